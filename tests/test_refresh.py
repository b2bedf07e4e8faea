"""Refreshes of some days against a run over everything."""

from __future__ import annotations

import datetime as dt
import re

import pytest
from compare import _sorted

import fixture
from waitline.plans.pipeline import Inputs, Pipeline
from waitline.plans.refresh import Refresh
from waitline.plans.store import Store
from waitline.settings import Settings
from waitline.sources import tables

ORDERS = "/root/testdata/sf0.001/orders.parquet"
MARTS = ("sla_daily", "sla_by_tier_case_type", "backlog_daily_proxy")


def rows(df):
    return _sorted([tuple(r) for r in df.collect()], df.columns)


class Raw:
    """The raw tables of a few months in a folder, and marts that follow them."""

    def __init__(self, spark, folder, settings=None):
        self.spark, self.raw, self.settings = spark, f"file://{folder}/raw", settings
        orders = spark.read.parquet(ORDERS).filter("o_orderdate < date'1995-02-20'")
        self.made = fixture.inputs_from_orders(orders, Store(spark))
        self.made.calendar.write.parquet(f"{self.raw}/calendar_dim")
        self.made.staffing.write.parquet(f"{self.raw}/staffing_schedule")
        self.state = f"file://{folder}/state"
        self.marts = Refresh(spark, self.raw, self.state, settings, case_id="bigint")

    def write(self, condition="true", change=lambda df: df, only_given_days=True):
        for name in ("cases", "events_log"):
            df = change(getattr(self.made, name).filter(condition))
            tables.write_partitioned(df, f"{self.raw}/{name}", only_given_days=only_given_days)

    def agrees(self):
        whole = Inputs.from_parquet(self.spark, self.raw, case_id="bigint")
        full = Pipeline(whole, Store(self.spark), self.settings)
        return [name for name in MARTS if rows(getattr(self.marts, name)) != rows(getattr(full, name))]


def test_refreshes_follow_what_is_written(spark, tmp_path, monkeypatch):
    """Days come, change, lose cases and go; refreshes are repeated, cut off and compacted."""
    raw = Raw(spark, tmp_path)
    raw.write("intake_date < date'1995-02-18' AND intake_date <> date'1995-02-03'")
    assert raw.marts.refresh() == 1
    raw.write("intake_date = date'1995-02-03'")  # a new day
    raw.write(  # a day with other tiers, without a case and without an event
        "intake_date = date'1995-02-16'",
        lambda df: df.filter("case_id % 3 <> 0").replace({"TIER_1": "TIER_3"}, subset=["tier"])
        if "tier" in df.columns
        else df.filter("case_id % 3 <> 0 AND NOT (case_id % 3 = 1 AND status = 'RESOLVED')"),
    )
    days, _ = raw.marts.written_days()
    assert {dt.date(1995, 2, 3), dt.date(1995, 2, 16)} <= set(days)
    assert raw.marts.refresh() == 2
    assert raw.agrees() == []
    taken_back = raw.marts._table("rows").filter("change < 0").select("intake_date").distinct()
    assert [r[0] for r in taken_back.collect()] == [dt.date(1995, 2, 16)]

    raw.write("intake_date = date'1995-01-20'", lambda df: df.filter("case_id % 3 = 0"))
    day = dt.date(1995, 1, 20)
    with monkeypatch.context() as broken:
        broken.setattr(Refresh, "_commit", cut_off)
        with pytest.raises(RuntimeError):
            raw.marts.refresh([day])
    raw.marts.refresh([day])
    raw.marts.refresh([day])
    raw.marts.compact()
    assert [row["version"] for row in raw.marts.commits()] == [5]
    raw.write(
        "intake_date < date'1995-02-20' AND intake_date <> date'1995-02-12'", only_given_days=False
    )
    raw.marts.refresh()  # everything is written again, a day is gone and others are new
    assert raw.agrees() == []
    ids = raw.marts.rows().select("case_id")
    assert ids.count() == ids.distinct().count()


def cut_off(*_):
    raise RuntimeError("lost")


def test_all_cases_in_the_table_and_only_the_days_read(spark, tmp_path, capsys):
    raw = Raw(spark, tmp_path, Settings(sla_mode="left"))
    raw.write("intake_date < date'1995-02-20'")
    raw.marts.refresh()
    raw.write("intake_date = date'1995-02-18'", lambda df: df.filter("case_id % 2 = 0"))
    day = dt.date(1995, 2, 18)
    raw.marts.refresh([day])
    assert raw.agrees() == []
    capsys.readouterr()
    raw.marts.rows([day]).explain("formatted")
    assert re.search(r"PartitionFilters: \[[^\]]*month", capsys.readouterr().out)
    inputs = Inputs.from_parquet(spark, raw.raw, case_id="bigint", days=[day, dt.date(1995, 5, 5)])
    for df in (inputs.cases, inputs.events_log):
        assert df.count() > 0
        assert all("intake_date=1995-02-18/" in file for file in df.inputFiles())
    none = Inputs.from_parquet(spark, raw.raw, case_id="bigint", days=[dt.date(1995, 5, 5)])
    assert none.cases.count() == 0 and none.cases.schema == inputs.cases.schema
