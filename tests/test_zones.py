"""Teams in several zones against a run for each zone alone."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from compare import _sorted
from helpers import calendar_table, cases_table, events_table, ts
from pyspark.sql import functions as F

from waitline.functions.zones import ZonedClock, in_team_time
from waitline.plans.pipeline import Inputs, Pipeline
from waitline.plans.store import Store
from waitline.plans.zones import zoned_sla_metrics
from waitline.settings import Settings, WorkingHours
from waitline.sources import staffing

FIRST = dt.date(2025, 10, 20)  # clocks go back on 26 October in Paris, on 2 November in New York
HOURS = {
    "Europe/Paris": WorkingHours(9, 17),
    "America/New_York": WorkingHours(8, 18),
    "Asia/Kolkata": WorkingHours(10, 16),
}


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(6)
    cases, log = [], []
    for n in range(90):
        case, at = f"c{n}", ts("2025-10-21T03:00:00") + dt.timedelta(minutes=rng.randrange(12_000))
        cases.append((case, at, "TIER_1"))
        log.append((case, "INTAKE", at))
        for status in ("TRIAGE", "CUSTOMER_WAIT", "REVIEW_QA", "CUSTOMER_WAIT", "RESOLVED"):
            at += dt.timedelta(minutes=rng.choice([3, 50, 400, 2000]))
            log.append((case, status, at))
    names = F.array(*[F.lit(z) for z in [*HOURS, "Etc/Unknown"]])
    zone = F.get(names, F.pmod(F.hash("case_id"), F.lit(4)))
    return cases_table(spark, cases).withColumn("team_tz", zone), events_table(spark, log)


def calendars(spark):
    holidays = {"Europe/Paris": [dt.date(2025, 11, 3)], "Asia/Kolkata": [dt.date(2025, 10, 22)]}
    return {z: calendar_table(spark, FIRST, 30, holidays.get(z, ())) for z in HOURS}


def rows(df):
    return _sorted([tuple(r) for r in df.collect()], df.columns)


@pytest.mark.parametrize("mode", ["inner", "left"])
def test_equals_each_zone_alone(spark, tables, mode):
    local, log = in_team_time(*tables)
    days, settings = calendars(spark), Settings(sla_mode=mode)
    found = zoned_sla_metrics(local, log, days, HOURS, Store(spark), settings)
    for zone, calendar in days.items():
        mine = local.filter(F.col("team_tz") == zone)
        inputs = Inputs(
            mine, log.filter(F.col("team_tz") == zone), calendar, staffing.staffing_schedule(calendar)
        )
        alone = Pipeline(inputs, Store(spark), Settings(sla_mode=mode, hours=HOURS[zone]))
        want = rows(alone.case_sla_metrics)
        assert want and rows(found.filter(F.col("team_tz") == zone)) == want
    # A zone without calendar has no positions.
    unknown = found.filter("team_tz = 'Etc/Unknown'")
    if mode == "inner":
        assert unknown.count() == 0
    else:
        assert unknown.filter("first_touch_business_minutes IS NOT NULL").count() == 0


def test_wall_times_follow_the_change_of_clocks(spark):
    at = ["2025-10-25T23:30:00", "2025-10-26T00:30:00", "2025-10-26T01:30:00"]
    cases = cases_table(spark, [(f"c{n}", ts(t)) for n, t in enumerate(at)])
    cases = cases.withColumn("team_tz", F.lit("Europe/Paris"))
    local, log = in_team_time(cases, events_table(spark, [("c1", "TRIAGE", ts(at[1])), ("x", "TRIAGE", ts(at[1]))]))
    times = [r["intake_ts"].isoformat()[11:16] for r in local.orderBy("case_id").collect()]
    assert times == ["01:30", "02:30", "02:30"]
    assert [(r["case_id"], r["event_ts"].hour, r["team_tz"]) for r in log.collect()] == [
        ("c1", 2, "Europe/Paris")
    ]


def test_positions_are_those_of_the_zone(spark):
    clock = ZonedClock.from_calendars(calendars(spark), HOURS)
    rows = [(z, ts(t)) for z in HOURS for t in (
        "2025-10-01T00:00:00", "2025-10-20T09:00:00", "2025-10-22T12:00:30", "2025-12-24T00:00:00"
    )]
    df = spark.createDataFrame(rows, "team_tz string, at timestamp_ntz")
    placed = clock.with_positions(df, {"at": "position"}).withColumn("covered", clock.covers(F.col("at")))
    found = {(r["team_tz"], r["at"]): (r["position"], r["covered"]) for r in placed.collect()}
    for zone, at in rows:
        alone = clock.clocks[zone]
        one = alone.with_positions(df.filter(F.col("team_tz") == zone), {"at": "position"})
        want = one.withColumn("covered", alone.covers(F.col("at"))).filter(F.col("at") == F.lit(at))
        r = want.first()
        assert found[zone, at] == (r["position"], r["covered"])


def test_times_of_an_unknown_zone_are_null(spark):
    at = ts("2025-10-25T23:30:00")
    names = ["Etc/Unknown", "Nowhere", "", None, "Europe/Paris", "UTC", "+02:00", "GMT+1", "Etc/GMT-3"]
    cases = cases_table(spark, [(f"c{n}", at, "TIER_1") for n in range(len(names))])
    zones = spark.createDataFrame(
        [(f"c{n}", z) for n, z in enumerate(names)], "case_id string, team_tz string"
    )
    log = events_table(spark, [(f"c{n}", "TRIAGE", at) for n in range(len(names))])
    local, moved = in_team_time(cases.drop("team_tz").join(zones, "case_id"), log)
    assert sorted(moved.columns) == sorted([*log.columns, "team_tz"])
    hours = [None] * 4 + [1, 23, 1, 0, 2]
    for df, column in ((local, "intake_ts"), (moved, "event_ts")):
        found = {r["case_id"]: r[column] for r in df.collect()}
        assert [found[f"c{n}"] and found[f"c{n}"].hour for n in range(len(names))] == hours
