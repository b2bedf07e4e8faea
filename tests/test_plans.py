"""Plans of the case-sized steps: what must not be in them, and what must reach the scan."""

from __future__ import annotations

import re

import pytest

import fixture
from waitline.operators import drivers, events, facts, marts, milestones, scenarios, sla
from waitline.plans.pipeline import Pipeline
from waitline.plans.store import Store

ORDERS = "/root/testdata/sf0.001/orders.parquet"


@pytest.fixture(scope="module")
def pipeline(spark):
    store = Store(spark)
    return Pipeline(fixture.inputs_from_orders(spark.read.parquet(ORDERS), store), store)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


CASE_SIZED = {
    "events_deduped": lambda p: events.dedupe(p.inputs.events_log),
    "first_times": lambda p: milestones.first_times(p.inputs.cases, p.timed_events),
    "wait_minutes": lambda p: sla.wait_minutes(p.timed_events, p.clock),
    "wait_intervals": lambda p: sla.wait_intervals(p.timed_events),
    "case_sla_metrics": lambda p: p.case_sla_metrics,
    "case_deciles": lambda p: p.case_deciles,
    "sla_daily": lambda p: marts.sla_daily(p.case_sla_metrics),
    "driver_congestion_buckets": lambda p: p.driver_congestion_buckets,
    "driver_reopen_impact": lambda p: drivers.driver_reopen_impact(p.measured),
    "driver_stage_durations": lambda p: drivers.driver_stage_durations(p.case_stage_durations),
    "reopen_penalty": lambda p: scenarios.reopen_penalty(
        p.measured.filter("reopened_first_ts IS NOT NULL"), p.case_stage_durations
    ),
}


@pytest.mark.parametrize("name", CASE_SIZED)
def test_no_nested_loops_and_no_single_partition_windows(pipeline, name):
    plan = _plan(CASE_SIZED[name](pipeline))
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan
    if "Window" in plan:
        assert "SinglePartition" not in plan


def test_case_tables_are_projections_of_the_stored_one(pipeline):
    for df in (pipeline.case_sla_metrics, pipeline.case_stage_durations, pipeline.case_deciles):
        plan = _plan(df)
        assert "Exchange" not in plan and plan.count("FileScan") == 1


def test_the_wide_table_is_made_without_a_shuffle(pipeline):
    plan = _plan(facts.case_facts(pipeline.repaired, pipeline.clock))
    assert plan.count("BroadcastExchange") == plan.count("Exchange") == 4


def test_marts_read_only_their_columns(pipeline, capsys):
    marts.sla_by_tier_case_type(pipeline.case_sla_metrics).explain("formatted")
    plan = capsys.readouterr().out
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} == {
        "tier",
        "case_type",
        "intake_at",
        "triage_at",
        "resolved_at",
        "customer_wait_business_minutes",
        "is_measured",
    }
    assert re.search(r"PushedFilters: \[[^\]]*is_measured", plan)


def test_percentiles_count_before_the_shuffle_by_value(pipeline):
    plan = _plan(drivers.driver_stage_durations(pipeline.case_stage_durations))
    assert re.search(r"hashpartitioning\(tier#\d+, measure#\d+, value#\d+L?", plan)


def test_dedupe_spreads_a_busy_case_by_time(pipeline):
    assert re.search(
        r"hashpartitioning\(case_id#\d+L?, status#\d+, event_ts_canonical#\d+",
        _plan(events.dedupe(pipeline.inputs.events_log)),
    )


def test_the_log_is_deduplicated_once(pipeline):
    for df in (pipeline.events_clean, pipeline.events_deduped):
        plan = _plan(df)
        assert "Exchange" not in plan and plan.count("FileScan") == 1


def test_the_fixture_reaches_the_rare_branches(pipeline):
    firsts = milestones.first_times(pipeline.inputs.cases, pipeline.timed_events)
    for name in ("triage", "resolved"):
        assert firsts.filter(milestones._straddles(name)).count() > 0
    days = pipeline.case_congestion_exposure.agg({"biz_days_in_window": "max"}).first()[0]
    assert days == pipeline.settings.exposure_days
