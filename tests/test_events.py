from __future__ import annotations

import datetime as dt

from helpers import events_table, ts
from pyspark.sql import functions as F

from waitline.operators import events

AT = ts("2025-07-01 10:00:00")
LATER = ts("2025-07-01 10:30:00")


def _kept(df):
    return sorted((r.event_id, r.event_ts, r.ingestion_ts) for r in events.dedupe(df).collect())


def test_prefers_own_time_then_early_ingestion_then_id(spark):
    log = events_table(
        spark,
        [
            ("a", "TRIAGE", None, AT),  # canonical time equal to the next rows' time
            ("a", "TRIAGE", AT, LATER),
            ("a", "TRIAGE", AT, AT),
            ("a", "TRIAGE", AT, AT),
        ],
    )
    assert _kept(log) == [("e0002", AT, AT)]


def test_a_retry_without_time_survives_under_its_own_ingestion_time(spark):
    log = events_table(
        spark, [("a", "TRIAGE", None, AT), ("a", "TRIAGE", None, LATER), ("b", "TRIAGE", None, AT)]
    )
    assert [e for e, _, _ in _kept(log)] == ["e0000", "e0001", "e0002"]


def test_dedupe_is_idempotent_and_keeps_one_of_many_copies(spark):
    rows = [("hot", "TRIAGE", AT, LATER)] * 300 + [(f"c{i}", "TRIAGE", AT) for i in range(200)]
    log = events_table(spark, rows)
    once = events.dedupe(log)
    assert once.count() == 201
    assert _kept(once) == _kept(log)


def test_copies_are_limited_before_the_shuffle(spark):
    plan = events.dedupe(events_table(spark, [("a", "TRIAGE", AT)]))._jdf.queryExecution()
    text = plan.executedPlan().toString()
    assert text.count("WindowGroupLimit") == 2


def test_a_case_with_a_third_of_the_events_is_spread_over_partitions(spark):
    rows = [("hot", "TRIAGE", AT + dt.timedelta(seconds=i)) for i in range(1000)]
    rows += [(f"c{i}", "TRIAGE", AT) for i in range(2000)]
    deduped = events.dedupe(events_table(spark, rows).repartition(4))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        parts = deduped.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    sizes = [r["count"] for r in parts]
    assert sum(sizes) == 3000 and max(sizes) < 2 * 3000 / 8


def test_flags(spark):
    log = events_table(
        spark,
        [("a", "TRIAGE", LATER, AT), ("a", "INTAKE", None, AT), ("b", "INTAKE", AT, AT)],
    )
    flags = {
        r.event_id: (r.is_ingestion_before_event_ts, r.is_event_ts_missing, r.is_tz_inconsistent)
        for r in events.clean(events.dedupe(log)).collect()
    }
    assert flags == {
        "e0000": (True, False, False),
        "e0001": (False, True, False),
        "e0002": (False, False, False),
    }
