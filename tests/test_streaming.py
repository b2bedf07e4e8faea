"""Dedup of a stream of files against the batch operator, and what becomes of its state."""

from __future__ import annotations

import datetime as dt
import os
from pathlib import Path

import pytest
from compare import _sorted
from helpers import events_table, ts

from waitline import schemas
from waitline.operators import events
from waitline.streaming import dedup

DAY = dt.timedelta(days=1)


def rows(df):
    return _sorted([tuple(r) for r in df.collect()], df.columns)


class Log:
    """A folder to which batches are written, and the stream that follows it."""

    def __init__(self, spark, folder, lateness):
        self.spark, self.folder, self.lateness = spark, folder, lateness
        self.schema = schemas.events_schema()

    def add(self, events_rows):
        events_table(self.spark, events_rows).coalesce(1).write.mode("append").parquet(
            f"{self.folder}/log"
        )

    def run(self, files=1):
        log = dedup.read_log(self.spark, f"{self.folder}/log", self.schema, files)
        query = dedup.start(
            dedup.dedupe(log, self.lateness), f"{self.folder}/out", f"{self.folder}/checkpoint"
        )
        query.awaitTermination()
        return [p for p in query.recentProgress if p["stateOperators"]]

    def end(self, at):
        dedup.write_heartbeat(self.spark, f"{self.folder}/log", self.schema, at)
        return self.run()

    def out(self):
        return self.spark.read.parquet(f"{self.folder}/out")


@pytest.fixture
def log(spark, tmp_path):
    return Log(spark, f"file://{tmp_path}", "1 day")


def test_best_delivery_of_later_batches_wins(spark, log):
    """Copies come in three files; times are missing, later deliveries are better or worse."""
    noon = ts("2025-07-01T12:00:00")
    batches = [
        [("a", "TRIAGE", noon, noon + 2 * DAY / 24), ("b", "INTAKE", None, noon)],
        [("a", "TRIAGE", noon, noon + DAY / 24), ("b", "INTAKE", noon, noon + DAY)],
        [("a", "TRIAGE", noon, noon + DAY / 24), ("c", "INTAKE", noon - DAY / 2, noon)],
    ]
    for batch in batches:
        log.add(batch)
    log.run()
    log.end(noon + 30 * DAY)
    everything = spark.read.parquet(f"{log.folder}/log").filter("event_id <> 'heartbeat'")
    assert rows(log.out()) == rows(events.dedupe(everything))
    assert log.out().count() == 3


def test_state_is_dropped_after_the_watermark(spark, log):
    start = ts("2025-07-01T08:00:00")
    for day in range(6):
        log.add([(f"c{n}", "TRIAGE", start + day * DAY) for n in range(50)] * 2)
    progress = log.run()
    held = [p["stateOperators"][0]["numRowsTotal"] for p in progress]
    assert max(held) <= 150 and held[-1] <= 100
    assert log.out().count() == 250  # the last day waits for what may still come
    assert log.end(start + 40 * DAY)[-1]["stateOperators"][0]["numRowsTotal"] == 1
    assert log.out().count() == 300


def test_late_within_the_watermark_counts_and_later_does_not(spark, log):
    noon = ts("2025-07-10T12:00:00")
    log.add([("a", "TRIAGE", noon)])
    log.run()
    log.add([("late", "TRIAGE", noon - DAY / 2), ("too late", "TRIAGE", noon - 2 * DAY)])
    progress = log.run()
    assert sum(p["stateOperators"][0]["numRowsDroppedByWatermark"] for p in progress) == 1
    log.end(noon + 30 * DAY)
    assert {r["case_id"] for r in log.out().collect()} == {"a", "late"}


def test_a_restart_gives_nothing_twice(spark, log):
    noon = ts("2025-07-01T12:00:00")
    for day in range(4):
        log.add([("a", "TRIAGE", noon + day * DAY)] * 3)
        log.run()
    log.end(noon + 30 * DAY)
    log.run()
    assert log.out().count() == 4


def test_the_session_zone_plays_no_part(spark, log):
    """An hour that a zone skips, and one that it has twice, keep their events apart."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        times = ["2025-03-09T02:30:00", "2025-03-09T03:30:00", "2025-11-02T01:30:00"]
        log.add([("a", "TRIAGE", ts(t)) for t in times])
        log.run()
        log.end(ts("2026-01-01T00:00:00"))
        assert sorted(r["event_ts"].isoformat() for r in log.out().collect()) == times
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_rows_without_any_time_are_left_out(spark):
    schema = schemas.events_schema()
    row = spark.createDataFrame([("e", "c", "TRIAGE", *[None] * 6)], schema)
    assert dedup.dedupe(row).count() == 0
    assert dedup.dedupe(row.limit(0)).count() == 0


def test_files_are_read_in_the_order_of_their_tasks(spark, tmp_path):
    folder = str(tmp_path / "log")
    spark.range(0, 6, 1, 6).write.parquet(folder)
    files = sorted(Path(folder).glob("part-*"))
    for number, file in enumerate(files):
        os.utime(file, (0, 1_000 * (number * 5 % 7)))
    dedup.order_files(spark, folder)
    times = [file.stat().st_mtime for file in files]
    assert times == sorted(set(times))
    stream = dedup.read_log(spark, folder, spark.range(0).schema, 2)
    seen = []
    stream.writeStream.trigger(availableNow=True).foreachBatch(
        lambda batch, _: seen.append(sorted(r.id for r in batch.collect()))
    ).start().awaitTermination()
    assert seen == [[0, 1], [2, 3], [4, 5]]


def test_batches_of_the_streamed_log_do_not_grow_with_it(spark, tmp_path, monkeypatch):
    import __spark_entry__ as registered

    first = dt.datetime(2025, 7, 1)
    orders = [(n, 7 * n, "FOP"[n % 3], first + n % 90 * DAY) for n in range(1, 201)]
    columns = "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp_ntz"
    spark.createDataFrame(orders, columns).write.parquet(f"{tmp_path}/orders.parquet")
    log = registered._pipeline(spark, str(tmp_path)).inputs.events_log
    monkeypatch.setattr(registered, "BATCH_ROWS", 200)
    started, start = [], dedup.start
    monkeypatch.setattr(dedup, "start", lambda *a: started.append(start(*a)) or started[-1])
    found = registered.queries()["w1_events_dedup_stream"](spark, str(tmp_path))
    assert sorted(rows(found)) == sorted(rows(events.dedupe(log)))
    given = [p["numInputRows"] for p in started[0].recentProgress]
    assert sum(given) == log.count() > 5 * 200
    assert max(given) <= 2 * 200
