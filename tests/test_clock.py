from __future__ import annotations

import datetime as dt
import random

import pytest
from helpers import calendar_table, open_minutes, position, ts
from pyspark.sql import functions as F

from waitline.functions.clock import BusinessClock, minutes_between, to_team_time
from waitline.settings import WorkingHours

FIRST, DAYS = dt.date(2025, 6, 28), 40  # begins on a Saturday
HOLIDAYS = (dt.date(2025, 7, 4),)
EDGES = [
    None,
    ts("2025-06-01 12:00:00"),  # before the calendar
    ts("2025-06-28 12:00:00"),  # in it, before the first business day
    ts("2025-06-30 07:59:59"),
    ts("2025-06-30 08:00:00"),
    ts("2025-06-30 08:00:00.000001"),
    ts("2025-06-30 08:00:01"),
    ts("2025-06-30 08:01:00"),
    ts("2025-07-01 17:59:00"),
    ts("2025-07-01 17:59:30"),
    ts("2025-07-01 18:00:00"),
    ts("2025-07-01 23:59:59.999999"),
    ts("2025-07-04 12:00:00"),  # holiday
    ts("2025-07-05 12:00:00"),  # Saturday
    ts("2025-08-06 18:30:00"),  # last day
    ts("2025-09-01 09:00:00"),  # after the calendar
]


def _positions(spark, clock, times):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(times)], "i int, t timestamp_ntz")
    rows = clock.with_positions(df, {"t": "p"}).withColumn("c", clock.covers(F.col("t"))).collect()
    return {r.i: (r.p, r.c) for r in rows}


def test_edges_equal_the_minute_table(spark):
    clock = BusinessClock.from_calendar(calendar_table(spark, FIRST, DAYS, HOLIDAYS))
    spine = open_minutes(FIRST, DAYS, HOLIDAYS)
    found = _positions(spark, clock, EDGES)
    for i, t in enumerate(EDGES):
        assert found[i] == (position(spine, t), t is not None and t >= spine[0]), t


def test_random_times_equal_the_minute_table_and_are_monotone(spark):
    rng = random.Random(7)
    start = ts("2025-06-20 00:00:00")
    times = sorted(
        start + dt.timedelta(seconds=rng.randrange(60 * 86400), microseconds=rng.choice([0, 0, 5]))
        for _ in range(400)
    )
    hours = WorkingHours(9, 17)
    clock = BusinessClock.from_calendar(calendar_table(spark, FIRST, DAYS, HOLIDAYS), hours)
    spine = open_minutes(FIRST, DAYS, HOLIDAYS, 9, 17)
    found = [_p for _p, _ in _positions(spark, clock, times).values()]
    assert found == [position(spine, t) for t in times]
    assert found == sorted(found)


def test_calendar_of_business_days_only_counts_missing_days_as_closed(spark):
    calendar = calendar_table(spark, FIRST, DAYS, HOLIDAYS).filter("NOT is_weekend")
    clock = BusinessClock.from_calendar(calendar)
    spine = open_minutes(FIRST, DAYS, HOLIDAYS)
    found = _positions(spark, clock, EDGES)
    assert [found[i][0] for i in range(len(EDGES))] == [position(spine, t) for t in EDGES]


def test_minute_spine(spark):
    clock = BusinessClock.from_calendar(calendar_table(spark, FIRST, DAYS, HOLIDAYS))
    rows = clock.minute_spine().orderBy("minute_idx").collect()
    assert [r.minute_ts for r in rows] == open_minutes(FIRST, DAYS, HOLIDAYS)
    assert [r.minute_idx for r in rows] == list(range(len(rows)))


def test_calendar_without_business_days_covers_nothing(spark):
    clock = BusinessClock.from_calendar(calendar_table(spark, FIRST, 2))
    assert _positions(spark, clock, [ts("2025-06-29 12:00:00")]) == {0: (0, False)}


def test_empty_calendar_is_refused(spark):
    with pytest.raises(ValueError, match="no days"):
        BusinessClock.from_calendar(calendar_table(spark, FIRST, DAYS).filter("false"))


def test_minutes_between_keeps_null_and_is_never_negative(spark):
    df = spark.createDataFrame([(5, 9), (9, 5), (None, 5), (5, None)], "a bigint, b bigint")
    got = [r[0] for r in df.select(minutes_between(F.col("a"), F.col("b"))).collect()]
    assert got == [4, 0, None, None]


def test_team_time_over_two_zones_and_a_clock_change(spark):
    df = spark.createDataFrame(
        [
            (ts("2025-01-15 17:00:00"), "America/Los_Angeles"),
            (ts("2025-07-15 17:00:00"), "America/Los_Angeles"),
            (ts("2025-07-15 17:00:00"), "America/New_York"),
        ],
        "t timestamp_ntz, z string",
    )
    got = [r[0].hour for r in df.select(to_team_time(F.col("t"), F.col("z"))).collect()]
    assert got == [9, 10, 13]
