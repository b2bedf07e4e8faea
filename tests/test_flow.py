from __future__ import annotations

import datetime as dt
import random

from helpers import DAY, calendar_table, ts

from waitline.functions.clock import BusinessClock
from waitline.operators import flow

FIRST, DAYS = dt.date(2025, 6, 28), 60
HOLIDAYS = (dt.date(2025, 7, 4),)


def _congestion(spark, rows):
    return spark.createDataFrame(rows, "cal_date date, team_tz string, congestion_flow_index double")


def test_exposure_equals_the_range_join(spark):
    rng = random.Random(5)
    business = [
        d
        for d in (FIRST + n * DAY for n in range(DAYS))
        if d.weekday() < 5 and d not in HOLIDAYS
    ]
    # Two zones on some days, no reading on others.
    readings = [
        (d, tz, round(rng.random() * 3, 4) if rng.random() < 0.8 else None)
        for d in business
        for tz in (("A", "B") if rng.random() < 0.3 else ("A",))
    ]
    cases = []
    for n in range(200):
        start = FIRST + rng.randrange(-10, DAYS + 10) * DAY
        end = start + rng.randrange(-2, 30) * DAY
        resolved = None if n % 17 == 0 else dt.datetime.combine(end, dt.time(12))
        cases.append((n, start if n % 19 else None, resolved))
    clock = BusinessClock.from_calendar(calendar_table(spark, FIRST, DAYS, HOLIDAYS))
    running = flow.flow_running(_congestion(spark, readings), clock)
    df = spark.createDataFrame(cases, "case_id int, intake_date date, resolved_ts timestamp_ntz")
    found = {
        r.case_id: (r.biz_days_in_window, r.avg_congestion_flow_index)
        for r in flow.with_exposure(df, running, clock, 10).collect()
        if r.avg_congestion_flow_index is not None
    }
    expected = {}
    for n, start, resolved in cases:
        if resolved is None or start is None:
            continue
        days = [d for d in business if start <= d <= resolved.date()][:10]
        values = [round(v * 10000) for d, _, v in readings if d in days and v is not None]
        if values:
            total, count = sum(values), len(values)
            expected[n] = (count, ((2 * total + count) // (2 * count)) / 10000)
    assert found == expected


def test_backlog_and_indices(spark):
    first = dt.date(2025, 7, 3)  # Thursday before a holiday and a weekend
    calendar = calendar_table(spark, first, 5, HOLIDAYS)
    cases = spark.createDataFrame([(first,), (first,), (first + 2 * DAY,)], "intake_date date")
    closed = spark.createDataFrame(
        [
            (ts("2025-07-06 10:00:00"), None),
            (None, ts("2025-07-07 10:00:00")),
            (ts("2026-01-01 10:00:00"), None),  # after the calendar
            (None, None),
        ],
        "resolved_ts timestamp_ntz, cancelled_ts timestamp_ntz",
    )
    staffing = spark.createDataFrame(
        [(first, "UTC", 2), (first + 4 * DAY, "UTC", 0)],
        "cal_date date, team_tz string, effective_agents_total bigint",
    )
    backlog = flow.backlog_daily_proxy(cases, closed, calendar)
    assert [r.open_backlog_proxy for r in backlog.orderBy("cal_date").collect()] == [2, 2, 3, 2, 1]
    daily = flow.congestion_daily(backlog, staffing).orderBy("cal_date").collect()
    assert [r.congestion_index for r in daily] == [1.0, None, None, None, None]
    v2 = flow.congestion_daily_v2(backlog, staffing, calendar).orderBy("cal_date").collect()
    assert [(r.cal_date.day, r.backlog_delta, r.congestion_flow_index) for r in v2] == [
        (3, None, 1.0),
        (7, -1, None),
    ]
