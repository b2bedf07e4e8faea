"""Small hand-made tables, and slow but plain versions of the operators."""

from __future__ import annotations

import datetime as dt

from waitline import schemas

DAY = dt.timedelta(days=1)
MINUTE = dt.timedelta(minutes=1)


def ts(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def cases_table(spark, rows):
    """Rows of (case_id, intake) or (case_id, intake, tier)."""
    full = [
        (r[0], r[1], "ACCESS_REVIEW", r[2] if len(r) > 2 else "TIER_1", "UTC", r[1].date())
        for r in rows
    ]
    return spark.createDataFrame(full, schemas.cases_schema())


def events_table(spark, rows):
    """Rows of (case_id, status, event time or None, ingestion time or None to be the same)."""
    full = []
    for number, (case, status, at, *rest) in enumerate(rows):
        seen = rest[0] if rest else at
        full.append((f"e{number:04d}", case, status, at, seen, "UTC", False, False, seen.date()))
    return spark.createDataFrame(full, schemas.events_schema())


def calendar_table(spark, first: dt.date, days: int, holidays=()):
    rows = []
    for n in range(days):
        d = first + n * DAY
        rows.append((d, d.weekday(), d.weekday() >= 5, d in holidays, None))
    return spark.createDataFrame(rows, schemas.CALENDAR)


def open_minutes(first: dt.date, days: int, holidays=(), start=8, end=18):
    """Every open minute of a calendar, in order."""
    return [
        dt.datetime.combine(first + n * DAY, dt.time(start)) + m * MINUTE
        for n in range(days)
        if (first + n * DAY).weekday() < 5 and (first + n * DAY) not in holidays
        for m in range((end - start) * 60)
    ]


def position(spine, at):
    """Number of the first open minute at or after a time."""
    return None if at is None else sum(minute < at for minute in spine)
