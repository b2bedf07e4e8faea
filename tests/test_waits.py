from __future__ import annotations

import datetime as dt
import random
import re

import pytest
from helpers import calendar_table, events_table, open_minutes, position, ts
from pyspark.sql import functions as F

from waitline.functions.clock import BusinessClock
from waitline.operators import events, sla

FIRST, DAYS = dt.date(2025, 6, 30), 30
START = ts("2025-06-30 06:00:00")


@pytest.fixture(scope="module")
def log(spark):
    """Several waits per case, copies, equal times across statuses, one busy case."""
    rng = random.Random(11)
    rows = []
    for n in range(40):
        for _ in range(200 if n == 0 else rng.randrange(1, 9)):
            at = START + dt.timedelta(seconds=rng.choice([1, 60, 3600]) * rng.randrange(400))
            status = rng.choice(["CUSTOMER_WAIT", "CUSTOMER_WAIT", "ESCALATED", "REVIEW_QA"])
            rows += [(f"c{n:02d}", status, at)] * rng.choice([1, 1, 2])
            if rng.random() < 0.2:
                rows.append((f"c{n:02d}", "ASSIGNMENT", at))
    return rows, events.with_canonical_time(events_table(spark, rows))


def _plain_intervals(rows):
    out = []
    for case, start in {(c, at) for c, status, at in rows if status == "CUSTOMER_WAIT"}:
        later = [at for c, _, at in rows if c == case and at > start]
        out.append((case, start, min(later) if later else None))
    return out


def test_intervals_equal_the_plain_search(log):
    rows, timed = log
    found = [tuple(r) for r in sla.wait_intervals(timed).collect()]
    assert sorted(found, key=str) == sorted(_plain_intervals(rows), key=str)


@pytest.mark.parametrize("mode", ["inner", "left"])
def test_minutes_equal_the_sum_over_intervals(spark, log, mode):
    rows, timed = log
    spine = open_minutes(FIRST, DAYS)
    expected: dict[str, int] = {}
    for case, start, end in _plain_intervals(rows):
        if end is None or (mode == "inner" and start < spine[0]):
            continue
        minutes = position(spine, end) - position(spine, start)
        expected[case] = expected.get(case, 0) + minutes
    clock = BusinessClock.from_calendar(calendar_table(spark, FIRST, DAYS))
    found = {r[0]: r[1] for r in sla.wait_minutes(timed, clock, mode).collect()}
    assert found == expected


def test_unknown_mode_is_refused(spark):
    with pytest.raises(ValueError, match="mode"):
        sla.in_sla_table(spark.range(1), "outer")


def test_a_case_with_a_third_of_all_events_is_spread(spark):
    """The groups that a task gets whole are days of a case, or minutes, never a case."""
    log = [("hot" if n % 3 == 0 else f"c{n}", "CUSTOMER_WAIT" if n % 4 == 0 else "REVIEW_QA",
            START + dt.timedelta(minutes=n)) for n in range(30_000)]
    timed = events.with_canonical_time(events_table(spark, log))
    clock = BusinessClock.from_calendar(calendar_table(spark, FIRST, DAYS))
    for found, key in (
        (sla.wait_minutes(timed, clock), r"case_id#\d+, open_day#\d+L?"),
        (sla.wait_intervals(timed), r"case_id#\d+, day#\d+, minute#\d+"),
    ):
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert re.search(rf"hashpartitioning\({key}, \d+\)", plan)
    shares = [r["n"] for r in clock.with_positions(timed, {"event_ts_canonical": "position"})
              .groupBy(F.pmod(F.hash("case_id", F.expr("position div 600")), F.lit(8)))
              .agg(F.count("*").alias("n")).collect()]
    assert max(shares) < 2 * len(log) / 8
