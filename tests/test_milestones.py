from __future__ import annotations

import datetime as dt
import random

import pytest
from helpers import cases_table, events_table, ts

from waitline.operators import events, milestones

INTAKE = ts("2025-07-01 10:00:00")


def _hour(h):
    return INTAKE + dt.timedelta(hours=h)


@pytest.fixture(scope="module")
def tables(spark):
    """Cases with none to many triage and resolution events on both sides of intake."""
    rng = random.Random(3)
    rows, expected = [], {}
    for n in range(60):
        case = f"c{n:02d}"
        for status in ("TRIAGE", "RESOLVED"):
            hours = [rng.randrange(-4, 5) for _ in range(rng.randrange(0, 6))]
            rows += [(case, status, _hour(h)) for h in hours]
            after = [h for h in hours if h >= 0]
            expected[case, status] = _hour(min(after or hours)) if hours else None
        rows.append((case, "ESCALATED", _hour(1)))
    cases = cases_table(spark, [(f"c{n:02d}", INTAKE) for n in range(60)])
    return cases, events.with_canonical_time(events_table(spark, rows)), expected


def test_repair_takes_the_first_time_at_or_after_intake(tables, store):
    cases, log, expected = tables
    firsts = store.keep("test_firsts", milestones.first_times(cases, log))
    assert firsts.filter(milestones._straddles("triage")).count() > 0
    found = {
        (r.case_id, status): at
        for r in milestones.repaired_times(firsts, log).collect()
        for status, at in (("TRIAGE", r.triage_fixed), ("RESOLVED", r.resolved_fixed))
    }
    assert found == expected


def test_milestones_do_not_depend_on_deduplication(tables):
    cases, log, _ = tables

    def result(source):
        firsts = milestones.first_times(cases, source)
        repaired = milestones.repaired_times(firsts, source)
        return sorted(milestones.case_milestones(repaired).collect())

    raw = log.drop("event_ts_canonical")
    copies = events.with_canonical_time(raw.unionByName(raw))
    assert result(copies) == result(events.dedupe(raw))


def test_flags_and_unrepaired_resolution(spark):
    cases = cases_table(spark, [("a", INTAKE), ("b", INTAKE), ("c", INTAKE)])
    log = events.with_canonical_time(
        events_table(
            spark,
            [
                ("a", "TRIAGE", _hour(-2)),
                ("a", "RESOLVED", _hour(-1)),
                ("a", "RESOLVED", _hour(3)),
                ("a", "CANCELLED", _hour(4)),
                ("b", "CANCELLED", None, _hour(2)),
            ],
        )
    )
    repaired = milestones.repaired_times(milestones.first_times(cases, log), log)
    rows = {r.case_id: r for r in milestones.case_milestones(repaired).collect()}
    assert rows["a"].resolved_ts == _hour(-1) and rows["a"].cancelled_ts == _hour(4)
    assert rows["a"].is_triage_before_intake_after_fix and not rows["a"].is_terminal_missing
    assert rows["b"].is_triage_missing and not rows["b"].is_terminal_missing
    assert rows["c"].is_triage_missing and rows["c"].is_terminal_missing
    inputs = {r.case_id: r for r in milestones.sla_inputs(repaired).collect()}
    assert inputs["a"].resolved_ts_final == _hour(3)
