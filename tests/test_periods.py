"""Percentiles of periods from stored days, totals over segments, figures observed while writing."""

from __future__ import annotations

import datetime as dt
import random
import statistics

import pytest
from helpers import events_table, ts

from waitline.operators import events, marts, periods, quality
from waitline.plans import observed

SLA = """case_id int, intake_date date, tier string, case_type string,
    first_touch_business_minutes bigint, sla_b_breached boolean,
    first_resolution_business_minutes_including_cw bigint, sla_a_breached_including_cw boolean,
    first_resolution_business_minutes_paused_cw bigint, sla_a_breached_paused_cw boolean"""


@pytest.fixture(scope="module")
def sla(spark):
    rng = random.Random(2)

    def value():
        return None if rng.random() < 0.1 else int(rng.paretovariate(1) * 50)

    rows = [
        (n, dt.date(2025, 1, 1) + dt.timedelta(days=rng.randrange(200)), rng.choice("xy"),
         rng.choice("pq"), value(), n % 3 == 0, value(), n % 5 == 0, None, None)
        for n in range(20_000)
    ]
    return rows, spark.createDataFrame(rows, SLA)


@pytest.mark.parametrize("period, months", [("month", 1), ("quarter", 3), ("year", 12)])
def test_periods_equal_percentiles_of_their_rows(sla, period, months):
    rows, df = sla
    found = periods.period_percentiles(periods.day_counts(df), period).collect()
    expected = {}
    for r in rows:
        first = dt.date(r[1].year, (r[1].month - 1) // months * months + 1, 1)
        for measure, at in (("touch", 4), ("whole", 6)):
            if r[at] is not None:
                expected.setdefault((first, measure), []).append(r[at])
    assert {(r["period"], r["measure"]) for r in found} == expected.keys()
    for r in found:
        values = expected[r["period"], r["measure"]]
        cuts = statistics.quantiles(values, n=100, method="inclusive")
        assert r["cases"] == len(values)
        for q in (50, 90, 95):
            assert r[f"p{q}_min"] == pytest.approx(cuts[q - 1], abs=1e-5)


@pytest.mark.parametrize("k", [32, 200, periods.SKETCH_K])
def test_sketches_keep_their_error(sla, k):
    _, df = sla
    sketches = periods.day_sketches(df, k=k)
    found = periods.sketched_percentiles(sketches, "quarter", k=k)
    judged = periods.sketch_errors(found, periods.day_counts(df), "quarter", k=k).collect()
    assert len(judged) == 6 and all(r["within_error"] for r in judged)
    assert periods.rank_error(k) < 2.3 / k**0.9


def test_sketches_are_small_and_wrong_ones_are_seen(sla):
    _, df = sla
    whole = periods.day_sketches(df.selectExpr("*", "1 AS one"), keys=["one"], k=200)
    assert whole.selectExpr("length(touch) AS bytes").first()["bytes"] < 8_000
    found = periods.sketched_percentiles(periods.day_sketches(df), "quarter")
    off = found.selectExpr("period", "measure", "p50_min", "p90_min", "p50_min AS p95_min")
    judged = periods.sketch_errors(off, periods.day_counts(df), "quarter").collect()
    assert not any(r["within_error"] for r in judged)


def test_segment_sets_equal_their_own_groups(sla):
    _, df = sla
    counts = marts.duration_counts(df, marts.SEGMENT_KEYS)
    sets = {tuple(r[:3]): tuple(r[3:]) for r in marts.sla_by_segment_sets(counts).collect()}
    assert len(sets) == 9
    both = {(*r[:2], 0): tuple(r[2:]) for r in marts.sla_by_tier_case_type(df).collect()}
    one = {(t, None, 1): v for (t, *_), v in (
        (r[:2], tuple(r[2:])) for r in
        marts.sla_by_tier_case_type(df.selectExpr("* EXCEPT (case_type)", "'' AS case_type")).collect()
    )}
    everything = marts.sla_by_tier_case_type(
        df.selectExpr("* EXCEPT (tier, case_type)", "'' AS tier", "'' AS case_type")
    ).collect()
    assert {k: v for k, v in sets.items() if k[2] == 0} == both
    assert {k: v for k, v in sets.items() if k[2] == 1} == one
    assert sets[None, None, 3] == tuple(everything[0][2:])


def test_observed_figures_equal_those_of_a_second_look(spark, tmp_path):
    rng = random.Random(4)
    base = ts("2025-07-01T09:00:00")
    rows = []
    for _ in range(500):
        at = base + dt.timedelta(minutes=rng.randrange(300))
        event = None if rng.random() < 0.1 else at
        rows.append((f"c{rng.randrange(9)}", rng.choice(["TRIAGE", "RESOLVED"]), event, base))
    log = events_table(spark, rows)
    staged = observed.stage_log(log, f"file://{tmp_path}/staged")
    deduped = events.dedupe(log)
    cleaned = events.clean(deduped)
    pairs = [
        (staged.event_integrity(), quality.event_integrity(log)),
        (staged.ingestion_before_event(), quality.ingestion_before_event(log)),
        (staged.clean_event_anomalies(), quality.clean_event_anomalies(cleaned)),
        (staged.dedup_reconciliation(), quality.dedup_reconciliation(log, deduped)),
    ]
    for seen, looked_up in pairs:
        assert seen.columns == looked_up.columns
        assert [tuple(r) for r in seen.collect()] == [tuple(r) for r in looked_up.collect()]
    assert staged.events_clean.count() == cleaned.count()


def test_observed_figures_of_an_empty_log(spark, tmp_path):
    log = events_table(spark, [("a", "TRIAGE", ts("2025-07-01T09:00:00"))]).limit(0)
    staged = observed.stage_log(log, f"file://{tmp_path}/staged")
    assert tuple(staged.dedup_reconciliation().first()) == (0, 0, 0)
    assert staged.event_integrity().first()[0] is None
