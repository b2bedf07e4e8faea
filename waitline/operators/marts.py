"""SLA summaries per day and per segment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waitline.functions.numbers import quantiles_of, rows_of, share, value_counts
from waitline.settings import REPORTED_QUANTILES

# Measure, its minutes, its breach flag.
DURATIONS = {
    "touch": ("first_touch_business_minutes", "sla_b_breached"),
    "whole": ("first_resolution_business_minutes_including_cw", "sla_a_breached_including_cw"),
    "paused": ("first_resolution_business_minutes_paused_cw", "sla_a_breached_paused_cw"),
}


def duration_counts(
    sla: DataFrame, keys: Sequence[str], weight: str | None = None
) -> DataFrame:
    """How often each duration and its breach flag occur per group, see ``value_counts``."""
    return value_counts(
        sla,
        keys,
        {name: minutes for name, (minutes, _) in DURATIONS.items()},
        {name: flag for name, (_, flag) in DURATIONS.items()},
        weight,
    )


def merged_counts(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Counts of several periods or changes as one, by fewer or the same keys."""
    by = [*keys, "measure", "value", "flag"]
    return counts.groupBy(*by).agg(F.sum("n").alias("n")).filter("n <> 0")


def _breach_pct(measure: str) -> Column:
    return share(rows_of(measure, F.col("flag")), rows_of(measure))


def _spread(measure: str, prefix: str, suffix: str = "") -> list[Column]:
    """p50, p90 and p95 columns of one measure."""
    values = quantiles_of(measure, REPORTED_QUANTILES)
    return [
        value.alias(f"{prefix}_p{round(q * 100)}_min{suffix}")
        for q, value in zip(REPORTED_QUANTILES, values, strict=True)
    ]


#: What the counts of a day, and of a segment, are kept by.
DAY_KEYS = ("intake_date", "is_triage_missing_for_sla", "is_terminal_missing_for_sla")
SEGMENT_KEYS = ("tier", "case_type")


def sla_daily(sla: DataFrame) -> DataFrame:
    """Volumes, breach rates, percentiles and missing times per intake day."""
    return sla_daily_of(duration_counts(sla, DAY_KEYS))


def sla_daily_of(counts: DataFrame) -> DataFrame:
    """``sla_daily`` from the counts of its values by ``DAY_KEYS``."""
    known = F.col("value").isNotNull()
    return counts.groupBy("intake_date").agg(
        rows_of("touch").alias("cases_in_sla_table"),
        rows_of("touch", known).alias("cases_with_triage"),
        _breach_pct("touch").alias("sla_b_breach_pct"),
        *_spread("touch", "ft"),
        rows_of("whole", known).alias("cases_resolved"),
        _breach_pct("whole").alias("sla_a_breach_pct_including_cw"),
        _breach_pct("paused").alias("sla_a_breach_pct_paused_cw"),
        *_spread("whole", "fr", "_inc_cw"),
        *_spread("paused", "fr", "_pause_cw"),
        share(rows_of("touch", F.col("is_triage_missing_for_sla")), rows_of("touch")).alias(
            "dq_triage_missing_pct"
        ),
        share(rows_of("touch", F.col("is_terminal_missing_for_sla")), rows_of("touch")).alias(
            "dq_terminal_missing_pct"
        ),
    )


def sla_by_tier_case_type(sla: DataFrame) -> DataFrame:
    """Volumes, breach rates and percentiles per tier and case type."""
    return sla_by_tier_case_type_of(duration_counts(sla, SEGMENT_KEYS))


def sla_by_tier_case_type_of(counts: DataFrame) -> DataFrame:
    """``sla_by_tier_case_type`` from the counts of its values by ``SEGMENT_KEYS``."""
    return counts.groupBy(*SEGMENT_KEYS).agg(*segment_columns())


def sla_by_segment_sets(counts: DataFrame) -> DataFrame:
    """The figures of ``sla_by_tier_case_type`` for both keys, each of them alone, and in all.

    One pass over counts by ``SEGMENT_KEYS``: percentiles of the larger groups come from the same
    counts, exactly. ``level`` has the bit 2 where all tiers are taken together and the bit 1
    where all case types are, since NULL may also be a value.
    """
    tier, case_type = (F.col(c) for c in SEGMENT_KEYS)
    sets = [[tier, case_type], [tier], [case_type], []]
    return counts.groupingSets(sets, tier, case_type).agg(
        F.grouping_id().alias("level"), *segment_columns()
    )


def segment_columns() -> list[Column]:
    """Volumes, breach rates and percentiles of a group of value counts."""
    return [
        rows_of("touch").alias("cases"),
        _breach_pct("touch").alias("sla_b_breach_pct"),
        *_spread("touch", "ft"),
        _breach_pct("whole").alias("sla_a_breach_pct_including_cw"),
        _breach_pct("paused").alias("sla_a_breach_pct_paused_cw"),
        *_spread("whole", "fr", "_inc_cw"),
        *_spread("paused", "fr", "_pause_cw"),
    ]


def sla_percentiles(sla: DataFrame) -> DataFrame:
    """Nine percentiles over all resolved cases, one row."""
    return duration_counts(sla.filter("resolved_ts IS NOT NULL"), []).agg(
        *_spread("touch", "ft"),
        *_spread("whole", "fr", "_inc"),
        *_spread("paused", "fr", "_pause"),
    )
