"""Quality and headline figures; each is a small DataFrame computed by Spark."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waitline.functions.numbers import interpolated, mean_of_scaled, rate, scaled
from waitline.settings import INCONSISTENT_ZONE, REPORTED_QUANTILES


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table, one row each."""
    counts = [
        df.agg(F.count("*").alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def intake_coverage(cases: DataFrame) -> DataFrame:
    return cases.agg(
        F.min("intake_date").alias("min_intake_date"),
        F.max("intake_date").alias("max_intake_date"),
        F.count_distinct("intake_date").alias("distinct_intake_days"),
    )


def event_rate_columns(digits: int | None = 3) -> list[Column]:
    early = F.col("event_ts").isNotNull() & (F.col("ingestion_ts") < F.col("event_ts"))
    return [
        rate(F.col("event_ts").isNull(), digits).alias("pct_missing_event_ts"),
        rate(F.col("is_duplicate"), digits).alias("pct_duplicate_flag"),
        rate(F.col("is_late_arriving"), digits).alias("pct_late_arriving_flag"),
        rate(F.col("event_tz") == INCONSISTENT_ZONE, digits).alias("pct_tz_inconsistent"),
        rate(early, digits).alias("pct_ingestion_before_event_ts"),
    ]


def event_rates(events: DataFrame, digits: int | None = 3) -> DataFrame:
    """Shares of missing times, flagged duplicates, late events, untrusted zones and
    events ingested before they happened, from one pass over the events."""
    return events.agg(*event_rate_columns(digits))


def event_integrity(events: DataFrame, digits: int | None = 3) -> DataFrame:
    return event_rates(events, digits).drop("pct_ingestion_before_event_ts")


def ingestion_before_event(events: DataFrame) -> DataFrame:
    return event_rates(events).select("pct_ingestion_before_event_ts")


def duplicate_groups(events: DataFrame) -> DataFrame:
    """Groups of equal case, status and time, and the rows beyond the first of each."""
    groups = (
        events.filter("event_ts IS NOT NULL")
        .groupBy("case_id", "status", "event_ts")
        .agg(F.count("*").alias("n"))
        .filter("n > 1")
    )
    return groups.agg(
        F.count("*").alias("duplicate_groups"),
        F.sum(F.col("n") - 1).alias("duplicate_extra_rows"),
    )


# Statuses whose coverage is reported.
COVERED_STATUSES = (
    "TRIAGE",
    "RESOLVED",
    "CANCELLED",
    "REOPENED",
    "ESCALATED",
    "CUSTOMER_WAIT",
)


def case_profile(events: DataFrame) -> DataFrame:
    """Per case: number of events, statuses reached, first intake and triage times.

    The case-level figures below are aggregates of it. Used on the events
    directly, each computes only its own columns; stored, one pass serves all.
    Partial aggregates combine on the map side, so a case with very many events
    is one row per task.
    """

    def first(status: str, time: str) -> Column:
        return F.min(F.when(F.col("status") == status, F.col(time)))

    return events.groupBy("case_id").agg(
        F.count("*").alias("events"),
        *[
            F.max(F.when(F.col("status") == s, 1).otherwise(0)).alias(f"has_{s.lower()}")
            for s in COVERED_STATUSES
        ],
        *[
            first(status, time).alias(f"{status.lower()}_{time}")
            for status in ("INTAKE", "TRIAGE")
            for time in ("event_ts", "event_ts_canonical")
        ],
    )


def events_per_case(profile: DataFrame) -> DataFrame:
    """Events, cases among them and their ratio."""
    return profile.agg(
        F.coalesce(F.sum("events"), F.lit(0)).alias("total_events"),
        F.count("case_id").alias("distinct_cases_in_events"),
    ).withColumn(
        "avg_events_per_case",
        F.round(F.try_divide("total_events", "distinct_cases_in_events"), 3),
    )


def status_coverage(profile: DataFrame) -> DataFrame:
    """Share of cases that reached each of six statuses."""
    return profile.agg(
        F.count("*").alias("cases_in_events"),
        *[
            F.round(100.0 * F.avg(f"has_{s.lower()}"), 3).alias(f"pct_cases_with_{s.lower()}")
            for s in COVERED_STATUSES
        ],
    )


def triage_before_intake(profile: DataFrame, time: str = "event_ts") -> DataFrame:
    """Share of cases triaged before intake, by the given time column of the events."""
    intake, triage = F.col(f"intake_{time}"), F.col(f"triage_{time}")
    return profile.filter(intake.isNotNull() & triage.isNotNull()).agg(
        F.count("*").alias("cases_with_both"),
        rate(triage < intake, 4).alias("pct_triage_before_intake"),
    )


def cancelled_and_resolved(profile: DataFrame) -> DataFrame:
    both = (F.col("has_cancelled") == 1) & (F.col("has_resolved") == 1)
    return profile.agg(rate(both, 4).alias("pct_cases_both_cancelled_and_resolved"))


def triage_before_intake_after_repair(milestones: DataFrame) -> DataFrame:
    known = milestones.filter("intake_ts IS NOT NULL AND triage_ts IS NOT NULL")
    return known.agg(
        rate(F.col("triage_ts") < F.col("intake_ts"), 4).alias("after_milestone_fix")
    )


def clean_event_columns() -> list[Column]:
    return [
        rate(F.col("is_event_ts_missing")).alias("pct_event_ts_missing"),
        rate(F.col("is_tz_inconsistent")).alias("pct_tz_inconsistent"),
        rate(F.col("is_ingestion_before_event_ts")).alias("pct_ingestion_before_event_ts"),
    ]


def clean_event_anomalies(cleaned: DataFrame) -> DataFrame:
    return cleaned.agg(*clean_event_columns())


def dedup_reconciliation(events: DataFrame, deduped: DataFrame) -> DataFrame:
    """Rows before and after deduplication, and those removed, one row."""
    sides = events.select(F.lit(1).alias("raw"), F.lit(0).alias("kept")).unionByName(
        deduped.select(F.lit(0).alias("raw"), F.lit(1).alias("kept"))
    )
    return sides.agg(
        F.sum("raw").alias("raw_events_log"), F.sum("kept").alias("staging_events_deduped")
    ).withColumn(
        "dedup_removed_rows", F.col("raw_events_log") - F.col("staging_events_deduped")
    )


def breach_rates(sla: DataFrame) -> DataFrame:
    return sla.filter("resolved_ts IS NOT NULL").agg(
        rate(F.col("sla_b_breached")).alias("sla_b_breach_pct"),
        rate(F.col("sla_a_breached_including_cw")).alias("sla_a_breach_pct_including_cw"),
        rate(F.col("sla_a_breached_paused_cw")).alias("sla_a_breach_pct_paused_cw"),
    )


def sla_triage_before_intake(sla: DataFrame) -> DataFrame:
    return sla.filter("triage_ts IS NOT NULL").agg(
        rate(F.col("is_triage_before_intake_for_sla"), 4).alias(
            "triage_before_intake_pct_for_sla"
        )
    )


def daily_breach_means(daily: DataFrame) -> DataFrame:
    """Mean of the daily breach rates, every day weighing the same."""

    def mean(column: str) -> Column:
        return mean_of_scaled(F.sum(scaled(F.col(column), 3)), F.count(column), 3)

    return daily.agg(
        mean("sla_b_breach_pct").alias("avg_sla_b_breach_pct_daily"),
        mean("sla_a_breach_pct_including_cw").alias("avg_sla_a_breach_pct_inc_cw_daily"),
        mean("sla_a_breach_pct_paused_cw").alias("avg_sla_a_breach_pct_pause_cw_daily"),
    )


def congestion_summary(congestion: DataFrame) -> DataFrame:
    """Mean and percentiles of the congestion index; calendar-sized input."""
    index = F.col("congestion_index")
    p50, p90, p95 = interpolated(index, REPORTED_QUANTILES)
    return congestion.filter("congestion_index IS NOT NULL").agg(
        mean_of_scaled(F.sum(scaled(index, 4)), F.count(index), 4).alias(
            "avg_congestion_index"
        ),
        p50.alias("cong_p50"),
        p90.alias("cong_p90"),
        p95.alias("cong_p95"),
    )
