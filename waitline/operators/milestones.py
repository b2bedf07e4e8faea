"""First times per case, and their repair against the intake time.

All of it works on minima, which copies of an event do not change. So the raw
log with canonical times gives the same result as the deduplicated one, and the
deduplication's shuffle is not needed here.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CASE_COLUMNS = ("case_id", "intake_ts", "case_type", "tier", "team_tz", "intake_date")

# Status and the column of its first time.
FIRST_TIMES = (
    ("ASSIGNMENT", "assignment_ts"),
    ("INVESTIGATION", "investigation_ts"),
    ("CUSTOMER_WAIT", "customer_wait_first_ts"),
    ("REVIEW_QA", "review_qa_ts"),
    ("CANCELLED", "cancelled_ts"),
    ("REOPENED", "reopened_first_ts"),
    ("ESCALATED", "escalated_first_ts"),
)

# Statuses whose first time is repaired: the first at or after intake, if any.
REPAIRED = (("TRIAGE", "triage"), ("RESOLVED", "resolved"))


def first_times(cases: DataFrame, events: DataFrame) -> DataFrame:
    """Cases with the first time of every status.

    Events are reduced to one row per case on the map side before they are
    shuffled, and only then joined, so a case with very many events costs each
    task one row. Of repaired statuses the last time and the number of events are
    kept as well; they settle nearly every repair without a second look.
    """
    ts = F.col("event_ts_canonical")

    def at(status: str) -> Column:
        return F.when(F.col("status") == status, ts)

    measures = [F.min(at(status)).alias(name) for status, name in FIRST_TIMES]
    for status, name in REPAIRED:
        measures += [
            F.min(at(status)).alias(f"{name}_any"),
            F.max(at(status)).alias(f"{name}_last"),
            F.count(at(status)).alias(f"{name}_events"),
        ]
    per_case = events.groupBy("case_id").agg(*measures)
    return cases.select(*CASE_COLUMNS).join(per_case, "case_id", "left")


def _straddles(name: str) -> Column:
    """Three or more events around the intake: the first one after it is not known yet."""
    return F.coalesce(
        (F.col(f"{name}_any") < F.col("intake_ts"))
        & (F.col(f"{name}_last") >= F.col("intake_ts"))
        & (F.col(f"{name}_events") > 2),
        F.lit(False),
    )


def _known_after_intake(name: str) -> Column:
    first, last = F.col(f"{name}_any"), F.col(f"{name}_last")
    return F.when(first >= F.col("intake_ts"), first).when(
        (last >= F.col("intake_ts")) & (F.col(f"{name}_events") == 2), last
    )


def _look_up(pending: DataFrame, events: DataFrame) -> DataFrame:
    """First repaired time at or after intake for the pending cases, from the events.

    The join carries no hint: Spark broadcasts the pending cases if they measure small,
    and else splits the partitions of busy cases. The minima combine before the shuffle.
    """
    statuses = [status for status, _ in REPAIRED]
    marks = events.filter(F.col("status").isin(statuses)).select(
        "case_id", "status", "event_ts_canonical"
    )
    return (
        marks.join(pending, "case_id")
        .filter(F.col("event_ts_canonical") >= F.col("intake_ts"))
        .groupBy("case_id")
        .agg(
            *[
                F.min(F.when(F.col("status") == status, F.col("event_ts_canonical"))).alias(
                    f"{name}_found"
                )
                for status, name in REPAIRED
            ]
        )
    )


def repaired_times(
    firsts: DataFrame,
    events: DataFrame,
    keep: Callable[[str, DataFrame], DataFrame] = lambda _, df: df,
) -> DataFrame:
    """``first_times`` plus ``triage_fixed`` and ``resolved_fixed``.

    Most repairs follow from the first and last time; the pending cases, with three or
    more events around the intake, are looked up in the events. ``keep`` may store
    these few, so that Spark knows their size when it plans the joins.
    """
    straddling = firsts.filter(_straddles("triage") | _straddles("resolved"))
    pending = keep("repair_pending", straddling.select("case_id", "intake_ts"))
    found = keep("repair_found", _look_up(pending, events))
    fixed = firsts.join(found, "case_id", "left")
    for _, name in REPAIRED:
        after = _known_after_intake(name)
        after = F.when(_straddles(name), F.col(f"{name}_found")).otherwise(after)
        fixed = fixed.withColumn(f"{name}_fixed", F.coalesce(after, F.col(f"{name}_any")))
    extra = [f"{name}_{part}" for _, name in REPAIRED for part in ("last", "events", "found")]
    return fixed.drop(*extra)


def case_milestones(repaired: DataFrame) -> DataFrame:
    """Milestones per case with quality flags; triage is repaired, resolution is not."""
    columns: Sequence[Column | str] = [
        *CASE_COLUMNS,
        F.col("triage_fixed").alias("triage_ts"),
        "assignment_ts",
        "investigation_ts",
        "customer_wait_first_ts",
        "review_qa_ts",
        F.col("resolved_any").alias("resolved_ts"),
        "cancelled_ts",
        "reopened_first_ts",
        "escalated_first_ts",
        F.col("triage_any").isNull().alias("is_triage_missing"),
        (F.col("resolved_any").isNull() & F.col("cancelled_ts").isNull()).alias(
            "is_terminal_missing"
        ),
        F.coalesce(F.col("triage_fixed") < F.col("intake_ts"), F.lit(False)).alias(
            "is_triage_before_intake_after_fix"
        ),
    ]
    return repaired.select(*columns)


def sla_inputs(repaired: DataFrame) -> DataFrame:
    """The times the service targets are measured between, triage and resolution repaired."""
    return repaired.select(
        "case_id",
        "intake_ts",
        F.col("triage_fixed").alias("triage_ts_final"),
        F.col("resolved_fixed").alias("resolved_ts_final"),
        "cancelled_ts",
        "case_type",
        "tier",
        "team_tz",
        "intake_date",
    )
