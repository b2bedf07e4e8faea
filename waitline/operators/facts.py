"""One wide row per case, from which every case table and mart is a projection.

Joins on the case number happen before, while first times and wait minutes are
brought to the cases. This table is made without a shuffle, and later steps that
combine SLA metrics, stages, reopening and exposure of a case read its columns and
join nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waitline.functions.clock import BusinessClock
from waitline.operators.milestones import CASE_COLUMNS

# Time of a case and the column of its position.
UNREPAIRED = {
    "intake_ts": "intake_at",
    "assignment_ts": "assignment_at",
    "investigation_ts": "investigation_at",
    "review_qa_ts": "review_qa_at",
}
REPAIRED = {
    "triage_ts": "triage_at",
    "resolved_ts": "resolved_at",
    "resolved_first_ts": "resolved_first_at",
}


def timed_cases(firsts: DataFrame, waits: DataFrame, clock: BusinessClock) -> DataFrame:
    """``first_times`` with wait minutes and the positions of times that no repair changes.

    The rows are still partitioned by case here, so only the waits are shuffled.
    Placing some of the times now leaves each of the two steps with generated
    code small enough for the JVM to compile.
    """
    return clock.with_positions(firsts.join(waits, "case_id", "left"), UNREPAIRED)


def case_facts(repaired: DataFrame, clock: BusinessClock) -> DataFrame:
    """Times, positions and wait minutes per case.

    ``repaired`` comes from ``timed_cases`` by ``repaired_times``.
    ``is_measured`` marks the rows of the SLA table, ``has_all_stages`` and
    ``has_wait`` those of the stage table.
    """

    def all_covered(*columns: str) -> Column:
        # The earliest of them decides, if none is missing.
        known = F.lit(True)
        for column in columns:
            known = known & F.col(column).isNotNull()
        earliest = F.least(*columns) if len(columns) > 1 else F.col(columns[0])
        return known & clock.covers(earliest)

    times = repaired.select(
        *CASE_COLUMNS,
        F.col("triage_fixed").alias("triage_ts"),
        F.col("resolved_fixed").alias("resolved_ts"),
        F.col("resolved_any").alias("resolved_first_ts"),
        "assignment_ts",
        "investigation_ts",
        "review_qa_ts",
        "cancelled_ts",
        "reopened_first_ts",
        *UNREPAIRED.values(),
        "customer_wait_business_minutes",
        all_covered("customer_wait_first_ts").alias("has_wait"),
    )
    stage_times = [*UNREPAIRED, "triage_ts", "resolved_first_ts"]
    return clock.with_positions(times, REPAIRED).select(
        *CASE_COLUMNS,
        "triage_ts",
        "resolved_ts",
        "cancelled_ts",
        "reopened_first_ts",
        *UNREPAIRED.values(),
        *REPAIRED.values(),
        "customer_wait_business_minutes",
        all_covered("intake_ts", "triage_ts", "resolved_ts").alias("is_measured"),
        all_covered(*stage_times).alias("has_all_stages"),
        "has_wait",
    )
