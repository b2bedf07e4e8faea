"""Time per stage of a case."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waitline.functions.clock import minutes_between

# Stage, position it starts at, position it ends at.
STAGES = (
    ("intake_to_triage", "intake_at", "triage_at"),
    ("triage_to_assignment", "triage_at", "assignment_at"),
    ("assignment_to_investigation", "assignment_at", "investigation_at"),
    ("investigation_to_reviewqa", "investigation_at", "review_qa_at"),
    ("reviewqa_to_resolved", "review_qa_at", "resolved_first_at"),
)
TOTAL = ("intake_to_resolved", "intake_at", "resolved_first_at")


def stage_columns() -> dict[str, Column]:
    """Open minutes of every stage and of the whole way, from the positions."""
    return {
        f"mins_{name}": minutes_between(F.col(start), F.col(end))
        for name, start, end in (*STAGES, TOTAL)
    }


def case_stage_durations(facts: DataFrame, require_wait: bool = True) -> DataFrame:
    """Stage times of the cases that passed every stage.

    By default only cases that also waited for the customer, as the published
    stage figures do; ``require_wait=False`` takes all.
    """
    passed = facts.filter("has_all_stages")
    if require_wait:
        passed = passed.filter("has_wait")
    return passed.select(
        "case_id",
        "intake_date",
        "tier",
        "case_type",
        "team_tz",
        *[c.alias(name) for name, c in stage_columns().items()],
    )
