"""Cleaning the event log."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waitline.settings import INCONSISTENT_ZONE

DEDUPED_COLUMNS = (
    "event_id",
    "case_id",
    "status",
    "event_ts",
    "ingestion_ts",
    "event_ts_canonical",
    "event_tz",
    "is_duplicate",
    "is_late_arriving",
    "intake_date",
)


def with_canonical_time(events: DataFrame) -> DataFrame:
    """Add the time to analyse by: when it happened, else when it was ingested."""
    return events.withColumn("event_ts_canonical", F.coalesce("event_ts", "ingestion_ts"))


def dedupe(events: DataFrame) -> DataFrame:
    """One row per case, status and canonical time.

    Kept is the row with a time of its own, then the earliest ingested, then the
    smallest id. Spark limits the groups before the shuffle (WindowGroupLimit), so
    copies of one event meet as one row per task however many there are, and the
    shuffle key holds the time, so that a busy case spreads over all tasks.
    """
    same_event = Window.partitionBy("case_id", "status", "event_ts_canonical").orderBy(
        F.col("event_ts").isNull(), "ingestion_ts", "event_id"
    )
    return (
        with_canonical_time(events)
        .withColumn("place", F.row_number().over(same_event))
        .filter("place = 1")
        .select(
            *[
                F.col(c).cast("boolean").alias(c) if c.startswith("is_") else F.col(c)
                for c in DEDUPED_COLUMNS
            ]
        )
    )


def clean(deduped: DataFrame) -> DataFrame:
    """Add flags for untrusted zones, missing times and ingestion before the event."""
    missing = F.col("event_ts").isNull()
    return deduped.select(
        "event_id",
        "case_id",
        "status",
        "event_ts",
        "ingestion_ts",
        "event_ts_canonical",
        "event_tz",
        F.col("event_tz").eqNullSafe(INCONSISTENT_ZONE).alias("is_tz_inconsistent"),
        "is_duplicate",
        "is_late_arriving",
        F.coalesce(~missing & (F.col("ingestion_ts") < F.col("event_ts")), F.lit(False)).alias(
            "is_ingestion_before_event_ts"
        ),
        missing.alias("is_event_ts_missing"),
        "intake_date",
    )
