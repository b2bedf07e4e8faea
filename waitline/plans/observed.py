"""Quality figures that are observed while the log is loaded and cleaned, without reading it again.

The figures are taken where the rows are written, behind the last shuffle: there Spark counts the
result of a task once, also when tasks run again because an executor was lost.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from waitline.operators import events, quality
from waitline.sources import tables

ROWS = "row_count"


def write_observed(df: DataFrame, path: str, figures: list[Column]) -> dict[str, Any]:
    """Write a table as Parquet and return aggregates of its rows, and their number."""
    observation = Observation()
    observed = df.observe(observation, F.count(F.lit(1)).alias(ROWS), *figures)
    with tables.small_splits(df.sparkSession):
        observed.write.options(**tables.COMPACT).parquet(path)
    return observation.get


@dataclass(frozen=True)
class StagedLog:
    """The raw and the clean log as written, and what was seen of them meanwhile."""

    events_log: DataFrame
    events_clean: DataFrame
    raw_figures: dict[str, Any]
    clean_figures: dict[str, Any]

    def _row(self, **values: Any) -> DataFrame:
        types = {int: "bigint", float: "double", type(None): "double"}
        schema = ", ".join(f"{name} {types[type(v)]}" for name, v in values.items())
        return self._spark.createDataFrame([tuple(values.values())], schema)

    @property
    def _spark(self) -> SparkSession:
        return self.events_log.sparkSession

    def event_integrity(self) -> DataFrame:
        names = [n for n in self.raw_figures if n not in (ROWS, "pct_ingestion_before_event_ts")]
        return self._row(**{name: self.raw_figures[name] for name in names})

    def ingestion_before_event(self) -> DataFrame:
        name = "pct_ingestion_before_event_ts"
        return self._row(**{name: self.raw_figures[name]})

    def clean_event_anomalies(self) -> DataFrame:
        return self._row(**{n: v for n, v in self.clean_figures.items() if n != ROWS})

    def dedup_reconciliation(self) -> DataFrame:
        raw, kept = self.raw_figures[ROWS], self.clean_figures[ROWS]
        return self._row(
            raw_events_log=raw, staging_events_deduped=kept, dedup_removed_rows=raw - kept
        )


def stage_log(log: DataFrame, folder: str) -> StagedLog:
    """Write a log and its clean form below a folder; the figures come with the two writes."""
    spark, schema = log.sparkSession, log.schema
    raw = write_observed(log, f"{folder}/events_log", quality.event_rate_columns())
    stored = spark.read.schema(schema).parquet(f"{folder}/events_log")
    cleaned = events.clean(events.dedupe(stored))
    clean = write_observed(cleaned, f"{folder}/events_clean", quality.clean_event_columns())
    return StagedLog(
        stored, spark.read.schema(cleaned.schema).parquet(f"{folder}/events_clean"), raw, clean
    )
