"""Marts that follow the days that were written, without a run over the whole log.

The raw tables are partitioned by the day of a case's intake, its events with it, so a day that
is written again holds all there is to know about its cases. A refresh reads those days alone. It
makes the rows of their cases, takes back the rows that the cases had before, and what does not
cancel out are signed changes: of rows, of value counts and of daily counts. Marts add the changes
of all refreshes up, which is as much work as there are distinct minutes, whatever the log holds.

Each refresh writes one version of every table and then a commit, which alone makes it count. So
a refresh that was cut short leaves nothing, and one that is run again changes nothing. One
refresh of a folder may run at a time.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waitline.operators import facts, flow, marts, sla
from waitline.plans.pipeline import Inputs, Pipeline
from waitline.plans.store import Store
from waitline.settings import Settings
from waitline.sources import tables

COUNT_KEYS = (*marts.DAY_KEYS, *marts.SEGMENT_KEYS)
MEASURES = [column for pair in marts.DURATIONS.values() for column in pair]
ROW = [
    "case_id", "tier", "case_type", "intake_date", "is_triage_missing_for_sla",
    "is_terminal_missing_for_sla", *MEASURES, "in_sla_table", "terminal_date",
]

COMMIT = "version int, is_whole boolean, seen_until timestamp, days array<date>"


class Refresh:
    """The marts ``sla_daily``, ``sla_by_tier_case_type`` and ``backlog_daily_proxy`` of a folder.

    ``raw`` has the four input tables as ``Inputs.from_parquet`` reads them; ``state`` is a
    folder that this class writes. Zones, settings and the calendar must stay the same.
    """

    def __init__(
        self,
        spark: SparkSession,
        raw: str,
        state: str,
        settings: Settings | None = None,
        case_id: str = "string",
    ):
        self.spark, self.raw, self.state = spark, raw.rstrip("/"), state.rstrip("/")
        self.settings, self.case_id = settings or Settings(), case_id

    # What has been written, and what is known of it.

    def commits(self) -> list:
        """The refreshes that count, oldest first."""
        path = f"{self.state}/commits"
        if not tables.exists(self.spark, path):
            return []
        rows = self.spark.read.schema(COMMIT).parquet(path).orderBy("version").collect()
        whole = max((n for n, row in enumerate(rows) if row["is_whole"]), default=0)
        return rows[whole:]

    def written_days(self) -> tuple[list[dt.date], dt.datetime | None]:
        """Days with files that no refresh has seen, or that are gone; and the latest file time.

        Only the names, days and times of the files are read.
        """
        commits = self.commits()
        known = {day for row in commits for day in row["days"]}
        since = commits[-1]["seen_until"] if commits else None
        files = [
            self.spark.read.format("binaryFile")
            .option("pathGlobFilter", "*.parquet")
            .load(f"{self.raw}/{table}")
            .select(
                F.regexp_extract("path", "/intake_date=([^/]+)/", 1).cast("date").alias("day"),
                "modificationTime",
            )
            for table in ("cases", "events_log")
        ]
        per_day = (
            files[0]
            .unionByName(files[1])
            .groupBy("day")
            .agg(F.max("modificationTime").alias("written"))
            .collect()
        )
        new = {r["day"] for r in per_day if since is None or r["written"] >= since}
        gone = known - {r["day"] for r in per_day}
        return sorted(new | gone), max((r["written"] for r in per_day), default=since)

    def _table(self, name: str) -> DataFrame:
        """All changes that count, of one table."""
        versions = [row["version"] for row in self.commits()]
        df = self.spark.read.option("basePath", f"{self.state}/{name}").parquet(
            *[f"{self.state}/{name}/version={version}" for version in versions]
        )
        return df.drop("version")

    def rows(self, days: Sequence[dt.date] | None = None) -> DataFrame:
        """One row per case as of now, of some intake days or all."""
        changes = self._table("rows")
        if days is not None:
            months = sorted({day.year * 100 + day.month for day in days})
            changes = changes.filter(F.col("month").isin(months)).filter(
                F.col("intake_date").isin(list(days))
            )
        return (
            changes.groupBy(*ROW)
            .agg(F.sum("change").alias("change"))
            .filter("change <> 0")
            .withColumn("change", F.col("change").cast("int"))
        )

    # A refresh.

    def refresh(self, days: Sequence[dt.date] | None = None) -> int | None:
        """Bring the marts up to the days given, or to all that were written; the new version."""
        commits = self.commits()
        if days is None or not commits:  # the first one holds everything
            days, seen_until = self.written_days()
        else:
            days, seen_until = sorted(set(days)), commits[-1]["seen_until"]
        if not days:
            return None
        store = Store(self.spark)
        changes = self._made_anew(days if commits else None, store).withColumn("change", F.lit(1))
        if commits:
            before = self.rows(days).withColumn("change", -F.col("change"))
            changes = (
                changes.unionByName(before)
                .groupBy(*ROW)
                .agg(F.sum("change").cast("int").alias("change"))
                .filter("change <> 0")
            )
        version = commits[-1]["version"] + 1 if commits else 1
        self._write(store.keep("changes", changes), version)
        store.clear()
        self._commit(version, not commits, seen_until, days)
        return version

    def compact(self) -> int | None:
        """Write the state as one version, on which later ones build; older ones are not read."""
        commits = self.commits()
        if not commits:
            return None
        version = commits[-1]["version"] + 1
        store = Store(self.spark)
        self._write(store.keep("rows", self.rows()), version)
        store.clear()
        days = sorted({day for row in commits for day in row["days"]})
        self._commit(version, True, commits[-1]["seen_until"], days)
        return version

    def _made_anew(self, days: Sequence[dt.date] | None, store: Store) -> DataFrame:
        """The rows of the cases of some days or all, from what is written of those days."""
        inputs = Inputs.from_parquet(self.spark, self.raw, case_id=self.case_id, days=days)
        pipeline = Pipeline(inputs, store, self.settings)
        wide = facts.case_facts(pipeline.repaired, pipeline.clock).withColumns(
            sla.sla_columns(self.settings.targets)
        )
        every_case = F.lit(self.settings.sla_mode == "left")
        ends = pipeline.repaired.select(
            F.col("case_id").alias("of"),
            F.coalesce("resolved_any", "cancelled_ts").cast("date").alias("terminal_date"),
        )
        return (
            wide.withColumn("in_sla_table", F.col("is_measured") | every_case)
            .join(ends, F.col("case_id") == F.col("of"))
            .select(*ROW)
        )

    def _write(self, changes: DataFrame, version: int) -> None:
        """The tables of one version, from signed rows."""

        def write(df: DataFrame, name: str, *by: str) -> None:
            writer = df.hint("rebalance", *by).write.mode("overwrite").partitionBy(*by)
            with tables.small_splits(self.spark):
                writer.parquet(f"{self.state}/{name}/version={version}")

        month = (F.year("intake_date") * 100 + F.month("intake_date")).alias("month")
        write(changes.select("*", month), "rows", "month")
        counts = marts.duration_counts(changes.filter("in_sla_table"), COUNT_KEYS, "change")
        write(counts.filter("n <> 0"), "counts")
        taken = changes.select(
            F.col("intake_date").alias("cal_date"), F.col("change").alias("intake_cases"),
            F.lit(0).alias("terminal_cases"),
        )
        closed = changes.filter("terminal_date IS NOT NULL").select(
            F.col("terminal_date").alias("cal_date"), F.lit(0).alias("intake_cases"),
            F.col("change").alias("terminal_cases"),
        )
        daily = taken.unionByName(closed).groupBy("cal_date")
        write(daily.agg(*[F.sum(c).alias(c) for c in ("intake_cases", "terminal_cases")]), "daily")

    def _commit(
        self, version: int, is_whole: bool, seen_until: dt.datetime | None, days: Sequence[dt.date]
    ) -> None:
        row = self.spark.createDataFrame([(version, is_whole, seen_until, list(days))], COMMIT)
        row.coalesce(1).write.mode("append").parquet(f"{self.state}/commits")

    # The marts.

    def counts(self) -> DataFrame:
        """Value counts by day and segment, from which every summary of durations follows."""
        return marts.merged_counts(self._table("counts"), COUNT_KEYS)

    @property
    def sla_daily(self) -> DataFrame:
        return marts.sla_daily_of(marts.merged_counts(self._table("counts"), marts.DAY_KEYS))

    @property
    def sla_by_tier_case_type(self) -> DataFrame:
        counts = marts.merged_counts(self._table("counts"), marts.SEGMENT_KEYS)
        return marts.sla_by_tier_case_type_of(counts)

    @property
    def backlog_daily_proxy(self) -> DataFrame:
        daily = self._table("daily").groupBy("cal_date")
        calendar = Inputs.from_parquet(self.spark, self.raw, case_id=self.case_id, days=[]).calendar

        def of(column: str) -> DataFrame:
            total = F.sum(column).alias(column)
            return daily.agg(total).filter(F.col(column) != 0)

        return flow.backlog_of(of("intake_cases"), of("terminal_cases"), calendar)
