"""The whole analysis as a chain of tables, each made when first asked for.

Stored are the wait minutes, the first times per case, the wide case table and the
calendar-sized tables. Everything else is a projection or an
aggregate of those.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T

from waitline import schemas
from waitline.functions.clock import BusinessClock
from waitline.operators import (
    drivers,
    events,
    facts,
    flow,
    marts,
    milestones,
    quality,
    scenarios,
    sla,
    stages,
)
from waitline.operators.ranking import with_tiles
from waitline.plans.store import Store
from waitline.settings import Settings
from waitline.sources import staffing, tables


#: The report tables and the columns that order their rows.
REPORT_ORDER = {
    "sla_daily": ["intake_date"],
    "sla_by_tier_case_type": ["tier", "case_type"],
    "staffing_daily": ["cal_date", "team_tz"],
    "backlog_daily_proxy": ["cal_date"],
    "congestion_daily": ["cal_date"],
    "driver_stage_durations": ["tier"],
    "driver_reopen_impact": ["tier", "case_type", "is_reopened"],
    "scenario_results": ["scenario_name"],
}

#: Staging tables and marts that the analysis leaves in the catalog.
PUBLISHED = (
    "events_deduped",
    "events_clean",
    "case_milestones",
    "business_minutes_dim",
    "case_sla_metrics",
    "case_stage_durations",
    "case_congestion_exposure",
    "reopen_penalty",
    "sla_daily",
    "sla_by_tier_case_type",
    "staffing_daily",
    "backlog_daily_proxy",
    "congestion_daily",
    "congestion_daily_v2",
    "driver_congestion_buckets",
    "driver_reopen_impact",
    "driver_stage_durations",
    "driver_summary",
    "scenario_results",
)


@dataclass(frozen=True)
class Inputs:
    """The four tables the analysis starts from."""

    cases: DataFrame
    events_log: DataFrame
    calendar: DataFrame
    staffing: DataFrame

    @classmethod
    def from_parquet(
        cls,
        spark: SparkSession,
        folder: str,
        team_tz: str | Column | None = None,
        event_tz: str | Column | None = None,
        case_id: str = "string",
        days: Sequence[dt.date] | None = None,
    ) -> Inputs:
        """The tables as Parquet below a folder, cases and events partitioned by intake date.

        For files that hold instants, ``team_tz`` is the zone of the working hours: one
        name for all, or the column of the cases that has it. ``event_tz`` is the same
        for events, and ``team_tz`` if it is not given. ``case_id`` is the type of the id.
        ``days`` are the intake days to read cases and events of, if not all.
        """
        kind = T.LongType() if case_id == "bigint" else T.StringType()
        paths = {
            "cases": (schemas.cases_schema(kind), team_tz),
            "events_log": (schemas.events_schema(kind), event_tz or team_tz),
            "calendar_dim": (schemas.CALENDAR, None),
            "staffing_schedule": (schemas.STAFFING, None),
        }
        return cls(
            *[
                tables.read_table(
                    spark, f"{folder}/{name}", schema, name, zone,
                    days if name in ("cases", "events_log") else None,
                )
                for name, (schema, zone) in paths.items()
            ]
        )


class Pipeline:
    def __init__(self, inputs: Inputs, store: Store, settings: Settings | None = None):
        self.inputs = inputs
        self.store = store
        self.settings = settings or Settings()

    # Events

    @cached_property
    def timed_events(self) -> DataFrame:
        return events.with_canonical_time(self.inputs.events_log)

    @cached_property
    def events_deduped(self) -> DataFrame:
        """The log without copies, stored: it is shuffled once for all that read it."""
        return self.store.keep("events_deduped", events.dedupe(self.inputs.events_log))

    @cached_property
    def events_clean(self) -> DataFrame:
        return events.clean(self.events_deduped)

    @cached_property
    def case_profile(self) -> DataFrame:
        """What the quality figures need to know per case, stored."""
        return self.store.keep("case_profile", quality.case_profile(self.timed_events))

    # Cases

    @cached_property
    def clock(self) -> BusinessClock:
        return BusinessClock.from_calendar(
            self.inputs.calendar, self.settings.hours, self.store.keep
        )

    @property
    def business_minutes_dim(self) -> DataFrame:
        return self.clock.minute_spine()

    @cached_property
    def repaired(self) -> DataFrame:
        firsts = milestones.first_times(self.inputs.cases, self.timed_events)
        timed = self.store.keep(
            f"timed_cases_{self.settings.sla_mode}",
            facts.timed_cases(firsts, self.wait_minutes, self.clock),
        )
        return milestones.repaired_times(timed, self.timed_events, self.store.keep)

    @cached_property
    def case_milestones(self) -> DataFrame:
        return milestones.case_milestones(self.repaired)

    @cached_property
    def wait_minutes(self) -> DataFrame:
        return self.store.keep(
            f"wait_minutes_{self.settings.sla_mode}",
            sla.wait_minutes(self.timed_events, self.clock, self.settings.sla_mode),
        )

    @cached_property
    def case_facts(self) -> DataFrame:
        """The wide case table, exposure included."""
        wide = facts.case_facts(self.repaired, self.clock)
        running = self.store.keep(
            "flow_running", flow.flow_running(self.congestion_daily_v2, self.clock)
        )
        return self.store.keep(
            f"case_facts_{self.settings.sla_mode}",
            flow.with_exposure(wide, running, self.clock, self.settings.exposure_days),
        )

    @cached_property
    def measured(self) -> DataFrame:
        """Rows of the wide table that belong to the SLA table, with their metrics."""
        rows = sla.in_sla_table(self.case_facts, self.settings.sla_mode)
        return rows.withColumns(
            {**sla.sla_columns(self.settings.targets), **stages.stage_columns()}
        )

    @cached_property
    def case_sla_metrics(self) -> DataFrame:
        return sla.case_sla_metrics(
            self.case_facts, self.settings.sla_mode, self.settings.targets
        )

    @cached_property
    def case_stage_durations(self) -> DataFrame:
        return stages.case_stage_durations(self.case_facts, self.settings.stages_require_wait)

    @cached_property
    def case_congestion_exposure(self) -> DataFrame:
        return flow.case_congestion_exposure(self.measured)

    # Marts

    @cached_property
    def sla_daily(self) -> DataFrame:
        return self.store.keep("sla_daily", marts.sla_daily(self.case_sla_metrics))

    @cached_property
    def sla_by_tier_case_type(self) -> DataFrame:
        return self.store.keep(
            "sla_by_tier_case_type", marts.sla_by_tier_case_type(self.case_sla_metrics)
        )

    @cached_property
    def staffing_daily(self) -> DataFrame:
        return self.store.keep("staffing_daily", staffing.staffing_daily(self.inputs.staffing))

    @cached_property
    def backlog_daily_proxy(self) -> DataFrame:
        return self.store.keep(
            "backlog_daily_proxy",
            flow.backlog_daily_proxy(
                self.inputs.cases, self.case_milestones, self.inputs.calendar
            ),
        )

    @cached_property
    def congestion_daily(self) -> DataFrame:
        return flow.congestion_daily(self.backlog_daily_proxy, self.staffing_daily)

    @cached_property
    def congestion_daily_v2(self) -> DataFrame:
        return flow.congestion_daily_v2(
            self.backlog_daily_proxy, self.staffing_daily, self.inputs.calendar
        )

    # Drivers

    @cached_property
    def case_deciles(self) -> DataFrame:
        """Measured cases with an exposure, and the decile it falls into."""
        exposed = self.measured.filter("avg_congestion_flow_index IS NOT NULL")
        return with_tiles(
            exposed,
            "avg_congestion_flow_index",
            "case_id",
            self.store.keep,
            self.settings.congestion_tiles,
            "congestion_decile",
            f"exposure_order_{self.settings.sla_mode}",
        )

    @cached_property
    def driver_congestion_buckets(self) -> DataFrame:
        return drivers.driver_congestion_buckets(self.case_deciles)

    @cached_property
    def driver_summary(self) -> DataFrame:
        return drivers.driver_summary(self.case_deciles)

    @cached_property
    def driver_reopen_impact(self) -> DataFrame:
        return self.store.keep(
            "driver_reopen_impact", drivers.driver_reopen_impact(self.measured)
        )

    @cached_property
    def driver_stage_durations(self) -> DataFrame:
        return self.store.keep(
            "driver_stage_durations", drivers.driver_stage_durations(self.case_stage_durations)
        )

    @cached_property
    def bottleneck_stage(self) -> DataFrame:
        return drivers.bottleneck_stage(self.driver_stage_durations)

    # Scenarios

    @cached_property
    def reopen_penalty(self) -> DataFrame:
        reopened = self.measured.filter("reopened_first_ts IS NOT NULL")
        return self.store.keep(
            "reopen_penalty", scenarios.reopen_penalty(reopened, self.case_stage_durations)
        )

    @cached_property
    def scenario_results(self) -> DataFrame:
        with_stages = self.measured.filter("has_all_stages")
        if self.settings.stages_require_wait:
            with_stages = with_stages.filter("has_wait")
        return scenarios.scenario_results(
            with_stages, self.reopen_penalty, self.settings.scenarios, self.settings.targets
        )

    def export(self, folder: str) -> list[str]:
        """The report tables as CSV below a folder, sorted by their grain; their names."""
        reports = {name: getattr(self, name) for name in REPORT_ORDER}
        tables.export_csv(reports, folder, REPORT_ORDER)
        return list(REPORT_ORDER)

    def publish(self, prefix: str = "", folder: str | None = None) -> list[str]:
        """Save every table of the analysis in the catalog, replacing it; the tables' names.

        ``folder`` keeps their files there, one folder per table. The log without copies is saved
        alone if it is not stored yet, and the clean log made of what was saved, so that it is
        written once.
        """
        names, saved = [], {}
        for table in PUBLISHED:
            name = f"{prefix}{table}"
            saved[table] = tables.save_table(
                self._to_publish(table, saved), name, folder and f"{folder}/{name}"
            )
            names.append(name)
        return names

    def _to_publish(self, table: str, saved: dict[str, DataFrame]) -> DataFrame:
        if "events_deduped" not in self.__dict__:
            if table == "events_deduped":
                return events.dedupe(self.inputs.events_log)
            if table == "events_clean":
                return events.clean(saved["events_deduped"])
        return getattr(self, table)
