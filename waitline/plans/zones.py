"""SLA metrics of teams in several zones."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from waitline.functions.zones import ZonedClock
from waitline.operators import events, facts, milestones, sla
from waitline.plans.store import Store
from waitline.settings import Settings, WorkingHours


def zoned_sla_metrics(
    cases: DataFrame,
    events_log: DataFrame,
    calendars: Mapping[str, DataFrame],
    hours: Mapping[str, WorkingHours],
    store: Store,
    settings: Settings | None = None,
) -> DataFrame:
    """``case_sla_metrics`` with the calendar and the hours of each case's ``team_tz``.

    Times are the team's wall times and events have the column ``team_tz`` too, as
    ``in_team_time`` gives them. ``settings`` says what else holds for all zones.
    """
    settings = settings or Settings()
    clock = ZonedClock.from_calendars(calendars, hours, store.keep)
    timed = events.with_canonical_time(events_log)
    firsts = milestones.first_times(cases, timed)
    waits = sla.wait_minutes(timed, clock, settings.sla_mode)
    placed = store.keep("zoned_cases", facts.timed_cases(firsts, waits, clock))
    repaired = milestones.repaired_times(
        placed, timed, lambda name, df: store.keep(f"zoned_{name}", df)
    )
    wide = facts.case_facts(repaired, clock)
    return sla.case_sla_metrics(wide, settings.sla_mode, settings.targets)
