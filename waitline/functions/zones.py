"""Business time of teams in several zones, each with its own calendar and hours.

Times are the wall times of a case's team. Where a clock is set forward or back, the instants that
it skips or repeats are outside working hours; ``in_team_time`` converts by the rules of the zone.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waitline.functions.clock import BusinessClock, to_team_time
from waitline.settings import WorkingHours

ZONE = "team_tz"


@dataclass(frozen=True)
class ZonedClock:
    """A clock for each zone, used like one: positions are looked up by zone and date.

    Rows need the column ``team_tz``. Those of a zone without calendar have no positions.
    """

    clocks: Mapping[str, BusinessClock]
    keys = (ZONE,)

    @classmethod
    def from_calendars(
        cls,
        calendars: Mapping[str, DataFrame],
        hours: Mapping[str, WorkingHours],
        keep: Callable[[str, DataFrame], DataFrame] | None = None,
    ) -> ZonedClock:
        """One calendar and one set of hours per zone; ``keep`` may store the numbered days."""

        def kept(zone: str) -> Callable[[str, DataFrame], DataFrame] | None:
            return keep and (lambda name, df: keep(f"{name}_{zone.replace('/', '_')}", df))

        return cls(
            {
                zone: BusinessClock.from_calendar(calendar, hours[zone], kept(zone))
                for zone, calendar in calendars.items()
            }
        )

    @property
    def piece_minutes(self) -> int:
        return max(clock.piece_minutes for clock in self.clocks.values())

    def covers(self, ts: Column) -> Column:
        """Whether the time lies at or after the first open minute of its zone."""
        covered = F.lit(False)
        for zone, clock in self.clocks.items():
            covered = F.when(F.col(ZONE) == zone, clock.covers(ts)).otherwise(covered)
        return covered

    def with_positions(self, df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
        """Add the position of each timestamp column on the axis of its row's zone.

        Calendars of all zones are one broadcast lookup by zone and date, joined once per column.
        """
        days = reduce(
            DataFrame.unionByName,
            [
                clock.days.select(
                    F.lit(zone).alias("_zone"),
                    "cal_date",
                    (F.col("days_before") * clock.hours.minutes_per_day).alias("minutes_before"),
                    F.when(F.col("is_business"), clock.hours.minutes_per_day)
                    .otherwise(0)
                    .alias("minutes_open"),
                    F.lit(clock.hours.open_minute).alias("open_minute"),
                )
                for zone, clock in self.clocks.items()
            ],
        )
        kept = [F.col(f"`{name}`") for name in df.columns]
        positions = []
        for number, (ts, target) in enumerate(columns.items()):
            day = f"_day{number}"
            df = df.join(
                F.broadcast(days.alias(day)),
                F.expr(f"`{ZONE}` = {day}._zone AND CAST(`{ts}` AS DATE) = {day}.cal_date"),
                "left",
            )
            inside = F.expr(
                f"""{day}.minutes_before + least({day}.minutes_open, greatest(0,
                    hour(`{ts}`) * 60 + minute(`{ts}`) - {day}.open_minute
                    + IF(extract(SECOND FROM `{ts}`) > 0, 1, 0)))"""
            )
            outside = F.lit(None).cast("int")
            for zone, clock in self.clocks.items():
                after = F.lit(clock.last_day + dt.timedelta(days=1)).cast("timestamp_ntz")
                before = F.lit(clock.first_day).cast("timestamp_ntz")
                at = F.col(f"`{ts}`")
                total = clock.business_days * clock.hours.minutes_per_day
                there = F.when(at >= after, total).when(at < before, 0)
                outside = F.when(F.col(ZONE) == zone, there).otherwise(outside)
            positions.append(F.coalesce(inside, outside).cast("bigint").alias(target))
        return df.select(*kept, *positions)


def in_team_time(
    cases: DataFrame, events_log: DataFrame, source_zone: str = "UTC"
) -> tuple[DataFrame, DataFrame]:
    """Cases and events in the wall time of each case's ``team_tz``, from that of one zone.

    Events get the zone of their case; those without a case are left out. A case with very many
    events is spread by Spark, which may split the join. The day of the intake is the team's. Where
    Spark does not know the zone, the times are null; the rows stay.
    """
    dated = F.concat(F.lit("2000-01-01 00:00:00.000"), F.col(ZONE))
    named = (F.trim(ZONE) != "") & dated.try_cast("timestamp").isNotNull()
    known = F.when(named, F.col(ZONE))
    local = cases.withColumn("intake_ts", to_team_time(F.col("intake_ts"), known, source_zone))
    zones = cases.select("case_id", ZONE, known.alias("_known"))
    times = {
        c: to_team_time(F.col(c), F.col("_known"), source_zone)
        for c in ("event_ts", "ingestion_ts")
    }
    return (
        local.withColumn("intake_date", F.col("intake_ts").cast("date")),
        events_log.join(zones, "case_id").withColumns(times).drop("_known"),
    )
