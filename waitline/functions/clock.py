"""Business time: position of a timestamp on the axis of open minutes.

The position of ``ts`` is the number of the first open minute at or after it.
With ``before(d)`` the business days strictly before the date ``d`` of ``ts``

    position(ts) = minutes_per_day * before(d)
                 + (d is a business day ? minutes since opening, rounded up,
                                          held between 0 and minutes_per_day : 0)

which needs one equi-join with the calendar on the date, and no minute table.
The joined side has one row per calendar day, so it is broadcast.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waitline.settings import WorkingHours


@dataclass(frozen=True)
class BusinessClock:
    """Business days of a calendar with running numbers, plus its outer bounds."""

    days: DataFrame  # cal_date, is_business, days_before; one row per day, no gaps
    first_day: dt.date
    last_day: dt.date
    business_days: int
    first_business_day: dt.date | None
    hours: WorkingHours
    keys = ()  # columns besides the times that positions depend on

    @property
    def piece_minutes(self) -> int:
        """Positions in a business day."""
        return self.hours.minutes_per_day

    @classmethod
    def from_calendar(
        cls,
        calendar: DataFrame,
        hours: WorkingHours | None = None,
        keep: Callable[[str, DataFrame], DataFrame] | None = None,
    ) -> BusinessClock:
        """Reads one row of bounds from the calendar; ``keep`` may store the numbered days."""
        open_day = ~F.col("is_weekend") & ~F.col("is_holiday")
        bounds = calendar.agg(
            F.min("cal_date").alias("first_day"),
            F.max("cal_date").alias("last_day"),
            F.count_if(open_day).alias("business_days"),
            F.min(F.when(open_day, F.col("cal_date"))).alias("first_business_day"),
        ).first()
        if bounds.first_day is None:
            raise ValueError("the calendar has no days")
        span = (bounds.last_day - bounds.first_day).days + 1
        every_day = calendar.sparkSession.range(span).select(
            F.date_add(F.lit(bounds.first_day), F.col("id").cast("int")).alias("cal_date")
        )
        opened = calendar.filter(open_day).select("cal_date", F.lit(True).alias("opened"))
        earlier = Window.orderBy("cal_date").rowsBetween(Window.unboundedPreceding, -1)
        days = (
            every_day.join(F.broadcast(opened), "cal_date", "left")
            .select("cal_date", F.coalesce("opened", F.lit(False)).alias("is_business"))
            .withColumn(
                "days_before",
                F.coalesce(F.count_if(F.col("is_business")).over(earlier), F.lit(0)).cast("int"),
            )
        )
        if keep is not None:
            days = keep("business_days", days)
        return cls(
            days=days,
            first_day=bounds.first_day,
            last_day=bounds.last_day,
            business_days=bounds.business_days,
            first_business_day=bounds.first_business_day,
            hours=hours or WorkingHours(),
        )

    def covers(self, ts: Column) -> Column:
        """Whether the time lies at or after the first open minute; NULL times do not."""
        if self.first_business_day is None:
            return F.lit(False)
        opening = dt.datetime.combine(self.first_business_day, dt.time(self.hours.start_hour))
        return F.coalesce(
            ts >= F.lit(opening.isoformat(sep=" ")).cast("timestamp_ntz"), F.lit(False)
        )

    def with_positions(self, df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
        """Add the position of each timestamp column under the given name; NULL stays NULL.

        Times before the calendar have position 0, times after it the number of
        all open minutes. One broadcast join per column and a single projection:
        the joined row already holds the open minutes before its day and within
        it, which keeps the generated code of many columns small enough to compile.
        """
        per_day = self.hours.minutes_per_day
        days = self.days.select(
            "cal_date",
            (F.col("days_before") * per_day).alias("minutes_before"),
            F.when(F.col("is_business"), per_day).otherwise(0).alias("minutes_open"),
        )
        after = self.last_day + dt.timedelta(days=1)
        total = self.business_days * per_day
        kept = [F.col(f"`{name}`") for name in df.columns]
        positions = []
        for number, (ts, target) in enumerate(columns.items()):
            day = f"_day{number}"
            df = df.join(
                F.broadcast(days.alias(day)),
                F.expr(f"CAST(`{ts}` AS DATE) = {day}.cal_date"),
                "left",
            )
            positions.append(
                F.expr(f"""CAST(coalesce(
                    {day}.minutes_before + least({day}.minutes_open, greatest(0,
                        hour(`{ts}`) * 60 + minute(`{ts}`) - {self.hours.open_minute}
                        + IF(extract(SECOND FROM `{ts}`) > 0, 1, 0))),
                    CASE WHEN `{ts}` >= TIMESTAMP_NTZ'{after} 00:00:00' THEN {total}
                         WHEN `{ts}` < TIMESTAMP_NTZ'{self.first_day} 00:00:00' THEN 0 END
                    ) AS BIGINT)""").alias(target)
            )
        return df.select(*kept, *positions)

    def minute_spine(self) -> DataFrame:
        """Every open minute with its number; a small dimension for reports and checks."""
        per_day = self.hours.minutes_per_day
        return (
            self.days.filter("is_business")
            .select(
                "cal_date",
                "days_before",
                F.explode(F.sequence(F.lit(0), F.lit(per_day - 1))).alias("offset"),
            )
            .select(
                (
                    F.col("cal_date").cast("timestamp_ntz")
                    + F.make_dt_interval(
                        mins=F.lit(self.hours.open_minute) + F.col("offset")
                    )
                ).alias("minute_ts"),
                "cal_date",
                (F.col("days_before").cast("bigint") * per_day + F.col("offset")).alias(
                    "minute_idx"
                ),
            )
        )


def micros_since_1970(ts: Column) -> Column:
    """Microseconds of a wall time since the start of 1970, whatever the zone of the session."""
    seconds = F.unix_date(ts.cast("date")).cast("bigint") * 86_400
    seconds = seconds + F.hour(ts) * 3_600 + F.minute(ts) * 60
    return seconds * 1_000_000 + (F.extract(F.lit("SECOND"), ts) * 1_000_000).cast("bigint")


def minutes_between(start: Column, end: Column) -> Column:
    """Open minutes from one position to another, never negative, NULL if either is."""
    return F.when(
        start.isNotNull() & end.isNotNull(), F.greatest(F.lit(0).cast("bigint"), end - start)
    )


def to_team_time(ts: Column, zone: Column, source_zone: str = "UTC") -> Column:
    """Wall time in the team's zone, without zone, from wall time in ``source_zone``."""
    return F.convert_timezone(F.lit(source_zone), zone, ts)
