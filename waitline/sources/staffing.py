"""Staffing schedule: planned and effective agents per day and shift."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waitline import schemas
from waitline.settings import Staffing


def staffing_schedule(
    calendar: DataFrame, plan: Staffing | None = None, team_tz: str = "UTC"
) -> DataFrame:
    """Shifts of every calendar day.

    Coverage goes in a straight line from 1 to ``deterioration_floor`` over the last
    ``deterioration_days`` days of the calendar; 0 days leave it at 1. Agents are
    rounded half to even.
    """
    plan = plan or Staffing()
    names = ("shift_name", "shift_start_hour", "shift_end_hour", "share")
    shifts = F.array(
        *[
            F.struct(*[F.lit(value).alias(name) for name, value in zip(names, shift, strict=True)])
            for shift in plan.shifts
        ]
    )
    span, floor = float(plan.deterioration_days), plan.deterioration_floor
    last_day = calendar.agg(F.max("cal_date")).scalar()
    if span:
        still = F.least(F.lit(1.0), F.datediff(last_day, "cal_date") / F.lit(span))
        coverage = 1.0 - (1.0 - still) * (1.0 - floor)
    else:
        coverage = F.lit(1.0)
    of_weekday = F.array(*[F.lit(n) for n in plan.planned_agents])
    days = calendar.select(
        F.col("cal_date").alias("shift_date"),
        F.get(of_weekday, F.weekday("cal_date")).alias("agents"),
        coverage.alias("deterioration_multiplier"),
        F.inline(shifts),
    )
    present = F.col("planned_agents") * (1.0 - plan.shrinkage_rate)
    return (
        days.withColumns(
            {
                "team_tz": F.lit(team_tz),
                "shrinkage_rate": F.lit(plan.shrinkage_rate),
                "planned_agents": F.bround(F.col("agents") * F.col("share")).cast("int"),
            }
        )
        .withColumn(
            "effective_agents",
            F.bround(present * F.col("deterioration_multiplier")).cast("int"),
        )
        .select(*schemas.STAFFING.fieldNames())
    )


def staffing_daily(staffing: DataFrame) -> DataFrame:
    """Agents per day and zone, planned and effective."""
    return staffing.groupBy(F.col("shift_date").alias("cal_date"), "team_tz").agg(
        F.sum("planned_agents").alias("planned_agents_total"),
        F.sum("effective_agents").alias("effective_agents_total"),
        F.round(F.avg("shrinkage_rate"), 4).alias("avg_shrinkage_rate"),
        F.round(F.avg("deterioration_multiplier"), 4).alias("avg_deterioration_multiplier"),
    )


def staffing_gaps(schedule: DataFrame) -> DataFrame:
    """Times without any shift: from the last end of a day to the first start of the next one."""
    hours = schedule.groupBy("team_tz", "shift_date").agg(
        F.min("shift_start_hour").alias("opens"), F.max("shift_end_hour").alias("closes")
    )
    by_day = Window.partitionBy("team_tz").orderBy("shift_date")

    def at(hour: str) -> Column:
        return F.col("shift_date").cast("timestamp_ntz") + F.make_dt_interval(hours=F.col(hour))

    return (
        hours.select("team_tz", "shift_date", at("opens").alias("opens"), at("closes").alias("closes"))
        .select(
            "team_tz", F.col("closes").alias("gap_start"),
            F.lead("opens").over(by_day).alias("gap_end"),
        )
        .filter("gap_end > gap_start")
    )
