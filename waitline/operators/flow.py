"""Backlog, staffing load and each case's exposure to it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waitline.functions.clock import BusinessClock
from waitline.functions.numbers import mean_of_scaled, ratio, scaled

FLOW_DIGITS = 4


def backlog_daily_proxy(
    cases: DataFrame, milestones: DataFrame, calendar: DataFrame
) -> DataFrame:
    """Cases taken in and closed per calendar day, with running totals.

    Both counts have one row per date before they are joined, so the calendar
    join and the running sum over it are as small as the calendar.
    """
    taken = cases.groupBy(F.col("intake_date").alias("cal_date")).agg(
        F.count("*").alias("intake_cases")
    )
    closed = (
        milestones.filter("resolved_ts IS NOT NULL OR cancelled_ts IS NOT NULL")
        .groupBy(F.coalesce("resolved_ts", "cancelled_ts").cast("date").alias("cal_date"))
        .agg(F.count("*").alias("terminal_cases"))
    )
    return backlog_of(taken, closed, calendar)


def backlog_of(taken: DataFrame, closed: DataFrame, calendar: DataFrame) -> DataFrame:
    """``backlog_daily_proxy`` from ``intake_cases`` and ``terminal_cases`` per date."""
    so_far = Window.orderBy("cal_date")
    return (
        calendar.select("cal_date")
        .join(F.broadcast(taken), "cal_date", "left")
        .join(F.broadcast(closed), "cal_date", "left")
        .na.fill(0, ["intake_cases", "terminal_cases"])
        .select(
            "cal_date",
            "intake_cases",
            "terminal_cases",
            F.sum("intake_cases").over(so_far).alias("cum_intake"),
            F.sum("terminal_cases").over(so_far).alias("cum_terminal"),
        )
        .withColumn("open_backlog_proxy", F.col("cum_intake") - F.col("cum_terminal"))
    )


def _with_staffing(backlog: DataFrame, staffing: DataFrame) -> DataFrame:
    """Backlog days with the agents of the day; several zones give several rows."""
    agents = staffing.select("cal_date", "team_tz", "effective_agents_total")
    return backlog.join(F.broadcast(agents), "cal_date", "left")


def congestion_daily(backlog: DataFrame, staffing: DataFrame) -> DataFrame:
    """Open backlog per effective agent, every calendar day."""
    return _with_staffing(backlog, staffing).select(
        "cal_date",
        "team_tz",
        "intake_cases",
        "terminal_cases",
        "open_backlog_proxy",
        "effective_agents_total",
        ratio(F.col("open_backlog_proxy"), F.col("effective_agents_total"), 4).alias(
            "congestion_index"
        ),
    )


def congestion_daily_v2(
    backlog: DataFrame, staffing: DataFrame, calendar: DataFrame
) -> DataFrame:
    """Intake and backlog per effective agent on business days.

    The change in backlog is taken from one business day to the next, so that of
    a Monday holds the weekend as well.
    """
    open_days = calendar.filter("NOT is_weekend AND NOT is_holiday").select("cal_date")
    agents = F.col("effective_agents_total")
    by_day = Window.partitionBy("team_tz").orderBy("cal_date")
    return (
        _with_staffing(backlog, staffing)
        .join(F.broadcast(open_days), "cal_date")
        .select(
            "cal_date",
            "team_tz",
            "intake_cases",
            "terminal_cases",
            "open_backlog_proxy",
            (F.col("open_backlog_proxy") - F.lag("open_backlog_proxy").over(by_day)).alias(
                "backlog_delta"
            ),
            "effective_agents_total",
            ratio(F.col("intake_cases"), agents, FLOW_DIGITS).alias("congestion_flow_index"),
            ratio(F.col("open_backlog_proxy"), agents, FLOW_DIGITS).alias(
                "congestion_stock_index"
            ),
        )
    )


def flow_running(congestion: DataFrame, clock: BusinessClock) -> DataFrame:
    """Running sum and count of the flow index over the calendar, one row per day.

    The index has four decimals and is summed as an integer, so that differences
    of running sums are exact.
    """
    per_day = congestion.groupBy("cal_date").agg(
        F.sum(scaled(F.col("congestion_flow_index"), FLOW_DIGITS)).alias("flow"),
        F.count("congestion_flow_index").alias("readings"),
    )
    so_far = Window.orderBy("cal_date")
    flow = F.when(F.col("is_business"), F.coalesce("flow", F.lit(0))).otherwise(0)
    readings = F.when(F.col("is_business"), F.coalesce("readings", F.lit(0))).otherwise(0)
    return clock.days.join(F.broadcast(per_day), "cal_date", "left").select(
        "cal_date",
        "is_business",
        "days_before",
        F.sum(flow).over(so_far).alias("flow_upto"),
        F.sum(readings).over(so_far).alias("readings_upto"),
        (F.sum(flow).over(so_far) - flow).alias("flow_before"),
        (F.sum(readings).over(so_far) - readings).alias("readings_before"),
    )


def with_exposure(
    facts: DataFrame, running: DataFrame, clock: BusinessClock, max_days: int = 10
) -> DataFrame:
    """Add the mean flow index over a case's first business days up to its resolution.

    The days of a case are a range of business-day numbers, and its sum the
    difference of two running sums. That takes three lookups in calendar-sized
    broadcast tables per case; no range join, no expansion, no shuffle.
    """
    start = F.broadcast(
        running.select(
            F.col("cal_date").alias("_from"),
            F.col("days_before").alias("_first"),
            F.col("flow_before").alias("_flow_before"),
            F.col("readings_before").alias("_readings_before"),
        )
    )
    end = F.broadcast(
        running.select(
            F.col("cal_date").alias("_to"),
            (F.col("days_before") + F.col("is_business").cast("int") - 1).alias("_last"),
        )
    )
    upto = F.broadcast(
        running.filter("is_business").select(
            F.col("days_before").alias("_day"),
            F.col("flow_upto").alias("_flow_upto"),
            F.col("readings_upto").alias("_readings_upto"),
        )
    )
    resolved_date = F.col("resolved_ts").cast("date")
    after_end = F.col("intake_date") > F.lit(clock.last_day)
    before_start = F.col("intake_date") < F.lit(clock.first_day)
    first = F.coalesce("_first", F.when(after_end, clock.business_days).when(before_start, 0))
    last = F.coalesce(
        "_last",
        F.when(resolved_date > F.lit(clock.last_day), clock.business_days - 1).when(
            resolved_date < F.lit(clock.first_day), -1
        ),
    )
    final_day = F.least(last, first + (max_days - 1))
    readings = F.col("_readings_upto") - F.coalesce("_readings_before", F.lit(0))
    flow = F.col("_flow_upto") - F.coalesce("_flow_before", F.lit(0))
    return (
        facts.withColumn("resolved_date", resolved_date)
        .join(start, F.col("intake_date") == F.col("_from"), "left")
        .join(end, F.col("resolved_date") == F.col("_to"), "left")
        .withColumn("_final", F.when(last.isNotNull() & (final_day >= first), final_day))
        .join(upto, F.col("_final") == F.col("_day"), "left")
        .withColumn("biz_days_in_window", F.when(readings > 0, readings))
        .withColumn(
            "avg_congestion_flow_index",
            F.when(readings > 0, mean_of_scaled(flow, readings, FLOW_DIGITS)),
        )
        .drop(
            "_from", "_first", "_flow_before", "_readings_before", "_to", "_last",
            "_final", "_day", "_flow_upto", "_readings_upto",
        )
    )


def case_congestion_exposure(exposed: DataFrame) -> DataFrame:
    """Exposure per case; cases without a business day or without an index are left out."""
    return exposed.filter("avg_congestion_flow_index IS NOT NULL").select(
        "case_id",
        "tier",
        "case_type",
        "intake_date",
        "resolved_date",
        "biz_days_in_window",
        "avg_congestion_flow_index",
    )
