"""Customer waits and service-target metrics per case."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waitline.functions.clock import BusinessClock, minutes_between
from waitline.operators.scan import with_next
from waitline.settings import Targets

WAIT = "CUSTOMER_WAIT"


def wait_intervals(events: DataFrame) -> DataFrame:
    """Each customer wait with the next strictly later event of its case, of any status.

    Copies of an event count once. The search runs minute by minute and is carried on over
    minutes and days, so a case with very many events, or a busy day of it, is spread.
    """
    ts = F.col("event_ts_canonical")
    moments = (
        events.groupBy("case_id", "event_ts_canonical")
        .agg(F.max(F.col("status") == WAIT).alias("is_wait"))
        .withColumns({"day": ts.cast("date"), "minute": F.date_trunc("minute", ts)})
    )
    return (
        with_next(moments, ["case_id"], "event_ts_canonical", ["day", "minute"], "cw_end_ts")
        .filter("is_wait")
        .select("case_id", ts.alias("cw_start_ts"), "cw_end_ts")
    )


def wait_minutes(events: DataFrame, clock: BusinessClock, mode: str = "inner") -> DataFrame:
    """Open minutes spent waiting for the customer, per case with a finished wait.

    Equals the sum over ``wait_intervals`` of the minutes from start to end, but
    works on positions: all events of a case at one position are one slot, and a
    wait counts from its slot to the next one if nothing follows it in its own.
    Slots are formed with map-side combine; the sum runs over the slots of each business
    day of a case, which are as many as it has minutes at most, and the wait that a day
    leaves open is carried to the case's next day with events. So a case with a third of
    all events is spread over its days. A semi join with the cases that wait would spare
    rows, but gather all that is left of a case in one task.
    """
    ts = F.col("event_ts_canonical")
    wait_ts = F.when(F.col("status") == WAIT, ts)
    day = F.call_function("div", F.col("position"), F.lit(clock.piece_minutes))
    slots = (
        clock.with_positions(
            events.select("case_id", "status", "event_ts_canonical", *clock.keys),
            {"event_ts_canonical": "position"},
        )
        .withColumn("open_day", day)
        .groupBy("case_id", *clock.keys, "open_day", "position")
        .agg(
            F.max(ts).alias("last_ts"),
            F.min(wait_ts).alias("first_wait_ts"),
            F.max(wait_ts).alias("last_wait_ts"),
        )
    )
    following = F.lead("position").over(
        Window.partitionBy("case_id", "open_day").orderBy("position")
    )
    left = mode == "left"
    counted = F.col("last_wait_ts").isNotNull()
    counted_first = F.col("first_wait_ts") < F.col("last_ts")
    if not left:
        counted = counted & clock.covers(F.col("last_wait_ts"))
        counted_first = counted_first & clock.covers(F.col("first_wait_ts"))
    runs_on = counted & (F.col("last_wait_ts") == F.col("last_ts"))
    is_last = F.col("next_position").isNull()
    per_day = (
        slots.withColumn("next_position", following)
        .groupBy("case_id", "open_day")
        .agg(
            F.min("position").alias("first_position"),
            F.sum(
                F.when(runs_on & ~is_last, F.col("next_position") - F.col("position")).otherwise(0)
            ).alias("minutes"),
            F.count_if(counted_first | (counted & ~is_last)).alias("finished"),
            F.count_if(counted & is_last).alias("unfinished"),
            F.max(F.when(runs_on & is_last, F.col("position"))).alias("open_position"),
        )
    )
    next_day = F.lead("first_position").over(Window.partitionBy("case_id").orderBy("open_day"))
    carried = F.coalesce(F.col("next_first") - F.col("open_position"), F.lit(0))
    return (
        per_day.withColumn("next_first", next_day)
        .filter(
            (F.col("finished") > 0) | (F.col("next_first").isNotNull() & (F.col("unfinished") > 0))
        )
        .groupBy("case_id")
        .agg(F.sum(F.col("minutes") + carried).alias("customer_wait_business_minutes"))
    )


def _hours(minutes: Column) -> Column:
    return F.round(minutes.cast("double") / 60.0, 3)


def sla_columns(targets: Targets) -> dict[str, Column]:
    """Metrics from positions ``intake_at``, ``triage_at``, ``resolved_at`` and wait minutes."""
    touch = minutes_between(F.col("intake_at"), F.col("triage_at"))
    whole = minutes_between(F.col("intake_at"), F.col("resolved_at"))
    waited = F.coalesce("customer_wait_business_minutes", F.lit(0).cast("bigint"))
    paused = F.when(whole.isNotNull(), F.greatest(F.lit(0).cast("bigint"), whole - waited))
    return {
        "first_touch_business_minutes": touch,
        "first_resolution_business_minutes_including_cw": whole,
        "customer_wait_business_minutes": waited,
        "first_resolution_business_minutes_paused_cw": paused,
        "first_touch_business_hours": _hours(touch),
        "first_resolution_business_hours_including_cw": _hours(whole),
        "first_resolution_business_hours_paused_cw": _hours(paused),
        "sla_b_breached": touch > targets.first_touch_minutes,
        "sla_a_breached_including_cw": whole > targets.first_resolution_minutes,
        "sla_a_breached_paused_cw": paused > targets.first_resolution_minutes,
        "is_triage_missing_for_sla": F.col("triage_ts").isNull(),
        "is_terminal_missing_for_sla": F.col("resolved_ts").isNull()
        & F.col("cancelled_ts").isNull(),
        "is_triage_before_intake_for_sla": F.coalesce(
            F.col("triage_ts") < F.col("intake_ts"), F.lit(False)
        ),
    }


def in_sla_table(facts: DataFrame, mode: str = "inner") -> DataFrame:
    """Cases of the SLA table: all, or those with intake, triage and resolution in the calendar."""
    if mode not in ("inner", "left"):
        raise ValueError(f"mode must be 'inner' or 'left', not {mode!r}")
    return facts if mode == "left" else facts.filter("is_measured")


def case_sla_metrics(
    facts: DataFrame, mode: str = "inner", targets: Targets | None = None
) -> DataFrame:
    """The SLA table, one row per case."""
    measures = [c.alias(name) for name, c in sla_columns(targets or Targets()).items()]
    return in_sla_table(facts, mode).select(
        "case_id",
        "case_type",
        "tier",
        "team_tz",
        "intake_date",
        "intake_ts",
        "triage_ts",
        "resolved_ts",
        "cancelled_ts",
        *measures,
    )
