"""What goes along with breaches: congestion, reopening, stages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waitline.functions.numbers import (
    mean_of_scaled,
    quantiles_of,
    rate,
    rows_of,
    scaled,
    value_counts,
)
from waitline.operators.stages import STAGES, TOTAL
from waitline.settings import REPORTED_QUANTILES


def driver_congestion_buckets(tiled: DataFrame) -> DataFrame:
    """Breach rates per congestion decile and tier; needs a ``congestion_decile`` column."""
    exposure = F.col("avg_congestion_flow_index")
    return tiled.groupBy("congestion_decile", "tier").agg(
        F.count("*").alias("cases"),
        rate(F.col("sla_b_breached")).alias("sla_b_breach_pct"),
        rate(F.col("sla_a_breached_including_cw")).alias("sla_a_breach_pct_inc_cw"),
        rate(F.col("sla_a_breached_paused_cw")).alias("sla_a_breach_pct_pause_cw"),
        mean_of_scaled(F.sum(scaled(exposure, 4)), F.count(exposure), 4).alias(
            "avg_congestion_exposure"
        ),
    )


# Name of a congestion level and the decile that stands for it.
LEVELS = {"p50_cong": 5, "p90_cong": 9, "p95plus_cong": 10}
BREACHES = {"sla_b": "sla_b_breached", "sla_a": "sla_a_breached_including_cw"}


def driver_summary(tiled: DataFrame) -> DataFrame:
    """Breach rates at three congestion levels and their differences, one row."""
    rates = tiled.groupBy("congestion_decile").agg(
        *[rate(F.col(flag)).alias(name) for name, flag in BREACHES.items()]
    )
    picked = rates.agg(
        *[
            F.max(F.when(F.col("congestion_decile") == decile, F.col(name))).alias(
                f"{name}_breach_{level}"
            )
            for name in BREACHES
            for level, decile in LEVELS.items()
        ]
    )

    def lift(name: str, level: str) -> Column:
        return F.round(
            F.col(f"{name}_breach_{level}") - F.col(f"{name}_breach_p50_cong"), 3
        )

    columns: list[Column | str] = []
    for name in BREACHES:
        columns += [f"{name}_breach_{level}" for level in LEVELS]
        columns += [
            lift(name, "p90_cong").alias(f"{name}_breach_lift_p90_vs_p50"),
            lift(name, "p95plus_cong").alias(f"{name}_breach_lift_p95_vs_p50"),
        ]
    return picked.select(*columns)


def driver_reopen_impact(sla: DataFrame) -> DataFrame:
    """Resolution hours with and without reopening per tier and case type.

    ``sla`` holds ``reopened_first_ts`` next to the SLA metrics of a case.
    """
    keys = ["tier", "case_type", "is_reopened"]
    resolved = sla.filter("resolved_ts IS NOT NULL").withColumn(
        "is_reopened", F.col("reopened_first_ts").isNotNull()
    )
    counts = value_counts(
        resolved,
        keys,
        {
            "whole": "first_resolution_business_hours_including_cw",
            "paused": "first_resolution_business_hours_paused_cw",
        },
    )

    def mean(measure: str) -> Column:
        total = F.sum(
            F.when(F.col("measure") == measure, scaled(F.col("value"), 3) * F.col("n"))
        )
        return mean_of_scaled(total, rows_of(measure, F.col("value").isNotNull()), 3)

    p90, p95 = quantiles_of("whole", (0.9, 0.95))
    return counts.groupBy(*keys).agg(
        rows_of("whole").alias("cases"),
        mean("whole").alias("avg_fr_hours_inc_cw"),
        mean("paused").alias("avg_fr_hours_pause_cw"),
        p90.alias("p90_fr_hours_inc_cw"),
        p95.alias("p95_fr_hours_inc_cw"),
    )


def driver_stage_durations(stages: DataFrame) -> DataFrame:
    """Percentiles of every stage per tier."""
    names = [name for name, _, _ in (*STAGES, TOTAL)]
    counts = value_counts(
        stages.filter("mins_intake_to_resolved IS NOT NULL"),
        ["tier"],
        {name: f"mins_{name}" for name in names},
    )
    columns = []
    for name in names:
        values = quantiles_of(name, REPORTED_QUANTILES)
        label = "total" if name == TOTAL[0] else name
        columns += [
            value.alias(f"p{round(q * 100)}_{label}")
            for q, value in zip(REPORTED_QUANTILES, values, strict=True)
        ]
    return counts.groupBy("tier").agg(*columns)


def bottleneck_stage(stage_percentiles: DataFrame, tier: str = "TIER_3") -> DataFrame:
    """The stage with the largest p95 of a tier; the earlier stage where two are equal."""
    entries = F.array(
        *[
            F.struct(
                F.coalesce(F.col(f"p95_{name}"), F.lit(-1.0)).alias("known"),
                F.lit(-place).alias("place"),
                F.lit(name).alias("stage"),
                F.col(f"p95_{name}").alias("p95_minutes"),
            )
            for place, (name, _, _) in enumerate(STAGES)
        ]
    )
    return (
        stage_percentiles.filter(F.col("tier") == tier)
        .withColumn("top", F.array_max(entries))
        .select("tier", F.col("top.stage").alias("stage"), "top.p95_minutes")
    )
