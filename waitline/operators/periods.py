"""Percentiles of months, quarters or years from what is stored per day.

Counts of values add up, so percentiles of any period follow from them exactly. Where a day has
too many distinct values to keep, a sketch of each measure takes their place: it merges as well,
has a fixed size, and its percentiles are off by at most ``rank_error`` of the rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waitline.functions.numbers import interpolated
from waitline.operators.marts import DURATIONS, duration_counts
from waitline.settings import REPORTED_QUANTILES

#: Values that a sketch keeps at its lowest level; more make it larger and more exact.
SKETCH_K = 800


def rank_error(k: int = SKETCH_K) -> float:
    """Bound of the error in rank, as a share of the rows, that 99 % of percentiles keep.

    The published figure for sketches of this kind: 2.296 / k to the power of 0.9021.
    """
    return 2.296 / k**0.9021


def period_of(day: Column, period: str) -> Column:
    """First day of the ``month``, ``quarter`` or ``year`` of a date."""
    return F.trunc(day, period).alias("period")


def day_counts(sla: DataFrame) -> DataFrame:
    """Counts of every duration per intake day, see ``value_counts``."""
    return duration_counts(sla, ["intake_date"]).drop("flag")


def period_percentiles(
    counts: DataFrame, period: str, quantiles: Sequence[float] = REPORTED_QUANTILES
) -> DataFrame:
    """Exact percentiles of each measure and period from ``day_counts``; NULL values apart."""
    merged = (
        counts.filter("value IS NOT NULL")
        .groupBy(period_of(F.col("intake_date"), period), "measure", "value")
        .agg(F.sum("n").alias("n"))
    )
    points = interpolated(F.col("value"), quantiles, F.col("n"))
    return merged.groupBy("period", "measure").agg(
        F.sum("n").alias("cases"),
        *[p.alias(f"p{round(q * 100)}_min") for q, p in zip(quantiles, points, strict=True)],
    )


def day_sketches(
    sla: DataFrame,
    measures: Mapping[str, str] | None = None,
    keys: Sequence[str] = ("intake_date",),
    k: int = SKETCH_K,
) -> DataFrame:
    """One sketch per key and measure, in a binary column with the measure's name."""
    measures = measures or {name: minutes for name, (minutes, _) in DURATIONS.items()}
    return sla.groupBy(*keys).agg(
        *[F.kll_sketch_agg_bigint(F.col(c), F.lit(k)).alias(name) for name, c in measures.items()]
    )


def sketched_percentiles(
    sketches: DataFrame,
    period: str,
    measures: Sequence[str] = tuple(DURATIONS),
    quantiles: Sequence[float] = REPORTED_QUANTILES,
    k: int = SKETCH_K,
) -> DataFrame:
    """Percentiles of each measure and period from sketches, values that occur and no means."""
    merged = sketches.groupBy(period_of(F.col("intake_date"), period)).agg(
        *[F.kll_merge_agg_bigint(F.col(name), F.lit(k)).alias(name) for name in measures]
    )
    rows = F.array(
        *[F.struct(F.lit(name).alias("measure"), F.col(name).alias("sketch")) for name in measures]
    )
    n = F.kll_sketch_get_n_bigint("sketch")
    return (
        merged.select("period", F.inline(rows))
        .filter(n > 0)
        .select(
            "period",
            "measure",
            n.alias("cases"),
            *[
                F.kll_sketch_get_quantile_bigint("sketch", F.lit(q)).alias(f"p{round(q * 100)}_min")
                for q in quantiles
            ],
        )
    )


def sketch_errors(
    sketched: DataFrame,
    counts: DataFrame,
    period: str,
    quantiles: Sequence[float] = REPORTED_QUANTILES,
    k: int = SKETCH_K,
) -> DataFrame:
    """Per period and measure whether each sketched percentile has the rank that is promised.

    Held against exact counts: the share of rows below the value, and that of rows up to it,
    must reach the wanted rank but for the error.
    """
    by = counts.filter("value IS NOT NULL").select(
        period_of(F.col("intake_date"), period), F.col("measure").alias("of"), "value", "n"
    )
    names = {q: f"p{round(q * 100)}_min" for q in quantiles}
    same = (by["period"] == sketched["period"]) & (F.col("of") == F.col("measure"))
    error = rank_error(k)

    def kept(q: float) -> Column:
        below = F.sum(F.when(F.col("value") < F.col(names[q]), F.col("n")).otherwise(0))
        upto = F.sum(F.when(F.col("value") <= F.col(names[q]), F.col("n")).otherwise(0))
        total = F.sum("n")
        return (below / total <= q + error) & (upto / total >= q - error)

    every = kept(quantiles[0])
    for q in quantiles[1:]:
        every = every & kept(q)
    return (
        sketched.join(by, same)
        .groupBy(sketched["period"], "measure")
        .agg(F.sum("n").alias("cases"), every.alias("within_error"))
    )
