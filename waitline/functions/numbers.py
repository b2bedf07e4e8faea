"""Rates, exact percentiles and rounding."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rate(condition: Column, digits: int | None = 3) -> Column:
    """Percentage of rows where the condition is true; NULL counts as not true."""
    percent = 100.0 * F.avg(F.when(condition, 1).otherwise(0))
    return percent if digits is None else F.round(percent, digits)


def share(part: Column, whole: Column, digits: int = 3) -> Column:
    """Percentage from two counts, NULL when there is nothing to divide by."""
    return F.round(100.0 * F.try_divide(part, whole), digits)


def ratio(numerator: Column, denominator: Column, digits: int) -> Column:
    """Rounded quotient, NULL where the denominator is zero."""
    return F.round(numerator.cast("double") / F.nullif(denominator, F.lit(0)), digits)


def scaled(value: Column, digits: int) -> Column:
    """A value already rounded to ``digits`` decimals as an exact integer."""
    return F.round(value * float(10**digits)).cast("bigint")


def mean_of_scaled(total: Column, count: Column, digits: int) -> Column:
    """Mean of non-negative scaled integers, rounded half up to ``digits`` without float error."""
    whole = F.call_function("div", total * 2 + count, F.nullif(count * 2, F.lit(0)))
    return whole.cast("double") / float(10**digits)


def value_counts(
    df: DataFrame,
    keys: Sequence[str],
    measures: Mapping[str, str],
    flags: Mapping[str, str] | None = None,
    weight: str | None = None,
) -> DataFrame:
    """How often each value of each measure occurs per group: (keys, measure, value, flag, n).

    First level of a two-level exact percentile. The rows are counted on the map
    side and shuffled by (keys, measure, value), so that one hot group is spread
    over many tasks; what is left per group is at most the distinct minutes.
    ``flags`` adds a boolean that depends on the same row, such as its breach flag. Rows
    count once, or as often as ``weight`` says, which may be negative for rows taken back.
    """
    flags = flags or {}
    weights = [] if weight is None else [weight]
    entries = [
        F.struct(
            F.lit(name).alias("measure"),
            F.col(column).alias("value"),
            (F.col(flags[name]) if name in flags else F.lit(None).cast("boolean")).alias("flag"),
        )
        for name, column in measures.items()
    ]
    return (
        df.select(*keys, *weights, F.explode(F.array(*entries)).alias("entry"))
        .select(*keys, *weights, "entry.measure", "entry.value", "entry.flag")
        .groupBy(*keys, "measure", "value", "flag")
        .agg((F.count("*") if weight is None else F.sum(weight)).alias("n"))
    )


def interpolated(
    value: Column, quantiles: Sequence[float], frequency: Column | int = 1
) -> list[Column]:
    """Exact interpolated percentiles, without the float noise of the interpolation."""
    points = F.percentile(value, F.array(*[F.lit(q) for q in quantiles]), frequency)
    return [F.round(F.get(points, F.lit(i)), 6) for i in range(len(quantiles))]


def quantiles_of(measure: str, quantiles: Sequence[float]) -> list[Column]:
    """Exact percentiles of one measure of ``value_counts``."""
    value = F.when(F.col("measure") == measure, F.col("value"))
    return interpolated(value, quantiles, F.col("n"))


def rows_of(measure: str, condition: Column | None = None) -> Column:
    """Rows behind one measure of ``value_counts``, optionally only those meeting a condition."""
    wanted = F.col("measure") == measure
    if condition is not None:
        wanted = wanted & condition
    return F.sum(F.when(wanted, F.col("n")).otherwise(0))
