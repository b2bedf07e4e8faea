"""Joins on time: the last row at or before a time, and intervals that overlap.

Both need no calendar and no closed form, and neither compares all rows of a key with each other.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waitline.functions.clock import micros_since_1970

Keep = Callable[[str, DataFrame], DataFrame]

BASE_SECONDS = 60


def asof_join(
    left: DataFrame,
    right: DataFrame,
    left_at: str,
    right_at: str,
    keep: Keep,
    by: Sequence[str] = (),
    how: str = "left",
    name: str = "asof",
) -> DataFrame:
    """Each left row with the last right row of the same ``by`` at or before its time.

    Both sides are dealt by range of (keys, time) as one table, which ``keep`` stores with the
    number of each part, so a key is spread over as many parts as it needs. In a part every left
    row takes the last right row before it; where there is none it takes the one carried over from
    the parts before, of which each is one row per key. Of right rows at one time the one with the
    largest values counts. Times and keys that are NULL match nothing; ``how`` says whether left
    rows without a match stay. The sides must not share names but those of ``by``.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"how must be 'left' or 'inner', not {how!r}")
    taken = [c for c in right.columns if c not in by]
    nothing = F.lit(None).cast(right.select(F.struct(*taken).alias("r")).schema["r"].dataType)
    row = F.struct(*[F.col(f"`{c}`") for c in left.columns])
    keys = [f"_key{n}" for n in range(len(by))]
    keyed = [F.col(c).alias(k) for c, k in zip(by, keys, strict=True)]
    ours = left.select(*keyed, F.col(left_at).alias("_at"), F.lit(1).alias("_side"),
                       nothing.alias("_right"), row.alias("_left"))
    theirs = right.filter(F.col(right_at).isNotNull()).select(
        *keyed, F.col(right_at).alias("_at"), F.lit(0).alias("_side"),
        F.struct(*taken).alias("_right"),
        F.lit(None).cast(ours.schema["_left"].dataType).alias("_left"),
    )
    for key in keys:
        theirs = theirs.filter(F.col(key).isNotNull())
    both = keep(
        name,
        ours.unionByName(theirs)
        .repartitionByRange(*keys, "_at", "_side")
        .withColumn("_part", F.spark_partition_id()),
    )
    so_far = Window.partitionBy("_part", *keys).orderBy("_at", "_side", "_right")
    found = both.withColumn("_found", F.last("_right", ignorenulls=True).over(so_far))
    ends = both.groupBy("_part", *keys).agg(
        F.max(F.when(F.col("_side") == 0, F.struct("_at", "_right"))).alias("_end")
    )
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(
        F.col("_part").alias("_of_part"),
        *[F.col(k).alias(f"_of{k}") for k in keys],
        F.last("_end", ignorenulls=True).over(before)["_right"].alias("_carried"),
    )
    same = F.col("_part") == F.col("_of_part")
    for key in keys:
        same = same & (F.col(key) == F.col(f"_of{key}"))
    match = F.when(F.col("_at").isNotNull(), F.coalesce("_found", "_carried"))
    joined = (
        found.filter("_side = 1")
        .join(carried, same, "left")
        .select("_left", match.alias("_match"))
    )
    if how == "inner":
        joined = joined.filter("_match IS NOT NULL")
    return joined.select("_left.*", *[F.col(f"_match.`{c}`").alias(c) for c in taken])


def overlap_join(
    left: DataFrame,
    right: DataFrame,
    left_interval: tuple[str, str],
    right_interval: tuple[str, str],
    by: Sequence[str] = (),
) -> DataFrame:
    """All pairs of rows of the same ``by`` whose intervals [start, end) overlap.

    Every interval has a level, the smallest power of two times ``BASE_SECONDS`` that holds its
    length, and lies in one or two buckets of that size or any larger one. A pair meets at the
    larger of its two levels, in the bucket of its common start and in no other. So an interval
    costs two rows per level that the other side has, however long the longest of them are,
    and a busy time is as many keys as it has levels and buckets. Intervals that are empty or lack
    an end overlap with nothing. The sides must not share names but those of ``by``.
    """
    base = BASE_SECONDS * 1_000_000

    def placed(df: DataFrame, interval: tuple[str, str], side: str) -> DataFrame:
        start, end = (micros_since_1970(F.col(c)) for c in interval)
        level = F.greatest(F.lit(0), F.ceil(F.log2(F.col(f"_{side}_length") / base))).cast("int")
        return (
            df.select(
                F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(f"_{side}"),
                *[F.col(c).alias(f"_{side}_key{n}") for n, c in enumerate(by)],
                start.alias(f"_{side}_start"),
                end.alias(f"_{side}_end"),
                (end - start).alias(f"_{side}_length"),
            )
            .filter(F.col(f"_{side}_length") > 0)
            .withColumn(f"_{side}_level", level)
        )

    def levels(df: DataFrame, side: str) -> list[int]:
        """A few dozen numbers at most: the logarithm of the longest time."""
        return sorted(r[0] for r in df.select(f"_{side}_level").distinct().collect())

    def dealt(df: DataFrame, side: str, others: list[int]) -> DataFrame:
        """Rows for the own level and for the larger ones of the other side."""
        own = F.col(f"_{side}_level")
        wanted = F.array_union(
            F.array(own), F.filter(F.array(*[F.lit(n) for n in others]), lambda n: n > own)
        )
        size = (F.lit(base) * F.pow(F.lit(2), F.col(f"_{side}_at"))).cast("bigint")
        first, last = (
            F.call_function("div", F.col(c) - F.pmod(F.col(c), size), size)
            for c in (f"_{side}_start", f"_{side}_last")
        )
        return (
            df.withColumn(f"_{side}_last", F.col(f"_{side}_end") - 1)
            .withColumn(f"_{side}_at", F.explode(wanted))
            .withColumn(f"_{side}_bucket", F.explode(F.sequence(first, last)))
            .drop(f"_{side}_last")
        )

    a, b = placed(left, left_interval, "a"), placed(right, right_interval, "b")
    ours, theirs = levels(a, "a"), levels(b, "b")
    if not ours or not theirs:
        a, b, ours, theirs = a.limit(0), b.limit(0), [0], [0]
    meet = (F.col("_a_at") == F.col("_b_at")) & (F.col("_a_bucket") == F.col("_b_bucket"))
    for n in range(len(by)):
        meet = meet & (F.col(f"_a_key{n}") == F.col(f"_b_key{n}"))
    common = F.greatest("_a_start", "_b_start")
    size = (F.lit(base) * F.pow(F.lit(2), F.col("_a_at"))).cast("bigint")
    pairs = dealt(a, "a", theirs).join(
        dealt(b, "b", ours),
        meet
        & (F.col("_a_at") == F.greatest("_a_level", "_b_level"))
        & (common < F.least("_a_end", "_b_end"))
        & (F.call_function("div", common - F.pmod(common, size), size) == F.col("_a_bucket")),
    )
    rest = [F.col(f"_b.`{c}`").alias(c) for c in right.columns if c not in by]
    return pairs.select("_a.*", *rest)
