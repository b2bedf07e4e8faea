"""Mixing sources to target weights by repeating documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waitline.llm.staging import stage
from waitline.llm.words import chance, word_count

WEIGHTS = (1, 2, 3)
MOST_REPEATS = 3
SEED = 20_240_601


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most_repeats: int = MOST_REPEATS
) -> DataFrame:
    """Targets per source from rows of (source, size).

    Sources by code point, null last, get the weights in turn and share the sum of all sizes by
    weight. A target above ``most_repeats`` times the source's size stops there; the excess is
    shared again by weight among the others until none is above. Returns ``source,
    source_size, target, rate``; the rate is target over size, 0 for a source without words.
    An empty table gives an empty one.

    The sizes are summed before the shuffle, so a source with a third of all rows is a few rows.
    Each round of sharing is one aggregate over the sources; no source is collected.
    """
    by_source = (
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .orderBy(F.col("source").asc_nulls_last())
    )
    dealt = stage(by_source.withColumn("part", F.spark_partition_id()))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = dealt.groupBy("part").agg(F.count("*").alias("rows")).select(
        "part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset")
    )
    within = Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last())
    place = F.col("offset") + F.row_number().over(within) - 1
    weight = F.get(F.array(*[F.lit(w) for w in weights]), F.pmod(place, F.lit(len(weights))).cast("int"))
    weighted = stage(
        dealt.join(offsets, "part").select(
            "source",
            "source_size",
            weight.alias("weight"),
            (F.col("source_size") * most_repeats).alias("most"),
        )
    )
    share = _share_of_one_weight(weighted)
    target = F.least(F.col("most").cast("double"), F.lit(share) * F.col("weight"))
    return weighted.select("source", "source_size", target.alias("target")).withColumn(
        "rate",
        F.when(
            F.col("source_size") > 0,
            F.least(F.col("target") / F.col("source_size"), F.lit(float(most_repeats))),
        ).otherwise(F.lit(0.0)),
    )


def _share_of_one_weight(weighted: DataFrame) -> float:
    """What one unit of weight gets once no source is above its most."""
    total, weights = weighted.agg(
        F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0))
    ).first()
    share = total / weights if weights else 0.0
    while total:
        full = F.col("most") < F.lit(share) * F.col("weight")
        stopped, free = weighted.agg(
            F.coalesce(F.sum(F.when(full, F.col("most"))), F.lit(0)),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0)),
        ).first()
        again = (total - stopped) / free if free else share
        if again <= share:
            break
        share = again
    return share


def copies(rate: Column, seed: int, key: Column) -> Column:
    """floor(rate) copies, and one more with the probability of the fraction."""
    extra = (chance(seed, key) < rate - F.floor(rate)).cast("int")
    return (F.floor(rate) + extra).cast("int")


def planned(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    most_repeats: int = MOST_REPEATS,
    seed: int = SEED,
) -> DataFrame:
    """Each row as a struct ``doc``, with ``size``, its source's figures and ``copies``.

    ``docs`` has doc_id, text and source; other columns stay inside the struct and may have any
    name. Size is the number of words, 0 for null or empty text. Rows with one doc_id draw the
    same coin, so reruns and repeated rows agree; without doc_id the text decides.
    """
    rows = docs.select(
        F.struct("*").alias("doc"),
        "source",
        F.coalesce(F.col("doc_id").cast("string"), F.col("text")).alias("key"),
        word_count(F.col("text")).alias("size"),
    )
    targets = source_targets(rows.select("source", "size"), weights, most_repeats).select(
        F.col("source").alias("target_source"), "source_size", "target", "rate"
    )
    joined = rows.join(targets, F.col("source").eqNullSafe(F.col("target_source")), "left")
    return joined.withColumn("copies", copies(F.col("rate"), seed, F.col("key"))).drop(
        "target_source", "key"
    )


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mix: every row as often as planned, with the columns of ``docs``."""
    repeated = F.explode(F.sequence(F.lit(1), F.col("copies")))
    plan = planned(docs, **options).filter("copies > 0")
    return plan.select("doc", repeated.alias("copy")).select("doc.*")
