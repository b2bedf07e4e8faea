"""What each of five filters removes, alone and after the others, in every order of the filters.

Four filters look at one text; the fifth (``E``) fails a document whose text a smaller id has too.
Failures are a handful of bits per document, so the audit of all 120 orders is one aggregate over
the combinations of bits: how often each occurs per part, and what every order does with it.

Null texts are empty ones. A null id is smaller than no other and has no smaller one. Repeated
rows of a document are documents of their own, which do not make each other fail, since no id is
smaller. Labels of a document in several rows count if any row has them; null labels and those of
ids that no document has count nowhere. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waitline.llm.staging import stage
from waitline.llm.words import let, word_array

#: The filters and the bounds of the contract.
FILTERS = "ABCDE"
LEAST_WORDS = 100
LEAST_DISTINCT_PERCENT = 80
MOST_CAPITALS_PERCENT = 10
SYMBOLS = "#$%&*|"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

BIT = {name: 1 << n for n, name in enumerate(FILTERS)}


def _without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def failed_alone(text: Column) -> Column:
    """The bits of the filters that look at one text, which is not null."""
    size = F.length(text)

    def of_words(words: Column) -> Column:
        few = F.size(words) < LEAST_WORDS
        repeated = 100 * F.size(F.array_distinct(words)) < LEAST_DISTINCT_PERCENT * F.size(words)
        return F.when(few, BIT["A"]).otherwise(0) + F.when(repeated, BIT["B"]).otherwise(0)

    shouted = 100 * (size - F.length(_without(text, CAPITALS))) > MOST_CAPITALS_PERCENT * size
    return (
        let(word_array(text), of_words)
        + F.when(shouted, BIT["C"]).otherwise(0)
        + F.when(F.length(_without(text, SYMBOLS)) < size, BIT["D"]).otherwise(0)
    )


def copies_of_smaller(docs: DataFrame, facts: DataFrame) -> DataFrame:
    """Rows of ``facts`` whose text a smaller id has too: a left semi join of the texts.

    Only texts with a hash that two ids have are compared. Of equal texts one row with the
    smallest id is joined to, made before the shuffle as far as a task sees them, so a group of
    copies is never gathered; Spark may split the other side of the join anywhere.
    """
    twice = stage(
        facts.groupBy("hash")
        .agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
        .filter("least < most")
        .select("hash")
    )
    text = F.coalesce("text", F.lit(""))
    keys = docs.select("doc_id", "lang", F.xxhash64(text).alias("hash"), text.alias("text"))
    suspects = stage(keys.join(twice, "hash", "left_semi"))
    first = stage(
        suspects.groupBy("hash", "text")
        .agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
        .filter("first < last")
        .select(F.col("hash").alias("of_hash"), F.col("text").alias("of_text"), "first")
    )
    same = (F.col("hash") == F.col("of_hash")) & (F.col("text") == F.col("of_text"))
    return suspects.join(first, same & (F.col("first") < F.col("doc_id")), "left_semi").select(
        "doc_id", "lang", "hash"
    )


def combinations(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, failed, good, toxic, n_docs``: how often each combination of failures occurs."""
    text = F.coalesce("text", F.lit(""))
    docs = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("lang"), "text")
    facts = stage(
        docs.select(
            "doc_id", "lang", F.xxhash64(text).alias("hash"), failed_alone(text).alias("failed")
        )
    )
    copied = copies_of_smaller(docs, facts)
    failures = facts.withColumn("n_docs", F.lit(1)).unionByName(
        copied.select("*", F.lit(BIT["E"]).alias("failed"), F.lit(0).alias("n_docs"))
    )
    per_doc = failures.groupBy("doc_id", "lang", "hash").agg(
        F.bit_or("failed").alias("failed"), F.sum("n_docs").alias("n_docs")
    )
    judged = labels.groupBy(F.col("doc_id").alias("of")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"),
        F.max((F.col("toxic") == 1).cast("int")).alias("toxic"),
    )
    return (
        per_doc.join(judged.filter("good = 1 OR toxic = 1"), F.col("doc_id") == F.col("of"), "left")
        .na.fill(0, ["good", "toxic"])
        .groupBy(F.col("lang").alias("part"), "failed", "good", "toxic")
        .agg(F.sum("n_docs").alias("n_docs"))
    )


OUTCOMES = T.StructType(
    [
        T.StructField("of_failed", T.IntegerType()),
        T.StructField("filter_order", T.StringType()),
        T.StructField("step", T.IntegerType()),
        *[T.StructField(name, T.IntegerType()) for name in ("kept", "removed", "redundant")],
        *[T.StructField(name, T.IntegerType()) for name in ("unique", "shapley")],
    ]
)


def outcomes(spark: SparkSession) -> DataFrame:
    """What every step of every order does with each combination: 32 x 120 x 5 rows, always.

    A filter is the first of a document's failures in 1 of as many orders as it has failures,
    which is its part of ``shapley``.
    """
    rows = []
    for failed in range(1 << len(FILTERS)):
        for order in permutations(FILTERS):
            before = 0
            for step, name in enumerate(order, 1):
                fails, gone = failed & BIT[name], failed & before
                before |= BIT[name]
                rows.append(
                    (
                        failed,
                        "".join(order),
                        step,
                        int(not failed & before),
                        int(bool(fails) and not gone),
                        int(bool(fails) and bool(gone)),
                        int(failed == BIT[name]),
                        120 // failed.bit_count() if fails else 0,
                    )
                )
    return spark.createDataFrame(rows, OUTCOMES)


def audited(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order and step, with the counts of the step; see the module."""
    counts = combinations(docs, labels)
    steps = F.broadcast(outcomes(docs.sparkSession))

    def total(flag: str, *only: str) -> Column:
        value = F.col("n_docs") * F.col(flag)
        for column in only:
            value = value * F.col(column)
        return F.sum(value).cast("long")

    return (
        counts.join(steps, F.col("failed") == F.col("of_failed"))
        .groupBy("part", "filter_order", "step")
        .agg(
            total("kept").alias("kept"),
            total("removed").alias("removed"),
            total("redundant").alias("redundant"),
            total("unique").alias("unique_fails"),
            total("removed", "good").alias("good_lost"),
            total("removed", "toxic").alias("toxic_lost"),
            total("shapley").alias("shapley"),
        )
    )
