"""Line dedup by overlapping windows of three lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LINES = 3
SECOND_SEED = 97


def _fingerprint(text: Column) -> Column:
    return F.xxhash64(text)


def _windows(docs: DataFrame, lines: int) -> DataFrame:
    """One row per window: the document, the window's first line and 128 bits of hash."""
    split = docs.select(
        "doc_id",
        _fingerprint(F.col("text")).alias("print"),
        F.split("text", "\n").alias("lines"),
    ).filter(F.size("lines") >= lines)
    first_lines = F.sequence(F.lit(0), F.size("lines") - lines)

    def window(i: Column) -> Column:
        parts = [F.get(F.col("lines"), i + n) for n in range(lines)]
        return F.struct(
            i.cast("int").alias("position"),
            F.xxhash64(*parts).alias("h1"),
            F.xxhash64(F.lit(SECOND_SEED), *parts).alias("h2"),
        )

    return split.select("doc_id", "print", F.inline(F.transform(first_lines, window)))


def covered_lines(docs: DataFrame, lines: int = LINES) -> DataFrame:
    """The line numbers to remove, per document that has any: ``doc_id, print, covered``.

    Windows of ``lines`` consecutive lines are hashed; of each hash that occurs again anywhere,
    the first occurrence by (doc_id, null first, then text hash, then line) stays and the lines
    of all later ones are covered. Counting combines before the shuffle, so a passage in a third
    of all documents is one row per task; the join that follows is one that Spark splits.
    """
    windows = _windows(docs, lines)
    place = F.struct("doc_id", "print", "position")
    repeated = (
        windows.groupBy("h1", "h2")
        .agg(F.min(place).alias("first"), F.count("*").alias("times"))
        .filter("times > 1")
        .select(F.col("h1").alias("k1"), F.col("h2").alias("k2"), "first")
    )
    later = windows.join(
        repeated, (F.col("h1") == F.col("k1")) & (F.col("h2") == F.col("k2"))
    ).filter(~place.eqNullSafe(F.col("first")))
    each = F.explode(F.sequence(F.col("position"), F.col("position") + lines - 1))
    return (
        later.select("doc_id", "print", each.alias("line"))
        .groupBy("doc_id", "print")
        .agg(F.collect_set("line").alias("covered"))
    )


def lines_removed(docs: DataFrame, covered: DataFrame) -> DataFrame:
    """Each row as a struct ``doc``, with ``clean`` text, ``n_lines`` and ``n_removed``.

    ``covered`` has the line numbers to remove by doc_id and ``print``, the text's fingerprint.
    """
    gone = covered.select(
        F.col("doc_id").alias("of_id"), F.col("print").alias("of_print"), "covered"
    )
    rows = docs.select(
        F.struct("*").alias("doc"),
        F.col("doc_id").alias("id"),
        F.col("text").alias("raw"),
        _fingerprint(F.col("text")).alias("print"),
    )
    joined = rows.join(
        gone,
        F.col("id").eqNullSafe(F.col("of_id")) & (F.col("print") == F.col("of_print")),
        "left",
    )
    every = F.sequence(F.lit(0), F.size("all_lines") - 1)
    kept = F.transform(F.array_except(every, "covered"), lambda i: F.get("all_lines", i))
    return joined.withColumn("all_lines", F.split("raw", "\n")).select(
        "doc",
        F.when(F.col("covered").isNull(), F.col("raw"))
        .otherwise(F.array_join(kept, "\n"))
        .alias("clean"),
        F.coalesce(F.size("all_lines"), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("covered"), F.lit(0)).cast("long").alias("n_removed"),
    )


def with_text(docs: DataFrame, cleaned: DataFrame) -> DataFrame:
    """The columns of ``docs`` with the clean text, and n_chars, if there, counted again."""
    columns = []
    for name in docs.columns:
        column = F.col("doc").getField(name)
        if name == "text":
            column = F.col("clean")
        elif name == "n_chars":
            kind = docs.schema["n_chars"].dataType
            column = F.when(F.col("n_removed") > 0, F.length("clean").cast(kind)).otherwise(column)
        columns.append(column.alias(name))
    return cleaned.select(*columns)


def deduplicated(docs: DataFrame, lines: int = LINES) -> DataFrame:
    """Each row as a struct ``doc``, with ``clean`` text, ``n_lines`` and ``n_removed``.

    ``docs`` has doc_id and text; other columns stay inside the struct. Rows equal in doc_id and
    text are one document and get the same result. Texts of fewer than ``lines`` lines, empty
    and null ones stay as they are. Lines are compared exactly. A text of which all lines are
    covered becomes empty.
    """
    return lines_removed(docs, covered_lines(docs, lines))


def without_repeated_lines(docs: DataFrame, lines: int = LINES) -> DataFrame:
    """``docs`` with the cleaned text, and n_chars, if there, counted again."""
    return with_text(docs, deduplicated(docs, lines))
