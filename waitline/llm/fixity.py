"""Fixity audit of archive replicas by Merkle trees over records and offset ranges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waitline.llm.staging import stage

#: Bytes of an archive file below one leaf node, and children of a node.
LEAF_BYTES = 1 << 16
FANOUT = 16


def record_hashes(records: DataFrame, leaf_bytes: int = LEAF_BYTES) -> DataFrame:
    """``file, offset, length, digest, leaf``: one row per record of ``file, offset, record``.

    The digest is SHA-256 of the record's bytes; the leaf is the range of offsets it begins in.
    A null record hashes as an empty one of length null; equal rows stay and count.
    """
    return records.select(
        "file",
        "offset",
        F.length("record").cast("long").alias("length"),
        F.sha2(F.coalesce(F.col("record"), F.encode(F.lit(""), "UTF-8")), 256).alias("digest"),
        _leaf(F.col("offset"), leaf_bytes).alias("leaf"),
    )


def _leaf(offset: Column, leaf_bytes: int = LEAF_BYTES) -> Column:
    return F.floor(F.coalesce(offset, F.lit(0)) / leaf_bytes).cast("long")


def _text(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit("-"))


def leaves(hashed: DataFrame) -> DataFrame:
    """``file, node, hash`` of the lowest ranges: hashes of their records in order of offset.

    Equal records are counted before the shuffle, so repeated rows do not gather in a node.
    """
    counted = hashed.groupBy("file", "leaf", "offset", "length", "digest").agg(
        F.count("*").alias("times")
    )
    record = F.concat_ws(":", _text("offset"), _text("length"), "digest", _text("times"))
    ordered = F.array_sort(F.collect_list(F.struct("offset", record.alias("record"))))
    return counted.groupBy("file", F.col("leaf").alias("node")).agg(
        F.sha2(F.array_join(F.transform(ordered, lambda r: r["record"]), "\n"), 256).alias("hash")
    )


def parents(nodes: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """The level above: each node hashes its children, ``fanout`` at most, with their places."""
    child = F.struct("node", F.concat_ws(":", _text("node"), "hash").alias("child"))
    ordered = F.array_sort(F.collect_list(child))
    return nodes.groupBy("file", F.floor(F.col("node") / fanout).cast("long").alias("node")).agg(
        F.sha2(F.array_join(F.transform(ordered, lambda r: r["child"]), "\n"), 256).alias("hash")
    )


def tree(hashed: DataFrame, fanout: int = FANOUT) -> list[DataFrame]:
    """The levels of the trees of all files, from the leaves to one root per file."""
    levels = [stage(leaves(hashed))]
    while (levels[-1].agg(F.max("node")).first()[0] or 0) > 0:
        levels.append(stage(parents(levels[-1], fanout)))
    return levels


def _mismatches(one: DataFrame, other: DataFrame) -> DataFrame:
    """``file, node`` of nodes that the two levels do not have alike."""
    right = other.select(
        F.col("file").alias("of"), F.col("node").alias("at"), F.col("hash").alias("other")
    )
    same_place = F.col("file").eqNullSafe(F.col("of")) & (F.col("node") == F.col("at"))
    return (
        one.join(right, same_place, "full")
        .filter(~F.col("hash").eqNullSafe(F.col("other")))
        .select(
            F.when(F.col("node").isNull(), F.col("of")).otherwise(F.col("file")).alias("file"),
            F.coalesce("node", "at").alias("node"),
        )
    )


def _below(nodes: DataFrame, suspects: DataFrame, fanout: int) -> DataFrame:
    """The nodes of a level whose parent is a suspect."""
    wanted = suspects.select(F.col("file").alias("of"), F.col("node").alias("parent"))
    under = F.floor(F.col("node") / fanout) == F.col("parent")
    return nodes.join(wanted, F.col("file").eqNullSafe(F.col("of")) & under, "left_semi")


def audit(one: DataFrame, other: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """Records in which two replicas differ, from their record hashes.

    Roots are compared first, then only the children of nodes that differ, down to the leaves; of
    those the records are compared. Returns ``file, offset, status`` with the lengths and digests
    of both: ``changed`` if both have the offset, ``missing`` if the other replica lacks it,
    ``extra`` if the first does. A replica without a file lacks all its records; two empty
    replicas have no differences. A null file is a file of its own.
    """
    trees = [tree(one, fanout), tree(other, fanout)]
    height = max(map(len, trees))
    for levels in trees:
        while len(levels) < height:
            levels.append(stage(parents(levels[-1], fanout)))
    suspects = stage(_mismatches(trees[0][-1], trees[1][-1]))
    for level in range(height - 2, -1, -1):
        left, right = (_below(levels[level], suspects, fanout) for levels in trees)
        suspects = stage(_mismatches(left, right))
    wanted = suspects.select(F.col("file").alias("of"), F.col("node").alias("at"))
    inside = F.col("file").eqNullSafe(F.col("of")) & (F.col("leaf") == F.col("at"))
    columns = ["file", "offset", "length", "digest"]
    left, right = (
        side.join(wanted, inside, "left_semi").groupBy(*columns).agg(F.count("*").alias("times"))
        for side in (one, other)
    )
    every = [*columns, "times"]
    right = right.select(*[F.col(c).alias(f"other_{c}") for c in every])
    pairs = left.join(right, [F.col(c).eqNullSafe(F.col(f"other_{c}")) for c in every], "full")
    only = pairs.filter(F.col("times").isNull() | F.col("other_times").isNull())
    here = F.col("times").isNotNull()
    place = only.select(
        F.when(here, F.col("file")).otherwise(F.col("other_file")).alias("file"),
        F.when(here, F.col("offset")).otherwise(F.col("other_offset")).alias("offset"),
        F.when(here, F.struct("length", "digest", "times")).alias("a"),
        F.when(~here, F.struct("other_length", "other_digest", "other_times")).alias("b"),
    )
    merged = place.groupBy("file", "offset").agg(
        F.max(F.col("a.length")).alias("length"),
        F.max(F.col("a.digest")).alias("digest"),
        F.max(F.col("b.other_length")).alias("other_length"),
        F.max(F.col("b.other_digest")).alias("other_digest"),
        F.count("a").alias("n_here"),
        F.count("b").alias("n_other"),
    )
    status = F.when(F.col("n_other") == 0, "missing").when(F.col("n_here") == 0, "extra")
    return merged.select(
        "file",
        "offset",
        status.otherwise("changed").alias("status"),
        "length",
        "digest",
        "other_length",
        "other_digest",
    )


def warc_record(page_id: Column, url: Column, html: Column) -> Column:
    """Bytes of the WARC record of a page; a null html is an empty payload."""
    payload = F.encode(F.coalesce(html, F.lit("")), "UTF-8")
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:"),
        F.coalesce(page_id.cast("string"), F.lit("-")),
        F.lit(">\r\nWARC-Target-URI: "),
        F.coalesce(url, F.lit("-")),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "),
        F.length(payload).cast("string"),
        F.lit("\r\n\r\n"),
    )
    return F.concat(F.encode(head, "UTF-8"), payload, F.encode(F.lit("\r\n\r\n"), "UTF-8"))


def warc_index(pages: DataFrame, per_file: int = 1_000) -> DataFrame:
    """Record hashes of the archive of ``page_id, url, html``, with page_id.

    A file has the pages of ``per_file`` consecutive ids, in order of id and then digest; pages
    without id are a file of their own. Only lengths and digests are shuffled, no payload.
    """
    record = warc_record(F.col("page_id"), F.col("url"), F.col("html"))
    number = F.floor(F.col("page_id") / per_file).cast("string")
    hashed = pages.select(
        "page_id",
        F.concat(F.lit("pages-"), F.coalesce(number, F.lit("none"))).alias("file"),
        record.alias("record"),
    ).select(
        "page_id",
        "file",
        F.length("record").cast("long").alias("length"),
        F.sha2("record", 256).alias("digest"),
    )
    before = (
        Window.partitionBy("file")
        .orderBy("page_id", "digest")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offset = F.coalesce(F.sum("length").over(before), F.lit(0))
    return hashed.withColumn("offset", offset).withColumn("leaf", _leaf(F.col("offset")))
