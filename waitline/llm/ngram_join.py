"""Jaccard join of documents on word n-grams, by signature trees."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waitline.llm.batches import slices
from waitline.llm.linking import (
    Threshold,
    components,
    mixed,
    present,
    presence,
    star_edges,
    verified_links,
)
from waitline.llm.shingles import set_number, shingle_set, words_of
from waitline.llm.staging import drop, stage

WORDS = 4
PERCENT = 85
#: Postings of a chunk that are gathered before they leave a task.
CHUNK = 1_000_000
#: Tenths of a set that two linked sets share of their keys. More tell more pairs apart, and are
#: more to shuffle.
SHARED_TENTHS = 3


class Signatures:
    """Keys of sets: their first tokens in the order of a hash, about half of them.

    Two linked sets have ``overlap`` tokens of either one in common at least. Of these ``k`` are
    among the first ``size - overlap + k`` of each. ``k`` grows with the size, so a set must share
    as many keys as the smallest set has that it may link with: ``least``.
    """

    def __init__(self, threshold: Threshold):
        self.percent = threshold.percent

    def overlap(self, size: int) -> int:
        """Tokens that a set has in common with any that links with it; also their least size."""
        return -(-self.percent * size // 100)

    def _shared(self, size: int) -> int:
        return min(self.overlap(size), max(1, size * SHARED_TENTHS // 10))

    def least(self, size: int) -> int:
        """How many keys a set of this size shares with each set that links with it."""
        return self._shared(self.overlap(size))

    def keys(self, tokens: np.ndarray) -> np.ndarray:
        """Keys of a sorted set; two sets that link and are not equal share ``least`` of them."""
        size = len(tokens)
        if 100 * size < self.percent * (size + 1):
            return np.zeros(0, np.int64)
        count = size - self.overlap(size) + self._shared(size)
        return np.sort(mixed(tokens))[:count].view(np.int64)


def set_rows(docs: DataFrame, keep: list[str], words: int) -> DataFrame:
    """``doc`` (a struct of ``keep``), ``node`` and ``n_shingles`` of each document.

    The node is a number of the set of shingles, equal for equal sets and null for the empty
    one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sets = [shingle_set(words_of(x), words) for x in batch.column("text").to_pylist()]
            nodes = [set_number(s) if len(s) else None for s in sets]
            sizes = [len(s) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64())],
                ["doc", "node", "n_shingles"],
            )

    rows = docs.select(F.struct(*keep).alias("doc"), "text")
    kind = rows.schema["doc"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc {kind}, node long, n_shingles long")


def _postings(docs: DataFrame, words: int, threshold: Threshold) -> DataFrame:
    """Rows of ``key, node, least``: the keys of all sets, and how many must be shared."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signatures = Signatures(threshold)
        held: dict[int, np.ndarray] = {}
        least: list[int] = []
        count = 0

        def gathered() -> pa.RecordBatch:
            sizes = [len(keys) for keys in held.values()]
            columns = [
                np.concatenate(list(held.values())),
                np.repeat(np.fromiter(held, np.int64, len(held)), sizes),
                np.repeat(np.array(least, np.int32), sizes),
            ]
            return pa.RecordBatch.from_arrays(
                [pa.array(c) for c in columns], ["key", "node", "least"]
            )

        for batch in slices(batches, "text"):
            for text in batch.column("text").to_pylist():
                tokens = shingle_set(words_of(text), words)
                if not len(tokens) or (node := set_number(tokens)) in held:
                    continue
                held[node] = signatures.keys(tokens)
                least.append(signatures.least(len(tokens)))
                count += len(held[node])
            if count >= CHUNK:
                yield gathered()
                held, least, count = {}, [], 0
        if held:
            yield gathered()

    return docs.select("text").mapInArrow(run, "key long, node long, least int")


def _rarest(postings: DataFrame) -> DataFrame:
    """Rows of ``key, node``: of the keys that sets share, those that decide about links.

    A set that shares ``m`` keys with any others links with none if ``m < least``. Else each set
    that links with it shares one of its ``m - least + 1`` rarest keys, in one order for all sets.
    Passages that many texts have are the last in it.
    """
    times = F.count("*").over(Window.partitionBy("key"))
    return (
        postings.withColumn("times", times)
        .filter("times > 1")
        .groupBy("node")
        .agg(F.sort_array(F.collect_set(F.struct("times", "key"))).alias("shared"), F.max("least").alias("least"))
        .filter(F.size("shared") >= F.col("least"))
        .withColumn("first", F.slice("shared", F.lit(1), F.size("shared") - F.col("least") + 1))
        .select("node", F.explode("first.key").alias("key"))
    )


def _sets_of(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """``node, tokens`` of the documents whose doc_id is wanted, and of a few others."""
    bits = docs.sparkSession.sparkContext.broadcast(presence(wanted, "doc_id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            maybe = present(bits.value, batch.column("hash").to_numpy())
            texts = batch.filter(pa.array(maybe)).column("text").to_pylist()
            sets = [s for text in texts if len(s := shingle_set(words_of(text), words))]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([set_number(s) for s in sets], pa.int64()),
                    pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
                ],
                ["node", "tokens"],
            )

    rows = docs.select("text", F.xxhash64("doc_id").alias("hash"))
    return rows.mapInArrow(run, "node long, tokens array<long>")


def joined(
    docs: DataFrame,
    words: int = WORDS,
    percent: int = PERCENT,
    keep: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """``doc`` (a struct of ``keep``), ``n_shingles`` and ``component_id`` of each document.

    Documents link if ``percent`` of the union of their shingle sets is common; the component is
    the smallest doc_id that links reach, and the documents with an equal set. A null or empty
    text, or one without words, has the empty set and is alone, and so is every text that
    nothing links with: its component is its own doc_id. Rows without doc_id take part; their
    component is the smallest doc_id there, or null.

    Equal sets become one node. Nodes that can link share one of the rarest of their keys (see
    ``Signatures`` and ``_rarest``), which makes candidate components; in these, signature trees
    find the links exactly. What is shuffled is about half a number per shingle, and the sets of
    candidates.
    """
    threshold = Threshold(percent)
    rows = stage(set_rows(docs, list(keep), words))
    candidates = components(star_edges(_rarest(_postings(docs, words, threshold))))
    named = rows.select(F.col("doc.doc_id").alias("doc_id"), "node", "n_shingles")
    wanted = stage(
        named.join(candidates, "node")
        .groupBy("node", F.col("component").alias("candidate"))
        .agg(F.min("doc_id").alias("doc_id"), F.max("n_shingles").alias("size"))
    )
    drop(candidates)
    links = verified_links(
        _sets_of(docs, wanted, words), threshold, sizes=wanted.drop("doc_id")
    )
    labels = components(links)
    drop(wanted)
    label = F.coalesce("component", "node").alias("label")
    labelled = rows.join(labels, "node", "left").select("doc", "n_shingles", label)
    groups = (
        labelled.filter("label IS NOT NULL")
        .groupBy(F.col("label").alias("of"))
        .agg(F.min("doc.doc_id").alias("least"), F.count("*").alias("rows"))
        .filter("rows > 1")
    )
    return labelled.join(groups, F.col("label") == F.col("of"), "left").select(
        "doc",
        "n_shingles",
        F.when(F.col("of").isNull(), F.col("doc.doc_id")).otherwise(F.col("least")).alias("component_id"),
    )


def one_of_each(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of each component, of its smallest doc_id.

    Of several texts under the smallest doc_id the one with the smallest hash stays, and of rows
    equal in doc_id and text any one. Rows without words stay, repeated ones too. All columns are
    returned, whatever their names; none of them is used but doc_id and text.

    Which rows go is worked out from ids and hashes and stored, so Spark knows the size of what
    it joins to the texts; as long as that is small, no text is shuffled.
    """
    columns, prefix = docs.columns, "of_"
    while any(c.startswith(prefix) for c in columns):
        prefix = f"_{prefix}"
    text_hash, id_there, hash_there = (f"{prefix}{n}" for n in ("hash", "there", "hash_there"))
    prints = docs.select("*", F.xxhash64("text").alias(text_hash))
    result = joined(
        prints.select("doc_id", "text", text_hash), words, percent, keep=("doc_id", text_hash)
    )
    place = F.struct(F.col("doc.doc_id").isNull().alias("unnamed"), "doc.doc_id",
                     F.col(f"doc.{text_hash}").alias("hash"))
    places = stage(
        result.filter("n_shingles > 0")
        .groupBy("component_id", place.alias("place"))
        .agg(F.count("*").alias("rows"))
    )
    first = places.groupBy(F.col("component_id").alias("of")).agg(
        F.min("place").alias("first"), F.sum("rows").alias("rows_there")
    )
    named = [F.col("place.doc_id").alias(id_there), F.col("place.hash").alias(hash_there)]
    touched = stage(
        places.join(first.filter("rows_there > 1"), F.col("component_id").eqNullSafe(F.col("of")))
        .filter((F.col("place") != F.col("first")) | (F.col("rows") > 1))
        .select(*named, (F.col("place") == F.col("first")).alias("is_first"))
    )
    drop(places)
    same = F.col("doc_id").eqNullSafe(F.col(id_there)) & (F.col(text_hash) == F.col(hash_there))
    kept = prints.join(touched, same, "left_anti")
    repeated = touched.filter("is_first")
    if not repeated.isEmpty():
        some = prints.join(repeated, same, "left_semi").dropDuplicates(["doc_id", text_hash])
        kept = kept.unionByName(some)
    return kept.select(*[F.col(f"`{c}`") for c in columns])
