"""From equal keys to verified components of sets, without pairs of all members of a group.

Nodes are numbers of distinct sets. Sets that share a key, directly or through others, form a
candidate component; keys are chosen by the caller so that two sets that must be compared share
one. Within candidate components sets are compared exactly, block by block, by signature trees.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waitline.llm.signature_tree import Sets, linked
from waitline.llm.staging import drop, stage

#: Tokens of a block at most, 24 MB. Each block meets every compatible one of its component, so
#: smaller ones are sent more often.
BLOCK_TOKENS = 3_000_000
BITMAP_BITS = 1 << 26
#: Sets of a candidate component that is compared together with others, and tokens of these.
FEW_SETS = 8
TOKENS_AT_ONCE = 500_000


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of the edges ``a, b``; null-free longs.

    Each round every node takes the smallest of itself and its neighbours, and the edges are
    contracted to those between what was taken. A round more than halves a path, so there are
    few; each is written to the shared folder. The component is one of its nodes.
    """
    edges = stage(edges.filter("a <> b").distinct())
    nodes = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    labels = stage(nodes.select("node", F.col("node").alias("component")))
    while not edges.isEmpty():
        before = (edges, labels)
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        taken = stage(
            both.groupBy(F.col("a").alias("from"))
            .agg(F.min("b").alias("least"))
            .select("from", F.least("from", "least").alias("to"))
        )
        ends = [taken.toDF(f"{end}_from", f"{end}_to") for end in "ab"]
        edges = stage(
            edges.join(ends[0], F.col("a") == F.col("a_from"))
            .join(ends[1], F.col("b") == F.col("b_from"))
            .select(F.least("a_to", "b_to").alias("a"), F.greatest("a_to", "b_to").alias("b"))
            .filter("a <> b")
            .distinct()
        )
        labels = stage(
            labels.join(taken, F.col("component") == F.col("from"), "left").select(
                "node", F.coalesce("to", "component").alias("component")
            )
        )
        drop(taken, *before)
    drop(edges)
    return labels


def star_edges(postings: DataFrame) -> DataFrame:
    """An edge from every node of a key to the key's smallest node, from rows of ``key, node``."""
    least = F.min("node").over(Window.partitionBy("key"))
    return (
        postings.select("node", least.alias("least"))
        .filter("node <> least")
        .select(F.col("least").alias("a"), F.col("node").alias("b"))
    )


def local_stars(keys: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Postings of a chunk, with the members of each key gathered on the chunk's smallest node.

    The others of a key follow as a key of their own with that node, once for all keys that
    have the two. So a key that a third of all rows have is one posting per chunk.
    """
    order = np.lexsort((nodes, keys))
    keys, nodes = keys[order], nodes[order]
    first = np.ones(len(keys), bool)
    first[1:] = keys[1:] != keys[:-1]
    lead = nodes[first][np.cumsum(first) - 1] if len(keys) else nodes
    others = lead != nodes
    pairs = np.unique(np.stack([lead[others], nodes[others]], 1), axis=0)
    own = mixed(pairs[:, 0].view(np.uint64) * np.uint64(3) + mixed(pairs[:, 1].view(np.uint64)))
    own = own.view(np.int64)
    return (
        np.concatenate([keys[first], own, own]),
        np.concatenate([nodes[first], pairs[:, 0], pairs[:, 1]]),
    )


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads neighbouring ones."""
    values = (values ^ (values >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    values = (values ^ (values >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return values ^ (values >> np.uint64(32))


@dataclass(frozen=True)
class Threshold:
    """Two sets link if 100 * intersection >= percent * union."""

    percent: int

    def least_overlap(self, total: np.ndarray | int) -> np.ndarray | int:
        """Smallest intersection that links two sets of together ``total`` elements."""
        return -(-self.percent * total // (100 + self.percent))

    def most_apart(self, total: int) -> int:
        """Bound of the symmetric difference of linked sets of together ``total`` elements."""
        return (100 - self.percent) * total // (100 + self.percent)

    def classes(self, largest: int) -> list[int]:
        """Starts of size classes; linked sets lie in one class or in neighbouring ones."""
        starts = [1, 2]
        while starts[-1] <= largest:
            starts.append(max(starts[-1] + 1, (starts[-1] - 1) * 100 // self.percent + 1))
        return starts


def presence(numbers: DataFrame, column: str) -> np.ndarray:
    """A bitmap of fixed size (8 MB) of the hashes of a column, made by Spark.

    It lets a later pass leave out most rows that are not among them; it never leaves out one
    that is. The exact check is a join.
    """
    slot = (F.pmod(F.xxhash64(column), F.lit(BITMAP_BITS)) + 1).alias("slot")
    rows = (
        numbers.select(slot)
        .groupBy(F.bitmap_bucket_number("slot").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits"))
        .collect()
    )
    per_bucket = 32_768
    bits = np.zeros(BITMAP_BITS // 8, np.uint8)
    for row in rows:
        at = (row["bucket"] - 1) * per_bucket // 8
        bits[at : at + per_bucket // 8] |= np.frombuffer(row["bits"], np.uint8)
    return bits


def present(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which of the hashes (``xxhash64`` of the column) may be in the bitmap."""
    slots = np.mod(hashes, BITMAP_BITS)
    return (bits[slots // 8] >> (slots % 8).astype(np.uint8)) & 1 == 1


def verified_links(
    members: DataFrame,
    threshold: Threshold,
    block_tokens: int = BLOCK_TOKENS,
    *,
    sizes: DataFrame | None = None,
) -> DataFrame:
    """Links ``a, b`` that connect what the threshold connects, from ``node, candidate, tokens``.

    ``tokens`` are sorted arrays of distinct longs, one row per node. A candidate component of up
    to ``block_tokens`` tokens is one block. A larger one is cut by size class and salt, its
    blocks are compared within themselves, and then in pairs of compatible size classes of which
    not all members are connected yet. Every pair of sets that could link is compared or is
    already connected, so no connection is lost; few links of a dense group are returned.

    Blocks are worked out from ``sizes`` (``node, candidate, size``), small rows, so that the
    tokens themselves only go to their blocks; where it is not given it is made of the members.
    With it, ``members`` needs no candidates, and rows of nodes without a size are left out.
    """
    given = sizes is not None
    if not given:
        members = stage(members)
        sizes = members.select("node", "candidate", F.size("tokens").alias("size"))
    sizes = stage(sizes)
    largest = sizes.agg(F.max("size")).first()[0] or 0
    starts = threshold.classes(largest)
    bounds = F.array(*[F.lit(s) for s in starts])
    of_size = F.size(F.filter(bounds, lambda start: start <= F.col("size")))
    totals = sizes.groupBy("candidate").agg(F.sum("size").alias("total"))
    shape = (
        sizes.groupBy("candidate", of_size.alias("class"))
        .agg(F.sum("size").alias("tokens_here"))
        .join(totals.toDF("of", "total"), F.col("candidate") == F.col("of"))
        .select(
            F.col("candidate").alias("shape_of"),
            F.col("class").alias("shape_class"),
            (F.col("total") > block_tokens).alias("large"),
            F.ceil(F.col("tokens_here") / block_tokens).cast("int").alias("salts"),
        )
    )
    salt = F.pmod(F.xxhash64(F.lit(5), "node"), F.col("salts").cast("long")).cast("int")
    places = stage(
        sizes.withColumn("class", of_size)
        .join(
            shape,
            (F.col("candidate") == F.col("shape_of")) & (F.col("class") == F.col("shape_class")),
        )
        .select(
            F.col("node").alias("place_of"),
            "candidate",
            F.when(F.col("large"), F.col("class")).otherwise(0).alias("class"),
            F.when(F.col("large"), salt).otherwise(0).alias("salt"),
        )
    )
    drop(sizes)
    blocked = stage(
        members.select("node", "tokens")
        .join(places, F.col("node") == F.col("place_of"))
        .dropDuplicates(["node"])
        .select(
            "node",
            "candidate",
            "tokens",
            "class",
            "salt",
            F.lit(0).alias("side"),
            F.col("node").alias("label"),
        )
    )
    drop(places, *([] if given else [members]))
    block = ["candidate", "class", "salt"]
    own = blocked.withColumn("task", F.xxhash64(*block))
    links = stage(_compared(own, threshold))
    if blocked.filter("class > 0").isEmpty():
        drop(blocked)
        return links
    known = components(links).select(F.col("node").alias("of_node"), F.col("component"))
    labelled = stage(
        blocked.filter("class > 0")
        .join(known, F.col("node") == F.col("of_node"), "left")
        .select(
            "node", "tokens", *block, F.coalesce("component", "node").alias("label")
        )
    )
    drop(blocked)
    blocks = labelled.groupBy(*block).agg(F.min("label").alias("low"), F.max("label").alias("high"))
    left = blocks.select(*[F.col(c).alias(f"{c}_a") for c in blocks.columns])
    right = blocks.select(*[F.col(c).alias(f"{c}_b") for c in blocks.columns])
    one_label = (
        (F.col("low_a") == F.col("high_a"))
        & (F.col("low_b") == F.col("high_b"))
        & (F.col("low_a") == F.col("low_b"))
    )
    follows = (F.col("class_b") == F.col("class_a") + 1) | (
        (F.col("class_b") == F.col("class_a")) & (F.col("salt_b") > F.col("salt_a"))
    )
    pairs = left.join(right, F.col("candidate_a") == F.col("candidate_b")).filter(
        follows & ~one_label
    )
    sides = pairs.select(
        F.xxhash64(*[f"{c}_{s}" for s in "ab" for c in block]).alias("task"),
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(n).alias("side"),
                        *[F.col(f"{c}_{s}").alias(f"of_{c}") for c in block],
                    )
                    for n, s in enumerate("ab")
                ]
            )
        ),
    )
    same_block = [F.col(c) == F.col(f"of_{c}") for c in block]
    spread = labelled.join(sides, same_block).select("task", "side", "node", "label", "tokens")
    more = stage(_compared(spread, threshold))
    drop(labelled)
    return links.unionByName(more)


def _compared(rows: DataFrame, threshold: Threshold) -> DataFrame:
    """Links found in each ``task``; sides 0 and 1 are compared with each other if both occur."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        small: list[pa.Table] = []
        count = 0
        for table in runs_of(batches, "task"):
            if table.num_rows == 1:
                continue
            if table.num_rows <= FEW_SETS and table.column("side")[-1].as_py() == 0:
                small.append(table.select(["node", "tokens"]))
                count += sum(len(c.flatten()) for c in table.column("tokens").chunks)
                if count >= TOKENS_AT_ONCE:
                    yield _links(_few_linked(small, threshold))
                    small, count = [], 0
                continue
            yield _links(linked(Sets.of(table), threshold))
        if small:
            yield _links(_few_linked(small, threshold))

    dealt = rows.select("task", "side", "node", "label", "tokens").repartition("task")
    return dealt.sortWithinPartitions("task", "side").mapInArrow(run, "a long, b long")


def _links(found: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], ["a", "b"])


def _few_linked(tables: list[pa.Table], threshold: Threshold) -> np.ndarray:
    """All links within each of many tables of few sets, by one sort of their tokens."""
    sizes = [t.num_rows for t in tables]
    rows = pa.concat_tables(tables)
    nodes = rows.column("node").to_numpy()
    tokens = pa.concat_arrays(rows.column("tokens").chunks)
    lengths = tokens.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    values = tokens.flatten().to_numpy(zero_copy_only=False)
    of_set = np.repeat(np.arange(len(nodes)), lengths)
    of_table = np.repeat(np.arange(len(sizes)), sizes)[of_set]
    order = np.lexsort((of_set, values, of_table))
    values, of_set, of_table = values[order], of_set[order], of_table[order]
    common = np.zeros(len(nodes) * FEW_SETS, np.int64)
    for step in range(1, max(sizes)):
        same = (values[step:] == values[:-step]) & (of_table[step:] == of_table[:-step])
        low, high = of_set[:-step][same], of_set[step:][same]
        common += np.bincount(low * FEW_SETS + high - low, minlength=len(common))
    low, apart = np.divmod(np.flatnonzero(common), FEW_SETS)
    high = low + apart
    link = common[common > 0] >= threshold.least_overlap(lengths[low] + lengths[high])
    return np.stack([nodes[low[link]], nodes[high[link]]], 1)


def runs_of(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables of the rows with one key, from rows sorted by it."""
    held: list[pa.RecordBatch] = []
    current = None
    for batch in batches:
        values = batch.column(key).to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero(values[1:] != values[:-1]) + 1
        for start, stop in zip([0, *cuts], [*cuts, len(values)], strict=True):
            if start == stop:
                continue
            if held and values[start] != current:
                yield pa.Table.from_batches(held)
                held = []
            current = values[start]
            held.append(batch.slice(start, stop - start))
    if held:
        yield pa.Table.from_batches(held)
