"""Nearest neighbours by a forest of sorted hash strings."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waitline.llm.linking import runs_of
from waitline.llm.staging import stage

SEED = 7


@dataclass(frozen=True)
class ForestPlan:
    """``trees`` arrays of strings of ``bits`` bits. ``sample`` queries, found exactly, tell how
    many candidates are needed for ``recall``. ``block`` rows of an array are one task's."""

    trees: int = 16
    bits: int = 48
    neighbours: int = 20
    recall: float = 0.96
    sample: int = 128
    block: int = 8_192


def valid_vectors(rows: DataFrame, id_column: str, column: str) -> DataFrame:
    """``id, vector`` of vectors that are not null, empty or zero and all finite."""
    usable = F.col(column).isNotNull() & F.forall(
        column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    )
    zero = F.forall(column, lambda x: x == 0)
    return rows.filter(usable & ~zero & F.col(id_column).isNotNull()).select(
        F.col(id_column).cast("long").alias("id"), F.col(column).alias("vector")
    )


def distinct_vectors(vectors: DataFrame, most: int) -> DataFrame:
    """``key, vector, ids``: equal vectors once, with the smallest ``most`` of their ids.

    Spark limits each vector's ids per task before the shuffle, so a vector that a third of all
    rows have is few rows. With ties going to smaller ids, ids beyond these are never among
    the ``most - 1`` nearest of any query.
    """
    place = F.row_number().over(Window.partitionBy("vector").orderBy("id"))
    few = vectors.distinct().withColumn("place", place).filter(F.col("place") <= most)
    return few.groupBy("vector").agg(
        F.min("id").alias("key"), F.array_sort(F.collect_list("id")).alias("ids")
    )


class Hashes:
    """Hash strings: signs of products with directions, orthogonal within a tree as far as the
    dimensions go. Vectors get one more component that makes all of one length, so that the
    angle to a query follows the inner product."""

    def __init__(self, dimensions: int, longest: float, plan: ForestPlan):
        self.longest, self.plan = longest, plan
        random = np.random.default_rng(SEED)
        shape = (dimensions + 1, min(plan.bits, dimensions + 1))
        drawn = []
        for _ in range(plan.trees):
            parts = [np.linalg.qr(random.normal(size=shape))[0] for _ in range(-(-plan.bits // shape[1]))]
            drawn.append(np.concatenate(parts, axis=1)[:, : plan.bits])
        self.directions = np.concatenate(drawn, axis=1)
        self.values = np.int64(1) << np.arange(plan.bits - 1, -1, -1, dtype=np.int64)

    def strings(self, vectors: np.ndarray, queries: bool) -> np.ndarray:
        """One row per vector, one string per tree as a number."""
        squares = (vectors**2).sum(axis=1)
        rest = 0 if queries else np.maximum(self.longest**2 - squares, 0)
        extended = np.column_stack([vectors, np.sqrt(rest) * np.ones(len(vectors))])
        signs = extended @ self.directions > 0
        return signs.reshape(len(vectors), self.plan.trees, self.plan.bits) @ self.values


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Vectors of one length as rows of doubles."""
    rows = len(column)
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks)
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(rows, -1)


def _hashed(vectors: DataFrame, hashes: Hashes, queries: bool) -> DataFrame:
    """``key, vector, strings``, one string per tree, and the vector's square as ``own``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                values = _matrix(batch.column("vector"))
                strings = pa.array(list(hashes.strings(values, queries)), pa.list_(pa.int64()))
                own = pa.array((values**2).sum(axis=1))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, strings, own], ["key", "vector", "strings", "own"]
                )

    kind = vectors.schema["vector"].dataType.simpleString()
    return vectors.select("key", "vector").mapInArrow(
        run, f"key long, vector {kind}, strings array<long>, own double"
    )


def _prefix(string: Column, depth: Column, bits: int) -> Column:
    """The first ``depth`` bits of a string as a number."""
    return F.floor(string / F.pow(F.lit(2.0), F.lit(bits) - depth)).cast("long")


def _by_tree(hashed: DataFrame) -> DataFrame:
    return hashed.select("key", "vector", F.posexplode("strings").alias("tree", "string"))


def _sizes(index: DataFrame, queries: DataFrame, deepest: int, bits: int) -> DataFrame:
    """``key, depth, size``: rows of all trees that share a prefix of that length with a query.

    Both sides of the join have a row per tree and depth for each row that Spark estimates their
    size from, so neither may be broadcast.
    """
    each = F.explode(F.sequence(F.lit(0), F.lit(deepest))).alias("depth")
    finest = (
        _by_tree(index.withColumn("vector", F.lit(None)))
        .groupBy("tree", _prefix(F.col("string"), F.lit(deepest), bits).alias("finest"))
        .agg(F.count("*").alias("rows"))
    )
    counts = (
        finest.select("tree", "finest", "rows", each)
        .groupBy("tree", "depth", _prefix(F.col("finest"), F.col("depth"), deepest).alias("prefix"))
        .agg(F.sum("rows").alias("rows"))
    )
    asked = _by_tree(queries.withColumn("vector", F.lit(None))).select("key", "tree", "string", each)
    return (
        asked.withColumn("prefix", _prefix(F.col("string"), F.col("depth"), bits))
        .join(counts.hint("merge"), ["tree", "depth", "prefix"])
        .groupBy("key", "depth")
        .agg(F.sum("rows").alias("size"))
    )


def _nearest_of_few(vectors: DataFrame, sample: list, count: int) -> list[np.ndarray]:
    """For each of a few queries the vectors of its nearest others, from a scan of all."""
    keys = np.array([row["key"] for row in sample])
    wanted = np.array([row["vector"] for row in sample], np.float64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                scores = wanted @ _matrix(batch.column("vector")).T
                scores[keys[:, None] == batch.column("key").to_numpy()] = -np.inf
                top = np.argsort(-scores, axis=1)[:, :count]
                number = np.repeat(np.arange(len(keys), dtype=np.int32), top.shape[1])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(number),
                        pa.array(np.take_along_axis(scores, top, 1).ravel()),
                        batch.column("vector").take(pa.array(top.ravel())),
                    ],
                    ["number", "score", "vector"],
                )

    kind = vectors.schema["vector"].dataType.simpleString()
    found = vectors.select("key", "vector").mapInArrow(
        run, f"number int, score double, vector {kind}"
    )
    place = F.row_number().over(Window.partitionBy("number").orderBy(F.desc("score")))
    rows = found.withColumn("place", place).filter(F.col("place") <= count)
    near: list[list] = [[] for _ in sample]
    for row in rows.collect():
        if row["score"] > float("-inf"):
            near[row["number"]].append(row["vector"])
    return [np.array(vs, np.float64) for vs in near]


def _enough(
    vectors: DataFrame, queries: DataFrame, sizes: DataFrame, total: int, hashes: Hashes, deepest: int
) -> int:
    """How many rows a query must gather for the plan's recall, from a sample of queries."""
    plan = hashes.plan
    least = plan.trees * (plan.neighbours + 1)
    chosen = queries.orderBy(F.xxhash64(F.lit(SEED), "key"), "key").limit(plan.sample)
    sample = chosen.select("key", "vector", "strings").collect()
    number = {row["key"]: n for n, row in enumerate(sample)}
    size = np.zeros((len(sample), deepest + 1))
    for row in sizes.filter(F.col("key").isin(list(number))).collect():
        size[number[row["key"]], row["depth"]] = row["size"]
    gathered = []
    for n, near in enumerate(_nearest_of_few(vectors, sample, plan.neighbours)):
        if len(near):
            strings = hashes.strings(near, queries=False)
            same = _common(strings, np.array(sample[n]["strings"]), plan.bits)
            gathered.append((same.max(axis=1), size[n]))
    most = total * plan.trees
    for enough in [max(least, int(most * share)) for share in np.geomspace(1e-6, 1, 80)]:
        hits = [(reached >= _depth(s, enough)).mean() for reached, s in gathered]
        if not hits or np.mean(hits) >= plan.recall:
            return enough
    return most


def _common(one: np.ndarray, other: np.ndarray, bits: int) -> np.ndarray:
    """Length of the common prefix of strings."""
    highest = np.floor(np.log2(np.maximum(one ^ other, 1).astype(np.float64))).astype(np.int64)
    return np.where(one == other, bits, bits - 1 - highest)


def _depth(sizes: np.ndarray, enough: int) -> int:
    """The longest prefix length at which all trees together have enough."""
    depths = np.flatnonzero(sizes >= enough)
    return int(depths[-1]) if len(depths) else 0


def _search(rows: DataFrame, plan: ForestPlan) -> DataFrame:
    """Best rows of each query in each task: ``key, near, score``.

    Side 0 has a part of a tree's sorted array, side 1 queries with the prefix length at which
    they read it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs_of(batches, "task"):
            table = table.sort_by([("side", "ascending"), ("string", "ascending")])
            cut = int(np.searchsorted(table.column("side").to_numpy(), 1))
            index, asked = table.slice(0, cut), table.slice(cut)
            if not cut or not asked.num_rows:
                continue
            keys, strings = index.column("key").to_numpy(), index.column("string").to_numpy()
            values, wanted = _matrix(index.column("vector")), _matrix(asked.column("vector"))
            free = np.int64(plan.bits) - asked.column("depth").to_numpy().astype(np.int64)
            low = (asked.column("string").to_numpy() >> free) << free
            start = np.searchsorted(strings, low)
            stop = np.searchsorted(strings, low + (np.int64(1) << free))
            ranges, owner = np.unique(np.stack([start, stop], 1), axis=0, return_inverse=True)
            for n, (first, last) in enumerate(ranges):
                if first == last:
                    continue
                mine = np.flatnonzero(owner.ravel() == n)
                scores = wanted[mine] @ values[first:last].T
                count = min(plan.neighbours + 1, last - first)
                top = np.argpartition(-scores, count - 1, axis=1)[:, :count]
                edge = np.take_along_axis(scores, top, 1).min(axis=1, keepdims=True)
                query, place = np.nonzero(scores >= edge)
                yield pa.RecordBatch.from_arrays(
                    [
                        asked.column("key").take(pa.array(mine[query])).combine_chunks(),
                        pa.array(keys[first + place]),
                        pa.array(scores[query, place]),
                    ],
                    ["key", "near", "score"],
                )

    dealt = rows.repartition("task").sortWithinPartitions("task")
    return dealt.mapInArrow(run, "key long, near long, score double")


def nearest(
    rows: DataFrame,
    query_ids: Column,
    id_column: str = "vec_id",
    column: str = "embedding",
    plan: ForestPlan = ForestPlan(),  # noqa: B008
) -> DataFrame:
    """``query_id, rank, id, score`` of each query's neighbours by inner product.

    Queries are the rows for which ``query_ids`` holds; all other rows are candidates. All valid
    vectors must have one length. Ties go to the smaller id; equal rows are one row; if an id
    has several vectors, all of them are candidates and queries, and the best score of a pair
    counts. Fewer candidates than asked for are all returned; an empty table gives none.

    Each tree sorts all vectors by a string of hash bits. A query descends to its longest prefix
    in every tree and ascends in all of them at once, one bit at a time, until the rows below
    the prefixes are enough. How many are enough is found on a bounded sample of queries whose
    neighbours a scan gives exactly. A tree's array is cut into blocks by the first bits; large
    blocks, and blocks that many queries read, are cut further.
    """
    most = plan.neighbours + 1
    vectors = valid_vectors(rows, id_column, column)
    index = stage(distinct_vectors(vectors, most))
    total = index.count()
    dimensions, longest = index.agg(
        F.max(F.size("vector")),
        F.max(F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") ** 2))),
    ).first()
    asking = vectors.join(rows.filter(query_ids).select(F.col(id_column).alias("id")).distinct(), "id")
    owners = stage(asking.distinct().join(index.select("vector", "key"), "vector").select("id", "key"))
    hashes = Hashes(dimensions or 1, longest or 1.0, plan)
    queried = owners.select("key").distinct().join(index, "key")
    queries = stage(_hashed(queried, hashes, queries=True))
    hashed = stage(_hashed(index, hashes, queries=False))
    deepest = min(plan.bits, max(0, int(np.ceil(np.log2(max(total, 1) / 8)))))
    sizes = stage(_sizes(hashed, queries, deepest, plan.bits))
    enough = _enough(index, queries, sizes, total, hashes, deepest)
    depths = sizes.filter(F.col("size") >= enough).groupBy("key").agg(F.max("depth").alias("depth"))
    found = _search(_tasks(hashed, queries, depths, total, plan), plan)
    own = queries.select("key", F.col("key").alias("near"), F.col("own").alias("score"))
    pairs = found.unionByName(own).groupBy("key", "near").agg(F.max("score").alias("score"))
    listed = pairs.join(index.select(F.col("key").alias("near"), "ids"), "near").select(
        "key", "score", F.explode("ids").alias("near_id")
    )
    best = F.row_number().over(Window.partitionBy("key").orderBy(F.desc("score"), "near_id"))
    few = listed.withColumn("place", best).filter(F.col("place") <= most)
    lists = few.groupBy("key").agg(F.collect_list(F.struct("near_id", "score")).alias("near"))
    answers = (
        owners.repartition("key")
        .join(lists, "key")
        .select(F.col("id").alias("query_id"), F.inline("near"))
        .filter("near_id <> query_id")
        .groupBy("query_id", "near_id")
        .agg(F.max("score").alias("score"))
    )
    rank = F.row_number().over(
        Window.partitionBy("query_id").orderBy(F.desc("score"), "near_id")
    )
    return (
        answers.withColumn("rank", rank)
        .filter(F.col("rank") <= plan.neighbours)
        .select("query_id", "rank", F.col("near_id").alias("id"), "score")
    )


def _tasks(
    hashed: DataFrame, queries: DataFrame, depths: DataFrame, total: int, plan: ForestPlan
) -> DataFrame:
    """Rows of both sides by task: a block of a tree, a salt of its rows, a part of its queries."""
    cut = min(plan.bits, max(0, int(np.ceil(np.log2(max(total, 1) / plan.block)))))
    array = _by_tree(hashed).withColumn("block", _prefix(F.col("string"), F.lit(cut), plan.bits))
    lengths = depths.select(F.col("key").alias("of"), "depth")
    width = F.pow(F.lit(2.0), F.greatest(F.lit(0), F.lit(cut) - F.col("depth"))).cast("long")
    first = _prefix(F.col("string"), F.least(F.lit(cut), F.col("depth")), plan.bits) * width
    asked = (
        _by_tree(queries)
        .join(lengths, F.col("key") == F.col("of"), "left")
        .withColumn("depth", F.coalesce("depth", F.lit(0)))
        .withColumn("block", F.explode(F.sequence(first, first + width - 1)))
    )
    parts = lambda n: F.ceil(n / plan.block).cast("int")
    shape = (
        array.groupBy("tree", "block")
        .agg(parts(F.count("*")).alias("salts"))
        .join(asked.groupBy("tree", "block").agg(parts(F.count("*")).alias("shares")), ["tree", "block"])
    )
    # Dealt out, since files tell little of how large it is in memory if it is broadcast.
    shape = stage(shape).repartition("tree", "block")
    part = lambda n: F.pmod(F.xxhash64("key"), n.cast("long")).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    salts, shares = F.col("salts"), F.col("shares")
    sides = [
        array.join(shape, ["tree", "block"])
        .withColumn("depth", F.lit(0))
        .withColumn("salt", part(salts))
        .withColumn("share", every(shares)),
        asked.join(shape, ["tree", "block"])
        .withColumn("share", part(shares))
        .withColumn("salt", every(salts)),
    ]
    task = F.xxhash64("tree", "block", "salt", "share").alias("task")
    both = [
        side.select(task, F.lit(n).alias("side"), "key", "string", F.col("depth").cast("int"), "vector")
        for n, side in enumerate(sides)
    ]
    return both[0].unionByName(both[1])
