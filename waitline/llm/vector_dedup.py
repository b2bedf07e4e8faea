"""Vectors that are near copies of each other, found by searching a graph of all of them.

Equal vectors are one node with a number of copies, however many there are. Nodes are dealt to
overlapping shards by centers fitted to a sample, again for shards that are too large; each shard
makes a robust-pruned graph of its nodes, and the neighbours that a node has in all its shards are
united. Every node is then searched for, from the medoids of its shards and of the next nearest
ones, and the search goes on as long as it reaches vectors in range. What it links is contracted
to components; within those all pairs are verified in double precision, block against block, so
that a node's number of links is exact for its component and the same from both ends. At last
nodes are compared with all others to audit the recall, and the search is widened if it is low.

Vectors that are null, empty or zero, or hold null or non-finite components, link with nothing.
Vectors of different lengths do not link. Repeated rows are vectors of their own, so they are
links of each other. A null id is no component's name, unless no member has an id. An empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waitline.llm import vector_graph
from waitline.llm.linking import components, runs_of
from waitline.llm.staging import stage

LEAST = 0.95
#: Of the search in 32-bit floats; what it finds is verified in doubles.
SLACK = 1e-4
#: Nodes of a shard at most, and on average after it is split; rows that centers are fitted to.
SHARD_MOST = 4_000
SHARD_MEAN = 2_000
SALT_ROWS = 50_000
MOST_CENTERS = 256
SAMPLE = 4_096
MOST_LEVELS = 8
ROUNDS = 6
#: Shards besides a node's own two in which it is searched for, at first.
VISITS = 1
#: Nodes compared with all others, and the part of their links that must have been found.
AUDITED = 1_024
LEAST_RECALL = 0.97
WIDENINGS = 2
BLOCK = 2_048
HOME, OVERLAP, VISITOR = range(3)


def unit(rows: pa.RecordBatch | pa.Table) -> np.ndarray:
    """The vectors of rows, all of one length, as doubles of length 1."""
    column = rows.column("embedding")
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    values = column.flatten().to_numpy().astype(np.float64).reshape(rows.num_rows, -1)
    values = values / np.abs(values).max(1, keepdims=True)
    return values / np.linalg.norm(values, axis=1, keepdims=True)


def _usable(vector: Column) -> Column:
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _batch(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns.values()], list(columns))


# Shards.


def _centers(vectors: np.ndarray, count: int) -> np.ndarray:
    """Centers of cells of similar directions; the same for the same vectors in one order."""
    centers = vectors[np.linspace(0, len(vectors) - 1, count).astype(int)]
    for _ in range(ROUNDS):
        cell = (vectors @ centers.T).argmax(1)
        sums = np.zeros_like(centers)
        np.add.at(sums, cell, vectors)
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centers = np.where(norms > 0, sums / np.maximum(norms, 1e-30), centers)
    return centers


def _fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in runs_of(batches, "shard"):
        centers = _centers(unit(rows), min(rows["count"][0].as_py(), rows.num_rows))
        yield _batch(shard=[rows["shard"][0].as_py()], centers=[centers.tolist()])


def _assign(visits: int):
    """Rows of a shard to the shards of the centers, the first row of each run being those.

    A node goes home to the nearest and overlaps to the next; where it only overlaps or visits it
    goes to the nearest alone, so a node has few rows however often shards are split.
    """

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centers = np.zeros((0, 0))
        for batch in batches:
            heads = np.flatnonzero(
                batch.column("centers").is_valid().to_numpy(zero_copy_only=False)
            )
            cuts = [0, *heads, batch.num_rows]
            for start, stop in zip(cuts, cuts[1:], strict=False):
                rows = batch.slice(start, stop - start)
                if rows.num_rows and start in heads:
                    centers = np.array(rows.column("centers")[0].as_py())
                    rows = rows.slice(1)
                if rows.num_rows:
                    yield from assigned(rows, centers)

    def assigned(rows: pa.RecordBatch, centers: np.ndarray) -> Iterator[pa.RecordBatch]:
        order = np.argsort(-(unit(rows) @ centers.T), 1, kind="stable")
        role = rows.column("role").to_numpy()
        for place in range(min(2 + visits, len(centers))):
            part = np.flatnonzero((role == HOME) | (place == 0))
            taken = rows.take(pa.array(part))
            shards = zip(taken.column("shard").to_pylist(), order[part, place], strict=True)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([f"{shard}.{child}" for shard, child in shards], pa.string()),
                    taken.column("node"),
                    pa.array(np.maximum(role[part], min(place, VISITOR)), pa.int32()),
                    taken.column("embedding"),
                ],
                ["shard", "node", "role", "embedding"],
            )

    return assign


def _split(dealt: DataFrame, large: DataFrame, visits: int) -> DataFrame:
    """The rows, those of large shards dealt to new ones."""
    of = large.withColumnRenamed("shard", "of")
    rows = dealt.join(of, F.col("shard") == F.col("of")).drop("of")
    place = F.row_number().over(Window.partitionBy("shard").orderBy(F.xxhash64("node"), "node"))
    count = F.least(F.lit(MOST_CENTERS), F.ceil(F.col("n_nodes") / SHARD_MEAN)).cast("int")
    centers = (
        rows.filter(F.col("role") == HOME)
        .select("shard", "node", count.alias("count"), "embedding", place.alias("place"))
        .filter(F.col("place") <= SAMPLE)
        .repartition("shard")
        .sortWithinPartitions("shard", "place")
        .mapInArrow(_fit, "shard string, centers array<array<double>>")
    )
    salts = F.ceil(F.col("n_nodes") / SALT_ROWS).cast("int")
    heads = centers.join(of, F.col("shard") == F.col("of")).select(
        "shard", F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt"), "centers"
    )
    salted = rows.withColumn("salt", F.pmod(F.xxhash64(F.lit(1), "node"), salts).cast("int"))
    split = (
        salted.drop("n_nodes")
        .unionByName(heads, allowMissingColumns=True)
        .repartition("shard", "salt")
        .sortWithinPartitions("shard", "salt", F.col("centers").isNull())
        .mapInArrow(_assign(visits), dealt.schema)
    )
    return dealt.join(of, F.col("shard") == F.col("of"), "left_anti").unionByName(split)


def sharded(nodes: DataFrame, visits: int = VISITS) -> DataFrame:
    """``shard, node, role, embedding``: each node at home, where it overlaps, and as a visitor."""
    dealt = nodes.select(
        F.size("embedding").cast("string").alias("shard"),
        "node",
        F.lit(HOME).alias("role"),
        "embedding",
    )
    for _ in range(MOST_LEVELS):
        large = stage(
            dealt.filter(F.col("role") == HOME)
            .groupBy("shard")
            .agg(F.count("*").alias("n_nodes"))
            .filter(F.col("n_nodes") > SHARD_MOST)
        )
        if large.isEmpty():
            break
        dealt = stage(_split(dealt, large, visits))
    return dealt


# The graph, and the search in it.


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in runs_of(batches, "shard"):
        graph = vector_graph.build(unit(rows).astype(np.float32))
        nodes = rows["node"].to_numpy()
        known = graph.links >= 0
        bounds = np.concatenate([[0], np.cumsum(known.sum(1))])
        yield pa.RecordBatch.from_arrays(
            [
                rows["shard"].combine_chunks(),
                pa.array(nodes),
                pa.ListArray.from_arrays(
                    pa.array(bounds, pa.int32()), pa.array(nodes[graph.links[known]])
                ),
            ],
            ["shard", "node", "neighbours"],
        )


def adjacency(dealt: DataFrame) -> DataFrame:
    """``shard, node, neighbours``: the neighbours in any shard of a node, in each of its shards."""
    members = dealt.filter(F.col("role") < VISITOR).select("shard", "node", "embedding")
    built = (
        members.repartition("shard")
        .sortWithinPartitions("shard", "node")
        .mapInArrow(_build, "shard string, node long, neighbours array<long>")
    )
    return (
        built.groupBy("node")
        .agg(
            F.array_distinct(F.flatten(F.collect_list("neighbours"))).alias("neighbours"),
            F.collect_list("shard").alias("shards"),
        )
        .select(F.explode("shards").alias("shard"), "node", "neighbours")
    )


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every end of the pairs the smallest that they connect it to, and itself."""
    ends, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    label = np.arange(len(ends))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    other = label != np.arange(len(ends))
    return ends[label[other]], ends[other]


def _graph_of(rows: pa.Table) -> tuple[vector_graph.Graph, np.ndarray, pa.Table, pa.Table]:
    """The graph of a shard's members, their numbers, the members, and all that are searched."""
    searched = rows.filter(rows["role"].is_valid())
    members = searched.filter(pc.less(searched["role"], VISITOR)).sort_by("node")
    edges = rows.filter(rows["role"].is_null()).sort_by("node")
    nodes = members["node"].to_numpy()
    lists = edges["neighbours"].combine_chunks()
    of = pc.list_parent_indices(lists).to_numpy()
    to = lists.flatten().to_numpy()
    at = np.minimum(np.searchsorted(nodes, to), len(nodes) - 1)
    here = nodes[at] == to
    of, at = of[here], at[here]
    place = np.arange(len(of)) - np.searchsorted(of, of)
    links = np.full((len(nodes), place.max(initial=0) + 1), -1, np.int32)
    links[of, place] = at
    vectors = unit(members).astype(np.float32)
    graph = vector_graph.Graph(vectors, links, vector_graph.medoids(vectors))
    return graph, nodes, members, searched


def _search(least: float, width: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in runs_of(batches, "shard"):
            graph, nodes, members, searched = _graph_of(rows)
            exact, queries = unit(members), unit(searched)
            query_nodes = searched["node"].to_numpy()
            none = np.zeros(0, np.int64)
            found = (none, none)
            for q, v in vector_graph.within(
                graph, queries.astype(np.float32), least - SLACK, width
            ):
                links = [found]
                for start in range(0, len(q), vector_graph.PAIRS):
                    i, j = q[start : start + vector_graph.PAIRS], v[start : start + vector_graph.PAIRS]
                    near = np.einsum("ij,ij->i", queries[i], exact[j]) >= least
                    links.append((query_nodes[i[near]], nodes[j[near]]))
                found = stars(*(np.concatenate(ends) for ends in zip(*links, strict=True)))
            yield _batch(a=found[0], b=found[1])

    return search


def linked(dealt: DataFrame, least: float, width: int) -> DataFrame:
    """``a, b``: links that connect whatever the search connects; few of a dense group."""
    rows = dealt.unionByName(adjacency(dealt), allowMissingColumns=True)
    return (
        rows.repartition("shard")
        .sortWithinPartitions("shard", "node")
        .mapInArrow(_search(least, width), "a long, b long")
    )


# Verified counts and the audit.


def _count(least: float):
    """Links of nodes with others of their component, between two blocks or within one."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in runs_of(batches, "task"):
            vectors, copies = unit(rows), rows["copies"].to_numpy()
            block, nodes = rows["block"].to_numpy(), rows["node"].to_numpy()
            own, others = np.flatnonzero(block == block.min()), np.flatnonzero(block == block.max())
            n_links = np.zeros(len(nodes), np.int64)
            for start in range(0, len(own), BLOCK):
                part = own[start : start + BLOCK]
                near = vectors[part] @ vectors[others].T >= least
                if block[own[0]] == block[others[0]]:
                    n_links[part] = near @ copies[others] - copies[part]
                else:
                    n_links[part] += near @ copies[others]
                    n_links[others] += near.T @ copies[part]
            yield _batch(node=nodes, n_links=n_links)

    return count


def counted(nodes: DataFrame, labels: DataFrame, least: float) -> DataFrame:
    """``node, n_links`` of the nodes of components, by all pairs of each component."""
    of = labels.select(F.col("node").alias("of"), "component")
    sizes = labels.groupBy(F.col("component").alias("whole")).agg(
        F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")
    )
    block = F.pmod(F.xxhash64(F.lit(2), "node"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    rows = (
        nodes.join(of, F.col("node") == F.col("of"))
        .join(sizes, F.col("component") == F.col("whole"))
        .select("component", "node", "copies", "embedding", block.alias("block"), other)
        .withColumn(
            "task",
            F.concat_ws(
                ".", "component", F.least("block", "other"), F.greatest("block", "other")
            ),
        )
    )
    return (
        rows.select("task", "node", "block", "copies", "embedding")
        .repartition("task")
        .sortWithinPartitions("task", "block", "node")
        .mapInArrow(_count(least), "node long, n_links long")
        .groupBy("node")
        .agg(F.sum("n_links").alias("n_links"))
    )


def audit(nodes: DataFrame, counts: DataFrame, least: float) -> float:
    """The part found of all links of ``AUDITED`` nodes, which are compared with every node."""
    chosen = nodes.orderBy(F.xxhash64(F.lit(3), "node"), "node").limit(AUDITED).toArrow()

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = pc.list_value_length(chosen["embedding"])
        for batch in batches:
            for length in set(lengths.to_pylist()):
                ours = chosen.filter(pc.equal(lengths, length))
                of_length = pc.list_value_length(batch.column("embedding"))
                theirs = batch.filter(pc.equal(of_length, length))
                if not theirs.num_rows:
                    continue
                near = unit(ours) @ unit(theirs).T >= least
                near &= ours["node"].to_numpy()[:, None] != theirs.column("node").to_numpy()
                yield _batch(
                    node=ours["node"].combine_chunks(),
                    there=near @ theirs.column("copies").to_numpy(),
                )

    there = nodes.mapInArrow(compare, "node long, there long").groupBy("node").agg(
        F.sum("there").alias("there")
    )
    known = counts.select(F.col("node").alias("of"), "n_links")
    row = (
        there.join(known, F.col("node") == F.col("of"), "left")
        .agg(F.sum("there"), F.sum(F.least("there", F.coalesce("n_links", F.lit(0)))))
        .first()
    )
    return row[1] / row[0] if row[0] else 1.0


def node_table(rows: DataFrame) -> DataFrame:
    """``node, least_id, copies, embedding`` of the distinct usable vectors of ``row, vec_id``."""
    return (
        rows.filter("usable")
        .groupBy("embedding")
        .agg(
            F.min("row").alias("node"),
            F.min("vec_id").alias("least_id"),
            F.count("*").alias("copies"),
        )
        .select("node", "least_id", "copies", "embedding")
    )


def near_copies(
    vectors: DataFrame, least: float = LEAST, least_recall: float = LEAST_RECALL
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for each row of ``vec_id, embedding``."""
    rows = stage(
        vectors.select(
            "vec_id",
            "embedding",
            F.monotonically_increasing_id().alias("row"),
            _usable(F.col("embedding")).alias("usable"),
        )
    )
    nodes = stage(node_table(rows))
    visits, width = VISITS, vector_graph.BEAM
    for widened in range(WIDENINGS + 1):
        dealt = sharded(nodes, visits)
        labels = components(linked(dealt, least, width))
        counts = stage(counted(nodes, labels, least))
        if widened == WIDENINGS or audit(nodes, counts, least) >= least_recall:
            break
        visits, width = 4 * visits, 2 * width
    found = (
        nodes.join(counts.withColumnRenamed("node", "of"), F.col("node") == F.col("of"), "left")
        .drop("of")
        .join(labels.withColumnRenamed("node", "of"), F.col("node") == F.col("of"), "left")
        .select(
            F.col("embedding").alias("of_embedding"),
            "least_id",
            F.coalesce("component", "node").alias("component"),
            (F.coalesce("n_links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        )
    )
    names = found.groupBy(F.col("component").alias("of")).agg(
        F.min("least_id").alias("component_id")
    )
    named = found.join(names, F.col("component") == F.col("of")).select(
        "of_embedding", "n_links", "component_id"
    )
    component_id = F.when(F.col("usable"), F.col("component_id")).otherwise(F.col("vec_id"))
    same = F.col("usable") & (F.col("embedding") == F.col("of_embedding"))
    return rows.join(stage(named), same, "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component_id.alias("component_id"),
        F.coalesce(F.col("vec_id") == component_id, F.lit(False)).alias("kept"),
    )
