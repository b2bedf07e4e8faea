"""Near copies of vectors against all pairs, and the graph that finds them."""

from __future__ import annotations

import numpy as np
import pytest
from tables import components

from waitline.llm import vector_dedup, vector_graph

ROWS = "vec_id long, embedding array<{}>, label int"


def clusters(seed, sizes, dims=24, spread=0.04):
    """Random unit vectors, with near copies of some of them."""
    rng = np.random.default_rng(seed)
    found = []
    for size in sizes:
        center = rng.normal(size=dims)
        center /= np.linalg.norm(center)
        found += [center + spread * rng.normal(size=dims) / 2 for _ in range(size)]
    order = rng.permutation(len(found))
    return np.array(found, np.float32)[order]


def plain(rows, least=0.95):
    """``vec_id, n_links, component_id, kept`` of every row, by all pairs."""
    usable = {}
    for n, (_, vector) in enumerate(rows):
        if vector and all(x is not None and np.isfinite(x) for x in vector) and any(vector):
            v = np.array(vector, np.float64)
            usable[n] = v / np.linalg.norm(v)

    def near(a, b):
        return len(usable[a]) == len(usable[b]) and usable[a] @ usable[b] >= least

    of = components(usable, near)
    found = []
    for n, (vec_id, _) in enumerate(rows):
        if n not in usable:
            found.append((vec_id, 0, vec_id, vec_id is not None))
            continue
        ids = [rows[m][0] for m in usable if of[m] == of[n] and rows[m][0] is not None]
        name = min(ids, default=None)
        n_links = int(sum(near(n, m) for m in usable if m != n))
        found.append((vec_id, n_links, name, vec_id is not None and vec_id == name))
    return sorted(found, key=str)


def found(spark, rows, kind="float", extra=False, **options):
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], ROWS.format(kind))
    if extra:
        for name in ("node", "row", "usable", "component", "n_links", "of", "shard"):
            df = df.selectExpr("*", f"'mine' AS `{name}`")
    return sorted(map(tuple, vector_dedup.near_copies(df, **options).collect()), key=str)


def hard_rows():
    near = [[1.0, 0.0, 0.0], [0.99, 0.1, 0.0], [0.9, 0.3, 0.0], [0.0, 1.0, 0.0], [2.0, 0.0, 0.0]]
    return [
        *enumerate(near, 10),
        (30, None), (31, []), (32, [0.0, 0.0, 0.0]), (33, [1.0, None, 0.0]),
        (34, [float("nan"), 1.0, 0.0]), (35, [float("inf"), 1.0, 0.0]),
        (36, [1.0, 0.0]), (37, [1.0, 0.001]), (38, [-1.0, 0.0, 0.0]), (39, [-0.0, 1.0, 0.0]),
        (None, [1.0, 0.0, 0.0]), (None, [0.0, 0.0, 5.0]), (None, None),
        (10, [1.0, 0.0, 0.0]), (5, [1.0, 0.0, 0.0]), (40, [1e30, 0.0, 0.0]),
        (41, [0.95, 0.31224989991991992, 0.0]),
    ]


@pytest.mark.parametrize("kind", ["float", "double"])
def test_hard_rows(spark, kind):
    rows = hard_rows()
    if kind == "float":
        rows = rows[:-1]
    assert found(spark, rows, kind, extra=kind == "float") == plain(rows)


def test_empty_table(spark):
    assert found(spark, []) == []
    assert found(spark, [(1, None)]) == [(1, 0, 1, True)]


def test_all_pairs_of_many_shards(spark, monkeypatch):
    """With small shards and blocks, dealt twice, the audited result is that of all pairs."""
    monkeypatch.setattr(vector_dedup, "SHARD_MOST", 120)
    monkeypatch.setattr(vector_dedup, "SHARD_MEAN", 60)
    monkeypatch.setattr(vector_dedup, "BLOCK", 64)
    monkeypatch.setattr(vector_dedup, "MOST_CENTERS", 4)
    vectors = clusters(3, [1] * 700 + [2, 3, 4, 5] * 20 + [90, 150])
    vectors = np.concatenate([vectors, vectors[:40], vectors[:1].repeat(200, 0)])
    rows = [(3 * n + 7, v.tolist()) for n, v in enumerate(vectors)]
    have, want = found(spark, rows), plain(rows)
    assert [r[0] for r in have] == [r[0] for r in want]
    linked = sum(r[1] for r in want)
    assert sum(min(a[1], b[1]) for a, b in zip(have, want, strict=True)) >= 0.99 * linked
    assert all(a[1] <= b[1] and a[2] >= b[2] for a, b in zip(have, want, strict=True))
    assert sum(a == b for a, b in zip(have, want, strict=True)) >= 0.98 * len(rows)


def test_audit_sees_what_is_missing(spark):
    rows = [(n, v.tolist()) for n, v in enumerate(clusters(5, [10] * 10))]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], ROWS.format("float"))
    nodes = vector_dedup.node_table(df.selectExpr("*", "vec_id AS row", "true AS usable"))
    full = spark.createDataFrame(
        [(i, n) for i, n, _, _ in plain(rows)], "node long, n_links long"
    )
    assert vector_dedup.audit(nodes, full, 0.95) == 1.0
    assert 0.4 < vector_dedup.audit(nodes, full.filter("node % 2 = 0"), 0.95) < 0.6


def test_graph_reaches_everything():
    vectors = clusters(9, [1] * 1500 + [40] * 5).astype(np.float64)
    vectors = (vectors / np.linalg.norm(vectors, axis=1, keepdims=True)).astype(np.float32)
    graph = vector_graph.build(vectors)
    assert vector_graph._reached(graph).all()
    near = vectors @ vectors.T >= 0.95
    hits = np.zeros_like(near)
    for q, v in vector_graph.within(graph, vectors, 0.95, vector_graph.BEAM):
        assert near[q, v].all()
        hits[q, v] = True
    assert (hits & near).sum() >= 0.97 * near.sum()


def test_graph_of_few_vectors():
    for n in (1, 2, 5):
        vectors = np.eye(8, dtype=np.float32)[:n]
        graph = vector_graph.build(vectors)
        pairs = [p for q, v in vector_graph.within(graph, vectors, 0.5, 4) for p in zip(q, v, strict=True)]
        assert sorted(pairs) == [(i, i) for i in range(n)]


def test_stars():
    a, b = vector_dedup.stars(np.array([5, 9, 2, 7]), np.array([9, 2, 8, 7]))
    assert sorted(zip(a.tolist(), b.tolist(), strict=True)) == [(2, 5), (2, 8), (2, 9)]
