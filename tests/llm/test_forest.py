from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from waitline.llm import forest

SCHEMA = "vec_id long, embedding array<float>, key string, rank int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, "mine", 7) for i, v in rows], SCHEMA)


def plain(rows, queries, count):
    """Each query's neighbours among all other ids, from every pair."""
    found = {}
    for q, vector in rows:
        if q in queries:
            best = {}
            for i, other in rows:
                if i != q:
                    score = float(np.dot(np.float64(vector), np.float64(other)))
                    best[i] = max(score, best.get(i, -np.inf))
            found[q] = sorted(best.items(), key=lambda x: (-x[1], x[0]))[:count]
    return found


def answers(df):
    found = {}
    for r in df.orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append((r.id, r.score))
        assert r["rank"] == len(found[r.query_id])
    return found


def random_rows(count, dimensions=16, seed=1, unit=True):
    vectors = np.random.default_rng(seed).normal(size=(count, dimensions)).astype(np.float32)
    if unit:
        vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    return [(n, [float(x) for x in v]) for n, v in enumerate(vectors)]


def test_few_rows_are_all_found(spark):
    rows = random_rows(12, unit=False)
    got = answers(forest.nearest(table(spark, rows), F.col("vec_id") % 5 == 0))
    want = plain(rows, {0, 5, 10}, 20)
    assert {q: [i for i, _ in a] for q, a in got.items()} == {
        q: [i for i, _ in a] for q, a in want.items()
    }
    for q, found in got.items():
        assert [s for _, s in found] == pytest.approx([s for _, s in want[q]])


@pytest.mark.parametrize("unit", [True, False])
def test_recall(spark, unit):
    rows = random_rows(3000, unit=unit)
    plan = forest.ForestPlan(block=512)
    queries = set(range(0, 3000, 20))
    got = answers(forest.nearest(table(spark, rows), F.col("vec_id") % 20 == 0, plan=plan))
    want = plain(rows, queries, 20)
    assert got.keys() == queries and all(len(a) == 20 for a in got.values())
    hits = [len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in queries]
    assert np.mean(hits) >= 18


def test_ties_copies_and_vectors_that_take_no_part(spark):
    rows = [(n, [1.0, 0.0]) for n in range(60)]
    rows += [(100, [0.5, 0.5]), (100, [0.5, 0.5]), (101, [-1.0, 0.0])]
    bad = [
        (200, None),
        (201, [0.0, 0.0]),
        (202, [float("nan"), 1.0]),
        (203, [float("inf"), 1.0]),
        (204, [None, 1.0]),
        (205, []),
        (None, [1.0, 1.0]),
    ]
    got = answers(forest.nearest(table(spark, rows + bad), F.col("vec_id") % 20 == 0))
    assert got.keys() == {0, 20, 40, 100}
    assert [i for i, _ in got[0]] == list(range(1, 21))
    assert [i for i, _ in got[20]] == [*range(20)]
    assert [i for i, _ in got[40]] == [*range(20)]
    assert [i for i, _ in got[100]] == [*range(20)]


def test_no_rows(spark):
    assert forest.nearest(table(spark, []), F.col("vec_id") % 20 == 0).count() == 0
    lone = table(spark, [(0, [1.0, 2.0])])
    assert forest.nearest(lone, F.col("vec_id") % 20 == 0).count() == 0


def test_query_against_all_pairs(spark):
    import __spark_entry__ as registered

    folder = "/root/testdata/sf0.001"
    rows = [
        (r.vec_id, r.embedding)
        for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()
    ]
    queries = {i for i, _ in rows if i % 20 == 0}
    result = registered.queries()["op7_nearest_neighbours"](spark, folder)
    got = answers(result.withColumnRenamed("vec_id", "id"))
    want = plain(rows, queries, 20)
    hits = [len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in queries]
    assert np.mean(hits) >= 0.9


def test_sizes_of_prefixes_are_not_broadcast(spark):
    strings = [(n, None, [n % 7, n % 5], 1.0) for n in range(20)]
    hashed = spark.createDataFrame(strings, "key long, vector array<float>, strings array<long>, own double")
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit, None)
    spark.conf.set(limit, "10m")
    try:
        sizes = forest._sizes(hashed, hashed.filter("key % 4 = 0"), 3, 3)
        got = {(r.key, r.depth): r["size"] for r in sizes.collect()}
        plan = sizes._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset(limit) if before is None else spark.conf.set(limit, before)
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    same = lambda a, b, depth: a >> (3 - depth) == b >> (3 - depth)
    assert got == {
        (q, depth): sum(same(q % m, n % m, depth) for n in range(20) for m in (7, 5))
        for q in range(0, 20, 4)
        for depth in range(4)
    }
