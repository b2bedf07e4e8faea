from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F
from tables import documents, hard_rows, words

from waitline.llm import mixing


def plain_targets(sizes: dict, weights=(1, 2, 3), most=3):
    order = sorted([s for s in sizes if s is not None]) + [s for s in sizes if s is None]
    weight = {s: weights[n % len(weights)] for n, s in enumerate(order)}
    total, stopped = sum(sizes.values()), set()
    while True:
        free = [s for s in order if s not in stopped]
        rest = total - sum(most * sizes[s] for s in stopped)
        share = rest / sum(weight[s] for s in free) if free else 0
        over = {s for s in free if share * weight[s] > most * sizes[s]}
        if not over:
            return {s: most * sizes[s] if s in stopped else share * weight[s] for s in order}
        stopped |= over


@pytest.mark.parametrize(
    "sizes",
    [
        {"a": 100, "b": 100, "c": 100},
        {"a": 1000, "b": 10, "c": 1, None: 5},
        {"é": 7, "z": 5000, "Z": 3, "": 9, None: 0},
        {"only": 12},
        {"a": 0, "b": 0},
    ],
)
def test_targets(spark, sizes):
    rows = spark.createDataFrame(
        [(s, n) for s, n in sizes.items()] + [(s, 0) for s in sizes], "source string, size long"
    )
    got = {r.source: r.target for r in mixing.source_targets(rows).collect()}
    assert got == pytest.approx(plain_targets(sizes))


def test_no_rows(spark):
    assert mixing.source_targets(spark.createDataFrame([], "source string, size long")).count() == 0
    assert mixing.mixed(documents(spark, [])).count() == 0


def test_hard_rows_and_clashing_names(spark):
    docs = documents(spark, hard_rows(), extra=True)
    plan = mixing.planned(docs).collect()
    assert len(plan) == len(hard_rows())
    for row in plan:
        assert row["size"] == len(words(row["doc"]["text"]))
        assert 0 <= row["copies"] <= 3
    out = mixing.mixed(docs)
    assert out.columns == docs.columns
    again = Counter(map(tuple, mixing.mixed(docs).collect()))
    assert Counter(map(tuple, out.collect())) == again
    expected = Counter()
    for row in plan:
        expected[tuple(row["doc"])] += row["copies"]
    assert again == +expected


def test_words_taken_come_near_the_targets(spark):
    rows = [(n, "w " * 20, f"s{n % 5 if n % 3 else 0}") for n in range(20_000)]
    plan = mixing.planned(documents(spark, rows)).groupBy("doc.source").agg(
        F.sum(F.col("size") * F.col("copies")).alias("taken"), F.first("target").alias("target")
    )
    for row in plan.collect():
        assert row["taken"] == pytest.approx(row["target"], rel=0.05)
