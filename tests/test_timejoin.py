"""As-of and overlap joins against plain search over all pairs."""

from __future__ import annotations

import datetime as dt
import random
import uuid

import pytest
from compare import _sorted

from waitline.operators import timejoin
from waitline.operators.scan import with_next

START = dt.datetime(2025, 7, 1)
LEFT = "id int, k string, at timestamp_ntz"
RIGHT = "k string, since timestamp_ntz, v string"


def moment(rng, span):
    return None if rng.random() < 0.05 else START + dt.timedelta(seconds=rng.randrange(span))


def rows(df):
    return _sorted([tuple(r) for r in df.collect()], df.columns)


def keep(store):
    return lambda name, df: store.keep(f"{name}_{uuid.uuid4().hex}", df)


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("by", [["k"], []])
def test_asof_equals_the_plain_search(spark, store, by, how):
    """A hot key, keys of one side only, equal times, NULL times and keys, an uneven spine."""
    rng = random.Random(5)
    keys = ["hot"] * 20 + ["a", "b", "c", None]
    left = [(n, rng.choice([*keys, "left only"]), moment(rng, 90_000)) for n in range(600)]
    right = [
        (rng.choice([*keys, "right only"]), moment(rng, rng.choice([500, 90_000])), f"v{n % 90}")
        for n in range(300)
    ]
    expected = []
    for n, k, at in left:
        before = [
            (since, *((rk,) if not by else ()), v)
            for rk, since, v in right
            if since is not None and at is not None and since <= at
            and (not by or (rk is not None and rk == k))
        ]
        # Struct order: the columns of the right side but the keys, in their order.
        best = max(
            before, key=lambda r: (r[0], *[(x is not None, x or "") for x in r[1:]]), default=None
        )
        if best is not None or how == "left":
            since, v = (best[0], best[-1]) if best else (None, None)
            expected.append((n, k, at, since, v))
    ours = spark.createDataFrame(left, LEFT)
    theirs = spark.createDataFrame(right, RIGHT)
    if not by:
        theirs = theirs.select("since", "k", "v").withColumnRenamed("k", "rk")
    found = timejoin.asof_join(ours, theirs, "at", "since", keep(store), by, how)
    found = found.select("id", "k", "at", "since", "v")
    assert rows(found) == _sorted(expected, found.columns)


def test_asof_of_empty_sides(spark, store):
    left = spark.createDataFrame([(1, "a", START)], LEFT)
    right = spark.createDataFrame([], RIGHT)
    found = timejoin.asof_join(left, right, "at", "since", keep(store), ["k"])
    assert [tuple(r) for r in found.collect()] == [(1, "a", START, None, None)]
    none = timejoin.asof_join(left.limit(0), right, "at", "since", keep(store), ["k"])
    assert none.count() == 0
    with pytest.raises(ValueError, match="how"):
        timejoin.asof_join(left, right, "at", "since", keep(store), how="outer")


def test_asof_spreads_a_hot_key(spark, store):
    """One key over many parts; no part has more than about its share."""
    left = spark.range(40_000).selectExpr(
        "CAST(id AS INT) id", "'hot' AS k",
        "TIMESTAMP_NTZ'2025-07-01 00:00:00' + make_dt_interval(0, 0, 0, id % 9973) AS at",
    )
    right = spark.range(2_000).selectExpr(
        "'hot' AS k",
        "TIMESTAMP_NTZ'2025-07-01 00:00:00' + make_dt_interval(0, 0, 0, id * 5) AS since",
        "CAST(id AS STRING) AS v",
    )
    held = {}

    def remember(name, df):
        held["both"] = store.keep(f"hot_{name}", df)
        return held["both"]

    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = timejoin.asof_join(left, right, "at", "since", remember, ["k"])
        assert found.filter("CAST(v AS INT) <> (id % 9973) div 5").count() == 0
        assert found.filter("v IS NULL").count() == 0
        shares = [r["count"] for r in held["both"].groupBy("_part").count().collect()]
        assert len(shares) == 8 and max(shares) < 2 * 42_000 / 8
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("by", [["k"], []])
def test_overlaps_equal_all_pairs(spark, by):
    """Lengths from a second to years, empty and open intervals, equal ends that only touch."""
    rng = random.Random(8)

    def interval():
        start = moment(rng, 400_000)
        length = rng.choice([0, 1, 59, 60, 61, 3600, 90_000, 70_000_000, -5])
        end = None if start is None or rng.random() < 0.05 else start + dt.timedelta(seconds=length)
        return start, end

    keys = ["hot"] * 5 + ["a", None]
    left = [(n, rng.choice(keys), *interval()) for n in range(150)]
    right = [(rng.choice(keys), *interval(), n) for n in range(150)]
    expected = []
    for n, k, s, e in left:
        for rk, rs, re, v in right:
            if None in (s, e, rs, re) or s >= e or rs >= re or (by and (k is None or k != rk)):
                continue
            if s < re and rs < e:
                expected.append((n, k, s, e, rs, re, v))
    ours = spark.createDataFrame(left, "id int, k string, s timestamp_ntz, e timestamp_ntz")
    theirs = spark.createDataFrame(right, "k string, rs timestamp_ntz, re timestamp_ntz, v int")
    if not by:
        theirs = theirs.withColumnRenamed("k", "rk")
    found = timejoin.overlap_join(ours, theirs, ("s", "e"), ("rs", "re"), by)
    assert "NestedLoop" not in plan(found) and "Cartesian" not in plan(found)
    found = found.select("id", "k", "s", "e", "rs", "re", "v")
    assert rows(found) == _sorted(expected, found.columns)


def test_overlaps_of_empty_sides(spark):
    ours = spark.createDataFrame([(1, START, START + dt.timedelta(hours=1))], "id int, s timestamp_ntz, e timestamp_ntz")
    theirs = ours.toDF("v", "rs", "re").limit(0)
    assert timejoin.overlap_join(ours, theirs, ("s", "e"), ("rs", "re")).count() == 0
    assert timejoin.overlap_join(theirs, ours, ("rs", "re"), ("s", "e")).count() == 0


def test_next_in_pieces_equals_the_plain_search(spark):
    rng = random.Random(3)
    numbers = {(rng.choice("aab"), rng.randrange(5000)) for _ in range(400)}
    df = spark.createDataFrame(sorted(numbers), "k string, n int").selectExpr(
        "*", "n div 500 AS coarse", "n div 20 AS fine"
    )
    found = with_next(df, ["k"], "n", ["coarse", "fine"], "following").select("k", "n", "following")
    expected = [
        (k, n, min((m for j, m in numbers if j == k and m > n), default=None)) for k, n in numbers
    ]
    assert rows(found) == _sorted(expected, found.columns)
