from __future__ import annotations

import random

from pyspark.sql import functions as F

from waitline.llm import fixity

SCHEMA = "file string, offset long, record binary, leaf string, node string"


def archive(spark, rows):
    return spark.createDataFrame([(*r, "mine", "mine") for r in rows], SCHEMA)


def plain(one, other):
    a, b = ({(f, o): r for f, o, r in rows} for rows in (one, other))
    return {
        place: "missing" if place not in b else "extra" if place not in a else "changed"
        for place in a.keys() | b.keys()
        if place not in a or place not in b or a[place] != b[place]
    }


def found(spark, one, other, **options):
    sides = [fixity.record_hashes(archive(spark, rows), **options) for rows in (one, other)]
    return {(r.file, r.offset): r.status for r in fixity.audit(*sides).collect()}


def records(files, count, seed=1):
    rng = random.Random(seed)
    rows = []
    for n in range(files):
        at = 0
        for _ in range(count):
            record = rng.randbytes(rng.randrange(1, 200))
            rows.append((f"f{n}", at, record))
            at += len(record)
    return rows


def test_damage_is_found(spark):
    one = records(4, 120)
    other = list(one)
    other[7] = (*other[7][:2], b"\0" * len(other[7][2]))
    other[130] = (*other[130][:2], b"short")
    del other[300], other[400:410]
    other.append(("f1", 10**7, b"tail"))
    other += [("new", 0, b"a"), ("new", 1, b"b")]
    assert found(spark, one, other, leaf_bytes=256) == plain(one, other)
    assert found(spark, other, one, leaf_bytes=256) == plain(other, one)
    assert found(spark, one, one, leaf_bytes=256) == {}


def test_hard_rows(spark):
    one = [(None, 0, b"x"), ("f", None, b"y"), ("f", 0, None), ("f", 5, b""), ("f", 9, b"z" * 10**6)]
    assert found(spark, one, one) == {}
    assert found(spark, one, one[:2]) == plain(one, one[:2])
    assert found(spark, one[:2], one) == plain(one[:2], one)
    assert found(spark, [], one) == plain([], one)
    assert found(spark, [], []) == {}
    # A record more often than in the other replica is a change of that place.
    assert found(spark, [*one, one[4]], one) == {("f", 9): "changed"}


def test_only_mismatching_branches_are_descended(spark):
    one = records(2, 400)
    other = [(*one[3][:2], b"?") if n == 3 else row for n, row in enumerate(one)]
    trees = [fixity.tree(fixity.record_hashes(archive(spark, r), 256)) for r in (one, other)]
    assert len(trees[0]) > 2
    roots = fixity._mismatches(trees[0][-1], trees[1][-1]).collect()
    assert [r.file for r in roots] == ["f0"]
    below = fixity._below(trees[0][0], fixity._mismatches(trees[0][1], trees[1][1]), fixity.FANOUT)
    assert below.count() <= fixity.FANOUT


def test_records_and_index_of_pages_agree(spark):
    rows = [(1, "http://a/", "<p>é</p>"), (2, None, None), (None, "u", "x"), (1001, "u", "y"), (1, "b", "c")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    index = fixity.warc_index(pages).collect()
    made = {}
    for r in sorted(index, key=lambda r: (r.file, r.offset)):
        assert r.offset == made.get(r.file, 0)
        made[r.file] = r.offset + r.length
    record = pages.filter("page_id = 1001").select(
        fixity.warc_record(F.col("page_id"), F.col("url"), F.col("html"))
    )
    text = bytes(record.first()[0])
    assert text.startswith(b"WARC/1.1\r\n") and text.endswith(b"Content-Length: 1\r\n\r\ny\r\n\r\n")
    assert fixity.warc_index(pages.limit(0)).count() == 0
