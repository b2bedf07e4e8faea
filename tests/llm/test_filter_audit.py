"""The audit of filter orders against plain Python, row by row and order by order."""

from __future__ import annotations

from itertools import permutations

import pytest
from tables import documents, hard_rows, prose, words

from waitline.llm import filter_audit

LABELS = "doc_id long, quality int, toxic int"


def failures(text):
    text = text or ""
    ws = words(text)
    found = set()
    if len(ws) < 100:
        found.add("A")
    if 100 * len(set(ws)) < 80 * len(ws):
        found.add("B")
    if 100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text):
        found.add("C")
    if any(c in "#$%&*|" for c in text):
        found.add("D")
    return found


def plain(rows, labels):
    """Every order applied to every document, filter after filter."""
    ids = {}
    for r in rows:
        if r["doc_id"] is not None:
            ids.setdefault(r["text"] or "", set()).add(r["doc_id"])
    docs = []
    for r in rows:
        fails = failures(r["text"])
        others = ids.get(r["text"] or "", ())
        if r["doc_id"] is not None and any(o < r["doc_id"] for o in others):
            fails.add("E")
        mine = [x for x in labels if x[0] == r["doc_id"] and x[0] is not None]
        docs.append((r["lang"] or "", fails, any(x[1] == 1 for x in mine), any(x[2] == 1 for x in mine)))
    result, shapley = {}, {}
    for part in {d[0] for d in docs}:
        for order in map("".join, permutations("ABCDE")):
            left = [d for d in docs if d[0] == part]
            here = list(left)
            for step, name in enumerate(order, 1):
                gone = [d for d in left if name in d[1]]
                fail = [d for d in here if name in d[1]]
                left = [d for d in left if name not in d[1]]
                result[part, order, step] = (
                    len(left), len(gone), len(fail) - len(gone),
                    sum(d[1] == {name} for d in here),
                    sum(d[2] for d in gone), sum(d[3] for d in gone),
                )
                shapley[part, name] = shapley.get((part, name), 0) + len(gone)
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in result.items()}


def audited(docs, labels):
    rows = filter_audit.audited(docs, labels).collect()
    assert len({r[:3] for r in rows}) == len(rows)
    return {tuple(r[:3]): tuple(r[3:]) for r in rows}


@pytest.mark.parametrize("extra", [False, True])
def test_hard_rows(spark, extra):
    shout = "LOUD & CLEAR " * 50
    rows = [
        *hard_rows(),
        (10, "", "a"), (11, None, "a"), (12, shout, "b"), (13, shout, None), (13, shout, "b"),
        (14, prose(14, 150), "c"), (15, prose(14, 150), "c"), (16, "a " * 200, "c"),
        (17, "é" * 300 + " ÄÖÜ | É", "c"), (None, shout, "c"), (None, None, "c"),
    ]
    docs = documents(spark, rows, extra)
    docs = docs.withColumn("lang", docs.lang if extra else docs.source)
    labels = [
        (5, 1, 0), (5, 0, 1), (6, 1, None), (13, None, 1), (14, 1, 0), (15, 1, 1), (None, 1, 1),
        (99, 1, 1), (2, 0, 0),
    ]
    found = audited(docs, spark.createDataFrame(labels, LABELS))
    assert found == plain([r.asDict() for r in docs.collect()], labels)


def test_empty_tables(spark):
    docs = documents(spark, [(1, "some text")])
    none = spark.createDataFrame([], LABELS)
    assert audited(docs.limit(0), none) == {}
    assert audited(docs, none) == plain([r.asDict() for r in docs.collect()], [])


def test_texts_of_one_hash_are_compared(spark, monkeypatch):
    """With one hash for all texts the texts themselves still decide."""
    monkeypatch.setattr(filter_audit.F, "xxhash64", lambda *c: filter_audit.F.lit(1).cast("long"))
    rows = [(n, prose(n % 4, 120)) for n in range(12)]
    docs = documents(spark, rows)
    found = audited(docs, spark.createDataFrame([], LABELS))
    assert found["en", "EABCD", 1][1] == 8
