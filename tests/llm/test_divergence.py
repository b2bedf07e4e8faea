"""Divergences of sources against plain Python over all terms and pairs."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tables import LOWER, documents, hard_rows, prose

from waitline.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def plain(rows):
    docs = [
        (r["lang"] or "", r["source"] or "", TERM.findall((r["text"] or "").translate(LOWER)))
        for r in rows
    ]
    found = set()
    for lang in {d[0] for d in docs}:
        of_lang = [d for d in docs if d[0] == lang]
        n_docs = Counter(t for d in of_lang for t in set(d[2]))
        kept = {t for t, n in n_docs.items() if n >= 3}
        counts = defaultdict(Counter)
        for _, source, terms in of_lang:
            counts[source].update(t for t in terms if t in kept)

        def p(counter, term, v=len(kept)):
            return 1 + 10**9 * (counter[term] + 1) // (counter.total() + v)

        whole = sum(counts.values(), Counter())
        for source in counts:
            pairs = {
                other: sum(
                    (p(counts[source], t) - p(counts[other], t)) ** 2 // p(counts[other], t)
                    for t in kept
                )
                for other in counts
                if other != source
            }
            terms = {
                t: (p(counts[source], t) - p(whole, t)) ** 2 // p(whole, t)
                for t in kept
                if counts[source][t] and p(counts[source], t) > p(whole, t)
            }
            for part, values, most in (("pair", pairs, None), ("term", terms, 200)):
                order = sorted(values.items(), key=lambda kv: (-kv[1], kv[0].encode()))
                for rank, (item, value) in enumerate(order[:most], 1):
                    found.add((lang, source, part, item, value, rank))
    return found


def audited(docs):
    rows = [tuple(r) for r in divergence.audited(docs).collect()]
    assert len(set(rows)) == len(rows)
    return set(rows)


def mixed_documents(spark, extra=False):
    rng = np.random.default_rng(7)
    vocabulary = [f"{a}{b}" for a in "abcdefghijklmnopqrstuvwxyz" for b in ("", "é", "ß", "Ωx", "zz")]
    odds = 1 / np.arange(1, len(vocabulary) + 1)
    rows = [
        (n, " ".join(rng.choice(vocabulary, size=int(rng.integers(0, 90)), p=odds / odds.sum())),
         f"s{int(rng.integers(0, 5))}")
        for n in range(200)
    ]
    rows += [(500, "It's ALL-caps; Ünïcode x\x00y ½ 日本 日本", "s1")] * 4
    docs = documents(spark, [*rows, *hard_rows()], extra)
    return docs.withColumn("lang", F.when(F.col("doc_id") % 3 == 0, "de").when(
        F.col("doc_id") % 3 == 1, "en"
    ))


@pytest.mark.parametrize("extra", [False, True])
def test_all_terms_and_pairs(spark, extra):
    docs = mixed_documents(spark, extra)
    assert audited(docs) == plain([r.asDict() for r in docs.collect()])


def test_small_spills_pieces_and_blocks(spark, monkeypatch):
    """The same from stripes spilled all the time, texts in pieces and pairs that are not held."""
    docs = mixed_documents(spark).repartition(3)
    expected = plain([r.asDict() for r in docs.collect()])
    folded = [r for r in docs.select(
        F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source"),
        F.coalesce("text", F.lit("")).alias("text")).toArrow().to_batches()]
    monkeypatch.setattr(divergence, "PIECE", 16)
    monkeypatch.setattr(divergence, "MOST_ENTRIES", 40)
    monkeypatch.setattr(divergence, "ROWS_OUT", 3)
    stripes = [dict(row) for b in divergence._fold(iter(folded)) for row in b.to_pylist()]
    assert len(stripes) > 3 * len({(s["lang"], s["term"]) for s in stripes})
    stripes.sort(key=lambda s: (s["lang"].encode(), s["term"].encode()))
    schema = next(divergence._fold(iter(folded))).schema
    parts = pa.Table.from_pylist(stripes, schema).to_batches(max_chunksize=7)
    kept = [row for b in divergence._merge(iter(parts)) for row in b.to_pylist()]
    assert all(k["n_docs"] >= 3 for k in kept)
    terms = {(e[0], e[3]) for e in expected if e[2] == "term"}
    assert terms <= {(k["lang"], k["term"]) for k in kept}

    def by_lang(lang):
        of = [k for k in kept if k["lang"] == lang]
        totals = Counter()
        for source in {r["source"] for b in folded for r in b.to_pylist() if r["lang"] == lang}:
            totals[source] = 0
        for k in of:
            totals.update(dict(zip(k["sources"], k["counts"], strict=True)))
        names = sorted(totals)
        header = {"lang": lang, "term": None, "n_docs": len(of), "sources": names,
                  "counts": [totals[n] for n in names]}
        return pa.Table.from_pylist([header, *of], schema).to_batches(max_chunksize=5)

    monkeypatch.setattr(divergence, "MOST_HELD", 1)
    sums = Counter()
    for lang in {e[0] for e in expected}:
        for b in divergence._diverge(iter(by_lang(lang))):
            for r in b.to_pylist():
                if r["part"] == "pair":
                    sums[r["lang"], r["source"], r["item"]] += r["value"]
    pairs = {(e[0], e[1], e[3]): e[4] for e in expected if e[2] == "pair" and e[4]}
    assert {k: v for k, v in sums.items() if v} == pairs


def test_strongest_terms_stop_at_the_limit(spark):
    letters = "abcdefghijklmnopqrst"
    vocabulary = " ".join(f"{a}{b}" for a in letters for b in letters)
    rows = [(n, vocabulary if n % 2 else "other words here", f"s{n % 2}") for n in range(8)]
    docs = documents(spark, rows)
    found = audited(docs)
    assert found == plain([r.asDict() for r in docs.collect()])
    assert sum(f[1:3] == ("s1", "term") for f in found) == 200


def test_pairs_are_added_up_once_per_portion_of_the_terms(spark, monkeypatch):
    """With three kept terms a language has one portion, whatever the number of partitions."""
    rows = [(n, "x", f"s{n % 4}", "alpha beta gamma") for n in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, source string, text string")
    setting = "spark.sql.shuffle.partitions"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "37")
    try:
        found = divergence.partial_divergences(docs).filter("part = 'pair'")
        assert found.count() == 4 * 3
        expected = audited(docs)
        monkeypatch.setattr(divergence, "TERMS_PER_TASK", 1)
        assert divergence.partial_divergences(docs).filter("part = 'pair'").count() == 3 * 4 * 3
        assert audited(docs) == expected
    finally:
        spark.conf.set(setting, before)


def test_probability_of_large_counts():
    counts, total = np.array([0, 10**13, 7 * 10**14 - 1]), 9 * 10**14
    expected = [1 + 10**9 * (int(c) + 1) // total for c in counts]
    assert divergence.probability(counts, total).tolist() == expected


def test_tables_without_terms(spark):
    assert audited(documents(spark, []).limit(0)) == set()
    docs = documents(spark, [(1, "1 2 3", "a"), (2, None, "b"), (3, "", None)])
    assert audited(docs) == plain([r.asDict() for r in docs.collect()])
    assert len(audited(docs)) == 6
