from __future__ import annotations

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tables import components, documents, hard_rows, prose, shingles

from waitline.llm import linking, ngram_join
from waitline.llm.signature_tree import Sets, linked


def copies(seed: int, count: int, words: int, changes: int):
    """Texts that differ from one another in up to ``changes`` places."""
    rng = random.Random(seed)
    base = [f"v{rng.randrange(400)}" for _ in range(words)]
    texts = []
    for n in range(count):
        own = list(base)
        for _ in range(rng.randrange(changes + 1)):
            own[rng.randrange(len(own))] = f"n{seed}x{n}x{rng.randrange(10**6)}"
        texts.append(" ".join(own))
    return texts


def check(spark, rows, words=4, percent=85):
    got = ngram_join.joined(documents(spark, rows), words, percent).collect()
    sets = {doc_id: shingles(text, words) for doc_id, text, *_ in rows}

    def link(a, b):
        both = len(sets[a] & sets[b])
        return both and 100 * both >= percent * len(sets[a] | sets[b])

    want = components(sets, link)
    assert {r.doc.doc_id: r.component_id for r in got} == want
    assert {r.doc.doc_id: r.n_shingles for r in got} == {d: len(s) for d, s in sets.items()}


@pytest.mark.parametrize("percent", [85, 60])
def test_as_all_pairs(spark, percent):
    texts = []
    for seed, (count, words, changes) in enumerate(
        [(60, 150, 4), (30, 30, 2), (30, 9, 1), (20, 5, 1), (10, 400, 12), (8, 2000, 40), (12, 3, 1)]
    ):
        texts += copies(seed, count, words, changes)
    texts += [prose(n, 80) + " " + prose(900, 60) for n in range(20)]  # a common passage
    rows = [(n, text) for n, text in enumerate(texts)]
    random.Random(1).shuffle(rows)
    check(spark, rows, percent=percent)


def test_blocks_of_a_large_component(spark, monkeypatch):
    """The same when a component is compared in many blocks."""
    texts = copies(3, 80, 120, 9) + copies(4, 40, 140, 9)
    rows = list(enumerate(texts))
    monkeypatch.setattr(linking.verified_links, "__defaults__", (1_500,))
    check(spark, rows)


def test_hard_rows(spark):
    docs = documents(spark, [*hard_rows(), (9, "ONE"), (10, "one")], extra=True)
    got = ngram_join.joined(docs, keep=("doc_id", "node")).collect()
    found = sorted((str(r.doc.doc_id), r.n_shingles, r.component_id) for r in got)
    assert found == sorted(
        [
            ("1", 0, 1), ("2", 0, 2), ("3", 0, 3), ("None", 57, None), ("5", 67, 5), ("5", 67, 5),
            ("6", 67, 5), ("7", 29_997, 7), ("8", 1, 8), ("9", 1, 8), ("10", 1, 8),
        ]
    )
    kept = ngram_join.one_of_each(docs)
    assert kept.columns == docs.columns
    ids = sorted(str(r.doc_id) for r in kept.collect())
    assert ids == sorted(["1", "2", "3", "None", "5", "7", "8"])
    assert ngram_join.joined(documents(spark, [])).count() == 0
    assert ngram_join.one_of_each(documents(spark, [])).count() == 0


def test_one_of_each_with_repeated_rows_and_awkward_names(spark):
    """Repeated rows of a survivor leave one; columns may have any name."""
    text = prose(1, 60)
    rows = [(1, text), (1, text), (4, prose(2, 60)), (2, text), (3, None), (3, None), (None, text)]
    docs = documents(spark, rows)
    for name in ("of_id", "of_print", "of_there", "_of_hash", "lang-score", "place", "first"):
        docs = docs.selectExpr("*", f"'mine' AS `{name}`")
    kept = ngram_join.one_of_each(docs)
    assert kept.columns == docs.columns
    found = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    assert found == sorted([(1, text), (4, prose(2, 60)), (3, None), (3, None)], key=str)


tokens = st.lists(st.integers(0, 40), min_size=1, max_size=30).map(lambda x: sorted(set(x)))


@settings(max_examples=150, deadline=None)
@given(st.lists(tokens, min_size=2, max_size=40), st.integers(0, 1), st.sampled_from([50, 80, 85]))
def test_trees_lose_no_connection(sets, two_sides, percent):
    threshold = linking.Threshold(percent)
    spread = linking.mixed(np.arange(41, dtype=np.uint64) + np.uint64(7))
    arrays = [np.sort(spread[s]) for s in sets]
    half = len(sets) // 2 if two_sides else len(sets)
    found = linked(
        Sets(
            np.arange(len(sets)),
            (np.arange(len(sets)) >= half).astype(int),
            np.arange(len(sets)),
            np.concatenate([[0], np.cumsum([len(s) for s in sets])]),
            np.concatenate(arrays),
        ),
        threshold,
    )

    def link(a, b):
        if two_sides and (a < half) == (b < half):
            return False
        both = len(set(sets[a]) & set(sets[b]))
        return both and 100 * both >= percent * len(set(sets[a]) | set(sets[b]))

    assert all(link(int(a), int(b)) for a, b in found)
    pairs = {(int(a), int(b)) for a, b in found} | {(int(b), int(a)) for a, b in found}
    items = range(len(sets))
    assert components(items, lambda a, b: (a, b) in pairs) == components(items, link)


@settings(max_examples=300, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 700), st.integers(0, 80), st.sampled_from([85, 80, 60]))
def test_linked_sets_share_a_key(seed, size, changes, percent):
    rng = np.random.default_rng(seed)
    values = rng.integers(0, 2**63, size + changes, dtype=np.uint64)
    one = np.unique(values[:size])
    other = np.unique(values[min(changes, size - 1) :])
    threshold = linking.Threshold(percent)
    both, either = len(np.intersect1d(one, other)), len(np.union1d(one, other))
    signatures = ngram_join.Signatures(threshold)
    if 100 * both >= percent * either and both < either:
        assert set(signatures.keys(one)) & set(signatures.keys(other))


def test_components_of_a_long_path(spark):
    edges = spark.range(300).selectExpr("id * 11 % 301 AS a", "(id + 1) * 11 % 301 AS b")
    labels = linking.components(edges).collect()
    assert len(labels) == 301 and len({r.component for r in labels}) == 1


def test_common_passages_make_no_candidates(spark, monkeypatch):
    """Texts of which a third is one passage are not compared; those that link among them are."""
    passage = prose(900, 50)
    rows = [(n, f"{prose(n, 100)} {passage}") for n in range(60)]
    rows += [(100 + n, f"{prose(n, 100)} {passage} other{n}") for n in range(3)]
    compared = []

    def spied(members, threshold, *, sizes):
        compared.extend(sizes.collect())
        return linking.verified_links(members, threshold, sizes=sizes)

    monkeypatch.setattr(ngram_join, "verified_links", spied)
    check(spark, rows)
    assert len(compared) == 6
    assert max(sum(a.candidate == b.candidate for a in compared) for b in compared) == 2


@settings(max_examples=300, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 400), st.integers(0, 80), st.sampled_from([85, 80, 20]))
def test_linked_sets_share_as_many_keys_as_they_must(seed, size, changes, percent):
    rng = np.random.default_rng(seed)
    values = rng.integers(0, 2**63, size + changes, dtype=np.uint64)
    one, other = np.unique(values[:size]), np.unique(values[rng.integers(0, changes + 1) :])
    both, either = len(np.intersect1d(one, other)), len(np.union1d(one, other))
    signatures = ngram_join.Signatures(linking.Threshold(percent))
    if 100 * both >= percent * either and both < either:
        shared = len(set(signatures.keys(one)) & set(signatures.keys(other)))
        assert shared >= max(signatures.least(len(one)), signatures.least(len(other))) > 0
