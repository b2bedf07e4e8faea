from __future__ import annotations

import math
from collections import Counter
from fractions import Fraction

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tables import documents, hard_rows, words

from waitline.llm import quality
from waitline.llm.staging import stage


def plain(text):
    text = text or ""
    ws = words(text)
    lines = [line for line in text.split("\n") if words(line)]
    three = [tuple(ws[i : i + 3]) for i in range(len(ws) - 2)]
    times = Counter(three)
    covered = {i + k for i, w in enumerate(three) if times[w] > 1 for k in range(3)}
    return {
        "n_words": len(ws),
        "word_chars": sum(map(len, ws)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_lines": len(lines),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
        "base_failed": len(ws) < 50 or 100 * len(covered) > 50 * len(ws),
    }


def check(spark, rows):
    got = quality.measured(documents(spark, rows)).collect()
    assert len(got) == len(rows)
    for row in got:
        want = plain(row["doc"]["text"])
        assert {name: row[name] for name in want} == want


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text("ab #\n\t é\x0b\x85|", max_size=60), min_size=1, max_size=20))
def test_measures(spark, texts):
    check(spark, list(enumerate(texts)))


def test_hard_rows(spark):
    long = " ".join(f"v{n % 997}" for n in range(20_000))
    check(spark, [*hard_rows(), (9, long), (10, "a b c a b c"), (11, "x y z")])
    assert quality.measured(documents(spark, [])).count() == 0
    names = quality.measured(documents(spark, hard_rows(), extra=True))
    assert names.select("doc.*").columns == documents(spark, [], extra=True).columns


@pytest.mark.parametrize("errors,trials", [(0, 1), (0, 4000), (3, 2500), (12, 9000), (1, 1)])
def test_binomial_tail(spark, errors, trials):
    rate = 1 / 300
    exact = sum(
        Fraction(math.comb(trials, i))
        * Fraction(rate) ** i
        * (1 - Fraction(rate)) ** (trials - i)
        for i in range(errors + 1)
    )
    row = spark.createDataFrame([(errors, trials)], "k long, n long")
    got = row.select(quality.binomial_tail(F.col("k"), F.col("n"), rate)).first()[0]
    assert got == pytest.approx(float(exact), rel=1e-9)


def labelled(spark, good, symbols):
    """Good documents without symbols, bad ones with many, and rows without a label."""
    rows = [(n, "en", 0, 0) for n in range(good)]
    rows += [(good + n, "en", symbols, 0) for n in range(50)]
    rows += [(10**6, None, symbols, 0), (10**6 + 1, "xx", symbols, 0)]
    table = spark.createDataFrame(rows, "doc_id long, lang string, n_symbols long, n_dup_lines long")
    table = table.selectExpr(
        "*", "500L word_chars", "100L n_words", "9L n_lines", "0L n_repeat_words", "false base_failed"
    )
    labels = [(n, int(n < good)) for n in range(good + 50)]
    return table, spark.createDataFrame([*labels, (None, 1)], "doc_id long, quality int")


def test_cutoffs_need_enough_proof(spark):
    table, labels = labelled(spark, 3000, 100)
    cutoffs = stage(quality.certified_cutoffs(table, labels))
    assert [(r.stratum, r.cut_symbols) for r in cutoffs.collect()] == [("en", 2)]
    kept = {r.doc_id: r.kept for r in quality.judged(table, cutoffs).collect()}
    assert all(kept[n] for n in range(3000)) and not any(kept[3000 + n] for n in range(50))
    # Strata without labels have no rule.
    assert kept[10**6] and kept[10**6 + 1]
    few, labels = labelled(spark, 500, 100)
    assert quality.certified_cutoffs(few, labels).count() == 0


def test_no_cutoff_beyond_the_first_that_fails(spark):
    """A cutoff counts only if all higher ones pass, and each has the full error of its rule."""
    table, labels = labelled(spark, 1300, 100)
    limit, errors = 0.01 / 3, 0.05 / 3
    assert (1 - limit) ** 1300 < errors  # enough for one test of one rule
    assert (1 - limit) ** 1300 > errors / 8  # not for one of eight
    assert quality.certified_cutoffs(table, labels).first().cut_symbols == 2
    noisy = table.withColumn(
        "n_symbols", F.when(F.col("doc_id") % 20 == 0, 35).otherwise(F.col("n_symbols"))
    )
    cutoffs = quality.certified_cutoffs(noisy, labels).first()
    assert cutoffs.cut_symbols == 8  # 35 of 500 is 7 percent


def test_false_rejections_hold_on_new_documents(spark):
    """A cutoff that rejects one good document in fifty is not certified."""
    table, labels = labelled(spark, 5000, 100)
    noisy = table.withColumn(
        "n_symbols", F.when(F.col("doc_id") % 50 == 0, 15).otherwise(F.col("n_symbols"))
    )
    row = quality.certified_cutoffs(noisy, labels).first()
    assert row.cut_symbols == 4


def test_empty_tables(spark):
    table, labels = labelled(spark, 10, 1)
    none = quality.certified_cutoffs(table.limit(0), labels)
    assert none.count() == 0
    assert quality.judged(table, quality.certified_cutoffs(table, labels.limit(0))).count() == 62
