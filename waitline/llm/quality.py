"""Quality rules whose cutoffs are certified on labelled documents.

Every rule rejects a document if a share exceeds a cutoff. A cutoff may be used in a stratum
(a language) only if the labelled good documents there prove, by an exact binomial bound, that
it rejects few good ones. Everything is DataFrame expressions.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waitline.llm.staging import stage
from waitline.llm.words import WORD, let, word_array

#: Fixed values of the base rules.
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\f\r"
WINDOW = 3

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


@dataclass(frozen=True)
class Rule:
    """Rejects if 100 * part > cutoff * whole, for integer percentages ``cutoffs``."""

    name: str
    part: str
    whole: str
    cutoffs: tuple[int, ...]

    def rejects(self, cutoff: Column) -> Column:
        return F.col(self.part) * 100 > cutoff * F.col(self.whole)


RULES = (
    Rule("symbols", "n_symbols", "word_chars", (2, 4, 6, 8, 12, 16, 24, 32)),
    Rule("repeated_lines", "n_dup_lines", "n_lines", (10, 20, 30, 40, 50, 60, 70, 80)),
    Rule("repeated_words", "n_repeat_words", "n_words", (10, 15, 20, 25, 30, 35, 40, 45)),
)


@dataclass(frozen=True)
class Risk:
    """At most ``false_rejection`` of the good documents of a stratum are rejected by all rules
    together; all such statements hold at once with probability ``1 - error``."""

    false_rejection: float = 0.01
    error: float = 0.05


def _covered_words(words: Column) -> Column:
    """How many words lie in windows of three that the text has twice or more.

    Windows are compared by 64-bit hashes within one text. They are sorted with their places,
    so the work is n log n in the words of a text.
    """

    def of_windows(hashes: Column) -> Column:
        placed = F.sort_array(
            F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        )
        return F.when(
            F.size(F.array_distinct(hashes)) < F.size(hashes), let(placed, of_placed)
        ).otherwise(0)

    def of_placed(placed: Column) -> Column:
        def same(one: Column, other: Column) -> Column:
            return F.coalesce(one["h"] == F.get(placed, other)["h"], F.lit(False))

        repeated = F.filter(placed, lambda p, j: same(p, j - 1) | same(p, j + 1))
        places = F.sort_array(F.transform(repeated, lambda p: p["i"]))
        return let(places, of_places)

    def of_places(places: Column) -> Column:
        steps = F.transform(
            places,
            lambda p, j: F.least(
                F.lit(WINDOW), F.coalesce(F.get(places, j + 1) - p, F.lit(WINDOW))
            ),
        )
        return F.aggregate(steps, F.lit(0), lambda total, step: total + step)

    def of_words(words: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(words) - WINDOW)
        hashes = F.transform(
            starts, lambda i: F.xxhash64(*[F.get(words, i + n) for n in range(WINDOW)])
        )
        return F.when(F.size(words) > WINDOW, let(hashes, of_windows)).otherwise(0)

    return let(words, of_words)


def measured(docs: DataFrame) -> DataFrame:
    """Each row as a struct ``doc`` with its measures; a null text is measured as an empty one.

    ``n_words``; ``word_chars``, code points in words; ``n_symbols``; ``n_lines``, lines with a
    word, and ``n_dup_lines``, those equal to an earlier one; ``n_repeat_words``, words in
    three-word windows found twice or more; ``base_failed``. One scan, no shuffle.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    without = lambda drop: F.length(F.translate(text, drop, ""))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD))
    line_counts = let(
        lines,
        lambda ls: F.struct(
            F.size(ls).alias("n_lines"),
            (F.size(ls) - F.size(F.array_distinct(ls))).alias("n_dup_lines"),
        ),
    )
    word_counts = let(
        word_array(text),
        lambda ws: F.struct(
            F.size(ws).alias("n_words"), _covered_words(ws).alias("n_repeat_words")
        ),
    )
    rows = docs.select(
        F.struct("*").alias("doc"),
        line_counts.alias("l"),
        word_counts.alias("w"),
        without(SPACES).cast("long").alias("word_chars"),
        (F.length(text) - without(SYMBOLS)).cast("long").alias("n_symbols"),
    )
    repeats = F.col("n_repeat_words") * 100 > F.col("n_words") * MOST_REPEATED_PERCENT
    return rows.select(
        "doc",
        "word_chars",
        "n_symbols",
        *[F.col(name).cast("long").alias(name.split(".")[1]) for name in (
            "l.n_lines", "l.n_dup_lines", "w.n_words", "w.n_repeat_words"
        )],
    ).withColumn("base_failed", (F.col("n_words") < LEAST_WORDS) | repeats)


def _log_factorial(n: Column) -> Column:
    """ln n! by Stirling's series, eight places further up where it is exact to 1e-13."""
    z = n + 9.0
    below = F.lit(0.0)
    for step in range(1, 9):
        below = below + F.log(n + float(step))
    series = 1 / (12 * z) - 1 / (360 * z**3) + 1 / (1260 * z**5) - 1 / (1680 * z**7)
    return (z - 0.5) * F.log(z) - z + 0.5 * math.log(2 * math.pi) + series - below


def binomial_tail(errors: Column, trials: Column, rate: float) -> Column:
    """P(X <= errors) for X binomial, summed downward from the largest term.

    Terms shrink as the count falls below the mean; beyond 18 standard deviations they are
    under 1e-70 of the largest, so the sum stops there and stays short for any table.
    """
    k, n = errors.cast("double"), trials.cast("double")
    largest = F.exp(
        _log_factorial(n)
        - _log_factorial(k)
        - _log_factorial(n - k)
        + k * math.log(rate)
        + (n - k) * math.log1p(-rate)
    )
    terms = F.sequence(F.lit(0), F.least(errors, F.ceil(9 * F.sqrt(n)) + 50).cast("int"))
    odds = (1 - rate) / rate
    summed = F.aggregate(
        terms,
        F.struct(F.lit(1.0).alias("term"), F.lit(0.0).alias("sum")),
        lambda acc, j: F.struct(
            (acc["term"] * (k - j) / (n - k + j + 1) * odds).alias("term"),
            (acc["sum"] + acc["term"]).alias("sum"),
        ),
        lambda acc: acc["sum"],
    )
    return largest * summed


def certified_cutoffs(
    rows: DataFrame,
    labels: DataFrame,
    stratum: str = "lang",
    rules: tuple[Rule, ...] = RULES,
    risk: Risk = Risk(),  # noqa: B008
) -> DataFrame:
    """The lowest certified cutoff per stratum and rule: ``stratum`` and one column per rule.

    ``rows`` has doc_id, the stratum and the measures; ``labels`` has doc_id and quality. The
    holdout is every labelled row that passes the base rules and whose labels are all 1. A
    cutoff passes if so few of the n good documents of a stratum fall to it that, were its true
    rate of false rejection above its limit, so few would have been seen with probability at
    most the error divided by the number of rules and strata (Bonferroni). What a lower cutoff
    rejects holds what a higher one does, so the cutoffs of a rule are tested in a fixed order,
    the highest first, each at the full error of its rule and stratum, up to the first that fails;
    those before it are certified, and a false one among them costs the error only once.
    The limit of a rule is an equal part of ``risk.false_rejection``. A rule without a certified
    cutoff is null and rejects nothing, and so is every rule in a stratum without labels. A null
    stratum is a stratum of its own. Null doc_ids match no label.
    """
    good = labels.groupBy("doc_id").agg(F.min("quality").alias("quality")).filter("quality = 1")
    holdout = rows.filter(~F.col("base_failed")).join(good.select("doc_id"), "doc_id")
    counts = [
        F.sum(rule.rejects(F.lit(cutoff)).cast("long")).alias(f"{rule.name}_{cutoff}")
        for rule in rules
        for cutoff in rule.cutoffs
    ]
    by_stratum = stage(
        holdout.groupBy(F.col(stratum).alias("stratum")).agg(
            F.count("*").alias("trials"), *counts
        )
    )
    each = by_stratum.select(
        "stratum",
        "trials",
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(rule.name).alias("rule"),
                        F.lit(cutoff).alias("cutoff"),
                        F.col(f"{rule.name}_{cutoff}").alias("errors"),
                    )
                    for rule in rules
                    for cutoff in rule.cutoffs
                ]
            )
        ),
    )
    limit = risk.false_rejection / len(rules)
    allowed = risk.error / max(1, by_stratum.count() * len(rules))
    possible = F.col("errors") < F.col("trials") * limit
    passes = F.when(
        possible, binomial_tail(F.col("errors"), F.col("trials"), limit) <= allowed
    ).otherwise(False)
    tested = each.withColumn("passes", passes)
    failed = tested.groupBy("stratum").agg(
        *[
            F.max(F.when((F.col("rule") == rule.name) & ~F.col("passes"), F.col("cutoff"))).alias(
                rule.name
            )
            for rule in rules
        ]
    )

    def lowest(rule: Rule) -> Column:
        above = F.coalesce(F.col(rule.name), F.lit(min(rule.cutoffs) - 1))
        cutoffs = F.array(*[F.lit(cutoff) for cutoff in rule.cutoffs])
        return F.array_min(F.filter(cutoffs, lambda cutoff: cutoff > above))

    cuts = [lowest(rule).alias(f"cut_{rule.name}") for rule in rules]
    some = F.coalesce(*[F.col(f"cut_{rule.name}") for rule in rules]).isNotNull()
    return failed.select("stratum", *cuts).filter(some)


def judged(
    rows: DataFrame,
    cutoffs: DataFrame,
    stratum: str = "lang",
    rules: tuple[Rule, ...] = RULES,
) -> DataFrame:
    """``rows`` with ``kept``: not base_failed, and no rule above its stratum's cutoff."""
    joined = rows.join(cutoffs, F.col(stratum).eqNullSafe(F.col("stratum")), "left")
    rejected = F.lit(False)
    for rule in rules:
        rejected = rejected | F.coalesce(rule.rejects(F.col(f"cut_{rule.name}")), F.lit(False))
    return joined.withColumn("kept", ~F.col("base_failed") & ~rejected)
