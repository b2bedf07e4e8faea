"""Small tables with the cases that every operator must bear, and plain versions of rules."""

from __future__ import annotations

import re

DOCS = "doc_id long, text string, lang string, source string, n_chars int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def prose(start: int, count: int) -> str:
    """Words that no other start has."""
    return " ".join(f"w{start}x{n}" for n in range(count))


def documents(spark, rows, extra: bool = False):
    """Rows of (doc_id, text) or (doc_id, text, source); ``extra`` adds columns of awkward names."""
    full = [
        (r[0], r[1], "en", r[2] if len(r) > 2 else "a", len(r[1]) if r[1] is not None else None)
        for r in rows
    ]
    df = spark.createDataFrame(full, DOCS)
    if extra:
        for name in (
            "size", "copies", "target", "node", "key", "clean", "covered", "print", "position",
            "doc", "kept", "n_words", "component_id", "row", "stratum", "label", "hash", "rate",
        ):
            df = df.selectExpr("*", f"'mine' AS `{name}`")
    return df


def hard_rows():
    """Null and empty texts, a null id, repeated rows, ties, and a long text."""
    return [
        (1, None, "a"),
        (2, "", None),
        (3, " \t\n", "b"),
        (None, prose(4, 60), "b"),
        (5, prose(5, 70), "a"),
        (5, prose(5, 70), "a"),
        (6, prose(5, 70), None),
        (7, prose(7, 30_000), "c"),
        (8, "one", "c"),
    ]


def words(text):
    return WORD.findall(text or "")


def shingles(text, length):
    ws = words((text or "").translate(LOWER))
    if not ws:
        return frozenset()
    return frozenset(tuple(ws[i : i + length]) for i in range(max(1, len(ws) - length + 1)))


def components(items, linked):
    """Smallest item that links reach, for each item, by trying all pairs."""
    parent = {i: i for i in items}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ordered = sorted(items)
    for n, a in enumerate(ordered):
        for b in ordered[n + 1 :]:
            if linked(a, b):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in items}
