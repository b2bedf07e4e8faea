from __future__ import annotations

from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from tables import documents, hard_rows

from waitline.llm import line_dedup


def plain(rows, lines=3):
    places = defaultdict(list)
    for doc_id, text in rows:
        split = text.split("\n")
        for p in range(len(split) - lines + 1):
            places[tuple(split[p : p + lines])].append((doc_id, p))
    gone = {
        (doc_id, p + k)
        for found in places.values()
        for doc_id, p in sorted(found)[1:]
        for k in range(lines)
    }
    return {
        doc_id: "\n".join(l for p, l in enumerate(text.split("\n")) if (doc_id, p) not in gone)
        for doc_id, text in rows
    }


texts = st.lists(st.sampled_from(["a", "b", "c", "", "long line"]), min_size=1, max_size=12)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(texts, min_size=1, max_size=8))
def test_as_by_hand(spark, bodies):
    rows = [(n, "\n".join(body)) for n, body in enumerate(bodies)]
    got = line_dedup.without_repeated_lines(documents(spark, rows)).collect()
    assert {r.doc_id: r.text for r in got} == plain(rows)
    assert all(r.n_chars == len(r.text) for r in got)


def test_hard_rows_and_clashing_names(spark):
    docs = documents(spark, hard_rows(), extra=True)
    out = line_dedup.without_repeated_lines(docs)
    assert out.columns == docs.columns
    assert sorted(map(str, out.collect())) == sorted(map(str, docs.collect()))
    assert line_dedup.without_repeated_lines(documents(spark, [])).count() == 0


def test_repeated_rows_are_one_document(spark):
    rows = [(2, "x\ny\nz\nq"), (2, "x\ny\nz\nq"), (1, "x\ny\nz"), (None, "p\nx\ny\nz")]
    got = line_dedup.deduplicated(documents(spark, rows)).collect()
    # A document without id comes first and keeps its lines.
    assert sorted((r["doc"]["doc_id"] or 0, r.clean) for r in got) == [
        (0, "p\nx\ny\nz"),
        (1, ""),
        (2, "q"),
        (2, "q"),
    ]
