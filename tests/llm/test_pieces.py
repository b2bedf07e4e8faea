from __future__ import annotations

import hashlib

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tables import documents, hard_rows

from waitline.llm import pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def model():
    return pieces.PieceModel(PATH)


@settings(max_examples=300, deadline=None)
@given(
    st.one_of(
        st.text(max_size=60),
        st.text("aetn  ▁\n\t#$1éß中😀\0\x85.,;:!?)(ig", max_size=80),
        st.lists(st.sampled_from(["the", "ing", " " * 17, "<s>", "</s>", "<0x0A>", "...", "\n"])).map(
            "".join
        ),
    )
)
def test_as_the_library(library, model, text):
    ids = library.encode(text)
    assert model.encode(text) == ids
    assert model.decode(ids) == library.decode(ids)


def test_compatible_pairs_are_those_that_merge_to_themselves(model):
    for a in range(262, 3000, 37):
        for b in range(261, 2500, 41):
            one, other = model.pieces[a], model.pieces[b]
            if pieces.BLANK in one + other:
                continue
            assert model._remerge(a, b) == (model.merge(one + other) == [one, other])


def test_tables_that_overflow_change_nothing(library, model, monkeypatch):
    monkeypatch.setattr(pieces, "KEPT_CHUNKS", 3)
    monkeypatch.setattr(pieces, "KEPT_PAIRS", 5)
    texts = [f"word{n} othering, {n * 7} things" for n in range(40)]
    assert [model.encode(t) for t in texts] == library.encode(texts)


def test_rows(spark, library):
    rows = [*hard_rows(), (9, "x" * 20_000), (10, "▁ a  b\r\n"), (10, "▁ a  b\r\n")]
    docs = documents(spark, rows, extra=True)
    made = pieces.decoded(pieces.encoded(docs, PATH, keep=["doc_id", "key"]), PATH)
    got = [(r.doc.doc_id, tuple(r.ids), r.decoded) for r in made.collect()]
    want = []
    for row in rows:
        ids = library.encode(row[1] or "")
        want.append((row[0], tuple(ids), library.decode(ids)))
    assert sorted(map(str, got)) == sorted(map(str, want))
    empty = pieces.decoded(pieces.encoded(documents(spark, []), PATH, keep=["doc_id"]), PATH)
    assert empty.count() == 0


def test_query(spark, library):
    import __spark_entry__ as registered

    folder = "/root/testdata/sf0.001"
    texts = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()

    def digest(text):
        return hashlib.sha256(text.encode()).hexdigest()

    want = {}
    for doc_id, text in texts:
        ids = library.encode(text or "")
        want[doc_id] = (len(ids), digest(",".join(map(str, ids))), digest(library.decode(ids)))
    rows = registered.queries()["op8_sentencepiece"](spark, folder).collect()
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows} == want
