from __future__ import annotations

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tables import documents, hard_rows

from waitline.llm import token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def cutter():
    return token_counts.Cutter(PATH)


def plain(cutter, text):
    return len(cutter.tokenizer.encode(text or "", add_special_tokens=False).ids)


@settings(max_examples=300, deadline=None)
@given(
    st.one_of(
        st.text(max_size=60),
        st.lists(
            st.sampled_from(
                ["<|endoftext|>", "<|", "|>", " ", "  ", "\n", "'s", "'", "!", "the", "中", "՘"]
            )
        ).map("".join),
    )
)
def test_pieces_have_the_tokens_of_the_text(cutter, text):
    assert sum(cutter.tokens(cutter.cut(text))) == plain(cutter, text)


@pytest.mark.parametrize("known", [0, 3, 200_000])
def test_rows(spark, cutter, monkeypatch, known):
    """Whatever part of the pre-tokens every task knows."""
    monkeypatch.setattr(token_counts, "KNOWN", known)
    rows = [*hard_rows(), (9, "<|endoftext|> and é" * 50), (10, "same same"), (11, "same same")]
    docs = documents(spark, rows, extra=True)
    got = token_counts.counted(docs, PATH, keep=["doc_id", "n_words"]).collect()
    want = [(r[0], len((r[1] or "").encode()), plain(cutter, r[1])) for r in rows]
    found = [(r.doc.doc_id, r.n_bytes, r.n_tokens) for r in got]
    assert sorted(map(str, found)) == sorted(map(str, want))


def test_no_rows(spark):
    assert token_counts.counted(documents(spark, []), PATH, keep=["doc_id"]).count() == 0


def test_query(spark, cutter):
    import __spark_entry__ as registered

    folder = "/root/testdata/sf0.001"
    texts = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    want = {d: (len((t or "").encode()), n := plain(cutter, t), n > 512) for d, t in texts}
    rows = registered.queries()["op5_token_counts"](spark, folder).collect()
    assert {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in rows} == want
