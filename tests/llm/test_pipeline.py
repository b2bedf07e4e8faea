from __future__ import annotations

import hashlib

import corpus_pipeline
import sentencepiece
from pyspark.sql import functions as F
from tables import documents, prose, shingles, words
from test_line_dedup import plain as plain_lines
from test_quality import plain as plain_measures

from waitline.llm import mixing

SF = "/root/testdata/sf0.001"


def rows_of(df):
    return sorted(map(str, df.collect()))


def test_stages_on_given_documents(spark, tmp_path):
    """Each stage against a plain version on what the stage before it kept."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {}
    for name, function in corpus_pipeline.STAGES:
        path = f"{tmp_path}/{len(kept)}"
        function(spark, docs, SF).write.parquet(path)
        kept[name] = (docs, spark.read.parquet(path))
        docs = kept[name][1]

    before, after = kept["quality rules"]
    assert after.columns == before.columns
    good = before.filter(
        F.col("doc_id").isin(
            [r.doc_id for r in before.collect() if not plain_measures(r.text)["base_failed"]]
        )
    )
    # So few labels certify no cutoff, and only the base rules reject.
    assert rows_of(after) == rows_of(good)

    before, after = kept["line dedup"]
    want = plain_lines([(r.doc_id, r.text) for r in before.collect()])
    assert {r.doc_id: r.text for r in after.collect()} == want
    assert after.columns == before.columns

    before, after = kept["n-gram Jaccard join"]
    texts = {r.doc_id: shingles(r.text, 4) for r in before.collect()}
    stay = {r.doc_id for r in after.collect()}
    for doc_id in texts.keys() - stay:
        assert any(
            100 * len(texts[doc_id] & texts[o]) >= 85 * len(texts[doc_id] | texts[o])
            for o in texts
            if o != doc_id
        )
    for a in stay:
        for b in stay:
            both = len(texts[a] & texts[b])
            assert a == b or not both or 100 * both < 85 * len(texts[a] | texts[b])

    before, after = kept["mixing to target weights"]
    copies = {r.doc.doc_id: r.copies for r in mixing.planned(before).collect()}
    counts = {r.doc_id: r["count"] for r in after.groupBy("doc_id").count().collect()}
    assert counts == {d: n for d, n in copies.items() if n}
    assert after.columns == before.columns

    before, after = kept["SentencePiece encoding"]
    library = sentencepiece.SentencePieceProcessor(model_file=corpus_pipeline.PIECE_MODEL)
    texts = {r.doc_id: r.text for r in before.collect()}
    for r in after.collect():
        assert list(r.ids) == library.encode(texts[r.doc_id]) and r.n_tokens == len(r.ids)
    assert after.count() == before.count()


def test_near_copies_below_85_percent_go(spark):
    """Copies cut at the end, of 0.81 to 0.84 of the five-word shingles."""
    rows, sizes = [], (81, 82, 83, 84, 79)
    for n, size in enumerate(sizes):
        whole = prose(n, 104)
        rows += [(2 * n, whole), (2 * n + 1, " ".join(whole.split()[: size + 4]))]
    kept = corpus_pipeline.drop_near_copies(spark, documents(spark, rows), SF)
    assert sorted(r.doc_id for r in kept.collect()) == [0, 2, 4, 6, 8, 9]


def test_texts_are_decoded_again(spark):
    texts = {1: "Some words, and a line\nbelow.", 2: "", 3: prose(3, 40)}
    docs = documents(spark, list(texts.items()))
    library = sentencepiece.SentencePieceProcessor(model_file=corpus_pipeline.PIECE_MODEL)
    rows = corpus_pipeline.encode_texts(spark, docs, SF).collect()
    want = {d: library.decode(library.encode(t)).encode() for d, t in texts.items()}
    assert {r.doc_id: r.decoded_sha256 for r in rows} == {
        d: hashlib.sha256(t).hexdigest() for d, t in want.items()
    }


def test_run_with_hard_rows(spark, tmp_path):
    long = prose(1, 3_000)
    rows = [(1, None), (2, ""), (3, long), (3, long), (4, long), (None, prose(4, 80)), (5, "short")]
    documents(spark, rows, extra=True).write.parquet(f"{tmp_path}/documents.parquet")
    labels = spark.createDataFrame([(3, 1), (3, None), (None, 0)], "doc_id long, quality int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    result = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in result} <= {3, None}
    assert all(r.n_tokens >= len(words(long)) for r in result if r.doc_id == 3)


def test_run_without_rows(spark, tmp_path):
    documents(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
