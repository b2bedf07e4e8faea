"""From raw documents to a token mix: five stages, each over all rows that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waitline.llm import line_dedup, mixing, ngram_join, pieces, quality
from waitline.llm.queries import PIECE_MODEL
from waitline.llm.staging import stage


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the certified cutoffs of their language.

    Documents are measured once for the cutoffs, of which only numbers are joined to the labels,
    and once to be judged, so no text is written or shuffled in between. Null texts are empty and
    go, as all short ones; a null language is one of its own; rows without doc_id have no label;
    repeated rows are judged alike. Other columns stay as they are, whatever their names.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    measures = quality.measured(docs.select("doc_id", "lang", "text"))
    holdout = measures.select("doc.doc_id", "doc.lang", "*")
    cutoffs = stage(quality.certified_cutoffs(holdout, labels))
    rows = quality.measured(docs).withColumn("lang", F.col("doc.lang"))
    return quality.judged(rows, cutoffs).filter("kept").select("doc.*")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later occurrences of three-line windows; every document stays.

    What the operator does with null and empty texts, repeated rows and ties holds here: a null
    text stays null, of equal windows the one of the smallest doc_id and row stays.
    """
    return line_dedup.without_repeated_lines(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of the n-gram join, at five words and 0.8.

    Of rows equal in doc_id and text one stays; null texts and those without words all stay.
    """
    return ngram_join.one_of_each(docs, words=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, which may be never; a null source is a source.

    The coin is drawn from the doc_id, so repeated rows are taken alike and reruns agree.
    """
    return mixing.mixed(docs)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document of the mix, and the digest of the text that they decode to.

    One row for each row of the mix. Null and empty texts have no ids and decode to nothing.
    """
    encoded = pieces.encoded(docs, PIECE_MODEL, keep=["doc_id", "source"])
    return pieces.decoded(encoded, PIECE_MODEL).select(
        "doc.doc_id",
        "doc.source",
        F.size("ids").cast("long").alias("n_tokens"),
        "ids",
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality rules", keep_good),
    ("line dedup", drop_repeated_lines),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing to target weights", mix_sources),
    ("SentencePiece encoding", encode_texts),
]

#: No SQL expresses binomial bounds, signature trees or the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is written and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, function) in enumerate(STAGES):
        docs = function(spark, docs if number == 0 else stage(docs), sf_dir)
    return docs
