"""The registered queries of the operators: each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waitline.llm import (
    divergence,
    filter_audit,
    fixity,
    forest,
    line_dedup,
    mixing,
    ngram_join,
    page_text,
    pieces,
    quality,
    substring_dedup,
    token_counts,
    vector_dedup,
)
from waitline.llm.staging import stage

BYTE_MODEL = public_tokenizers.path("byte_bpe_50k.json")
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")
MOST_TOKENS = 512
QUERY_EVERY = 20
DECAY_EVERY = 97
Query = Callable[[SparkSession, str], DataFrame]


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def mixing_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.planned(_read(spark, sf_dir, "documents"))
    return plan.select(
        "doc.doc_id",
        "size",
        "source_size",
        "target",
        (F.col("size") * F.col("copies")).cast("long").alias("taken"),
        F.col("copies").cast("long").alias("copies"),
    )


def line_dedup_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = line_dedup.deduplicated(_read(spark, sf_dir, "documents"))
    return result.select("doc.doc_id", "n_lines", "n_removed", F.col("clean").alias("text"))


def quality_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    rows = stage(quality.measured(docs).select("doc.doc_id", "doc.lang", "*").drop("doc"))
    cutoffs = quality.certified_cutoffs(rows, _read(spark, sf_dir, "labels"))
    return quality.judged(rows, cutoffs).select(
        "doc_id", *quality.MEASURES, "n_lines", "base_failed", "kept"
    )


def page_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _read(spark, sf_dir, "pages")
    texts = page_text.extracted(pages, keep=["page_id", "url"])
    return texts.select("doc.*", "text", F.length("text").cast("long").alias("n_chars"))


def document_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    counts = token_counts.counted(docs, BYTE_MODEL, keep=["doc_id"])
    over = F.col("n_tokens") > MOST_TOKENS
    return counts.select("doc.doc_id", "n_bytes", "n_tokens", over.alias("over_limit"))


def archive_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit an archive of all pages against a replica in which some records have decayed.

    In the replica pages whose id leaves 3 by 97 have other bytes of the same length where they
    have an ``a``, and those whose id leaves 5 are lost.
    """
    pages = _read(spark, sf_dir, "pages")
    left_over = F.col("page_id") % DECAY_EVERY
    decayed = F.when(left_over == 3, F.translate("html", "a", "b")).otherwise(F.col("html"))
    here = stage(fixity.warc_index(pages))
    replica = stage(
        fixity.warc_index(pages.withColumn("html", decayed)).filter(
            F.coalesce(left_over != 5, F.lit(True))
        )
    )
    found = fixity.audit(here, replica)
    places = here.select("page_id", F.col("file").alias("of"), F.col("offset").alias("at"))
    return found.join(
        places, (F.col("file") == F.col("of")) & (F.col("offset") == F.col("at"))
    ).select("page_id", "file", "offset", "length", "status")


def nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "embeddings")
    return forest.nearest(rows, F.col("vec_id") % QUERY_EVERY == 0).select(
        "query_id", "rank", F.col("id").alias("vec_id"), "score"
    )


def piece_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pieces.encoded(_read(spark, sf_dir, "documents"), PIECE_MODEL, keep=["doc_id"])
    return pieces.decoded(rows, PIECE_MODEL).select(
        "doc.doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.clusters(_read(spark, sf_dir, "documents")).drop("print")


def ngram_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.joined(_read(spark, sf_dir, "documents")).select(
        "doc.doc_id", "n_shingles", "component_id"
    )


def source_divergences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audited(_read(spark, sf_dir, "documents"))


def near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.near_copies(_read(spark, sf_dir, "embeddings"))


def filter_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audited(
        _read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels")
    )


def queries() -> dict[str, Query]:
    return {
        "op1_mixing": mixing_plan,
        "op2_line_dedup": line_dedup_texts,
        "op3_quality_rules": quality_verdicts,
        "op9_substring_dedup": repeated_passages,
        "op10_ngram_join": ngram_components,
        "op4_page_text": page_texts,
        "op5_token_counts": document_tokens,
        "op6_warc_fixity": archive_audit,
        "op7_nearest_neighbours": nearest_vectors,
        "op8_sentencepiece": piece_round_trip,
        "op11_source_divergence": source_divergences,
        "op12_near_vectors": near_vectors,
        "op13_filter_audit": filter_orders,
    }
