"""Registered queries of the training-data operators, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnscope.llm import (backoff_lm, bisectors, line_frequency, mixing, multiset_hash, nn_descent, packing, simhash,
                          toxicity, url_reputation, warc, whitening, wrappers)
from txnscope.llm.common import table
from txnscope.session import materialize

RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"),
         ("block", "com/de/"))


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers
    return str(public_tokenizers.path(name))


def warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.derivatives(warc.responses_of(table(spark, sf_dir, "pages")), key="page_id")


def toxicity_severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs.select("doc_id", "text"), model) \
        .select("doc_id", "expected_severity", "grade", "p_toxic", "toxic")


def simhash_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = materialize(simhash.with_fingerprint(docs, shingle=3).select("doc_id", "fp"), "simhash-rows")
    classes = simhash.near_duplicates(rows, max_bits=2)
    return rows.join(classes, "fp").select("doc_id", simhash.fingerprint_text(F.col("fp")).alias("fingerprint"),
                                           "component_id")


def backoff_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 10 == 0
    return backoff_lm.score_documents(docs, held_out, order=2)


def wrapper_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.extract(table(spark, sf_dir, "pages")) \
        .withColumn("n_chars", F.length("text").cast("bigint"))


def packed_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def url_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_reputation.judge(table(spark, sf_dir, "pages").select("page_id", "url"), RULES) \
        .select("page_id", "host", "path", "rule", "verdict")


def source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multiset_hash.fingerprints(table(spark, sf_dir, "documents"))


def line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return line_frequency.filter_lines(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        "n_removed_lines", "words_left", "kept")


def embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nn_descent.nearest(table(spark, sf_dir, "embeddings"))


def centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bisectors.cluster(table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_warc_derivatives": warc_derivatives,
        "op2_toxicity_severity": toxicity_severity,
        "op3_simhash_classes": simhash_classes,
        "op4_backoff_scores": backoff_scores,
        "op5_wrapper_text": wrapper_text,
        "op6_packed_pieces": packed_pieces,
        "op7_url_verdicts": url_verdicts,
        "op8_source_mix": source_mix,
        "op9_document_fingerprints": document_fingerprints,
        "op10_line_quality": line_quality,
        "op11_embedding_whitening": embedding_whitening,
        "op12_nearest_neighbours": nearest_neighbours,
        "op13_centroid_clusters": centroid_clusters,
    }


def oracle_sql() -> dict[str, str]:
    return {"op7_url_verdicts": url_reputation.judge_sql(RULES), "op10_line_quality": line_frequency.filter_sql(),
            "op13_centroid_clusters": bisectors.cluster_sql()}
