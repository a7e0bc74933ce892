"""Corpus pipeline: toxicity, quality rules, near-duplicates, source mix, packing.

Each stage takes what the one before kept, written as Parquet and read again.
Near-duplicates go by SimHash bit distance (three-word shingles, two bits).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnscope.llm import line_frequency, mixing, packing, simhash, toxicity
from txnscope.llm.common import table
from txnscope.llm.queries import tokenizer_path
from txnscope.session import materialize


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the severity model does not reject."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, prefix="__").where("not __toxic").select(*docs.columns)


def with_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules, without the lines that too many texts of their source share."""
    own = docs.columns
    judged = line_frequency.filter_lines(docs.select("doc_id", "text", "source", F.struct(*own).alias("__own")))
    # The row number keeps Catalyst from moving the filter below the counts, where each use would compute them anew.
    judged = judged.withColumn("__row", F.monotonically_increasing_id()).where("kept and __row >= 0")
    made = {"text": F.when(F.col("n_removed_lines") > 0, F.col("clean_text")).otherwise(F.col("__own")["text"])}
    made["n_chars"] = F.length(made["text"]).cast("bigint")
    return judged.select(*[(made[c] if c in made else F.col("__own")[c]).alias(c) for c in own])


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    return simhash.dedup(docs, shingle=3, max_bits=2)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the mix in sequences of 1024 tokens."""
    return packing.pack(docs, tokenizer_path())


STAGES = [("toxicity", without_toxic), ("quality rules", with_quality), ("simhash near-dedup", one_of_each),
          ("source mix", mixed), ("packing", packed)]

#: Fitted models, SimHash and byte-pair tokens have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents in ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialize(docs, "pipeline-" + name.replace(" ", "-"))
    return docs
