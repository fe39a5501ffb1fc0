"""The training-data pipeline: language ID, quality rules, near-duplicate removal, packing."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import langid, minhash, packing, quality
from tidemark.llm.common import arrow_bytes, table
from tidemark.session import stored

#: SQL has no trained models or tokenizers.
ORACLE_SQL = None


def few_bytes(spark: SparkSession) -> None:
    """From now on texts go to Python about a megabyte at a time. It stays so, as the rows of a stage are made when they are read."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", 1 << 20)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text has an identified language. Null texts and texts without a letter go."""
    model = langid.fit_languages(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), F.lit(True))
    few_bytes(spark)
    return langid.keep_identified(docs, model)


def apply_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the trained verdict."""
    model = quality.fit_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), F.lit(True))
    few_bytes(spark)
    return quality.keep_good(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: that with the smallest doc_id. Repeated rows become one; rows without doc_id stay."""
    kept = minhash.near_duplicates(docs, shingle_words=5).filter("kept and doc_id is not null").select("doc_id").distinct()
    return docs.join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"]).unionByName(docs.filter("doc_id is null"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all documents in sequences of 4096 tokens."""
    with arrow_bytes(spark):
        return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("language_id", identify_language), ("quality_rules", apply_quality_rules), ("near_dedup", drop_near_duplicates), ("packing", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    with arrow_bytes(spark):  # the session's own setting is back in the end
        for name, stage in STAGES:
            docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
