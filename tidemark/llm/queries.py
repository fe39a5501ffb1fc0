"""The registered queries of this subpackage, one per operator, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from tidemark.llm import bpe, collocations, langid, licenses, minhash, packing, quality, repeats, sharding, spelling, toxicity, vectors, warc
from tidemark.llm.common import remainder_of_crc, table

QUERIES = {}
ORACLE = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_quality_rules(spark, sf):
    docs = table(spark, sf, "documents")
    model = quality.fit_quality(docs, table(spark, sf, "labels"), F.lit(True))
    return quality.judge(docs, model)


@query
def op2_warc_index(spark, sf):
    return warc.archive_pages(table(spark, sf, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE["op2_warc_index"] = warc.ORACLE_SQL


@query
def op3_language_id(spark, sf):
    docs = table(spark, sf, "documents")
    held_out = remainder_of_crc("doc_id", 4) == 2
    model = langid.fit_languages(docs, public_tokenizers.path("piece_bpe_32k.model"), ~held_out)
    return langid.identify(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query
def op4_minhash_near_dedup(spark, sf):
    return minhash.near_duplicates(table(spark, sf, "documents"))


ORACLE["op4_minhash_near_dedup"] = minhash.oracle_sql()


@query
def op5_best_fit_packing(spark, sf):
    return packing.pack_documents(table(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op6_byte_bpe(spark, sf):
    return bpe.encode_documents(table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@query
def op7_embedding_near_dedup(spark, sf):
    return vectors.near_duplicate_vectors(table(spark, sf, "embeddings"))


ORACLE["op7_embedding_near_dedup"] = vectors.oracle_sql()


@query
def op8_toxicity(spark, sf):
    docs = table(spark, sf, "documents")
    held_out = remainder_of_crc("doc_id", 3) == 1
    model = toxicity.fit_toxicity(docs, table(spark, sf, "labels"), ~held_out)
    return toxicity.score_toxicity(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


@query
def op9_license_scan(spark, sf):
    return licenses.scan_licenses(table(spark, sf, "documents"))


@query
def op10_sharding(spark, sf):
    placed = sharding.shard_documents(table(spark, sf, "documents"), 16)
    return placed.select(
        F.col("row.doc_id").alias("doc_id"),
        "size",
        F.coalesce(F.crc32(F.col("row.text").cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op11_spelling_variants(spark, sf):
    return spelling.spelling_variants(table(spark, sf, "documents"))


ORACLE["op11_spelling_variants"] = spelling.ORACLE_SQL


@query
def op12_repeated_passages(spark, sf):
    return repeats.remove_repeats(table(spark, sf, "documents"), with_kept=False)


ORACLE["op12_repeated_passages"] = repeats.ORACLE_SQL


@query
def op13_phrase_collocations(spark, sf):
    return collocations.collocations(table(spark, sf, "documents"))


ORACLE["op13_phrase_collocations"] = collocations.ORACLE_SQL


def load_all():
    """Registry and SQL, the pipeline's included."""
    import corpus_pipeline

    sql = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return {**QUERIES, "pipeline": corpus_pipeline.run}, {**ORACLE, **sql}
