"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LETTER = regex.compile(r"\p{L}")


def table(spark, sf_dir: str, name: str) -> DataFrame:
    """One table of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keyed_texts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The two columns an operator reads, as ``doc_id`` (long) and ``text`` (string).

    Whatever else the frame holds, clashing names included, goes no further.
    """
    return docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))


def slices(batch, column: int = 1, most_bytes: int = 1 << 20):
    """Parts of a batch with about ``most_bytes`` of text each (one row at least), and their texts."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype("int64").cumsum()
    start = 0
    while start < batch.num_rows:
        before = sizes[start - 1] if start else 0
        end = max(start + 1, int(sizes.searchsorted(before + most_bytes, side="right")))
        part = batch.slice(start, end - start)
        yield part, part.column(column).to_pylist()
        start = end


@contextmanager
def _setting(spark, name: str, value):
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def arrow_batches(spark, rows: int):
    """Jobs started inside send at most ``rows`` rows at once to Python, for rows that may be long; then the session's setting is back."""
    return _setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", rows)


def arrow_bytes(spark, most: int = 1 << 20):
    """Jobs started inside send about ``most`` bytes at once to Python (one row at least), however many rows; then the session's setting is back."""
    return _setting(spark, "spark.sql.execution.arrow.maxBytesPerBatch", most)


def read_batches(spark, rows: int):
    """Jobs started inside decode at most ``rows`` rows of a file at once, for rows that are long; then the session's setting is back."""
    return _setting(spark, "spark.sql.parquet.columnarReaderBatchSize", rows)


def brief_shuffles(spark):
    """Shuffle files of queries started inside go when their query ends, not when the driver happens to collect its garbage."""
    return _setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", True)


def remainder_of_crc(key: str, divisor: int):
    """crc32 of the key as text, modulo ``divisor``; a null key counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")), F.lit(divisor).cast("long"))


def text_condition(judge):
    """A filter condition on a text column, from a function that makes a judge per task: texts -> list of bool.

    Only the texts go to Python, in slices of bounded size.
    """

    @F.arrow_udf("boolean")
    def condition(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        verdict = judge()
        for texts in batches:
            kept = [k for _, part in slices(pa.RecordBatch.from_arrays([texts], names=["text"]), 0) for k in verdict(part)]
            yield pa.array(kept, pa.bool_())

    return condition


def hashed_share(key: str, share: float, seed: int):
    """True for about ``share`` of all keys, the same ones on every run."""
    return F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(1_000_000).cast("long")) < int(max(0.0, min(1.0, share)) * 1_000_000)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, usable, per_class: int, seed: int):
    """A bounded sample of labelled texts in the driver, with the weight that restores class shares.

    At most about ``per_class`` documents of each label value, the same ones on every run; of the
    texts of one doc_id the first in byte order.
    ``usable`` is a condition on doc_id. Returns a pandas frame: doc_id, text, y, weight.
    """
    from functools import reduce

    y = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y"))
    y = y.filter(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1) & usable).groupBy("doc_id").agg(F.max("y").alias("y"))
    y = y.join(docs.select("doc_id").filter("doc_id is not null").distinct(), "doc_id", "left_semi")
    counts = {r.y: r["count"] for r in y.groupBy("y").count().collect()}
    picks = [(F.col("y") == k) & hashed_share("doc_id", per_class / n, seed) for k, n in counts.items()]
    chosen = y.filter(reduce(lambda a, b: a | b, picks)) if picks else y.limit(0)
    # at most 2 x per_class ids, so the broadcast is bounded
    rows = docs.filter("text is not null").join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.first("y").alias("y"))
    rows = rows.toPandas().sort_values("doc_id", ignore_index=True)
    got = rows.groupby("y").size()
    rows["weight"] = rows["y"].map(lambda k: counts[k] / got[k]).astype(float)
    return rows
