"""Data checks. Each gives rows ``(check, ok, detail)``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _row(df: DataFrame, name: str, ok: Column, detail: Column) -> DataFrame:
    return df.select(F.lit(name).alias("check"), ok.alias("ok"), detail.cast("string").alias("detail"))


def _no_rows(bad: DataFrame, name: str) -> DataFrame:
    return _row(bad.agg(F.count(F.lit(1)).alias("n")), name, F.col("n") == 0, F.col("n"))


def dates_present(df: DataFrame, expected: Sequence[date], name: str) -> DataFrame:
    """Exactly the expected as-of dates occur."""
    wanted = df.sparkSession.createDataFrame([(d,) for d in expected], "as_of_date date").withColumn("_w", F.lit(True))
    found = df.select("as_of_date").distinct().withColumn("_f", F.lit(True))
    return _no_rows(wanted.join(found, "as_of_date", "full").where("_w is null or _f is null"), name)


def keys_unique(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    return _no_rows(df.groupBy(*keys).count().where("count > 1"), name)


def cohort_grows(cohort: DataFrame, name: str, share: float = 0.8) -> DataFrame:
    """In each segment every date has more than ``share`` of the date before."""
    counts = cohort.groupBy("segment", "as_of_date").agg(F.count(F.lit(1)).alias("n"))
    before = F.lag("n").over(Window.partitionBy("segment").orderBy("as_of_date"))
    return _no_rows(counts.withColumn("_b", before).where(F.col("_b") * share >= F.col("n")), name)


def same_counts(a: DataFrame, b: DataFrame, name: str) -> DataFrame:
    """Two tables have as many rows at every date."""
    left = a.groupBy("as_of_date").agg(F.count(F.lit(1)).alias("_a"))
    right = b.groupBy("as_of_date").agg(F.count(F.lit(1)).alias("_b"))
    return _no_rows(left.join(right, "as_of_date", "full").where("not (_a <=> _b)"), name)


def no_exited(cohort: DataFrame, exits: DataFrame, name: str) -> DataFrame:
    """Nobody is in a cohort at or after the exit."""
    gone = exits.where("exit_date is not null").groupBy("entity_id").agg(F.min("exit_date").alias("exit_date"))
    return _no_rows(cohort.join(gone, "entity_id").where("exit_date <= as_of_date"), name)


def label_span(labels: DataFrame, months_future: int, name: str) -> DataFrame:
    """For a final event, true labels of an entity span less than the horizon."""
    span = labels.where("label").groupBy("entity_id").agg(
        F.months_between(F.trunc(F.max("as_of_date"), "month"), F.trunc(F.min("as_of_date"), "month")).alias("m")
    )
    return _no_rows(span.where(F.col("m") >= months_future), name)


def in_range(df: DataFrame, column: str, low, high, name: str) -> DataFrame:
    """Every non-NULL value lies between the bounds."""
    return _no_rows(df.where(~F.col(column).between(low, high)), name)


def only_values(df: DataFrame, column: str, allowed: Sequence, name: str) -> DataFrame:
    """The column's distinct values are exactly the allowed ones."""
    wanted = df.sparkSession.createDataFrame([(v,) for v in allowed], [column]).withColumn("_w", F.lit(True))
    found = df.select(column).distinct().withColumn("_f", F.lit(True))
    return _no_rows(wanted.join(found, column, "full").where("_w is null or _f is null"), name)


def not_after(df: DataFrame, column: str, bound, name: str) -> DataFrame:
    return _no_rows(df.where(F.col(column) > F.lit(bound).cast("date")), name)


def ids_in_crosswalk(df: DataFrame, id_col: str, crosswalk: DataFrame, source: str, name: str) -> DataFrame:
    """Each resolved entity is in the crosswalk under its own source id."""
    known = crosswalk.where(F.col("source") == source).select("entity_id", F.col("sourceid").alias("_sid"))
    resolved = df.where("entity_id is not null").select("entity_id", F.col(id_col).cast("string").alias("_sid")).distinct()
    found = resolved.join(known, ["entity_id", "_sid"], "left_semi").select("entity_id").distinct()
    return _no_rows(resolved.select("entity_id").distinct().join(found, "entity_id", "left_anti"), name)


def tables_covered(listing: Mapping[str, Sequence[str]], wanted: DataFrame, name: str) -> DataFrame:
    """All wanted table names occur in the listed groups; the detail names those missing."""
    have = sorted({t for names in listing.values() for t in names})
    missing = wanted.select("table_name").distinct().where(~F.col("table_name").isin(have))
    out = missing.agg(F.concat_ws(", ", F.sort_array(F.collect_list("table_name"))).alias("m"))
    return _row(out, name, F.col("m") == "", F.col("m"))


def metrics_match(stored: DataFrame, recomputed: DataFrame, name: str, tolerance: float = 1e-9) -> DataFrame:
    """Stored metric values equal recomputed ones (``model_id, as_of_date, metric, value``)."""
    keys = ["model_id", "as_of_date", "metric"]
    both = stored.select(*keys, F.col("value").alias("_s")).join(recomputed.select(*keys, F.col("value").alias("_r")), keys, "full")
    bad = both.where(F.col("_s").isNull() | F.col("_r").isNull() | (F.abs(F.col("_s") - F.col("_r")) > tolerance))
    return _no_rows(bad, name)


def all_checks(*parts: DataFrame) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
