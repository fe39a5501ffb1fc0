"""Tables and their columns: reading, listing, and finding related tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, table: str, folder: str | None = None) -> DataFrame:
    """A catalogue table, or the parquet file or folder ``folder/table[.parquet]``."""
    if folder is None:
        return spark.table(table)
    return spark.read.parquet(f"{folder}/{table}.parquet")


def read_jdbc(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    """A database table; give ``partitionColumn``, bounds and ``numPartitions`` for a parallel read."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()


def column_listing(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``(table_name, column_name)`` of the given tables."""
    spark = next(iter(tables.values())).sparkSession
    rows = [(t, c) for t, df in tables.items() for c in df.columns]
    return spark.createDataFrame(rows, "table_name string, column_name string")


def catalogue_listing(spark: SparkSession, database: str | None = None) -> DataFrame:
    """``(table_name, column_name)`` of a catalogue database."""
    names = [t.name for t in spark.catalog.listTables(database)]
    return column_listing({n: spark.table(f"{database}.{n}" if database else n) for n in names})


def column_overlap(listing: DataFrame, first: str, second: str) -> DataFrame:
    """Columns that two tables share."""
    a = listing.where(F.col("table_name") == first).select("column_name", F.col("table_name").alias("first_table"))
    b = listing.where(F.col("table_name") == second).select("column_name", F.col("table_name").alias("second_table"))
    return a.join(b, "column_name")


def related_tables(listing: DataFrame, table: str, name_part: str, min_shared: int = 2) -> DataFrame:
    """Tables whose name holds ``name_part`` and that share at least ``min_shared`` columns."""
    own = listing.where(F.col("table_name") == table).select("column_name")
    others = listing.where(F.contains("table_name", F.lit(name_part)) & (F.col("table_name") != table))
    return others.join(own, "column_name").groupBy("table_name").agg(
        F.count(F.lit(1)).alias("shared"), F.sort_array(F.collect_list("column_name")).alias("columns")
    ).where(F.col("shared") >= min_shared)


def feature_tables(listing: DataFrame, kinds: Sequence[str] = ("_cat", "_num")) -> DataFrame:
    """Feature tables by kind, from the ending of their names."""
    kind = None
    for k in kinds:
        test = F.endswith("table_name", F.lit(k))
        kind = F.when(test, k.lstrip("_")) if kind is None else kind.when(test, k.lstrip("_"))
    return listing.select("table_name").distinct().withColumn("kind", kind)
