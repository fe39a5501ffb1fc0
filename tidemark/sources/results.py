"""Result tables as parquet: experiments, model sets, models, predictions, evaluations, importances.

Rows are appended, never updated. Ids are hashes of what a row describes, so that a rerun gives
the same ids.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

EXPERIMENTS = "experiment_id long, event string, at timestamp, config string, trained_on string, label_group string"
MODEL_SETS = "model_set_id long, experiment_id long, type string, params string, temporal_params string"
MODELS = "model_id long, model_set_id long, train_end_date date"
EVALUATIONS = "model_id long, segment string, as_of_date date, metric string, k long, segment_k long, value double"
IMPORTANCES = "model_id long, train_end_date date, feature_name string, feature_importance double"


def stable_id(*parts: Column) -> Column:
    """Positive 63-bit id of the parts."""
    return F.abs(F.xxhash64(*parts)).cast("long")


def _arranged(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows of a table partition together, in even pieces however large the partition is."""
    return df.hint("rebalance", *partition_by) if partition_by else df


def append(df: DataFrame, folder: str, table: str, partition_by: Sequence[str] = ()) -> None:
    _arranged(df, partition_by).write.mode("append").partitionBy(*partition_by).parquet(f"{folder}/{table}")


def overwrite(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write a table anew and read it back."""
    _arranged(df, partition_by).write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.parquet(path)


def overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Replace only the partitions that ``df`` holds."""
    _arranged(df, partition_by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)


def start_experiment(
    spark: SparkSession, folder: str, config: Mapping, trained_on: str, label_group: str, at: datetime
) -> int:
    """Log the start of a run and give its id."""
    text = json.dumps(config, default=str, sort_keys=True)
    row = spark.createDataFrame([(text, trained_on, label_group, at)], "config string, trained_on string, label_group string, at timestamp")
    row = row.withColumn("experiment_id", stable_id(F.col("config"), F.col("trained_on"), F.col("at").cast("string")))
    out = row.select("experiment_id", F.lit("start").alias("event"), "at", "config", "trained_on", "label_group")
    append(out, folder, "experiments")
    return out.first().experiment_id


def end_experiment(spark: SparkSession, folder: str, experiment_id: int, at: datetime) -> None:
    row = spark.createDataFrame([(experiment_id, "end", at, None, None, None)], EXPERIMENTS)
    append(row, folder, "experiments")


def experiments(log: DataFrame) -> DataFrame:
    """One row per experiment from the log: start, end (NULL while running) and config."""
    value = lambda c: F.max(F.when(F.col("event") == "start", F.col(c))).alias(c)
    return log.groupBy("experiment_id").agg(
        F.max(F.when(F.col("event") == "start", F.col("at"))).alias("starts"),
        F.max(F.when(F.col("event") == "end", F.col("at"))).alias("ends"),
        value("config"),
        value("trained_on"),
        value("label_group"),
    )


def selected_labels(experiments: DataFrame) -> DataFrame:
    """Label names stored in the config, one row each."""
    names = F.from_json(F.get_json_object("config", "$.labels.selected_labels"), "array<string>")
    return experiments.select("experiment_id", F.explode(names).alias("label_name"))


def model_set_rows(spark: SparkSession, experiment_id: int, grid: Sequence[tuple[str, Mapping]], temporal: Mapping) -> DataFrame:
    rows = [(experiment_id, kind, json.dumps(params), json.dumps(temporal, default=str)) for kind, params in grid]
    df = spark.createDataFrame(rows, "experiment_id long, type string, params string, temporal_params string")
    return df.withColumn("model_set_id", stable_id(F.col("experiment_id"), F.col("type"), F.col("params"))).select(
        "model_set_id", "experiment_id", "type", "params", "temporal_params"
    )


def model_rows(model_sets: DataFrame, train_end_dates: Sequence) -> DataFrame:
    """A model per model set and training end."""
    ends = F.explode(F.array(*[F.lit(d).cast("date") for d in train_end_dates]))
    out = model_sets.select("model_set_id", ends.alias("train_end_date"))
    return out.select(stable_id(F.col("model_set_id"), F.col("train_end_date")).alias("model_id"), "model_set_id", "train_end_date")


def save_predictions(predictions: DataFrame, folder: str, csv: bool = False) -> str:
    """Predictions, one partition per model; CSV with a header if wanted.

    Earlier predictions of the same models are replaced, so that a retry adds nothing.
    """
    path = f"{folder}/predictions" + ("_csv" if csv else "")
    writer = _arranged(predictions, ["model_id"]).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("model_id")
    writer.option("header", True).csv(path) if csv else writer.parquet(path)
    return path


def read_predictions(spark: SparkSession, folder: str, model_ids: Sequence[int] | None = None) -> DataFrame:
    """Predictions of the given models; only their partitions are read."""
    df = spark.read.parquet(f"{folder}/predictions")
    return df if model_ids is None else df.where(F.col("model_id").isin(list(model_ids)))


def export_lists(lists: DataFrame, folder: str) -> str:
    """Outreach lists as CSV, one folder per model set."""
    path = f"{folder}/outreach_lists"
    lists.write.mode("overwrite").partitionBy("model_set_id").option("header", True).csv(path)
    return path
