"""Which kinds of outcome the selected entities have."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEYS = ["entity_id", "as_of_date"]


def predictions_with_info(predictions: DataFrame, info: DataFrame, model_ids: Sequence[int]) -> DataFrame:
    """Predictions of several models with label group and type (full outer, as models without rows show up)."""
    wanted = list(model_ids)
    rows = predictions.where(F.col("model_id").isin(wanted))
    return rows.join(
        info.where(F.col("model_id").isin(wanted)).select("model_id", "label_group", "type"), "model_id", "full"
    )


def pivot_split_labels(split_labels: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """One boolean column per label; ``names`` maps label name to column name."""
    return (
        split_labels.where("label")
        .groupBy(*KEYS)
        .agg(*[F.max(F.col("label_name") == label).alias(column) for label, column in names.items()])
    )


def merge_predictions_labels(predictions: DataFrame, pivoted: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Full outer merge; absent labels are false."""
    out = predictions.join(pivoted, KEYS, "full")
    return out.fillna(False, subset=[*columns, "label"])


def top_rows(merged: DataFrame, segment_ks: Mapping[str, int]) -> DataFrame:
    test = F.lit(False)
    for segment, k in segment_ks.items():
        test = test | ((F.col("segment") == segment) & (F.col("segment_k") <= k))
    return merged.where(test)


def label_totals(top: DataFrame, columns: Sequence[str]) -> DataFrame:
    return top.groupBy("as_of_date", "model_id", "label_group", "type", "segment").agg(
        *[F.sum(F.col(c).cast("int")).alias(c) for c in columns]
    )


def totals_by_model(totals: DataFrame, columns: Sequence[str], model_ids: Sequence[int]) -> DataFrame:
    """Stack label columns to rows and put models side by side."""
    long = totals.select(
        "as_of_date",
        "segment",
        "model_id",
        F.inline(F.array(*[F.struct(F.lit(c).alias("label_column"), F.col(c).alias("n")) for c in columns])),
    )
    return long.groupBy("as_of_date", "label_column", "segment").agg(
        *[F.sum(F.when(F.col("model_id") == m, F.col("n"))).alias(f"model_{m}") for m in model_ids]
    )


def flagged_events(parts: Mapping[str, DataFrame], flags: Sequence[str], exits: DataFrame, exit_flag: str = "exit_flag") -> DataFrame:
    """Flagged events of several sources (tagged) plus exits, missing flags false.

    ``parts`` have ``entity_id, event_date`` and the flags; ``exits(entity_id, exit_date)``.
    """
    out = None
    for source, part in parts.items():
        rows = part.select("entity_id", "event_date", *flags).withColumn("source", F.lit(source))
        out = rows if out is None else out.unionByName(rows)
    out = out.withColumn(exit_flag, F.lit(False))
    gone = exits.select("entity_id", F.col("exit_date").alias("event_date"), F.lit(True).alias(exit_flag))
    return out.unionByName(gone, allowMissingColumns=True).fillna(False, subset=[*flags, exit_flag])
