"""Metrics on ranked predictions.

``predictions(model_id, entity_id, segment, as_of_date, score, label_name, label, k, segment_k)``
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MODEL_KEYS = ["model_id", "as_of_date"]
BLOCK = 1_000_000


def _hits(label: Column, inside: Column | None = None) -> Column:
    flag = label if inside is None else label & inside
    return F.sum(F.when(flag, 1).otherwise(0))


def in_top(segment_ks: Mapping[str, int] | None = None, total_k: int | None = None) -> Column:
    """Whether a row is predicted positive: its overall rank, or the rank in its segment, is within k."""
    if total_k is not None:
        return F.coalesce(F.col("k") <= total_k, F.lit(False))
    if not segment_ks:
        raise ValueError("give segment_ks or total_k")
    test = F.lit(False)
    for segment, k in segment_ks.items():
        test = test | ((F.col("segment") == segment) & (F.col("segment_k") <= k))
    return F.coalesce(test, F.lit(False))


def precision_recall_at_k(predictions: DataFrame, k: int, segment: str | None = None) -> DataFrame:
    """Precision (over k, also where fewer rows exist) and recall at k per model and date.

    With a ``segment`` only its rows count and ``segment_k`` is the rank.
    """
    rows = predictions if segment is None else predictions.where(F.col("segment") == segment)
    inside = F.col("k" if segment is None else "segment_k") <= k
    sums = rows.groupBy(*MODEL_KEYS).agg(_hits(F.col("label"), inside).alias("_top"), _hits(F.col("label")).alias("_pos"))
    return sums.select(
        *MODEL_KEYS,
        (F.col("_top") / F.lit(k)).alias("precision"),
        F.when(F.col("_pos") == 0, 0.0).otherwise(F.col("_top") / F.col("_pos")).alias("recall"),
    )


def evaluation_rows(predictions: DataFrame, k: int, segment_ks: Mapping[str, int], overall: bool = True) -> DataFrame:
    """Long evaluation table: per segment at its k, overall at k, and precision at the last k.

    One aggregate over the predictions gives every sum; its row per model and date is then laid
    out long. With ``overall=False`` (models of one segment) the last-k precision is the segment's.
    """
    label = F.col("label")
    sums = [_hits(label, F.col("k") <= k).alias("top"), _hits(label).alias("pos"), F.max("k").alias("last_k")]
    for i, (segment, limit) in enumerate(segment_ks.items()):
        own = F.col("segment") == segment
        sums += [
            _hits(label & own, F.col("segment_k") <= limit).alias(f"top_{i}"),
            _hits(label & own).alias(f"pos_{i}"),
            F.max(F.when(own, F.col("segment_k"))).alias(f"last_k_{i}"),
        ]
    wide = predictions.groupBy(*MODEL_KEYS).agg(*sums)

    def row(segment: str | None, metric: str, at: Column, value: Column) -> Column:
        none = F.lit(None).cast("long")
        return F.struct(
            F.lit(segment).cast("string").alias("segment"),
            F.lit(metric).alias("metric"),
            (none if segment else at.cast("long")).alias("k"),
            (at.cast("long") if segment else none).alias("segment_k"),
            value.cast("double").alias("value"),
        )

    def recall(top: str, pos: str) -> Column:
        return F.when(F.col(pos) == 0, 0.0).otherwise(F.col(top) / F.col(pos))

    rows = []
    for i, (segment, limit) in enumerate(segment_ks.items()):
        rows.append(row(segment, "precision", F.lit(limit), F.col(f"top_{i}") / F.lit(limit)))
        rows.append(row(segment, "recall", F.lit(limit), recall(f"top_{i}", f"pos_{i}")))
        if not overall:
            last = F.col(f"last_k_{i}")
            rows.append(row(segment, "precision", last, F.try_divide(F.col(f"pos_{i}"), last)))
    if overall:
        rows.append(row(None, "precision", F.lit(k), F.col("top") / F.lit(k)))
        rows.append(row(None, "recall", F.lit(k), recall("top", "pos")))
        rows.append(row(None, "precision", F.col("last_k"), F.col("pos") / F.col("last_k")))
    return wide.select(*MODEL_KEYS, F.inline(F.array(*rows)))


def running_hits(
    predictions: DataFrame, by: Sequence[str], rank: str, name: str, total: str, block: int = BLOCK
) -> DataFrame:
    """Positives up to each rank (``name``) and in all (``total``) inside ``by``.

    Ranks are dense, so blocks of ``block`` ranks are even pieces: block sums are added up in a
    small table and each block runs its own sum.
    """
    by = list(by)
    rows = predictions.withColumn("_block", F.floor((F.col(rank) - 1) / block)).withColumn(
        "_hit", F.when(F.col("label"), 1).otherwise(0)
    )
    before = Window.partitionBy(*by).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    sums = (
        rows.groupBy(*by, "_block")
        .agg(F.sum("_hit").alias("_s"))
        .select(
            *by,
            "_block",
            F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_start"),
            F.sum("_s").over(Window.partitionBy(*by)).alias(total),
        )
    )
    inside = Window.partitionBy(*by, "_block").orderBy(rank).rowsBetween(Window.unboundedPreceding, 0)
    return (
        rows.withColumn("_in", F.sum("_hit").over(inside))
        .join(sums, [*by, "_block"], "inner")
        .withColumn(name, F.col("_start") + F.col("_in"))
        .drop("_block", "_hit", "_in", "_start")
    )


def pr_curve(predictions: DataFrame, segment: str | None = None, block: int = BLOCK) -> DataFrame:
    """Precision and recall at every rank; recall is 0 where nothing is positive."""
    rank = "k" if segment is None else "segment_k"
    rows = predictions if segment is None else predictions.where(F.col("segment") == segment)
    out = running_hits(rows, MODEL_KEYS, rank, "_cum", "_pos", block)
    return (
        out.withColumn("precision", F.col("_cum") / F.col(rank))
        .withColumn("recall", F.when(F.col("_pos") == 0, 0.0).otherwise(F.col("_cum") / F.col("_pos")))
        .drop("_cum", "_pos")
    )


def melt_metrics(curve: DataFrame, metrics: Sequence[str] = ("precision", "recall"), value: str = "value") -> DataFrame:
    ids = [c for c in curve.columns if c not in metrics]
    return curve.unpivot(ids, list(metrics), "metric", value)


def full_curve(predictions: DataFrame, block: int = BLOCK) -> DataFrame:
    """Long curve of any number of models with the overall and the segment value side by side."""
    rows = running_hits(predictions, MODEL_KEYS, "k", "_cum", "_pos", block)
    rows = running_hits(rows, [*MODEL_KEYS, "segment"], "segment_k", "_scum", "_spos", block)
    recall = lambda cum, pos: F.when(F.col(pos) == 0, 0.0).otherwise(F.col(cum) / F.col(pos))
    pairs = F.array(
        F.struct(
            F.lit("precision").alias("metric"),
            (F.col("_cum") / F.col("k")).alias("value"),
            (F.col("_scum") / F.col("segment_k")).alias("segment_value"),
        ),
        F.struct(
            F.lit("recall").alias("metric"),
            recall("_cum", "_pos").alias("value"),
            recall("_scum", "_spos").alias("segment_value"),
        ),
    )
    return rows.select(*predictions.columns, F.inline(pairs))


def confusion_matrix(
    predictions: DataFrame, segment_ks: Mapping[str, int] | None = None, total_k: int | None = None
) -> DataFrame:
    """Counts for all four (label, prediction) pairs per model and date, zeros included."""
    rows = predictions if total_k is not None else predictions.where(F.col("segment").isin(list(segment_ks)))
    pred = in_top(segment_ks, total_k)
    cell = lambda y, p: F.sum(F.when((F.col("label") == y) & (pred == p), 1).otherwise(0))
    cells = {(y, p): f"c{int(y)}{int(p)}" for y in (False, True) for p in (False, True)}
    wide = rows.groupBy(*MODEL_KEYS).agg(*[cell(y, p).alias(n) for (y, p), n in cells.items()])
    return wide.select(
        *MODEL_KEYS,
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(int(y)).alias("label"), F.lit(int(p)).alias("prediction"), F.col(n).alias("n"))
                    for (y, p), n in cells.items()
                ]
            )
        ),
    )


def add_prediction(df: DataFrame, segment_ks: Mapping[str, int] | None = None, total_k: int | None = None, name: str = "prediction") -> DataFrame:
    return df.withColumn(name, in_top(segment_ks, total_k).cast("int"))


def features_with_predictions(
    features: DataFrame, predictions: DataFrame, segment_ks: Mapping[str, int] | None = None, total_k: int | None = None
) -> DataFrame:
    """Feature rows of predicted entities with score, label, ranks and a 0/1 ``pred``."""
    rows = predictions if total_k is not None else predictions.where(F.col("segment").isin(list(segment_ks)))
    return add_prediction(features.join(rows, ["entity_id", "as_of_date"], "inner"), segment_ks, total_k, "pred")


def right_closed_bin(value: Column, edges: Sequence[float], names: Sequence[str]) -> Column:
    """Bin ``(edge, next edge]``; outside all bins (and NULL) is the text ``nan``."""
    if len(edges) != len(names) + 1:
        raise ValueError("there must be one more edge than names")
    out = None
    for low, high, name in zip(edges, edges[1:], names):
        test = (value > low) & (value <= high)
        out = F.when(test, name) if out is None else out.when(test, name)
    return out.otherwise("nan")


def crosstab(features_preds: DataFrame, column: Column, against: str) -> DataFrame:
    """Long cross table: rows per (value, label or prediction)."""
    return features_preds.groupBy(column.alias("value"), F.col(against).cast("int").alias(against)).agg(
        F.count(F.lit(1)).alias("n")
    )


def crosstab_wide(features_preds: DataFrame, column: Column, against: str, values: Sequence[str]) -> DataFrame:
    """One row per label or prediction and one count column per listed value."""
    return (
        features_preds.withColumn("_v", column)
        .groupBy(F.col(against).cast("int").alias(against))
        .agg(*[F.sum(F.when(F.col("_v") == v, 1).otherwise(0)).alias(f"n_{v}") for v in values])
    )


def split_label_predictions(predictions: DataFrame, split_labels: DataFrame, segment_ks: Mapping[str, int]) -> DataFrame:
    """True predictions with the split labels that made them true, and the 0/1 prediction."""
    true_names = split_labels.where("label").select(
        "entity_id", "as_of_date", F.col("label_name").alias("split_label_name"), F.col("label").alias("split_label")
    )
    return add_prediction(predictions.where("label").join(true_names, ["entity_id", "as_of_date"], "inner"), segment_ks)


def split_label_counts(cohort: DataFrame, split_labels: DataFrame) -> DataFrame:
    """Distinct cohort entities per date and true label name."""
    rows = split_labels.where("label").select("entity_id", "as_of_date", "label_name").distinct()
    return (
        rows.join(cohort.select("entity_id", "as_of_date").distinct(), ["entity_id", "as_of_date"], "left_semi")
        .groupBy("as_of_date", "label_name")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def label_counts(
    split_labels: DataFrame, label_names: Sequence[str], label_group: str, segment: str, distinct_entities: bool = False
) -> DataFrame:
    """True labels over time for one segment, as rows or as distinct entities."""
    rows = split_labels.where(
        F.col("label") & F.col("label_name").isin(list(label_names)) & (F.col("segment") == segment)
    ).select("as_of_date", "entity_id")
    if distinct_entities:
        rows = rows.distinct()
    return rows.groupBy("as_of_date").agg(F.count(F.lit(1)).alias("n")).select(
        "as_of_date", F.lit(segment).alias("segment"), F.lit(label_group).alias("label_group"), "n"
    )


def repair_evaluations(evaluations: DataFrame, predictions: DataFrame, segment: str, k: int) -> DataFrame:
    """Recompute a segment's metrics at k from predictions.

    Stored values that differ are replaced, stored rows of models without predictions are
    dropped, all other rows stay. ``action`` says what happened to a row.
    """
    fresh = precision_recall_at_k(predictions, k, segment)
    fresh = fresh.unpivot(MODEL_KEYS, ["precision", "recall"], "metric", "fresh").withColumn("_has", F.lit(True))
    target = F.coalesce((F.col("segment") == segment) & (F.col("segment_k") == k), F.lit(False))
    joined = evaluations.withColumn("_target", target).join(fresh, [*MODEL_KEYS, "metric"], "left")
    known = predictions.where(F.col("segment") == segment).select("model_id").distinct().withColumn("_known", F.lit(True))
    joined = joined.join(known, "model_id", "left")
    action = (
        F.when(~F.col("_target"), "keep")
        .when(F.col("_known").isNull(), "delete")
        .when(F.col("_has") & (F.col("fresh") != F.col("value")), "update")
        .otherwise("keep")
    )
    return (
        joined.withColumn("action", action)
        .where("action <> 'delete'")
        .withColumn("value", F.when(F.col("action") == "update", F.col("fresh")).otherwise(F.col("value")))
        .select(*evaluations.columns, "action")
    )


def score_distribution(predictions: DataFrame, bins: int = 20) -> DataFrame:
    """Binned score counts and shares per label; scores lie in [0, 1]."""
    bin_of = F.least(F.floor(F.col("score") * bins), F.lit(bins - 1)).cast("int")
    counts = predictions.groupBy("model_id", "label", bin_of.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy("model_id", "label")
    return counts.withColumn("share", F.col("n") / F.sum("n").over(whole))


def mean_importances(importances: DataFrame, top: int, model_ids: Sequence[int] | None = None) -> DataFrame:
    """Mean importance per feature over models, the ``top`` largest by absolute value."""
    rows = importances if model_ids is None else importances.where(F.col("model_id").isin(list(model_ids)))
    return (
        rows.groupBy("feature_name")
        .agg(F.avg("feature_importance").alias("feature_importance"))
        .orderBy(F.abs("feature_importance").desc(), "feature_name")
        .limit(top)
    )
