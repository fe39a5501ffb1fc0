"""Group metrics of predictions by attribute, and their disparity to a reference group."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.evaluation import in_top

MISSING = "MISSING"
COUNTS = ["tp", "fp", "tn", "fn"]
METRICS = ["tpr", "tnr", "for", "fdr", "fpr", "fnr", "npv", "precision", "ppr", "pprev", "prev"]


def modal_attributes(attributes: DataFrame, names: Sequence[str]) -> DataFrame:
    """Most frequent value per entity and attribute (smallest on ties), wide, MISSING if none.

    ``attributes(entity_id, attribute_type, attribute_value)``. Values are counted first, so
    the pick is a min over (-count, value) of distinct values.
    """
    counts = (
        attributes.where(F.col("attribute_value").isNotNull())
        .groupBy("entity_id", "attribute_type", "attribute_value")
        .agg((-F.count(F.lit(1))).alias("neg"))
    )
    everyone = attributes.select("entity_id").distinct()
    best = counts.groupBy("entity_id").agg(
        *[
            F.min(F.when(F.col("attribute_type") == n, F.struct("neg", "attribute_value")))["attribute_value"].alias(n)
            for n in names
        ]
    )
    return everyone.join(best, "entity_id", "left").select(
        "entity_id", *[F.coalesce(n, F.lit(MISSING)).alias(n) for n in names]
    )


def join_attributes(predictions: DataFrame, wide: DataFrame, names: Sequence[str]) -> DataFrame:
    out = predictions.join(wide, "entity_id", "left").withColumn("label_value", F.col("label").cast("int"))
    for n in names:
        out = out.withColumn(n, F.coalesce(n, F.lit(MISSING)))
    return out


def enrich_attributes(
    df: DataFrame, extra: DataFrame, names: Sequence[str], recode: Mapping[str, Mapping[str, str]] | None = None
) -> DataFrame:
    """Fill MISSING attributes from a second table and keep one row per entity.

    A repeated entity in ``extra`` or ``df`` keeps its first row (``extra``: smallest values;
    ``df``: earliest date, then smallest model id). ``recode`` maps ``{"new name from old":
    {value: new value}}`` as ``{old: {...}}`` in place.
    """
    second = extra.groupBy("entity_id").agg(
        F.min(F.struct(*[F.coalesce(n, F.lit(MISSING)).alias(n) for n in names])).alias("_x")
    )
    out = df.join(second, "entity_id", "left")
    for n in names:
        filled = F.when(F.col(n) == MISSING, F.coalesce(F.col(f"_x.{n}"), F.lit(MISSING))).otherwise(F.col(n))
        out = out.withColumn(n, filled)
    for n, values in (recode or {}).items():
        column = F.col(n)
        for old, new in values.items():
            column = F.when(F.col(n) == old, new).otherwise(column)
        out = out.withColumn(n, column)
    columns = [c for c in df.columns if c != "entity_id"]
    first = F.min(F.struct("as_of_date", "model_id", *[c for c in columns if c not in ("as_of_date", "model_id")]))
    return out.groupBy("entity_id").agg(first.alias("_r")).select("entity_id", *[F.col(f"_r.{c}").alias(c) for c in columns])


def _ratio(a: Column, b: Column) -> Column:
    return F.try_divide(a.cast("double"), b.cast("double"))


def group_metrics(
    df: DataFrame,
    attributes: Sequence[str],
    segment_ks: Mapping[str, int] | None = None,
    total_k: int | None = None,
    by: Sequence[str] = ("model_id",),
) -> DataFrame:
    """Confusion counts and rates per attribute value; a rate over nothing is NULL."""
    by = list(by)
    pred = in_top(segment_ks, total_k)
    pairs = F.array(
        *[F.struct(F.lit(a).alias("attribute_name"), F.col(a).cast("string").alias("attribute_value")) for a in attributes]
    )
    long = df.select(*by, F.col("label").alias("_y"), pred.alias("_p"), F.inline(pairs))
    cell = lambda y, p: F.sum(F.when((F.col("_y") == y) & (F.col("_p") == p), 1).otherwise(0)).cast("long")
    counts = long.groupBy(*by, "attribute_name", "attribute_value").agg(
        cell(True, True).alias("tp"), cell(False, True).alias("fp"), cell(False, False).alias("tn"), cell(True, False).alias("fn")
    )
    tp, fp, tn, fn = (F.col(c) for c in COUNTS)
    size = tp + fp + tn + fn
    every = F.sum(tp + fp).over(Window.partitionBy(*by, "attribute_name"))
    return counts.withColumn("_pp_all", every).select(
        *by, "attribute_name", "attribute_value", *COUNTS, size.alias("group_size"),
        _ratio(tp, tp + fn).alias("tpr"), _ratio(tn, tn + fp).alias("tnr"), _ratio(fn, fn + tn).alias("for"),
        _ratio(fp, tp + fp).alias("fdr"), _ratio(fp, fp + tn).alias("fpr"), _ratio(fn, fn + tp).alias("fnr"),
        _ratio(tn, fn + tn).alias("npv"), _ratio(tp, tp + fp).alias("precision"), _ratio(tp + fp, F.col("_pp_all")).alias("ppr"),
        _ratio(tp + fp, size).alias("pprev"), _ratio(tp + fn, size).alias("prev"),
    )


def disparities(metrics: DataFrame, reference: Mapping[str, str], by: Sequence[str] = ("model_id",)) -> DataFrame:
    """Each metric over that of the attribute's reference value.

    The reference row comes from a window over an attribute's groups, not from a self join.
    """
    is_ref = F.lit(False)
    for name, value in reference.items():
        is_ref = is_ref | ((F.col("attribute_name") == name) & (F.col("attribute_value") == value))
    whole = Window.partitionBy(*by, "attribute_name")
    out = metrics.where(F.col("attribute_name").isin(list(reference)))
    return out.select(
        *by, "attribute_name", "attribute_value",
        *[_ratio(F.col(m), F.max(F.when(is_ref, F.col(m))).over(whole)).alias(f"{m}_disparity") for m in METRICS],
    )


def absolute_metrics(metrics: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return metrics.select(*by, "attribute_name", "attribute_value", *METRICS)
