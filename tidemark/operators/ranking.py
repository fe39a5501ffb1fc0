"""Scores and ranks.

A rank over all rows of a model is a prefix count. To keep whole models out of one task, rows
are cut into ordered buckets, buckets are counted (a small table), and a row's rank is the
count of the buckets before its own plus its place inside the bucket.
"""

from __future__ import annotations

import itertools
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.session import stored

TIE_SLOTS = 64
FLIP = "__flip__"


def tie_order(entity: str = "entity_id") -> list[Column]:
    """Order among equal scores: by ``entity_id mod 64``, then by id.

    The first key lets a large group of equal scores be ranked in 64 tasks.
    """
    return [F.pmod(F.col(entity), F.lit(TIE_SLOTS)), F.col(entity)]


def score_cuts(df: DataFrame, score: str = "score", rows_per_task: int = 2_000_000) -> list[float]:
    """Score values that split the table in pieces of about ``rows_per_task`` rows.

    One aggregate over the score column brings back at most 1,000 numbers; none for a table
    that fits one task. The cuts only spread the work, ranks do not depend on them.
    """
    shares = ", ".join(f"{i / 1000}D" for i in range(1, 1000))
    row = df.agg(
        F.count(score).alias("n"),
        F.expr(f"percentile_approx(`{score}`, array({shares}), 10000)").alias("q"),
    ).first()
    if not row.n or row.n <= rows_per_task:
        return []
    step = max(1, 1000 * rows_per_task // row.n)
    cuts = set(row.q[step - 1 :: step]) | {v for v, nxt in zip(row.q, row.q[1:]) if v == nxt}
    return sorted(float(c) for c in cuts)


def add_rank(
    df: DataFrame,
    by: Sequence[str],
    name: str,
    score: str = "score",
    entity: str = "entity_id",
    cuts: Sequence[float] | None = None,
) -> DataFrame:
    """Rank 1..n by falling score inside ``by``, ties in ``tie_order``."""
    order = [F.desc(score), *tie_order(entity)]
    if not cuts:
        return df.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order)).cast("long"))
    keys = [*by, "_b", "_t"]
    cut = _in_buckets(df, cuts, score, entity)
    starts = _starts(cut.groupBy(*keys).count(), by, "_start")
    inside = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    ranked = cut.withColumn("_r", inside).join(starts, keys, "inner")
    return ranked.select(*df.columns, (F.col("_r") + F.col("_start")).cast("long").alias(name))


def _cuts_below(value: Column, cuts: Sequence[float]) -> Column:
    """How many of the sorted cuts are below a value, found by halving."""
    edges = F.array(*[F.lit(float(c)) for c in cuts])
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(len(cuts).bit_length()))])
    further = lambda at, step: (at + step <= len(cuts)) & (F.get(edges, at + step - 1) < value)
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(further(at, step), at + step).otherwise(at))


def _in_buckets(df: DataFrame, cuts: Sequence[float], score: str, entity: str) -> DataFrame:
    """Rows with their bucket ``_b`` and slot ``_t``.

    Even buckets lie between two cuts, odd ones hold the rows equal to a cut; only the latter
    (equal scores throughout) are split further by tie slot.
    """
    edges = F.array(*[F.lit(float(c)) for c in cuts])
    equal = F.get(edges, F.col("_above")) == F.col(score).cast("double")
    return (
        df.withColumn("_above", _cuts_below(F.col(score).cast("double"), cuts))
        .withColumn("_b", 2 * F.col("_above") + F.when(equal, 1).otherwise(0))
        .withColumn("_t", F.when(equal, F.pmod(F.col(entity), F.lit(TIE_SLOTS))).otherwise(F.lit(0)))
        .drop("_above")
    )


def _starts(counts: DataFrame, by: Sequence[str], name: str) -> DataFrame:
    """Rows of the buckets before each bucket, from ``count`` by (by, _b, _t)."""
    before = Window.partitionBy(*by).orderBy(F.desc("_b"), "_t").rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(*by, "_b", "_t", F.coalesce(F.sum("count").over(before), F.lit(0)).alias(name))


def rank_predictions(
    df: DataFrame, rows_per_task: int = 2_000_000, cuts: Sequence[float] | None = None
) -> DataFrame:
    """Add ``k`` (overall) and ``segment_k`` to predictions, per model and as-of date.

    ``cuts`` are measured unless given. For scores that are costly to compute, write them to
    a table first and rank that.
    """
    cuts = score_cuts(df, rows_per_task=rows_per_task) if cuts is None else cuts
    by, own = ["model_id", "as_of_date"], ["model_id", "as_of_date", "segment"]
    if not cuts:
        return add_rank(add_rank(df, by, "k"), own, "segment_k")
    # Both ranks come from the same buckets: one exchange of the rows, one table of counts.
    cut = _in_buckets(df, cuts, "score", "entity_id")
    counts = cut.groupBy(*own, "_b", "_t").count()
    overall = _starts(counts.groupBy(*by, "_b", "_t").agg(F.sum("count").alias("count")), by, "_start")
    starts = _starts(counts, own, "_own_start").join(overall, [*by, "_b", "_t"], "inner")
    order = [F.desc("score"), *tie_order()]
    inside = lambda keys: F.row_number().over(Window.partitionBy(*keys, "_b", "_t").orderBy(*order))
    ranked = cut.withColumn("_r", inside(by)).withColumn("_own", inside(own)).join(starts, [*own, "_b", "_t"], "inner")
    k, own_k = (F.col("_r") + F.col("_start")).cast("long"), (F.col("_own") + F.col("_own_start")).cast("long")
    return ranked.select(*df.columns, k.alias("k"), own_k.alias("segment_k"))


def attach_labels(scores: DataFrame, labels: DataFrame) -> DataFrame:
    """Predictions of labelled entities: ``labels`` carry the segment and the label."""
    return labels.join(scores, ["entity_id", "as_of_date"], "inner")


# ---- rankers ---------------------------------------------------------------------------


def sum_before(
    df: DataFrame, by: Sequence[str], order: str, amount: str, name: str, cuts: Sequence[float] = ()
) -> DataFrame:
    """Sum of ``amount`` over the rows of ``by`` with a smaller ``order`` (distinct inside ``by``).

    With ``cuts`` the groups are summed in buckets, so that a large group is not one task.
    """
    by = list(by)
    if not cuts:
        before = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return df.withColumn(name, F.coalesce(F.sum(amount).over(before), F.lit(0)))
    edges = F.array(*[F.lit(float(c)) for c in cuts])
    rows = df.withColumn("_b", F.size(F.filter(edges, lambda c: c < F.col(order))))
    keys = [*by, "_b"]
    before = Window.partitionBy(*by).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy(*keys).agg(F.sum(amount).alias("_s"))
    starts = starts.select(*keys, F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_start"))
    out = rows.withColumn("_in", F.coalesce(F.sum(amount).over(inside), F.lit(0))).join(starts, keys, "inner")
    return out.withColumn(name, F.col("_start") + F.col("_in")).drop("_b", "_in", "_start")


def feature_ranker(
    df: DataFrame, features: Sequence[str], by: Sequence[str] = ("as_of_date",), rows_per_task: int = 2_000_000
) -> DataFrame:
    """Average-rank percentile of the features in lexicographic order, 1 is highest.

    A feature written ``__flip__name`` ranks from low to high; NULL ranks lowest. Rows are first
    counted per distinct combination of values, which takes care of any number of ties. The rows
    below a combination are, feature by feature, those that agree on the features before and
    have less in this one. ``by`` are settings of a run (dates, folds, models): one row for each
    is broadcast.

    Combinations that hold over a thousandth of their group's rows (so fewer than a thousand per
    group) get their scores by broadcast, all others by a join in which no key is large.
    """
    by = list(by)
    terms = []
    for i, f in enumerate(features):
        flip = f.startswith(FLIP)
        column = F.col(f[len(FLIP) :] if flip else f).cast("double")
        term = F.coalesce(-column if flip else column, F.lit(float("-inf")))
        terms.append(term.alias(f"_f{i}"))
    names = [f"_f{i}" for i in range(len(terms))]
    keyed = df.select("*", *terms)
    combos = stored(keyed.groupBy(*by, *names).agg(F.count(F.lit(1)).alias("_n")), "combinations")
    sizes = combos.groupBy(*by).agg(F.sum("_n").alias("_all"))
    out = combos.join(F.broadcast(sizes), by, "inner")
    below = F.lit(0)
    for i, name in enumerate(names):
        group = [*by, *names[:i]]
        counts = combos.groupBy(*group, name).agg(F.sum("_n").alias("_c"))
        counts = sum_before(counts, group, name, "_c", f"_below{i}", score_cuts(counts, name, rows_per_task))
        out = out.join(counts.drop("_c"), [*group, name], "inner")
        below = below + F.col(f"_below{i}")
    score = (below + (F.col("_n") + 1) / 2) / F.col("_all")
    scored = stored(out.select(*by, *names, score.alias("score"), (F.col("_n") * 1000 > F.col("_all")).alias("_common")), "scores")
    key = [*by, *names]
    common = F.broadcast(scored.where("_common").drop("_common"))
    rare = scored.where("not _common").drop("_common")
    rest = keyed.join(common.drop("score"), key, "left_anti").join(rare, key, "inner")
    return keyed.join(common, key, "inner").union(rest).drop(*names)


def linear_ranker(
    df: DataFrame, weights: Mapping[str, float], by: Sequence[str] = ("as_of_date",)
) -> DataFrame:
    """Weighted sum with weights scaled to sum 1, then min-max to [0, 1] inside ``by``.

    If all raw scores are equal the score is 0. ``by`` are settings of a run (dates, folds,
    models): one row of bounds for each is broadcast.
    """
    by = list(by)
    total = float(sum(weights.values()))
    raw = None
    for name, w in weights.items():
        term = F.lit(w / total) * F.col(name)
        raw = term if raw is None else raw + term
    scored = df.withColumn("_raw", raw)
    span = scored.groupBy(*by).agg(F.min("_raw").alias("_lo"), F.max("_raw").alias("_hi"))
    out = scored.join(F.broadcast(span), by, "inner")
    score = F.when(F.col("_hi") > F.col("_lo"), (F.col("_raw") - F.col("_lo")) / (F.col("_hi") - F.col("_lo")))
    return out.withColumn("score", F.coalesce(score, F.lit(0.0))).drop("_raw", "_lo", "_hi")


def ranker_importances(
    spark: SparkSession, columns: Sequence[str], features: Sequence[str], weights: Sequence[float] | None = None
) -> DataFrame:
    """Importance per matrix column: weights, or n, n-1, ..., 1 for ranked features, as shares."""
    plain = [f[len(FLIP) :] if f.startswith(FLIP) else f for f in features]
    missing = set(plain) - set(columns)
    if missing:
        raise ValueError(f"not in the matrix: {sorted(missing)}")
    values = dict(zip(plain, weights if weights is not None else range(len(plain), 0, -1)))
    total = float(sum(values.values()))
    return spark.createDataFrame(
        [(c, float(values.get(c, 0)) / total) for c in columns], "feature_name string, feature_importance double"
    )


def model_grid(params: Mapping[str, Mapping[str, Sequence]]) -> list[tuple[str, dict]]:
    """Every parameter combination of every model type."""
    return [
        (kind, dict(zip(options, combo)))
        for kind, options in params.items()
        for combo in itertools.product(*options.values())
    ]
