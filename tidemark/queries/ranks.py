"""Scores, ranks and models."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import learners as ln
from tidemark.operators import matrix as mx
from tidemark.operators import ranking as rk
from tidemark.operators import trees as tr
from tidemark.queries import base as b
from tidemark.queries import matrices as mt
from tidemark.queries import temporal as tp
from tidemark.queries.base import register, t
from tidemark.session import new_table_path, stored

KEYS = ["entity_id", "as_of_date"]


@register(
    "r1_feature_ranker",
    f"""WITH {mt.MASTER}, x AS (SELECT entity_id, as_of_date, ord_n_sum_12m AS a, -ord_days_since_last AS b FROM master)
    SELECT entity_id, as_of_date, (rank() OVER (PARTITION BY as_of_date ORDER BY a, b) + (count(*) OVER (PARTITION BY as_of_date, a, b) - 1) / 2.0::DOUBLE)
      / count(*) OVER (PARTITION BY as_of_date) AS score FROM x""",
)
def _(spark, sf):
    return rk.feature_ranker(stored(mt.master(spark, sf, parts=["numbers"]), "master"), ["ord_n_sum_12m", "__flip__ord_days_since_last"]).select(*KEYS, "score")


@register(
    "r1_feature_ranker_orders",
    """SELECT o_orderkey AS entity_id, CAST(date_trunc('year', o_orderdate) AS DATE) AS as_of_date,
      (rank() OVER (PARTITION BY date_trunc('year', o_orderdate) ORDER BY -floor(o_totalprice / 10000), o_custkey % 10, o_orderkey % 3)
       + (count(*) OVER (PARTITION BY date_trunc('year', o_orderdate), floor(o_totalprice / 10000), o_custkey % 10, o_orderkey % 3) - 1) / 2.0::DOUBLE)
      / count(*) OVER (PARTITION BY date_trunc('year', o_orderdate)) AS score FROM orders""",
)
def _(spark, sf):
    rows = t(spark, sf, "orders").select(
        F.col("o_orderkey").alias("entity_id"),
        F.trunc("o_orderdate", "year").alias("as_of_date"),
        F.floor(F.col("o_totalprice") / 10000).alias("price"),
        (F.col("o_custkey") % 10).alias("c10"),
        (F.col("o_orderkey") % 3).alias("o3"),
    )
    # Pieces of 100 rows, so that the bucketed sums take part on small tables.
    return rk.feature_ranker(rows, ["__flip__price", "c10", "o3"], rows_per_task=100).select(*KEYS, "score")


WEIGHTS = {"ord_n_sum_3m": 2.0, "ord_n_sum_12m": 1.0, "ord_days_since_last": 0.25}


@register(
    "r2_ranker_importances",
    f"""WITH {mt.MASTER}, x AS (SELECT avg(ord_n_sum_3m) AS ord_n_sum_3m, avg(ord_n_sum_12m) AS ord_n_sum_12m, avg(ord_days_since_last) AS ord_days_since_last FROM master)
    SELECT feature_name, round(mean_, 6) AS mean_, CAST(CASE feature_name WHEN 'ord_n_sum_12m' THEN 2 WHEN 'ord_days_since_last' THEN 1 ELSE 0 END AS DOUBLE) / 3 AS feature_importance
    FROM (UNPIVOT x ON ord_n_sum_3m, ord_n_sum_12m, ord_days_since_last INTO NAME feature_name VALUE mean_)""",
)
def _(spark, sf):
    means = mt.master(spark, sf, parts=["numbers"]).agg(*[F.avg(c).alias(c) for c in WEIGHTS])
    long = means.unpivot([], list(WEIGHTS), "feature_name", "mean_")
    weights = rk.ranker_importances(spark, list(WEIGHTS), ["ord_n_sum_12m", "__flip__ord_days_since_last"])
    return long.join(weights, "feature_name").withColumn("mean_", F.round("mean_", 6))


@register(
    "r3_linear_ranker",
    f"""WITH {mt.MASTER}, x AS (SELECT entity_id, as_of_date, 2.0::DOUBLE / 3.25::DOUBLE * ord_n_sum_3m + 1.0::DOUBLE / 3.25::DOUBLE * ord_n_sum_12m
        + 0.25::DOUBLE / 3.25::DOUBLE * ord_days_since_last AS r FROM master)
    SELECT entity_id, as_of_date, round((r - min(r) OVER w) / (max(r) OVER w - min(r) OVER w), 9) AS score FROM x WINDOW w AS (PARTITION BY as_of_date)""",
)
def _(spark, sf):
    return rk.linear_ranker(stored(mt.master(spark, sf, parts=["numbers"]), "master"), WEIGHTS).select(*KEYS, F.round("score", 9).alias("score"))


GRID = {"DecisionTreeClassifier": {"max_depth": [1, 2], "criterion": ["gini", "entropy"]}, "LogisticRegression": {"C": [0.01, 1.0]}}


@register(
    "r4_model_grid",
    f"""WITH {b.LABELS}, {tp.SERIES_FOLDS}, grid(type, params) AS (VALUES
        ('DecisionTreeClassifier', '1,gini'), ('DecisionTreeClassifier', '1,entropy'), ('DecisionTreeClassifier', '2,gini'), ('DecisionTreeClassifier', '2,entropy'),
        ('LogisticRegression', '0.01'), ('LogisticRegression', '1.0'))
    SELECT type, params, fold_id, count(*) AS validation_rows FROM labels_ JOIN folds USING (as_of_date) CROSS JOIN grid WHERE role = 'validation' GROUP BY ALL""",
)
def _(spark, sf):
    from tidemark.plans import folds as fo

    grid = [(kind, ",".join(map(str, p.values()))) for kind, p in rk.model_grid(GRID)]
    counts = tp.labels(spark, sf).join(F.broadcast(fo.folds_frame(spark, b.FOLDS).where("role = 'validation'")), "as_of_date")
    counts = counts.groupBy("fold_id").agg(F.count(F.lit(1)).alias("validation_rows"))
    every = F.inline(F.array(*[F.struct(F.lit(k).alias("type"), F.lit(p).alias("params")) for k, p in grid]))
    return counts.select("fold_id", "validation_rows", every)


def training_parts(spark, sf):
    """Stored rows of every fold: (fold id, training part, validation part), and the columns."""
    rows, columns = mt.fold_matrix(spark, sf)
    rows = stored(rows, "matrix")
    part = lambda i, role: rows.where(f"fold_id = {i} and role = '{role}'")
    return [(i, part(i, "train"), part(i, "validation")) for i in range(len(b.FOLDS))], columns


def _by_fold(spark, sf, one):
    """``one(training part, validation part, columns)`` of every fold, with the fold id."""
    parts, columns = training_parts(spark, sf)
    frames = [one(train, validation, columns).withColumn("fold_id", F.lit(i)) for i, train, validation in parts]
    return reduce(DataFrame.unionByName, frames)


def _scores(spark, sf, kind, params):
    return _by_fold(spark, sf, lambda train, validation, columns: ln.fit(train, columns, kind, params).score(validation).select(F.lit(kind).alias("type"), *KEYS, "score"))


@register("r5_logistic_regression")
def _(spark, sf):
    return _scores(spark, sf, "LogisticRegression", {"penalty": "l2", "C": 0.1})


@register("r5_decision_tree")
def _(spark, sf):
    return _scores(spark, sf, "DecisionTreeClassifier", {"criterion": "gini", "max_depth": 5})


@register("r5_random_forest")
def _(spark, sf):
    return _scores(spark, sf, "RandomForestClassifier", {"n_estimators": 10, "max_depth": 5, "max_features": "sqrt", "min_samples_split": 10})


@register("r5_gradient_boosting")
def _(spark, sf):
    return _scores(spark, sf, "GradientBoostingClassifier", {"n_estimators": 5, "learning_rate": 0.5})


@register("r5_perceptron")
def _(spark, sf):
    return _scores(spark, sf, "MLPClassifier", {"hidden_layer_sizes": [4], "max_iter": 20})


@register("r6_adaboost")
def _(spark, sf):
    return _scores(spark, sf, "AdaBoostClassifier", {"n_estimators": 5, "learning_rate": 0.5})


TREE_FEATURES = ["ord_n_sum_3m", "ord_n_sum_12m", "ord_days_since_last"]


def _split_sql(rows: str, by: str) -> str:
    """The best split of each group of rows (fold_id, {by}, f, x, y), first feature and lowest edge on ties."""
    pure = "(({0} * {0} + {1} * {1}) / ({0} + {1}))"
    parent = pure.format("p0", "p1")
    both = pure.format("l0", "l1") + " + " + pure.format("(p0 - l0)", "(p1 - l1)")
    return f"""SELECT fold_id, {by}, f, v FROM (
        SELECT fold_id, {by}, f, v, {both} AS score, {parent} AS base FROM (
          SELECT fold_id, {by}, f, v, sum((x <= v AND y = 0)::INT)::DOUBLE AS l0, sum((x <= v AND y = 1)::INT)::DOUBLE AS l1, sum((y = 0)::INT)::DOUBLE AS p0, sum(y)::DOUBLE AS p1
          FROM {rows} JOIN edges USING (fold_id, f) GROUP BY ALL) WHERE l0 + l1 > 0 AND p0 + p1 > l0 + l1 AND p0 > 0 AND p1 > 0)
      WHERE score > base QUALIFY row_number() OVER (PARTITION BY fold_id, {by} ORDER BY score DESC, f, v) = 1"""


LONG_ROWS = f"""{mt.SLICED}, {b.LABELS.split(b.COHORT + ', ', 1)[1]}, train AS (SELECT fold_id, row_number() OVER () AS id, label::INT AS y, {", ".join(f"{c}::DOUBLE AS x{i}" for i, c in enumerate(TREE_FEATURES))}
      FROM sliced JOIN labels_ USING (entity_id, as_of_date) WHERE role = 'train'),
    long AS ({" UNION ALL ".join(f"SELECT fold_id, id, y, {i} AS f, x{i} AS x FROM train" for i in range(len(TREE_FEATURES)))}),
    placed AS (SELECT fold_id, f, x, row_number() OVER (PARTITION BY fold_id, f ORDER BY x) AS pos, count(*) OVER (PARTITION BY fold_id, f) AS n FROM long),
    vals AS (SELECT fold_id, f, count(DISTINCT x) AS d, max(x) AS top FROM long GROUP BY ALL),
    edges AS (SELECT DISTINCT fold_id, f, x AS v FROM placed JOIN vals USING (fold_id, f), range(1, 32) q(i) WHERE d > 32 AND pos = greatest(1, ceil(i / 32.0::DOUBLE * n))
      UNION SELECT DISTINCT fold_id, f, x FROM placed JOIN vals USING (fold_id, f) WHERE d <= 32 AND x < top)"""


def _tree_matrix(spark, sf):
    rows = mx.align_labels(mt.sliced(spark, sf, ["numbers"]).select("fold_id", "role", *KEYS, *TREE_FEATURES), tp.labels(spark, sf))
    return stored(rows.where("role = 'train'"), "tree-matrix")


@register(
    "r5_tree_depth_two",
    f"""WITH {LONG_ROWS}, rows0 AS (SELECT *, '' AS path FROM long), s0 AS ({_split_sql("rows0", "path")}),
    side AS (SELECT fold_id, id, CASE WHEN x <= v THEN 'L' ELSE 'R' END AS path FROM long JOIN s0 USING (fold_id, f)),
    rows1 AS (SELECT long.*, path FROM long JOIN side USING (fold_id, id)), s1 AS ({_split_sql("rows1", "path")}),
    side2 AS (SELECT fold_id, id, path || CASE WHEN x <= v THEN 'L' ELSE 'R' END AS path FROM rows1 JOIN s1 USING (fold_id, path, f)),
    members AS (SELECT fold_id, id, '' AS path FROM train UNION ALL SELECT * FROM side UNION ALL SELECT * FROM side2),
    splits AS (SELECT * FROM s0 UNION ALL SELECT * FROM s1)
    SELECT fold_id, path, count(*) AS n, sum(y)::BIGINT AS positive, any_value(f)::INT AS feature, any_value(v) AS edge
    FROM members JOIN train USING (fold_id, id) LEFT JOIN splits USING (fold_id, path) GROUP BY fold_id, path""",
)
def _(spark, sf):
    """Every node of a Gini tree of depth two in every fold: its rows, positives and split."""
    rows, out = _tree_matrix(spark, sf), []
    paths = {tr.ROOT: ""}
    for _ in range(2):
        paths |= {tr.child(k, side): p + "LR"[side] for k, p in paths.items() for side in (False, True)}
    for i in range(len(b.FOLDS)):
        grown = tr.fit_trees(rows.where(f"fold_id = {i}"), TREE_FEATURES, tr.TreeSettings(max_depth=2, max_bins=32, finish_rows=500))
        out += [(i, paths[k], int(w0 + w1), int(w1), f if f >= 0 else None, float(grown.edges[f][at]) if f >= 0 else None) for _, k, f, at, w0, w1 in grown.nodes]
    return spark.createDataFrame(out, "fold_id int, path string, n long, positive long, feature int, edge double")


@register(
    "r6_first_stumps",
    f"""WITH {LONG_ROWS}, rows0 AS (SELECT *, '' AS path FROM long), s0 AS ({_split_sql("rows0", "path")}),
    sides AS (SELECT fold_id, f, v, sum((x <= v AND y = 0)::INT) AS l0, sum((x <= v AND y = 1)::INT) AS l1, sum((x > v AND y = 0)::INT) AS r0, sum((x > v AND y = 1)::INT) AS r1 FROM long JOIN s0 USING (fold_id, f) GROUP BY ALL)
    SELECT fold_id, f::INT AS feature, v AS edge, (l1 > l0)::INT::DOUBLE AS below, (r1 > r0)::INT::DOUBLE AS above,
      round(0.5::DOUBLE * ln((l0 + l1 + r0 + r1 - least(l0, l1) - least(r0, r1)) / (least(l0, l1) + least(r0, r1))::DOUBLE), 9) AS alpha FROM sides""",
)
def _(spark, sf):
    """The first boosted stump of every fold and its weight."""
    rows, out = _tree_matrix(spark, sf), []
    for i in range(len(b.FOLDS)):
        for alpha, feature, edge, below, above in tr.boosted_splits(rows.where(f"fold_id = {i}"), TREE_FEATURES, 1, 0.5, max_bins=32):
            out.append((i, TREE_FEATURES.index(feature), edge, below, above, round(alpha, 9)))
    return spark.createDataFrame(out, "fold_id int, feature int, edge double, below double, above double, alpha double")


@register("r7_importances")
def _(spark, sf):
    def one(train, validation, columns):
        kinds = [("LogisticRegression", {"C": 0.1}), ("RandomForestClassifier", {"n_estimators": 5, "max_depth": 3})]
        frames = [ln.fit(train, columns, kind, params).importances(spark).withColumn("type", F.lit(kind)) for kind, params in kinds]
        return reduce(DataFrame.unionByName, frames)

    return _by_fold(spark, sf, one)


@register(
    "r8_attach_labels",
    f"""WITH {b.LABELS}, num AS (SELECT c.entity_id, c.as_of_date, count(o_orderkey)::DOUBLE AS score FROM cohort c LEFT JOIN orders o ON o.o_custkey = c.entity_id
        AND CAST(o_orderdate AS DATE) < c.as_of_date GROUP BY ALL) SELECT l.*, score FROM labels_ l JOIN num USING (entity_id, as_of_date)""",
)
def _(spark, sf):
    from tidemark.operators import features as fe

    spec = fe.FeatureSource("orders", "ord", "o_orderdate", history=(fe.HistoryFeature("n", "sum", impute=0),))
    counts = fe.build_features(tp.cohort(spark, sf), tp.order_source(spark, sf), spec, b.DATES)
    return rk.attach_labels(counts.select(*KEYS, F.col("ord_n").cast("double").alias("score")), tp.labels(spark, sf))


RANKED = f"WITH {b.PREDICTIONS} SELECT model_id, as_of_date, segment, entity_id, k, segment_k FROM pr"


@register("r9_ranks", RANKED)
def _(spark, sf):
    return b.predictions(spark, sf).select("model_id", "as_of_date", "segment", "entity_id", "k", "segment_k")


@register("r9_ranks_many_tasks", RANKED)
def _(spark, sf):
    """The same ranks with pieces of about 2,000 rows, as for a model that no task could hold."""
    ranked = rk.rank_predictions(b.scores(spark, sf), rows_per_task=2_000)
    return ranked.select("model_id", "as_of_date", "segment", "entity_id", "k", "segment_k")


@register("r10_save_and_load")
def _(spark, sf):
    def one(train, validation, columns):
        path = new_table_path(spark, "model")
        params = {"C": 0.1}
        ln.save(ln.fit(train, columns, "LogisticRegression", params), path)
        return ln.load(spark, path, "LogisticRegression", columns, params).score(validation)

    return _by_fold(spark, sf, one)
