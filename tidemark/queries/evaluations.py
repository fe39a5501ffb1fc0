"""Metrics, curves, model selection and repairs."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import evaluation as ev
from tidemark.operators import model_selection as ms
from tidemark.queries import base as b
from tidemark.queries import temporal as tp
from tidemark.queries.base import register, t
from tidemark.session import stored

MK = "model_id, as_of_date"


def precision_sql(k: int, rank: str, where: str = "true") -> str:
    return f"""SELECT {MK}, count(*) FILTER (WHERE label AND {rank} <= {k}) / {k}::DOUBLE AS precision,
      CASE WHEN count(*) FILTER (WHERE label) = 0 THEN 0 ELSE count(*) FILTER (WHERE label AND {rank} <= {k}) / (count(*) FILTER (WHERE label))::DOUBLE END AS recall
      FROM pr WHERE {where} GROUP BY {MK}"""


@register("v1_v2_overall_at_k", f"WITH {b.PREDICTIONS} {precision_sql(115, 'k')}")
def _(spark, sf):
    return ev.precision_recall_at_k(b.predictions(spark, sf), 115)


@register("v1_v2_segment_at_k", f"WITH {b.PREDICTIONS} {precision_sql(75, 'segment_k', chr(115) + 'egment = ' + chr(39) + 'east' + chr(39))}")
def _(spark, sf):
    return ev.precision_recall_at_k(b.predictions(spark, sf), 75, "east")


EVALUATIONS = f"""g AS (SELECT {MK}, segment, sum(CASE WHEN label AND segment_k <= CASE segment WHEN 'east' THEN 75 ELSE 40 END THEN 1 ELSE 0 END) AS top,
      sum(CASE WHEN label THEN 1 ELSE 0 END) AS pos, sum(CASE WHEN label AND k <= 115 THEN 1 ELSE 0 END) AS top_all, max(k) AS last_k,
      CASE segment WHEN 'east' THEN 75 ELSE 40 END AS sk FROM pr GROUP BY ALL),
  a AS (SELECT {MK}, sum(top_all) AS top_all, sum(pos) AS pos, max(last_k) AS last_k FROM g GROUP BY ALL),
  evals AS (SELECT {MK}, segment, 'precision' AS metric, NULL::BIGINT AS k, sk::BIGINT AS segment_k, top / sk::DOUBLE AS value FROM g
    UNION ALL SELECT {MK}, segment, 'recall', NULL, sk, CASE WHEN pos = 0 THEN 0 ELSE top / pos::DOUBLE END FROM g
    UNION ALL SELECT {MK}, NULL, 'precision', 115, NULL, top_all / 115::DOUBLE FROM a
    UNION ALL SELECT {MK}, NULL, 'recall', 115, NULL, CASE WHEN pos = 0 THEN 0 ELSE top_all / pos::DOUBLE END FROM a
    UNION ALL SELECT {MK}, NULL, 'precision', last_k, NULL, pos / last_k::DOUBLE FROM a)"""


def stored_predictions(spark, sf):
    """Predictions as a table, for what reads them more than once."""
    return stored(b.predictions(spark, sf), "predictions")


def evaluations(spark, sf):
    return ev.evaluation_rows(b.predictions(spark, sf), b.TOTAL_K, b.SEGMENT_KS)


@register("v3_evaluation_rows", f"WITH {b.PREDICTIONS}, {EVALUATIONS} SELECT * FROM evals")
def _(spark, sf):
    return evaluations(spark, sf)


@register(
    "v3_one_segment_rows",
    f"""WITH {b.PREDICTIONS}, w AS (SELECT {MK}, count(*) FILTER (WHERE label AND segment_k <= 40) AS top, count(*) FILTER (WHERE label) AS pos, count(*) AS n
      FROM pr WHERE segment = 'west' GROUP BY ALL)
    SELECT {MK}, 'west' AS segment, m.metric, NULL::BIGINT AS k, CASE m.i WHEN 3 THEN n ELSE 40 END AS segment_k,
      CASE m.i WHEN 1 THEN top / 40::DOUBLE WHEN 2 THEN top / pos::DOUBLE ELSE pos / n::DOUBLE END AS value
    FROM w CROSS JOIN (VALUES (1, 'precision'), (2, 'recall'), (3, 'precision')) m(i, metric)""",
)
def _(spark, sf):
    rows = b.predictions(spark, sf).where("segment = 'west'")
    return ev.evaluation_rows(rows, 40, {"west": 40}, overall=False)


CURVE = f"""cu AS (SELECT *, sum(label::INT) OVER (PARTITION BY {MK} ORDER BY k) AS c, sum(label::INT) OVER (PARTITION BY {MK}) AS p,
    sum(label::INT) OVER (PARTITION BY {MK}, segment ORDER BY segment_k) AS sc, sum(label::INT) OVER (PARTITION BY {MK}, segment) AS sp FROM pr)"""
COLS = ["model_id", "entity_id", "segment", "as_of_date", "label", "k", "segment_k"]


@register(
    "v4_pr_curve",
    f"WITH {b.PREDICTIONS}, {CURVE} SELECT {', '.join(COLS)}, c / k::DOUBLE AS precision, CASE WHEN p = 0 THEN 0 ELSE c / p::DOUBLE END AS recall FROM cu",
)
def _(spark, sf):
    """Blocks of 500 ranks, so that the block sums take part even on small tables."""
    return ev.pr_curve(stored_predictions(spark, sf), block=500).select(*COLS, "precision", "recall")


@register(
    "v4_segment_curve",
    f"""WITH {b.PREDICTIONS}, {CURVE} SELECT {', '.join(COLS)}, sc / segment_k::DOUBLE AS precision, CASE WHEN sp = 0 THEN 0 ELSE sc / sp::DOUBLE END AS recall
    FROM cu WHERE segment = 'west'""",
)
def _(spark, sf):
    return ev.pr_curve(stored_predictions(spark, sf), "west", block=500).select(*COLS, "precision", "recall")


@register(
    "v5_melted_curve",
    f"""WITH {b.PREDICTIONS}, {CURVE} SELECT model_id, entity_id, k, m.metric, CASE m.metric WHEN 'precision' THEN c / k::DOUBLE ELSE CASE WHEN p = 0 THEN 0 ELSE c / p::DOUBLE END END AS value
    FROM cu CROSS JOIN (VALUES ('precision'), ('recall')) m(metric)""",
)
def _(spark, sf):
    return ev.melt_metrics(ev.pr_curve(stored_predictions(spark, sf)).select("model_id", "entity_id", "k", "precision", "recall"))


@register(
    "v6_v7_full_curves",
    f"""WITH {b.PREDICTIONS}, {CURVE} SELECT model_id, entity_id, segment, k, segment_k, m.metric,
      CASE m.metric WHEN 'precision' THEN c / k::DOUBLE ELSE CASE WHEN p = 0 THEN 0 ELSE c / p::DOUBLE END END AS value,
      CASE m.metric WHEN 'precision' THEN sc / segment_k::DOUBLE ELSE CASE WHEN sp = 0 THEN 0 ELSE sc / sp::DOUBLE END END AS segment_value
    FROM cu CROSS JOIN (VALUES ('precision'), ('recall')) m(metric)""",
)
def _(spark, sf):
    return ev.full_curve(stored_predictions(spark, sf)).select("model_id", "entity_id", "segment", "k", "segment_k", "metric", "value", "segment_value")


IN_TOP = "((segment = 'east' AND segment_k <= 75) OR (segment = 'west' AND segment_k <= 40))"


@register(
    "v8_confusion",
    f"""WITH {b.PREDICTIONS} SELECT {MK}, CAST(y AS INTEGER) AS label, CAST(p AS INTEGER) AS prediction, count(*) FILTER (WHERE label = (y = 1) AND {IN_TOP} = (p = 1)) AS n
    FROM pr CROSS JOIN (VALUES (0), (1)) a(y) CROSS JOIN (VALUES (0), (1)) c(p) GROUP BY {MK}, y, p""",
)
def _(spark, sf):
    return ev.confusion_matrix(b.predictions(spark, sf), b.SEGMENT_KS)


@register(
    "v8_confusion_total",
    f"""WITH {b.PREDICTIONS} SELECT {MK}, CAST(y AS INTEGER) AS label, CAST(p AS INTEGER) AS prediction, count(*) FILTER (WHERE label = (y = 1) AND (k <= 115) = (p = 1)) AS n
    FROM pr CROSS JOIN (VALUES (0), (1)) a(y) CROSS JOIN (VALUES (0), (1)) c(p) GROUP BY {MK}, y, p""",
)
def _(spark, sf):
    return ev.confusion_matrix(b.predictions(spark, sf), total_k=b.TOTAL_K)


@register("v9_predictions", f"WITH {b.PREDICTIONS} SELECT model_id, entity_id, CAST({IN_TOP} AS INTEGER) AS prediction FROM pr")
def _(spark, sf):
    return ev.add_prediction(b.predictions(spark, sf), b.SEGMENT_KS).select("model_id", "entity_id", "prediction")


# ---- model selection: results tables derived from the predictions -----------------------

KINDS = {1: "RandomForestClassifier", 2: "FeatureRanker", 3: "LogisticRegression"}


def model_tables(spark, sf):
    """Models, model sets and experiments that belong to the predictions' model ids."""
    seen = b.scores(spark, sf).select("model_id", "model_set_id", "as_of_date").distinct()
    models = seen.select("model_id", "model_set_id", F.add_months("as_of_date", -6).alias("train_end_date"))
    sets = seen.select("model_set_id").distinct().select(
        "model_set_id",
        (F.lit(1) + F.col("model_set_id") % 2).alias("experiment_id"),
        F.element_at(F.create_map(*[F.lit(x) for kv in KINDS.items() for x in kv]), F.col("model_set_id")).alias("type"),
        F.element_at(
            F.create_map(
                F.lit(1), F.lit('{"n_estimators": 1000, "max_depth": 100}'), F.lit(2), F.lit('{"features": ["age", "days"]}'), F.lit(3), F.lit('{"penalty": "l2", "C": 0.1}')
            ),
            F.col("model_set_id"),
        ).alias("params"),
    )
    exps = sets.select("experiment_id").distinct().select(
        "experiment_id",
        F.lit("2001-01-01").cast("date").alias("starts"),
        F.when(F.col("experiment_id") == 2, F.lit("2001-01-02").cast("date")).alias("ends"),
        F.lit('{"labels": {"months_future": 6, "selected_labels": ["EXIT A", "EXIT B"]}}').alias("config"),
        F.lit("ALL").alias("trained_on"),
        F.when(F.col("experiment_id") == 1, "Exit only").otherwise("Any trouble").alias("label_group"),
    )
    return models, sets, exps


MODEL_TABLES = """models AS (SELECT DISTINCT model_id, model_set_id, CAST(as_of_date - INTERVAL 6 MONTH AS DATE) AS train_end_date FROM sc),
  sets AS (SELECT DISTINCT model_set_id, CAST(1 + model_set_id % 2 AS INTEGER) AS experiment_id,
    CASE model_set_id WHEN 1 THEN 'RandomForestClassifier' WHEN 2 THEN 'FeatureRanker' ELSE 'LogisticRegression' END AS type,
    CASE model_set_id WHEN 1 THEN '{"n_estimators": 1000, "max_depth": 100}' WHEN 2 THEN '{"features": ["age", "days"]}' ELSE '{"penalty": "l2", "C": 0.1}' END AS params FROM sc),
  exps AS (SELECT DISTINCT experiment_id, DATE '2001-01-01' AS starts, CASE WHEN experiment_id = 2 THEN DATE '2001-01-02' END AS ends, 'ALL' AS trained_on,
    CASE WHEN experiment_id = 1 THEN 'Exit only' ELSE 'Any trouble' END AS label_group FROM sets)"""
EVALUATED = f"{b.PREDICTIONS}, {EVALUATIONS}, {MODEL_TABLES}"


@register(
    "v10_rank_model_sets",
    f"""WITH {EVALUATED}, r AS (SELECT e.*, model_set_id, experiment_id, type, params, label_group, trained_on, starts, ends,
        count(value) OVER (PARTITION BY label_group, model_set_id) AS n FROM evals e JOIN models USING (model_id) JOIN sets USING (model_set_id) JOIN exps USING (experiment_id)
        WHERE metric = 'precision' AND segment = 'east' AND as_of_date >= DATE '1996-01-01'),
      q AS (SELECT *, max(value) OVER (PARTITION BY label_group, as_of_date) - value AS reg FROM r WHERE n >= 3 AND segment_k = 75)
    SELECT label_group, experiment_id, model_set_id, trained_on, type, params, starts, ends, round(avg(reg), 9) AS regret, round(avg(value), 9) AS mean_metric, 'east' AS segment, 'precision' AS metric
    FROM q GROUP BY ALL""",
)
def _(spark, sf):
    ranked = ms.rank_model_sets(
        evaluations(spark, sf), *model_tables(spark, sf), segment="east", segment_k=75, earliest_date="1996-01-01", months_future=6, min_dates=3
    )
    return ranked.withColumn("regret", F.round("regret", 9)).withColumn("mean_metric", F.round("mean_metric", 9))


@register(
    "v11_best_model_sets",
    f"""WITH {EVALUATED}, q AS (SELECT label_group, model_set_id, type, value, max(value) OVER (PARTITION BY label_group, as_of_date) - value AS reg
        FROM evals JOIN models USING (model_id) JOIN sets USING (model_set_id) JOIN exps USING (experiment_id)
        WHERE metric = 'recall' AND segment = 'west' AND segment_k = 40 AND NOT regexp_matches(type, 'FeatureRanker|LinearRanker')),
      s AS (SELECT label_group, model_set_id, type, avg(reg) AS regret, avg(value) AS mean_metric FROM q GROUP BY ALL)
    SELECT label_group, model_set_id, type, round(regret, 9) AS regret, CAST(row_number() OVER (PARTITION BY label_group ORDER BY regret, mean_metric DESC, model_set_id) AS INTEGER) AS place
    FROM s QUALIFY place <= 1""",
)
def _(spark, sf):
    ranked = ms.rank_model_sets(
        evaluations(spark, sf), *model_tables(spark, sf), segment="west", segment_k=40, metric="recall", exclude_types=["FeatureRanker", "LinearRanker"]
    )
    best = ms.best_model_sets(ranked, top=1)
    return best.select("label_group", "model_set_id", "type", F.round("regret", 9).alias("regret"), "place")


@register(
    "v12_model_info",
    f"""WITH {EVALUATED} SELECT experiment_id, model_set_id, model_id, train_end_date, type, params, trained_on, label_group
    FROM models JOIN sets USING (model_set_id) JOIN exps USING (experiment_id) WHERE experiment_id = 2""",
)
def _(spark, sf):
    return ms.model_info(*model_tables(spark, sf), experiment_ids=[2])


def order_features(spark, sf):
    return t(spark, sf, "orders").select(
        F.col("o_orderkey").alias("entity_id"), F.trunc("o_orderdate", "year").alias("as_of_date"), F.col("o_totalprice").alias("price"), F.col("o_orderpriority").alias("priority")
    )


FEATURED = f"fp AS (SELECT pr.*, o_totalprice AS price, o_orderpriority AS priority, CAST({IN_TOP} AS INTEGER) AS pred FROM pr JOIN orders ON entity_id = o_orderkey)"


@register("v13_features_with_predictions", f"WITH {b.PREDICTIONS}, {FEATURED} SELECT model_id, entity_id, as_of_date, price, priority, score, label, k, pred FROM fp")
def _(spark, sf):
    out = ev.features_with_predictions(order_features(spark, sf), b.predictions(spark, sf), b.SEGMENT_KS)
    return out.select("model_id", "entity_id", "as_of_date", "price", "priority", "score", "label", "k", "pred")


EDGES, NAMES = [10000, 100000, 250000, 400000], ["low", "mid", "high"]
BIN = "CASE WHEN price > 10000 AND price <= 100000 THEN 'low' WHEN price > 100000 AND price <= 250000 THEN 'mid' WHEN price > 250000 AND price <= 400000 THEN 'high' ELSE 'nan' END"


@register(
    "v14_crosstabs",
    f"""WITH {b.PREDICTIONS}, {FEATURED} SELECT 'label' AS against, {BIN} AS value, CAST(label AS INTEGER) AS outcome, count(*) AS n FROM fp GROUP BY ALL
    UNION ALL SELECT 'pred', {BIN}, pred, count(*) FROM fp GROUP BY ALL""",
)
def _(spark, sf):
    rows = ev.features_with_predictions(order_features(spark, sf), b.predictions(spark, sf), b.SEGMENT_KS)
    bins = ev.right_closed_bin(F.col("price"), EDGES, NAMES)
    out = None
    for against in ("label", "pred"):
        part = ev.crosstab(rows, bins, against).select(F.lit(against).alias("against"), "value", F.col(against).alias("outcome"), "n")
        out = part if out is None else out.unionByName(part)
    return out


@register(
    "v14_crosstab_wide",
    f"""WITH {b.PREDICTIONS}, {FEATURED} SELECT CAST(label AS INTEGER) AS label, """
    + ", ".join(f"count(*) FILTER (WHERE {BIN} = '{n}') AS n_{n}" for n in NAMES + ["nan"])
    + " FROM fp GROUP BY label",
)
def _(spark, sf):
    rows = ev.features_with_predictions(order_features(spark, sf), b.predictions(spark, sf), b.SEGMENT_KS)
    return ev.crosstab_wide(rows, ev.right_closed_bin(F.col("price"), EDGES, NAMES), "label", NAMES + ["nan"])


def order_split_labels(spark, sf):
    """Split labels of scored orders: one row per label name, with its truth."""
    names = F.array(
        F.struct(F.lit("STATUS F").alias("label_name"), (F.col("o_orderstatus") == "F").alias("label")),
        F.struct(F.lit("URGENT").alias("label_name"), (F.col("o_orderpriority") == "1-URGENT").alias("label")),
        F.struct(F.lit("COSTLY").alias("label_name"), (F.col("o_totalprice") > 450000).alias("label")),
    )
    return t(spark, sf, "orders").select(F.col("o_orderkey").alias("entity_id"), F.trunc("o_orderdate", "year").alias("as_of_date"), F.inline(names))


ORDER_SPLIT = """osl AS (SELECT o_orderkey AS entity_id, CAST(date_trunc('year', o_orderdate) AS DATE) AS as_of_date, n.label_name,
    CASE n.label_name WHEN 'STATUS F' THEN o_orderstatus = 'F' WHEN 'URGENT' THEN o_orderpriority = '1-URGENT' ELSE o_totalprice > 450000 END AS label
    FROM orders CROSS JOIN (VALUES ('STATUS F'), ('URGENT'), ('COSTLY')) n(label_name))"""


@register(
    "v15_split_label_predictions",
    f"""WITH {b.PREDICTIONS}, {ORDER_SPLIT} SELECT pr.model_id, pr.entity_id, osl.label_name AS split_label_name, osl.label AS split_label, CAST({IN_TOP} AS INTEGER) AS prediction
    FROM pr JOIN osl ON pr.entity_id = osl.entity_id AND pr.as_of_date = osl.as_of_date WHERE pr.label AND osl.label""",
)
def _(spark, sf):
    out = ev.split_label_predictions(b.predictions(spark, sf), order_split_labels(spark, sf), b.SEGMENT_KS)
    return out.select("model_id", "entity_id", "split_label_name", "split_label", "prediction")


@register("v16_split_label_counts", f"WITH {b.SPLIT_LABELS} SELECT as_of_date, label_name, count(DISTINCT entity_id) AS n FROM split_labels WHERE label GROUP BY ALL")
def _(spark, sf):
    return ev.split_label_counts(tp.cohort(spark, sf), tp.split_labels(spark, sf))


@register(
    "v17_label_counts",
    f"""WITH {b.SPLIT_LABELS}, x AS (SELECT * FROM split_labels WHERE label AND segment = 'east' AND label_name IN ('EXIT A', 'EXIT B', 'URGENT ORDER'))
    SELECT as_of_date, segment, 'Any trouble' AS label_group, count(*) AS n, 'rows' AS counted FROM x GROUP BY ALL
    UNION ALL SELECT as_of_date, segment, 'Any trouble', count(DISTINCT entity_id), 'entities' FROM x GROUP BY ALL""",
)
def _(spark, sf):
    made = tp.split_labels(spark, sf)
    names = ["EXIT A", "EXIT B", "URGENT ORDER"]
    rows = ev.label_counts(made, names, "Any trouble", "east").withColumn("counted", F.lit("rows"))
    return rows.unionByName(ev.label_counts(made, names, "Any trouble", "east", True).withColumn("counted", F.lit("entities")))


@register(
    "v18_repair_evaluations",
    f"""WITH {b.PREDICTIONS}, {EVALUATIONS}, stored AS (SELECT model_id, segment, as_of_date, metric, k, segment_k,
        CASE WHEN segment = 'west' AND model_id % 2 = 0 THEN value + 0.5 ELSE value END AS value FROM evals
        UNION ALL SELECT model_id + 1000, segment, as_of_date, metric, k, segment_k, value FROM evals WHERE segment = 'west' AND model_id % 3 = 0)
    SELECT s.model_id, s.segment, s.as_of_date, s.metric, s.k, s.segment_k, round(CASE WHEN s.segment = 'west' AND s.value <> e.value THEN e.value ELSE s.value END, 9) AS value,
      CASE WHEN s.segment = 'west' AND s.value <> e.value THEN 'update' ELSE 'keep' END AS action
    FROM stored s LEFT JOIN evals e ON e.model_id = s.model_id AND e.segment IS NOT DISTINCT FROM s.segment AND e.metric = s.metric AND e.k IS NOT DISTINCT FROM s.k AND e.segment_k IS NOT DISTINCT FROM s.segment_k
    WHERE s.model_id < 1000""",
)
def _(spark, sf):
    """Stored values of every second model's west rows are wrong, and some models have no predictions."""
    preds = stored_predictions(spark, sf)
    good = ev.evaluation_rows(preds, b.TOTAL_K, b.SEGMENT_KS)
    wrong = F.when((F.col("segment") == "west") & (F.col("model_id") % 2 == 0), F.col("value") + 0.5).otherwise(F.col("value"))
    ghosts = good.where("segment = 'west' and model_id % 3 = 0").withColumn("model_id", F.col("model_id") + 1000)
    old = good.withColumn("value", wrong).unionByName(ghosts)
    return ev.repair_evaluations(old, preds, "west", 40).withColumn("value", F.round("value", 9))


def importances(spark, sf):
    """Importances per model, derived from order prices by priority."""
    return (
        t(spark, sf, "orders")
        .groupBy((F.year("o_orderdate") - 1990).alias("model_id"), F.col("o_orderpriority").alias("feature_name"))
        .agg((F.round(F.sum("o_totalprice"), 2) / F.count(F.lit(1)) - 250000).alias("feature_importance"))
    )


@register(
    "v19_mean_importances",
    """WITH i AS (SELECT year(o_orderdate) AS y, o_orderpriority AS feature_name, round(sum(o_totalprice), 2) / count(*) - 250000 AS v FROM orders GROUP BY ALL)
    SELECT feature_name, round(avg(v), 6) AS feature_importance FROM i GROUP BY 1 ORDER BY abs(avg(v)) DESC LIMIT 3""",
)
def _(spark, sf):
    return ev.mean_importances(importances(spark, sf), 3).withColumn("feature_importance", F.round("feature_importance", 6))


@register(
    "v20_metric_over_time",
    f"""WITH {EVALUATED}, o AS (SELECT as_of_date, model_set_id, CASE type WHEN 'RandomForestClassifier' THEN 'RandomForestClassifier(1000, 100)' WHEN 'FeatureRanker' THEN 'FeatureRanker(age)' ELSE 'LogisticRegression(l2, 0.1)' END AS model_name,
        label_group, trained_on, value FROM evals JOIN models USING (model_id) JOIN sets USING (model_set_id) JOIN exps USING (experiment_id)
        WHERE metric = 'precision' AND segment = 'east' AND segment_k = 75)
    SELECT * FROM o WHERE model_name IN (SELECT model_name FROM o WHERE as_of_date = (SELECT max(as_of_date) FROM o) ORDER BY value DESC, model_name, model_set_id LIMIT 2)""",
)
def _(spark, sf):
    return ms.metric_over_time(evaluations(spark, sf), *model_tables(spark, sf), metric="precision", segment="east", segment_k=75, show_top=2)


@register(
    "v21_score_distribution",
    f"""WITH {b.PREDICTIONS}, x AS (SELECT model_id, label, CAST(least(floor(score * 20), 19) AS INTEGER) AS bin, count(*) AS n FROM sc GROUP BY ALL)
    SELECT *, n / (sum(n) OVER (PARTITION BY model_id, label))::DOUBLE AS share FROM x""",
)
def _(spark, sf):
    return ev.score_distribution(b.scores(spark, sf))


@register(
    "x11_selected_models",
    f"""WITH {EVALUATED} SELECT as_of_date, label_group, model_set_id, value, CASE WHEN model_set_id = 2 THEN 'Baseline' ELSE 'Model' END AS kind
    FROM evals JOIN models USING (model_id) JOIN sets USING (model_set_id) JOIN exps USING (experiment_id)
    WHERE metric = 'precision' AND segment = 'east' AND segment_k = 75 AND as_of_date >= DATE '1997-12-01'
      AND ((model_set_id = 1 AND label_group = 'Any trouble') OR (model_set_id = 2 AND label_group = 'Exit only') OR (model_set_id = 3 AND label_group = 'Exit only'))""",
)
def _(spark, sf):
    chosen = spark.createDataFrame(
        [(1, "Any trouble", False), (2, "Exit only", True), (3, "Exit only", False)], "model_set_id int, label_group string, is_baseline boolean"
    )
    return ms.selected_metric_table(
        evaluations(spark, sf), *model_tables(spark, sf), chosen, metric="precision", segment="east", segment_k=75, earliest_date="1997-12-01"
    )
