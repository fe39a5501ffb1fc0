import random
from datetime import date

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.operators import evaluation as ev
from tidemark.operators import ranking as rk

ROWS = [(0, 1, 2, 100), (1, 2, 1, 1000), (2, 1, 100, 2)]


def order(spark, rows, names, scorer):
    df = spark.createDataFrame(rows, "entity_id long, " + ", ".join(f"{n} long" for n in names)).withColumn("as_of_date", F.lit("2020-01-01"))
    return [r.entity_id for r in scorer(df).orderBy(F.desc("score")).collect()]


def test_feature_ranker_goldens(spark):
    names = ["ambuls", "diags", "arrests"]
    assert order(spark, ROWS, names, lambda d: rk.feature_ranker(d, ["ambuls", "diags"])) == [1, 2, 0]
    flipped = [(0, 1, 1, 2, 100), (1, 2, 2, 1, 1000), (2, 3, 1, 100, 2)]
    assert order(spark, flipped, ["days_since", *names], lambda d: rk.feature_ranker(d, ["__flip__days_since", "ambuls", "diags"])) == [0, 1, 2]


@pytest.mark.parametrize("weights,wanted", [((0.5, 0.5), [2, 1, 0]), ((0, 1), [2, 1, 0]), ((0, 0, 1), [1, 2, 0])])
def test_linear_ranker_goldens(spark, weights, wanted):
    names = ["ambuls", "diags", "arrests"]
    rows = [(0, 1, 2, 100), (1, 1, 3, 200), (2, 2, 4, 150)]
    assert order(spark, rows, names, lambda d: rk.linear_ranker(d, dict(zip(names, weights)))) == wanted


def test_linear_ranker_of_equal_scores_is_zero(spark):
    df = spark.createDataFrame([(1, 5), (2, 5)], "entity_id long, a long").withColumn("as_of_date", F.lit("d"))
    assert [r.score for r in rk.linear_ranker(df, {"a": 1.0}).collect()] == [0.0, 0.0]


@pytest.fixture(scope="module")
def skewed():
    """Two models; a third of all scores are one value."""
    rng = random.Random(3)
    return [
        (1 + i % 2, "2020-01-01", i, "ab"[rng.randint(0, 1)], 0.25 if i % 3 == 0 else round(rng.random(), 3), rng.random() < 0.2) for i in range(3000)
    ]


def frame(spark, rows):
    return spark.createDataFrame(rows, "model_id int, as_of_date string, entity_id long, segment string, score double, label boolean")


def test_ranks_in_pieces_equal_ranks_in_one(spark, skewed):
    df = frame(spark, skewed)
    one = rk.rank_predictions(df, cuts=[]).collect()
    assert len(rk.score_cuts(df, rows_per_task=100)) > 10
    assert sorted(rk.rank_predictions(df, rows_per_task=100).collect()) == sorted(one)
    by = lambda r: (-r.score, r.entity_id % 64, r.entity_id)
    for model in (1, 2):
        mine = sorted((r for r in one if r.model_id == model), key=by)
        assert [r.k for r in mine] == list(range(1, len(mine) + 1))


def test_feature_ranker_is_pandas_average_rank(spark, skewed):
    df = frame(spark, skewed).withColumn("tie", F.col("entity_id") % 7)
    got = {r.entity_id: r.rank for r in rk.feature_ranker(df, ["score", "__flip__tie"], ["model_id"], 50).withColumnRenamed("score", "x").toPandas().assign(rank=lambda p: p.iloc[:, -1]).itertuples()}
    p = df.toPandas()
    p["t"] = list(zip(p["score"], -p["tie"]))
    p["want"] = p.groupby("model_id")["t"].rank(pct=True, method="average")
    assert got == pytest.approx(dict(zip(p["entity_id"], p["want"])))


def test_curve_in_blocks(spark, skewed):
    ranked = rk.rank_predictions(frame(spark, skewed), cuts=[])
    p = ranked.toPandas().sort_values(["model_id", "k"])
    p["c"] = p.groupby("model_id")["label"].cumsum()
    want = dict(zip(p["entity_id"], p["c"] / p["k"]))
    got = {r.entity_id: r.precision for r in ev.pr_curve(ranked, block=97).collect()}
    assert got == pytest.approx(want)


def test_recall_without_positives_is_zero(spark):
    df = frame(spark, [(1, "d", i, "a", i / 10, False) for i in range(5)])
    ranked = rk.rank_predictions(df)
    assert {r.recall for r in ev.pr_curve(ranked).collect()} == {0.0}
    rows = ev.evaluation_rows(ranked, 10, {"a": 2}).collect()
    assert {r.value for r in rows} == {0.0} and len(rows) == 5


def test_grid_and_importances(spark):
    assert rk.model_grid({"A": {"x": [1, 2], "y": [3]}}) == [("A", {"x": 1, "y": 3}), ("A", {"x": 2, "y": 3})]
    got = {r.feature_name: r.feature_importance for r in rk.ranker_importances(spark, ["p", "q", "r"], ["__flip__q", "p"]).collect()}
    assert got == pytest.approx({"p": 1 / 3, "q": 2 / 3, "r": 0.0})
    with pytest.raises(ValueError):
        rk.ranker_importances(spark, ["p"], ["z"])


def test_learner_parameters():
    from tidemark.operators import learners as ln

    grids = {
        "GradientBoostingClassifier": {"loss": ["log_loss"], "n_estimators": [50, 1000], "learning_rate": [0.1, 1]},
        "AdaBoostClassifier": {"n_estimators": [50, 1000], "learning_rate": [0.1, 1]},
        "LogisticRegression": {"penalty": ["l2"], "C": [0.00001, 2]},
        "DecisionTreeClassifier": {"criterion": ["gini", "entropy", "log_loss"], "max_depth": [1, 100, 250], "max_features": ["sqrt", 1.0]},
        "RandomForestClassifier": {"n_estimators": [1000, 10000], "max_features": ["sqrt"], "max_depth": [100, 250], "min_samples_split": [10], "n_jobs": [90]},
    }
    points = {}
    for kind, params in rk.model_grid(grids):
        used = ln.effective(kind, params)
        assert ln.effective(kind, used) == used
        points.setdefault(kind, set()).add(tuple(sorted(map(str, used.items()))))
    assert {k: len(v) for k, v in points.items()} == {"GradientBoostingClassifier": 4, "AdaBoostClassifier": 4, "LogisticRegression": 2, "DecisionTreeClassifier": 8, "RandomForestClassifier": 2}
    for kind, params in (("LogisticRegression", {"penalty": "l1"}), ("DecisionTreeClassifier", {"splitter": "best"}), ("MLPClassifier", {"alpha": 1}), ("LGBMClassifier", {})):
        with pytest.raises(ValueError):
            ln.effective(kind, params)


def test_ranker_with_one_common_combination(spark):
    n = 6000
    rows = [(i, "2020-01-01", 0.0 if i % 10 else float(i % 70), 0.0 if i % 10 else float(i % 30)) for i in range(n)]
    df = spark.createDataFrame(rows, "entity_id long, as_of_date string, a double, b double").repartition(8)
    got = {r.entity_id: r.score for r in rk.feature_ranker(df, ["a", "__flip__b"]).collect()}
    place = sorted((a, -b) for _, _, a, b in rows)
    first, last = {}, {}
    for i, v in enumerate(place):
        first.setdefault(v, i)
        last[v] = i
    assert got == {e: pytest.approx(((first[(a, -b)] + last[(a, -b)]) / 2 + 1) / n) for e, _, a, b in rows}


def test_many_cuts_take_one_pass_of_the_rows(spark):
    """Each rank used to read its input again, and every row was compared with every cut."""
    cuts = [-1.5, 0.0, 0.25, 0.5, 2.0, 7.0]
    values = [-3.0, -1.5, -0.0, 0.1, 0.25, 0.3, 0.5, 1.0, 2.0, 3.0, 7.0, 8.0, float("nan"), None]
    for some in (cuts, cuts[:1], cuts[:3]):
        got = spark.createDataFrame([(v,) for v in values], "v double").select(rk._cuts_below(F.col("v"), some).alias("n")).collect()
        assert [r.n for r in got] == [0 if v is None else len(some) if v != v else sum(c < v for c in some) for v in values]
    schema = "model_id int, as_of_date date, segment string, entity_id long, score double"
    day = date(2020, 1, 1)
    rows = [(m, day, "east" if i % 3 else "west", i, [0.25, 0.5, i % 40 / 10, None][i % 4]) for m in (1, 2) for i in range(300)]
    df = spark.createDataFrame(rows, schema)
    plain = rk.rank_predictions(df, cuts=[])
    cut = rk.rank_predictions(df, cuts=cuts)
    assert sorted(map(str, cut.collect())) == sorted(map(str, plain.collect())) and cut.columns == plain.columns
    plan = cut._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") <= 3  # the rows, and their counts for both kinds of rank
