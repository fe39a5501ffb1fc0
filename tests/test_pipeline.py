import json
import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.functions import cleaning as c
from tidemark.operators import conform as cf
from tidemark.operators import evaluation as ev
from tidemark.operators import learners as ln
from tidemark.operators import matrix as mx
from tidemark.plans import folds as fo
from tidemark.plans.etl import EtlStep, run_etl
from tidemark.plans.run import Experiment, run_experiment
from tidemark.queries import base as b
from tidemark.queries import matrices as mt
from tidemark.queries import temporal as tp
from tidemark.sources import results as rs

SF = "/root/testdata/sf0.01"


def test_experiment_end_to_end(spark, tmp_path):
    folder = str(tmp_path)
    exp = Experiment(
        temporal=fo.FoldConfig("1999-01-01", "2000-01-01", 6, 6, 12, fold_shift_months=6),
        interval_back="3 months", segment_sources=b.SEGMENT_SOURCES, selected_labels=b.LABEL_NAMES, label_group="Any trouble",
        feature_sources=[mt.NUMBERS, mt.KINDS],
        models={
            "LinearRanker": {"features": [["ord_n_sum_3m", "ord_n_sum_12m"]], "weights": [[2.0, 1.0]]},
            "FeatureRanker": {"features": [["ord_n_sum_12m", "__flip__ord_days_since_last"]]},
            "LogisticRegression": {"penalty": ["l2"], "C": [0.1]},
            "AdaBoostClassifier": {"n_estimators": [3], "learning_rate": [0.5]},
        },
        k=115, segment_ks=b.SEGMENT_KS, exclude_sources=b.EXCLUDED,
    )
    orders = tp.order_source(spark, SF)
    run = run_experiment(spark, exp, b.entity_events(spark, SF), b.label_events(spark, SF), {"orders": orders}, folder, b.exits(spark, SF), lambda: datetime(2020, 1, 1))
    folds = fo.make_folds(exp.temporal)
    log = rs.experiments(spark.read.parquet(f"{folder}/experiments")).first()
    assert log.experiment_id == run and log.ends is not None and json.loads(log.config)["labels"]["months_future"] == 6
    models = spark.read.parquet(f"{folder}/models")
    assert models.count() == 4 * len(folds)
    preds = rs.read_predictions(spark, folder)
    kept = spark.read.parquet(f"{folder}/evaluations")
    again = ev.evaluation_rows(preds, 115, b.SEGMENT_KS)
    keys = ["model_id", "as_of_date", "segment", "metric", "k", "segment_k"]
    order = lambda df: {tuple(r[c] for c in keys): r.value for r in df.collect()}
    assert order(kept) == pytest.approx(order(again)) and kept.count() == 7 * 4 * len(folds)
    assert spark.read.parquet(f"{folder}/importances").select("model_id").distinct().count() == 4 * len(folds)
    labels = spark.read.parquet(f"{folder}/experiment_{run}/label_any_trouble_all")
    for d in {f.validation_date for f in folds}:
        day = F.col("as_of_date") == d
        assert preds.where(day).count() == 4 * labels.where(day).count()


def test_experiments_share_a_folder(spark, tmp_path):
    folder = str(tmp_path)
    exp = Experiment(
        temporal=fo.FoldConfig("1999-01-01", "2000-01-01", 6, 6, 12, fold_shift_months=6, multiple_folds=False),
        interval_back="3 months", segment_sources=b.SEGMENT_SOURCES, selected_labels=b.LABEL_NAMES, label_group="Any trouble",
        feature_sources=[mt.NUMBERS], models={"LinearRanker": {"features": [["ord_n_sum_3m", "ord_n_sum_12m"]], "weights": [[2.0, 1.0]]}},
        k=115, segment_ks=b.SEGMENT_KS, exclude_sources=b.EXCLUDED,
    )
    tables = {"orders": tp.order_source(spark, SF)}

    def run(e, day):
        return run_experiment(spark, e, b.entity_events(spark, SF), b.label_events(spark, SF), tables, folder, b.exits(spark, SF), lambda: datetime(2020, 1, day))

    def stored():
        rows = rs.read_predictions(spark, folder).collect()
        assert len({(r.model_id, r.entity_id, r.as_of_date) for r in rows}) == len(rows)
        return {name: spark.read.parquet(f"{folder}/{name}").count() for name in ("predictions", "evaluations", "models", "model_sets", "importances")}, set(map(str, rows))

    first = run(exp, 1)
    counts, rows = stored()
    assert run(exp, 1) == first and stored() == (counts, rows)
    east = Experiment(**{**vars(exp), "segment": "east"})
    assert len({first, run(exp, 2), run(east, 2)}) == 3
    more, both = stored()
    assert rows < both and more["models"] == 3 * counts["models"] and more["predictions"] > 2 * counts["predictions"]


def test_etl_runs_in_dependency_order(spark, tmp_path):
    raw = {"clients": spark.createDataFrame([(1, "a ")], "id int, name string"), "visits": spark.createDataFrame([("A", "01/02/2020")], "name string, day string")}
    steps = [
        EtlStep("events", lambda t: t["visits"].join(t["clean"], "name").select(c.fix_date(F.col("day"), "2021-01-01").alias("day"), "id"), ("visits", "clean")),
        EtlStep("clean", lambda t: t["clients"].select("id", c.clean_text(F.col("name")).alias("name")), ("clients",)),
    ]
    (row,) = run_etl(steps, raw, str(tmp_path))["events"].collect()
    assert str(row.day) == "2020-01-02" and row.id == 1
    with pytest.raises(ValueError):
        run_etl([EtlStep("x", lambda t: t["nope"], ("nope",))], raw, str(tmp_path))


@pytest.fixture(scope="module")
def toy(spark):
    rows = [(i, "2020-01-01", float(i % 10), float(i % 3), (i % 10) > 6 if i % 17 else (i % 2 == 0)) for i in range(600)]
    return spark.createDataFrame(rows, "entity_id long, as_of_date string, x double, y double, label boolean")


def test_boosting_follows_the_formula(toy):
    stumps = ln.boost_stumps(toy, ["x", "y"], 3, 1.0)
    assert stumps[0].feature == "x"
    p = toy.toPandas()
    vote = [s.left if r.x <= s.threshold else s.right for s in stumps[:1] for r in p.itertuples()]
    err = sum(v != float(y) for v, y in zip(vote, p["label"])) / len(p)
    assert stumps[0].alpha == pytest.approx(math.log((1 - err) / err))
    scores = ln.Fitted("AdaBoostClassifier", ["x", "y"], {}, stumps).score(toy).toPandas()
    assert scores["score"].between(0, 1).all() and scores.merge(p).groupby("label")["score"].mean().is_monotonic_increasing


@pytest.mark.parametrize("kind,params", [("LogisticRegression", {"C": 1.0}), ("AdaBoostClassifier", {"n_estimators": 2})])
def test_saved_models_score_alike(spark, toy, tmp_path, kind, params):
    fitted = ln.fit(toy, ["x", "y"], kind, params)
    ln.save(fitted, str(tmp_path / "m"))
    again = ln.load(spark, str(tmp_path / "m"), kind, ["x", "y"], params)
    assert sorted(fitted.score(toy).collect()) == sorted(again.score(toy).collect())


def test_fingerprint_forms_agree(spark):
    folds = b.FOLDS
    got = {r.fold_id: r.fingerprint for r in mx.fingerprint_column(fo.folds_frame(spark, folds), "ALL").collect()}
    assert got == {i: mx.fold_fingerprint(f, "ALL") for i, f in enumerate(folds)}


def test_matrix_guards(spark):
    with pytest.raises(ValueError):
        mx.check_names(["a", "b", "a"])
    df = spark.createDataFrame([("train", str(i)) for i in range(5)], "role string, c string")
    with pytest.raises(ValueError):
        mx.train_categories(df, ["c"], limit=3)


def test_column_detection(spark):
    df = spark.createDataFrame([(1, "m", "w", "2020-01-01")], "patid int, sex string, race string, call_date string")
    assert set(cf.detect_columns(df)) == {"sex", "race", "event_date"}
    with pytest.raises(ValueError):
        cf.detect_columns(df.drop("call_date"))
