"""Fitting and scoring classifiers on fold matrices: Spark ML, and trees and stumps on histograms."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, MultilayerPerceptronClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.ranking import feature_ranker, linear_ranker, ranker_importances
from tidemark.operators.trees import Trees, TreeSettings, boosted_splits, fit_trees, load_trees, save_trees, score_trees

MAX_DEPTH = 30  # of the trees that Spark ML boosts
KEYS = ["entity_id", "as_of_date"]


@dataclass(frozen=True)
class Stump:
    """One boosting round: a single split and its vote weight."""

    alpha: float
    feature: str | None
    threshold: float
    left: float
    right: float

    def vote(self) -> Column:
        if self.feature is None:
            return F.lit(self.left)
        return F.when(F.col(self.feature) <= self.threshold, self.left).otherwise(self.right)


def _subset(n_features: int, value) -> int | None:
    """How many features a split may choose from; None for all."""
    if value in (None, 1.0, "all"):
        return None
    if value in ("sqrt", "log2"):
        return max(1, int(math.sqrt(n_features) if value == "sqrt" else math.log2(n_features)))
    return max(1, int(value * n_features) if isinstance(value, float) else int(value))


#: Parameters that a model type takes, with their defaults.
DEFAULTS: dict[str, dict] = {
    "LogisticRegression": {"penalty": "l2", "C": 1.0},
    "DecisionTreeClassifier": {"criterion": "gini", "max_depth": None, "max_features": None, "min_samples_split": 2},
    "RandomForestClassifier": {"n_estimators": 100, "criterion": "gini", "max_depth": None, "max_features": "sqrt", "min_samples_split": 2},
    "GradientBoostingClassifier": {"loss": "log_loss", "n_estimators": 100, "learning_rate": 0.1, "max_depth": 3},
    "MLPClassifier": {"hidden_layer_sizes": [100], "max_iter": 200},
    "AdaBoostClassifier": {"n_estimators": 50, "learning_rate": 1.0},
}
#: How many workers to use is Spark's business.
RESOURCES = {"n_jobs"}


def effective(kind: str, params: Mapping) -> dict:
    """The parameters a model is really fitted with; unknown names and values are an error.

    Boosted trees are at most 30 deep; other trees as deep as wanted. ``log_loss`` is ``entropy``.
    Rankers take their parameters as they are.
    """
    if kind in ("FeatureRanker", "LinearRanker"):
        return dict(params)
    if kind not in DEFAULTS:
        raise ValueError(f"unknown model type {kind!r}")
    if strange := sorted(set(params) - set(DEFAULTS[kind]) - RESOURCES):
        raise ValueError(f"{kind} does not take {', '.join(strange)}")
    out = DEFAULTS[kind] | {k: v for k, v in params.items() if k not in RESOURCES}
    allowed = {"penalty": ("l2",), "loss": ("log_loss", "deviance"), "criterion": ("gini", "entropy", "log_loss")}
    for name, values in allowed.items():
        if name in out and out[name] not in values:
            raise ValueError(f"{kind} takes {name} in {values}, not {out[name]!r}")
    if out.get("criterion") == "log_loss":
        out["criterion"] = "entropy"
    if "loss" in out:
        out["loss"] = "log_loss"
    if kind == "GradientBoostingClassifier":
        out["max_depth"] = min(int(out["max_depth"] or MAX_DEPTH), MAX_DEPTH)
    return out


def make_classifier(kind: str, params: Mapping, n_rows: int, n_features: int, seed: int = 0):
    """A Spark classifier from the usual parameter names (see ``effective``)."""
    p = effective(kind, params)
    if kind == "LogisticRegression":
        return LogisticRegression(regParam=1.0 / (float(p["C"]) * max(n_rows, 1)), elasticNetParam=0.0, standardization=False)
    if kind == "GradientBoostingClassifier":
        return GBTClassifier(maxIter=int(p["n_estimators"]), stepSize=float(p["learning_rate"]), maxDepth=p["max_depth"], seed=seed)
    if kind == "MLPClassifier":
        hidden = p["hidden_layer_sizes"]
        hidden = [hidden] if isinstance(hidden, int) else list(hidden)
        return MultilayerPerceptronClassifier(layers=[n_features, *hidden, 2], maxIter=int(p["max_iter"]), seed=seed)
    raise ValueError(f"{kind} is not a Spark classifier")


def tree_settings(kind: str, params: Mapping, n_features: int, seed: int = 0) -> TreeSettings:
    """Settings of a tree or forest from the usual parameter names (see ``effective``)."""
    p = effective(kind, params)
    forest = kind == "RandomForestClassifier"
    depth = None if p["max_depth"] is None else int(p["max_depth"])
    subset = _subset(n_features, p["max_features"])
    return TreeSettings(int(p.get("n_estimators", 1)), p["criterion"], depth, subset, int(p["min_samples_split"]), bootstrap=forest, seed=seed)


def boost_stumps(train: DataFrame, features: Sequence[str], rounds: int, learning_rate: float = 1.0) -> list[Stump]:
    """Boosted stumps (discrete SAMME), each from one histogram of the weighted rows."""
    return [Stump(*split) for split in boosted_splits(train, features, rounds, learning_rate)]


def boosted_score(stumps: Sequence[Stump]) -> Column:
    """Positive-class score in [0, 1] from the weighted votes."""
    if not stumps:
        return F.lit(0.5)
    total = sum(s.alpha for s in stumps)
    votes = sum((F.lit(s.alpha) * (2 * s.vote() - 1) for s in stumps), F.lit(0.0))
    return 1.0 / (1.0 + F.exp(-votes / F.lit(total)))


@dataclass
class Fitted:
    kind: str
    features: list[str]
    params: Mapping
    model: PipelineModel | Trees | list[Stump] | None = None

    def score(self, matrix: DataFrame) -> DataFrame:
        """``entity_id, as_of_date, score`` for each row."""
        if self.kind == "FeatureRanker":
            return feature_ranker(matrix, self.params["features"]).select(*KEYS, "score")
        if self.kind == "LinearRanker":
            weights = dict(zip(self.params["features"], self.params["weights"]))
            return linear_ranker(matrix, weights).select(*KEYS, "score")
        if self.kind == "AdaBoostClassifier":
            return matrix.select(*KEYS, boosted_score(self.model).alias("score"))
        if isinstance(self.model, Trees):
            return score_trees(matrix, self.features, self.model)
        scored = self.model.transform(matrix)
        return scored.select(*KEYS, vector_to_array("probability")[1].alias("score"))

    def importances(self, spark: SparkSession) -> DataFrame | None:
        """One row per feature; None where the model type has no importances."""
        if self.kind in ("FeatureRanker", "LinearRanker"):
            return ranker_importances(spark, self.features, self.params["features"], self.params.get("weights"))
        if self.kind == "AdaBoostClassifier":
            total = sum(s.alpha for s in self.model) or 1.0
            values = [sum(s.alpha for s in self.model if s.feature == f) / total for f in self.features]
        elif isinstance(self.model, Trees):
            values = self.model.importances(len(self.features), self.params["criterion"])
        else:
            last = self.model.stages[-1]
            if self.kind == "LogisticRegression":
                values = list(last.coefficients)
            elif hasattr(last, "featureImportances"):
                values = list(last.featureImportances.toArray())
            else:
                return None
        rows = [(f, float(v)) for f, v in zip(self.features, values)]
        return spark.createDataFrame(rows, "feature_name string, feature_importance double")


def fit(train: DataFrame, features: Sequence[str], kind: str, params: Mapping, seed: int = 0) -> Fitted:
    """Fit a model on matrix rows with a boolean ``label``."""
    features, params = list(features), effective(kind, params)
    if kind in ("FeatureRanker", "LinearRanker"):
        return Fitted(kind, features, params)
    if kind == "AdaBoostClassifier":
        stumps = boost_stumps(train, features, int(params["n_estimators"]), float(params["learning_rate"]))
        return Fitted(kind, features, params, stumps)
    if kind in ("DecisionTreeClassifier", "RandomForestClassifier"):
        return Fitted(kind, features, params, fit_trees(train, features, tree_settings(kind, params, len(features), seed)))
    assembler = VectorAssembler(inputCols=features, outputCol="_x")
    n_rows = train.count() if kind == "LogisticRegression" else 0
    model = make_classifier(kind, params, n_rows, len(features), seed).setFeaturesCol("_x").setLabelCol("_y")
    fitted = model.fit(assembler.transform(train.withColumn("_y", F.col("label").cast("double"))))
    return Fitted(kind, features, params, PipelineModel([assembler, fitted]))


def save(fitted: Fitted, path: str) -> None:
    """Spark ML models are saved by Spark; trees as tables, stumps as a small JSON table."""
    if isinstance(fitted.model, PipelineModel):
        fitted.model.write().overwrite().save(path)
        return
    spark = SparkSession.getActiveSession()
    if isinstance(fitted.model, Trees):
        save_trees(spark, fitted.model, path)
        return
    rows = [(s.alpha, s.feature, s.threshold, s.left, s.right) for s in fitted.model or []]
    schema = "alpha double, feature string, threshold double, `left` double, `right` double"
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").json(path)


def load(spark: SparkSession, path: str, kind: str, features: Sequence[str], params: Mapping) -> Fitted:
    if kind in ("FeatureRanker", "LinearRanker"):
        return Fitted(kind, list(features), params)
    if kind == "AdaBoostClassifier":
        schema = "alpha double, feature string, threshold double, `left` double, `right` double"
        rows = spark.read.schema(schema).json(path).collect()
        return Fitted(kind, list(features), params, [Stump(*r) for r in rows])
    if kind in ("DecisionTreeClassifier", "RandomForestClassifier"):
        return Fitted(kind, list(features), effective(kind, params), load_trees(spark, path))
    return Fitted(kind, list(features), params, PipelineModel.load(path))
