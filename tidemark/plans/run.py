"""A whole experiment: folds, cohort, labels, features, matrices, models, results."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import cohort as co
from tidemark.operators import evaluation as ev
from tidemark.operators import learners as ln
from tidemark.operators import matrix as mx
from tidemark.operators.features import FeatureSource, build_features, columns_for_segment
from tidemark.operators.ranking import attach_labels, model_grid, rank_predictions
from tidemark.plans import folds as fo
from tidemark.plans.stages import Stages, data_version, stage_key
from tidemark.sources import results as rs


@dataclass(frozen=True)
class Experiment:
    temporal: fo.FoldConfig
    interval_back: str
    segment_sources: Mapping[str, Sequence[str]]
    selected_labels: Sequence[str]
    label_group: str
    feature_sources: Sequence[FeatureSource]
    models: Mapping[str, Mapping[str, Sequence]]
    k: int
    segment_ks: Mapping[str, int]
    segment: str = "ALL"
    exclude_sources: Sequence[str] = ()
    impute_columns: Sequence[str] = field(default=())
    split_labels: bool = False
    labels_until: str | None = None  # open horizon: labels up to this date whatever the as-of date

    @property
    def segments(self) -> list[str]:
        return list(self.segment_sources) if self.segment == "ALL" else [self.segment]


def run_experiment(
    spark: SparkSession,
    exp: Experiment,
    events: DataFrame,
    label_events: DataFrame | Sequence[co.LabelDefinition],
    tables: Mapping[str, DataFrame],
    folder: str,
    exits: DataFrame | None = None,
    clock=datetime.now,
    stages: Stages | None = None,
) -> int:
    """Run the experiment and write all its tables below ``folder``; gives the experiment id.

    Cohort, labels, features, matrices and scores lie in a folder of the experiment's own, so
    several experiments share ``folder``. Predictions replace those of the same model. The id is
    a hash of settings and starting time (``clock``): a retry with the same clock takes the same
    id and replaces its rows; with another clock it is an experiment of its own.

    ``label_events`` are finished events or definitions over ``tables``. With ``split_labels`` a
    table of one row per label name is written too. With ``stages`` cohort, labels and features
    are kept there by settings and data: what is there is used again, further dates are added.

    Each stage is written once and read back, so that later stages and lost executors restart
    from tables, and matrix statistics and ranks read stored rows.
    """
    config = {
        "segment": exp.segment,
        "temporal": vars(exp.temporal),
        "cohort": {"interval_back": exp.interval_back},
        "labels": {"months_future": exp.temporal.months_future, "selected_labels": list(exp.selected_labels), "until": exp.labels_until},
    }
    experiment_id = rs.start_experiment(spark, folder, config, exp.segment, exp.label_group, clock())
    place = f"{folder}/experiment_{experiment_id}"
    folds = fo.make_folds(exp.temporal)
    dates = fo.all_dates(folds)
    by_date = ["as_of_date"]

    if not isinstance(label_events, DataFrame):
        label_events = co.defined_label_events(tables, label_events)
    horizon = (exp.selected_labels, exp.temporal.months_future, exp.segments, exp.labels_until)
    label_name = co.label_table_name(exp.label_group, exp.segment)
    cohort_key = stages and stage_key(exp.interval_back, exp.segment_sources, exp.exclude_sources, data_version(events), data_version(exits))
    label_key = stages and stage_key(cohort_key, horizon, data_version(label_events))

    def kept(name: str, key: str | None, build) -> DataFrame:
        """The table by date: from the stages, or written to the experiment's own folder."""
        return stages.by_date(name, key, dates, build) if stages else rs.overwrite(build(dates), f"{place}/{name}", by_date)

    def with_labels(build):
        return lambda days: build(cohort.where(F.col("as_of_date").isin(list(days))), label_events, exp.selected_labels, days, exp.temporal.months_future, exp.segments, exp.labels_until)

    cohort = kept("cohort", cohort_key, lambda days: co.build_cohort(events, days, exp.interval_back, exp.segment_sources, exp.exclude_sources, exits))
    labels = kept(label_name, label_key, with_labels(co.build_labels))
    if exp.split_labels:
        kept(f"split_{label_name}", label_key, with_labels(co.build_split_labels))
    if stages:
        features = [stages.features(stage_key(cohort_key, s, data_version(tables[s.name])), cohort, tables[s.name], s, dates) for s in exp.feature_sources]
    else:
        features = [
            rs.overwrite(build_features(cohort, tables[s.name], s, dates), f"{place}/features/{s.name}_{s.prefix}", by_date)
            for s in exp.feature_sources
        ]
    master = mx.master_matrix(cohort, features)
    wanted = columns_for_segment(exp.feature_sources, exp.segment)
    master = rs.overwrite(master.select(*mx.KEYS, *wanted), f"{place}/master", by_date)
    text, numbers = mx.split_column_kinds(master)

    # grid points that Spark fits alike are one model set
    points = {(kind, _key(used)): (kind, used) for kind, params in model_grid(exp.models) for used in [ln.effective(kind, params)]}
    sets = rs.model_set_rows(spark, experiment_id, list(points.values()), config["temporal"])
    rs.overwrite_partitions(sets, f"{folder}/model_sets", ["experiment_id"])
    set_ids = [(r.model_set_id, r.type, r.params) for r in sets.collect()]
    grid = {key: params for key, (_, params) in points.items()}

    for i, fold in enumerate(folds):
        folds_df = fo.folds_frame(spark, [fold])
        rows = mx.slice_folds(master, folds_df)
        if exp.impute_columns:
            rows = mx.impute_mean(rows, exp.impute_columns)
        cats = mx.train_categories(rows, text)
        rows = mx.one_hot(rows, cats)
        columns = [c for c in rows.columns if c not in (*mx.KEYS, "fold_id", "role")]
        rows = mx.align_labels(mx.standardise(rows, columns), labels)
        name = mx.fold_fingerprint(fold, exp.segment)
        rows = rs.overwrite(rows, f"{place}/matrices/{name}", ["role"])
        train, validation = rows.where("role = 'train'"), rows.where("role = 'validation'")
        if train.isEmpty() or validation.isEmpty():
            raise ValueError(f"fold {i} has no training or no validation rows")
        end = max(fold.train_dates)
        models = rs.model_rows(sets, [end])
        rs.overwrite_partitions(models, f"{folder}/models", ["model_set_id", "train_end_date"])
        ids = {r.model_set_id: r.model_id for r in models.collect()}
        weights = []
        for set_id, kind, params in set_ids:
            fitted = ln.fit(train, columns, kind, grid[(kind, params)])
            scored = fitted.score(validation).withColumn("model_id", F.lit(ids[set_id]))
            rs.overwrite_partitions(scored, f"{place}/scores/{name}", ["model_id"])
            own = fitted.importances(spark)
            if own is not None:
                weights.append(own.select(F.lit(ids[set_id]).alias("model_id"), F.lit(end).alias("train_end_date"), "*"))
            if fitted.model is not None:
                ln.save(fitted, f"{folder}/saved_models/{kind}_{set_id}_{ids[set_id]}")
        # All models of the fold are ranked and evaluated together.
        scores = spark.read.parquet(f"{place}/scores/{name}").withColumn("model_id", F.col("model_id").cast("long"))
        scores = scores.where(F.col("model_id").isin(list(ids.values())))
        rs.save_predictions(rank_predictions(attach_labels(scores, labels)), folder)
        stored = rs.read_predictions(spark, folder, list(ids.values()))
        evaluations = ev.evaluation_rows(stored, exp.k, exp.segment_ks, overall=exp.segment == "ALL")
        rs.overwrite_partitions(evaluations, f"{folder}/evaluations", ["model_id"])
        if weights:
            rs.overwrite_partitions(reduce(DataFrame.unionByName, weights), f"{folder}/importances", ["model_id"])
    rs.end_experiment(spark, folder, experiment_id, clock())
    return experiment_id


def _key(params: Mapping) -> str:
    return json.dumps(params)
