"""Kept stages: what is there is read, further dates are added and equal a full run."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import cohort as co
from tidemark.operators import features as fe
from tidemark.plans import folds as fo
from tidemark.plans.run import Experiment, run_experiment
from tidemark.plans.stages import Stages, data_version, stage_key

DATES = [date(2020, 3, 1), date(2020, 6, 1), date(2020, 9, 1)]
SPEC = fe.FeatureSource(
    "events", "e", "event_date",
    windows=(fe.WindowAggregate("amount", "amount", ("sum", "max"), ("2 months", "9999 months")),),
    history=(fe.HistoryFeature("last", "days_since_last", impute=-1),),
    modes=(fe.ModeFeature("source", "source"),),
    states=(fe.State("kinds", "count_distinct", "source"), fe.State("mean", "avg", "amount")),
    expressions=(fe.HistoryExpression("kinds", "kinds"), fe.HistoryExpression("mean", "round(mean, 9)")),
)


@pytest.fixture
def events(spark, tmp_path):
    day = F.date_add(F.lit("2019-06-01").cast("date"), (F.col("id") * 37 % 520).cast("int"))
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 50).cast("long").alias("entity_id"), day.alias("event_date"),
        F.concat(F.lit("s"), F.col("id") % 4).alias("source"), (F.col("id") * 13 % 17).cast("int").alias("amount"),
    )
    path = str(tmp_path / "events")
    rows.write.parquet(path)
    return spark.read.parquet(path)


def rows_of(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


def test_later_dates_are_added(spark, tmp_path, events):
    cohort = co.build_cohort(events, DATES, "3 months", {"a": ["s0"], "b": ["s1", "s2"]})
    key = stage_key(SPEC, data_version(events))
    first = Stages(spark, str(tmp_path / "kept"))
    first.features(key, cohort, events, SPEC, DATES[:2])
    assert first.computed == [("features-events-e", DATES[:2])]
    # the second run may not read a row that neither a window nor the time since the states needs
    second = Stages(spark, str(tmp_path / "kept"))
    newer = events.where(F.col("event_date") >= min(DATES[1], date(2020, 7, 1)))
    grown = second.features(key, cohort, newer, SPEC, DATES)
    assert second.computed == [("features-events-e", DATES[2:])]
    assert rows_of(grown) == rows_of(fe.build_features(cohort, events, SPEC, DATES))
    third = Stages(spark, str(tmp_path / "kept"))
    assert rows_of(third.features(key, cohort, events, SPEC, DATES)) == rows_of(grown) and third.computed == []
    # an earlier date than the states is made from all rows
    early = Stages(spark, str(tmp_path / "kept"))
    more = [DATES[0] - timedelta(days=40), *DATES]
    people = co.build_cohort(events, more, "3 months", {"a": ["s0"], "b": ["s1", "s2"]})
    assert rows_of(early.features(key, people, events, SPEC, more)) == rows_of(fe.build_features(people, events, SPEC, more))


def test_versions_follow_data_and_plan(spark, tmp_path, events):
    path = str(tmp_path / "events")
    assert data_version(events) == data_version(spark.read.parquet(path)) != data_version(events.where("amount > 3"))
    before = data_version(events)
    events.limit(3).write.mode("append").parquet(path)
    assert data_version(spark.read.parquet(path)) != before
    memory = spark.createDataFrame([(1,)], "x int")
    assert data_version(memory) != data_version(memory)


def test_definitions_read_each_source_once(spark, events):
    definitions = [
        co.LabelDefinition("High", "events", "event_date", "amount > 14"), co.LabelDefinition("High", "other", "day", entity="who"),
        co.LabelDefinition("From s0", "events", "event_date", "source = 's0'"), co.LabelDefinition("Never", "events", "event_date", "cast(null as boolean)"),
    ]
    other = spark.createDataFrame([(1, date(2020, 1, 1)), (None, date(2020, 1, 1)), (2, None)], "who long, day date")
    got = co.defined_label_events({"events": events, "other": other}, definitions)
    want = [(r.entity_id, r.event_date, "High") for r in events.collect() if r.amount > 14] + [(1, date(2020, 1, 1), "High")]
    want += [(r.entity_id, r.event_date, "From s0") for r in events.collect() if r.source == "s0"]
    assert sorted(map(tuple, got.collect())) == sorted(want)
    with pytest.raises(ValueError):
        co.defined_label_events({}, [])


def test_experiments_share_stages(spark, tmp_path, events):
    exp = Experiment(
        temporal=fo.FoldConfig("2020-01-01", "2020-07-01", 3, 3, 12, fold_shift_months=3), interval_back="3 months", segment_sources={"a": ["s0"], "b": ["s1", "s2"]},
        selected_labels=["High", "From s0"], label_group="Any", feature_sources=[SPEC], models={"LinearRanker": {"features": [["e_amount_sum_2m"]], "weights": [[1.0]]}},
        k=10, segment_ks={"a": 5, "b": 5}, split_labels=True,
    )
    definitions = [co.LabelDefinition("High", "events", "event_date", "amount > 14"), co.LabelDefinition("From s0", "events", "event_date", "source = 's0'")]
    spans, evaluations = [], []
    for i, (end, kept) in enumerate([("2020-07-01", "kept"), ("2020-07-01", "kept"), ("2020-10-01", "kept"), ("2020-10-01", "anew")]):
        stages = Stages(spark, str(tmp_path / kept))
        longer = Experiment(**{**vars(exp), "temporal": fo.FoldConfig("2020-01-01", end, 3, 3, 12, fold_shift_months=3)})
        folder = str(tmp_path / f"run{i}")
        run_experiment(spark, longer, events, definitions, {"events": events}, folder, None, lambda: datetime(2020, 1, 1), stages)
        spans.append({name: len(days) for name, days in stages.computed})
        evaluations.append(sorted((r.as_of_date, str(r.segment), r.metric, r.k or 0, r.value) for r in spark.read.parquet(f"{folder}/evaluations").collect()))
    names = {"cohort", "label_any_all", "split_label_any_all", "features-events-e"}
    assert set(spans[0]) == names and spans[1] == {} and set(spans[2]) == names
    assert all(0 < spans[2][n] < spans[3][n] for n in names) and evaluations[0] == evaluations[1] and evaluations[2] == evaluations[3]
