"""Matrices per fold."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import features as fe
from tidemark.operators import matrix as mx
from tidemark.operators.features import FeatureSource, HistoryFeature, ModeFeature, WindowAggregate
from tidemark.plans import folds as fo
from tidemark.queries import base as b
from tidemark.queries import etl
from tidemark.queries import temporal as tp
from tidemark.queries.base import register
from tidemark.session import stored

KEYS = mx.KEYS

NUMBERS = FeatureSource(
    "orders", "ord", "o_orderdate",
    windows=(WindowAggregate("n", "1", ("sum",), ("3 months", "12 months")),),
    history=(HistoryFeature("days_since_last", "days_since_last", impute=999999),),
)
KINDS = FeatureSource("orders", "cat", "o_orderdate", modes=(ModeFeature("priority", "o_orderpriority"),))
DOB = FeatureSource("attributes", "dem", "event_date", modes=(ModeFeature("dob", "attribute_value", where="attribute_type = 'dob'"),))


def feature_tables(spark, sf, parts=("numbers", "kinds", "age"), people=None):
    """The cohort and its chosen feature tables, one per source."""
    people = stored(tp.cohort(spark, sf), "cohort") if people is None else people

    def age():
        dob = fe.build_features(people, etl.attributes(spark, sf), DOB, b.DATES)
        years, _ = fe.age_columns(F.col("dem_dob").cast("date"), F.col("as_of_date"))
        return dob.select(*KEYS, F.when(F.col("entity_id") % 5 != 0, years).alias("dem_age"))

    make = {
        "numbers": lambda: fe.build_features(people, tp.order_source(spark, sf), NUMBERS, b.DATES),
        "kinds": lambda: fe.build_features(people, tp.order_source(spark, sf), KINDS, b.DATES),
        "age": age,
    }
    return people, [make[p]() for p in parts]


def master(spark, sf, dates=None, parts=("numbers", "kinds", "age"), people=None):
    people, tables = feature_tables(spark, sf, parts, people)
    return mx.master_matrix(people, tables, dates)


MASTER = f"""{tp.JOINED}, {etl.ATTRIBUTES}, cnt AS (SELECT entity_id, as_of_date, o_orderpriority AS value, count(*) AS n FROM j WHERE d IS NOT NULL GROUP BY ALL),
  m1 AS (SELECT entity_id, as_of_date, value FROM cnt QUALIFY row_number() OVER (PARTITION BY entity_id, as_of_date ORDER BY n DESC, value) = 1),
  num AS (SELECT entity_id, as_of_date, CAST({tp.win('sum', '1', '3 MONTH')} AS BIGINT) AS ord_n_sum_3m, CAST({tp.win('sum', '1', '12 MONTH')} AS BIGINT) AS ord_n_sum_12m,
            CAST(coalesce(as_of_date - max(d), 999999) AS INTEGER) AS ord_days_since_last FROM j GROUP BY entity_id, as_of_date),
  dob AS (SELECT c.entity_id, c.as_of_date, CAST(min(attribute_value) AS DATE) AS dob FROM cohort c LEFT JOIN attrs
      ON attrs.entity_id = c.entity_id AND attrs.event_date < c.as_of_date AND attribute_type = 'dob' GROUP BY ALL),
  master AS (SELECT num.*, m1.value AS cat_priority, CASE WHEN num.entity_id % 5 <> 0 AND (as_of_date - dob) / 365.25::DOUBLE BETWEEN 5 AND 90
      THEN (as_of_date - dob) / 365.25::DOUBLE END AS dem_age FROM num LEFT JOIN m1 USING (entity_id, as_of_date) JOIN dob USING (entity_id, as_of_date))"""
SLICED = f"{MASTER}, {tp.SERIES_FOLDS}, sliced AS (SELECT * FROM master JOIN folds USING (as_of_date))"


def sliced(spark, sf, parts=("numbers", "kinds", "age"), people=None):
    """Fold rows of the stored master matrix, as the statistics and the rows both read it."""
    return mx.slice_folds(stored(master(spark, sf, parts=parts, people=people), "master"), fo.folds_frame(spark, b.FOLDS))


@register("m1_feature_join", f"WITH {MASTER} SELECT * REPLACE (round(dem_age, 6) AS dem_age) FROM master")
def _(spark, sf):
    return master(spark, sf).withColumn("dem_age", F.round("dem_age", 6))


@register(
    "m2_column_kinds",
    f"""WITH {MASTER} SELECT 'cat_priority' AS column_name, 'cat' AS kind, count(cat_priority) AS n FROM master
    UNION ALL SELECT 'ord_n_sum_3m', 'num', count(ord_n_sum_3m) FROM master UNION ALL SELECT 'ord_n_sum_12m', 'num', count(ord_n_sum_12m) FROM master
    UNION ALL SELECT 'ord_days_since_last', 'num', count(ord_days_since_last) FROM master UNION ALL SELECT 'dem_age', 'num', count(dem_age) FROM master""",
)
def _(spark, sf):
    df = master(spark, sf)
    text, numbers = mx.split_column_kinds(df)
    counts = df.agg(*[F.count(c).alias(c) for c in text + numbers])
    pairs = [
        F.struct(F.lit(c).alias("column_name"), F.lit("cat" if c in text else "num").alias("kind"), F.col(c).alias("n")) for c in text + numbers
    ]
    return counts.select(F.inline(F.array(*pairs)))


@register(
    "m3_master_for_dates",
    f"WITH {MASTER} SELECT * REPLACE (round(dem_age, 6) AS dem_age) FROM master WHERE as_of_date IN (DATE '1998-01-01', DATE '2000-07-01')",
)
def _(spark, sf):
    return master(spark, sf, [b.DATES[0], b.DATES[-1]]).withColumn("dem_age", F.round("dem_age", 6))


@register("m4_fold_slices", f"WITH {SLICED} SELECT fold_id, role, count(*) AS n, min(as_of_date) AS first_date, max(as_of_date) AS last_date FROM sliced GROUP BY ALL")
def _(spark, sf):
    return (
        sliced(spark, sf)
        .groupBy("fold_id", "role")
        .agg(F.count(F.lit(1)).alias("n"), F.min("as_of_date").alias("first_date"), F.max("as_of_date").alias("last_date"))
    )


@register(
    "m5_impute_mean",
    f"""WITH {SLICED}, mean AS (SELECT fold_id, avg(dem_age) AS m FROM sliced WHERE role = 'train' GROUP BY ALL)
    SELECT fold_id, role, entity_id, as_of_date, round(coalesce(dem_age, m), 6) AS dem_age FROM sliced JOIN mean USING (fold_id)""",
)
def _(spark, sf):
    out = mx.impute_mean(sliced(spark, sf, ["age"]), ["dem_age"])
    return out.select("fold_id", "role", *KEYS, F.round("dem_age", 6).alias("dem_age"))


CATEGORIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@register(
    "m6_one_hot",
    f"WITH {SLICED} SELECT fold_id, role, entity_id, as_of_date, "
    + ", ".join(f"CASE WHEN cat_priority = '{c}' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS \"cat_priority_{c}\"" for c in CATEGORIES)
    + ", CASE WHEN cat_priority IS NULL THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS \"cat_priority_None\" FROM sliced",
)
def _(spark, sf):
    rows = sliced(spark, sf, ["kinds"])
    found = mx.train_categories(rows, ["cat_priority"])
    found["cat_priority"] = sorted({*found["cat_priority"], None}, key=lambda v: (v is None, v))
    out = mx.one_hot(rows, found)
    return out.select("fold_id", "role", *KEYS, *[c for c in out.columns if c.startswith("cat_priority_")])


SCALED = ["ord_n_sum_3m", "ord_n_sum_12m", "ord_days_since_last"]


@register(
    "m7_standardise",
    f"WITH {SLICED}, st AS (SELECT fold_id, "
    + ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in SCALED)
    + " FROM sliced WHERE role = 'train' GROUP BY ALL) SELECT fold_id, role, entity_id, as_of_date, "
    + ", ".join(f"round(({c} - m_{c}) / CASE WHEN s_{c} = 0 THEN 1 ELSE s_{c} END, 6) AS {c}" for c in SCALED)
    + " FROM sliced JOIN st USING (fold_id)",
)
def _(spark, sf):
    out = mx.standardise(sliced(spark, sf, ["numbers"]), SCALED)
    return out.select("fold_id", "role", *KEYS, *[F.round(c, 6).alias(c) for c in SCALED])


def fold_matrix(spark, sf):
    """Labelled, imputed, one-hot and scaled rows of every fold. Features and labels share one stored cohort."""
    people = stored(tp.cohort(spark, sf), "cohort")
    rows = mx.impute_mean(sliced(spark, sf, people=people), ["dem_age"])
    rows = mx.one_hot(rows, {"cat_priority": CATEGORIES})
    columns = [c for c in rows.columns if c not in (*KEYS, "fold_id", "role")]
    return mx.align_labels(mx.standardise(rows, columns), tp.labels(spark, sf, people=people)), columns


@register(
    "m8_align_labels",
    f"""WITH {b.LABELS}, {tp.SERIES_FOLDS} SELECT fold_id, role, label, count(*) AS n, CAST(0 AS BIGINT) AS null_cells FROM labels_ JOIN folds USING (as_of_date) GROUP BY ALL""",
)
def _(spark, sf):
    rows, columns = fold_matrix(spark, sf)
    return rows.groupBy("fold_id", "role", "label").agg(
        F.count(F.lit(1)).alias("n"), mx.null_cells(rows, columns).cast("long").alias("null_cells")
    )


@register(
    "m9_fold_fingerprint",
    f"""WITH {b.COHORT}, {tp.SERIES_FOLDS}, fp AS (SELECT fold_id, left(sha256(string_agg(CAST(as_of_date AS STRING), '|' ORDER BY as_of_date) FILTER (WHERE role = 'train')
        || '|' || max(CAST(as_of_date AS STRING)) FILTER (WHERE role = 'validation') || '|ALL'), 16) AS fingerprint FROM folds GROUP BY ALL)
    SELECT fingerprint, fold_id, count(*) AS n FROM fp JOIN folds USING (fold_id) JOIN cohort USING (as_of_date) GROUP BY ALL""",
)
def _(spark, sf):
    folds = fo.folds_frame(spark, b.FOLDS)
    counts = mx.slice_folds(tp.cohort(spark, sf), folds).groupBy("fold_id").agg(F.count(F.lit(1)).alias("n"))
    return mx.fingerprint_column(folds, "ALL").join(counts, "fold_id")
