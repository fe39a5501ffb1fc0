"""Train and validation matrices per fold.

Imputation, categories and scaling are learnt on a fold's training rows only and applied to
both roles; the statistics are one row per fold and are broadcast.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.plans.folds import Fold

KEYS = ["entity_id", "as_of_date"]


def check_names(columns: Sequence[str]) -> None:
    twice = sorted({c for c in columns if list(columns).count(c) > 1})
    if twice:
        raise ValueError(f"feature names occur twice: {twice}")


def master_matrix(cohort: DataFrame, feature_tables: Sequence[DataFrame], as_of_dates: Sequence | None = None) -> DataFrame:
    """Cohort keys with the columns of every feature table, joined on the key."""
    check_names([c for t in feature_tables for c in t.columns if c not in KEYS])
    keys = cohort.select(*KEYS)
    if as_of_dates is not None:
        keys = keys.where(F.col("as_of_date").isin(list(as_of_dates)))
    return reduce(lambda a, b: a.join(b, KEYS, "inner"), feature_tables, keys)


def split_column_kinds(df: DataFrame) -> tuple[list[str], list[str]]:
    """Categorical (string) and numerical feature columns."""
    fields = [f for f in df.schema.fields if f.name not in (*KEYS, "segment", "label", "fold_id", "role")]
    text = [f.name for f in fields if f.dataType.typeName() == "string"]
    return text, [f.name for f in fields if f.name not in text]


def slice_folds(master: DataFrame, folds: DataFrame) -> DataFrame:
    """Rows per fold and role; a date may serve several folds. The folds table is made of settings."""
    return master.join(F.broadcast(folds), "as_of_date", "inner")


def impute_mean(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULLs become the mean of the fold's training rows."""
    train = F.col("role") == "train"
    means = df.groupBy("fold_id").agg(*[F.avg(F.when(train, F.col(c))).alias(f"_m_{c}") for c in columns])
    filled = lambda c: F.coalesce(F.col(c).cast("double"), F.col(f"_m_{c}")).alias(c)
    return df.join(F.broadcast(means), "fold_id").select(*[filled(c) if c in columns else c for c in df.columns])


def train_categories(df: DataFrame, columns: Sequence[str], limit: int = 1000) -> dict[str, list[str | None]]:
    """Distinct training values per column (NULL included), for naming one-hot columns.

    Brings at most ``limit`` values per column to the driver and fails beyond that, as a matrix
    cannot have that many columns.
    """
    train = df.where("role = 'train'")
    out = {}
    for c in columns:
        values = [r[0] for r in train.select(c).distinct().limit(limit + 1).collect()]
        if len(values) > limit:
            raise ValueError(f"{c} has more than {limit} categories")
        out[c] = sorted(values, key=lambda v: (v is None, v))
    return out


def one_hot(df: DataFrame, categories: dict[str, Sequence[str | None]]) -> DataFrame:
    """A 0/1 column per training category; NULL is a category, unknown values are all zero."""
    hot = [
        F.when(F.col(c).eqNullSafe(v), 1.0).otherwise(0.0).alias(f"{c}_{'None' if v is None else v}")
        for c, values in categories.items()
        for v in values
    ]
    return df.select(*[c for c in df.columns if c not in categories], *hot)


def standardise(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(x - mean) / population deviation of the fold's training rows; a deviation of 0 scales by 1."""
    train = F.col("role") == "train"
    value = lambda c: F.when(train, F.col(c).cast("double"))
    stats = df.groupBy("fold_id").agg(
        *[F.avg(value(c)).alias(f"_m_{c}") for c in columns], *[F.stddev_pop(value(c)).alias(f"_s_{c}") for c in columns]
    )
    out = df.join(F.broadcast(stats), "fold_id")
    scaled = [
        ((F.col(c).cast("double") - F.col(f"_m_{c}")) / F.when(F.col(f"_s_{c}") == 0, 1.0).otherwise(F.col(f"_s_{c}"))).alias(c)
        for c in columns
    ]
    kept = [c for c in df.columns if c not in columns]
    return out.select(*kept, *scaled)


def align_labels(matrix: DataFrame, labels: DataFrame) -> DataFrame:
    """Matrix rows that have a label, with it."""
    return matrix.join(labels.select(*KEYS, "label"), KEYS, "inner")


def null_cells(df: DataFrame, columns: Sequence[str]) -> Column:
    return sum((F.sum(F.col(c).isNull().cast("int")) for c in columns), F.lit(0))


def fold_fingerprint(fold: Fold, segment: str) -> str:
    """Stable name of a fold and segment, as a partition value for stored matrices."""
    text = "|".join([*map(str, sorted(fold.train_dates)), str(fold.validation_date), segment])
    return hashlib.sha256(text.encode()).hexdigest()[:16]


def fingerprint_column(folds: DataFrame, segment: str) -> DataFrame:
    """The same fingerprint from a folds table."""
    train = F.array_sort(F.collect_list(F.when(F.col("role") == "train", F.col("as_of_date").cast("string"))))
    return folds.groupBy("fold_id").agg(
        F.left(
            F.sha2(
                F.concat_ws(
                    "|",
                    train,
                    F.max(F.when(F.col("role") == "validation", F.col("as_of_date").cast("string"))),
                    F.lit(segment),
                ),
                256,
            ),
            F.lit(16),
        ).alias("fingerprint")
    )

