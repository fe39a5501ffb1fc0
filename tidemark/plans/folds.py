"""Temporal folds: which as-of dates train and which one validates."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from tidemark.dates import add_months, to_date, whole_months


@dataclass(frozen=True)
class FoldConfig:
    absolute_train_start: date | str
    latest_validation_date: date | str
    train_sampling_freq_months: int
    months_future: int
    max_train_history_months: int = 60
    min_train_history_months: int = 0
    multiple_folds: bool = True
    fold_shift_months: int = 3


@dataclass(frozen=True)
class Fold:
    train_dates: tuple[date, ...]
    validation_date: date


def date_ladder(start: date, end: date, step_months: int, min_months: int, max_months: int) -> list[date]:
    """Dates from ``end`` down, each a step before the one above it; empty if too short."""
    if whole_months(start, end) < min_months:
        return []
    floor = max(start, add_months(end, -max_months))
    ladder = []
    while end >= floor:
        ladder.append(end)
        end = add_months(end, -step_months)
    return ladder


def make_folds(cfg: FoldConfig) -> list[Fold]:
    """Newest fold first; earlier folds follow until no training date is left."""
    start = to_date(cfg.absolute_train_start)
    validation = to_date(cfg.latest_validation_date)
    if validation < start:
        raise ValueError("latest_validation_date lies before absolute_train_start")
    folds: list[Fold] = []
    while True:
        ladder = date_ladder(
            start,
            add_months(validation, -cfg.months_future),
            cfg.train_sampling_freq_months,
            cfg.min_train_history_months,
            cfg.max_train_history_months,
        )
        if not ladder:
            break
        folds.append(Fold(tuple(ladder), validation))
        if not cfg.multiple_folds:
            break
        validation = add_months(validation, -cfg.fold_shift_months)
    if not folds:
        raise ValueError("no fold fits the temporal settings")
    return folds


def all_dates(folds: Sequence[Fold]) -> list[date]:
    return sorted({d for f in folds for d in (*f.train_dates, f.validation_date)})


def train_and_validation_dates(folds: Sequence[Fold]) -> tuple[list[date], list[date]]:
    train = sorted({d for f in folds for d in f.train_dates})
    return train, sorted({f.validation_date for f in folds})


def folds_frame(spark: SparkSession, folds: Sequence[Fold]) -> DataFrame:
    """``folds(fold_id, role, as_of_date)``: one row per fold and date, newest fold is 0."""
    rows = []
    for i, fold in enumerate(folds):
        if max(fold.train_dates) >= fold.validation_date:
            raise ValueError(f"fold {i} trains on dates after its validation date")
        rows += [(i, "train", d) for d in fold.train_dates]
        rows.append((i, "validation", fold.validation_date))
    return spark.createDataFrame(rows, "fold_id int, role string, as_of_date date")
