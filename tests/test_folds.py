from datetime import date

import pytest

from tidemark.dates import Interval, add_months, whole_months
from tidemark.plans.folds import FoldConfig, all_dates, date_ladder, make_folds, train_and_validation_dates


def cfg(start, latest, freq, **kw):
    base = dict(months_future=6, max_train_history_months=60, min_train_history_months=0, multiple_folds=True, fold_shift_months=6)
    return FoldConfig(start, latest, freq, **(base | kw))


def test_single_train_date():
    (fold,) = make_folds(cfg("2019-01-01", "2019-07-01", 3, multiple_folds=False))
    assert fold.train_dates == (date(2019, 1, 1),) and fold.validation_date == date(2019, 7, 1)


def test_many_train_dates():
    (fold,) = make_folds(cfg("2015-07-01", "2021-01-01", 6, multiple_folds=False))
    wanted = [date(y, m, 1) for y in range(2020, 2014, -1) for m in (7, 1) if date(2015, 7, 1) <= date(y, m, 1) <= date(2020, 7, 1)]
    assert list(fold.train_dates) == wanted


def test_two_folds_and_dates():
    folds = make_folds(cfg("2019-01-01", "2020-01-01", 6, max_train_history_months=12))
    assert [(f.train_dates, f.validation_date) for f in folds] == [
        ((date(2019, 7, 1), date(2019, 1, 1)), date(2020, 1, 1)),
        ((date(2019, 1, 1),), date(2019, 7, 1)),
    ]
    assert all_dates(folds) == [date(2019, 1, 1), date(2019, 7, 1), date(2020, 1, 1)]
    assert train_and_validation_dates(folds) == ([date(2019, 1, 1), date(2019, 7, 1)], [date(2019, 7, 1), date(2020, 1, 1)])


def test_max_history():
    folds = make_folds(cfg("2019-01-01", "2020-01-01", 6, max_train_history_months=5))
    assert all(len(f.train_dates) == 1 for f in folds)


def test_min_history():
    last = make_folds(cfg("2017-01-01", "2020-01-01", 6, min_train_history_months=24))[-1]
    assert list(last.train_dates) == [date(2019, 1, 1), date(2018, 7, 1), date(2018, 1, 1), date(2017, 7, 1), date(2017, 1, 1)]
    assert last.validation_date == date(2019, 7, 1)


def test_folds_shift_and_nest():
    folds = make_folds(cfg("2017-01-01", "2020-01-01", 3, max_train_history_months=36, fold_shift_months=3))
    for newer, older in zip(folds, folds[1:]):
        assert add_months(newer.validation_date, -3) == older.validation_date
        assert set(older.train_dates) <= set(newer.train_dates)
        assert list(older.train_dates) == sorted(older.train_dates, reverse=True)


def test_ladder_clamps_step_by_step():
    assert date_ladder(date(2020, 1, 1), date(2020, 5, 31), 1, 0, 60)[:4] == [date(2020, 5, 31), date(2020, 4, 30), date(2020, 3, 30), date(2020, 2, 29)]


def test_no_fold():
    with pytest.raises(ValueError):
        make_folds(cfg("2019-12-01", "2020-01-01", 6))


def test_month_arithmetic():
    assert add_months(date(2020, 3, 31), -1) == date(2020, 2, 29)
    assert whole_months(date(2020, 1, 31), date(2020, 2, 29)) == 1
    assert whole_months(date(2020, 1, 15), date(2020, 3, 14)) == 1
    assert Interval.parse("9999 months").unbounded and Interval.parse("7 days").suffix == "7d"
