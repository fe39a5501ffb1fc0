from datetime import date

import pytest
from pyspark.sql import functions as F

from tidemark.functions import cleaning as c
from tidemark.functions import text as tx
from tidemark.functions import vocab as v


def values(spark, fn, items, kind="string"):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(items)], f"i int, x {kind}")
    return [r.y for r in df.select("i", fn(F.col("x")).alias("y")).orderBy("i").collect()]


def test_fix_date_goldens(spark):
    got = values(spark, lambda x: c.fix_date(x, "2022-08-01"), ["12/01/1990", "12/01/90", "12/01/2090", "12/01/1890", "", None, "13/45/1990"])
    assert got == [date(1990, 12, 1), date(1990, 12, 1), None, None, None, None, None]


def test_clean_text_drops_only_the_first_del(spark):
    assert values(spark, c.clean_text, [" a\x7fb\x7f ", "\x7f", "  ", None]) == ["AB\x7f", None, None, None]


def test_fix_time(spark):
    assert values(spark, c.fix_time, ["12:34", "12:34:56", "9975", "12", None]) == ["12:34", "12:34", None, None, None]


def test_numbers(spark):
    assert values(spark, c.to_int, [" 12 ", "1.5", "a", None]) == [12, None, None, None]
    assert values(spark, c.fix_age, ["149", "150"]) == [149, None]


@pytest.mark.parametrize("text,wanted", [("ALCOHOL FREE", "OTHER"), ("ALCOHOL USE", "SUBSTANCE-RELATED OR ADDICTIVE"), (None, "OTHER"), ("PARANOIA", "PERSONALITY")])
def test_classes(spark, text, wanted):
    assert values(spark, lambda x: tx.classify_text(x, v.DIAGNOSIS_CLASSES, F.lit("OTHER")), [text]) == [wanted]


def test_plain_patterns_equal_regex(spark):
    """Patterns that are looked for as plain words give what the regular expression gives."""
    texts = ["TIC DISORDER", "NO TIC HERE", "TIC", "X PARANOIA", "PARANOIA", "DRUG-USE", "", "STRESS"]
    rules = [p for r in v.DIAGNOSIS_CLASSES for p in (*r.any_of, *r.also, *r.none_of, *r.or_any)]
    df = spark.createDataFrame([(x,) for x in texts], "x string")
    row = df.agg(*[F.sum((tx._matches(F.col("x"), p) != F.col("x").rlike(p)).cast("int")).alias(f"c{i}") for i, p in enumerate(rules)]).first()
    assert sum(row) == 0


def test_fuzzy_names(spark):
    names = values(spark, lambda x: tx.fuzzy_canonicalise(x, v.CITY_NAMES, v.CITY_NULLS), ["OLATHA", "PLATTE", "66061", ".", "DENVER"])
    assert names == ["OLATHE", "PLATTE", "OLATHE", None, "DENVER"]
