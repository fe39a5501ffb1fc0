import math
import random
from datetime import date

from tidemark.operators.outreach import monthly_blocks, outreach_lists
from tidemark.operators.ranking import rank_predictions

DAYS = [date(2020, 1, 1), date(2020, 4, 1), date(2020, 7, 1), date(2020, 10, 1)]


def walk(rows, k, days):
    """Plain walk over the sorted predictions of one model set."""
    seen, out = set(), []
    per_date = k * math.ceil(12 / len(days))
    for d in days:
        picked = 0
        for r in sorted((r for r in rows if r.as_of_date == d), key=lambda r: r.k):
            if picked == per_date or len(seen) == 12 * k:
                break
            if r.entity_id not in seen:
                seen.add(r.entity_id)
                picked += 1
                out.append((d, r.entity_id))
    return out


def test_lists_equal_a_plain_walk(spark):
    rng = random.Random(1)
    rows = [(s, s * 10 + q, e, "a", d, rng.random()) for s in (1, 2) for q, d in enumerate(DAYS) for e in range(150)]
    df = spark.createDataFrame(rows, "model_set_id long, model_id int, entity_id long, segment string, as_of_date date, score double")
    ranked = rank_predictions(df)
    got = outreach_lists(ranked, 5, "2020-05-01", "2020-12-01")
    data = ranked.collect()
    for s in (1, 2):
        mine = [(r.as_of_date, r.entity_id) for r in got.orderBy("position").collect() if r.model_set_id == s]
        assert mine == walk([r for r in data if r.model_set_id == s], 5, DAYS[1:])
    blocks = monthly_blocks(got, 5).groupBy("model_set_id", "month").count().collect()
    assert {r["count"] for r in blocks} == {5}


def test_exhausted_lists_are_shorter(spark):
    rows = [(1, q, e, "a", d, e / 10) for q, d in enumerate(DAYS) for e in range(8)]
    df = spark.createDataFrame(rows, "model_set_id long, model_id int, entity_id long, segment string, as_of_date date, score double")
    assert outreach_lists(rank_predictions(df), 5, "2020-01-01", "2020-12-01").count() == 8
