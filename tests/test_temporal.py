"""Cohorts, labels and features against brute force, on data in which one entity has a third of the rows."""

import random
import statistics
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.dates import Interval, add_months
from tidemark.operators import cohort as co
from tidemark.operators import features as fe

DATES = [date(2020, m, d) for m, d in ((1, 31), (3, 31), (5, 31), (9, 1))]
SEGMENTS = {"a": ["s0"], "b": ["s1", "s2"]}
SCHEMA = "entity_id long, event_date date, source string, amount int"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    out = []
    for i in range(900):
        who = 1 if i % 3 == 0 else rng.randint(2, 60)
        day = date(2019, 1, 1) + timedelta(days=rng.randint(0, 700))
        out.append((who, day, f"s{rng.randint(0, 3)}", rng.randint(0, 9)))
    return out


@pytest.fixture(scope="module")
def exits():
    return [(5, date(2020, 3, 31)), (5, date(2020, 8, 1)), (7, date(2019, 2, 1))]


def brute_cohort(rows, exits):
    out = {}
    for d in DATES:
        for who in {r[0] for r in rows}:
            mine = [r for r in rows if r[0] == who and add_months(d, -2) <= r[1] <= d and r[2] != "s3"]
            if not mine or any(e[0] == who and e[1] <= d for e in exits):
                continue
            newest = max(r[1] for r in mine)
            ranks = [next((i for i, s in enumerate(SEGMENTS.values(), 1) if r[2] in s), 0) for r in mine if r[1] == newest]
            out[(who, d)] = [None, "a", "b"][max(ranks)]
    return out


def make(spark, rows, exits):
    events = spark.createDataFrame(rows, SCHEMA)
    gone = spark.createDataFrame(exits, "entity_id long, exit_date date")
    return events, co.build_cohort(events, DATES, "2 months", SEGMENTS, ["s3"], gone)


def test_cohort(spark, rows, exits):
    _, cohort = make(spark, rows, exits)
    got = {(r.entity_id, r.as_of_date): r.segment for r in cohort.collect()}
    assert got == brute_cohort(rows, exits)


def test_labels_are_strict_on_both_sides(spark, rows, exits):
    events, cohort = make(spark, rows, exits)
    hits = events.where("source = 's0'").select("entity_id", "event_date", F.lit("L").alias("label_name"))
    got = {(r.entity_id, r.as_of_date): r.label for r in co.build_labels(cohort, hits, ["L"], DATES, 1, ["a", "b"]).collect()}
    wanted = {
        k: any(r[0] == k[0] and r[2] == "s0" and k[1] < r[1] < add_months(k[1], 1) for r in rows)
        for k, s in brute_cohort(rows, exits).items()
        if s
    }
    assert got == wanted


SPEC = fe.FeatureSource(
    "events", "e", "event_date",
    windows=(
        fe.WindowAggregate("amount", "amount", ("sum", "max", "count", "avg"), ("7 days", "1 month", "30 days", "9999 months")),
        fe.WindowAggregate("big", "1", ("sum",), ("3 months",), where="amount > 5"),
    ),
    history=(
        fe.HistoryFeature("last", "days_since_last", impute=999999),
        fe.HistoryFeature("last_big", "days_since_last", where="amount > 5", impute=999999),
        fe.HistoryFeature("ever", "ever", arg="amount = 9", impute=0),
    ),
    modes=(fe.ModeFeature("source", "source"),),
)


def brute_features(rows, key):
    who, d = key
    mine = [r for r in rows if r[0] == who and r[1] < d]
    inside = lambda iv: [r for r in mine if iv.unbounded or r[1] >= iv.before(d)]
    out = {}
    for text in ("7 days", "1 month", "30 days", "9999 months"):
        iv = Interval.parse(text)
        amounts = [r[3] for r in inside(iv)]
        out[f"e_amount_sum_{iv.suffix}"] = sum(amounts)
        out[f"e_amount_max_{iv.suffix}"] = max(amounts, default=0)
        out[f"e_amount_count_{iv.suffix}"] = len(amounts)
        out[f"e_amount_avg_{iv.suffix}"] = sum(amounts) / len(amounts) if amounts else 0
    out["e_big_sum_3m"] = sum(r[3] > 5 for r in inside(Interval.parse("3 months")))
    since = lambda rs: (d - max(r[1] for r in rs)).days if rs else 999999
    out["e_last"], out["e_last_big"] = since(mine), since([r for r in mine if r[3] > 5])
    out["e_ever"] = int(any(r[3] == 9 for r in mine))
    counts = {}
    for r in mine:
        counts[r[2]] = counts.get(r[2], 0) + 1
    out["e_source"] = min(counts, key=lambda s: (-counts[s], s)) if counts else None
    return out


def as_dict(df):
    return {(r.entity_id, r.as_of_date): {k: v for k, v in r.asDict().items() if k not in ("entity_id", "as_of_date")} for r in df.collect()}


@pytest.mark.parametrize("chunk", [200, 4])
def test_features(spark, rows, exits, chunk):
    events, cohort = make(spark, rows, exits)
    got = as_dict(fe.build_features(cohort, events, SPEC, DATES, chunk))
    assert got == {k: pytest.approx(brute_features(rows, k)) for k in brute_cohort(rows, exits)}


def test_window_bound_follows_the_date(spark):
    """30 days reach further back than a month on 1 March, and less far on 1 February."""
    cohort = spark.createDataFrame([(1, date(2024, 2, 1)), (1, date(2024, 3, 1))], "entity_id long, as_of_date date")
    source = spark.createDataFrame([(1, date(2024, 1, 1), 5.0)], "entity_id long, day date, v double")
    spec = fe.FeatureSource("s", "s", "day", windows=(fe.WindowAggregate("v", "v", ("sum",), ("30 days", "1 month")),))
    got = {r.as_of_date.month: r.s_v_sum_1m for r in fe.build_features(cohort, source, spec, [date(2024, 2, 1), date(2024, 3, 1)]).collect()}
    assert got == {2: 5.0, 3: 0.0}


@pytest.mark.parametrize("seed", range(3))
def test_mixed_units_against_brute_force(spark, rows, exits, seed):
    rng = random.Random(seed)
    events, cohort = make(spark, rows, exits)
    units = [f"{n} {u}" for n, u in ((1, "month"), (30, "days"), (4, "weeks"), (52, "weeks"), (1, "year"), (12, "months"), (365, "days"), (366, "days"), (9, "weeks"), (2, "months"), (61, "days"))]
    chosen = rng.sample(units, 5)
    spec = fe.FeatureSource("events", "e", "event_date", windows=(fe.WindowAggregate("a", "amount", ("sum", "count"), chosen),))
    want = {}
    for who, d in brute_cohort(rows, exits):
        for name, _, fn, iv in spec.window_columns():
            inside = [r[3] for r in rows if r[0] == who and iv.before(d) <= r[1] < d]
            want[(who, d, name)] = sum(inside) if fn == "sum" else len(inside)
    for columns in (100, 3):
        found = fe.build_features(cohort, events, spec, DATES, columns).collect()
        assert {(r.entity_id, r.as_of_date, c[0]): r[c[0]] for r in found for c in spec.window_columns()} == want


STATES = fe.FeatureSource(
    "events", "x", "event_date",
    windows=(fe.WindowAggregate("amount", "amount", ("sum", "avg"), ("1 month", "9 months", "9999 months")),),
    history=(fe.HistoryFeature("last", "days_since_last", impute=-1),),
    modes=(fe.ModeFeature("source", "source"),),
    states=(
        fe.State("n", "count", "amount"), fe.State("mean", "avg", "amount", where="amount < 8"), fe.State("var", "variance", "amount"), fe.State("sd", "stddev", "amount"),
        fe.State("early", "first", "source", where="amount > 2"), fe.State("late", "last", "amount"), fe.State("kinds", "count_distinct", "source"),
        fe.State("levels", "count_distinct", "amount", where="source <> 's0'"), fe.State("spread", "sketch", "amount"),
    ),
    expressions=(
        fe.HistoryExpression("n", "n", impute=0), fe.HistoryExpression("ratio", "mean / n"), fe.HistoryExpression("var", "var"), fe.HistoryExpression("sd", "sd"),
        fe.HistoryExpression("early", "early", categorical=True), fe.HistoryExpression("late", "late"), fe.HistoryExpression("kinds", "kinds"), fe.HistoryExpression("levels", "levels", impute=0),
        fe.HistoryExpression("median", "kll_sketch_get_quantile_double(spread, 0.5D)"), fe.HistoryExpression("year", "year(as_of_date) + kinds"),
    ),
)


def brute_expressions(rows, key):
    who, d = key
    mine = [r for r in rows if r[0] == who and r[1] < d]
    amounts = [r[3] for r in mine]
    some = [x for x in amounts if x < 8]
    var = statistics.variance(amounts) if len(amounts) > 1 else None
    kinds = len({r[2] for r in mine}) or None
    return {
        "x_n": len(mine), "x_ratio": sum(some) / len(some) / len(mine) if some else None, "x_var": var, "x_sd": var**0.5 if var is not None else None,
        "x_early": min(((r[1], r[2]) for r in mine if r[3] > 2), default=(0, None))[1], "x_late": max(((r[1], r[3]) for r in mine), default=(0, None))[1],
        "x_kinds": kinds, "x_levels": len({r[3] for r in mine if r[2] != "s0"}), "x_year": d.year + kinds if kinds else None,
    }


def test_expressions_over_states(spark, rows, exits):
    events, cohort = make(spark, rows, exits)
    got = as_dict(fe.build_features(cohort, events, STATES, DATES))
    assert set(got) == set(brute_cohort(rows, exits))
    for key, found in got.items():
        want = brute_expressions(rows, key)
        assert {k: found[k] for k in want} == pytest.approx(want, abs=1e-9)
        amounts = [r[3] for r in rows if r[0] == key[0] and r[1] < key[1]]
        middle = found["x_median"]  # exact while the sketch holds all values
        assert middle is None if not amounts else sum(a < middle for a in amounts) <= len(amounts) / 2 + 5 and sum(a > middle for a in amounts) <= len(amounts) / 2 + 5


def test_carried_states_equal_a_full_run(spark, rows, exits):
    events, cohort = make(spark, rows, exits)
    plain = fe.FeatureSource(**{**vars(STATES), "expressions": tuple(e for e in STATES.expressions if e.name != "median")})
    want = as_dict(fe.build_features(cohort, events, plain, DATES))
    state, got = None, {}
    for d in DATES:  # one date after the other, each from the state before
        part = cohort.where(F.col("as_of_date") == d)
        read = events if state is None else events.where(F.col("event_date") >= min(state.since, Interval.parse("9 months").before(d)))
        got |= as_dict(fe.build_features(part, read, plain, [d], carried=state))
        newer = events if state is None else events.where(F.col("event_date") >= state.since)
        state = fe.stored_state(fe.history_state(newer, plain, d, state))
    assert got == {k: pytest.approx(v, abs=1e-9) for k, v in want.items()}
    with pytest.raises(ValueError):
        fe.build_features(cohort, events, plain, DATES, carried=state)


def dealt(monkeypatch, rows_per_task):
    monkeypatch.setattr("tidemark.session.ROWS_PER_TASK", rows_per_task, raising=False)


@pytest.mark.parametrize("spec", [SPEC, STATES, fe.FeatureSource("events", "x", "event_date", states=STATES.states[:6], expressions=STATES.expressions[:6])])
def test_features_of_many_tasks_equal_those_of_one(spark, rows, exits, monkeypatch, spec):
    events, cohort = make(spark, [*rows, (None, DATES[0], "s0", 1), (2, None, "s0", 1), (3, DATES[0], None, None)], exits)
    want = as_dict(fe.build_features(cohort, events, spec, DATES))
    state = fe.history_state(events, spec, DATES[0]).values
    kept = {r.entity_id: (r.n, r.var__s, r.late) for r in state.collect()} if spec.states else None
    dealt(monkeypatch, 100)
    for chunk in (100, 4):
        got = as_dict(fe.build_features(cohort, events, spec, DATES, chunk))
        assert got == {k: pytest.approx(v, abs=1e-9) for k, v in want.items()}
    if spec.states:
        state = fe.history_state(events, spec, DATES[0]).values
        assert {r.entity_id: (r.n, r.var__s, r.late) for r in state.collect()} == kept


@pytest.mark.parametrize("kept", ["windows", "history"])
def test_tasks_go_with_the_rows(spark, monkeypatch, kept):
    """No task gets a share of the keys that grows with the input, also if the scan is one task and rows are narrow."""
    dealt(monkeypatch, 2000)
    events = spark.range(30_000).select((F.col("id") % 15_000).alias("entity_id"), F.lit(DATES[0]).alias("event_date"), F.lit("s0").alias("source"), F.lit(1).alias("amount")).coalesce(1)
    cohort = events.select("entity_id", F.explode(F.array(*map(F.lit, DATES[1:]))).alias("as_of_date")).distinct()
    spec = fe.FeatureSource("events", "e", "event_date", **{kept: getattr(SPEC, kept)})
    out = fe.build_features(cohort, events, spec, DATES).groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in out) == 45_000
    assert max(r["count"] for r in out) < 9_000


def test_a_hot_entity_is_combined_in_several_tasks(spark, monkeypatch):
    """Its rows leave a task as one per date and ring, and no task has a third of them."""
    events = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("entity_id"), F.lit(DATES[0]).alias("event_date"), F.lit("s0").alias("source"), F.col("id").cast("int").alias("amount"))
    spec = fe.FeatureSource("events", "e", "event_date", windows=SPEC.windows)
    rows, _ = fe._rings(events, spec, fe._pieces(spec), DATES, True, None, 16)
    hot = rows.where("entity_id = -1").select("*", F.spark_partition_id().alias("p")).collect()
    name = next(c for c in rows.columns if c.startswith("_m"))
    assert len(hot) <= fe.PARTS_PER_ENTITY * len(DATES[1:]) and len({r.p for r in hot}) >= 8
    total = {d: sum(r[name] or 0 for r in hot if r.as_of_date == d) for d in DATES[1:]}
    assert set(total.values()) <= {0, sum(range(0, 30_000, 3))} and total[DATES[1]]


def test_no_row_goes_to_every_later_date(spark, rows, exits):
    """Rows of all history leave the fan-out once; only those inside a window come more often."""
    events, cohort = make(spark, rows, exits)
    only = fe.FeatureSource("events", "x", "event_date", states=STATES.states, expressions=STATES.expressions)
    fanned, _ = fe._rings(events, only, fe._pieces(only), DATES, False)
    assert fanned.count() == sum(r[1] < DATES[-1] for r in rows)


def test_ages_in_a_spec(spark):
    cohort = spark.createDataFrame([(k, date(2024, 2, 1)) for k in (1, 2, 3, 4)], "entity_id long, as_of_date date")
    source = spark.createDataFrame([(1, date(2023, 1, 1), "1984-02-01"), (1, date(2023, 1, 2), "1984-02-01"), (1, date(2023, 1, 3), "1990-01-01"), (2, date(2023, 1, 1), "2023-01-01"), (3, date(2024, 2, 1), "1984-02-01")], "entity_id long, day date, dob string")
    spec = fe.FeatureSource("s", "d", "day", ages=(fe.AgeFeature("age", "dob"),))
    got = {r.entity_id: (r.d_age, r.d_age_imp) for r in fe.build_features(cohort, source, spec, [date(2024, 2, 1)]).collect()}
    assert got == {1: (pytest.approx(14610 / 365.25), 0), 2: (None, 1), 3: (None, 1), 4: (None, 1)}
    assert spec.numeric_columns() == ["d_age", "d_age_imp"]


def test_where_of_a_flag_and_names_shared(spark):
    cohort = spark.createDataFrame([(1, date(2024, 2, 1))], "entity_id long, as_of_date date")
    source = spark.createDataFrame([(1, date(2024, 1, 1), 5.0)], "entity_id long, day date, v double")
    flag = fe.FeatureSource("s", "s", "day", history=(fe.HistoryFeature("f", "ever", "v > 1", where="v > 9"), fe.HistoryFeature("g", "ever", "v > 1")))
    row = fe.build_features(cohort, source, flag, [date(2024, 2, 1)]).first()
    assert (row.s_f, row.s_g) == (0, 1)
    same = fe.WindowAggregate("v", "v", ("sum",), ("1 month",), where="v > 7")
    with pytest.raises(ValueError):
        fe.build_features(cohort, source, fe.FeatureSource("s", "s", "day", windows=(same, fe.WindowAggregate("v", "v", ("sum",), ("1 month",)))), [date(2024, 2, 1)])


def test_later_events_never_change_features(spark, rows, exits):
    _, cohort = make(spark, rows, exits)
    cohort = cohort.where(F.col("as_of_date") == DATES[1])
    later = [(r[0], DATES[1] + timedelta(days=i % 50), "s0", 9) for i, r in enumerate(rows)]
    known = spark.createDataFrame(rows, SCHEMA)
    both = spark.createDataFrame(rows + later, SCHEMA)
    assert as_dict(fe.build_features(cohort, known, SPEC, DATES)) == as_dict(fe.build_features(cohort, both, SPEC, DATES))


def test_events_outside_the_horizon_never_change_labels(spark, rows, exits):
    _, cohort = make(spark, rows, exits)
    cohort = cohort.where(F.col("as_of_date") == DATES[1])
    hits = spark.createDataFrame([(r[0], r[1], "L") for r in rows if r[2] == "s0"], "entity_id long, event_date date, label_name string")
    edge = [(r[0], x, "L") for r in rows for x in (DATES[1], add_months(DATES[1], 1))]
    more = hits.unionByName(spark.createDataFrame(edge, hits.schema))
    build = lambda h: sorted(co.build_labels(cohort, h, ["L"], DATES, 1, ["a", "b"]).collect())
    assert build(hits) == build(more)


def test_split_labels_agree_with_labels(spark, rows, exits):
    events, cohort = make(spark, rows, exits)
    named = events.select("entity_id", "event_date", F.col("source").alias("label_name"))
    split = co.build_split_labels(cohort, named, ["s0", "s1"], DATES, 2, ["a", "b"])
    joint = co.build_labels(cohort, named, ["s0", "s1"], DATES, 2, ["a", "b"])
    any_of = split.groupBy("entity_id", "as_of_date").agg(F.max("label").alias("label"))
    assert sorted(any_of.collect()) == sorted(joint.select("entity_id", "as_of_date", "label").collect())


def test_label_groups():
    groups = {"One-two only": [["x", "y"], ["x"]]}
    assert co.label_table_name(co.label_group_of(["y", "x"], groups), "both") == "label_one_two_only_both"
    with pytest.raises(ValueError):
        co.label_group_of(["z"], groups)


@pytest.mark.parametrize("query", ["t10_interval_aggregates", "t17_t18_episodes"])
def test_queries_in_many_tasks(spark, tmp_path, monkeypatch, query):
    """The same rows as in one task, and no task with a large share of them."""
    from tidemark.queries import load_all

    day = lambda n: F.timestamp_add("DAY", n.cast("int"), F.lit("1997-06-01").cast("timestamp"))
    orders = spark.range(12_000).select(
        F.col("id").alias("o_orderkey"), F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 4_000).alias("o_custkey"), F.lit("F").alias("o_orderstatus"),
        (F.col("id") * 7 % 400_000).cast("double").alias("o_totalprice"), day(F.col("id") * 37 % 1200).alias("o_orderdate"), F.lit("1-URGENT").alias("o_orderpriority"),
    )
    items = orders.select(
        F.col("o_orderkey").alias("l_orderkey"), F.timestamp_add("DAY", (F.col("o_orderkey") % 90).cast("int"), F.col("o_orderdate")).alias("l_shipdate"),
        F.when(F.col("o_orderkey") % 5 == 0, "R").otherwise("N").alias("l_returnflag"), (F.col("o_orderkey") % 50).cast("double").alias("l_quantity"),
    )
    for name, df in (("orders", orders), ("lineitem", items)):
        df.coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    run = load_all()[0][query]
    want = sorted(map(tuple, run(spark, str(tmp_path)).collect()))
    dealt(monkeypatch, 1000)
    got = run(spark, str(tmp_path)).withColumn("p", F.spark_partition_id()).collect()
    assert sorted(tuple(r)[:-1] for r in got) == want and len(want) > 5_000
    sizes = [sum(r.p == p for r in got) for p in {r.p for r in got}]
    assert max(sizes) < len(got) / 4
