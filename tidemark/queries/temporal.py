"""Folds, cohorts, labels and point-in-time features."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.dates import Interval, fan_out
from tidemark.operators import cohort as co
from tidemark.operators import conform as cf
from tidemark.operators import features as fe
from tidemark.operators.features import AgeFeature, DateFeature, FeatureSource, HistoryExpression, HistoryFeature, ModeFeature, State, WindowAggregate
from tidemark.plans import folds as fo
from tidemark.plans.stages import Stages, data_version, stage_key
from tidemark.queries import base as b
from tidemark.queries import etl
from tidemark.queries.base import register, t
from tidemark.session import new_table_path, stored

KEYS = ["entity_id", "as_of_date"]

# ---- folds -----------------------------------------------------------------------------

SERIES_FOLDS = """f AS (SELECT CAST(i AS INTEGER) AS fold_id, CAST(DATE '2000-07-01' - INTERVAL (6 * i) MONTH AS DATE) AS v FROM range(0, 5) r(i)),
  folds AS (SELECT fold_id, 'validation' AS role, v AS as_of_date FROM f
    UNION ALL SELECT fold_id, 'train', CAST(d AS DATE) FROM f, LATERAL (SELECT unnest(generate_series(DATE '1998-01-01', v - INTERVAL 6 MONTH, INTERVAL 6 MONTH)) AS d))"""


@register(
    "t1_date_ladder",
    """SELECT CAST(d AS DATE) AS as_of_date, count(*) AS orders_before FROM orders,
       (SELECT unnest(generate_series(DATE '1998-01-01', DATE '2000-01-01', INTERVAL 6 MONTH)) AS d) WHERE CAST(o_orderdate AS DATE) < d GROUP BY d""",
)
def _(spark, sf):
    cfg = b.TEMPORAL
    ladder = fo.date_ladder(b.DATES[0], fo.add_months(b.DATES[-1], -6), cfg.train_sampling_freq_months, 0, cfg.max_train_history_months)
    day = F.to_date("o_orderdate")
    rows = fan_out(t(spark, sf, "orders"), ["o_orderdate"], [{"as_of": d} for d in ladder], lambda w: day < w["as_of"])
    return rows.groupBy(F.col("_w.as_of").alias("as_of_date")).agg(F.count(F.lit(1)).alias("orders_before"))


def cohort(spark, sf):
    return co.build_cohort(b.entity_events(spark, sf), b.DATES, b.BACK, b.SEGMENT_SOURCES, b.EXCLUDED, b.exits(spark, sf))


@register(
    "t2_folds",
    f"WITH {b.COHORT}, {SERIES_FOLDS} SELECT fold_id, role, as_of_date, count(*) AS n FROM cohort JOIN folds USING (as_of_date) GROUP BY ALL",
)
def _(spark, sf):
    counts = cohort(spark, sf).groupBy("as_of_date").agg(F.count(F.lit(1)).alias("n"))
    return fo.folds_frame(spark, b.FOLDS).join(counts, "as_of_date").select("fold_id", "role", "as_of_date", "n")


@register(
    "t3_fold_dates",
    f"""WITH {b.COHORT}, {SERIES_FOLDS}, d AS (SELECT DISTINCT role, as_of_date FROM folds UNION SELECT DISTINCT 'all', as_of_date FROM folds)
    SELECT role, as_of_date, count(*) AS n FROM cohort JOIN d USING (as_of_date) GROUP BY ALL""",
)
def _(spark, sf):
    train, validation = fo.train_and_validation_dates(b.FOLDS)
    rows = [("train", d) for d in train] + [("validation", d) for d in validation] + [("all", d) for d in fo.all_dates(b.FOLDS)]
    dates = spark.createDataFrame(rows, "role string, as_of_date date")
    counts = cohort(spark, sf).groupBy("as_of_date").agg(F.count(F.lit(1)).alias("n"))
    return dates.join(counts, "as_of_date").select("role", "as_of_date", "n")


# ---- cohort and labels -----------------------------------------------------------------


@register("t4_cohort", f"WITH {b.COHORT} SELECT entity_id, as_of_date, segment FROM cohort")
def _(spark, sf):
    return cohort(spark, sf)


def labels(spark, sf, names=tuple(b.LABEL_NAMES), people=None):
    return co.build_labels(cohort(spark, sf) if people is None else people, b.label_events(spark, sf), names, b.DATES, b.HORIZON, b.SEGMENTS)


@register("t5_labels", f"WITH {b.LABELS} SELECT * FROM labels_")
def _(spark, sf):
    return labels(spark, sf)


@register(
    "t6_label_group",
    f"""WITH {b.COHORT}, {b.LABEL_EVENTS} SELECT 'label_exit_only_all' AS table_name, c.as_of_date, c.segment,
      EXISTS (SELECT 1 FROM le WHERE le.entity_id = c.entity_id AND le.label_name IN ('EXIT A', 'EXIT B') AND le.event_date > c.as_of_date
              AND le.event_date < c.as_of_date + INTERVAL 6 MONTH) AS label, count(*) AS n
    FROM cohort c WHERE segment IN ('east', 'west') GROUP BY ALL""",
)
def _(spark, sf):
    chosen = ["EXIT B", "EXIT A"]
    name = co.label_table_name(co.label_group_of(chosen, b.LABEL_GROUPS), "ALL")
    return labels(spark, sf, sorted(chosen)).groupBy(F.lit(name).alias("table_name"), "as_of_date", "segment", "label").agg(F.count(F.lit(1)).alias("n"))


DEFINITIONS = (
    co.LabelDefinition("Large order", "orders", "o_orderdate", "o_totalprice > 300000", "o_custkey"),
    co.LabelDefinition("Urgent", "orders", "o_orderdate", "o_orderpriority = '1-URGENT'", "o_custkey"),
    co.LabelDefinition("Urgent", "items", "l_shipdate", "l_quantity > 49", "o_custkey"),
    co.LabelDefinition("Any shipment", "items", "l_shipdate", entity="o_custkey"),
)


@register(
    "t6_label_definitions",
    f"""WITH {b.COHORT}, items AS (SELECT o_custkey, l_shipdate, l_quantity FROM orders JOIN lineitem ON l_orderkey = o_orderkey), defined AS (
      SELECT o_custkey AS entity_id, CAST(o_orderdate AS DATE) AS event_date, 'Large order' AS label_name FROM orders WHERE o_totalprice > 300000
      UNION ALL SELECT o_custkey, CAST(o_orderdate AS DATE), 'Urgent' FROM orders WHERE o_orderpriority = '1-URGENT'
      UNION ALL SELECT o_custkey, CAST(l_shipdate AS DATE), 'Urgent' FROM items WHERE l_quantity > 49
      UNION ALL SELECT o_custkey, CAST(l_shipdate AS DATE), 'Any shipment' FROM items),
    hits AS (SELECT DISTINCT c.entity_id, c.as_of_date, label_name FROM cohort c JOIN defined d ON d.entity_id = c.entity_id AND event_date > as_of_date AND event_date < as_of_date + INTERVAL {b.HORIZON} MONTH)
    SELECT c.entity_id, c.as_of_date, segment, n.label_name, h.entity_id IS NOT NULL AS label FROM cohort c, (SELECT DISTINCT label_name FROM defined) n
    LEFT JOIN hits h ON h.entity_id = c.entity_id AND h.as_of_date = c.as_of_date AND h.label_name = n.label_name WHERE segment IN ('east', 'west')""",
)
def _(spark, sf):
    """Labels from definitions over source tables, one row per label name."""
    tables = {"orders": t(spark, sf, "orders"), "items": b.owned_items(spark, sf)}
    found = co.defined_label_events(tables, DEFINITIONS)
    return co.build_split_labels(cohort(spark, sf), found, sorted({d.name for d in DEFINITIONS}), b.DATES, b.HORIZON, b.SEGMENTS)


def split_labels(spark, sf, **kw):
    return co.build_split_labels(cohort(spark, sf), b.label_events(spark, sf), b.LABEL_NAMES, b.DATES, b.HORIZON, b.SEGMENTS, **kw)


@register("t7_split_labels", f"WITH {b.SPLIT_LABELS} SELECT * FROM split_labels")
def _(spark, sf):
    return split_labels(spark, sf)


@register(
    "t8_open_labels",
    f"WITH {b.SPLIT_LABELS.replace(f'c.as_of_date + INTERVAL {b.HORIZON} MONTH', 'DATE ' + chr(39) + '2001-03-31' + chr(39))} SELECT * FROM split_labels",
)
def _(spark, sf):
    return split_labels(spark, sf, open_until="2001-03-31")


@register(
    "t20_future_events",
    f"""WITH {b.EVENTS}, {b.EXITS} SELECT entity_id, event_date, event_type, source FROM ev
    WHERE event_date > DATE '2000-07-01' AND entity_id IN (SELECT entity_id FROM ex)""",
)
def _(spark, sf):
    return co.future_events(b.entity_events(spark, sf), b.exits(spark, sf), "2000-07-01").select("entity_id", "event_date", "event_type", "source")


# ---- features --------------------------------------------------------------------------

ORDERS = FeatureSource(
    "orders", "ord", "o_orderdate",
    windows=(
        WindowAggregate("orders", "1", ("sum",), ("7 days", "1 month", "12 months", "9999 months")),
        WindowAggregate("priced", "case when o_totalprice > 100000 then o_totalprice end", ("count",), ("3 months", "9999 months")),
        WindowAggregate("spend", "o_totalprice", ("sum", "avg"), ("14 days", "6 months", "9999 months")),
        WindowAggregate("spend", "o_totalprice", ("max", "min"), ("1 year",)),
        WindowAggregate("urgent", "1", ("sum",), ("6 months", "60 months"), where="o_orderpriority = '1-URGENT'"),
    ),
    history=(
        HistoryFeature("days_since_last", "days_since_last", impute=999999),
        HistoryFeature("days_since_first", "days_since_first", impute=999999),
        HistoryFeature("days_since_last_urgent", "days_since_last", where="o_orderpriority = '1-URGENT'", impute=999999),
        HistoryFeature("urgent_flag", "ever", arg="o_orderpriority = '1-URGENT'", impute=0),
        HistoryFeature("never_flag", "min", arg="case when o_orderpriority = '1-URGENT' then 0 else 1 end", impute=1),
    ),
    modes=(ModeFeature("priority", "o_orderpriority"), ModeFeature("late_status", "o_orderstatus", where="o_totalprice > 250000", impute="NONE")),
    dates=(DateFeature("seasonality_month", "cast(month(as_of_date) as string)"),),
)
WEST_ONLY = FeatureSource(
    "shipments", "shp", "l_shipdate", segment="west",
    windows=(WindowAggregate("quantity", "l_quantity", ("sum", "max"), ("3 months", "9999 months")),),
)


def order_source(spark, sf):
    return t(spark, sf, "orders").withColumnRenamed("o_custkey", "entity_id")


def item_source(spark, sf):
    return b.owned_items(spark, sf).withColumnRenamed("o_custkey", "entity_id")


JOINED = f"{b.COHORT}, j AS (SELECT c.entity_id, c.as_of_date, o.*, CAST(o_orderdate AS DATE) AS d FROM cohort c LEFT JOIN orders o ON o.o_custkey = c.entity_id AND CAST(o_orderdate AS DATE) < c.as_of_date)"


def win(fn: str, arg: str, interval: str | None, extra: str = "", fill: str = "0") -> str:
    bound = f"d >= as_of_date - INTERVAL {interval}" if interval else "true"
    return f"coalesce({fn}({arg}) FILTER (WHERE d IS NOT NULL AND {bound} {extra}), {fill})"


PRICED = "CASE WHEN o_totalprice > 100000 THEN o_totalprice END"
WINDOW_SQL = f"""
  CAST({win('sum', '1', '7 DAY')} AS BIGINT) AS ord_orders_sum_7d, CAST({win('sum', '1', '1 MONTH')} AS BIGINT) AS ord_orders_sum_1m,
  CAST({win('sum', '1', '12 MONTH')} AS BIGINT) AS ord_orders_sum_12m, CAST({win('sum', '1', None)} AS BIGINT) AS ord_orders_sum_9999m,
  CAST({win('count', PRICED, '3 MONTH')} AS BIGINT) AS ord_priced_count_3m, CAST({win('count', PRICED, None)} AS BIGINT) AS ord_priced_count_9999m,
  round({win('sum', 'o_totalprice', '14 DAY')}, 2) AS ord_spend_sum_14d, round({win('sum', 'o_totalprice', '6 MONTH')}, 2) AS ord_spend_sum_6m,
  round({win('sum', 'o_totalprice', None)}, 2) AS ord_spend_sum_9999m,
  round({win('avg', 'o_totalprice', '14 DAY')}, 8) AS ord_spend_avg_14d, round({win('avg', 'o_totalprice', '6 MONTH')}, 8) AS ord_spend_avg_6m,
  round({win('avg', 'o_totalprice', None)}, 8) AS ord_spend_avg_9999m,
  {win('max', 'o_totalprice', '1 YEAR')} AS ord_spend_max_1y, {win('min', 'o_totalprice', '1 YEAR')} AS ord_spend_min_1y,
  CAST({win('sum', '1', '6 MONTH', "AND o_orderpriority = '1-URGENT'")} AS BIGINT) AS ord_urgent_sum_6m,
  CAST({win('sum', '1', '60 MONTH', "AND o_orderpriority = '1-URGENT'")} AS BIGINT) AS ord_urgent_sum_60m"""
HISTORY_SQL = """
  CAST(coalesce(as_of_date - max(d), 999999) AS INTEGER) AS ord_days_since_last, CAST(coalesce(as_of_date - min(d), 999999) AS INTEGER) AS ord_days_since_first,
  CAST(coalesce(as_of_date - max(d) FILTER (WHERE o_orderpriority = '1-URGENT'), 999999) AS INTEGER) AS ord_days_since_last_urgent,
  CAST(coalesce(max(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END), 0) AS INTEGER) AS ord_urgent_flag,
  CAST(coalesce(min(CASE WHEN d IS NULL THEN NULL WHEN o_orderpriority = '1-URGENT' THEN 0 ELSE 1 END), 1) AS INTEGER) AS ord_never_flag"""


def rounded(df):
    places = lambda c: 2 if "_spend_sum_" in c else 8 if "_spend_avg_" in c else None
    return df.select(*[F.round(c, places(c)).alias(c) if places(c) else c for c in df.columns])


def only(spec: FeatureSource, **parts) -> FeatureSource:
    kept = {"windows": (), "history": (), "modes": (), "dates": ()} | parts
    return FeatureSource(spec.name, spec.prefix, spec.knowledge_date, spec.segment, impute_agg=spec.impute_agg, filter=spec.filter, **kept)


@register(
    "t9_point_in_time_join",
    f"""WITH {JOINED} SELECT entity_id, as_of_date, nullif(count(o_orderkey), 0) AS ord_n, max(d) AS ord_last_day, max(o_totalprice) - min(o_totalprice) AS ord_spread,
      nullif(count(DISTINCT o_orderstatus), 0) AS ord_kinds FROM j GROUP BY ALL""",
)
def _(spark, sf):
    spec = only(
        ORDERS,
        states=(State("orders", "count", "o_orderkey"), State("day", "max", "_day"), State("high", "max", "o_totalprice"), State("low", "min", "o_totalprice"), State("statuses", "count_distinct", "o_orderstatus")),
        expressions=(HistoryExpression("n", "nullif(orders, 0)"), HistoryExpression("last_day", "day"), HistoryExpression("spread", "high - low"), HistoryExpression("kinds", "statuses")),
    )
    return fe.build_features(cohort(spark, sf), order_source(spark, sf), spec, b.DATES)


EXPRESSIONS = FeatureSource(
    "orders", "ord", "o_orderdate",
    windows=(WindowAggregate("spend", "o_totalprice", ("max",), ("1 year",)),),
    states=(
        State("mean", "avg", "o_totalprice"),
        State("sd", "stddev", "o_totalprice", where="o_orderstatus = 'F'"),
        State("first_day", "min", "_day"),
        State("first_priority", "first", "o_orderpriority"),
        State("last_price", "last", "o_totalprice", where="o_orderstatus = 'O'"),
        State("priorities", "count_distinct", "o_orderpriority"),
        State("dates", "count_distinct", "o_orderdate", where="o_totalprice > 100000"),
        State("urgent", "count", "1", where="o_orderpriority = '1-URGENT'"),
    ),
    expressions=(
        HistoryExpression("mean_spend", "round(mean, 8)", impute=0),
        HistoryExpression("sd_spend", "round(sd, 3)"),
        HistoryExpression("known_years", "round(datediff(as_of_date, first_day) / 365.25D, 6)"),
        HistoryExpression("first_priority", "first_priority", impute="NONE", categorical=True),
        HistoryExpression("last_price", "last_price"),
        HistoryExpression("urgent_per_priority", "round(coalesce(urgent, 0) / cast(priorities as double), 6)"),
        HistoryExpression("dates", "dates", impute=0),
    ),
)
EXPRESSION_SQL = f"""WITH {JOINED}, firsts AS (SELECT entity_id, as_of_date, min((d, o_orderpriority))[2] AS p FROM j WHERE o_orderpriority IS NOT NULL AND d IS NOT NULL GROUP BY ALL),
    lasts AS (SELECT entity_id, as_of_date, max((d, o_totalprice))[2] AS q FROM j WHERE o_orderstatus = 'O' GROUP BY ALL)
    SELECT j.entity_id, j.as_of_date, {win('max', 'o_totalprice', '1 YEAR')} AS ord_spend_max_1y, coalesce(round(avg(o_totalprice), 8), 0) AS ord_mean_spend,
      round(stddev_samp(o_totalprice) FILTER (WHERE o_orderstatus = 'F'), 3) AS ord_sd_spend, round((j.as_of_date - min(d)) / 365.25::DOUBLE, 6) AS ord_known_years,
      coalesce(any_value(p), 'NONE') AS ord_first_priority, any_value(q) AS ord_last_price,
      round(count(*) FILTER (WHERE o_orderpriority = '1-URGENT') / nullif(count(DISTINCT o_orderpriority), 0)::DOUBLE, 6) AS ord_urgent_per_priority,
      count(DISTINCT o_orderdate) FILTER (WHERE o_totalprice > 100000) AS ord_dates
    FROM j LEFT JOIN firsts USING (entity_id, as_of_date) LEFT JOIN lasts USING (entity_id, as_of_date) GROUP BY j.entity_id, j.as_of_date"""


@register("t11_expressions", EXPRESSION_SQL)
def _(spark, sf):
    """Any SQL over mergeable states, numbers and categories alike."""
    return fe.build_features(cohort(spark, sf), order_source(spark, sf), EXPRESSIONS, b.DATES)


@register("t11_carried_states", EXPRESSION_SQL)
def _(spark, sf):
    """The same features, the later dates from states carried on from the earlier ones."""
    people, orders, dates = cohort(spark, sf), order_source(spark, sf), sorted(b.DATES)
    half = len(dates) // 2
    kept = fe.stored_state(fe.history_state(orders, EXPRESSIONS, dates[half - 1]))
    parts = [fe.build_features(people.where(F.col("as_of_date").isin(some)), orders, EXPRESSIONS, some, carried=c) for some, c in ((dates[:half], None), (dates[half:], kept))]
    return parts[0].unionByName(parts[1])


@register("t10_interval_aggregates", f"WITH {JOINED} SELECT entity_id, as_of_date, {WINDOW_SQL} FROM j GROUP BY entity_id, as_of_date")
def _(spark, sf):
    spec = only(ORDERS, windows=ORDERS.windows)
    return rounded(fe.build_features(cohort(spark, sf), order_source(spark, sf), spec, b.DATES))


# days are subtracted as integers: DuckDB takes INTERVAL 30 DAY and INTERVAL 1 MONTH for one expression
MIXED = {"30 days": "30", "1 month": "INTERVAL 1 MONTH", "52 weeks": "364", "1 year": "INTERVAL 12 MONTH", "61 days": "61", "2 months": "INTERVAL 2 MONTH"}
MIXED_SQL = ", ".join(
    f"count(*) FILTER (WHERE d IS NOT NULL AND d >= as_of_date - {bound}) AS ord_orders_{fn}_{Interval.parse(text).suffix}" for text, bound in MIXED.items() for fn in ("count", "sum")
)


@register("t10_mixed_units", f"WITH {JOINED} SELECT entity_id, as_of_date, {MIXED_SQL} FROM j GROUP BY entity_id, as_of_date")
def _(spark, sf):
    """Intervals of days, weeks and months whose order changes with the as-of date."""
    spec = only(ORDERS, windows=(fe.WindowAggregate("orders", "1", ("count", "sum"), tuple(MIXED)),))
    return fe.build_features(cohort(spark, sf), order_source(spark, sf), spec, b.DATES)


@register("t11_t13_history", f"WITH {JOINED} SELECT entity_id, as_of_date, {HISTORY_SQL} FROM j GROUP BY entity_id, as_of_date")
def _(spark, sf):
    spec = only(ORDERS, history=ORDERS.history)
    return fe.build_features(cohort(spark, sf), order_source(spark, sf), spec, b.DATES)


MODES_SQL = """
  , cnt AS (SELECT entity_id, as_of_date, o_orderpriority AS value, count(*) AS n FROM j WHERE d IS NOT NULL GROUP BY ALL),
  cnt2 AS (SELECT entity_id, as_of_date, o_orderstatus AS value, count(*) AS n FROM j WHERE o_totalprice > 250000 GROUP BY ALL),
  m1 AS (SELECT entity_id, as_of_date, value FROM cnt QUALIFY row_number() OVER (PARTITION BY entity_id, as_of_date ORDER BY n DESC, value) = 1),
  m2 AS (SELECT entity_id, as_of_date, value FROM cnt2 QUALIFY row_number() OVER (PARTITION BY entity_id, as_of_date ORDER BY n DESC, value) = 1)"""


@register(
    "t14_modes",
    f"""WITH {JOINED} {MODES_SQL} SELECT c.entity_id, c.as_of_date, m1.value AS ord_priority, coalesce(m2.value, 'NONE') AS ord_late_status
    FROM cohort c LEFT JOIN m1 USING (entity_id, as_of_date) LEFT JOIN m2 USING (entity_id, as_of_date)""",
)
def _(spark, sf):
    return fe.mode_features(cohort(spark, sf), order_source(spark, sf), ORDERS, b.DATES)


@register(
    "t15_age",
    f"""WITH {b.COHORT}, {etl.ATTRIBUTES}, dob AS (
      SELECT c.entity_id, c.as_of_date, CAST(min(attribute_value) AS DATE) AS dob FROM cohort c LEFT JOIN attrs
      ON attrs.entity_id = c.entity_id AND attrs.event_date < c.as_of_date AND attribute_type = 'dob' GROUP BY ALL)
    SELECT entity_id, as_of_date, round(CASE WHEN (as_of_date - dob) / 365.25::DOUBLE BETWEEN 5 AND 90 THEN (as_of_date - dob) / 365.25::DOUBLE END, 6) AS dem_age,
      CASE WHEN (as_of_date - dob) / 365.25::DOUBLE BETWEEN 5 AND 90 THEN 0 ELSE 1 END AS dem_age_imp FROM dob""",
)
def _(spark, sf):
    spec = FeatureSource("attributes", "dem", "event_date", ages=(AgeFeature("age", "attribute_value", where="attribute_type = 'dob'"),))
    return fe.build_features(cohort(spark, sf), etl.attributes(spark, sf), spec, b.DATES).withColumn("dem_age", F.round("dem_age", 6))


@register("t10_stages", f"WITH {JOINED} SELECT entity_id, as_of_date, {WINDOW_SQL}, {HISTORY_SQL} FROM j GROUP BY entity_id, as_of_date")
def _(spark, sf):
    """Features by stages: a first run over some dates, a second over all, which adds only the others."""
    stages, people, orders = Stages(spark, new_table_path(spark, "stages")), cohort(spark, sf), order_source(spark, sf)
    spec, dates = only(ORDERS, windows=ORDERS.windows, history=ORDERS.history), sorted(b.DATES)
    key = stage_key(spec, data_version(orders), data_version(people))
    stages.features(key, people, orders, spec, dates[: len(dates) // 2])
    return rounded(stages.features(key, people, orders, spec, dates))


@register("t16_seasonality", f"WITH {b.COHORT} SELECT entity_id, as_of_date, CAST(month(as_of_date) AS STRING) AS ord_seasonality_month FROM cohort")
def _(spark, sf):
    return fe.build_features(cohort(spark, sf), order_source(spark, sf), only(ORDERS, dates=ORDERS.dates), b.DATES)


@register(
    "t17_t18_episodes",
    f"""WITH {b.COHORT}, {etl.EPISODES}, j AS (SELECT c.entity_id, c.as_of_date, start_date, end_date, end_date AS d FROM cohort c
      LEFT JOIN ep ON ep.entity_id = c.entity_id AND ep.end_date < c.as_of_date)
    SELECT entity_id, as_of_date, CAST({win('sum', 'end_date - start_date', '6 MONTH')} AS BIGINT) AS ep_days_sum_6m,
      CAST({win('sum', 'end_date - start_date', None)} AS BIGINT) AS ep_days_sum_9999m,
      CAST({win('max', 'end_date - start_date', '24 MONTH')} AS INTEGER) AS ep_length_max_24m, CAST({win('max', 'end_date - start_date', None)} AS INTEGER) AS ep_length_max_9999m,
      CAST(coalesce(as_of_date - min(end_date), 999999) AS INTEGER) AS ep_days_since_first FROM j GROUP BY entity_id, as_of_date""",
)
def _(spark, sf):
    days = "datediff(end_date, start_date)"
    spec = FeatureSource(
        "episodes", "ep", "end_date",
        windows=(
            WindowAggregate("days", days, ("sum",), ("6 months", "9999 months")),
            WindowAggregate("length", days, ("max",), ("24 months", "9999 months")),
        ),
        history=(HistoryFeature("days_since_first", "days_since_first", impute=999999),),
    )
    # no feature takes the source; the rows are counted and then dealt out
    episodes = stored(cf.conform_episodes(etl.episode_parts(spark, sf)).drop("source"), "episodes")
    return fe.build_features(cohort(spark, sf), episodes, spec, b.DATES)


@register(
    "t19_segment_features",
    f"""WITH {b.COHORT}, j AS (SELECT c.entity_id, c.as_of_date, l.l_quantity, CAST(l_shipdate AS DATE) AS d FROM cohort c
      LEFT JOIN (orders o JOIN lineitem l ON l_orderkey = o_orderkey) ON o.o_custkey = c.entity_id AND CAST(l_shipdate AS DATE) < c.as_of_date)
    SELECT entity_id, as_of_date, {win('sum', 'l_quantity', '3 MONTH')} AS shp_quantity_sum_3m, {win('sum', 'l_quantity', None)} AS shp_quantity_sum_9999m,
      {win('max', 'l_quantity', '3 MONTH')} AS shp_quantity_max_3m, {win('max', 'l_quantity', None)} AS shp_quantity_max_9999m
    FROM j GROUP BY entity_id, as_of_date""",
)
def _(spark, sf):
    east = FeatureSource("orders", "ord", "o_orderdate", segment="east")
    columns = fe.columns_for_segment([east, WEST_ONLY], "west")
    items = stored(item_source(spark, sf).select("entity_id", "l_shipdate", "l_quantity"), "items")
    return fe.build_features(cohort(spark, sf), items, WEST_ONLY, b.DATES).select(*KEYS, *columns)


# ---- from events to precision at k -----------------------------------------------------


@register(
    "flagship_precision_at_k",
    f"""WITH {b.LABELS}, f AS (
      SELECT c.entity_id, c.as_of_date, count(*) FILTER (WHERE o.d >= c.as_of_date - INTERVAL 3 MONTH) AS n3,
        count(*) FILTER (WHERE o.d >= c.as_of_date - INTERVAL 12 MONTH) AS n12, count(o.d) AS n_all
      FROM cohort c LEFT JOIN (SELECT o_custkey, CAST(o_orderdate AS DATE) AS d FROM orders) o ON o.o_custkey = c.entity_id AND o.d < c.as_of_date
      GROUP BY ALL
    ), raw AS (SELECT *, 0.5::DOUBLE * n3 + 0.25::DOUBLE * n12 + 0.25::DOUBLE * n_all AS r FROM f),
    s AS (SELECT *, CASE WHEN max(r) OVER w > min(r) OVER w THEN (r - min(r) OVER w) / (max(r) OVER w - min(r) OVER w) ELSE 0 END AS score
          FROM raw WINDOW w AS (PARTITION BY as_of_date)),
    p AS (SELECT l.*, s.score, row_number() OVER (PARTITION BY l.as_of_date ORDER BY score DESC, l.entity_id % 64, l.entity_id) AS k,
            row_number() OVER (PARTITION BY l.as_of_date, segment ORDER BY score DESC, l.entity_id % 64, l.entity_id) AS segment_k
          FROM labels_ l JOIN s USING (entity_id, as_of_date)),
    g AS (SELECT as_of_date, segment, sum(CASE WHEN label AND segment_k <= CASE segment WHEN 'east' THEN 75 ELSE 40 END THEN 1 ELSE 0 END) AS top,
            sum(CASE WHEN label THEN 1 ELSE 0 END) AS pos, sum(CASE WHEN label AND k <= 115 THEN 1 ELSE 0 END) AS top_all, max(k) AS last_k,
            CASE segment WHEN 'east' THEN 75 ELSE 40 END AS sk FROM p GROUP BY ALL),
    a AS (SELECT as_of_date, sum(top_all) AS top_all, sum(pos) AS pos, max(last_k) AS last_k FROM g GROUP BY ALL)
    SELECT CAST(1 AS INTEGER) AS model_id, * FROM (
      SELECT as_of_date, segment, 'precision' AS metric, NULL::BIGINT AS k, sk::BIGINT AS segment_k, top / sk::DOUBLE AS value FROM g
      UNION ALL SELECT as_of_date, segment, 'recall', NULL, sk, CASE WHEN pos = 0 THEN 0 ELSE top / pos::DOUBLE END FROM g
      UNION ALL SELECT as_of_date, NULL, 'precision', 115, NULL, top_all / 115::DOUBLE FROM a
      UNION ALL SELECT as_of_date, NULL, 'recall', 115, NULL, CASE WHEN pos = 0 THEN 0 ELSE top_all / pos::DOUBLE END FROM a
      UNION ALL SELECT as_of_date, NULL, 'precision', last_k, NULL, pos / last_k::DOUBLE FROM a)""",
)
def _(spark, sf):
    from tidemark.operators.evaluation import evaluation_rows
    from tidemark.operators.ranking import attach_labels, linear_ranker, rank_predictions
    from tidemark.session import stored

    people = stored(cohort(spark, sf), "cohort")
    spec = FeatureSource("orders", "ord", "o_orderdate", windows=(WindowAggregate("n", "1", ("sum",), ("3 months", "12 months", "9999 months")),))
    features = fe.build_features(people, order_source(spark, sf), spec, b.DATES)
    weights = {"ord_n_sum_3m": 2.0, "ord_n_sum_12m": 1.0, "ord_n_sum_9999m": 1.0}
    scored = linear_ranker(features, weights).select(*KEYS, "score")
    made = co.build_labels(people, b.label_events(spark, sf), b.LABEL_NAMES, b.DATES, b.HORIZON, b.SEGMENTS)
    ranked = rank_predictions(stored(attach_labels(scored, made).withColumn("model_id", F.lit(1)), "flagship"))
    return evaluation_rows(ranked, b.TOTAL_K, b.SEGMENT_KS)
