"""Registry of queries with their SQL counterparts, and the views they share.

The views map the driver's tables onto the library's model: customers are entities; orders and
line items are their events; costly orders are exits; orders also stand for scored entities.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import conform as cf
from tidemark.operators.cohort import combine_label_parts
from tidemark.operators.ranking import rank_predictions
from tidemark.plans import folds as fo

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return add


_TABLES: dict[tuple[str, str], DataFrame] = {}


def t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A driver table; its frame is kept, as reading the schema takes a job."""
    key = (f"{spark.sparkContext.applicationId}-{id(spark)}", f"{sf}/{name}.parquet")
    if key not in _TABLES:
        _TABLES[key] = spark.read.parquet(key[1])
    return _TABLES[key]


# ---- temporal settings -----------------------------------------------------------------

TEMPORAL = fo.FoldConfig(
    absolute_train_start="1998-01-01",
    latest_validation_date="2000-07-01",
    train_sampling_freq_months=6,
    months_future=6,
    max_train_history_months=24,
    min_train_history_months=0,
    multiple_folds=True,
    fold_shift_months=6,
)
FOLDS = fo.make_folds(TEMPORAL)
DATES = fo.all_dates(FOLDS)
HORIZON = TEMPORAL.months_future
BACK = "3 months"

ASOF = "dates_(as_of_date) AS (VALUES " + ", ".join(f"(DATE '{d}')" for d in DATES) + ")"
FOLD_ROWS = (
    "folds(fold_id, role, as_of_date) AS (VALUES "
    + ", ".join(
        f"({i}, '{role}', DATE '{d}')"
        for i, f in enumerate(FOLDS)
        for role, ds in (("train", f.train_dates), ("validation", [f.validation_date]))
        for d in ds
    )
    + ")"
)

# ---- events, exits, labels -------------------------------------------------------------

SEGMENT_SOURCES = {"east": ["web_orders", "shipments"], "west": ["store_orders"]}
SEGMENTS = list(SEGMENT_SOURCES)
EXCLUDED = ["returns"]
EVENT_SPECS = [
    cf.EventSpec("web_orders", "ORDER", "o_orderdate", "o_custkey", "o_orderpriority in ('1-URGENT', '2-HIGH')"),
    cf.EventSpec("store_orders", "ORDER", "o_orderdate", "o_custkey", "o_orderpriority in ('3-MEDIUM', '4-NOT SPECIFIED')"),
    cf.EventSpec("phone_orders", "CALL", "o_orderdate", "o_custkey", "o_orderpriority = '5-LOW'"),
    cf.EventSpec("shipments", "SHIPMENT", "l_shipdate", "o_custkey", "l_returnflag <> 'R'"),
    cf.EventSpec("returns", "RETURN", "l_shipdate", "o_custkey", "l_returnflag = 'R'"),
]


def owned_items(spark: SparkSession, sf: str) -> DataFrame:
    """Line items with the customer of their order."""
    owners = t(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return t(spark, sf, "lineitem").join(owners, F.col("l_orderkey") == F.col("o_orderkey"))


def event_tables(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    orders, items = t(spark, sf, "orders"), owned_items(spark, sf)
    return {s.source: items if s.event_date == "l_shipdate" else orders for s in EVENT_SPECS}


def entity_events(spark: SparkSession, sf: str) -> DataFrame:
    return cf.conform_events(event_tables(spark, sf), EVENT_SPECS)


EVENTS = """ev AS (
  SELECT o_custkey AS entity_id, CAST(o_orderdate AS DATE) AS event_date,
         CASE WHEN o_orderpriority = '5-LOW' THEN 'CALL' ELSE 'ORDER' END AS event_type,
         CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'web_orders'
              WHEN o_orderpriority = '5-LOW' THEN 'phone_orders' ELSE 'store_orders' END AS source
  FROM orders
  UNION ALL
  SELECT o_custkey, CAST(l_shipdate AS DATE),
         CASE WHEN l_returnflag = 'R' THEN 'RETURN' ELSE 'SHIPMENT' END,
         CASE WHEN l_returnflag = 'R' THEN 'returns' ELSE 'shipments' END
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

EXIT_PRICE = 495000


def exits(spark: SparkSession, sf: str) -> DataFrame:
    """Exit rows: orders above a price, with two cause flags."""
    return (
        t(spark, sf, "orders")
        .where(F.col("o_totalprice") > EXIT_PRICE)
        .select(
            F.col("o_custkey").alias("entity_id"),
            F.col("o_orderdate").cast("date").alias("exit_date"),
            (F.col("o_orderpriority") == "1-URGENT").alias("cause_a"),
            (F.col("o_orderstatus") == "F").alias("cause_b"),
        )
    )


EXITS = f"""ex AS (
  SELECT o_custkey AS entity_id, CAST(o_orderdate AS DATE) AS exit_date,
         o_orderpriority = '1-URGENT' AS cause_a, o_orderstatus = 'F' AS cause_b
  FROM orders WHERE o_totalprice > {EXIT_PRICE})"""

COHORT = f"""{ASOF}, {EVENTS}, {EXITS}, newest AS (
  SELECT entity_id, as_of_date, source,
         row_number() OVER (PARTITION BY entity_id, as_of_date ORDER BY event_date DESC,
           CASE WHEN source IN ('web_orders', 'shipments') THEN 1 WHEN source = 'store_orders' THEN 2 ELSE 0 END DESC) AS rn
  FROM ev JOIN dates_ ON event_date >= as_of_date - INTERVAL 3 MONTH AND event_date <= as_of_date
  WHERE source NOT IN ('returns')
), cohort AS (
  SELECT entity_id, as_of_date,
         CASE WHEN source IN ('web_orders', 'shipments') THEN 'east' WHEN source = 'store_orders' THEN 'west' END AS segment
  FROM newest n WHERE rn = 1 AND NOT EXISTS (
    SELECT 1 FROM ex WHERE ex.entity_id = n.entity_id AND ex.exit_date <= n.as_of_date))"""

LABEL_NAMES = ["URGENT ORDER", "BIG RETURN", "EXIT A", "EXIT B"]
LABEL_GROUPS = {
    "Exit only": [["EXIT A", "EXIT B"]],
    "Any trouble": [["URGENT ORDER", "BIG RETURN", "EXIT A", "EXIT B"], ["BIG RETURN", "EXIT A", "EXIT B"]],
}


def label_events(spark: SparkSession, sf: str) -> DataFrame:
    orders, items, gone = t(spark, sf, "orders"), owned_items(spark, sf), exits(spark, sf)
    dated = lambda df, day: df.select(F.col("o_custkey").alias("entity_id"), F.col(day).cast("date").alias("event_date"))
    left = lambda cause: gone.where(cause).select("entity_id", F.col("exit_date").alias("event_date"))
    return combine_label_parts(
        {
            "URGENT ORDER": [dated(orders.where("o_orderpriority = '1-URGENT' and o_totalprice > 400000"), "o_orderdate")],
            "BIG RETURN": [dated(items.where("l_returnflag = 'R' and l_quantity >= 49"), "l_shipdate")],
            "EXIT A": [left("cause_a")],
            "EXIT B": [left("cause_b")],
        }
    )


LABEL_EVENTS = """le AS (
  SELECT o_custkey AS entity_id, CAST(o_orderdate AS DATE) AS event_date, 'URGENT ORDER' AS label_name
  FROM orders WHERE o_orderpriority = '1-URGENT' AND o_totalprice > 400000
  UNION ALL SELECT o_custkey, CAST(l_shipdate AS DATE), 'BIG RETURN'
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag = 'R' AND l_quantity >= 49
  UNION ALL SELECT entity_id, exit_date, 'EXIT A' FROM ex WHERE cause_a
  UNION ALL SELECT entity_id, exit_date, 'EXIT B' FROM ex WHERE cause_b)"""

LABELS = f"""{COHORT}, {LABEL_EVENTS}, labels_ AS (
  SELECT c.entity_id, c.as_of_date, c.segment, 'URGENT ORDER, BIG RETURN, EXIT A, EXIT B' AS label_name,
         EXISTS (SELECT 1 FROM le WHERE le.entity_id = c.entity_id AND le.event_date > c.as_of_date
                 AND le.event_date < c.as_of_date + INTERVAL {HORIZON} MONTH) AS label
  FROM cohort c WHERE segment IN ('east', 'west'))"""

SPLIT_LABELS = f"""{COHORT}, {LABEL_EVENTS}, split_labels AS (
  SELECT c.entity_id, c.as_of_date, c.segment, n.label_name,
         EXISTS (SELECT 1 FROM le WHERE le.entity_id = c.entity_id AND le.label_name = n.label_name
                 AND le.event_date > c.as_of_date AND le.event_date < c.as_of_date + INTERVAL {HORIZON} MONTH) AS label
  FROM cohort c CROSS JOIN (VALUES ('URGENT ORDER'), ('BIG RETURN'), ('EXIT A'), ('EXIT B')) n(label_name)
  WHERE segment IN ('east', 'west'))"""

# ---- crosswalk -------------------------------------------------------------------------


def crosswalk_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Match runs: an old one and a new one that misses some customers and knows two id kinds."""
    c = t(spark, sf, "customer").where("c_custkey % 11 <> 0")
    crm = c.select(
        F.col("c_custkey").alias("entity_id"),
        F.lit("CRM.CUSTOMER").alias("source"),
        F.col("c_custkey").cast("string").alias("sourceid"),
        F.md5(F.col("c_name").cast("binary")).alias("hash_sourceid"),
    )
    name = c.select(
        F.col("c_custkey").alias("entity_id"),
        F.lit("SHOP.NAME").alias("source"),
        F.col("c_name").alias("sourceid"),
        F.md5(F.col("c_name").cast("binary")).alias("hash_sourceid"),
    )
    both = crm.unionByName(name)
    old = both.withColumn("matchdate", F.lit("2001-05-23").cast("date"))
    new = both.where("entity_id % 7 <> 0").withColumn("matchdate", F.lit("2001-06-26").cast("date"))
    return old.unionByName(new)


CROSSWALK_RUNS = """cw_all AS (
  SELECT c_custkey AS entity_id, s.source, CASE WHEN s.source = 'CRM.CUSTOMER' THEN CAST(c_custkey AS STRING) ELSE c_name END AS sourceid,
         md5(c_name) AS hash_sourceid, r.matchdate
  FROM customer CROSS JOIN (VALUES ('CRM.CUSTOMER'), ('SHOP.NAME')) s(source)
  CROSS JOIN (VALUES (DATE '2001-05-23'), (DATE '2001-06-26')) r(matchdate)
  WHERE c_custkey % 11 <> 0 AND (r.matchdate = DATE '2001-05-23' OR c_custkey % 7 <> 0))"""
CROSSWALK = CROSSWALK_RUNS + """, cw AS (
  SELECT * FROM cw_all WHERE matchdate = (SELECT max(matchdate) FROM cw_all))"""


def crosswalk(spark: SparkSession, sf: str) -> DataFrame:
    return cf.latest_snapshot(crosswalk_runs(spark, sf), "matchdate")


# ---- predictions -----------------------------------------------------------------------

SEGMENT_KS = {"east": 75, "west": 40}
TOTAL_K = 115
MODEL_SETS = [1, 2, 3]


def scores(spark: SparkSession, sf: str) -> DataFrame:
    """Three model sets scoring every order in its year; the order is the entity."""
    orders = t(spark, sf, "orders")
    nations = t(spark, sf, "customer").select("c_custkey", "c_nationkey")
    rows = orders.join(nations, F.col("o_custkey") == F.col("c_custkey"))
    per_set = F.array(
        F.struct(F.lit(1).alias("s"), (F.col("o_totalprice") / 500000).alias("score")),
        F.struct(F.lit(2).alias("s"), (F.pmod(F.col("o_orderkey") * 7919, F.lit(1000)) / 1000).alias("score")),
        F.struct(
            F.lit(3).alias("s"),
            (F.when(F.col("o_orderstatus") == "F", 0.5).otherwise(0.25) + F.pmod(F.col("o_orderkey") * 31, F.lit(64)) / 128).alias("score"),
        ),
    )
    return rows.select(
        F.col("o_orderkey").alias("entity_id"),
        F.when(F.col("c_nationkey") % 2 == 0, "east").otherwise("west").alias("segment"),
        F.trunc("o_orderdate", "year").alias("as_of_date"),
        (F.col("o_orderstatus") == "F").alias("label"),
        F.inline(per_set),
    ).select(
        (F.col("s") * 100 + F.year("as_of_date") - 1990).cast("int").alias("model_id"),
        F.col("s").alias("model_set_id"),
        "entity_id",
        "segment",
        "as_of_date",
        "score",
        F.lit("STATUS F").alias("label_name"),
        "label",
    )


def predictions(spark: SparkSession, sf: str) -> DataFrame:
    return rank_predictions(scores(spark, sf))


PRED_COLUMNS = ["model_id", "model_set_id", "entity_id", "segment", "as_of_date", "score", "label_name", "label", "k", "segment_k"]

PREDICTIONS = """sc AS (
  SELECT CAST(s.s * 100 + year(o_orderdate) - 1990 AS INTEGER) AS model_id, CAST(s.s AS INTEGER) AS model_set_id,
         o_orderkey AS entity_id, CASE WHEN c_nationkey % 2 = 0 THEN 'east' ELSE 'west' END AS segment,
         CAST(date_trunc('year', o_orderdate) AS DATE) AS as_of_date,
         CASE s.s WHEN 1 THEN o_totalprice / 500000
                  WHEN 2 THEN CAST((o_orderkey * 7919) % 1000 AS DOUBLE) / 1000
                  ELSE (CASE WHEN o_orderstatus = 'F' THEN 0.5::DOUBLE ELSE 0.25::DOUBLE END)
                       + CAST((o_orderkey * 31) % 64 AS DOUBLE) / 128 END AS score,
         'STATUS F' AS label_name, o_orderstatus = 'F' AS label
  FROM orders JOIN customer ON o_custkey = c_custkey CROSS JOIN (VALUES (1), (2), (3)) s(s)
), pr AS (
  SELECT *, row_number() OVER (PARTITION BY model_id, as_of_date ORDER BY score DESC, entity_id % 64, entity_id) AS k,
         row_number() OVER (PARTITION BY model_id, as_of_date, segment ORDER BY score DESC, entity_id % 64, entity_id) AS segment_k
  FROM sc)"""
