"""Result tables: each query writes to a new folder and reads back."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from tidemark.operators.ranking import model_grid
from tidemark.queries import base as b
from tidemark.queries import evaluations as eq
from tidemark.queries import groups as gq
from tidemark.queries import temporal as tp
from tidemark.queries.base import register, t
from tidemark.queries.ranks import GRID
from tidemark.session import new_table_path, stored
from tidemark.sources import catalog as ct
from tidemark.sources import results as rs

P = ["model_id", "entity_id", "segment", "as_of_date", "score", "label_name", "label", "k", "segment_k"]


@register("s1_table_scan", "SELECT * REPLACE (strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate) FROM orders")
def _(spark, sf):
    return ct.read_table(spark, "orders", sf).withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd"))


@register("s4_s5_predictions", f"WITH {b.PREDICTIONS} SELECT {', '.join(P)} FROM pr WHERE model_id IN (105, 207)")
def _(spark, sf):
    folder = new_table_path(spark, "results")
    rs.save_predictions(b.predictions(spark, sf).select(P), folder)
    return rs.read_predictions(spark, folder, [105, 207]).select(P)


@register("s4_predictions_csv", f"WITH {b.PREDICTIONS} SELECT model_id, entity_id, k FROM pr WHERE model_id = 105")
def _(spark, sf):
    folder = new_table_path(spark, "results")
    path = rs.save_predictions(b.predictions(spark, sf).select("model_id", "entity_id", "k"), folder, csv=True)
    schema = "entity_id long, k long, model_id int"
    return spark.read.option("header", True).schema(schema).csv(path).where("model_id = 105").select("model_id", "entity_id", "k")


@register("s6_append_results", f"WITH {b.PREDICTIONS}, {eq.EVALUATIONS} SELECT * FROM evals UNION ALL SELECT model_id + 1000, as_of_date, segment, metric, k, segment_k, value FROM evals")
def _(spark, sf):
    folder = new_table_path(spark, "results")
    rows = stored(eq.evaluations(spark, sf), "evaluations")  # a few rows per model, ranked once for both writes
    rs.append(rows, folder, "evaluations")
    rs.append(rows.withColumn("model_id", F.col("model_id") + 1000), folder, "evaluations")
    return spark.read.parquet(f"{folder}/evaluations")


@register(
    "s6_model_ids",
    f"""WITH {b.EVENTS} SELECT 6 AS sets, 6 AS models, 6 AS distinct_ids, true AS stable, count(*) AS n_events FROM ev""",
)
def _(spark, sf):
    """Ids are the same when the rows are made again."""
    first = rs.model_set_rows(spark, 7, model_grid(GRID), {"months_future": 6})
    again = rs.model_set_rows(spark, 7, model_grid(GRID), {"months_future": 6})
    models = rs.model_rows(first, [b.DATES[0]])
    same = first.join(again, "model_set_id", "left_anti").agg((F.count(F.lit(1)) == 0).alias("stable"))
    counts = models.agg(F.count_distinct("model_set_id").cast("int").alias("sets"), F.count(F.lit(1)).cast("int").alias("models"), F.count_distinct("model_id").cast("int").alias("distinct_ids"))
    n = b.entity_events(spark, sf).agg(F.count(F.lit(1)).alias("n_events"))
    one = lambda df: df.withColumn("_one", F.lit(1))
    return one(counts).join(one(same), "_one").join(one(n), "_one").drop("_one")


@register("s7_overwrite", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey % 2 = 0")
def _(spark, sf):
    path = new_table_path(spark, "table")
    rows = t(spark, sf, "orders").select("o_orderkey", "o_custkey")
    rs.overwrite(rows, path)
    return rs.overwrite(rows.where("o_orderkey % 2 = 0"), path)


@register(
    "s7_overwrite_partitions",
    "SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus = 'F' THEN 2 ELSE 1 END AS version FROM orders",
)
def _(spark, sf):
    path = new_table_path(spark, "table")
    rows = t(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    rs.overwrite_partitions(rows.withColumn("version", F.lit(1)), path, ["o_orderstatus"])
    rs.overwrite_partitions(rows.where("o_orderstatus = 'F'").withColumn("version", F.lit(2)), path, ["o_orderstatus"])
    return spark.read.parquet(path)


@register(
    "s8_s9_experiment_log",
    f"""WITH {b.COHORT} SELECT l.label_name, true AS finished, '6' AS months_future, 'east' AS trained_on, n.n FROM (VALUES ('EXIT A'), ('EXIT B')) l(label_name) CROSS JOIN (SELECT count(*) AS n FROM cohort) n""",
)
def _(spark, sf):
    folder = new_table_path(spark, "results")
    config = {"labels": {"months_future": 6, "selected_labels": ["EXIT A", "EXIT B"]}}
    done = rs.start_experiment(spark, folder, config, "east", "Exit only", datetime(2001, 1, 1))
    rs.start_experiment(spark, folder, config, "west", "Exit only", datetime(2001, 1, 2))
    rs.end_experiment(spark, folder, done, datetime(2001, 1, 3))
    runs = rs.experiments(spark.read.parquet(f"{folder}/experiments")).where("ends is not null")
    n = tp.cohort(spark, sf).count()
    return runs.join(rs.selected_labels(runs), "experiment_id").select(
        "label_name",
        F.col("ends").isNotNull().alias("finished"),
        F.get_json_object("config", "$.labels.months_future").alias("months_future"),
        "trained_on",
        F.lit(n).cast("long").alias("n"),
    )


@register(
    "s9_json_path",
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events WHERE CAST(json_extract_string(props, '$.k') AS INTEGER) = 6""",
)
def _(spark, sf):
    k = F.get_json_object("props", "$.k").cast("int")
    return t(spark, sf, "events").select("event_id", k.alias("k")).where("k = 6")


@register("s10_list_export", f"WITH {gq.BLOCKS} SELECT * FROM bl")
def _(spark, sf):
    from tidemark.operators.outreach import monthly_blocks

    blocks = monthly_blocks(gq.lists(spark, sf), gq.K)
    path = rs.export_lists(blocks, new_table_path(spark, "export"))
    schema = "as_of_date date, entity_id long, position long, month int, model_set_id long"
    return spark.read.option("header", True).schema(schema).csv(path)
