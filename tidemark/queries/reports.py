"""Exploration reports, data checks and catalogue metadata."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import text as tx
from tidemark.functions import vocab as v
from tidemark.operators import checks as ck
from tidemark.operators import cohort as co
from tidemark.operators import evaluation as ev
from tidemark.operators import explore as ex
from tidemark.operators.features import age_columns
from tidemark.queries import base as b
from tidemark.queries import etl
from tidemark.queries import evaluations as eq
from tidemark.queries import groups as gq
from tidemark.queries import temporal as tp
from tidemark.queries.base import register, t
from tidemark.queries.scalars import CALL_FLAGS, CALL_VIEW, DIAGNOSIS, FLAGS, SECOND, flagged_calls, lit, sql_classify
from tidemark.session import stored
from tidemark.sources import catalog as ct

TABLES = ["customer", "orders", "lineitem", "part", "supplier", "nation", "region", "events"]
FLAGGED = f"{CALL_VIEW}, cf AS (SELECT o_orderkey, entity_id, event_date, {CALL_FLAGS} FROM calls)"

# ---- exploration -----------------------------------------------------------------------


@register(
    "x1_match_coverage",
    f"""WITH {b.CROSSWALK}, ids AS (SELECT 'CRM.CUSTOMER' AS source, CAST(o_custkey AS STRING) AS sourceid FROM orders UNION ALL SELECT 'SHOP.NAME', c_name FROM customer)
    SELECT i.source, count(DISTINCT i.sourceid) AS unique_ids, count(*) AS id_rows, any_value(w.n) AS crosswalk_ids, any_value(w.r) AS crosswalk_rows,
      count(DISTINCT i.sourceid) FILTER (WHERE i.sourceid IN (SELECT sourceid FROM cw WHERE cw.source = i.source)) AS matched_ids,
      count(DISTINCT i.sourceid) FILTER (WHERE i.sourceid IN (SELECT sourceid FROM cw WHERE cw.source = i.source)) / count(DISTINCT i.sourceid)::DOUBLE AS share_matched
    FROM ids i JOIN (SELECT source, count(DISTINCT sourceid) AS n, count(*) AS r FROM cw GROUP BY ALL) w USING (source) GROUP BY i.source""",
)
def _(spark, sf):
    sources = {"CRM.CUSTOMER": (t(spark, sf, "orders"), "o_custkey"), "SHOP.NAME": (t(spark, sf, "customer"), "c_name")}
    out = ex.match_coverage(sources, b.crosswalk(spark, sf))
    return out.select("source", *[F.col(c).cast("long").alias(c) for c in ("unique_ids", "id_rows", "crosswalk_ids", "crosswalk_rows", "matched_ids")], "share_matched")


@register(
    "x2_entity_frequency",
    f"WITH {b.EVENTS} SELECT entity_id, event_type, count(*) AS n FROM ev GROUP BY ALL",
)
def _(spark, sf):
    return ex.value_counts(b.entity_events(spark, sf), "entity_id", "event_type")


@register(
    "x2_value_counts",
    "SELECT nullif(o_orderpriority, '5-LOW') AS priority, o_orderstatus AS status, count(*) AS n FROM orders GROUP BY ALL",
)
def _(spark, sf):
    rows = t(spark, sf, "orders").select(F.expr("nullif(o_orderpriority, '5-LOW')").alias("priority"), F.col("o_orderstatus").alias("status"))
    return ex.value_counts(rows, "priority", "status")


@register(
    "x3_counts_over_time",
    f"""WITH {FLAGGED}, y AS (SELECT CAST(year(event_date) AS INTEGER) AS year, CAST(month(event_date) AS INTEGER) AS month, count(*) AS all_events, count(*) FILTER (WHERE suicidal_flag) AS suicidal,
        count(*) FILTER (WHERE drug_flag) AS drug FROM cf GROUP BY ALL),
      u AS (SELECT year, month, s.s AS series, all_events, CASE s.s WHEN 'all_events' THEN all_events WHEN 'suicidal' THEN suicidal ELSE drug END AS n
            FROM y CROSS JOIN (VALUES ('all_events'), ('suicidal'), ('drug')) s(s))
    SELECT year, month, series, n, n / all_events::DOUBLE * 100 AS percent FROM u""",
)
def _(spark, sf):
    return ex.counts_over_time(flagged_calls(spark, sf), "event_date", {"suicidal": "suicidal_flag", "drug": "drug_flag"}, by_month=True)


@register(
    "x3_counts_by_year",
    """WITH y AS (SELECT CAST(year(ts) AS INTEGER) AS year, count(*) AS all_events, count(*) FILTER (WHERE event_type = 'purchase') AS bought, count(*) FILTER (WHERE value > 50) AS large FROM events GROUP BY ALL),
      u AS (SELECT year, s.s AS series, all_events, CASE s.s WHEN 'all_events' THEN all_events WHEN 'bought' THEN bought ELSE large END AS n FROM y CROSS JOIN (VALUES ('all_events'), ('bought'), ('large')) s(s))
    SELECT year, series, n, n / all_events::DOUBLE * 100 AS percent FROM u""",
)
def _(spark, sf):
    return ex.counts_over_time(t(spark, sf, "events"), "ts", {"bought": "event_type = 'purchase'", "large": "value > 50"})


@register("x4_flag_overlaps", f"WITH {FLAGGED} SELECT {', '.join(FLAGS)}, count(*) AS n FROM cf WHERE {' OR '.join(FLAGS)} GROUP BY ALL")
def _(spark, sf):
    return ex.flag_overlaps(flagged_calls(spark, sf), FLAGS)


PER_PERSON = f"{FLAGGED}, pe AS (SELECT entity_id, count(*) AS n_events, " + ", ".join(f"count(*) FILTER (WHERE {f}) AS n_{f}" for f in FLAGS) + f", count(*) FILTER (WHERE {' OR '.join(FLAGS)}) > 0 AS any_flag FROM cf GROUP BY ALL)"


@register("x5_flags_per_entity", f"WITH {PER_PERSON} SELECT * FROM pe")
def _(spark, sf):
    return ex.flags_per_entity(flagged_calls(spark, sf), FLAGS)


@register("x5_calls_by_group", f"WITH {PER_PERSON} SELECT any_flag, n_events, count(*) AS entities FROM pe GROUP BY ALL")
def _(spark, sf):
    return ex.calls_by_group(ex.flags_per_entity(flagged_calls(spark, sf), FLAGS))


def profile(spark, sf):
    attributes = t(spark, sf, "customer").select(F.col("c_custkey").alias("entity_id"), F.col("c_mktsegment").alias("market"))
    return ex.entity_profile(b.exits(spark, sf), flagged_calls(spark, sf), FLAGS[:3], b.crosswalk_runs(spark, sf), attributes)


PROFILE = f"""{FLAGGED}, {b.EXITS}, {b.CROSSWALK_RUNS}, h AS (SELECT entity_id, """ + ", ".join(f"max({f}) AS {f}" for f in FLAGS[:3]) + """ FROM cf GROUP BY ALL),
  cr AS (SELECT entity_id, count(*) AS contact_rows FROM cw_all GROUP BY ALL),
  prof AS (SELECT ex.*, """ + ", ".join(f"h.{f}" for f in FLAGS[:3]) + """, contact_rows, c_mktsegment AS market FROM ex LEFT JOIN h USING (entity_id) LEFT JOIN cr USING (entity_id) LEFT JOIN customer ON c_custkey = ex.entity_id)"""


@register("x6_exit_profile", f"WITH {PROFILE} SELECT * FROM prof")
def _(spark, sf):
    return profile(spark, sf)


@register(
    "x6_first_contact_share",
    f"""WITH {PROFILE}, p AS (SELECT * REPLACE (contact_rows // 2 AS contact_rows) FROM prof WHERE cause_b) SELECT market, count(*) FILTER (WHERE contact_rows = 1) AS only_contact,
      count(*) FILTER (WHERE contact_rows >= 1) AS total, count(*) FILTER (WHERE contact_rows = 1) / nullif(count(*) FILTER (WHERE contact_rows >= 1), 0)::DOUBLE AS share FROM p GROUP BY ALL""",
)
def _(spark, sf):
    halved = profile(spark, sf).withColumn("contact_rows", F.floor(F.col("contact_rows") / 2))
    return ex.first_contact_share(halved, "market", "cause_b")


TYPES = ["ORDER", "CALL", "SHIPMENT", "RETURN"]


@register(
    "x7_active_day_stats",
    f"""WITH {b.EVENTS}, {b.EXITS}, d AS (SELECT entity_id, event_type, count(DISTINCT event_date) AS n FROM ev GROUP BY ALL), who AS (SELECT DISTINCT entity_id FROM d),
      w AS (SELECT who.entity_id, ty.t AS event_type, coalesce(d.n, 0) AS n, coalesce((SELECT max(cause_a OR cause_b) FROM ex WHERE ex.entity_id = who.entity_id), false) AS label
            FROM who CROSS JOIN (VALUES ('ORDER'), ('CALL'), ('SHIPMENT'), ('RETURN')) ty(t) LEFT JOIN d ON d.entity_id = who.entity_id AND d.event_type = ty.t),
      s AS (SELECT event_type, """
    + ", ".join(
        f"{fn}(n) FILTER (WHERE {'label' if e == 'true' else 'NOT label'})::DOUBLE AS {name}_{e}"
        for e in ("true", "false")
        for name, fn in (("mean", "avg"), ("std", "stddev_samp"), ("min", "min"), ("max", "max"), ("median", "median"))
    )
    + """ FROM w GROUP BY ALL)
    SELECT event_type, x.stat, round(CASE x.stat WHEN 'mean' THEN mean_true WHEN 'std' THEN std_true WHEN 'min' THEN min_true WHEN 'max' THEN max_true ELSE median_true END, 6) AS label_true,
      round(CASE x.stat WHEN 'mean' THEN mean_false WHEN 'std' THEN std_false WHEN 'min' THEN min_false WHEN 'max' THEN max_false ELSE median_false END, 6) AS label_false,
      round(CASE x.stat WHEN 'mean' THEN mean_true - mean_false WHEN 'std' THEN std_true - std_false WHEN 'min' THEN min_true - min_false WHEN 'max' THEN max_true - max_false ELSE median_true - median_false END, 6) AS difference
    FROM s CROSS JOIN (VALUES ('mean'), ('std'), ('min'), ('max'), ('median')) x(stat)""",
)
def _(spark, sf):
    labelled = b.exits(spark, sf).select("entity_id", (F.col("cause_a") | F.col("cause_b")).alias("label"))
    out = ex.active_day_stats(b.entity_events(spark, sf), TYPES, labelled)
    return out.select("event_type", "stat", *[F.round(c, 6).alias(c) for c in ("label_true", "label_false", "difference")])


def false_alarms(spark, sf):
    """Customers that the first outreach model listed without an exit afterwards."""
    listed = gq.quarterly(spark, sf).where("model_id = 14 and k <= 300")
    gone = b.exits(spark, sf).where("exit_date > date'1998-10-01'").select("entity_id").distinct()
    return listed.join(gone, "entity_id", "left_anti").select("entity_id")


ALARMS = f"""{gq.QUARTERLY}, {gq.LATER}, fa AS (SELECT entity_id FROM qs WHERE model_set_id = 1 AND q = 4 AND entity_id NOT IN (SELECT entity_id FROM ex WHERE exit_date > DATE '1998-10-01')
    AND entity_id IN (SELECT entity_id FROM qs WHERE model_set_id = 1 AND q = 4 ORDER BY score DESC, entity_id % 64, entity_id LIMIT 300)),
  fu AS (SELECT fa.entity_id, {', '.join(f'CAST(coalesce(sum({f}::INT), 0) AS BIGINT) AS {f}' for f in FLAGS)} FROM fa LEFT JOIN (SELECT * FROM fe WHERE event_date > DATE '1998-10-01') fe USING (entity_id) GROUP BY ALL),
  fz AS (SELECT *, {' + '.join(FLAGS)} > 0 AS any_later FROM fu)"""


def follow_up(spark, sf):
    later = gq.later_events(spark, sf).where("event_date > date'1998-10-01'")
    return ex.false_alarm_follow_up(false_alarms(spark, sf), later, FLAGS)


@register("x8_false_alarm_follow_up", f"WITH {ALARMS} SELECT * FROM fz")
def _(spark, sf):
    return follow_up(spark, sf)


@register("x8_follow_up_share", f"WITH {ALARMS} SELECT count(*) FILTER (WHERE any_later) AS with_event, count(*) AS entities, avg(any_later::INT) AS share FROM fz")
def _(spark, sf):
    return ex.follow_up_share(follow_up(spark, sf))


CLASSES = f"WITH x AS (SELECT {sql_classify(DIAGNOSIS, v.DIAGNOSIS_CLASSES, lit('OTHER'))} AS a, {sql_classify(SECOND, v.DIAGNOSIS_CLASSES, lit('OTHER'))} AS b FROM orders)"


def class_pairs(spark, sf):
    rows = t(spark, sf, "orders").select(F.expr(DIAGNOSIS).alias("x"), F.expr(SECOND).alias("y"))
    of = lambda c: tx.classify_text(F.col(c), v.DIAGNOSIS_CLASSES, F.lit("OTHER"))
    return rows.select(of("x").alias("a"), of("y").alias("b"))


@register("x9_class_pairs", f"{CLASSES} SELECT a, b, count(*) AS n, a = b AS same FROM x GROUP BY ALL")
def _(spark, sf):
    return ex.class_agreement(class_pairs(spark, sf), "a", "b")


@register("x9_agreement_share", f"{CLASSES} SELECT avg((a = b)::INT) AS share_same, count(*) AS n FROM x")
def _(spark, sf):
    return ex.agreement_share(class_pairs(spark, sf), "a", "b")


@register(
    "x10_lost_entities",
    f"""WITH {b.CROSSWALK_RUNS} SELECT entity_id, DATE '2001-05-23' AS old_matchdate, CAST(NULL AS DATE) AS new_matchdate FROM cw_all GROUP BY entity_id
    HAVING max(matchdate) = DATE '2001-05-23'""",
)
def _(spark, sf):
    return ex.lost_entities(b.crosswalk_runs(spark, sf), "2001-05-23", "2001-06-26")


@register(
    "x12_exit_counts",
    f"""WITH {b.EXITS} SELECT CAST(year(exit_date) AS INTEGER) AS year, c_mktsegment AS market, count(*) AS n, count(*) FILTER (WHERE cause_a) AS n_cause_a, count(*) FILTER (WHERE cause_b) AS n_cause_b
    FROM ex JOIN customer ON c_custkey = entity_id GROUP BY ALL""",
)
def _(spark, sf):
    market = t(spark, sf, "customer").select(F.col("c_custkey").alias("entity_id"), F.col("c_mktsegment").alias("market"))
    rows = b.exits(spark, sf).join(market, "entity_id")
    return ex.exit_counts(rows, [F.year("exit_date").alias("year"), F.col("market")], ["cause_a", "cause_b"])


# ---- checks ----------------------------------------------------------------------------


@register(
    "c1_checks",
    f"""WITH {b.LABELS}, {etl.ATTRIBUTES}, cc AS (SELECT segment, as_of_date, count(*) AS n, lag(count(*)) OVER (PARTITION BY segment ORDER BY as_of_date) AS p FROM cohort GROUP BY segment, as_of_date),
      lc AS (SELECT as_of_date, count(*) AS n FROM labels_ GROUP BY ALL), c2 AS (SELECT as_of_date, count(*) AS n FROM cohort GROUP BY ALL),
      ages AS (SELECT DISTINCT (DATE '2000-07-01' - TRY_CAST(attribute_value AS DATE)) / 365.25::DOUBLE AS age, attribute_value AS dob FROM attrs WHERE attribute_type = 'dob'),
      r("check", n) AS (
        SELECT 'cohort has every date', CAST(count(*) AS BIGINT) FROM dates_ FULL JOIN c2 USING (as_of_date) WHERE dates_.as_of_date IS NULL OR c2.as_of_date IS NULL
        UNION ALL SELECT 'cohort keys are unique', (SELECT count(*) FROM (SELECT 1 FROM cohort GROUP BY entity_id, as_of_date HAVING count(*) > 1))
        UNION ALL SELECT 'cohort grows', (SELECT count(*) FROM cc WHERE p * 0.8 >= n)
        UNION ALL SELECT 'labels match cohort', (SELECT count(*) FROM lc FULL JOIN c2 USING (as_of_date) WHERE lc.n IS DISTINCT FROM c2.n)
        UNION ALL SELECT 'nobody has exited', (SELECT count(*) FROM cohort c JOIN (SELECT entity_id, min(exit_date) AS d FROM ex GROUP BY ALL) e USING (entity_id) WHERE d <= as_of_date)
        UNION ALL SELECT 'only known status', (SELECT count(*) FROM (SELECT DISTINCT attribute_value FROM attrs WHERE attribute_type = 'status') WHERE attribute_value NOT IN ('F', 'O'))
        UNION ALL SELECT 'nobody is born in the future', (SELECT count(*) FROM attrs WHERE attribute_type = 'dob' AND TRY_CAST(attribute_value AS DATE) > DATE '2001-12-31')
        UNION ALL SELECT 'ages are in range', (SELECT count(*) FROM ages WHERE age BETWEEN 5 AND 90 AND NOT (age BETWEEN 5 AND 90)))
    SELECT "check", n = 0 AS ok, CAST(n AS STRING) AS detail FROM r""",
)
def _(spark, sf):
    people = stored(tp.cohort(spark, sf), "cohort")
    made = co.build_labels(people, b.label_events(spark, sf), b.LABEL_NAMES, b.DATES, b.HORIZON, b.SEGMENTS)
    attrs = etl.attributes(spark, sf)
    status = attrs.where("attribute_type = 'status'").select("attribute_value")
    births = attrs.where("attribute_type = 'dob'").select(F.col("attribute_value").cast("date").alias("dob"))
    age, _ = age_columns(F.col("dob"), F.lit("2000-07-01").cast("date"))
    return ck.all_checks(
        ck.dates_present(people, b.DATES, "cohort has every date"),
        ck.keys_unique(people, ["entity_id", "as_of_date"], "cohort keys are unique"),
        ck.cohort_grows(people, "cohort grows"),
        ck.same_counts(made, people, "labels match cohort"),
        ck.no_exited(people, b.exits(spark, sf), "nobody has exited"),
        ck.only_values(status, "attribute_value", ["F", "O"], "only known status"),
        ck.not_after(births, "dob", "2001-12-31", "nobody is born in the future"),
        ck.in_range(births.select(age.alias("age")), "age", 5, 90, "ages are in range"),
    )


@register(
    "c1_metric_checks",
    f"""WITH {b.PREDICTIONS}, {eq.EVALUATIONS}, {b.CROSSWALK} SELECT 'stored metrics match the curve' AS "check", count(*) = 0 AS ok, CAST(count(*) AS STRING) AS detail FROM (
      SELECT 1 FROM (SELECT model_id, as_of_date, sum(CASE WHEN label AND segment_k <= 75 THEN 1 ELSE 0 END) / 75::DOUBLE AS p FROM pr WHERE segment = 'east' GROUP BY ALL HAVING max(segment_k) >= 75) c
      JOIN evals USING (model_id, as_of_date) WHERE segment = 'east' AND metric = 'precision' AND abs(value - p) > 1e-9)
    UNION ALL SELECT 'ids are in the crosswalk', count(*) = 0, CAST(count(*) AS STRING) FROM (SELECT DISTINCT o_custkey FROM orders WHERE o_custkey IN (SELECT entity_id FROM cw)
      AND o_custkey NOT IN (SELECT TRY_CAST(sourceid AS BIGINT) FROM cw WHERE source = 'CRM.CUSTOMER' AND TRY_CAST(sourceid AS BIGINT) IS NOT NULL))
    UNION ALL SELECT 'every table is covered', false, 'benchmark, conversations' UNION ALL SELECT 'labels span less than the horizon', count(*) = 0, CAST(count(*) AS STRING)
      FROM (SELECT entity_id FROM (SELECT DISTINCT o_custkey AS entity_id, date_trunc('month', o_orderdate) AS m FROM orders WHERE o_totalprice > 490000) GROUP BY entity_id HAVING date_diff('month', min(m), max(m)) >= 6)""",
)
def _(spark, sf):
    preds = eq.stored_predictions(spark, sf)
    kept = ev.evaluation_rows(preds, b.TOTAL_K, b.SEGMENT_KS).where("segment = 'east'").select("model_id", "as_of_date", "metric", "value")
    curve = ev.pr_curve(preds, "east").where("segment_k = 75")
    again = ev.melt_metrics(curve.select("model_id", "as_of_date", "precision", "recall"))
    resolved = t(spark, sf, "orders").select(F.col("o_custkey").alias("sourceid"), F.col("o_custkey").alias("entity_id"))
    resolved = resolved.join(b.crosswalk(spark, sf).select("entity_id").distinct(), "entity_id", "left_semi")
    wanted = ct.column_listing({n: t(spark, sf, n) for n in [*TABLES, "benchmark", "conversations"]})
    costly = t(spark, sf, "orders").where("o_totalprice > 490000").select(
        F.col("o_custkey").alias("entity_id"), F.to_date("o_orderdate").alias("as_of_date"), F.lit(True).alias("label")
    )
    return ck.all_checks(
        ck.metrics_match(kept, again, "stored metrics match the curve"),
        ck.ids_in_crosswalk(resolved, "sourceid", b.crosswalk(spark, sf), "CRM.CUSTOMER", "ids are in the crosswalk"),
        ck.tables_covered({"clean": TABLES[:4], "raw": TABLES[4:]}, wanted, "every table is covered"),
        ck.label_span(costly, 6, "labels span less than the horizon"),
    )


# ---- catalogue -------------------------------------------------------------------------


def table_counts(spark, sf):
    """Rows and non-NULL cells per column of every table, one pass each."""
    out = None
    for name in TABLES:
        df = t(spark, sf, name)
        pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").alias("n")) for c in df.columns])
        part = df.agg(*[F.count(c).alias(c) for c in df.columns]).select(F.lit(name).alias("table_name"), F.inline(pairs))
        out = part if out is None else out.unionByName(part)
    return out


@register(
    "s2_catalogue",
    " UNION ALL ".join(f"SELECT table_name, column_name, (SELECT count(*) FROM {n}) AS n FROM (SELECT '{n}' AS table_name, column_name FROM (DESCRIBE {n}))" for n in TABLES),
)
def _(spark, sf):
    listing = ct.column_listing({n: t(spark, sf, n) for n in TABLES})
    return listing.join(table_counts(spark, sf), ["table_name", "column_name"])


S3_VIEWS = ["orders", "orders_east", "orders_west", "lineitem"]


@register(
    "s3_related_tables",
    """WITH c AS (SELECT (SELECT count(*) FROM orders) AS n)
    SELECT 'orders_east' AS table_name, 'o_custkey,o_orderkey,o_totalprice' AS columns, CAST(3 AS BIGINT) AS shared, n FROM c UNION ALL SELECT 'orders_west', 'o_orderdate,o_orderkey', 2, n FROM c""",
)
def _(spark, sf):
    orders = t(spark, sf, "orders")
    tables = {
        "orders": orders,
        "orders_east": orders.select("o_orderkey", "o_custkey", "o_totalprice"),
        "orders_west": orders.select("o_orderkey", "o_orderdate", F.lit(1).alias("extra")),
        "orders_thin": orders.select("o_orderkey"),
        "lineitem": t(spark, sf, "lineitem"),
    }
    related = ct.related_tables(ct.column_listing(tables), "orders", "orders_")
    rows = orders.agg(F.count(F.lit(1)).alias("n"))
    return related.select("table_name", F.concat_ws(",", "columns").alias("columns"), "shared").withColumn("n", F.lit(rows.first().n).cast("long"))


@register(
    "s3_column_overlap",
    """WITH c AS (SELECT count(l_orderkey) AS n FROM lineitem) SELECT 'l_orderkey' AS column_name, 'lineitem' AS first_table, 'returned' AS second_table, n FROM c""",
)
def _(spark, sf):
    items = t(spark, sf, "lineitem")
    listing = ct.column_listing({"lineitem": items, "returned": items.select("l_orderkey", F.lit(1).alias("flag"))})
    n = items.agg(F.count("l_orderkey").alias("n")).first().n
    return ct.column_overlap(listing, "lineitem", "returned").withColumn("n", F.lit(n).cast("long"))
