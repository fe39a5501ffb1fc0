"""Fairness, label mix and outreach lists."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import evaluation as ev
from tidemark.operators import fairness as fa
from tidemark.operators import label_mix as lm
from tidemark.operators import model_selection as ms
from tidemark.operators import outreach as ou
from tidemark.operators.ranking import rank_predictions
from tidemark.queries import base as b
from tidemark.queries import evaluations as eq
from tidemark.queries.base import register, t
from tidemark.queries.scalars import CALL_FLAGS, CALL_VIEW, FLAGS, flagged_calls

# ---- fairness --------------------------------------------------------------------------

ATTRS = ["flag", "status"]


def order_attributes(spark, sf):
    """Attributes of orders, many per order; some values count as unknown."""
    rows = t(spark, sf, "lineitem")
    pairs = F.array(
        F.struct(F.lit("flag").alias("attribute_type"), F.expr("nullif(l_returnflag, 'R')").alias("attribute_value")),
        F.struct(F.lit("status").alias("attribute_type"), F.expr("nullif(l_linestatus, 'O')").alias("attribute_value")),
    )
    return rows.select(F.col("l_orderkey").alias("entity_id"), F.inline(pairs)).where("attribute_value is not null")


MODAL = """oa AS (SELECT l_orderkey AS entity_id, n.k, CASE n.k WHEN 'flag' THEN nullif(l_returnflag, 'R') ELSE nullif(l_linestatus, 'O') END AS v
    FROM lineitem CROSS JOIN (VALUES ('flag'), ('status')) n(k)),
  top AS (SELECT entity_id, k, v FROM oa WHERE v IS NOT NULL GROUP BY entity_id, k, v QUALIFY row_number() OVER (PARTITION BY entity_id, k ORDER BY count(*) DESC, v) = 1),
  modal AS (SELECT entity_id, coalesce(max(v) FILTER (WHERE k = 'flag'), 'MISSING') AS flag, coalesce(max(v) FILTER (WHERE k = 'status'), 'MISSING') AS status FROM top GROUP BY ALL)"""


def modal(spark, sf):
    return fa.modal_attributes(order_attributes(spark, sf), ATTRS)


@register("a1_modal_attributes", f"WITH {MODAL} SELECT * FROM modal")
def _(spark, sf):
    return modal(spark, sf)


def attributed(spark, sf):
    return fa.join_attributes(b.predictions(spark, sf), modal(spark, sf), ATTRS)


ATTRIBUTED = f"""{b.PREDICTIONS}, {MODAL}, pa AS (SELECT pr.*, coalesce(flag, 'MISSING') AS flag, coalesce(status, 'MISSING') AS status, CAST(label AS INTEGER) AS label_value
    FROM pr LEFT JOIN modal USING (entity_id))"""


@register("a2_scores_with_attributes", f"WITH {ATTRIBUTED} SELECT model_id, entity_id, flag, status, label_value, k FROM pa")
def _(spark, sf):
    return attributed(spark, sf).select("model_id", "entity_id", "flag", "status", "label_value", "k")


@register(
    "a3_enriched_attributes",
    f"""WITH {ATTRIBUTED}, x AS (SELECT l_orderkey AS entity_id, min((l_returnflag, l_linestatus)) AS s FROM lineitem GROUP BY ALL),
      e AS (SELECT pa.entity_id, model_id, CASE WHEN flag = 'MISSING' THEN coalesce(s[1], 'MISSING') ELSE flag END AS flag,
              CASE WHEN status = 'MISSING' THEN coalesce(s[2], 'MISSING') ELSE status END AS status,
              row_number() OVER (PARTITION BY pa.entity_id ORDER BY as_of_date, model_id) AS rn FROM pa LEFT JOIN x USING (entity_id))
    SELECT entity_id, model_id, flag, CASE status WHEN 'F' THEN 'FINAL' WHEN 'O' THEN 'OPEN' ELSE status END AS status FROM e WHERE rn = 1""",
)
def _(spark, sf):
    extra = t(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("entity_id"), F.col("l_returnflag").alias("flag"), F.col("l_linestatus").alias("status")
    )
    out = fa.enrich_attributes(attributed(spark, sf), extra, ATTRS, {"status": {"F": "FINAL", "O": "OPEN"}})
    return out.select("entity_id", "model_id", *ATTRS)


GROUPS = f"""{ATTRIBUTED}, lg AS (SELECT model_id, n.a AS attribute_name, CASE n.a WHEN 'flag' THEN flag WHEN 'status' THEN status ELSE segment END AS attribute_value, label AS y, {eq.IN_TOP} AS p
    FROM pa CROSS JOIN (VALUES ('flag'), ('status'), ('segment')) n(a)),
  c AS (SELECT model_id, attribute_name, attribute_value, count(*) FILTER (WHERE y AND p) AS tp, count(*) FILTER (WHERE NOT y AND p) AS fp,
    count(*) FILTER (WHERE NOT y AND NOT p) AS tn, count(*) FILTER (WHERE y AND NOT p) AS fn, count(*) AS group_size FROM lg GROUP BY ALL),
  gm AS (SELECT *, tp::DOUBLE / nullif(tp + fn, 0) AS tpr, tn::DOUBLE / nullif(tn + fp, 0) AS tnr, fn::DOUBLE / nullif(fn + tn, 0) AS "for", fp::DOUBLE / nullif(tp + fp, 0) AS fdr,
    fp::DOUBLE / nullif(fp + tn, 0) AS fpr, fn::DOUBLE / nullif(fn + tp, 0) AS fnr, tn::DOUBLE / nullif(fn + tn, 0) AS npv, tp::DOUBLE / nullif(tp + fp, 0) AS precision,
    (tp + fp)::DOUBLE / nullif(CAST(sum(tp + fp) OVER (PARTITION BY model_id, attribute_name) AS BIGINT), 0) AS ppr, (tp + fp)::DOUBLE / group_size AS pprev, (tp + fn)::DOUBLE / group_size AS prev FROM c)"""


def group_metrics(spark, sf):
    return fa.group_metrics(attributed(spark, sf), [*ATTRS, "segment"], b.SEGMENT_KS)


@register("a4_group_metrics", f"WITH {GROUPS} SELECT * FROM gm")
def _(spark, sf):
    return group_metrics(spark, sf)


@register("a4_absolute_metrics", f"WITH {GROUPS} SELECT model_id, attribute_name, attribute_value, {', '.join(chr(34) + m + chr(34) for m in fa.METRICS)} FROM gm")
def _(spark, sf):
    return fa.absolute_metrics(group_metrics(spark, sf), ["model_id"])


REFERENCE = {"flag": "A", "status": "F", "segment": "east"}


@register(
    "a5_disparities",
    f"""WITH {GROUPS}, ref AS (SELECT * FROM gm WHERE (attribute_name, attribute_value) IN (('flag', 'A'), ('status', 'F'), ('segment', 'east')))
    SELECT gm.model_id, gm.attribute_name, gm.attribute_value, """
    + ", ".join(f'gm."{m}" / nullif(ref."{m}", 0) AS {m}_disparity' for m in fa.METRICS)
    + " FROM gm LEFT JOIN ref ON ref.model_id = gm.model_id AND ref.attribute_name = gm.attribute_name",
)
def _(spark, sf):
    return fa.disparities(group_metrics(spark, sf), REFERENCE)


# ---- label mix -------------------------------------------------------------------------

IDS = [105, 205, 305]
NAMES = {"STATUS F": "status_f", "URGENT": "urgent", "COSTLY": "costly"}


def with_info(spark, sf):
    info = ms.model_info(*eq.model_tables(spark, sf))
    return lm.predictions_with_info(b.predictions(spark, sf), info, IDS)


INFO = f"""{b.PREDICTIONS}, {eq.MODEL_TABLES}, pi AS (SELECT pr.*, label_group, type FROM pr JOIN models USING (model_id, model_set_id) JOIN sets USING (model_set_id)
    JOIN exps USING (experiment_id) WHERE model_id IN (105, 205, 305))"""


@register("l1_predictions_with_info", f"WITH {INFO} SELECT model_id, entity_id, label_group, type, k FROM pi")
def _(spark, sf):
    return with_info(spark, sf).select("model_id", "entity_id", "label_group", "type", "k")


PIVOT = f"""{eq.ORDER_SPLIT}, pv AS (SELECT entity_id, as_of_date, max(label_name = 'STATUS F') AS status_f, max(label_name = 'URGENT') AS urgent, max(label_name = 'COSTLY') AS costly
    FROM osl WHERE label GROUP BY ALL)"""


@register("l2_split_label_pivot", f"WITH {PIVOT} SELECT * FROM pv")
def _(spark, sf):
    return lm.pivot_split_labels(eq.order_split_labels(spark, sf), NAMES)


def merged(spark, sf):
    return lm.merge_predictions_labels(
        with_info(spark, sf), lm.pivot_split_labels(eq.order_split_labels(spark, sf), NAMES), list(NAMES.values())
    )


MERGED = f"""{INFO}, {PIVOT}, mg AS (SELECT entity_id, as_of_date, model_id, segment, segment_k, label_group, type, coalesce(status_f, false) AS status_f, coalesce(urgent, false) AS urgent,
    coalesce(costly, false) AS costly FROM pi FULL JOIN pv USING (entity_id, as_of_date))"""


@register("l3_merged_labels", f"WITH {MERGED} SELECT entity_id, model_id, status_f, urgent, costly FROM mg")
def _(spark, sf):
    return merged(spark, sf).select("entity_id", "model_id", *NAMES.values())


TOTALS = f"""{MERGED}, tt AS (SELECT as_of_date, model_id, label_group, type, segment, CAST(sum(status_f::INT) AS BIGINT) AS status_f, CAST(sum(urgent::INT) AS BIGINT) AS urgent,
    CAST(sum(costly::INT) AS BIGINT) AS costly FROM mg WHERE {eq.IN_TOP} GROUP BY ALL)"""


def totals(spark, sf):
    return lm.label_totals(lm.top_rows(merged(spark, sf), b.SEGMENT_KS), list(NAMES.values()))


@register("l4_label_totals", f"WITH {TOTALS} SELECT * FROM tt")
def _(spark, sf):
    return totals(spark, sf)


@register(
    "l5_totals_by_model",
    f"""WITH {TOTALS}, u AS (UNPIVOT tt ON status_f, urgent, costly INTO NAME label_column VALUE n)
    SELECT as_of_date, label_column, segment, """
    + ", ".join(f"CAST(sum(n) FILTER (WHERE model_id = {m}) AS BIGINT) AS model_{m}" for m in IDS)
    + " FROM u GROUP BY ALL",
)
def _(spark, sf):
    return lm.totals_by_model(totals(spark, sf), list(NAMES.values()), IDS)


def later_events(spark, sf):
    """Flagged calls and visits plus exits of entities."""
    calls = flagged_calls(spark, sf)
    return lm.flagged_events(
        {"call": calls.where("o_orderkey % 2 = 0"), "visit": calls.where("o_orderkey % 2 = 1")}, FLAGS, b.exits(spark, sf)
    )


LATER = f"""{CALL_VIEW}, {b.EXITS}, cf AS (SELECT o_orderkey, entity_id, event_date, {CALL_FLAGS} FROM calls),
  fe AS (SELECT entity_id, event_date, {', '.join(FLAGS)}, CASE WHEN o_orderkey % 2 = 0 THEN 'call' ELSE 'visit' END AS source, false AS exit_flag FROM cf
    UNION ALL SELECT entity_id, exit_date, {', '.join('false' for _ in FLAGS)}, NULL, true FROM ex)"""


@register("l6_flagged_events", f"WITH {LATER} SELECT * FROM fe")
def _(spark, sf):
    return later_events(spark, sf)


# ---- outreach lists --------------------------------------------------------------------

DAYS = ["1997-10-01", "1998-01-01", "1998-04-01", "1998-07-01", "1998-10-01", "1999-01-01"]
K, LOW, HIGH = 7, "1998-02-01", "1998-11-01"


def quarterly(spark, sf):
    """Two model sets scoring every customer each quarter."""
    days = F.array(*[F.struct(F.lit(d).cast("date").alias("as_of_date"), F.lit(i).alias("q")) for i, d in enumerate(DAYS)])
    sets = F.explode(F.array(F.lit(1), F.lit(2)))
    rows = t(spark, sf, "customer").select("c_custkey", "c_nationkey", F.inline(days)).select("*", sets.alias("model_set_id"))
    score = F.when(F.col("model_set_id") == 1, F.pmod(F.col("c_custkey") * 7919 + F.col("q") * 31, F.lit(1000)) / 1000).otherwise(
        F.pmod(F.col("c_custkey") * 104729, F.lit(997)) / 997
    )
    return rank_predictions(
        rows.select(
            "model_set_id",
            (F.col("model_set_id") * 10 + F.col("q")).alias("model_id"),
            F.col("c_custkey").alias("entity_id"),
            F.when(F.col("c_nationkey") % 2 == 0, "east").otherwise("west").alias("segment"),
            "as_of_date",
            score.alias("score"),
        )
    )


# n = 4 dates from 1998-01-01 to 1998-10-01, 3 months each, 21 entities per date.
QUARTERLY = f"""qs AS (SELECT s.s AS model_set_id, c_custkey AS entity_id, CASE WHEN c_nationkey % 2 = 0 THEN 'east' ELSE 'west' END AS segment, d.d AS as_of_date, d.q AS q,
    CASE s.s WHEN 1 THEN ((c_custkey * 7919 + d.q * 31) % 1000)::DOUBLE / 1000 ELSE ((c_custkey * 104729) % 997)::DOUBLE / 997 END AS score
    FROM customer CROSS JOIN (VALUES {', '.join(f"({i}, DATE '{d}')" for i, d in enumerate(DAYS))}) d(q, d) CROSS JOIN (VALUES (1), (2)) s(s)),
  qr AS (SELECT *, row_number() OVER (PARTITION BY model_set_id, as_of_date, segment ORDER BY score DESC, entity_id % 64, entity_id) AS sk FROM qs),
  """ + ",\n  ".join(
    f"p{i} AS MATERIALIZED (SELECT model_set_id, as_of_date, entity_id, sk FROM qr WHERE q = {i} AND segment = 'east'"
    + "".join(f" AND (model_set_id, entity_id) NOT IN (SELECT (model_set_id, entity_id) FROM p{j})" for j in range(1, i))
    + " QUALIFY row_number() OVER (PARTITION BY model_set_id ORDER BY sk) <= 21)"
    for i in range(1, 5)
) + """,
  lists AS (SELECT model_set_id::BIGINT AS model_set_id, as_of_date, entity_id, row_number() OVER (PARTITION BY model_set_id ORDER BY as_of_date, sk) AS position
    FROM (SELECT * FROM p1 UNION ALL SELECT * FROM p2 UNION ALL SELECT * FROM p3 UNION ALL SELECT * FROM p4))"""


def lists(spark, sf):
    return ou.outreach_lists(quarterly(spark, sf), K, LOW, HIGH, segment="east")


@register("g1_outreach_lists", f"WITH {QUARTERLY} SELECT * FROM lists")
def _(spark, sf):
    return lists(spark, sf)


BLOCKS = f"{QUARTERLY}, bl AS (SELECT *, CAST(floor((position - 1) / 7.0) AS INTEGER) AS month FROM lists)"


@register("g2_monthly_blocks", f"WITH {BLOCKS} SELECT * FROM bl")
def _(spark, sf):
    return ou.monthly_blocks(lists(spark, sf), K)


ALL_FLAGS = [*FLAGS, "exit_flag"]


@register(
    "g3_outcomes",
    f"""WITH {BLOCKS}, {LATER}, li AS (SELECT *, DATE '{LOW}' + INTERVAL (month) MONTH AS f FROM bl QUALIFY count(*) OVER (PARTITION BY model_set_id, month) = 7),
      h AS (SELECT model_set_id, f, fe.* FROM li JOIN fe USING (entity_id)), hl AS (UNPIVOT (SELECT model_set_id, f, event_date, {', '.join(ALL_FLAGS)} FROM h) ON {', '.join(ALL_FLAGS)} INTO NAME event_type VALUE hit)
    SELECT model_set_id, event_type, count(*) FILTER (WHERE hit AND event_date > f) AS all_time,
      count(*) FILTER (WHERE hit AND event_date > f) - count(*) FILTER (WHERE hit AND event_date > DATE '{HIGH}' + INTERVAL 6 MONTH) AS validation_period FROM hl GROUP BY ALL""",
)
def _(spark, sf):
    blocks = ou.monthly_blocks(lists(spark, sf), K)
    return ou.outcomes_after_referral(blocks, later_events(spark, sf), ALL_FLAGS, K, LOW, HIGH)


@register(
    "g3_exit_breakdown",
    f"""WITH {BLOCKS}, {b.EXITS} SELECT model_set_id, CAST(sum(cause_a::INT) AS BIGINT) AS n_a, CAST(sum(cause_b::INT) AS BIGINT) AS n_b, CAST(sum((cause_a OR cause_b)::INT) AS BIGINT) AS any_cause
    FROM ex JOIN bl USING (entity_id) GROUP BY ALL""",
)
def _(spark, sf):
    blocks = ou.monthly_blocks(lists(spark, sf), K)
    return ou.exit_breakdown(blocks, b.exits(spark, sf), K, {"cause_a": "n_a", "cause_b": "n_b"})
