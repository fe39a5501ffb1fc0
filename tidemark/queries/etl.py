"""Identity resolution, table jobs and the long tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import cleaning as c
from tidemark.functions import text as tx
from tidemark.functions import vocab as v
from tidemark.operators import conform as cf
from tidemark.queries import base as b
from tidemark.queries.base import register, t
from tidemark.queries.scalars import CLEAN, DIAGNOSIS, KEY, RACES, SECOND, SEXES, lit, sql_classify, sql_like

CRM = "CRM.CUSTOMER"


@register("e1_latest_snapshot", f"WITH {b.CROSSWALK} SELECT entity_id, source, sourceid, hash_sourceid, matchdate FROM cw")
def _(spark, sf):
    return b.crosswalk(spark, sf)


@register(
    "e2_resolve",
    f"""WITH {b.CROSSWALK} SELECT o_orderkey, cw.entity_id FROM orders
    LEFT JOIN cw ON cw.source = 'CRM.CUSTOMER' AND cw.sourceid = CAST(o_custkey AS STRING)""",
)
def _(spark, sf):
    return cf.resolve(t(spark, sf, "orders"), "o_custkey", b.crosswalk(spark, sf), CRM).select("o_orderkey", "entity_id")


@register(
    "e2_resolve_by_hash",
    f"""WITH {b.CROSSWALK}, c AS (SELECT c_custkey, md5(c_name) AS h FROM customer)
    SELECT c_custkey, cw.entity_id FROM c LEFT JOIN cw ON cw.source = 'SHOP.NAME' AND cw.hash_sourceid = h""",
)
def _(spark, sf):
    rows = t(spark, sf, "customer").select("c_custkey", F.md5(F.col("c_name").cast("binary")).alias("h"))
    return cf.resolve(rows, "h", b.crosswalk(spark, sf), "SHOP.NAME", "hash_sourceid").select("c_custkey", "entity_id")


@register(
    "e3_resolve_inner",
    f"""WITH {b.CROSSWALK} SELECT o_orderkey, cw.entity_id FROM orders
    JOIN cw ON cw.source = 'CRM.CUSTOMER' AND cw.sourceid = CAST(o_custkey AS STRING)""",
)
def _(spark, sf):
    return cf.resolve(t(spark, sf, "orders"), "o_custkey", b.crosswalk(spark, sf), CRM, keep_unmatched=False).select("o_orderkey", "entity_id")


@register(
    "e4_two_hop",
    f"""WITH {b.CROSSWALK} SELECT l_orderkey, l_linenumber, cw.entity_id FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey
    LEFT JOIN cw ON cw.source = 'CRM.CUSTOMER' AND cw.sourceid = CAST(o_custkey AS STRING)""",
)
def _(spark, sf):
    out = cf.resolve_via(t(spark, sf, "lineitem"), t(spark, sf, "orders"), ("l_orderkey", "o_orderkey"), "o_custkey", b.crosswalk(spark, sf), CRM)
    return out.select("l_orderkey", "l_linenumber", "entity_id")


@register(
    "e5_event_date",
    f"""WITH x AS (SELECT {KEY}, CASE {KEY} % 3 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END AS first_, '1999-01-02' AS second_ FROM orders)
    SELECT {KEY}, CAST(coalesce(nullif(first_, ''), nullif(second_, '')) AS DATE) AS event_date FROM x""",
)
def _(spark, sf):
    first = F.expr(f"CASE {KEY} % 3 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE cast(cast(o_orderdate AS date) AS string) END")
    return t(spark, sf, "orders").select(KEY, c.choose_date(first, F.lit("1999-01-02")).cast("date").alias("event_date"))


@register(
    "e6_detect_columns",
    f"""WITH {b.CROSSWALK}, x AS (SELECT {KEY}, o_custkey AS patid, {RACES} AS race_code, {SEXES} AS sex,
        CASE WHEN {KEY} % 4 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS call_date, CAST(o_orderdate AS DATE) + 3 AS svc_date FROM orders),
      y AS (SELECT *, {CLEAN('sex')} AS s, {CLEAN('race_code')} AS r FROM x)
    SELECT {KEY}, cw.entity_id, CASE WHEN s LIKE 'M%' THEN 'MALE' WHEN s LIKE 'F%' THEN 'FEMALE' END AS sex,
      CASE WHEN r LIKE 'AM%' OR r = 'I' THEN 'I' WHEN r LIKE 'AS%' OR r = 'A' THEN 'A' WHEN r LIKE 'B%' THEN 'B'
           WHEN r LIKE 'C%' OR r LIKE 'W%' THEN 'W' WHEN r LIKE 'HI%' THEN 'H' WHEN r LIKE 'O%' THEN 'O'
           WHEN r LIKE 'NAT%' OR r LIKE 'HA%' OR r = 'P' THEN 'P' END AS race, coalesce(call_date, svc_date) AS event_date
    FROM y LEFT JOIN cw ON cw.source = 'CRM.CUSTOMER' AND cw.sourceid = CAST(patid AS STRING)""",
)
def _(spark, sf):
    raw = t(spark, sf, "orders").select(
        KEY,
        F.col("o_custkey").alias("patid"),
        F.expr(RACES).alias("race_code"),
        F.expr(SEXES).alias("sex"),
        F.when(F.col(KEY) % 4 != 0, F.to_date("o_orderdate")).alias("call_date"),
        F.date_add(F.to_date("o_orderdate"), 3).alias("svc_date"),
    )
    out = cf.semi_clean(raw, cf.Identity("patid", CRM), b.crosswalk(spark, sf))
    return out.select(KEY, "entity_id", "sex", "race", "event_date")


@register("e7_distinct_rows", "SELECT DISTINCT l_orderkey, l_returnflag, l_linestatus FROM lineitem")
def _(spark, sf):
    columns = {n: F.col(n) for n in ("l_orderkey", "l_returnflag", "l_linestatus")}
    return cf.standardise(t(spark, sf, "lineitem"), cf.TableJob("flags", columns, distinct=True))


@register(
    "e8_consensus",
    """WITH x AS (SELECT l_orderkey AS entity_id, l_returnflag AS flag, nullif(l_linestatus, 'F') AS status, l_quantity > 25 AS big FROM lineitem)
    SELECT entity_id, CASE WHEN count(DISTINCT flag) = 1 AND count(flag) = count(*) THEN min(flag) END AS flag,
      CASE WHEN count(DISTINCT status) = 1 AND count(status) = count(*) THEN min(status) END AS status, CAST(max(CAST(big AS INTEGER)) AS INTEGER) AS big
    FROM x GROUP BY entity_id""",
)
def _(spark, sf):
    rows = t(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("entity_id"),
        F.col("l_returnflag").alias("flag"),
        F.expr("nullif(l_linestatus, 'F')").alias("status"),
        (F.col("l_quantity") > 25).alias("big"),
    )
    return cf.consensus(rows, ["flag", "status"], ["big"])


@register("e9_entity_events", f"WITH {b.EVENTS} SELECT entity_id, event_date, event_type, source FROM ev")
def _(spark, sf):
    return b.entity_events(spark, sf)


def attribute_rows(spark, sf):
    return t(spark, sf, "orders").select(
        F.col("o_custkey").alias("entity_id"),
        F.to_date("o_orderdate").alias("event_date"),
        F.col("o_orderpriority").alias("priority"),
        F.expr("nullif(o_orderstatus, 'P')").alias("status"),
        F.date_sub(F.lit("1990-06-30").cast("date"), F.pmod(F.col("o_custkey") * 37, F.lit(35000)).cast("int")).cast("string").alias("dob"),
    )


def attributes(spark, sf):
    return cf.conform_attributes(attribute_rows(spark, sf), "orders", {"priority": "priority", "status": "status", "dob": "dob"})


ATTRIBUTES = """attrs AS (
  SELECT DISTINCT o_custkey AS entity_id, CAST(o_orderdate AS DATE) AS event_date, 'orders' AS source, p.k AS attribute_type,
         CASE p.k WHEN 'priority' THEN o_orderpriority WHEN 'status' THEN nullif(o_orderstatus, 'P')
                  ELSE CAST(DATE '1990-06-30' - CAST((o_custkey * 37) % 35000 AS INTEGER) AS STRING) END AS attribute_value
  FROM orders CROSS JOIN (VALUES ('priority'), ('status'), ('dob')) p(k)
  WHERE CASE WHEN p.k = 'status' THEN nullif(o_orderstatus, 'P') ELSE 'x' END IS NOT NULL)"""


@register("e10_attributes", f"WITH {ATTRIBUTES} SELECT * FROM attrs")
def _(spark, sf):
    return attributes(spark, sf)


@register("e11_attributes_undated", f"WITH {ATTRIBUTES} SELECT DISTINCT entity_id, source, attribute_type, attribute_value FROM attrs")
def _(spark, sf):
    return cf.conform_attributes(attribute_rows(spark, sf), "orders", {"priority": "priority", "status": "status", "dob": "dob"}, event_date=None)


@register(
    "e12_union_sources",
    """SELECT o_custkey AS entity_id, o_orderpriority AS what, 'orders' AS source FROM orders
    UNION SELECT o_custkey, l_returnflag, 'items' FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
def _(spark, sf):
    orders = t(spark, sf, "orders").select(F.col("o_custkey").alias("entity_id"), F.col("o_orderpriority").alias("what"))
    items = b.owned_items(spark, sf).select(F.col("o_custkey").alias("entity_id"), F.col("l_returnflag").alias("what"))
    return cf.union_distinct({"orders": orders, "items": items})


@register(
    "e13_union_padded",
    """SELECT o_custkey AS entity_id, CAST(o_orderdate AS DATE) AS event_date, o_orderpriority AS priority, NULL AS flag, 'orders' AS source FROM orders
    UNION SELECT o_custkey, CAST(l_shipdate AS DATE), NULL, l_returnflag, 'items' FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
def _(spark, sf):
    orders = t(spark, sf, "orders").select(
        F.col("o_custkey").alias("entity_id"), F.to_date("o_orderdate").alias("event_date"), F.col("o_orderpriority").alias("priority")
    )
    items = b.owned_items(spark, sf).select(
        F.col("o_custkey").alias("entity_id"), F.to_date("l_shipdate").alias("event_date"), F.col("l_returnflag").alias("flag")
    )
    return cf.union_distinct({"orders": orders, "items": items})


def episode_parts(spark, sf):
    items = b.owned_items(spark, sf).where("l_shipdate >= o_orderdate")
    episode = items.select(
        F.col("o_custkey").alias("entity_id"), F.to_date("o_orderdate").alias("start_date"), F.to_date("l_shipdate").alias("end_date"), "l_returnflag", "l_quantity"
    )
    return {"flagged": episode.where("l_returnflag = 'R'"), "large": episode.where("l_quantity > 10"), "all": episode}


EPISODES = """ep_all AS (
  SELECT o_custkey AS entity_id, CAST(o_orderdate AS DATE) AS start_date, CAST(l_shipdate AS DATE) AS end_date, l_returnflag, l_quantity
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_shipdate >= o_orderdate
), ep AS (
  SELECT entity_id, start_date, end_date, min(source) AS source FROM (
    SELECT entity_id, start_date, end_date, 'flagged' AS source FROM ep_all WHERE l_returnflag = 'R'
    UNION SELECT entity_id, start_date, end_date, 'large' FROM ep_all WHERE l_quantity > 10
    UNION SELECT entity_id, start_date, end_date, 'all' FROM ep_all) u GROUP BY entity_id, start_date, end_date)"""


@register("e14_episodes", f"WITH {EPISODES} SELECT * FROM ep")
def _(spark, sf):
    return cf.conform_episodes(episode_parts(spark, sf))


@register(
    "e15_member_flag",
    """SELECT l_orderkey, l_linenumber, l_partkey IN (SELECT p_partkey FROM part WHERE p_brand = 'Brand#7')
       OR l_suppkey IN (SELECT p_partkey FROM part WHERE p_brand = 'Brand#7') AS listed FROM lineitem""",
)
def _(spark, sf):
    listed = t(spark, sf, "part").where("p_brand = 'Brand#7'")
    return cf.member_flag(t(spark, sf, "lineitem"), ["l_partkey", "l_suppkey"], listed, "p_partkey", "listed").select("l_orderkey", "l_linenumber", "listed")


@register("e16_trial_limit", "SELECT least(5, count(*)) AS n_rows, 5 AS wanted FROM orders")
def _(spark, sf):
    job = cf.TableJob("trial", {"o_orderkey": F.col("o_orderkey")})
    few = cf.standardise(t(spark, sf, "orders"), job, limit=5)
    return few.agg(F.count(F.lit(1)).alias("n_rows"), F.lit(5).alias("wanted"))


@register(
    "e17_undated",
    """SELECT 'events' AS what, count(*) AS n FROM orders WHERE o_orderdate IS NULL
    UNION ALL SELECT 'attributes', count(DISTINCT (o_custkey, o_orderpriority)) FROM orders""",
)
def _(spark, sf):
    rows = cf.undated(attribute_rows(spark, sf))
    events = cf.conform_events({"audit": rows}, [cf.EventSpec("audit", "AUDIT", "event_date")])
    kept = cf.conform_attributes(rows, "audit", {"priority": "priority"}, event_date=None)
    return events.agg(F.lit("events").alias("what"), F.count(F.lit(1)).alias("n")).unionByName(
        kept.agg(F.lit("attributes").alias("what"), F.count(F.lit(1)).alias("n"))
    )


@register(
    "e18_exit_tables",
    f"""WITH {b.CROSSWALK}, a AS (
      SELECT o_orderkey, cw.entity_id, DATE '1950-01-01' + CAST(o_orderkey % 9000 AS INTEGER) AS birth_date, CAST(o_orderdate AS DATE) AS exit_date, {DIAGNOSIS} AS mechanism, {SECOND} AS manner
      FROM orders LEFT JOIN cw ON cw.source = 'CRM.CUSTOMER' AND cw.sourceid = CAST(o_custkey AS STRING))
    SELECT entity_id, birth_date, exit_date, CAST(CASE WHEN o_orderkey % 2 = 0 THEN year(exit_date) - year(birth_date) ELSE o_orderkey % 90 END AS INTEGER) AS age,
      CASE WHEN o_orderkey % 2 = 0 THEN {sql_like({'mechanism': ['%overdose%', '%amphet%']})} ELSE {sql_like({'mechanism': v.OVERDOSE_CAUSE, 'manner': v.OVERDOSE_CAUSE})} END AS cause_a,
      {sql_like({'manner': v.SUICIDE_MANNER})} AS cause_b, CASE WHEN o_orderkey % 2 = 0 THEN 'east' ELSE 'west' END AS segment FROM a""",
)
def _(spark, sf):
    rows = cf.resolve(t(spark, sf, "orders"), "o_custkey", b.crosswalk(spark, sf), CRM).select(
        "o_orderkey",
        "entity_id",
        F.date_add(F.lit("1950-01-01").cast("date"), (F.col("o_orderkey") % 9000).cast("int")).alias("birth_date"),
        F.to_date("o_orderdate").alias("exit_date"),
        F.expr(DIAGNOSIS).alias("mechanism"),
        F.expr(SECOND).alias("manner"),
        F.concat((F.col("o_orderkey") % 90).cast("string"), F.lit(" Years")).alias("age_text"),
    )
    common = {"birth_date": F.col("birth_date"), "exit_date": F.col("exit_date")}
    by_manner = tx.keyword_flag({"manner": v.SUICIDE_MANNER})
    east = {
        **common,
        "age": c.year_difference(F.col("exit_date"), F.col("birth_date")),
        "cause_a": tx.keyword_flag({"mechanism": ["%overdose%", "%amphet%"]}),
        "cause_b": by_manner,
    }
    west = {
        **common,
        "age": c.age_from_text(F.col("age_text")),
        "cause_a": tx.keyword_flag({"mechanism": v.OVERDOSE_CAUSE, "manner": v.OVERDOSE_CAUSE}),
        "cause_b": by_manner,
    }
    even = F.col("o_orderkey") % 2 == 0
    return cf.conform_exits({"east": (rows.where(even), east), "west": (rows.where(~even), west)})


@register(
    "e19_table_job",
    f"""WITH {b.CROSSWALK}, x AS (
      SELECT DISTINCT cw.entity_id, CAST(l_shipdate AS DATE) AS service_date, upper(trim(concat(' ', lower(l_returnflag), '-', l_linestatus))) AS service, CAST(l_suppkey AS STRING) AS provider
      FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN cw ON cw.source = 'CRM.CUSTOMER' AND cw.sourceid = CAST(o_custkey AS STRING))
    SELECT * FROM x""",
)
def _(spark, sf):
    job = cf.TableJob(
        "services",
        {
            "service_date": F.to_date("l_shipdate"),
            "service": c.clean_text(F.concat(F.lit(" "), F.lower("l_returnflag"), F.lit("-"), F.col("l_linestatus"))),
            "provider": F.col("l_suppkey").cast("string"),
        },
        cf.Identity("o_custkey", CRM, parent=t(spark, sf, "orders"), link=("l_orderkey", "o_orderkey")),
        distinct=True,
    )
    return cf.standardise(t(spark, sf, "lineitem"), job, b.crosswalk(spark, sf))


@register(
    "e19_diagnosis_job",
    f"""WITH {b.CROSSWALK}, x AS (SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS dx_date, {CLEAN(DIAGNOSIS)} AS description FROM orders),
      y AS (SELECT *, {sql_classify('description', v.DIAGNOSIS_CLASSES, lit('OTHER'))} AS class FROM x)
    SELECT o_orderkey, cw.entity_id, dx_date, description, class, class = 'SUBSTANCE-RELATED OR ADDICTIVE' AS substance_flag,
      class = 'SUICIDE IDEATION OR SELF-HARM' AS self_harm_flag
    FROM y LEFT JOIN cw ON cw.source = 'CRM.CUSTOMER' AND cw.sourceid = CAST(o_custkey AS STRING)""",
)
def _(spark, sf):
    job = cf.TableJob(
        "diagnoses",
        {"o_orderkey": F.col("o_orderkey"), "dx_date": F.to_date("o_orderdate"), "description": c.clean_text(F.expr(DIAGNOSIS))},
        cf.Identity("o_custkey", CRM),
    )
    out = cf.standardise(t(spark, sf, "orders"), job, b.crosswalk(spark, sf))
    out = out.withColumn("class", tx.classify_text(F.col("description"), v.DIAGNOSIS_CLASSES, F.lit("OTHER")))
    return out.withColumn("substance_flag", F.col("class") == "SUBSTANCE-RELATED OR ADDICTIVE").withColumn(
        "self_harm_flag", F.col("class") == "SUICIDE IDEATION OR SELF-HARM"
    )
