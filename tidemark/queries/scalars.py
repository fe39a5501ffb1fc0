"""Cleaning expressions, run over whole tables on values made dirty from their columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import cleaning as c
from tidemark.functions import flags as fl
from tidemark.functions import text as tx
from tidemark.functions import vocab as v
from tidemark.queries.base import register, t
from tidemark.session import spread

KEY = "o_orderkey"
REF = "2001-12-31"


def orders_with(spark, sf, **exprs):
    """Orders' key and text columns made by SQL that both engines read alike."""
    return t(spark, sf, "orders").select(KEY, *[F.expr(e).alias(n) for n, e in exprs.items()])


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def pick(words: list[str | None], key: str = KEY) -> str:
    """CASE that gives one of the words by the key; the same text in both engines."""
    arms = " ".join(f"WHEN {i} THEN {'NULL' if w is None else lit(w)}" for i, w in enumerate(words))
    return f"CASE {key} % {len(words)} {arms} END"


def sql_class(x: str, r: tx.TextClass) -> str:
    m = lambda ps, joint: "(" + joint.join(f"regexp_matches({x}, {lit(p)})" for p in ps) + ")"
    tests = []
    if r.any_of:
        main = [m(r.any_of, " OR ")]
        if r.also:
            main.append(m(r.also, " OR "))
        if r.none_of:
            main.append("NOT " + m(r.none_of, " OR "))
        if r.unless_all:
            main.append("NOT " + m(r.unless_all, " AND "))
        tests.append("(" + " AND ".join(main) + ")")
    if r.or_any:
        tests.append(m(r.or_any, " OR "))
    return " OR ".join(tests)


def sql_classify(x: str, rules: list[tx.TextClass], default: str) -> str:
    return "CASE " + " ".join(f"WHEN {sql_class(x, r)} THEN {lit(r.label)}" for r in rules) + f" ELSE {default} END"


def sql_fuzzy(x: str, rules: list[tx.FuzzyName], nulls: list[str]) -> str:
    arms = []
    words = lambda ws: "(" + ", ".join(lit(w) for w in ws) + ")"
    for r in rules:
        tests = []
        if r.near:
            near = "(" + " OR ".join(f"levenshtein({x}, {lit(w)}) <= {n}" for w, n in r.near) + ")"
            if r.not_words:
                near += f" AND {x} NOT IN {words(r.not_words)}"
            near += "".join(f" AND NOT regexp_matches({x}, {lit(p)})" for p in r.not_like)
            tests.append(f"({near})")
        if r.words:
            tests.append(f"{x} IN {words(r.words)}")
        tests += [f"regexp_matches({x}, {lit(p)})" for p in r.like]
        arms.append(f"WHEN {' OR '.join(tests)} THEN {lit(r.name)}")
    return f"CASE {' '.join(arms)} WHEN {x} IN {words(nulls)} THEN NULL ELSE {x} END"


def sql_like(any_of: dict[str, list[str]], none_of: dict[str, list[str]] | None = None) -> str:
    test = "(" + " OR ".join(f"{col} ILIKE {lit(p)}" for col, ps in any_of.items() for p in ps) + ")"
    test += "".join(f" AND {col} NOT ILIKE {lit(p)}" for col, ps in (none_of or {}).items() for p in ps)
    return f"coalesce({test}, false)"


CLEAN = lambda x: f"nullif(upper(regexp_replace(trim({x}), chr(127), '')), '')"

# ---- text and numbers ------------------------------------------------------------------

DIRTY = (
    f"CASE {KEY} % 5 WHEN 0 THEN concat('  ', lower(o_orderpriority), chr(127), ' a', chr(127), ' ') WHEN 1 THEN '   ' "
    "WHEN 2 THEN NULL WHEN 3 THEN chr(127) ELSE o_orderpriority END"
)


@register("f1_clean_text", f"WITH x AS (SELECT {KEY}, {DIRTY} AS raw FROM orders) SELECT {KEY}, {CLEAN('raw')} AS clean FROM x")
def _(spark, sf):
    return orders_with(spark, sf, raw=DIRTY).select(KEY, c.clean_text(F.col("raw")).alias("clean"))


NUMBERS = (
    f"CASE {KEY} % 8 WHEN 0 THEN concat(' ', cast({KEY} AS string), ' ') WHEN 1 THEN '1.5' WHEN 2 THEN '12.' WHEN 3 THEN 'A1' "
    f"WHEN 4 THEN NULL WHEN 5 THEN '' WHEN 6 THEN concat('$', cast({KEY} AS string), '.25 USD') ELSE cast({KEY} % 211 AS string) END"
)
IS_NUM = f"coalesce(regexp_matches({CLEAN('raw')}, '^[0-9]+[.]?[0-9]*$'), false)"
AS_INT = f"CASE WHEN {IS_NUM} AND NOT contains(raw, '.') THEN CAST(trim(raw) AS INTEGER) END"


@register(
    "f2_f4_numbers",
    f"""WITH x AS (SELECT {KEY}, {NUMBERS} AS raw FROM orders)
    SELECT {KEY}, {IS_NUM} AS numeric_, {AS_INT} AS int_, CAST(nullif(regexp_replace(raw, '[^0-9.]', '', 'g'), '') AS DOUBLE) AS float_,
           TRY_CAST(nullif(raw, '') AS FLOAT) AS real_ FROM x""",
)
def _(spark, sf):
    x = F.col("raw")
    return orders_with(spark, sf, raw=NUMBERS).select(
        KEY, c.is_numeric(x).alias("numeric_"), c.to_int(x).alias("int_"), c.to_float(x).alias("float_"), c.to_real(x).alias("real_")
    )


@register(
    "f13_age",
    f"WITH x AS (SELECT {KEY}, {NUMBERS} AS raw FROM orders) SELECT {KEY}, CASE WHEN {AS_INT} < 150 THEN {AS_INT} END AS age FROM x",
)
def _(spark, sf):
    return orders_with(spark, sf, raw=NUMBERS).select(KEY, c.fix_age(F.col("raw")).alias("age"))


# ---- dates and times -------------------------------------------------------------------

_P = lambda part, n=2: f"lpad(cast({part}(o_orderdate) AS string), {n}, '0')"
DATE_TEXT = (
    f"CASE {KEY} % 9 WHEN 0 THEN concat({_P('month')}, '/', {_P('day')}, '/', {_P('year', 4)}) "
    f"WHEN 1 THEN concat({_P('year', 4)}, '-', {_P('month')}, '-', {_P('day')}) WHEN 2 THEN '02/34/2017' "
    f"WHEN 3 THEN concat({_P('month')}, '/', {_P('day')}, '/', right({_P('year', 4)}, 2)) WHEN 4 THEN 'unknown' WHEN 5 THEN NULL "
    f"WHEN 6 THEN concat({_P('month')}, '/', {_P('day')}, '/1890') WHEN 7 THEN concat({_P('month')}, '/', {_P('day')}, '/2090') "
    f"ELSE concat({_P('month')}, '/', {_P('day')}, '/ý') END"
)
TRY = lambda x, *fs: f"CAST(try_strptime({x}, [{', '.join(lit(f) for f in fs)}]) AS DATE)"
DIGITS = "regexp_replace(raw, '[^0-9]', '', 'g')"


@register(
    "f5_dates",
    f"""WITH x AS (SELECT {KEY}, {DATE_TEXT} AS raw FROM orders)
    SELECT {KEY}, {TRY('raw', '%Y-%m-%d', '%m/%d/%Y', '%m/%d/%y')} IS NOT NULL AS is_date,
           CASE WHEN length({DIGITS}) = 8 THEN {TRY('raw', '%m/%d/%Y', '%Y-%m-%d')} END AS parsed FROM x""",
)
def _(spark, sf):
    x = F.col("raw")
    return orders_with(spark, sf, raw=DATE_TEXT).select(KEY, c.is_date(x).alias("is_date"), c.parse_date_two_ways(x).alias("parsed"))


@register(
    "f6_fix_date",
    f"""WITH x AS (SELECT {KEY}, {DATE_TEXT} AS raw FROM orders), y AS (
      SELECT *, {TRY('raw', '%m/%d/%y')} AS two, CASE WHEN length({DIGITS}) = 8 THEN {TRY('raw', '%m/%d/%Y', '%Y-%m-%d')} END AS four, length({DIGITS}) AS n FROM x)
    SELECT {KEY}, CAST(CASE WHEN contains(raw, 'ý') THEN NULL
             WHEN n = 6 THEN CASE WHEN year(two) > 2001 THEN two - INTERVAL 100 YEAR ELSE two END
             WHEN n = 8 AND year(four) >= 1901 AND four <= DATE '{REF}' THEN four END AS DATE) AS fixed FROM y""",
)
def _(spark, sf):
    return orders_with(spark, sf, raw=DATE_TEXT).select(KEY, c.fix_date(F.col("raw"), REF).alias("fixed"))


@register(
    "f7_fix_and_check_date",
    f"""WITH x AS (SELECT {KEY}, {DATE_TEXT} AS raw FROM orders)
    SELECT {KEY}, CASE WHEN contains(raw, 'ý') THEN NULL
        WHEN {TRY('raw', '%Y-%m-%d', '%m/%d/%Y', '%m/%d/%y')} IS NULL THEN NULL
        WHEN length({DIGITS}) = 8 THEN {TRY(DIGITS, '%m%d%Y')} WHEN length({DIGITS}) = 6 THEN {TRY(DIGITS, '%m%d%y')} END AS fixed FROM x""",
)
def _(spark, sf):
    return orders_with(spark, sf, raw=DATE_TEXT).select(KEY, c.fix_and_check_date(F.col("raw")).alias("fixed"))


@register(
    "f8_f26_date_parts",
    """SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS ship_day, CAST(year(l_shipdate) AS INTEGER) AS y, CAST(month(l_shipdate) AS INTEGER) AS m,
       CAST(year(l_shipdate) - year(o_orderdate) AS INTEGER) AS years_apart, CAST(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS INTEGER) AS days_apart
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
def _(spark, sf):
    from tidemark.queries.base import owned_items

    ship, order = F.col("l_shipdate"), F.col("o_orderdate")
    return owned_items(spark, sf).select(
        "l_orderkey",
        "l_linenumber",
        c.time_to_date(ship).alias("ship_day"),
        F.year(ship).alias("y"),
        F.month(ship).alias("m"),
        c.year_difference(ship, order).alias("years_apart"),
        F.datediff(F.to_date(ship), F.to_date(order)).alias("days_apart"),
    )


TIMES = (
    f"CASE {KEY} % 6 WHEN 0 THEN concat(lpad(cast({KEY} % 24 AS string), 2, '0'), ':', lpad(cast({KEY} % 60 AS string), 2, '0')) "
    f"WHEN 1 THEN concat(lpad(cast({KEY} % 24 AS string), 2, '0'), ':', lpad(cast({KEY} % 60 AS string), 2, '0'), ':09') "
    f"WHEN 2 THEN '12' WHEN 3 THEN NULL WHEN 4 THEN '9975' ELSE concat('x2001', lpad(cast({KEY} % 24 AS string), 2, '0'), '3015') END"
)


@register(
    "f14_time",
    f"""WITH x AS (SELECT {KEY}, {TIMES} AS raw FROM orders), y AS (SELECT *, right({DIGITS}, 6) AS tail FROM x)
    SELECT {KEY}, CASE WHEN length(tail) IN (4, 6) THEN strftime(try_strptime(left(tail, 4), '%H%M'), '%H:%M') END AS at FROM y""",
)
def _(spark, sf):
    return orders_with(spark, sf, raw=TIMES).select(KEY, c.fix_time(F.col("raw")).alias("at"))


INTRO = f"concat('ON  ', {_P('month')}, '/', {_P('day')}, '/', {_P('year', 4)}, ' ', lpad(cast(1 + {KEY} % 12 AS string), 2, '0'), ':', lpad(cast({KEY} % 60 AS string), 2, '0'), CASE WHEN {KEY} % 2 = 0 THEN ' AM' ELSE ' PM' END, ' visit')"


@register(
    "f22_substring_date",
    f"""WITH x AS (SELECT {KEY}, {INTRO} AS intro FROM orders)
    SELECT {KEY}, CAST(strptime(substring(intro, 5, 10), '%m/%d/%Y') AS DATE) AS day_,
           strftime(strptime(substring(intro, 5, 19), '%m/%d/%Y %I:%M %p'), '%Y-%m-%d %H:%M') AS at FROM x""",
)
def _(spark, sf):
    x = F.col("intro")
    return orders_with(spark, sf, intro=INTRO).select(
        KEY, c.substring_date(x, 5, 10).alias("day_"), F.date_format(c.substring_timestamp(x, 5, 19), "yyyy-MM-dd HH:mm").alias("at")
    )


@register(
    "f23_f24_repairs",
    """SELECT l_orderkey, l_linenumber,
        CASE WHEN l_returnflag <> 'N' THEN CAST(l_shipdate AS DATE) WHEN l_linestatus = 'F' THEN CAST(o_orderdate AS DATE) END AS first_known,
        CASE WHEN l_linestatus = 'F' THEN CAST(o_orderdate AS DATE) WHEN l_returnflag <> 'N' THEN CAST(l_shipdate AS DATE) END AS last_known,
        CAST(greatest(o_orderdate, l_shipdate) AS DATE) AS end_day, nullif(l_tax, 0) AS tax,
        CASE WHEN CAST(l_shipdate AS DATE) = DATE '1998-01-01' THEN NULL ELSE CAST(l_shipdate AS DATE) END AS repaired
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
def _(spark, sf):
    from datetime import date

    from tidemark.queries.base import owned_items

    ship, order = F.to_date("l_shipdate"), F.to_date("o_orderdate")
    a, b = F.when(F.col("l_returnflag") != "N", ship), F.when(F.col("l_linestatus") == "F", order)
    return owned_items(spark, sf).select(
        "l_orderkey",
        "l_linenumber",
        c.first_known(a, b).alias("first_known"),
        c.first_known(b, a).alias("last_known"),
        c.end_not_before(order, ship).alias("end_day"),
        c.zero_to_null(F.col("l_tax")).alias("tax"),
        c.replace_value(ship, date(1998, 1, 1)).alias("repaired"),
    )


# ---- codes -----------------------------------------------------------------------------

ANSWERS = pick(["y", " Yes ", "N", "no", "maybe", None, "", "YES\x7f"])


@register(
    "f9_yes_no",
    f"""WITH x AS (SELECT {KEY}, {ANSWERS} AS raw FROM orders), y AS (SELECT *, {CLEAN('raw')} AS cl FROM x)
    SELECT {KEY}, CASE WHEN cl IN ('Y', 'YES') THEN true WHEN cl IN ('N', 'NO') THEN false END AS words,
      CASE cl WHEN 'Y' THEN true WHEN 'N' THEN false END AS letter, CAST(CASE cl WHEN 'Y' THEN 1 WHEN 'N' THEN 0 END AS INTEGER) AS number FROM y""",
)
def _(spark, sf):
    x = F.col("raw")
    return orders_with(spark, sf, raw=ANSWERS).select(
        KEY, c.yes_no_words(x).alias("words"), c.yes_no(x).alias("letter"), c.yes_no_int(x).alias("number")
    )


SEXES = pick(["m", "Male", "FEMALE", " f", "X", None, ""])
RACES = pick(["am. indian", "I", "asian", "A", "black", "caucasian", "white", "hispanic", "other", "native hawaiian", "hawaiian", "P", "unknown", "?", None, "HX"])


@register(
    "f10_f11_codes",
    f"""WITH x AS (SELECT {KEY}, {SEXES} AS s, {RACES} AS r FROM orders), y AS (SELECT {KEY}, {CLEAN('s')} AS s, {CLEAN('r')} AS r FROM x)
    SELECT {KEY}, CASE WHEN s LIKE 'M%' THEN 'MALE' WHEN s LIKE 'F%' THEN 'FEMALE' END AS sex,
      CASE WHEN r LIKE 'AM%' OR r = 'I' THEN 'I' WHEN r LIKE 'AS%' OR r = 'A' THEN 'A' WHEN r LIKE 'B%' THEN 'B'
           WHEN r LIKE 'C%' OR r LIKE 'W%' THEN 'W' WHEN r LIKE 'HI%' THEN 'H' WHEN r LIKE 'O%' THEN 'O'
           WHEN r LIKE 'NAT%' OR r LIKE 'HA%' OR r = 'P' THEN 'P' END AS race FROM y""",
)
def _(spark, sf):
    return orders_with(spark, sf, s=SEXES, r=RACES).select(KEY, c.fix_sex(F.col("s")).alias("sex"), c.fix_race(F.col("r")).alias("race"))


ZIPS = pick(["66061", "00000", "99999", "66061-1234", "zip", None, ""])


@register(
    "f12_f27_zips",
    f"""WITH x AS (SELECT {KEY}, {ZIPS} AS raw, {pick(['66061', '66062', None])} AS other FROM orders)
    SELECT {KEY}, CASE WHEN raw IN ('00000', '99999') THEN NULL ELSE raw END AS zip, nullif({DIGITS}, '') AS only_digits,
      CASE WHEN raw = other THEN 'same' ELSE 'not same' END AS agree FROM x""",
)
def _(spark, sf):
    x = F.col("raw")
    return orders_with(spark, sf, raw=ZIPS, other=pick(["66061", "66062", None])).select(
        KEY, c.fix_zip(x).alias("zip"), c.zip_digits(x).alias("only_digits"), c.same_value(x, F.col("other")).alias("agree")
    )


STATES = pick(["K", "KA", "KS", " ", "MO", None])
PLACES = pick(["OLATHE, KS", "OLATHE KS.", "LENEXA  KS", "KSVILLE", "GARDNER", None])


@register(
    "f15_state",
    f"""WITH x AS (SELECT {KEY}, {STATES} AS s, {PLACES} AS p FROM orders)
    SELECT {KEY}, CASE WHEN s IN ('K', 'KA') THEN 'KS' WHEN s = ' ' THEN NULL ELSE s END AS state, regexp_replace(p, ',? +KS\\.?$', '') AS place FROM x""",
)
def _(spark, sf):
    return orders_with(spark, sf, s=STATES, p=PLACES).select(
        KEY, c.fix_state(F.col("s")).alias("state"), c.strip_state_suffix(F.col("p")).alias("place")
    )


CITIES = pick(
    [
        "OLATHE", "OLATHA", "PLATTE", "OLATHE KANSAS", "66061", "OVERLAND PARK", "OVRLAND PRK", "ROELAND PARK", "ORLAND PARK", "O.P.", "OV. PK",
        "SHAWNEE", "SHAWNE", "PAWNEE", "66203", "LENEXA", "SENECA", "KANSAS CTY", "ARKANSAS CITY", "GARNDER", "GARDENER", "BONNER SPGS KANSAS",
        "DESOTO", "DENSON", "EDGERTON RD", "LEAWODO", "MERIAM", "MISSION.....", "MISSION HILS", "MISSION WODS", "PRAIRIEVILLE", "P.V.",
        "ROEPARK", "SHAWNEE MISION", "SM", "SPRING HILL (TOWNSHIP)", "CLEARVEW", "STILLWELL", "FAIRYWAY", "FAIRWAY KS", "LAKE QUIVERA",
        "WESTWOD", "WESTWOOD HILL", "STAPLES", "STANLY", "OXFORD KANSAS", "EUODRA", "ELDORA", "BURNS", "BUCYRIS", "NEW CENTURY AIRPORT",
        "OAK CENTER", "", "`", ".", "WICHITA", "DENVER", None,
    ]
)


@register(
    "f16_fuzzy_names",
    f"WITH x AS (SELECT {KEY}, {CITIES} AS raw FROM orders) SELECT {KEY}, {sql_fuzzy('raw', v.CITY_NAMES, v.CITY_NULLS)} AS city FROM x",
)
def _(spark, sf):
    return orders_with(spark, sf, raw=CITIES).select(KEY, tx.fuzzy_canonicalise(F.col("raw"), v.CITY_NAMES, v.CITY_NULLS).alias("city"))


TRACTS = pick(["20091053101", "20045000200", None, "20091"])


@register(
    "f17_resident",
    f"""WITH x AS (SELECT {KEY}, {TRACTS} AS tract, CASE WHEN {KEY} % 7 < 3 THEN NULL ELSE o_orderpriority END AS address FROM orders)
    SELECT {KEY}, CASE WHEN left(tract, 5) = '20091' THEN true WHEN address IS NULL THEN NULL ELSE false END AS resident FROM x""",
)
def _(spark, sf):
    rows = orders_with(spark, sf, tract=TRACTS, address=f"CASE WHEN {KEY} % 7 < 3 THEN NULL ELSE o_orderpriority END")
    return rows.select(KEY, c.is_resident(F.col("tract"), F.col("address"), v.RESIDENT_TRACT_PREFIX).alias("resident"))


PROGRAMS = pick(["PACT TEAM", "ADOLESCENT CENTER", "MH INTAKE", "FAM FOCUS", "GAMBLING", "VOCATIONAL", "SUD", "PRE ADMISSION ADMIT", "PRE SCHOOL", "CSS", "CDS", "OTHER", None])
REASONS = pick(
    [
        "DEATH BY ACCIDENT", "MUTUAL DECISION A", "TX NOT COMPLETE AGCY DECISION", "TX NOT COMPLETE CLIENT DECISION", "CLIENT DROPPED OUT",
        "TREATMENT COMPLETE", "PRE ADMIT ADMITTED", "PRE ADMIT", "CLIENT MOVED AWAY", "TRANSFER OUT", "REFUSED", "CANCELED", "NO SHOW", "X", None,
        "FURTHER CARE NOT AVAILABLE HERE",
    ]
)


@register(
    "f18_text_classes",
    f"""WITH x AS (SELECT {KEY}, {PROGRAMS} AS p, {REASONS} AS r FROM orders)
    SELECT {KEY}, CASE WHEN p LIKE '%ACT%' THEN 'ACT' WHEN p LIKE '%ADOLESCENT%' OR p LIKE '%YOUTH%' OR p LIKE '%PEDIATRICS%' THEN 'YOUTH TREATMENT'
        WHEN p LIKE '%MH%' OR p LIKE '%MENTAL HEALTH%' THEN 'MENTAL HEALTH' WHEN p LIKE '%FAMILY%' OR p LIKE '%FAM FOCUS%' THEN 'FAMILY'
        WHEN p LIKE '%GAMBLING%' THEN 'GAMBLING' WHEN p LIKE '%EMPLOYMENT%' OR p LIKE '%VOCATIONAL%' THEN 'EMPLOYMENT'
        WHEN p LIKE '%ALCOHOL%' OR p LIKE '%DRUG%' OR p LIKE '%SUBSTANCE ABUSE%' OR p LIKE '%SUD%' OR p LIKE '%DETOXIFICATION%' THEN 'SUBSTANCE ABUSE'
        WHEN p LIKE 'PRE%' AND p LIKE '%ADMIT%' THEN 'PRE-ADMIT' WHEN p LIKE '%CSS%' THEN 'CSS' WHEN p LIKE '%CDS%' THEN 'CDS' ELSE p END AS program,
      {sql_classify('r', v.DISCHARGE_CLASSES, 'r')} AS reason FROM x""",
)
def _(spark, sf):
    return orders_with(spark, sf, p=PROGRAMS, r=REASONS).select(
        KEY, tx.classify_text(F.col("p"), v.PROGRAM_CLASSES).alias("program"), tx.classify_text(F.col("r"), v.DISCHARGE_CLASSES).alias("reason")
    )


DIAGNOSES = [
    "AUTISTIC DISORDER (F84.0)", "ATTN-DEFICIT HYPERACTIVITY (F90.1)", "PARANOID SCHIZOPHRENIA (F20.0)", "BIPOLAR WITH PSYCHOTIC FEATURES (F31.2)",
    "DEMENTIA WITH PSYCHOSIS (F03)", "MAJOR DEPRESSIVE DISORDER (F33.1)", "ADJUSTMENT DISORDER WITH DEPRESSED MOOD (F43.21)", "PREMENSTRUAL DYSPHORIA (F32.81)",
    "GENERALIZED ANXIETY DISORDER (F41.1)", "ALCOHOL USE WITH ANXIETY (F10.980)", "HOARDING DISORDER (F42.3)", "POST-TRAUMATIC STRESS DISORDER (F43.10)",
    "BIRTH TRAUMA SUBDURAL (P10.0)", "BRAIN TRAUMA (S06)", "DISSOCIATIVE AMNESIA (F44.0)", "CONVERSION DISORDER (F44.4)", "FOOD ALLERGY (Z91.018)",
    "ANOREXIA NERVOSA (F50.0)", "ENURESIS (F98.0)", "INSOMNIA (G47.00)", "GENDER IDENTITY DISORDER (F64.0)", "CONDUCT DISORDER (F91.9)", "ALZHEIMERS DISEASE (G30.9)",
    "BORDERLINE PERSONALITY DISORDER (F60.3)", "PARANOIA", "FETISHISM (F65.0)", "OPIOID DEPENDENCE (F11.20)", "COCAINE", "AMPHETAMINE", "TOBACCO USE (Z72.0)",
    "PATHOLOGICAL GAMBLING (F63.0)", "SUICIDAL IDEATIONS (R45.851)", "CHILD NEGLECT (T76.02)", "SIBLING RIVALRY (Z62.891)", "HOMELESSNESS (Z59.0)",
    "IMPRISONMENT", "PERSONAL HISTORY OF SUICIDAL BEHAVIOR", "PRISON", "SEXUAL ASSAULT", "SOCIAL EXCLUSION (Z60.4)", "MENTAL DISORDER NOS (F99)", "FRACTURE OF WRIST (S62)",
    "SUICIDE ATTEMPT (T14.91)", "POISONING BY DRUG, SELF-HARM (T50)", "NONE", None,
]
DIAGNOSIS = pick(DIAGNOSES)
SECOND = pick(DIAGNOSES, f"({KEY} * 7 + 3)")


@register(
    "f19_diagnosis_classes",
    f"WITH x AS (SELECT {KEY}, {DIAGNOSIS} AS raw FROM orders) SELECT {KEY}, {sql_classify('raw', v.DIAGNOSIS_CLASSES, lit('OTHER'))} AS class FROM x",
)
def _(spark, sf):
    return orders_with(spark, sf, raw=DIAGNOSIS).select(KEY, tx.classify_text(F.col("raw"), v.DIAGNOSIS_CLASSES, F.lit("OTHER")).alias("class"))


@register(
    "f19_document_classes",
    f"SELECT {sql_classify('upper(text)', v.DIAGNOSIS_CLASSES, lit('OTHER'))} AS class, lang, CAST(count(*) AS BIGINT) AS n FROM documents GROUP BY ALL",
)
def _(spark, sf):
    # The upper-cased text is a column of its own, else each of the rules would make it anew.
    docs = spread(t(spark, sf, "documents").select("lang", "text")).select("lang", F.upper("text").alias("u"))
    return docs.groupBy(tx.classify_text(F.col("u"), v.DIAGNOSIS_CLASSES, F.lit("OTHER")).alias("class"), "lang").agg(F.count(F.lit(1)).alias("n"))


IMPRESSIONS = ["Psych/Behavioral", "Suicide Attempt", "Overdose", "ETOH abuse", "Chest Pain", "Substance Abuse", "Drug Ingestion", "Allergic reaction", "Anxiety", None, ""]
COMPLAINTS = [
    "wants to die i want to die", "dont want to die", "I dont want to live", "cut both wrists", "took meth", "meth use", "ate a laundry pod, drug abuse?",
    "drug abuse", "kill myself said self", "end his life", "fall", "drug ingested", "suicidal ideation", "heroin", "used heroin", None, "depressed",
]
CALLS = dict(p=pick(IMPRESSIONS), s=pick(IMPRESSIONS, f"({KEY} * 3 + 1)"), q=pick(COMPLAINTS, f"({KEY} * 5 + 2)"))
FLAGS = ["suicidal_flag", "suicide_attempt_flag", "drug_flag", "other_mental_crisis_flag", "alcohol_flag", "drug_poisoning_flag"]
_all = lambda ps: {"p": ps, "s": ps, "q": ps}
CALL_FLAGS = f"""
  {sql_like({**_all(v.SUICIDAL_ANYWHERE), 'q': v.SUICIDAL_ANYWHERE + v.SUICIDAL_COMPLAINT}, {'q': v.SUICIDAL_VETO})}
    OR coalesce(p ILIKE '%psych%' AND q ILIKE '%end%life%', false) AS suicidal_flag,
  coalesce(p ILIKE 'suicide attempt' OR s ILIKE 'suicide attempt', false) AS suicide_attempt_flag,
  {sql_like({**_all(v.DRUG_ANYWHERE), 'q': v.DRUG_ANYWHERE + v.DRUG_COMPLAINT})} OR {sql_like(_all(v.DRUG_ABUSE), {'q': v.DRUG_ABUSE_VETO})} AS drug_flag,
  {sql_like(_all(v.MENTAL_ANYWHERE))} AS other_mental_crisis_flag, {sql_like(_all(v.ALCOHOL_ANYWHERE))} AS alcohol_flag,
  {sql_like(_all(v.INGEST_ANYWHERE), {'p': v.INGEST_VETO, 's': v.INGEST_VETO})} AS drug_poisoning_flag"""
CALL_VIEW = f"calls AS (SELECT {KEY}, o_custkey AS entity_id, CAST(o_orderdate AS DATE) AS event_date, {', '.join(f'{e} AS {n}' for n, e in CALLS.items())} FROM orders)"


def flagged_calls(spark, sf):
    """Orders as call reports: entity, date and the six flags."""
    rows = t(spark, sf, "orders").select(
        KEY, F.col("o_custkey").alias("entity_id"), F.to_date("o_orderdate").alias("event_date"), *[F.expr(e).alias(n) for n, e in CALLS.items()]
    )
    return rows.select(KEY, "entity_id", "event_date", *[e.alias(n) for n, e in fl.call_flags("p", "s", "q").items()])


@register("f20_call_flags", f"WITH {CALL_VIEW} SELECT {KEY}, {CALL_FLAGS} FROM calls")
def _(spark, sf):
    return flagged_calls(spark, sf).select(KEY, *FLAGS)


_both = lambda ps: {"a": ps, "b": ps}
_mental = "(" + ", ".join(lit(x) for x in v.MENTAL_CRISIS_CLASSES) + ")"


@register(
    "f20_visit_flags",
    f"""WITH x AS (SELECT {KEY}, {DIAGNOSIS} AS a, {SECOND} AS b FROM orders)
    SELECT {KEY}, {sql_like(_both(v.VISIT_ATTEMPT))} AS suicide_attempt_flag,
      {sql_like({'a': v.VISIT_SUICIDAL, 'b': v.VISIT_SUICIDAL + v.VISIT_SUICIDAL_SECONDARY})} AS suicidal_flag,
      {sql_like(_both(v.VISIT_DRUG))} AS drug_flag, {sql_like(_both(v.VISIT_ALCOHOL))} AS alcohol_flag, {sql_like(_both(v.VISIT_POISONING))} AS drug_poisoning_flag,
      {sql_classify('a', v.DIAGNOSIS_CLASSES, lit('OTHER'))} IN {_mental} OR {sql_classify('b', v.DIAGNOSIS_CLASSES, lit('OTHER'))} IN {_mental} AS other_mental_crisis_flag
    FROM x""",
)
def _(spark, sf):
    rows = orders_with(spark, sf, a=DIAGNOSIS, b=SECOND)
    of = lambda n: tx.classify_text(F.col(n), v.DIAGNOSIS_CLASSES, F.lit("OTHER"))
    return rows.select(KEY, *[e.alias(n) for n, e in fl.visit_flags("a", "b", of("a"), of("b")).items()])


@register(
    "f20_document_keywords",
    """SELECT doc_id, lang, coalesce((text ILIKE '%the%and%' OR text ILIKE '%le %' OR source ILIKE 'src1%') AND text NOT ILIKE '%lorem%', false) AS flag FROM documents""",
)
def _(spark, sf):
    flag = tx.keyword_flag({"text": ["%the%and%", "%le %"], "source": ["src1%"]}, {"text": ["%lorem%"]})
    return t(spark, sf, "documents").select("doc_id", "lang", flag.alias("flag"))


@register(
    "f21_trailing_code",
    f"""WITH x AS (SELECT {KEY}, {DIAGNOSIS} AS raw FROM orders)
    SELECT {KEY}, nullif(regexp_extract(raw, '\\(([^\\)]+)\\)$', 1), '') AS code, regexp_replace(raw, '\\(([^\\)]+)\\)$', '') AS text FROM x""",
)
def _(spark, sf):
    x = F.col("raw")
    return orders_with(spark, sf, raw=DIAGNOSIS).select(KEY, tx.trailing_code(x).alias("code"), tx.strip_trailing_code(x).alias("text"))


@register("f25_hash_hex", "SELECT c_custkey, lower(hex(c_name)) AS hex_, md5(c_name) AS md5_ FROM customer")
def _(spark, sf):
    name = F.col("c_name").cast("binary")
    return t(spark, sf, "customer").select("c_custkey", c.hash_hex(name).alias("hex_"), F.md5(name).alias("md5_"))
