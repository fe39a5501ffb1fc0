"""From raw tables to one entity id and long event, attribute and episode tables."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import cleaning as c
from tidemark.functions import vocab

EVENT_COLUMNS = ["entity_id", "event_date", "event_type", "source"]


# ---- identity --------------------------------------------------------------------------


def latest_snapshot(df: DataFrame, date_col: str) -> DataFrame:
    """Rows of the newest match run; the newest date is one row and is broadcast."""
    day = F.col(date_col).cast("date")
    newest = df.agg(F.max(day).alias("_newest"))
    return df.withColumn("_newest", day).join(F.broadcast(newest), "_newest", "left_semi").drop("_newest")


def resolve(
    df: DataFrame, id_col: str, crosswalk: DataFrame, source: str, cross_col: str = "sourceid", keep_unmatched: bool = True
) -> DataFrame:
    """Add ``entity_id`` by the crosswalk's ids of one source; unmatched rows keep NULL or go.

    Spark broadcasts the crosswalk's rows of the source if they are small; otherwise the join
    shuffles and adaptive execution splits hot ids.
    """
    ids = crosswalk.where(F.col("source") == source).select(F.col(cross_col).alias("_id"), "entity_id")
    key = F.col(id_col) if cross_col.startswith("hash") else F.col(id_col).cast("string")
    how = "left" if keep_unmatched else "inner"
    return df.drop("entity_id").join(ids, key == F.col("_id"), how).drop("_id")


def resolve_via(
    child: DataFrame, parent: DataFrame, link: str | tuple[str, str], parent_id: str, crosswalk: DataFrame, source: str,
    keep_unmatched: bool = True,
) -> DataFrame:
    """Two hops: the child's parent row holds the id that the crosswalk knows.

    The parent is resolved first, so the wide child is joined once. ``link`` is the child's and
    the parent's key column.
    """
    child_key, parent_key = (link, link) if isinstance(link, str) else link
    owners = resolve(parent.select(F.col(parent_key).alias("_link"), parent_id), parent_id, crosswalk, source, keep_unmatched=keep_unmatched)
    how = "left" if keep_unmatched else "inner"
    return child.join(owners.select("_link", "entity_id"), F.col(child_key) == F.col("_link"), how).drop("_link")


# ---- table jobs ------------------------------------------------------------------------


@dataclass(frozen=True)
class Identity:
    """How a table gets its entity id: its id column and the crosswalk source, maybe by a parent."""

    id_col: str
    source: str
    cross_col: str = "sourceid"
    keep_unmatched: bool = True
    parent: DataFrame | None = None
    link: str | tuple[str, str] | None = None


@dataclass(frozen=True)
class TableJob:
    """Cleaning of one table: output columns as expressions, identity, and whether to dedupe rows."""

    name: str
    columns: Mapping[str, Column]
    identity: Identity | None = None
    distinct: bool = False
    event_date: str | None = None
    event_type: str = "SEMI-CLEAN"


def standardise(raw: DataFrame, job: TableJob, crosswalk: DataFrame | None = None, limit: int | None = None) -> DataFrame:
    """Run a table job. ``limit`` is the trial mode that reads a few rows only."""
    rows = raw if limit is None else raw.limit(limit)
    ident = job.identity
    if ident is None:
        out = rows.select(*[e.alias(n) for n, e in job.columns.items()])
    else:
        if ident.parent is not None:
            rows = resolve_via(rows, ident.parent, ident.link, ident.id_col, crosswalk, ident.source, ident.keep_unmatched)
        else:
            rows = resolve(rows, ident.id_col, crosswalk, ident.source, ident.cross_col, ident.keep_unmatched)
        out = rows.select("entity_id", *[e.alias(n) for n, e in job.columns.items()])
    return out.distinct() if job.distinct else out


def _only(names: Sequence[str], pattern: str) -> str | None:
    found = [n for n in names if re.search(pattern, n)]
    if len(found) > 1:
        raise ValueError(f"more than one column matches {pattern!r}: {found}")
    return found[0] if found else None


def detect_columns(df: DataFrame, date_order: Sequence[str] = vocab.EVENT_DATE_ORDER) -> dict[str, Column]:
    """Standard columns found by name: race, sex, dob, and the event date by priority."""
    names = df.columns
    out: dict[str, Column] = {}
    if race := _only(names, "race"):
        out["race"] = c.fix_race(F.col(race))
    if sex := _only(names, "sex(?!ual|off)"):
        out["sex"] = c.fix_sex(F.col(sex))
    dates = [n for n in date_order if n in names]
    if not dates:
        raise ValueError(f"no event date column in {names}")
    out["event_date"] = F.coalesce(*[F.col(n).cast("date") for n in dates])
    if dob := _only(names, "dob"):
        out["dob"] = F.col(dob).cast("date")
    return out


def semi_clean(df: DataFrame, identity: Identity, crosswalk: DataFrame, date_order: Sequence[str] = vocab.EVENT_DATE_ORDER) -> DataFrame:
    """Resolve a table and put its detected standard columns in front of its own."""
    found = detect_columns(df, date_order)
    out = resolve(df, identity.id_col, crosswalk, identity.source, identity.cross_col)
    rest = [n for n in df.columns if n not in found and n != "entity_id"]
    return out.select("entity_id", *[e.alias(n) for n, e in found.items()], *rest)


def undated(df: DataFrame) -> DataFrame:
    """Keep a source for audits only: without an event date it never becomes an event."""
    return df.withColumn("event_date", F.lit(None).cast("date"))


def consensus(df: DataFrame, attributes: Sequence[str], any_flags: Sequence[str] = ()) -> DataFrame:
    """One row per entity: an attribute survives only if all rows agree (NULL counts as a value).

    Flags are true if true on any row.
    """
    aggs = []
    for a in attributes:
        agree = (F.min(a) == F.max(a)) & (F.count(a) == F.count(F.lit(1)))
        aggs.append(F.when(agree, F.min(a)).alias(a))
    flags = [F.max(F.col(f).cast("int")).alias(f) for f in any_flags]
    return df.groupBy("entity_id").agg(*aggs, *flags)


# ---- long tables -----------------------------------------------------------------------


@dataclass(frozen=True)
class EventSpec:
    """How a table becomes events; ``event_date`` is a column or an expression."""

    source: str
    event_type: str
    event_date: str | Column
    entity_id: str | Column = "entity_id"
    where: str | None = None


def _col(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def conform_events(tables: Mapping[str, DataFrame], specs: Sequence[EventSpec], ignore: Sequence[str] = ()) -> DataFrame:
    """One long event table; rows without id or date drop out, duplicates stay."""
    parts = []
    for s in specs:
        if s.source in ignore:
            continue
        rows = tables[s.source] if s.where is None else tables[s.source].where(s.where)
        parts.append(
            rows.select(
                _col(s.entity_id).cast("long").alias("entity_id"),
                _col(s.event_date).cast("date").alias("event_date"),
                F.lit(s.event_type).alias("event_type"),
                F.lit(s.source).alias("source"),
            ).where("entity_id is not null and event_date is not null")
        )
    return reduce(DataFrame.unionByName, parts)


def conform_attributes(
    df: DataFrame, source: str, attributes: Mapping[str, str], event_date: str | None = "event_date"
) -> DataFrame:
    """Wide to long attributes, distinct, without NULL values.

    ``attributes`` maps attribute type to column. With ``event_date=None`` the table has no date
    and must not feed features.
    """
    ids = ["entity_id"] + ([F.col(event_date).alias("event_date")] if event_date else [])
    pairs = F.array(
        *[
            F.struct(F.lit(t).alias("attribute_type"), F.col(col).cast("string").alias("attribute_value"))
            for t, col in attributes.items()
        ]
    )
    return (
        df.where("entity_id is not null")
        .select(*ids, F.lit(source).alias("source"), F.inline(pairs))
        .where("attribute_value is not null")
        .distinct()
    )


def union_distinct(parts: Mapping[str, DataFrame]) -> DataFrame:
    """Set union of tables with their source name; missing columns are NULL."""
    tagged = [df.withColumn("source", F.lit(name)) for name, df in parts.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged).distinct()


def conform_episodes(parts: Mapping[str, DataFrame]) -> DataFrame:
    """Episodes of several sources; the same episode in two sources keeps the smallest name."""
    rows = [
        df.select("entity_id", "start_date", "end_date", F.lit(name).alias("source")) for name, df in parts.items()
    ]
    return reduce(DataFrame.unionByName, rows).groupBy("entity_id", "start_date", "end_date").agg(F.min("source").alias("source"))


def member_flag(df: DataFrame, columns: Sequence[str], reference: DataFrame, ref_col: str, name: str) -> DataFrame:
    """True if any of the columns is in the reference list.

    The list is made distinct, so each left join keeps the row count; Spark broadcasts it only
    if it is small.
    """
    out = df
    for i, column in enumerate(columns):
        ref = reference.select(F.col(ref_col).alias(f"_r{i}")).where(F.col(f"_r{i}").isNotNull()).distinct()
        out = out.join(ref, F.col(column) == F.col(f"_r{i}"), "left")
    hit = reduce(lambda a, b: a | b, [F.col(f"_r{i}").isNotNull() for i in range(len(columns))])
    return out.withColumn(name, hit).drop(*[f"_r{i}" for i in range(len(columns))])


def conform_exits(parts: Mapping[str, tuple[DataFrame, Mapping[str, Column]]]) -> DataFrame:
    """Exit tables of all segments under one schema.

    Each part gives expressions for ``birth_date``, ``exit_date``, ``age`` and the cause flags.
    """
    rows = [
        df.select("entity_id", *[e.alias(n) for n, e in exprs.items()], F.lit(segment).alias("segment"))
        for segment, (df, exprs) in parts.items()
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)

