"""Cohorts and labels at many as-of dates in one plan each."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.dates import Interval, fan_out, to_date

KEYS = ["entity_id", "as_of_date"]


def first_exits(exits: DataFrame) -> DataFrame:
    """Earliest exit per entity: ``exits(entity_id, exit_date)`` -> one row each."""
    return (
        exits.where("entity_id is not null and exit_date is not null")
        .groupBy("entity_id")
        .agg(F.min("exit_date").alias("exit_date"))
    )


def segment_rank(source: Column, segment_sources: Mapping[str, Sequence[str]]) -> Column:
    """1, 2, ... for the segments in their order, 0 for sources in no list."""
    out = F.lit(0)
    for i, sources in reversed(list(enumerate(segment_sources.values(), start=1))):
        out = F.when(source.isin(list(sources)), i).otherwise(out)
    return out


def build_cohort(
    events: DataFrame,
    as_of_dates: Sequence[date | str],
    interval_back: str,
    segment_sources: Mapping[str, Sequence[str]],
    exclude_sources: Sequence[str] = (),
    exits: DataFrame | None = None,
) -> DataFrame:
    """Entities with an event in ``[as_of - interval_back, as_of]`` that have not yet exited.

    The newest event sets the segment; on one day the segment listed last wins, and a source
    without segment never wins. Each event fans out to the as-of dates whose window holds it. Day
    and segment make one number, so the newest event is a hash-aggregated max and a hot entity
    collapses before the shuffle.
    """
    back = Interval.parse(interval_back)
    dates = [{"as_of": d, "lo": back.before(d)} for d in sorted({to_date(x) for x in as_of_dates})]
    day = F.col("event_date")
    rows = events.where(
        F.col("entity_id").isNotNull() & day.between(F.lit(min(d["lo"] for d in dates)), F.lit(dates[-1]["as_of"]))
    )
    if exclude_sources:
        rows = rows.where(~F.col("source").isin(list(exclude_sources)))
    names = list(segment_sources)
    base = len(names) + 1
    code = F.unix_date(day).cast("long") * base + segment_rank(F.col("source"), segment_sources)
    rows = rows.select("entity_id", "event_date", code.alias("_code"))
    inside = lambda w: (w["lo"] <= day) & (day <= w["as_of"])
    rank = F.pmod(F.col("_newest"), F.lit(base))
    segment = F.lit(None).cast("string")
    for i, name in enumerate(names, start=1):
        segment = F.when(rank == i, name).otherwise(segment)
    newest = (
        fan_out(rows, ["entity_id", "event_date", "_code"], dates, inside)
        .groupBy("entity_id", F.col("_w.as_of").alias("as_of_date"))
        .agg(F.max("_code").alias("_newest"))
        .select(*KEYS, segment.alias("segment"))
    )
    if exits is None:
        return newest
    gone = first_exits(exits).withColumnRenamed("entity_id", "gone_id")
    return newest.join(
        gone, (F.col("entity_id") == F.col("gone_id")) & (F.col("exit_date") <= F.col("as_of_date")), "left_anti"
    )


def label_hits(
    label_events: DataFrame,
    as_of_dates: Sequence[date | str],
    months_future: int,
    open_until: date | str | None = None,
    by_name: bool = False,
) -> DataFrame:
    """Distinct (entity, as-of date[, label name]) with a label event inside the horizon.

    The horizon is strict on both sides: ``as_of < event_date < as_of + months_future``. With
    ``open_until`` the upper bound is that date for every as-of date.
    """
    horizon = Interval(months_future, "month")
    dates = [
        {"as_of": d, "hi": to_date(open_until) if open_until else horizon.after(d)}
        for d in sorted({to_date(x) for x in as_of_dates})
    ]
    day = F.col("event_date")
    keys = ["entity_id"] + (["label_name"] if by_name else [])
    rows = label_events.where(
        F.col("entity_id").isNotNull() & (day > F.lit(dates[0]["as_of"])) & (day < F.lit(max(d["hi"] for d in dates)))
    )
    inside = lambda w: (w["as_of"] < day) & (day < w["hi"])
    return fan_out(rows, [*keys, "event_date"], dates, inside).select(*keys, F.col("_w.as_of").alias("as_of_date")).distinct()


def build_labels(
    cohort: DataFrame,
    label_events: DataFrame,
    label_names: Sequence[str],
    as_of_dates: Sequence[date | str],
    months_future: int,
    segments: Sequence[str],
    open_until: date | str | None = None,
) -> DataFrame:
    """One label per cohort row: true if any of ``label_names`` happens inside the horizon.

    ``label_events(entity_id, event_date, label_name)``. Cohort rows outside ``segments`` (also
    those without a segment) get no label row.
    """
    wanted = label_events.where(F.col("label_name").isin(list(label_names)))
    hits = label_hits(wanted, as_of_dates, months_future, open_until).withColumn("hit", F.lit(True))
    return (
        cohort.where(F.col("segment").isin(list(segments)))
        .join(hits, KEYS, "left")
        .select(
            *KEYS,
            "segment",
            F.lit(", ".join(label_names)).alias("label_name"),
            F.coalesce("hit", F.lit(False)).alias("label"),
        )
    )


def build_split_labels(
    cohort: DataFrame,
    label_events: DataFrame,
    label_names: Sequence[str],
    as_of_dates: Sequence[date | str],
    months_future: int,
    segments: Sequence[str],
    open_until: date | str | None = None,
) -> DataFrame:
    """One row per cohort row and label name.

    Only the hits are joined (one row per cohort key, as the set of names that happened); the
    rows for every name are then made without a further shuffle.
    """
    names = list(label_names)
    wanted = label_events.where(F.col("label_name").isin(names))
    hits = (
        label_hits(wanted, as_of_dates, months_future, open_until, by_name=True)
        .groupBy(*KEYS)
        .agg(F.collect_set("label_name").alias("hit_names"))
    )
    return (
        cohort.where(F.col("segment").isin(list(segments)))
        .join(hits, KEYS, "left")
        .withColumn("label_name", F.explode(F.array(*[F.lit(n) for n in names])))
        .select(
            *KEYS,
            "segment",
            "label_name",
            F.coalesce(F.array_contains("hit_names", F.col("label_name")), F.lit(False)).alias("label"),
        )
    )


@dataclass(frozen=True)
class LabelDefinition:
    """What makes a label event: rows of a source table with ``where`` (SQL), dated by ``date``.

    Several definitions may share a name; each then adds its events.
    """

    name: str
    source: str
    date: str
    where: str | None = None
    entity: str = "entity_id"


def defined_label_events(tables: Mapping[str, DataFrame], definitions: Sequence[LabelDefinition]) -> DataFrame:
    """``entity_id, event_date, label_name`` of all definitions, each source table read once.

    Rows without entity or date make no event.
    """
    if not definitions:
        raise ValueError("no label is defined")
    out = None
    for source in dict.fromkeys(d.source for d in definitions):
        own = [d for d in definitions if d.source == source]
        found = [F.named_struct(F.lit("entity_id"), F.col(d.entity), F.lit("event_date"), F.col(d.date).cast("date"), F.lit("label_name"), F.lit(d.name)) for d in own]
        found = [F.when(F.expr(d.where), x) if d.where else x for d, x in zip(own, found, strict=True)]
        rows = tables[source].select(F.explode(F.array_compact(F.array(*found))).alias("e")).select("e.*").where("entity_id is not null and event_date is not null")
        out = rows if out is None else out.unionByName(rows)
    return out


def combine_label_parts(parts: Mapping[str, Sequence[DataFrame]]) -> DataFrame:
    """``{label_name: [frames with entity_id, event_date]}`` -> one label event table."""
    out = None
    for name, frames in parts.items():
        for frame in frames:
            part = frame.select("entity_id", "event_date", F.lit(name).alias("label_name"))
            out = part if out is None else out.unionByName(part)
    return out


def label_group_of(selected: Sequence[str], groups: Mapping[str, Sequence[Sequence[str]]]) -> str:
    """Name of the group that has exactly the selected labels in one of its variants."""
    for name, variants in groups.items():
        if any(sorted(v) == sorted(selected) for v in variants):
            return name
    raise ValueError(f"no label group is made of {sorted(selected)}")


def label_table_name(group: str, segment: str) -> str:
    return "_".join(["label", group.replace(" ", "_").replace("-", "_").lower(), segment.lower()])


def future_events(events: DataFrame, entities: DataFrame, after: Column | date | str, date_col: str = "event_date") -> DataFrame:
    """Events of the listed entities strictly after a date."""
    bound = after if isinstance(after, Column) else F.lit(to_date(after))
    return events.where(F.col(date_col) > bound).join(entities.select("entity_id").distinct(), "entity_id", "left_semi")
