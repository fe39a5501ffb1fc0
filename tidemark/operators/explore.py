"""Reports on sources, events and entities."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def match_coverage(sources: Mapping[str, tuple[DataFrame, str]], crosswalk: DataFrame) -> DataFrame:
    """Per source: ids, rows, crosswalk ids, and the ids found in the crosswalk with their share.

    ``sources`` maps the crosswalk's source name to (frame, id column). All sources are stacked
    first, so there is one aggregate and one join whatever their number.
    """
    ids = None
    for name, (frame, column) in sources.items():
        part = frame.select(F.lit(name).alias("source"), F.col(column).cast("string").alias("sourceid"))
        ids = part if ids is None else ids.unionByName(part)
    per_id = ids.groupBy("source", "sourceid").agg(F.count("sourceid").alias("rows"))
    known = crosswalk.groupBy("source", "sourceid").agg(F.count("sourceid").alias("cross_rows"))
    both = per_id.join(known, ["source", "sourceid"], "full")
    has = lambda c: F.when(F.col(c).isNotNull() & F.col("sourceid").isNotNull(), 1).otherwise(0)
    return (
        both.where(F.col("source").isin(list(sources)))
        .groupBy("source")
        .agg(
            F.sum(has("rows")).alias("unique_ids"),
            F.coalesce(F.sum("rows"), F.lit(0)).alias("id_rows"),
            F.sum(has("cross_rows")).alias("crosswalk_ids"),
            F.coalesce(F.sum("cross_rows"), F.lit(0)).alias("crosswalk_rows"),
            F.sum(has("rows") * has("cross_rows")).alias("matched_ids"),
        )
        .withColumn("share_matched", F.try_divide(F.col("matched_ids"), F.col("unique_ids")))
    )


def value_counts(df: DataFrame, *columns: str) -> DataFrame:
    """Rows per value (NULL is a value), most frequent first."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), *columns)


def counts_over_time(df: DataFrame, date_col: str, flags: Mapping[str, str], by_month: bool = False) -> DataFrame:
    """Events by year (and month): all and per flag, long, with the percentage of all."""
    keys = [F.year(date_col).alias("year")] + ([F.month(date_col).alias("month")] if by_month else [])
    names = ["year"] + (["month"] if by_month else [])
    wide = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("all_events"),
        *[F.count(F.when(F.expr(test), 1)).alias(name) for name, test in flags.items()],
    )
    return wide.select(
        *names,
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("series"), F.col(c).alias("n"), (F.col(c) / F.col("all_events") * 100).alias("percent")
                    )
                    for c in ("all_events", *flags)
                ]
            )
        ),
    )


def flag_overlaps(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """Rows per combination of flags, of rows with any flag."""
    any_flag = F.lit(False)
    for f in flags:
        any_flag = any_flag | F.coalesce(F.col(f), F.lit(False))
    return df.where(any_flag).groupBy(*[F.coalesce(F.col(f), F.lit(False)).alias(f) for f in flags]).agg(F.count(F.lit(1)).alias("n"))


def flags_per_entity(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """Per entity: events, events per flag, and whether any flag ever held."""
    out = df.groupBy("entity_id").agg(
        F.count(F.lit(1)).alias("n_events"), *[F.count(F.when(F.col(f), 1)).alias(f"n_{f}") for f in flags]
    )
    return out.withColumn("any_flag", sum((F.col(f"n_{f}") for f in flags), F.lit(0)) > 0)


def calls_by_group(per_entity: DataFrame) -> DataFrame:
    """Distribution of events per entity, for entities with and without any flag."""
    return per_entity.groupBy("any_flag", "n_events").agg(F.count(F.lit(1)).alias("entities"))


def entity_profile(exits: DataFrame, history: DataFrame, flags: Sequence[str], contacts: DataFrame, attributes: DataFrame) -> DataFrame:
    """Exits with the flags ever seen in an entity's history, its contact rows and attributes."""
    ever = history.groupBy("entity_id").agg(*[F.max(f).alias(f) for f in flags])
    rows = contacts.groupBy("entity_id").agg(F.count(F.lit(1)).alias("contact_rows"))
    return exits.join(ever, "entity_id", "left").join(rows, "entity_id", "left").join(attributes, "entity_id", "left")


def first_contact_share(profile: DataFrame, by: str, cause: str) -> DataFrame:
    """Of exits with a cause: how many had the exit as their only contact."""
    only = F.count(F.when(F.col("contact_rows") == 1, 1))
    more = F.count(F.when(F.col("contact_rows") > 1, 1))
    return profile.where(F.col(cause)).groupBy(by).agg(
        only.alias("only_contact"), (only + more).alias("total"), F.try_divide(only, only + more).alias("share")
    )


def active_days(events: DataFrame) -> DataFrame:
    """Days with at least one event, per entity and event type."""
    return (
        events.select("entity_id", "event_date", "event_type")
        .distinct()
        .groupBy("entity_id", "event_type")
        .agg(F.count(F.lit(1)).alias("n_days"))
    )


def active_day_stats(events: DataFrame, types: Sequence[str], labelled: DataFrame) -> DataFrame:
    """Mean, deviation, min, max and median of active days per type, by label, and the difference.

    ``labelled(entity_id, label)``; entities not in it count as false.
    """
    days = active_days(events)
    wide = days.groupBy("entity_id").agg(
        *[F.coalesce(F.sum(F.when(F.col("event_type") == t, F.col("n_days"))), F.lit(0)).alias(f"t{i}") for i, t in enumerate(types)]
    )
    labels = labelled.groupBy("entity_id").agg(F.max("label").alias("label"))
    joined = wide.join(labels, "entity_id", "left").withColumn("label", F.coalesce("label", F.lit(False)))
    pairs = F.array(*[F.struct(F.lit(t).alias("event_type"), F.col(f"t{i}").alias("n")) for i, t in enumerate(types)])
    stats = (
        joined.select("label", F.inline(pairs))
        .groupBy("event_type")
        .agg(*[c for flag in (True, False) for c in _stats(flag)])
    )
    out = []
    for s in ("mean", "std", "min", "max", "median"):
        out.append(
            F.struct(
                F.lit(s).alias("stat"),
                F.col(f"{s}_true").cast("double").alias("label_true"),
                F.col(f"{s}_false").cast("double").alias("label_false"),
                (F.col(f"{s}_true") - F.col(f"{s}_false")).cast("double").alias("difference"),
            )
        )
    return stats.select("event_type", F.inline(F.array(*out)))


def _stats(flag: bool) -> list[Column]:
    n = F.when(F.col("label") == flag, F.col("n"))
    end = "true" if flag else "false"
    return [
        F.avg(n).alias(f"mean_{end}"),
        F.stddev_samp(n).alias(f"std_{end}"),
        F.min(n).alias(f"min_{end}"),
        F.max(n).alias(f"max_{end}"),
        F.median(n).alias(f"median_{end}"),
    ]


def false_alarm_follow_up(false_alarms: DataFrame, flagged: DataFrame, flags: Sequence[str]) -> DataFrame:
    """Per false alarm entity the later flagged events by kind, and whether there was any."""
    sums = flagged.groupBy("entity_id").agg(*[F.sum(F.col(f).cast("int")).alias(f) for f in flags])
    out = false_alarms.select("entity_id").join(sums, "entity_id", "left").fillna(0, subset=list(flags))
    return out.withColumn("any_later", sum((F.col(f) for f in flags), F.lit(0)) > 0)


def follow_up_share(follow_up: DataFrame) -> DataFrame:
    return follow_up.agg(
        F.count(F.when(F.col("any_later"), 1)).alias("with_event"),
        F.count(F.lit(1)).alias("entities"),
        F.avg(F.col("any_later").cast("int")).alias("share"),
    )


def class_agreement(df: DataFrame, first: str, second: str) -> DataFrame:
    """Pair counts of two class columns."""
    return df.groupBy(first, second).agg(F.count(F.lit(1)).alias("n"), F.max(F.col(first) == F.col(second)).alias("same"))


def agreement_share(df: DataFrame, first: str, second: str) -> DataFrame:
    same = F.when(F.col(first) == F.col(second), 1).otherwise(0)
    return df.agg(F.avg(same).alias("share_same"), F.count(F.lit(1)).alias("n"))


def lost_entities(snapshots: DataFrame, old, new) -> DataFrame:
    """Entities of the old snapshot that the new one lacks (``snapshots(entity_id, matchdate)``)."""
    old, new = F.lit(old).cast("date"), F.lit(new).cast("date")
    seen = snapshots.where(F.col("matchdate").isin(old, new)).groupBy("entity_id").agg(
        F.max(F.when(F.col("matchdate") == old, F.col("matchdate"))).alias("old_matchdate"),
        F.max(F.when(F.col("matchdate") == new, F.col("matchdate"))).alias("new_matchdate"),
    )
    return seen.where("old_matchdate is not null and new_matchdate is null")


def exit_counts(exits: DataFrame, by: Sequence[Column], causes: Sequence[str]) -> DataFrame:
    """Exits in all and by cause flag for each value of ``by``."""
    return exits.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), *[F.count(F.when(F.col(c), 1)).alias(f"n_{c}") for c in causes]
    )
