"""Monthly outreach lists in which nobody appears twice."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from datetime import date

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.dates import to_date

LIST_SCHEMA = "model_set_id long, as_of_date date, entity_id long, position long"


def outreach_lists(
    predictions: DataFrame,
    k: int,
    min_date: date | str,
    max_date: date | str,
    segment: str | None = None,
    months: int = 12,
) -> DataFrame:
    """Lists of ``k`` entities a month for every model set, walking its prediction dates.

    Dates run from the newest one not after ``min_date`` to ``max_date``; model sets without
    such a start date give no list. With n dates each one serves ``ceil(months / n)`` months,
    and all lists together hold at most ``months * k`` entities. A date takes its best entities
    not yet listed; if they run out the list is shorter.

    At most ``needed * n`` best ranks of a date can matter (everything before may have been
    taken already), so a model set's candidates are bounded by k, months and n, and the walk
    over them is done in one task per model set.
    """
    low, high = to_date(min_date), to_date(max_date)
    rank = "k" if segment is None else "segment_k"
    rows = predictions if segment is None else predictions.where(F.col("segment") == segment)
    dates = predictions.select("model_set_id", "as_of_date").distinct()
    start = Window.partitionBy("model_set_id")
    first = F.max(F.when(F.col("as_of_date") <= F.lit(low), F.col("as_of_date"))).over(start)
    dates = dates.withColumn("_first", first).where(
        (F.col("as_of_date") >= F.col("_first")) & (F.col("as_of_date") <= F.lit(high))
    )
    dates = dates.withColumn("_dates", F.count(F.lit(1)).over(start)).drop("_first")
    need = F.lit(k) * F.ceil(F.lit(months) / F.col("_dates"))
    candidates = rows.join(dates, ["model_set_id", "as_of_date"]).where(F.col(rank) <= need * F.col("_dates"))

    def walk(pdf: pd.DataFrame) -> pd.DataFrame:
        per_date = k * math.ceil(months / int(pdf["_dates"].iloc[0]))
        seen: set[int] = set()
        out = []
        for day, part in pdf.sort_values(["as_of_date", rank]).groupby("as_of_date", sort=True):
            room = min(per_date, months * k - len(seen))
            fresh = [e for e in part["entity_id"] if e not in seen][:room]
            seen.update(fresh)
            out += [(day, e) for e in fresh]
        frame = pd.DataFrame(out, columns=["as_of_date", "entity_id"])
        frame.insert(0, "model_set_id", pdf["model_set_id"].iloc[0])
        frame["position"] = range(1, len(frame) + 1)
        return frame

    slim = candidates.select(F.col("model_set_id").cast("long"), "as_of_date", F.col("entity_id").cast("long"), rank, "_dates")
    return slim.groupBy("model_set_id").applyInPandas(walk, LIST_SCHEMA)


def monthly_blocks(lists: DataFrame, k: int) -> DataFrame:
    """The month (0, 1, ...) in which each listed entity is reached."""
    return lists.withColumn("month", F.floor((F.col("position") - 1) / k).cast("int"))


def outcomes_after_referral(
    blocks: DataFrame,
    events: DataFrame,
    flags: Sequence[str],
    k: int,
    min_date: date | str,
    max_date: date | str,
    months_future: int = 6,
) -> DataFrame:
    """Flag counts after being reached: ever, and until ``max_date`` + ``months_future``.

    Only full months count. The lists hold at most months * k rows per model set and are
    broadcast, so that the events, with their hot entities, stay where they are.
    """
    low = F.lit(to_date(min_date))
    end = F.add_months(F.lit(to_date(max_date)), months_future)
    full = Window.partitionBy("model_set_id", "month")
    listed = blocks.withColumn("_n", F.count(F.lit(1)).over(full)).where(F.col("_n") == k)
    listed = listed.select("model_set_id", "entity_id", F.add_months(low, F.col("month")).alias("_from"))
    hits = events.select("entity_id", "event_date", *flags).join(F.broadcast(listed), "entity_id")
    after = F.col("event_date") > F.col("_from")
    late = F.col("event_date") > end
    wide = hits.groupBy("model_set_id").agg(
        *[F.sum(F.when(F.col(f) & after, 1).otherwise(0)).alias(f"{f}__all") for f in flags],
        *[F.sum(F.when(F.col(f) & late, 1).otherwise(0)).alias(f"{f}__late") for f in flags],
    )
    return wide.select(
        "model_set_id",
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(f).alias("event_type"),
                        F.col(f"{f}__all").alias("all_time"),
                        (F.col(f"{f}__all") - F.col(f"{f}__late")).alias("validation_period"),
                    )
                    for f in flags
                ]
            )
        ),
    )


def exit_breakdown(blocks: DataFrame, exits: DataFrame, k: int, causes: Mapping[str, str]) -> DataFrame:
    """Exits of listed entities by cause column (``{column: output name}``) and by any cause."""
    full = Window.partitionBy("model_set_id", "month")
    listed = blocks.withColumn("_n", F.count(F.lit(1)).over(full)).where(F.col("_n") == k)
    rows = exits.select("entity_id", *causes).join(F.broadcast(listed.select("model_set_id", "entity_id")), "entity_id")
    any_cause = F.greatest(*[F.col(c).cast("int") for c in causes]) if len(causes) > 1 else F.col(next(iter(causes))).cast("int")
    return rows.groupBy("model_set_id").agg(
        *[F.sum(F.col(c).cast("int")).alias(n) for c, n in causes.items()], F.sum(any_cause).alias("any_cause")
    )
