"""Point-in-time features.

A feature at an as-of date sees only source rows dated strictly before it. Sums, counts,
minima, maxima and averages over calendar windows, days since the first or last event, flags
and modes are all computed for every as-of date in one pass over the source:

* each source row fans out to the as-of dates whose longest bounded window holds it, and to
  the first as-of date after it;
* one aggregate per (entity, as-of date) with map-side combine gives the bounded windows and
  the increment for unbounded ones, so a hot entity shrinks to one row per date and task;
* unbounded windows are running aggregates over an entity's as-of dates (never more rows than
  as-of dates).

Any SQL over named states is a feature too (``State``, ``HistoryExpression``). A state is kept per
(entity, first as-of date after the row) and merged forward over the dates: sums and extremes as
they are, distinct counts by the date of a value's first row, quantiles by mergeable sketches. No
row goes to more than one date for them. States can be stored (``history_state``) and carried on
to later dates, for which only newer rows are then read.

The cohort keys join in by union before the aggregate, so no join is needed.

An aggregate holds a row per key of its task. A source's rows are therefore counted as they fan
out and dealt to a number of tasks that goes with the count, whatever the splits of its scan.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.dates import Interval, fan_out, to_date
from tidemark.session import gathered, stored, tasks_for

KEYS = ["entity_id", "as_of_date"]
#: parts of an entity's rows that are combined apart if a source needs several tasks
PARTS_PER_ENTITY = 32


@dataclass(frozen=True)
class WindowAggregate:
    """``fn(arg)`` over each interval before the as-of date; ``arg`` and ``where`` are SQL."""

    name: str
    arg: str
    fns: Sequence[str]
    intervals: Sequence[str]
    where: str | None = None


@dataclass(frozen=True)
class HistoryFeature:
    """A value over all history.

    ``kind`` is ``days_since_last``, ``days_since_first``, ``ever`` (1 if ``arg`` held on any
    row), ``max``, ``min``, ``sum`` or ``count`` of ``arg``.
    """

    name: str
    kind: str
    arg: str | None = None
    where: str | None = None
    impute: float | int | None = None


@dataclass(frozen=True)
class ModeFeature:
    """Most frequent value (smallest on ties) among rows with ``where``."""

    name: str
    arg: str
    where: str | None = None
    impute: str | None = None


@dataclass(frozen=True)
class AgeFeature:
    """Age in years from a birth date among attributes (the most frequent one), and a 0/1 flag
    ``<name>_imp`` that it is missing or out of bounds and so to be imputed."""

    name: str
    arg: str
    where: str | None = None
    low: float = 5.0
    high: float = 90.0


@dataclass(frozen=True)
class State:
    """What is known of an entity's rows before the as-of date, for use in expressions.

    ``fn`` is sum, count, min, max, avg, variance, stddev (of a sample), first or last (non-null
    value of the first or last day; on one day the smallest or largest), count_distinct, or
    sketch (of doubles, for kll_sketch_get_quantile_double and its like). Without rows a state is
    null, counts included.
    """

    name: str
    fn: str
    arg: str
    where: str | None = None


@dataclass(frozen=True)
class HistoryExpression:
    """SQL over the states of the source and ``as_of_date``."""

    name: str
    expr: str
    impute: float | int | str | None = None
    categorical: bool = False


@dataclass(frozen=True)
class Carried:
    """States of all entities of a source, as known before the day ``since``.

    ``values`` has a row per entity; ``seen`` the values behind distinct counts and ``counts`` the
    counts behind modes, if there are any.
    """

    since: date
    values: DataFrame
    seen: DataFrame | None = None
    counts: DataFrame | None = None


@dataclass(frozen=True)
class DateFeature:
    """An expression over the as-of date alone, such as the month."""

    name: str
    expr: str


@dataclass(frozen=True)
class FeatureSource:
    """Features drawn from one table; ``knowledge_date`` is when a row became known."""

    name: str
    prefix: str
    knowledge_date: str
    segment: str = "ALL"
    windows: Sequence[WindowAggregate] = ()
    history: Sequence[HistoryFeature] = ()
    modes: Sequence[ModeFeature] = ()
    dates: Sequence[DateFeature] = ()
    states: Sequence[State] = ()
    expressions: Sequence[HistoryExpression] = ()
    ages: Sequence[AgeFeature] = ()
    impute_agg: float | int | None = 0
    filter: str | None = None

    def window_columns(self) -> list[tuple[str, WindowAggregate, str, Interval]]:
        return [
            ("_".join([self.prefix, w.name, fn.lower(), iv.suffix]), w, fn.lower(), iv)
            for w in self.windows
            for fn in w.fns
            for iv in map(Interval.parse, w.intervals)
        ]

    def numeric_columns(self) -> list[str]:
        names = [*self.history, *(e for e in self.expressions if not e.categorical)]
        ages = [f"{self.prefix}_{a.name}{end}" for a in self.ages for end in ("", "_imp")]
        return [c[0] for c in self.window_columns()] + [f"{self.prefix}_{n.name}" for n in names] + ages

    def categorical_columns(self) -> list[str]:
        return [f"{self.prefix}_{m.name}" for m in (*self.modes, *self.dates, *(e for e in self.expressions if e.categorical))]


def check_unique(spec: FeatureSource) -> None:
    """Raises if two features of a source would share a column name."""
    names = spec.numeric_columns() + spec.categorical_columns() + [s.name for s in spec.states]
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise ValueError(f"features of {spec.name!r} share column names: {', '.join(twice)}")


def _guarded(arg: str, where: str | None) -> Column:
    value = F.expr(arg)
    return F.when(F.expr(where), value) if where else value


_MERGE = {"sum": F.sum, "count": F.sum, "max": F.max, "min": F.min, "sketch": lambda c: F.call_function("kll_merge_agg_double", F.col(c))}
#: states made of running primitives: part name -> (merge, value)
_PARTS = {
    "sum": lambda v, day: {"": ("sum", v)},
    "count": lambda v, day: {"": ("count", v)},
    "min": lambda v, day: {"": ("min", v)},
    "max": lambda v, day: {"": ("max", v)},
    "avg": lambda v, day: {"__s": ("sum", v), "__n": ("count", v)},
    "variance": lambda v, day: {"__s": ("sum", v.cast("double")), "__q": ("sum", v.cast("double") * v.cast("double")), "__n": ("count", v)},
    "first": lambda v, day: {"": ("min", F.when(v.isNotNull(), F.named_struct(F.lit("day"), day, F.lit("value"), v)))},
    "last": lambda v, day: {"": ("max", F.when(v.isNotNull(), F.named_struct(F.lit("day"), day, F.lit("value"), v)))},
}
_PARTS["stddev"] = _PARTS["variance"]


def _prepared(source: DataFrame, spec: FeatureSource) -> DataFrame:
    known = F.col(spec.knowledge_date).cast("date")
    rows = source.where(spec.filter) if spec.filter else source
    return rows.withColumn("_day", known).where(F.col("entity_id").isNotNull() & F.col("_day").isNotNull())


def _first_after(window: Column, day: Column) -> Column:
    """No earlier as-of date also lies after the day."""
    return window["prev"].isNull() | (window["prev"] <= day)


def _pieces(spec: FeatureSource) -> tuple[dict, dict]:
    """Primitive aggregates that the features are made of: bounded ones by interval, and running ones."""
    bounded: dict[str, tuple[str, Column, Interval, tuple]] = {}
    running: dict[str, tuple[str, Column]] = {}

    def add(name: str, fn: str, value: Column, interval: Interval | None, measure: tuple = ()) -> None:
        if fn not in _MERGE:
            raise ValueError(f"window aggregate {fn!r} is not supported")
        value = F.when(value.isNotNull(), 1) if fn == "count" else value
        if interval is None or interval.unbounded:
            running[name] = (fn, value)
        else:
            bounded[name] = (fn, value, interval, (fn, *measure))

    for name, w, fn, interval in spec.window_columns():
        value = _guarded(w.arg, w.where)
        if fn == "avg":
            add(f"{name}__s", "sum", value, interval, (w.arg, w.where))
            add(f"{name}__n", "count", value, interval, (w.arg, w.where))
        else:
            add(name, fn, value, interval, (w.arg, w.where))
    for h in spec.history:
        name = f"{spec.prefix}_{h.name}"
        if h.kind in ("days_since_last", "days_since_first"):
            day = F.when(F.expr(h.where), F.col("_day")) if h.where else F.col("_day")
            add(name, "max" if h.kind == "days_since_last" else "min", day, None)
        elif h.kind == "ever":
            add(name, "max", F.when(F.expr(f"({h.arg}) and ({h.where})" if h.where else h.arg), 1).otherwise(0), None)
        else:
            add(name, h.kind, _guarded(h.arg or "1", h.where), None)
    for s in spec.states:
        if s.fn in _PARTS:
            for part, (fn, value) in _PARTS[s.fn](_guarded(s.arg, s.where), F.col("_day")).items():
                add(s.name + part, fn, value, None)
        elif s.fn not in ("count_distinct", "sketch"):
            raise ValueError(f"state {s.fn!r} is not supported")
    return bounded, running


def _state_value(s: State) -> Column:
    """The state from its merged parts."""
    if s.fn == "avg":
        return F.try_divide(F.col(f"{s.name}__s"), F.col(f"{s.name}__n"))
    if s.fn in ("variance", "stddev"):
        total, squares, n = (F.col(f"{s.name}__{k}") for k in "sqn")
        value = F.when(n > 1, F.greatest(F.lit(0.0), squares - total * total / n) / (n - 1))
        return F.sqrt(value) if s.fn == "stddev" else value
    return F.col(s.name)["value"] if s.fn in ("first", "last") else F.col(s.name)


def _first_dates(spec: FeatureSource, source: DataFrame, days: Sequence[date], since: date | None, columns: Sequence[Column]) -> DataFrame:
    """Each row since ``since`` once, at the first as-of date after it."""
    day = F.col("_day")
    known = _prepared(source, spec).where(day < F.lit(days[-1]))
    known = known.where(day >= F.lit(since)) if since else known
    dates = [{"as_of": d, "prev": p} for p, d in zip([None, *days], days)]
    fanned = fan_out(known, ["entity_id", "_day", *columns], dates, lambda w: (w["as_of"] > day) & _first_after(w, day))
    return fanned.withColumn("as_of_date", F.col("_w.as_of")).drop("_w", "_day")


def _first_values(spec: FeatureSource, source: DataFrame, days: Sequence[date], carried: Carried | None) -> DataFrame | None:
    """entity_id, state (its number), value and as_of_date: the first date on which a distinct value is known."""
    numbered = [(i, s) for i, s in enumerate(spec.states) if s.fn == "count_distinct"]
    if not numbered:
        return None
    values = F.array(*[F.named_struct(F.lit("state"), F.lit(i), F.lit("value"), _guarded(s.arg, s.where).cast("string")) for i, s in numbered])
    rows = _first_dates(spec, source, days, carried and carried.since, [values.alias("vs")])
    rows = rows.select("entity_id", "as_of_date", F.explode("vs").alias("v")).where("v.value is not null")
    found = rows.groupBy("entity_id", F.col("v.state").alias("state"), F.col("v.value").alias("value")).agg(F.min("as_of_date").alias("as_of_date"))
    return found.join(carried.seen, ["entity_id", "state", "value"], "left_anti") if carried and carried.seen is not None else found


def _state_rows(spec: FeatureSource, source: DataFrame, days: Sequence[date], carried: Carried | None) -> tuple[DataFrame | None, dict[str, str], DataFrame | None]:
    """Rows by (entity, as-of date) of the states that are no plain running aggregates, how they merge, and the first values."""
    out, merge = None, {}
    firsts = _first_values(spec, source, days, carried)
    if firsts is not None:
        names = {i: s.name for i, s in enumerate(spec.states) if s.fn == "count_distinct"}
        out = firsts.groupBy(*KEYS).agg(*[F.sum(F.when(F.col("state") == i, F.lit(1).cast("long"))).alias(n) for i, n in names.items()])
        merge |= dict.fromkeys(names.values(), "sum")
    sketched = [s for s in spec.states if s.fn == "sketch"]
    if sketched:
        rows = _first_dates(spec, source, days, carried and carried.since, [_guarded(s.arg, s.where).cast("double").alias(s.name) for s in sketched])
        rows = rows.groupBy(*KEYS).agg(*[F.call_function("kll_sketch_agg_double", F.col(s.name)).alias(s.name) for s in sketched])
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
        merge |= {s.name: "sketch" for s in sketched}
    return out, merge, firsts


def history_state(source: DataFrame, spec: FeatureSource, as_of: date | str, earlier: Carried | None = None) -> Carried:
    """The states of every entity as known before ``as_of``: what later dates of the spec build on.

    With earlier states only rows since then are read. To be stored before they are carried on.
    """
    as_of = to_date(as_of)
    _, running = _pieces(spec)
    pieces = {}, running
    rows, _ = _rings(source, spec, pieces, [as_of], False, earlier and earlier.since, _tasks(source, spec, pieces, [as_of], earlier and earlier.since))
    others, merge, firsts = _state_rows(spec, source, [as_of], earlier)
    merge = {n: fn for n, (fn, _) in running.items()} | merge
    rows = rows.select("entity_id", *running)
    for more in (others, earlier and earlier.values):
        if more is not None:
            rows = rows.unionByName(more.drop("as_of_date"), allowMissingColumns=True)
    values = rows.groupBy("entity_id").agg(*[_MERGE[fn](n).alias(n) for n, fn in merge.items()]) if merge else rows.select("entity_id").distinct()
    if firsts is not None:
        firsts = firsts.select("entity_id", "state", "value")
        firsts = firsts.unionByName(earlier.seen) if earlier else firsts
    births = spec_modes(spec)
    counts = _mode_counts(source, births, [as_of], earlier).groupBy("entity_id", "feature", "value").agg(F.sum("count").alias("count")) if births.modes else None
    return Carried(as_of, values, firsts, counts)


def stored_state(state: Carried, name: str = "states") -> Carried:
    """The states written to the shared folder and read back."""
    kept = {k: stored(df, f"{name}-{k}") for k in ("values", "seen", "counts") if (df := getattr(state, k)) is not None}
    return replace(state, **kept)


def _shorter(interval: Interval, spans: Sequence[Interval], days: Sequence[date]) -> Column:
    """How many of the intervals are shorter at an as-of date (30 days and 1 month may swap)."""
    counts = {d: sum(iv.before(d) > interval.before(d) for iv in spans) for d in days}
    if len(set(counts.values())) == 1:
        return F.lit(counts[days[0]])
    return F.element_at(F.create_map(*[F.lit(x) for d, n in counts.items() for x in (d, n)]), F.col("as_of_date"))


def _reach(source: DataFrame, spec: FeatureSource, pieces: tuple[dict, dict], days: Sequence[date], since: date | None):
    """The rows that any date needs, the dates, which of them a row goes to, and for which it is new."""
    bounded, running = pieces
    intervals = list(dict.fromkeys(iv for _, _, iv, _ in bounded.values()))
    dates = [
        {"as_of": d, "prev": p, "lo": min((iv.before(d) for iv in intervals), default=d)}
        for p, d in zip([None, *days], days)
    ]
    day = F.col("_day")
    newer = lambda w: _first_after(w, day) & (day >= F.lit(since)) if since else _first_after(w, day)
    if running:
        keep = lambda w: (w["as_of"] > day) & ((w["lo"] <= day) | newer(w))
    else:
        keep = lambda w: (w["as_of"] > day) & (w["lo"] <= day)
    known = _prepared(source, spec).where(day < F.lit(days[-1]))
    if since:
        known = known.where(day >= F.lit(min(since, dates[0]["lo"])))
    return known, dates, keep, newer


def _tasks(source: DataFrame, spec: FeatureSource, pieces: tuple[dict, dict], days: Sequence[date], since: date | None = None) -> int:
    """How many tasks the rows of a source need once they have fanned out."""
    known, dates, keep, _ = _reach(source, spec, pieces, days, since)
    return tasks_for(fan_out(known, ["_day"], dates, keep).count())


def _rings(
    source: DataFrame, spec: FeatureSource, pieces: tuple[dict, dict], days: Sequence[date], by_ring: bool, since: date | None = None, tasks: int = 1
) -> tuple[DataFrame, dict[str, Column]]:
    """Rows of one source by (entity, as-of date), and what each bounded column takes from them.

    ``by_ring`` first sums rows per ring: how many of the intervals do not reach back to a row.
    There is then one column per measure, and few rows per key, however many columns there are.
    Running columns take only rows since ``since``, and older rows beyond all windows stay unread.
    With several ``tasks`` rows are dealt to them by entity and part of its rows before they fan
    out, and combined there, so a hot entity is neither one task's nor sent on row by row.
    """
    bounded, running = pieces
    intervals = list(dict.fromkeys(iv for _, _, iv, _ in bounded.values()))
    known, dates, keep, newer = _reach(source, spec, pieces, days, since)
    day = F.col("_day")
    measures = {m: (f"_m{i}", fn, v) for i, (m, (fn, v)) in enumerate({m: (fn, v) for fn, v, _, m in bounded.values()}.items())}
    inputs = [v.alias(n) for n, _, v in measures.values()] + [v.alias(n) for n, (_, v) in running.items()]
    known, sub = known.select("entity_id", "_day", *inputs), []
    if tasks > 1:
        sub = ["_sub"]
        part = F.pmod(F.xxhash64(*known.columns), F.lit(PARTS_PER_ENTITY))
        known = known.withColumn("_sub", part).repartition(tasks, "entity_id", "_sub")
    fanned = fan_out(known, known.columns, dates, keep)
    as_of = F.col("_w.as_of")
    started = [F.when(newer(F.col("_w")), F.col(n)).alias(n) for n in running]
    names = [n for n, _, _ in measures.values()]
    merged = [_MERGE[fn](n).alias(n) for n, fn, _ in measures.values()] + [_MERGE[fn](n).alias(n) for n, (fn, _) in running.items()]
    if not by_ring:
        rows = fanned.select("entity_id", as_of.alias("as_of_date"), *sub, "_day", *names, *started)
        if sub:
            rows = rows.groupBy(*KEYS, *sub, *(["_day"] if names else [])).agg(*merged).drop(*sub)
        return rows, {n: F.when(day >= iv.before_col(F.col("as_of_date")), F.col(measures[m][0])) for n, (_, _, iv, m) in bounded.items()}
    ring = sum((F.when(iv.before_col(as_of) > day, 1).otherwise(0) for iv in intervals), F.lit(0))
    rows = fanned.select("entity_id", as_of.alias("as_of_date"), ring.alias("_ring"), *sub, *names, *started)
    rows = rows.groupBy(*KEYS, "_ring", *sub).agg(*merged).drop(*sub)
    inside = {iv: F.col("_ring") <= _shorter(iv, intervals, days) for iv in intervals}
    return rows, {n: F.when(inside[iv], F.col(measures[m][0])) for n, (_, _, iv, m) in bounded.items()}


def aggregate_features(
    cohort: DataFrame,
    source: DataFrame,
    spec: FeatureSource,
    as_of_dates: Sequence[date | str],
    columns_per_aggregate: int = 100,
    carried: Carried | None = None,
) -> DataFrame:
    """Window, history and date features and expressions of one source for every cohort row.

    Bounded columns are summed by ring first (see ``_rings``). Above ``columns_per_aggregate``
    columns the rings are written once, and columns are made from them in groups, so the source
    is read and fanned out once. With ``carried`` states, which must not be newer than the first
    as-of date, only rows since then and those inside windows are read.
    """
    check_unique(spec)
    pieces = bounded, running = _pieces(spec)
    days = sorted({to_date(d) for d in as_of_dates})
    if carried and carried.since > days[0]:
        raise ValueError(f"states are of {carried.since}, after the first as-of date {days[0]}")
    keys = cohort.select(*KEYS).distinct()
    others, merge, _ = _state_rows(spec, source, days, carried)
    merge = {n: fn for n, (fn, _) in running.items()} | merge
    if bounded or merge:
        since = carried and carried.since
        tasks = _tasks(source, spec, pieces, days, since)
        rows, parts = _rings(source, spec, pieces, days, bool(bounded), since, tasks)
        names = list(bounded)
        groups = [names[i : i + columns_per_aggregate] for i in range(0, len(names), columns_per_aggregate)] or [[]]
        if len(groups) > 1:
            rows = stored(rows, "rings")
        marked = keys.withColumn("_key", F.lit(True))
        merged = []
        for i, group in enumerate(groups):
            started = merge if i == 0 else {}
            part = (rows if i == 0 else rows.drop(*running)).unionByName(marked, allowMissingColumns=True)
            if i == 0 and others is not None:
                part = part.unionByName(others, allowMissingColumns=True)
            if i == 0 and carried:
                part = part.unionByName(carried.values.withColumn("as_of_date", F.lit(days[0])), allowMissingColumns=True)
            part = gathered(part, tasks, "entity_id").select(*KEYS, "_key", *[parts[n].alias(n) for n in group], *started)
            part = part.groupBy(*KEYS).agg(
                F.max("_key").alias("_key"),
                *[_MERGE[bounded[n][0]](n).alias(n) for n in group],
                *[_MERGE[fn](n).alias(n) for n, fn in started.items()],
            )
            if started:
                so_far = Window.partitionBy("entity_id").orderBy("as_of_date").rowsBetween(Window.unboundedPreceding, 0)
                part = part.select(*KEYS, "_key", *group, *[_MERGE[fn](n).over(so_far).alias(n) for n, fn in merge.items()])
            merged.append(part.where("_key").drop("_key"))
        keys = reduce(lambda a, b: a.join(b, KEYS), merged)

    if spec.states:
        made = {s.name for s in spec.states}
        keys = keys.select(*[c for c in keys.columns if c not in made], *[_state_value(s).alias(s.name) for s in spec.states])
    out = [_impute(F.expr(e.expr), e.impute).alias(f"{spec.prefix}_{e.name}") for e in spec.expressions]
    for name, _, fn, _ in spec.window_columns():
        value = F.try_divide(F.col(f"{name}__s"), F.col(f"{name}__n")) if fn == "avg" else F.col(name)
        out.append(_impute(value, spec.impute_agg).alias(name))
    for h in spec.history:
        name = f"{spec.prefix}_{h.name}"
        value = F.col(name)
        if h.kind.startswith("days_since"):
            value = F.datediff(F.col("as_of_date"), value)
        out.append(_impute(value, h.impute).alias(name))
    for d in spec.dates:
        out.append(F.expr(d.expr).alias(f"{spec.prefix}_{d.name}"))
    return keys.select(*KEYS, *out)


def _impute(value: Column, fill) -> Column:
    return value if fill is None else F.coalesce(value, F.lit(fill))


def spec_modes(spec: FeatureSource) -> FeatureSource:
    """The spec with the birth dates of its ages among its modes."""
    births = [ModeFeature(f"{a.name}__birth", f"cast({a.arg} as date)", a.where) for a in spec.ages]
    return replace(spec, modes=(*spec.modes, *births))


def _mode_counts(source: DataFrame, spec: FeatureSource, days: Sequence[date], carried: Carried | None) -> DataFrame:
    """entity_id, feature, value, count and bucket, the first as-of date after the counted rows."""
    values = F.array(*[F.named_struct(F.lit("feature"), F.lit(m.name), F.lit("value"), _guarded(m.arg, m.where).cast("string")) for m in spec.modes])
    rows = _first_dates(spec, source, days, carried and carried.since, [values.alias("vs")])
    rows = rows.select("entity_id", F.col("as_of_date").alias("bucket"), F.explode("vs").alias("v")).where("v.value is not null")
    counts = rows.groupBy("entity_id", "bucket", F.col("v.feature").alias("feature"), F.col("v.value").alias("value")).count()
    return counts.unionByName(carried.counts.withColumn("bucket", F.lit(days[0]))) if carried else counts


def mode_features(
    cohort: DataFrame, source: DataFrame, spec: FeatureSource, as_of_dates: Sequence[date | str], carried: Carried | None = None
) -> DataFrame:
    """Modes as of each date.

    Values are counted per (entity, feature, value, first later as-of date) with map-side
    combine; the counts, not the rows, fan out to the later dates. The winner is a min over
    (-count, value).
    """
    days = sorted({to_date(d) for d in as_of_dates})
    keys = cohort.select(*KEYS).distinct()
    counts = _mode_counts(source, spec, days, carried)
    later = lambda w: w["as_of"] >= F.col("bucket")
    best = (
        fan_out(counts, ["entity_id", "feature", "value", "count", "bucket"], [{"as_of": d} for d in days], later)
        .groupBy("entity_id", F.col("_w.as_of").alias("as_of_date"), "feature", "value")
        .agg((-F.sum("count")).alias("neg"))
        .groupBy(*KEYS)
        .agg(
            *[
                F.min(F.when(F.col("feature") == m.name, F.struct("neg", "value")))["value"].alias(
                    f"{spec.prefix}_{m.name}"
                )
                for m in spec.modes
            ]
        )
    )
    cols = [_impute(F.col(f"{spec.prefix}_{m.name}"), m.impute).alias(f"{spec.prefix}_{m.name}") for m in spec.modes]
    return keys.join(best, KEYS, "left").select(*KEYS, *cols)


def age_columns(dob: Column, as_of: Column, low: float = 5.0, high: float = 90.0) -> tuple[Column, Column]:
    """Age in years if within bounds else NULL, and a 0/1 flag that it must be imputed."""
    age = F.datediff(as_of, dob) / F.lit(365.25)
    ok = age.between(low, high)
    return F.when(ok, age), F.when(ok, 0).otherwise(1)


def build_features(
    cohort: DataFrame,
    source: DataFrame,
    spec: FeatureSource,
    as_of_dates: Sequence[date | str],
    columns_per_aggregate: int = 100,
    carried: Carried | None = None,
) -> DataFrame:
    """All features of one source, wide. Two columns of one name are an error."""
    out = aggregate_features(cohort, source, spec, as_of_dates, columns_per_aggregate, carried)
    with_births = spec_modes(spec)
    if not with_births.modes:
        return out
    modes = mode_features(cohort, source, with_births, as_of_dates, carried)
    for a in spec.ages:
        name = f"{spec.prefix}_{a.name}"
        age, missing = age_columns(F.col(f"{name}__birth").cast("date"), F.col("as_of_date"), a.low, a.high)
        modes = modes.withColumns({name: age, f"{name}_imp": missing}).drop(f"{name}__birth")
    return out.join(modes, KEYS)


def columns_for_segment(specs: Sequence[FeatureSource], segment: str) -> list[str]:
    """Feature columns that apply to a segment: those of its own sources and of shared ones."""
    chosen = [s for s in specs if segment == "ALL" or s.segment in (segment, "ALL")]
    return [c for s in chosen for c in (*s.numeric_columns(), *s.categorical_columns())]
