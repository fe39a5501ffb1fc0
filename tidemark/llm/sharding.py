"""Sharding by histogram sort.

Rows are ordered by (hash of the text, hash of the key), so equal texts are neighbours. The
boundaries between shards are found without moving a row: each round counts the exact bytes
below a set of probes across all partitions and refines only the intervals that still hold an
unsettled boundary. A boundary that falls inside a group of equal texts moves to the nearer end
of the group; only where that would unbalance the shards is the group itself cut, at a hash of
the key. Once all boundaries stand, rows are exchanged once.

The driver holds probe counts and boundaries: at most 2**bits numbers for the first histogram and for each open boundary.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import stored

LOWEST = -(1 << 63)


@dataclass
class Boundary:
    """A place in the order: rows at or after (h, g) lie above it."""

    target: float
    h: int = LOWEST
    g: int = LOWEST
    within: list = field(default_factory=list)  # open interval: (key, bits, prefix, bytes below)


def _nearest(b: Boundary, key: str, bits: int, hist: dict, before: int, tolerance: float, group_tolerance: float, hot: int | None) -> None:
    """Settles a boundary from the counts of one interval, or narrows the interval."""
    step = 64 - bits
    put = (lambda edge: (edge, LOWEST)) if key == "h" else (lambda edge: (hot, edge))
    below, prefixes = before, sorted(hist)
    best = None
    for p in prefixes:
        n, lo, hi = hist[p]
        if below + n > b.target or p == prefixes[-1]:
            allowed = tolerance
            if lo == hi and key == "h":
                allowed = group_tolerance
            near, edge = min((abs(below - b.target), (p << step) if p << step > LOWEST else LOWEST), (abs(below + n - b.target), ((p + 1) << step)))
            best = (near, edge, p, n, lo, hi, below)
            break
        below += n
    near, edge, p, n, lo, hi, below = best
    b.within = []
    if near <= allowed or (lo == hi and key == "g"):
        b.h, b.g = put(edge) if edge < 1 << 63 else ((1 << 63) - 1, (1 << 63) - 1)
    elif lo == hi:
        b.within = ["g", 0, lo, below]
    else:
        b.within = [key, bits, p, below] if key == "h" else [key, bits, (hot, p), below]


def find_boundaries(rows: DataFrame, shards: int, bits: int, tolerance: float, group_tolerance: float) -> tuple[list[Boundary], np.ndarray]:
    """Shard boundaries by refinement, and bytes by the first ``bits`` bits of h.

    rows: h, g (long hashes) and size.
    """
    first = {r.p: (int(r.n), r.lo, r.hi) for r in rows.groupBy(F.shiftright("h", 64 - bits).alias("p")).agg(F.sum("size").alias("n"), F.min("h").alias("lo"), F.max("h").alias("hi")).collect()}
    total = sum(n for n, _, _ in first.values())
    half = 1 << (bits - 1)
    coarse = np.array([first.get(p, (0,))[0] for p in range(-half, half)], np.int64)
    out = [Boundary(total * s / shards) for s in range(1, shards)]
    tol, group_tol = tolerance * total / shards, group_tolerance * total / shards
    if first:
        for b in out:
            _nearest(b, "h", bits, first, 0, tol, group_tol, None)
    while any(b.within for b in out):
        parts = []
        for b in out:
            if not b.within:
                continue
            key, had, at, _ = b.within
            if key == "h":
                inside = F.shiftright("h", 64 - had) == at
            else:
                hot, prefix = (at, None) if had == 0 else at
                inside = F.col("h") == hot
                if prefix is not None:
                    inside = inside & (F.shiftright("g", 64 - had) == prefix)
            more = min(64, had + bits)
            parts.append((inside, repr((key, had, at)), key, more))
        unique = list({p[1]: p for p in parts}.values())
        place = F.coalesce(*[F.when(inside, F.lit(i)) for i, (inside, _, _, _) in enumerate(unique)])
        probe = F.coalesce(*[F.when(inside, F.shiftright(key, 64 - more) if more < 64 else F.col(key)) for inside, _, key, more in unique])
        value = F.coalesce(*[F.when(inside, F.col(key)) for inside, _, key, _ in unique])
        counted = rows.select(place.alias("i"), probe.alias("p"), value.alias("v"), "size").filter("i is not null").groupBy("i", "p")
        hists: dict[int, dict] = {}
        for r in counted.agg(F.sum("size").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).collect():
            hists.setdefault(r.i, {})[r.p] = (int(r.n), r.lo, r.hi)
        number = {name: i for i, (_, name, _, _) in enumerate(unique)}
        for b in out:
            if b.within:
                key, had, at, before = b.within
                hot = None if key == "h" else at if had == 0 else at[0]
                _nearest(b, key, min(64, had + bits), hists[number[repr((key, had, at))]], before, tol, group_tol, hot)
    return sorted(out, key=lambda b: (b.h, b.g)), coarse


def _shard(h: Column, g: Column, boundaries: list[Boundary]) -> Column:
    out = F.lit(0)
    for b in boundaries:
        out = out + F.when((h > b.h) | ((h == b.h) & (g >= b.g)), 1).otherwise(0)
    return out


def shard_documents(
    docs: DataFrame, shards: int = 16, key: str = "doc_id", text: str = "text", tolerance: float = 0.001, group_tolerance: float = 0.05, bits: int = 12, range_bytes: int = 32 << 20
) -> DataFrame:
    """Shards of nearly equal bytes: shard, slot, size and the whole row as a struct ``row``.

    The size of a row is the UTF-8 bytes of its text (null: none) plus 1. Every boundary lies
    within ``tolerance`` of a shard's ideal bytes from its ideal place, or within
    ``group_tolerance`` where that keeps a group of equal texts whole, or as near as one row
    allows. Equal texts with equal keys (repeated rows) stay together; null keys and null texts
    are ordinary values. Slots count from 0 in each shard without gaps. With fewer rows than
    shards some shards are empty; an empty table gives no rows. Input columns of any name are
    safe inside ``row``.
    """
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    h, g = F.xxhash64(F.col(f"row.`{text}`")), F.xxhash64(F.col(f"row.`{key}`"), F.lit(1))
    size = (F.coalesce(F.octet_length(F.col(f"row.`{text}`").cast("string")), F.lit(0)) + 1).cast("long")
    light = stored(row.select(h.alias("h"), g.alias("g"), size.alias("size")), "sharding")
    boundaries, coarse = find_boundaries(light, shards, bits, tolerance, group_tolerance)

    # shards are exchanged as several ranges, cut at edges of the first histogram
    range_of = (np.cumsum(coarse) - coarse) // max(1, range_bytes)
    fine = F.array(*[F.lit(int(x)) for x in np.unique(range_of, return_inverse=True)[1]])

    def place(h, g):
        shard = _shard(h, g, boundaries)
        return shard, shard + F.element_at(fine, (F.shiftright(h, 64 - bits) + (1 << (bits - 1)) + 1).cast("int"))

    shard, part = place(F.col("h"), F.col("g"))
    counts = sorted((r.shard, r.part, r["count"]) for r in light.select(shard.alias("shard"), part.alias("part")).groupBy("shard", "part").count().collect())
    base, seen = {}, {}
    for s, p, n in counts:
        base[p] = seen.get(s, 0)
        seen[s] = base[p] + n
    first_slot = F.array(*[F.lit(base.get(p, 0)).cast("long") for p in range(max(base, default=0) + 1)])

    keyed = row.withColumns({"h": h, "g": g, "size": size})
    shard, part = place(F.col("h"), F.col("g"))
    moved = keyed.withColumns({"shard": shard.cast("int"), "part": part.cast("int")}).repartition(max(1, len(counts)), "part")
    number = F.row_number().over(Window.partitionBy("part").orderBy("h", "g"))
    return moved.select("shard", (F.element_at(first_slot, F.col("part") + 1) + number - 1).alias("slot"), "size", "row")
