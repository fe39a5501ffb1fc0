"""Classification trees and boosted stumps grown on histograms, of any depth.

Features are binned once by quantiles into a stored table of small integers. Trees then grow
level by level: one pass adds up class weights by (tree, open node, feature, bin) in every task,
Spark adds up the tasks, and the best split of each node is found from its own histogram. Nodes
that have become small are finished in one pass: their rows meet by (tree, node), at most
``finish_rows`` of them, and the rest of the subtree is grown there by the same rule. Only node
tables and bin edges reach the driver.

A split is "value <= edge". The split with the largest sum over both children of (squared class
weights / weight) wins for Gini, its like for entropy; ties go to the first feature and the
lowest edge. A node's name is a hash of its path, so that draws of rows and features are the same
on every run and retry.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import stored

KEYS = ["entity_id", "as_of_date"]
ROOT = 1
NODES = "tree int, node long, feature int, bin int, w0 double, w1 double"
MASK = (1 << 64) - 1


def child(node: int, right: bool) -> int:
    """Name of a child."""
    x = (node * 2 + int(right) + 0x9E3779B97F4A7C15) & MASK
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & MASK
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & MASK
    return (x ^ (x >> 31)) >> 1


@dataclass(frozen=True)
class TreeSettings:
    """How trees grow. ``max_features`` (a number) are drawn anew for every node; None takes all."""

    n_trees: int = 1
    criterion: str = "gini"
    max_depth: int | None = None
    max_features: int | None = None
    min_samples_split: int = 2
    bootstrap: bool = False
    max_bins: int = 256
    finish_rows: int = 20_000
    seed: int = 0


def bin_edges(train: DataFrame, features: Sequence[str], max_bins: int, accuracy: int = 1_000_000) -> list[np.ndarray]:
    """Edges of each feature: all values but the largest if there are at most ``max_bins``, else quantiles.

    Sets of values are only collected where an estimate says that they are small. Quantiles of the
    other features come from mergeable summaries, exact up to ``accuracy`` rows; these are large, so
    features with few values get none.
    """
    shares, columns = [i / max_bins for i in range(1, max_bins)], [F.col(f"`{c}`").cast("double") for c in features]

    def measured(one, some) -> dict[int, object]:
        some = list(some)
        return dict(zip(some, train.agg(*[one(columns[i]).alias(f"v{i}") for i in some]).first(), strict=True)) if some else {}

    distinct = measured(F.approx_count_distinct, range(len(features)))
    sets = measured(F.collect_set, (i for i, n in distinct.items() if n <= 1.25 * max_bins))
    values = {i: np.unique([v for v in found if v == v]) for i, found in sets.items()}
    values = {i: v for i, v in values.items() if len(v) <= max_bins}
    quantiles = measured(lambda c: F.percentile_approx(c, shares, accuracy), (i for i in range(len(features)) if i not in values))
    return [values[i][:-1] if i in values else np.unique(np.array(quantiles[i] or [], float)) for i in range(len(features))]


def _binned(batch: pa.RecordBatch, edges: list[np.ndarray], first: int) -> np.ndarray:
    """Bins by row and feature; null and NaN are above all edges."""
    columns = [batch.column(first + i).to_numpy(zero_copy_only=False).astype(float) for i in range(len(edges))]
    return np.stack([np.searchsorted(e, np.where(np.isnan(x), np.inf, x), side="left") for e, x in zip(edges, columns, strict=True)], axis=1).astype(np.uint8)


def _bytes(x: np.ndarray) -> pa.Array:
    """A binary value per row of a byte matrix."""
    ends = np.arange(len(x) + 1) * x.shape[1]
    return pa.Array.from_buffers(pa.binary(), len(x), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(x))])


def _byte_rows(values: pa.Array, n: int) -> np.ndarray:
    """The byte matrix of binary values of ``n`` bytes each, none of them null."""
    data = values.buffers()[2]
    first = np.frombuffer(values.buffers()[1], np.int32, 1, values.offset * 4)[0] if len(values) else 0
    return np.frombuffer(data, np.uint8, len(values) * n, first).reshape(len(values), n) if data is not None else np.zeros((len(values), n), np.uint8)


def binned_rows(train: DataFrame, features: Sequence[str], edges: list[np.ndarray]) -> DataFrame:
    """key (hash of the row's keys), y and x, a byte per feature, stored. Rows without label are left out."""

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            x = _binned(batch, edges, 2)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), _bytes(x)], names=["key", "y", "x"])

    rows = train.where("label is not null").select(F.xxhash64(*KEYS).alias("key"), F.col("label").cast("int").alias("y"), *[F.col(f"`{c}`").cast("double").alias(f"_{i}") for i, c in enumerate(features)])
    return stored(rows.mapInArrow(run, "key long, y int, x binary"), "binned")


def drawn_weights(keys: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """How often each row is in the sample of a tree: Poisson draws of mean 1 by hash."""
    h = keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64((tree * 0xBF58476D1CE4E5B9 + seed * 0x94D049BB133111EB + 1) & MASK)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    u = ((h ^ (h >> np.uint64(31))) >> np.uint64(11)).astype(float) / (1 << 53)
    return np.searchsorted(np.cumsum([math.exp(-1) / math.factorial(k) for k in range(12)]), u, side="right").astype(float)


def _impurity(w0, w1, criterion: str):
    """Larger is purer: a share of the weight that is correct by the criterion."""
    n = w0 + w1
    with np.errstate(divide="ignore", invalid="ignore"):
        if criterion == "gini":
            return np.where(n > 0, (w0 * w0 + w1 * w1) / n, 0.0)
        plogp = lambda w: np.where(w > 0, w * np.log2(w / n), 0.0)
        return plogp(w0) + plogp(w1)


def best_split(h: np.ndarray, features: np.ndarray, criterion: str) -> tuple[int, int] | None:
    """(feature, bin) of the best split by a histogram (feature, bin, class), or None if nothing gains."""
    left = h.cumsum(axis=1)[:, :-1]
    total = h[0].sum(axis=0)
    right = total - left
    score = _impurity(left[..., 0], left[..., 1], criterion) + _impurity(right[..., 0], right[..., 1], criterion)
    score[(left.sum(axis=2) <= 0) | (right.sum(axis=2) <= 0)] = -np.inf
    allowed = np.full(len(h), -np.inf)
    allowed[features] = 0.0
    score = score + allowed[:, None]
    if not score.size or score.max() <= _impurity(total[0], total[1], criterion):
        return None
    f, b = np.unravel_index(int(score.argmax()), score.shape)
    return int(f), int(b)


def _features_of(tree: int, node: int, n: int, s: TreeSettings) -> np.ndarray:
    if s.max_features is None or s.max_features >= n:
        return np.arange(n)
    return np.random.default_rng([s.seed, tree, node]).permutation(n)[: s.max_features]


def _leaf(w0: float, w1: float, depth: int, s: TreeSettings) -> bool:
    return w0 <= 0 or w1 <= 0 or w0 + w1 < s.min_samples_split or (s.max_depth is not None and depth >= s.max_depth)


def histogram(x: np.ndarray, y: np.ndarray, w: np.ndarray, bins: int) -> np.ndarray:
    """Class weights by feature and bin, as doubles (numpy counts no rows in integers, even with weights)."""
    n = x.shape[1]
    at = (x.astype(np.int64) + np.arange(n) * bins) * 2 + y[:, None]
    return np.bincount(at.ravel(), np.repeat(w, n), n * bins * 2).astype(float).reshape(n, bins, 2)


def grow(x: np.ndarray, y: np.ndarray, w: np.ndarray, tree: int, node: int, depth: int, bins: int, s: TreeSettings) -> list[tuple]:
    """Rows (tree, node, feature, bin, w0, w1) of the subtree of a node, from all its rows."""
    out, todo = [], [(node, depth, np.arange(len(y)))]
    while todo:
        node, depth, at = todo.pop()
        w1 = float(w[at] @ y[at])
        w0 = float(w[at].sum()) - w1
        split = None if _leaf(w0, w1, depth, s) else best_split(histogram(x[at], y[at], w[at], bins), _features_of(tree, node, x.shape[1], s), s.criterion)
        if split is None:
            out.append((tree, node, -1, 0, w0, w1))
            continue
        out.append((tree, node, *split, w0, w1))
        right = x[at, split[0]] > split[1]
        todo += [(child(node, False), depth + 1, at[~right]), (child(node, True), depth + 1, at[right])]
    return out


@dataclass
class Trees:
    """Grown trees: edges by feature, and nodes as rows of NODES."""

    edges: list[np.ndarray]
    nodes: list[tuple] = field(default_factory=list)
    n_trees: int = 1

    def tables(self) -> list[dict[int, tuple]]:
        out: list[dict[int, tuple]] = [{} for _ in range(self.n_trees)]
        for tree, node, feature, b, w0, w1 in self.nodes:
            out[tree][node] = (feature, b, w0, w1)
        return out

    def depth(self) -> int:
        deepest = 0
        for table in self.tables():
            level = [ROOT]
            d = -1
            while level:
                d += 1
                level = [child(k, side) for k in level if table[k][0] >= 0 for side in (False, True)]
            deepest = max(deepest, d)
        return deepest

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        """Mean share of class 1 in the leaves of binned rows."""
        total = np.zeros(len(x))
        for table in self.tables():
            todo = [(ROOT, np.arange(len(x)))]
            while todo:
                node, at = todo.pop()
                feature, b, w0, w1 = table[node]
                if feature < 0:
                    total[at] += w1 / (w0 + w1) if w0 + w1 > 0 else 0.5
                elif len(at):
                    right = x[at, feature] > b
                    todo += [(child(node, False), at[~right]), (child(node, True), at[right])]
        return total / max(1, self.n_trees)

    def importances(self, n_features: int, criterion: str = "gini") -> np.ndarray:
        """Gain in purity by feature, as shares of a tree's whole gain, averaged over trees that split."""
        out, splitting = np.zeros(n_features), 0
        for table in self.tables():
            gain = np.zeros(n_features)
            for node, (feature, _, w0, w1) in table.items():
                if feature >= 0:
                    parts = [table[child(node, side)][2:] for side in (False, True)]
                    gain[feature] += sum(float(_impurity(*map(np.float64, p), criterion)) for p in parts) - float(_impurity(np.float64(w0), np.float64(w1), criterion))
            if gain.sum() > 0:
                out, splitting = out + gain / gain.sum(), splitting + 1
        return out / max(1, splitting)


def _open_nodes(table: dict[int, tuple], open_: set[int], x: np.ndarray) -> dict[int, np.ndarray]:
    """Rows in each open node, by a walk down the splits found so far."""
    out, todo = {}, [(ROOT, np.arange(len(x)))]
    while todo:
        node, at = todo.pop()
        if node in open_:
            out[node] = at
        elif node in table and table[node][0] >= 0 and len(at):
            right = x[at, table[node][0]] > table[node][1]
            todo += [(child(node, False), at[~right]), (child(node, True), at[right])]
    return out


def _matrix(batch: pa.RecordBatch, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    x = _byte_rows(batch.column("x"), n)
    return batch.column("key").to_numpy(), batch.column("y").to_numpy().astype(np.int64), x


def fit_trees(train: DataFrame, features: Sequence[str], s: TreeSettings) -> Trees:
    """Trees on rows with entity_id, as_of_date, a boolean ``label`` and the features."""
    if not 2 <= s.max_bins <= 256:
        raise ValueError("max_bins is between 2 and 256")
    edges = bin_edges(train, features, s.max_bins)
    rows = binned_rows(train, features, edges)
    n, bins = len(features), max((len(e) for e in edges), default=0) + 1
    done: list[dict[int, tuple]] = [{} for _ in range(s.n_trees)]
    open_: dict[tuple[int, int], int] = {(t, ROOT): 0 for t in range(s.n_trees)}  # depth of nodes to be split
    small: dict[tuple[int, int], int] = {}  # depth of nodes to be finished
    weight = lambda keys, tree: drawn_weights(keys, tree, s.seed) if s.bootstrap else np.ones(len(keys))

    while open_:
        wanted = [{k for t, k in open_ if t == tree} for tree in range(s.n_trees)]

        def count(batches: Iterator[pa.RecordBatch], wanted=wanted):
            for batch in batches:
                keys, y, x = _matrix(batch, n)
                for tree, nodes in enumerate(wanted):
                    if nodes:
                        w = weight(keys, tree)
                        for node, at in _open_nodes(done[tree], nodes, x).items():
                            h = histogram(x[at], y[at], w[at], bins).ravel()
                            cell = np.flatnonzero(h)
                            same = lambda v, k, m=len(cell): pa.array(np.full(m, v), k)
                            yield pa.RecordBatch.from_arrays([same(tree, pa.int32()), same(node, pa.int64()), pa.array(cell), pa.array(h[cell])], names=["tree", "node", "cell", "w"])

        cells = rows.mapInArrow(count, "tree int, node long, cell long, w double").groupBy("tree", "node", "cell").agg(F.sum("w").alias("w"))
        depths = dict(open_)

        def choose(key, group):
            tree, node = (k.as_py() for k in key)
            h = np.zeros(n * bins * 2)
            h[group.column("cell").to_numpy()] = group.column("w").to_numpy()
            h = h.reshape(n, bins, 2)
            w0, w1 = h[0].sum(axis=0).tolist()
            if w0 + w1 <= s.finish_rows and not _leaf(w0, w1, depths[tree, node], s):
                split = (-2, 0)
            else:
                split = (None if _leaf(w0, w1, depths[tree, node], s) else best_split(h, _features_of(tree, node, n, s), s.criterion)) or (-1, 0)
            return pa.table([[tree], [node], [split[0]], [split[1]], [w0], [w1]], schema=pa.schema([("tree", pa.int32()), ("node", pa.int64()), ("feature", pa.int32()), ("bin", pa.int32()), ("w0", pa.float64()), ("w1", pa.float64())]))

        chosen = cells.groupBy("tree", "node").applyInArrow(choose, NODES).collect()
        if not chosen:  # no row at all
            done = [{ROOT: (-1, 0, 0.0, 0.0)} for _ in range(s.n_trees)]
            break
        for r in chosen:
            depth = open_.pop((r.tree, r.node))
            if r.feature == -2:
                small[r.tree, r.node] = depth
                continue
            done[r.tree][r.node] = (r.feature, r.bin, r.w0, r.w1)
            if r.feature >= 0:
                open_.update({(r.tree, child(r.node, side)): depth + 1 for side in (False, True)})
        for tree, node in open_.keys() & depths.keys():  # a drawn sample without rows
            done[tree][node] = (-1, 0, 0.0, 0.0)
            del open_[tree, node]

    nodes = [(tree, k, *v) for tree, table in enumerate(done) for k, v in table.items()]
    if small:
        wanted = [{k for t, k in small if t == tree} for tree in range(s.n_trees)]

        def deal(batches: Iterator[pa.RecordBatch]):
            for batch in batches:
                keys, y, x = _matrix(batch, n)
                for tree, ends in enumerate(wanted):
                    if ends:
                        w = weight(keys, tree)
                        for node, at in _open_nodes(done[tree], ends, x).items():
                            at = at[w[at] > 0]
                            same = lambda v, k, m=len(at): pa.array(np.full(m, v), k)
                            yield pa.RecordBatch.from_arrays(
                                [same(tree, pa.int32()), same(node, pa.int64()), pa.array(keys[at]), pa.array(y[at].astype(np.int32)), _bytes(x[at]), pa.array(w[at])],
                                names=["tree", "node", "key", "y", "x", "w"],
                            )

        def finish(key, group):
            tree, node = (k.as_py() for k in key)
            x = np.frombuffer(b"".join(group.column("x").to_pylist()), np.uint8).reshape(group.num_rows, n)
            found = grow(x, group.column("y").to_numpy().astype(np.int64), group.column("w").to_numpy(), tree, node, small[tree, node], bins, s)
            kinds = [pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.float64(), pa.float64()]
            return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(zip(*found, strict=True), kinds, strict=True)], names=["tree", "node", "feature", "bin", "w0", "w1"])

        dealt = rows.mapInArrow(deal, "tree int, node long, key long, y int, x binary, w double")
        nodes += [tuple(r) for r in dealt.groupBy("tree", "node").applyInArrow(finish, NODES).collect()]
    return Trees(edges, sorted(nodes), s.n_trees)


def score_trees(matrix: DataFrame, features: Sequence[str], trees: Trees) -> DataFrame:
    """entity_id, as_of_date and score of every row."""

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(trees.probabilities(_binned(batch, trees.edges, 2)))], names=[*KEYS, "score"])

    rows = matrix.select(*KEYS, *[F.col(f"`{c}`").cast("double").alias(f"_{i}") for i, c in enumerate(features)])
    kinds = ", ".join(f"{c} {matrix.schema[c].dataType.simpleString()}" for c in KEYS)
    return rows.mapInArrow(run, f"{kinds}, score double")


def save_trees(spark: SparkSession, trees: Trees, path: str) -> None:
    """Nodes and edges as two tables below ``path``."""
    spark.createDataFrame(trees.nodes, NODES).write.mode("overwrite").parquet(f"{path}/nodes")
    spark.createDataFrame([(i, e.tolist(), trees.n_trees) for i, e in enumerate(trees.edges)], "feature int, edges array<double>, n_trees int").write.mode("overwrite").parquet(f"{path}/edges")


def load_trees(spark: SparkSession, path: str) -> Trees:
    edges = spark.read.parquet(f"{path}/edges").orderBy("feature").collect()
    nodes = sorted(tuple(r) for r in spark.read.parquet(f"{path}/nodes").select("tree", "node", "feature", "bin", "w0", "w1").collect())
    return Trees([np.array(r.edges, float) for r in edges], nodes, edges[0].n_trees if edges else 1)


def boosted_splits(train: DataFrame, features: Sequence[str], rounds: int, learning_rate: float, max_bins: int = 256, store_every: int = 50):
    """(alpha, feature or None, edge, left vote, right vote) of every boosting round (discrete SAMME).

    Each round is one small aggregate: class weights by feature and bin, weighted by the rounds
    before. Weights are written every ``store_every`` rounds, so that a pass repeats few votes.
    """
    edges = bin_edges(train, features, max_bins)
    n, bins = len(features), max((len(e) for e in edges), default=0) + 1
    rows = binned_rows(train, features, edges).withColumn("w", F.lit(1.0))
    out, votes = [], []  # votes since the weights were written: (factor, feature, bin, left, right)

    def weights(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> np.ndarray:
        for alpha, feature, b, left, right in votes:
            says = np.full(len(y), left) if feature < 0 else np.where(x[:, feature] <= b, left, right)
            w = w * np.exp(alpha * (says != y))
        return w

    def count(batches: Iterator[pa.RecordBatch]):
        total = np.zeros(n * bins * 2)
        for batch in batches:
            _, y, x = _matrix(batch, n)
            total += histogram(x, y, weights(x, y, batch.column("w").to_numpy()), bins).ravel()
        cell = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(total[cell])], names=["cell", "w"])

    def weighted(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            _, y, x = _matrix(batch, n)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(weights(x, y, batch.column("w").to_numpy()))], names=["key", "y", "x", "w"])

    for i in range(rounds):
        h = np.zeros(n * bins * 2)
        for r in rows.mapInArrow(count, "cell long, w double").groupBy("cell").agg(F.sum("w").alias("w")).collect():
            h[r.cell] = r.w
        h = h.reshape(n, bins, 2)
        total = h[0].sum(axis=0)
        split = best_split(h, np.arange(n), "gini")
        if split is None:
            f, b, sides = -1, 0, [total, total]
        else:
            f, b = split
            left = h[f, : b + 1].sum(axis=0)
            sides = [left, total - left]
        says = [int(side[1] > side[0]) for side in sides]
        wrong = total[1 - says[0]] if f < 0 else sum(side[1 - v] for side, v in zip(sides, says, strict=True))
        error = float(wrong / total.sum()) if total.sum() > 0 else 0.5
        named = (None, 0.0) if f < 0 else (features[f], float(edges[f][b]))
        if error >= 0.5:
            break
        if error <= 0.0:
            out.append((1.0, *named, float(says[0]), float(says[1])))
            break
        alpha = learning_rate * math.log((1.0 - error) / error)
        out.append((alpha, *named, float(says[0]), float(says[1])))
        votes.append((alpha, f, b, *says))
        if len(votes) >= store_every and i + 1 < rounds:
            rows = stored(rows.mapInArrow(weighted, "key long, y int, x binary, w double"), "weighted")
            votes.clear()
    return out
