import random
from datetime import date

import numpy as np
import pytest

from tidemark.operators import learners as ln
from tidemark.operators import trees as tr

FEATURES = ["a", "b", "c"]


def make(spark, n=600, seed=1, levels=25):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        x = [float(rng.randrange(levels)) for _ in FEATURES]
        y = (x[0] > 8) ^ (x[1] <= 5) ^ (rng.random() < 0.2)
        rows.append((i, date(2020, 1, 1), bool(y), *x))
    return rows, spark.createDataFrame(rows, "entity_id long, as_of_date date, label boolean, a double, b double, c double").repartition(4)


def brute(rows, depth, most=None, least=2):
    """Gini tree over all observed values: nested (feature, threshold, left, right) or (n0, n1)."""
    n1 = sum(r[2] for r in rows)
    n0 = len(rows) - n1
    pure = lambda a, b: (a * a + b * b) / (a + b)
    best = None
    if n0 and n1 and len(rows) >= least and (most is None or depth < most):
        for f in range(3):
            for v in sorted({r[3 + f] for r in rows})[:-1]:
                left = [r for r in rows if r[3 + f] <= v]
                l1 = sum(r[2] for r in left)
                score = pure(len(left) - l1, l1) + pure(n0 - len(left) + l1, n1 - l1)
                if best is None or score > best[0]:
                    best = (score, f, v)
    if best is None or best[0] <= pure(n0, n1):
        return (n0, n1)
    _, f, v = best
    return (f, v, brute([r for r in rows if r[3 + f] <= v], depth + 1, most, least), brute([r for r in rows if r[3 + f] > v], depth + 1, most, least))


def shown(trees, node=tr.ROOT, tree=0):
    feature, b, w0, w1 = trees.tables()[tree][node]
    if feature < 0:
        return (w0, w1)
    return (feature, trees.edges[feature][b], shown(trees, tr.child(node, False), tree), shown(trees, tr.child(node, True), tree))


@pytest.mark.parametrize(("most", "finish"), [(2, 0), (None, 100), (None, 10_000), (4, 50)])
def test_equals_a_brute_force_tree(spark, most, finish):
    rows, train = make(spark, 300)
    trees = tr.fit_trees(train, FEATURES, tr.TreeSettings(max_depth=most, finish_rows=finish))
    assert shown(trees) == brute(rows, 0, most)


def test_depth_is_not_limited(spark):
    """A staircase of alternating labels needs one level per step."""
    n = 120
    rows = [(i, date(2020, 1, 1), i % 2 == 0, float(i), 0.0, 0.0) for i in range(n)]
    rows += [(1000 + 200 * i + j, date(2020, 1, 1), i % 2 == 0, float(i), 0.0, 0.0) for i in range(n) for j in range(i)]
    train = spark.createDataFrame(rows, "entity_id long, as_of_date date, label boolean, a double, b double, c double")
    deep = tr.fit_trees(train, FEATURES, tr.TreeSettings(max_depth=250))
    cut = tr.fit_trees(train, FEATURES, tr.TreeSettings(max_depth=31))
    assert cut.depth() == 31 < deep.depth() <= 250
    x = np.array([[i, 0, 0] for i in range(n)], np.uint8)
    assert (deep.probabilities(x) == [i % 2 == 0 for i in range(n)]).all() and not (cut.probabilities(x) == deep.probabilities(x)).all()


def test_forest_is_repeatable_and_learns(spark, tmp_path):
    rows, train = make(spark, 900, levels=400)
    params = {"n_estimators": 12, "max_depth": 100, "max_features": "sqrt", "min_samples_split": 10}
    fitted = ln.fit(train, FEATURES, "RandomForestClassifier", params, seed=3)
    again = ln.fit(train.repartition(7), FEATURES, "RandomForestClassifier", params, seed=3)
    assert fitted.model.nodes == again.model.nodes and len({tuple(shown(fitted.model, tree=t)) for t in range(12)}) > 6
    scores = {r.entity_id: r.score for r in fitted.score(train).collect()}
    right = sum((scores[r[0]] >= 0.5) == r[2] for r in rows)
    assert right > 0.8 * len(rows) and all(0 <= s <= 1 for s in scores.values())
    own = {r.feature_name: r.feature_importance for r in fitted.importances(spark).collect()}
    assert sum(own.values()) == pytest.approx(1) and own["c"] < own["a"]
    ln.save(fitted, str(tmp_path / "m"))
    loaded = ln.load(spark, str(tmp_path / "m"), "RandomForestClassifier", FEATURES, params)
    assert loaded.model.nodes == fitted.model.nodes and {r.entity_id: r.score for r in loaded.score(train).collect()} == scores
    drawn = tr.drawn_weights(np.arange(100_000), 1, 0)
    assert drawn.mean() == pytest.approx(1, abs=0.02) and drawn.var() == pytest.approx(1, abs=0.03)


def test_batches_without_rows_of_a_node(spark):
    """Rows come sorted in small batches, so that most batches have no row of most nodes."""
    rows = [(i, date(2020, 1, 1), (i // 50) % 2 == 0, float(i // 50), float(i % 7), 0.0) for i in range(400)]
    train = spark.createDataFrame(rows, "entity_id long, as_of_date date, label boolean, a double, b double, c double").coalesce(1).sortWithinPartitions("a")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 40)
    try:
        trees = tr.fit_trees(train, FEATURES, tr.TreeSettings(max_depth=5, finish_rows=0))
        forest = ln.fit(train, FEATURES, "RandomForestClassifier", {"n_estimators": 5, "max_depth": 3})
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert shown(trees) == brute(rows, 0, 5)
    assert sum(r.feature_importance for r in forest.importances(spark).collect()) == pytest.approx(1)
    assert tr.histogram(np.zeros((0, 3), np.uint8), np.zeros(0, np.int64), np.zeros(0), 4).dtype == float


def test_features_with_few_values_get_no_quantile_summaries(spark, monkeypatch):
    """A summary holds up to a million numbers per task, a 0/1 column needs none."""
    rows = [(float(i % 2), float(i % 400), float(i % 9), None) for i in range(4_000)]
    train = spark.createDataFrame(rows, "a double, b double, c double, d double")
    asked, real = [], tr.F.percentile_approx
    monkeypatch.setattr(tr.F, "percentile_approx", lambda column, *rest: asked.append(column) or real(column, *rest))
    edges = tr.bin_edges(train, ["a", "b", "c", "d"], 256)
    assert len(asked) == 1
    assert [len(e) for e in edges] == [1, 255, 8, 0] and edges[2].tolist() == [float(i) for i in range(8)]
    x = np.arange(21, dtype=np.uint8).reshape(7, 3)
    assert tr._bytes(x).to_pylist() == [r.tobytes() for r in x]
    assert (tr._byte_rows(tr._bytes(x)[2:5], 3) == x[2:5]).all() and tr._byte_rows(tr._bytes(x)[:0], 3).shape == (0, 3)


def test_odd_inputs(spark):
    schema = "entity_id long, as_of_date date, label boolean, a double, b double, c double"
    empty = spark.createDataFrame([], schema)
    trees = tr.fit_trees(empty, FEATURES, tr.TreeSettings())
    row = spark.createDataFrame([(1, date(2020, 1, 1), True, None, float("nan"), 1.0)], schema)
    assert tr.score_trees(row, FEATURES, trees).first().score == 0.5
    one = tr.fit_trees(row.unionByName(row.selectExpr("entity_id", "as_of_date", "cast(null as boolean) as label", "a", "b", "c")), FEATURES, tr.TreeSettings())
    assert shown(one) == (0.0, 1.0) and tr.score_trees(row, FEATURES, one).first().score == 1.0


def brute_boost(rows, rounds, rate):
    w, out = {r[0]: 1.0 for r in rows}, []
    for _ in range(rounds):
        best = None
        total = [sum(w[r[0]] for r in rows if r[2] == k) for k in (False, True)]
        pure = lambda a, b: (a * a + b * b) / (a + b)
        for f in range(3):
            for v in sorted({r[3 + f] for r in rows})[:-1]:
                left = [sum(w[r[0]] for r in rows if r[2] == k and r[3 + f] <= v) for k in (False, True)]
                right = [t - x for t, x in zip(total, left, strict=True)]
                score = pure(*left) + pure(*right)
                if best is None or score > best[0] + 1e-9:
                    best = (score, f, v, float(left[1] > left[0]), float(right[1] > right[0]))
        _, f, v, left, right = best
        wrong = {r[0] for r in rows if (left if r[3 + f] <= v else right) != r[2]}
        error = sum(w[k] for k in wrong) / sum(w.values())
        if error >= 0.5:
            break
        alpha = rate * np.log((1 - error) / error)
        out.append((alpha, FEATURES[f], v, left, right))
        w = {k: x * np.exp(alpha * (k in wrong)) for k, x in w.items()}
    return out


@pytest.mark.parametrize("every", [2, 50])
def test_boosted_stumps_equal_brute_force(spark, every):
    rows, train = make(spark, 250, seed=4)
    got = tr.boosted_splits(train, FEATURES, 7, 0.5, store_every=every)
    want = brute_boost(rows, 7, 0.5)
    assert len(got) == len(want) > 3
    for g, w in zip(got, want, strict=True):
        assert g[0] == pytest.approx(w[0]) and g[1:] == w[1:]
