import random
import re

import pytest

from tidemark.llm import minhash
from tidemark.llm.components import connected_components


def exact(rows, size, percent):
    """Components over all pairs, from word sets."""
    sets = {}
    for k, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[k] = {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())
    parent = {k: k for k in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                parent[max(root(a), root(b))] = min(root(a), root(b))
    return {k: (len(sets[k]), root(k), root(k) == k) for k in keys}


def corpus(seed=1):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    texts = []
    for _ in range(12):  # clusters of edited copies, some near the threshold
        base = [word() for _ in range(rng.randint(4, 120))]
        for _ in range(rng.randint(1, 12)):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 9))):
                copy[rng.randrange(len(copy))] = word()
            texts.append(" ".join(copy))
    shared = " ".join(word() for _ in range(60))  # a passage that many texts hold
    texts += [" ".join(word() for _ in range(40)) + " " + shared for _ in range(30)]
    texts += ["A B", "a b", "b a", "a", "A", "", None, "hot copy of a text"] + ["hot copy of a text"] * 60
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize(("size", "percent"), [(2, 80), (5, 80), (2, 60)])
def test_components_equal_all_pairs(spark, size, percent):
    rows = corpus(size)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(docs, size, percent).collect()}
    assert got == exact(rows, size, percent)


def test_a_chain_of_links_is_one_component(spark):
    words = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join(words[3 * i : 3 * i + 100])) for i in range(30)]
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {k: v[1] for k, v in exact(rows, 2, 80).items()} and set(got.values()) == {0}


def test_odd_rows(spark, odd_docs, no_docs):
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(odd_docs).collect()), key=str)
    want = [(0, 0, 0, True), (1, 0, 1, True), (2, 0, 2, True), (3, 1, 3, True), (None, 2, None, True), (5, 2, 5, True), (5, 2, 5, True), (6, 1, 6, True), (7, 4, 7, True), (8, 3, 8, True), (9, 2, 9, True)]
    assert got == sorted(want, key=str)
    assert minhash.near_duplicates(no_docs).count() == 0


def test_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (7, 7), (None, 3), (101, 100)], "a long, b long")
    got = {r.node: r.component for r in connected_components(edges).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


def test_first_shingles_miss_no_pair(spark):
    rng = random.Random(5)
    base = [f"w{i}" for i in range(150)]
    sets = {k: set(minhash.shingles(" ".join(w for w in base if rng.random() > 0.06), 2).tolist()) for k in range(60)}
    rows = [(k, k % 5, b"".join(x.to_bytes(8, "little") for x in sorted(s))) for k, s in sets.items()]
    for percent in (60, 80, 95):
        got = [(r.a, r.b) for r in minhash._prefix_pairs(spark.createDataFrame(rows, "node long, component long, items binary"), percent).collect()]
        near = {(a, b) for a in sets for b in sets if a < b and a % 5 != b % 5 and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])}
        assert len(got) == len(set(got)) and near <= set(got) and all(a % 5 != b % 5 for a, b in got)


def test_one_id_with_two_texts(spark):
    one, two = " ".join(f"a{i}" for i in range(60)), " ".join(f"b{i}" for i in range(60))
    rows = [(1, one), (1, two), (2, one + " x"), (3, two + " y"), (3, "c d e f"), (0, two + " z")]
    got = {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(1, 59, 1, True), (2, 60, 1, False), (1, 59, 0, False), (3, 60, 0, False), (0, 60, 0, True), (3, 3, 3, True)}


def test_copies_around_one_text_meet_few_others(spark, monkeypatch):
    rng = random.Random(3)
    base = [f"w{i}" for i in range(100)]
    rows = []
    for k in range(240):  # two copies are about as similar as the threshold, and each is closer to the base
        copy = list(base)
        for _ in range(rng.randint(1, 6) if k != 100 else 0):
            copy[rng.randrange(100)] = f"x{rng.random()}"
        rows.append((k, " ".join(copy)))
    compared = []
    confirmed = minhash._confirmed
    monkeypatch.setattr(minhash, "_confirmed", lambda pairs, sets, percent: compared.append(pairs.count()) or confirmed(pairs, sets, percent))
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == exact(rows, 2, 80)
    assert sum(compared) <= 2 * len(rows), compared
