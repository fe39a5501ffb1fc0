import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import spelling
from tidemark.llm.filters import key_filter
from tidemark.session import stored


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(rows, slip=97):
    counts = Counter()
    for k, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if k is None else k}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % slip == 0 else run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= 5 and c >= 3}
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= 2 * n[w] else None

    def root(w):
        return root(form[w]) if form[w] else w

    return {w: (form[w], root(w), n[w], len(near[w]), n.get(form[w])) for w in n}


def found(spark, rows, slip=97):
    out = spelling.spelling_variants(spark.createDataFrame(rows, "doc_id long, text string"), slip=slip).collect()
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in out}
    assert len(got) == len(out)
    return got


def corpus(seed):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abéÀñz") for _ in range(rng.randint(4, 8))) for _ in range(60)]
    texts = [" ".join(rng.choice(words).capitalize() if rng.random() < 0.1 else words[min(59, int(rng.expovariate(0.1)))] for _ in range(rng.randint(0, 120))) for _ in range(60)]
    long = "".join(rng.choice("ab") for _ in range(3000))
    texts += [f"{long} {long} {long} {long[:700]}x{long[700:]}, {long[:700]}x{long[700:]};{long[:700]}x{long[700:]}"] * 2
    return [*enumerate(texts), (None, "vowel vowel vowel vowels vowels vowels"), (3, None), (4, ""), (5, "aaaaàaaaaa")]


@pytest.mark.parametrize("slip", [97, 3])
def test_equals_brute_force(spark, slip):
    rows = corpus(slip)
    want = brute(rows, slip)
    assert any(v[0] for v in want.values()) and found(spark, rows, slip) == want


def test_chains_and_ties(spark):
    text = " ".join(["abcdef"] * 40 + ["abcdeg"] * 20 + ["abcdh"] * 3 + ["abcdeh"] * 12 + ["zbcdeh"] * 6 + ["zzcdeh"] * 3 + ["qqqqqa"] * 4 + ["qqqqqb"] * 8 + ["qqqqqc"] * 8)
    got = found(spark, [(1, text)], slip=1 << 33)
    assert got == brute([(1, text)], slip=1 << 33)
    assert got["zzcdeh"][:2] == ("zbcdeh", "abcdef") and got["qqqqqa"][0] == "qqqqqb" and got["abcdef"][0] is None


def test_neighbourhoods_are_full_and_without_repeats():
    def all_of(word):
        s = range(1, spelling.SYMBOLS + 1)
        out = {word} | {word[:i] + word[i + 1 :] for i in range(len(word))}
        out |= {word[:i] + (c,) + word[i + 1 :] for i in range(len(word)) for c in s}
        return out | {word[:i] + (c,) + word[i:] for i in range(len(word) + 1) for c in s}

    rng = random.Random(1)
    for n in (1, 2, 5, 9):
        words = [tuple(rng.randint(1, 3) for _ in range(n)) for _ in range(7)]
        got = [[] for _ in words]
        for rows, hashes in spelling.neighbourhoods(np.array(words, np.uint64)):
            for i, h in zip(rows, hashes, strict=True):
                got[i].append(int(h))
        for word, hashes in zip(words, got, strict=True):
            want = {int(spelling.word_hashes(np.array([w], np.uint64))[0]) if w else 0 for w in all_of(word)}
            assert len(hashes) == len(set(hashes)) and set(hashes) == want


def test_odd_rows(spark, odd_docs, no_docs):
    assert found(spark, [(r.doc_id, r.text) for r in odd_docs.collect()]) == brute([(r.doc_id, r.text) for r in odd_docs.collect()])
    assert spelling.spelling_variants(odd_docs).columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert spelling.spelling_variants(no_docs).count() == 0


def test_filter_denies_no_key(spark):
    keys = np.random.default_rng(1).integers(-(1 << 63), (1 << 63) - 1, 3000)
    held = key_filter(spark.createDataFrame([(int(k),) for k in keys[:1000]], "key long"))
    assert held.may_hold(keys[:1000]).all() and held.may_hold(keys[1000:]).mean() < 0.05
    full = key_filter(spark.createDataFrame([(int(k),) for k in keys], "key long"), most_bits=64)
    assert full.may_hold(keys).all()


def test_neighbours_are_joined_by_exchange(spark):
    # a small file, of which each word has many neighbours: Spark's estimate says broadcast
    words = stored(spelling._with_hashes(spark.range(300).select(F.concat(F.lit("wort"), F.col("id").cast("string")).alias("word"), F.col("id").alias("n"))), "words")
    near = spelling.near_words(words)
    assert "Broadcast" not in near._jdf.queryExecution().executedPlan().toString()
    assert {(r.word, r.near) for r in near.collect()} == {(f"wort{a}", f"wort{b}") for a in range(300) for b in range(300) if one_edit(str(a), str(b))}
