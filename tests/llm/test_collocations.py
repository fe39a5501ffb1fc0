import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from tidemark.llm import collocations
from tidemark.llm.filters import KeyFilter, key_filter


def brute(rows, longest=5, least=100, most=2000):
    f, n = {}, Counter()
    for _, lang, text in rows:
        lang = lang or "und"
        for piece in re.split("[.,;:!?\x0a-\x0d]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    f.setdefault(lang, Counter())[tuple(words[i : i + k])] += 1
    out = set()
    for lang, of in f.items():
        frequent = {p: c for p, c in of.items() if c >= least and len(p) > 1}
        inside = {q[i : i + k] for q, c in frequent.items() for k in range(2, len(q)) for i in range(len(q) - k + 1) if c == of[q[i : i + k]]}
        scored = []
        for p, a in frequent.items():
            if p not in inside:
                score, _, left, right = min((1000 * a * n[lang] // (of[p[:k]] * of[p[k:]]), k, of[p[:k]], of[p[k:]]) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:most], 1):
            out.add((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return out


def found(spark, rows, **settings):
    got = collocations.collocations(spark.createDataFrame(rows, "doc_id long, lang string, text string"), **settings).collect()
    assert len(set(got)) == len(got)
    return set(map(tuple, got))


def corpus(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(12)] + ["Éa", "日本", "\x0bx", "#1"]
    fixed = ["New York city hall", "w1 w2 w3 w4 w5 w6", "a a a a"]
    rows = []
    for i in range(80):
        text = []
        for _ in range(rng.randint(0, 60)):
            text.append(rng.choice(fixed) if rng.random() < 0.2 else rng.choice(words))
            text.append(rng.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n", "\r", ";"]))
        rows.append((i, rng.choice(["en", "en", "de", None]), "".join(text)))
    return [*rows, (900, "en", None), (None, "en", "new york"), (901, "fr", ""), *rows[:3]]


@pytest.mark.parametrize(("shards", "least"), [(4, 6), (1, 6), (3, 20)])
def test_equals_brute_force(spark, shards, least):
    rows = corpus(shards)
    want = brute(rows, least=least, most=50)
    assert {len(p[2].split()) for p in want} >= {2, 3} and found(spark, rows, shards=shards, least=least, most=50) == want


def test_late_words_complete_a_cycle(spark):
    """Phrases that reach the threshold only with the last shard are still counted in all."""
    rows = [(i, "en", f"rare thing here {i}") for i in range(30)]
    assert found(spark, rows, least=30) == brute(rows, least=30)


def test_phrases_of_one_text_get_their_words(spark):
    """Each phrase is in one text only, so every part of the texts has some."""
    rows = [(i, "en" if i % 3 else "de", f"p{i} q{i} r{i}, " * 7) for i in range(60)]
    want = brute(rows, least=7)
    assert len(want) == 60 and found(spark, rows, least=7) == want


def test_a_task_spells_a_phrase_once(spark):
    """However many blocks it is in; only what is wanted, known or not, is spelled."""
    text = "aa bb cc, dd ee. " * 220_000
    assert len(text) > 3 * collocations.BLOCK
    every = KeyFilter(np.full(1, ~np.uint64(0)))
    texts = spark.createDataFrame([(1, "en", text)], "doc_id long, lang string, text string").coalesce(1)
    got = collocations._spelled(texts, 3, every, every).collect()
    assert sorted(r.phrase for r in got) == ["", "aa", "aa bb", "aa bb cc", "bb", "bb cc", "cc", "dd", "dd ee", "ee"]
    only = [r.key for r in got if r.phrase == "bb cc"]
    got = collocations._spelled(texts, 3, every, key_filter(spark.createDataFrame([(only[0],)], "key long"))).collect()
    assert "bb cc" in {r.phrase for r in got} and len(got) < 10


def test_keys_that_share_a_place_are_told_again():
    told = collocations.Told(2)
    for keys, new in (([0, 1 << 62], [True, True]), ([1, 1 << 62], [True, False]), ([0, 3 << 62], [True, True]), ([0], [False])):
        assert told.new(np.array(keys, np.uint64)).tolist() == new


def test_blocks_see_every_phrase_once():
    text = [b"a b c d e f g, h i j k l", b"m n o p q r s t u v w x y z " * 3]
    whole = [w for words, new in collocations.blocks(text, 5) for w in words]
    for size in (1, 7, 20):
        parts, seen = [], Counter()
        for words, new in collocations.blocks(text, 5, size):
            parts += words[len(words) - new :]
            for k in range(1, 6):
                for i in range(len(words) - k + 1):
                    if i + k > len(words) - new:
                        seen[tuple(words[i : i + k])] += 1
        assert parts == whole
        assert seen == Counter(tuple(whole[i : i + k]) for k in range(1, 6) for i in range(len(whole) - k + 1))


def test_scores_beyond_64_bits(spark):
    big = 3_000_000_000_000
    row = spark.createDataFrame([(big, big, big, big - 1)], "a long, n long, l long, r long")
    got = row.select(F.expr("cast(1000 * a as decimal(19, 0)) * cast(n as decimal(19, 0)) div (cast(l as decimal(19, 0)) * cast(r as decimal(19, 0)))")).first()[0]
    assert got == 1000 * big * big // (big * (big - 1))


def test_odd_rows(spark, odd_docs, no_docs):
    odd = odd_docs.withColumn("lang", F.lit(None).cast("string"))
    rows = [(r.doc_id, None, r.text) for r in odd.collect()]
    got = collocations.collocations(odd).collect()
    assert set(map(tuple, got)) == brute(rows) and got
    assert collocations.collocations(no_docs.withColumn("lang", F.lit("en"))).count() == 0


def test_tasks_hold_a_filter_once(spark):
    held = key_filter(spark.range(100_000).select(F.xxhash64("id").alias("key")))
    assert held.words.nbytes >= 1 << 17
    assert len(cloudpickle.dumps(held)) < 1000  # a function that has it is as small
    sure = spark.range(1000).select(F.xxhash64("id").alias("key"))
    found = sure.mapInArrow(lambda batches: (b.filter(pa.array(held.may_hold(b.column(0).to_numpy()))) for b in batches), "key long")
    assert found.count() == 1000
