import random
import re
from collections import Counter

from pyspark.sql import functions as F

from tidemark.llm import quality


def by_hand(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    runs = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {j for i in range(len(w) - 2) if runs[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        dup += line in seen and bool(re.search(r"[^\x20\x09-\x0D]", line))
        seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def test_counts_equal_the_definition():
    rng = random.Random(1)
    parts = ["a", "b", "c", " ", " ", "\n", "\n\n", "\t", "\x0b", "\x85", " ", "é", "🎉", "#", "|", "a b c", "\x1c"]
    for _ in range(2000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 60)))
        t = quality.read(text)
        assert (t.words, t.word_chars, t.symbols, t.dup_lines, t.repeat_words) == by_hand(text), repr(text)


def labelled(spark):
    rng = random.Random(2)
    words = ["river", "stone", "walked", "slowly", "under", "bright", "morning", "garden", "letters", "quiet"]
    rows = []
    for i in range(300):
        good = i % 3 > 0
        text = " ".join(rng.choice(words) + ("" if good else "!!$$") for _ in range(60 + i % 40))
        rows.append((i, text, int(good)))
    return spark.createDataFrame(rows, "doc_id long, text string, quality int")


def test_held_out_accuracy(spark):
    rows = labelled(spark)
    docs, labels = rows.drop("quality"), rows.select("doc_id", "quality")
    model = quality.fit_quality(docs, labels, F.col("doc_id") < 200)
    scored = quality.judge(docs, model).withColumnRenamed("quality", "probability").join(labels, "doc_id").filter("doc_id >= 200").collect()
    assert sum((r.probability >= 0.5) == bool(r.quality) for r in scored) >= 0.97 * len(scored)
    assert all(r.kept == (not r.base_failed and r.probability >= quality.KEEP_FROM) for r in scored)


def test_odd_rows(spark, odd_docs, no_docs):
    no_labels = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, quality int")
    model = quality.fit_quality(odd_docs, no_labels, F.lit(True))
    rows = quality.judge(odd_docs, model).collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        if r.doc_id in (0, 1, 2):
            assert (r.n_words, r.word_chars, r.base_failed, r.kept) == (0, 0, True, False)
    long = next(r for r in rows if r.doc_id == 9)
    assert (long.n_words, long.n_repeat_words, long.base_failed) == (4000, 4000, True)
    assert quality.keep_good(odd_docs, model).columns == odd_docs.columns
    assert quality.judge(no_docs, model).count() == 0
