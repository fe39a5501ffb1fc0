import random

from pyspark.sql import functions as F

from tidemark.llm import toxicity

BAD = ["grumblewort", "snarfle", "blightface", "mudgoblin"]


def labelled(spark, n=600):
    rng = random.Random(3)
    syllables = ["ta", "ren", "mo", "li", "shen", "dor", "ka", "vel", "un", "pas"]
    rows = []
    for i in range(n):
        words = ["".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(rng.randint(30, 120))]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(BAD))
        rows.append((i, " ".join(words), int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int")


def test_held_out_accuracy(spark):
    rows = labelled(spark)
    docs, labels = rows.drop("toxic"), rows.select("doc_id", "toxic")
    model = toxicity.fit_toxicity(docs, labels, F.col("doc_id") % 3 != 1)
    out = toxicity.score_toxicity(docs, model).join(labels, "doc_id").filter("doc_id % 3 = 1").collect()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in out)
    toxic, clean = [r for r in out if r.toxic], [r for r in out if not r.toxic]
    assert sum(r.predicted for r in toxic) >= 0.9 * len(toxic)
    assert sum(r.predicted for r in clean) <= 0.02 * len(clean)


def test_odd_rows(spark, odd_docs, no_docs):
    rows = labelled(spark, 200)
    model = toxicity.fit_toxicity(rows, rows.select("doc_id", "toxic"), F.lit(True))
    out = toxicity.score_toxicity(odd_docs, model).collect()
    assert len(out) == odd_docs.count()
    empty = [r.score for r in out if r.doc_id in (0, 1, 2)]
    assert len(set(empty)) == 1 and empty[0] < 0.7
    twins = [r.score for r in out if r.doc_id in (None, 5)]
    assert len(twins) == 3 and len(set(twins)) == 1
    assert toxicity.score_toxicity(no_docs, model).count() == 0
    untaught = toxicity.fit_toxicity(odd_docs, spark.createDataFrame([(1, None)], "doc_id long, toxic int"), F.lit(True))
    assert {(r.score, r.predicted) for r in toxicity.score_toxicity(odd_docs, untaught).collect()} == {(0.0, 0)}


def test_windows_cover_the_whole_text():
    text = "Ab " + "q" * 150 + " é"
    assert b"".join(toxicity.windows(text)) == "".join(text.lower().split()).encode()
