import random

import numpy as np
import public_tokenizers as pt
import pytest
from pyspark.sql import functions as F

from tidemark.llm import langid

PATH = pt.path("piece_bpe_32k.model")
ENGLISH = "the house of my friend stands near the old river and we walk there with great pleasure every morning".split()
GERMAN = "das haus von meinem freund steht am alten fluss und wir gehen dort jeden morgen mit grosser freude".split()


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choices((ENGLISH, GERMAN)[i % 2], k=12)), ("en", "de")[i % 2]) for i in range(200)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


@pytest.fixture(scope="module")
def model(docs):
    return langid.fit_languages(docs, PATH, F.col("doc_id") < 150)


def test_forward_sums_all_segmentations(model):
    def all_cuts(t, k):
        if not t:
            return 1.0
        unknown = model.p[-2, k]
        return sum((model.p[model.index[t[:i]], k] if t[:i] in model.index else unknown if i == 1 else 0.0) * all_cuts(t[i:], k) for i in range(1, len(t) + 1))

    for word in ("the", "freude", "xqz", "日本", "ein"):
        want = [all_cuts(langid.START + word, k) for k in range(2)]
        assert np.allclose(np.exp(model.log_probabilities([word])[0]), want, rtol=1e-9)


def test_held_out_texts_are_told_apart(docs, model):
    rows = langid.identify(docs, model).join(docs, "doc_id").filter("doc_id >= 150").collect()
    assert all(r.lang_pred == r.lang and r.score > 0.9 for r in rows)


def test_odd_rows(spark, odd_docs, no_docs, model):
    rows = langid.identify(odd_docs, model).collect()
    assert len(rows) == odd_docs.count()
    und = {r.doc_id for r in rows if r.lang_pred == "und"}
    assert und == {0, 1, 2, 8} and all(0 <= r.score <= 1 for r in rows)
    kept = langid.keep_identified(odd_docs, model)
    assert kept.columns == odd_docs.columns and {0, 1, 2, 8}.isdisjoint(r.doc_id for r in kept.collect())
    assert langid.identify(no_docs, model).count() == 0
    untaught = langid.fit_languages(odd_docs.withColumn("lang", F.lit(None).cast("string")), PATH, F.lit(True))
    assert {r.lang_pred for r in langid.identify(odd_docs, untaught).collect()} == {"und"}


def test_long_words_are_scored_whole(model):
    for word in ("freudethe" * 9, "the" * 400, "日本" * 60):
        text, want = langid.START + word, []
        for k in range(2):
            sums = [0.0]  # logarithms, place by place
            for end in range(1, len(text) + 1):
                cuts = [(text[at:end], sums[at]) for at in range(max(0, end - 16), end)]
                terms = [a + np.log(model.p[model.index[t], k] if t in model.index else model.p[-2, k]) for t, a in cuts if t in model.index or len(t) == 1]
                sums.append(np.logaddexp.reduce(terms))
            want.append(sums[-1])
        assert np.allclose(model.log_probabilities([word])[0], want, rtol=1e-9)
