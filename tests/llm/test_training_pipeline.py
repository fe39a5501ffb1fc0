import os

import pytest
from test_minhash import exact
from test_packing import check
from test_quality import by_hand

import __spark_entry__ as entry
import corpus_pipeline
from tidemark import session
from tidemark.llm import minhash

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="needs the driver's tables")
def test_stages_do_what_they_say(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, frames = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, SF).cache()
        frames[name] = before, docs
        if name != "packing":
            assert docs.columns == columns and docs.count() > 0
    rows = lambda df: {r.doc_id: r.text for r in df.collect()}
    before, after = map(rows, frames["language_id"])
    assert {k for k in before if k not in after} == {k for k, t in before.items() if not any(c.isalpha() for c in t or "")}
    before, after = map(rows, frames["quality_rules"])
    for k, t in before.items():
        n, _, _, _, repeated = by_hand(t)
        assert k not in after or (n >= 50 and 100 * repeated <= 50 * n)
    before, after = map(rows, frames["near_dedup"])
    assert set(after) == {k for k, (_, _, kept) in exact(before.items(), 5, 80).items() if kept}
    check(frames["packing"][1].collect(), after, 4096)


def test_rows_without_key_and_repeated_rows(spark):
    text = " ".join(f"word{i}" for i in range(80))
    docs = spark.createDataFrame([(1, text), (1, text), (2, text), (None, text), (None, None), (3, None)], "doc_id long, text string")
    out = corpus_pipeline.drop_near_duplicates(spark, docs, SF).collect()
    assert sorted(((r.doc_id or 0, r.text is None) for r in out)) == [(0, False), (0, True), (1, False), (3, True)]


def test_few_bytes_of_texts_are_with_python(spark, monkeypatch):
    """Batches for Python are bounded by bytes while the rows of a stage are made; after the run they are as before."""
    limit, seen = "spark.sql.execution.arrow.maxBytesPerBatch", []

    def noted(df, name, write=session.stored):
        seen.append(int(spark.conf.get(limit)))
        return write(df, name)

    text = " ".join(f"word{i}" for i in range(80))
    docs = spark.createDataFrame([(1, text, "en"), (2, text, "en"), (3, None, "en")], "doc_id long, text string, lang string")
    tables = {"documents": docs, "labels": spark.createDataFrame([], "doc_id long, quality int")}
    monkeypatch.setattr(corpus_pipeline, "table", lambda spark, sf_dir, name: tables[name])
    for module in (corpus_pipeline, minhash):
        monkeypatch.setattr(module, "stored", noted)
    before = spark.conf.get(limit)
    assert [r.doc_id for r in corpus_pipeline.run(spark, "").collect()] == [1]
    assert len(seen) > len(corpus_pipeline.STAGES) and max(seen) <= 1 << 20 and spark.conf.get(limit) == before
    try:
        for _, stage in corpus_pipeline.STAGES[:2]:
            spark.conf.set(limit, before)
            rows = stage(spark, docs, "")
            assert int(spark.conf.get(limit)) <= 1 << 20 and rows.count() == 2
    finally:
        spark.conf.set(limit, before)


def test_registered():
    names = set(entry.queries())
    assert {"pipeline"} | {f"op{n}_" for n in range(1, 11)} <= {"pipeline"} | {n.split("_")[0] + "_" for n in names if n.startswith("op")}
    assert set(entry.oracle_sql()) <= names
