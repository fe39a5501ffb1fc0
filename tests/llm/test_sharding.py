import random

from tidemark.llm.sharding import shard_documents


def law(rows, shards, slack, group=0):
    size, slots = {}, {}
    for r in rows:
        assert r.size == len((r.row.text or "").encode()) + 1
        size[r.shard] = size.get(r.shard, 0) + r.size
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    ideal = sum(size.values()) / shards
    assert all(abs(n - ideal) <= slack for n in size.values()) and len(size) == shards
    return ideal


def test_bytes_are_even_and_groups_whole(spark):
    rng = random.Random(1)
    texts = ["w" * rng.randint(1, 400) + str(i) for i in range(4000)]
    texts += [t for t in texts[:300] for _ in range(2)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(7)
    rows = shard_documents(docs, 16, range_bytes=10_000).collect()
    assert sorted(r.row.doc_id for r in rows) == list(range(len(texts)))
    law(rows, 16, 1500)
    where = {}
    for r in rows:
        where.setdefault(r.row.text, set()).add(r.shard)
    assert all(len(w) == 1 for w in where.values())


def test_a_group_above_a_shard_is_cut(spark):
    texts = ["hot text of a third of all rows"] * 1500 + [f"text number {i} with more words" for i in range(3000)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = shard_documents(docs, 8).collect()
    assert len(rows) == 4500
    law(rows, 8, 70)


def test_odd_rows(spark, odd_docs, no_docs):
    rows = shard_documents(odd_docs, 4).collect()
    assert len(rows) == odd_docs.count() and {r.shard for r in rows} <= set(range(4))
    slots = {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
        assert r.row.asDict().keys() == set(odd_docs.columns)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert shard_documents(no_docs, 4).count() == 0
    one = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    assert shard_documents(one, 4).count() == 1
