import zlib

import numpy as np
import public_tokenizers as pt
from tokenizers import Tokenizer

from tidemark.llm import packing

PATH = pt.path("word_bpe_49k.json")


def check(rows, texts, capacity):
    """Every document's pieces are whole and in order; sequences have no gaps and do not overflow."""
    t = Tokenizer.from_file(PATH)
    docs, sequences = {}, {}
    for r in rows:
        docs.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    assert set(docs) == set(texts)
    for k, text in texts.items():
        ids = np.array(t.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        pieces = sorted(docs[k], key=lambda r: r.piece)
        assert [p.piece for p in pieces] == list(range(len(pieces))) == list(range(-(-len(ids) // capacity)))
        for p in pieces:
            cut = ids[p.start : p.start + p.length]
            assert p.start == p.piece * capacity and p.length == len(cut) and p.ids_crc32 == zlib.crc32(cut.tobytes())
    for members in sequences.values():
        at = 0
        for r in sorted(members, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    return len(sequences)


def test_words_equal_the_tokenizer():
    t = Tokenizer.from_file(PATH)
    own = packing.WordTokens(PATH)
    parts = ["a", "The", "'s", "'re", "'", "R", " ", "  ", "\n", "\t", "1", "23", "!!", ".", ",", "é", "É", "İ", "ΑΣ", "́", "日本", "🎉", " ", "\x1c", "<|endoftext|>", "<|startoftext|>", " <|endoftext|> "]
    rng = np.random.default_rng(1)
    for _ in range(3000):
        text = "".join(parts[i] for i in rng.integers(0, len(parts), rng.integers(0, 20)))
        assert np.frombuffer(own.encode(text), "<u4").tolist() == t.encode(text, add_special_tokens=False).ids, repr(text)


def test_best_fit_keeps_capacity():
    rng = np.random.default_rng(2)
    sizes = rng.integers(1, 101, 5000)
    bins = packing.best_fit(sizes, 100)
    assert np.bincount(bins, sizes).max() <= 100
    assert bins.max() + 1 <= 1.02 * sizes.sum() / 100 + 1


def test_rounds_merge_underfull_bins(spark):
    rng = np.random.default_rng(3)
    texts = {i: " ".join(["word"] * int(n)) for i, n in enumerate(rng.integers(0, 30, 600))}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(24)
    rows = packing.pack_documents(docs, PATH, capacity=40, fan_in=4, group_items=10_000).collect()
    n = check(rows, texts, 40)
    assert n <= sum(len(t.split()) + 1 for t in texts.values()) / 40 * 1.06 + 1
    small_groups = packing.pack_documents(docs, PATH, capacity=40, fan_in=2, group_items=50).collect()
    check(small_groups, texts, 40)


def test_odd_rows(spark, odd_docs, no_docs):
    rows = packing.pack_documents(odd_docs.dropDuplicates(["size"]), PATH).collect()
    check(rows, {r.doc_id: r.text for r in odd_docs.collect()}, 4096)
    assert len([r for r in packing.pack_documents(odd_docs, PATH).collect() if r.doc_id == 5]) == 2
    assert packing.pack_documents(no_docs, PATH).count() == 0
