import hashlib
import random

import numpy as np
import public_tokenizers as pt
import tiktoken

from tidemark.llm import bpe

PARTS = ["a", "b", "the", "'s", "'re", "'", "r", "e", " ", "  ", "\n", "\n\n", "\t", "1", "23", "!", "!!", "é", "ü", "日本", "🎉", " ", "\x1c", "x" * 30, "ab" * 20, "-" * 40]


def reference():
    ranks = bpe.read_ranks(pt.path("byte_bpe_50k.tiktoken"))
    return ranks, tiktoken.Encoding("own", pat_str=pt.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_joined_halves_equal_the_library():
    ranks, library = reference()
    rng = random.Random(1)
    for leaf_chars, leaf_bytes in ((1, 2), (5, 3), (17, 8), (4096, 48)):
        own = bpe.TreeCodec(ranks, pt.PATTERN, leaf_chars, leaf_bytes)
        for _ in range(1500):
            text = "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 30)))
            ids = np.frombuffer(own.encode(text), "<u4").tolist()
            assert ids == library.encode_ordinary(text), repr(text)
            assert own.decode(ids) == text.encode()


def test_long_stretch_without_blanks():
    ranks, library = reference()
    own, rng = bpe.TreeCodec(ranks, pt.PATTERN), random.Random(2)
    for alphabet in ("ab", "abcdefghij", "日本é"):
        text = "".join(rng.choice(alphabet) for _ in range(20_000))
        ids = np.frombuffer(own.encode(text), "<u4").tolist()
        assert ids == library.encode_ordinary(text) and own.decode(ids) == text.encode()


def test_odd_rows(spark, odd_docs, no_docs):
    _, library = reference()
    out = bpe.encode_documents(odd_docs, pt.path("byte_bpe_50k.tiktoken"), pt.PATTERN, with_ids=True).collect()
    want = []
    for r in odd_docs.collect():
        ids = library.encode_ordinary(r.text or "")
        want.append((r.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest(), ids))
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted(map(tuple, out), key=key) == sorted(want, key=key)
    assert bpe.encode_documents(no_docs, pt.path("byte_bpe_50k.tiktoken"), pt.PATTERN).count() == 0
