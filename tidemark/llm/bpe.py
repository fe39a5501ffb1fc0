"""Byte-level BPE by monoid tree reduction.

A text is encoded by halves. Two neighbouring halves are joined by encoding the boundary again:
the window starts at the last unit of the left half that no later character can change and runs
on until one of its cuts is also a cut of the right half. From there the right half stands, as
the split pattern looks ahead but never back. Inside one long match of the pattern the byte
halves are joined in the same way: the window grows until its outer tokens and their neighbours
are encoded as just these two, which makes the whole sequence the encoding.

Decoding concatenates the bytes of the ids up a tree of halves.
"""

from __future__ import annotations

import base64
import hashlib
import re
from array import array
from itertools import accumulate

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame

from tidemark.llm.common import keyed_texts

LEAF_CHARS = 4096
LEAF_BYTES = 48
CACHE_ENTRIES = 1_000_000
DECODE_LEAF = 8192
#: Neighbouring white space, where the quick cut at blanks would not hold.
ODD_SPACE = re.compile(r"\s\s")
SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def read_ranks(path: str) -> dict[bytes, int]:
    """The rank file: a base64 token and its rank on each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class Cache(dict):
    """Ids of units that follow a blank; bounded by starting anew."""

    def __init__(self, owner: TreeCodec):
        super().__init__()
        self.owner = owner

    def __missing__(self, unit: str) -> bytes:
        ids = self.owner.ids_of(" " + unit)
        if len(unit) <= 64:
            if len(self) >= CACHE_ENTRIES:
                self.clear()
            self[unit] = ids
        return ids


class TreeCodec:
    """Encoder and decoder over one rank table and split pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, leaf_chars: int = LEAF_CHARS, leaf_bytes: int = LEAF_BYTES):
        self.leaf_chars, self.leaf_bytes = max(1, leaf_chars), max(2, leaf_bytes)
        self.pattern = regex.compile(pattern)
        core = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.short = core._encode_single_piece
        self.bytes_of = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.bytes_of[rank] = token
        self.whole = core._core_bpe.encode_ordinary
        self.after_blank = Cache(self)
        self.pairs: dict[tuple[int, int], bool] = {}

    # -- inside one match of the pattern

    def stable_pair(self, a: int, b: int) -> bool:
        """Whether the bytes of the two tokens are encoded as just these two."""
        key = (a, b)
        if key not in self.pairs:
            if len(self.pairs) > CACHE_ENTRIES:
                self.pairs.clear()
            self.pairs[key] = list(self.short(self.bytes_of[a] + self.bytes_of[b])) == [a, b]
        return self.pairs[key]

    def join_ids(self, left: list[int], right: list[int]) -> list[int]:
        w = 1
        while True:
            i, j = max(0, len(left) - w), min(len(right), w)
            middle = list(self.short(b"".join(self.bytes_of[t] for t in left[i:] + right[:j])))
            if (i == 0 or self.stable_pair(left[i - 1], middle[0])) and (j == len(right) or self.stable_pair(middle[-1], right[j])):
                return left[:i] + middle + right[j:]
            w *= 2

    def encode_bytes(self, piece: bytes) -> list[int]:
        """Ids of one match. Halves of a long one are reduced pairwise, level by level."""
        if len(piece) <= self.leaf_bytes:
            return list(self.short(piece)) if piece else []
        nodes = [list(self.short(piece[i : i + self.leaf_bytes])) for i in range(0, len(piece), self.leaf_bytes)]
        while len(nodes) > 1:
            nodes = [self.join_ids(nodes[i], nodes[i + 1]) if i + 1 < len(nodes) else nodes[i] for i in range(0, len(nodes), 2)]
        return nodes[0]

    # -- texts

    def ids_of(self, unit: str) -> bytes:
        """Ids of a unit (one or more whole matches) as little-endian 32-bit integers."""
        if len(unit) * 4 <= self.leaf_bytes:
            return array("I", self.whole(unit)).tobytes()
        ids = array("I")
        for match in self.pattern.findall(unit):
            ids.extend(self.encode_bytes(match.encode()))
        return ids.tobytes()

    def leaf(self, text: str, base: int) -> tuple[list[int], list[bytes]]:
        """Starts and ids of the units of a leaf."""
        if ODD_SPACE.search(text):
            units = self.pattern.findall(text)
            ids = [self.ids_of(u) for u in units]
            return list(accumulate(map(len, units[:-1]), initial=base)), ids
        # every blank is alone between other characters, so it starts a match
        first, *rest = text.split(" ")
        ids = [self.ids_of(first), *map(self.after_blank.__getitem__, rest)]
        starts = [base, *accumulate((len(x) + 1 for x in rest[:-1]), initial=base + len(first))] if rest else [base]
        return starts, ids

    def join(self, text: str, left, right, boundary: int, end: int):
        starts, ids = left
        ends = boundary
        while starts and ends + 2 > boundary:  # a match depends on two characters after it at most
            ends = starts.pop()
            ids.pop()
        right_starts, right_ids = right
        at, k = ends, 0
        while at < end:
            while k < len(right_starts) and right_starts[k] < at:
                k += 1
            if k < len(right_starts) and right_starts[k] == at:
                break
            m = self.pattern.match(text, at, end)
            starts.append(at)
            ids.append(self.ids_of(m.group()))
            at = m.end()
        else:
            k = len(right_starts)
        starts.extend(right_starts[k:])
        ids.extend(right_ids[k:])
        return starts, ids

    def node(self, text: str, a: int, b: int):
        if b - a <= self.leaf_chars:
            return self.leaf(text[a:b], a)
        mid = (a + b) // 2
        return self.join(text, self.node(text, a, mid), self.node(text, mid, b), mid, b)

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian 32-bit integers."""
        return b"".join(self.node(text, 0, len(text))[1]) if text else b""

    def decode(self, ids) -> bytes:
        """Bytes of the ids; halves are decoded and concatenated."""
        if len(ids) <= DECODE_LEAF:
            return b"".join(map(self.bytes_of.__getitem__, ids))
        mid = len(ids) // 2
        return self.decode(ids[:mid]) + self.decode(ids[mid:])


_CODECS: dict[tuple[str, str], TreeCodec] = {}


def codec(path: str, pattern: str) -> TreeCodec:
    """The codec of this process."""
    if (path, pattern) not in _CODECS:
        _CODECS[path, pattern] = TreeCodec(read_ranks(path), pattern)
    return _CODECS[path, pattern]


def encode_documents(docs: DataFrame, path: str, pattern: str, with_ids: bool = False) -> DataFrame:
    """Token count, digest of the ids and digest of the decoded bytes of every whole text.

    A row comes out for every row that goes in, repeated rows and null doc_ids included. A null
    text counts as empty: no tokens, and digests of no bytes. ``with_ids`` adds the ids.
    """

    def encode(batches):
        c = codec(path, pattern)
        for batch in batches:
            n, of_ids, of_bytes, all_ids = [], [], [], []
            for text in batch.column(1):
                packed = c.encode(text.as_py() or "")
                ids = np.frombuffer(packed, "<u4")
                n.append(len(ids))
                of_ids.append(hashlib.sha256(packed).hexdigest())
                of_bytes.append(hashlib.sha256(c.decode(ids.tolist())).hexdigest())
                if with_ids:
                    all_ids.append(ids.astype("i4"))
            columns = [batch.column(0), pa.array(n, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_bytes, pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                columns.append(pa.array(all_ids, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return keyed_texts(docs).mapInArrow(encode, SCHEMA + (", ids array<int>" if with_ids else ""))
