"""Hierarchical residual packing of tokenised documents into fixed-length sequences.

Each input partition tokenises its texts and packs their pieces by best fit. Bins that are nearly
full are done. The others are the items of the next round: they meet in fewer, larger groups,
are packed again by best fit, and so on up the tree until one group is left or a round gains
nothing more. A group is bounded by ``group_items``; what moves between rounds are the places of
pieces (a few numbers each), never text or tokens.
"""

from __future__ import annotations

import unicodedata
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm.common import keyed_texts
from tidemark.session import new_table_path

SEQUENCE = 4096
CACHE_ENTRIES = 300_000
MEMBERS = "array<struct<doc_id:long,piece:int,start:long,length:long,ids_crc32:long,offset:long>>"
BINS = f"bin long, used int, members {MEMBERS}"
FIELDS = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("offset", pa.int64())]


def byte_characters() -> dict[int, str]:
    """The printable stand-ins of byte-level vocabularies: printable Latin-1 as it is, other bytes from 256 on, in order."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)}


class WordTokens(dict):
    """Ids by stretch between blanks, for a tokenizer that never joins across a blank or line feed.

    Each distinct stretch is encoded once and kept while there is room. The tokenizer's added
    tokens hold no blank, so a stretch with one goes to the tokenizer whole. A word of letters goes
    straight to the tokenizer's model, lower-cased and spelt in byte characters as its
    pre-tokenizer would; all else takes the whole tokenizer.
    """

    def __init__(self, path: str):
        super().__init__({"": b""})
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenize = self.tokenizer.model.tokenize
        self.spelling = byte_characters()
        self.ends = {e: self.whole(e) for e in ",."}

    def whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def letters(self, word: str) -> bytes | None:
        """Ids of a word of letters only, or None if it isn't one."""
        if not word.isalpha():
            return None
        if word.isascii():
            word = word.lower()
        else:
            word = "".join(map(str.lower, unicodedata.normalize("NFC", word)))
            if not word.isalpha():
                return None
            word = word.encode().decode("latin-1").translate(self.spelling)
        return array("I", [t.id for t in self.tokenize(word)]).tobytes()

    def __missing__(self, stretch: str) -> bytes:
        end = self.ends.get(stretch[-1])  # a full stop or comma after a letter is a token run of its own
        ids = None if end is None else self.letters(stretch[:-1])
        ids = ids + end if ids else self.letters(stretch) or self.whole(stretch)
        if len(stretch) <= 64:
            if len(self) >= CACHE_ENTRIES:
                self.clear()
                self[""] = b""
            self[stretch] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian 32-bit integers."""
        return b"".join(map(self.__getitem__, text.replace("\n", " ").split(" ")))


_TOKENS: dict[str, WordTokens] = {}


def tokens_of(path: str) -> WordTokens:
    """The tokenizer of this process."""
    if path not in _TOKENS:
        _TOKENS[path] = WordTokens(path)
    return _TOKENS[path]


def best_fit(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Bin number of every item: largest item first, each into the fullest bin that has room."""
    order = np.argsort(-sizes, kind="stable")
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]  # by room left
    rooms = 0  # bit r: a bin with room r is open
    out, n_bins = np.empty(len(sizes), np.int64), 0
    for i, size in zip(order.tolist(), sizes[order].tolist(), strict=True):
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            bins = open_bins[room]
            b = bins.pop()
            if not bins:
                rooms ^= 1 << room
        else:
            room, b = capacity, n_bins
            n_bins += 1
        out[i] = b
        left = room - size
        if left:
            open_bins[left].append(b)
            rooms |= 1 << left
    return out


def _bins(level: int, sizes: np.ndarray, starts: np.ndarray, fields: list[np.ndarray], capacity: int) -> pa.RecordBatch | None:
    """Packs items, each a run of members (its first member is at ``starts``), into bins."""
    if not len(sizes):
        return None
    bin_of = best_fit(sizes, capacity)
    order = np.lexsort((np.arange(len(sizes)), bin_of))
    sizes, of = sizes[order], bin_of[order]
    first = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
    before = np.cumsum(sizes) - sizes
    shift = before - np.repeat(before[first], np.diff(np.r_[first, len(of)]))  # place of the item in its bin
    n_members = (starts[1:] - starts[:-1])[order]
    member_ends = np.cumsum(n_members)
    take = np.repeat(starts[:-1][order] - (member_ends - n_members), n_members) + np.arange(member_ends[-1])
    columns = [f[take] for f in fields]
    columns[-1] = columns[-1] + np.repeat(shift, n_members)
    member_struct = pa.StructArray.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, FIELDS, strict=True)], names=[n for n, _ in FIELDS])
    edges = np.r_[(member_ends - n_members)[first], member_ends[-1]].astype(np.int32)
    used = np.add.reduceat(sizes, first)
    numbers = (level << 56) + (TaskContext.get().partitionId() << 32) + np.arange(len(first))
    return pa.RecordBatch.from_arrays(
        [pa.array(numbers, pa.int64()), pa.array(used, pa.int32()), pa.ListArray.from_arrays(pa.array(edges), member_struct)], names=["bin", "used", "members"]
    )


def local_bins(texts: DataFrame, tokenizer: str, end_id: int, capacity: int) -> DataFrame:
    """Bins of the pieces of each partition's texts."""

    def pack(batches):
        tokens, end = tokens_of(tokenizer), np.array([end_id], "<u4").tobytes()
        doc, missing, piece, start, length, crc = array("q"), array("b"), array("i"), array("q"), array("q"), array("q")
        width = 4 * capacity
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = tokens.encode(text.as_py() or "") + end
                for k, lo in enumerate(range(0, len(ids), width)):
                    cut = ids[lo : lo + width]
                    doc.append(key or 0)
                    missing.append(key is None)
                    piece.append(k)
                    start.append(lo // 4)
                    length.append(len(cut) // 4)
                    crc.append(zlib.crc32(cut))
        n = len(doc)
        fields = [np.frombuffer(x, t) if n else np.empty(0, t) for x, t in ((doc, "i8"), (piece, "i4"), (start, "i8"), (length, "i8"), (crc, "i8"))]
        keys = np.ma.masked_array(fields[0], np.frombuffer(missing, "b").astype(bool) if n else [])
        out = _bins(0, fields[3], np.arange(n + 1), [keys, *fields[1:], np.zeros(n, "i8")], capacity)
        if out is not None:
            yield out

    return texts.mapInArrow(pack, BINS)


def merge_bins(bins: DataFrame, level: int, groups: int, capacity: int) -> DataFrame:
    """One round: underfull bins meet in groups and are packed as items."""

    def pack(batches):
        got = pa.Table.from_batches(list(batches)).combine_chunks()
        if not got.num_rows:
            return
        got = got.sort_by("bin")
        members = got.column("members").combine_chunks()
        flat = members.flatten()
        starts = np.r_[0, np.cumsum(members.value_lengths().to_numpy(zero_copy_only=False))].astype(np.int64)
        keys = flat.field("doc_id")
        null = keys.is_null().to_numpy(zero_copy_only=False)
        fields = [np.ma.masked_array(keys.fill_null(0).to_numpy(zero_copy_only=False), null), *[flat.field(n).to_numpy(zero_copy_only=False) for n, _ in FIELDS[1:]]]
        yield _bins(level, got.column("used").to_numpy().astype(np.int64), starts, fields, capacity)

    def run(batches):
        first = next(batches, None)
        if first is not None:
            yield from pack([first, *batches])

    return bins.repartition(groups, F.xxhash64("bin")).mapInArrow(run, BINS)


def pack_documents(
    docs: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = SEQUENCE, nearly_full: float = 0.998, group_items: int = 200_000, fan_in: int = 8, least_gain: float = 0.005
) -> DataFrame:
    """The place of every piece of every document in the packed sequences.

    One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset. A null or
    empty text is the end id alone. Texts above ``capacity`` tokens are cut into full pieces and a
    rest. Repeated rows and null doc_ids are documents of their own. An empty table gives no rows.

    Rounds end when all underfull bins fit one group of ``group_items``, or when a round saves
    under ``least_gain`` of its bins; what is left then stays as it is.
    """
    spark = docs.sparkSession
    path = new_table_path(spark, "packing")
    full = int(capacity * nearly_full)
    texts = keyed_texts(docs)
    groups = texts.rdd.getNumPartitions()
    local_bins(texts, tokenizer, end_id, capacity).write.parquet(f"{path}/0")
    rounds = [spark.read.schema(BINS).parquet(f"{path}/0")]
    done, level, kept = [], 0, None
    while True:
        bins = rounds[-1]
        under = bins.filter(F.col("used") < full)
        n = under.count()
        last_round = groups == 1 and level > 0
        stalled = kept is not None and n > kept * (1 - least_gain) and -(-n // group_items) >= groups
        if n <= 1 or last_round or stalled:
            done.append(bins)
            break
        done.append(bins.filter(F.col("used") >= full))
        kept, level = n, level + 1
        groups = max(-(-n // group_items), groups // fan_in, 1)
        merge_bins(under, level, groups, capacity).write.parquet(f"{path}/{level}")
        rounds.append(spark.read.schema(BINS).parquet(f"{path}/{level}"))
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.select(F.col("bin").alias("sequence_id"), F.inline("members")).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
