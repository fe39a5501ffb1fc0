"""Quality rules: counts of words, symbols and repetition, and a trained verdict.

The verdict is a logistic regression over hashed word n-grams (one and two words) and character
n-grams (one to four code points), trained on a bounded sample of labelled documents. Its margin
is calibrated to a probability on documents it was not trained on, and texts are scored in Arrow
batches against a fixed threshold.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import keyed_texts, labelled_sample, text_condition
from tidemark.llm.logistic import fit_logistic, sigmoid

BITS = 16  # buckets of each of the two hashed spaces, as a power of two
KEEP_FROM = 0.3  # least probability of good quality
SPACES = np.zeros(0x110000, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
SYMBOLS = np.zeros(128, bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True
MIX = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Text:
    """Words and code points of a text, and the counts that the rules use."""

    words: int
    word_chars: int
    symbols: int
    dup_lines: int
    repeat_words: int
    ids: np.ndarray  # word number by place
    vocabulary: list[bytes]  # word by number
    points: np.ndarray

    @property
    def failed(self) -> bool:
        return self.words < 50 or 100 * self.repeat_words > 50 * self.words


def repeated_words(ids: np.ndarray, n_ids: int) -> int:
    """Words in windows of three that occur twice or more."""
    n = len(ids)
    if n < 3:
        return 0
    if n_ids < 1 << 21:
        key = (ids[:-2] * n_ids + ids[1:-1]) * n_ids + ids[2:]
    else:  # number the pairs first, so that keys stay exact
        pair = np.unique(ids[:-2] * n_ids + ids[1:-1], return_inverse=True)[1]
        key = pair * n_ids + ids[2:]
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(n - 2, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(n, bool)
    for shift in range(3):
        covered[shift : n - 2 + shift] |= twice
    return int(covered.sum())


def duplicate_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = text.split(b"\n")
    if len(lines) < 2:
        return 0
    seen, n = set(), 0
    for line in lines:
        if line in seen:
            n += bool(line.split())
        else:
            seen.add(line)
    return n


def read(text: str) -> Text:
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()  # the white space of bytes is \x20 and \x09-\x0D
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    low = points[points < 128]
    return Text(
        len(words), int(len(points) - SPACES[low].sum()), int(SYMBOLS[low].sum()), duplicate_lines(raw), repeated_words(ids, len(number)), ids, list(number), points
    )


def _bucket(h: np.ndarray) -> np.ndarray:
    return ((h * MIX) >> np.uint64(64 - BITS)).astype(np.int64)


def hashed(t: Text) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the word and of the character n-grams, one entry per occurrence."""
    own = np.fromiter(map(zlib.crc32, t.vocabulary), np.uint64, len(t.vocabulary))[t.ids]
    word = [own + np.uint64(1)]
    if len(own) > 1:
        word.append(own[:-1] * np.uint64(0x100000001B3) + own[1:] + np.uint64(2))
    p = t.points.astype(np.uint64)
    char, gram = [], np.zeros(len(p), np.uint64)
    for size in range(1, 5):
        gram = (gram[: len(p) - size + 1] if size == 1 else gram[:-1]) * np.uint64(0x110001) + p[size - 1 :] + np.uint64(size)
        if not len(gram):
            break
        char.append(gram)
    empty = np.zeros(0, np.int64)
    return (_bucket(np.concatenate(word)) if len(own) else empty), (_bucket(np.concatenate(char)) if char else empty)


@dataclass
class QualityModel:
    word: np.ndarray | None
    char: np.ndarray | None
    bias: float = 0.0
    slope: float = 1.0
    offset: float = 0.0

    def margin(self, t: Text) -> float:
        w, c = hashed(t)
        return self.bias + (self.word[w].mean() if len(w) else 0.0) + (self.char[c].mean() if len(c) else 0.0)

    def probability(self, t: Text) -> float:
        """Calibrated probability of good quality; 1 without a model."""
        return 1.0 if self.word is None else float(sigmoid(self.slope * self.margin(t) + self.offset))


def fit_from_texts(texts: list[str], y: np.ndarray, weight: np.ndarray, epochs: int = 12, l2: float = 1e-4, seed: int = 3) -> QualityModel:
    """Training on four fifths of the texts (balanced classes), calibration on the rest (class shares).

    Without both labels on both sides there is no model, and the verdict is always to keep.
    """
    rng = np.random.default_rng(seed)
    held = rng.random(len(texts)) < 0.2
    if any(((y == k) & p).sum() == 0 for k in (0, 1) for p in (held, ~held)):
        return QualityModel(None, None)
    size = 1 << BITS
    rows = []
    for t in texts:
        w, c = hashed(read(t))
        wi, wn = np.unique(w, return_counts=True)
        ci, cn = np.unique(c, return_counts=True)
        rows.append((np.r_[wi, ci + size], np.r_[wn / max(1, len(w)), cn / max(1, len(c))]))
    train = np.flatnonzero(~held)
    sample_weight = np.where(y == 1, 0.5 / y[train].mean(), 0.5 / (1 - y[train].mean()))
    # adaptive gradient steps; features are shares of a text, so rare ones need large steps
    v, g2, bias, b2 = np.zeros(2 * size), np.full(2 * size, 1e-8), 0.0, 1e-8
    for _ in range(epochs):
        for i in rng.permutation(train):
            idx, x = rows[i]
            error = sample_weight[i] * (sigmoid(v[idx] @ x + bias) - y[i])
            grad = error * x + l2 * v[idx] * x
            g2[idx] += grad * grad
            v[idx] -= 0.5 * grad / np.sqrt(g2[idx])
            b2 += error * error
            bias -= 0.1 * error / np.sqrt(b2)
    margin = np.array([v[idx] @ x + bias for idx, x in (rows[i] for i in np.flatnonzero(held))])
    spread = max(float(np.abs(margin).mean()), 1e-9)
    slope, offset = fit_logistic(margin[:, None] / spread, y[held].astype(float), weight[held], l2=0.1)
    return QualityModel(v[:size].astype(np.float32), v[size:].astype(np.float32), float(bias), float(slope / spread), float(offset))


def fit_quality(docs: DataFrame, labels: DataFrame, usable, per_class: int = 1500, seed: int = 13) -> QualityModel:
    """The model, from at most about ``per_class`` usable labelled rows of either quality."""
    rows = labelled_sample(keyed_texts(docs), labels, "quality", usable, per_class, seed)
    return fit_from_texts(rows["text"].tolist(), rows["y"].to_numpy(), rows["weight"].to_numpy())


def judge(docs: DataFrame, model: QualityModel, keep_from: float = KEEP_FROM) -> DataFrame:
    """Counts and verdict of every row, from its whole text.

    doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept and
    quality (calibrated probability). A null or empty text has no words and fails. Repeated rows
    and null doc_ids are ordinary rows. Without usable labels only the base rules decide.
    """
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def run(batches):
        for batch in batches:
            counts, failed, quality = [], [], []
            for text in batch.column(1):
                t = read(text.as_py() or "")
                counts.append((t.words, t.word_chars, t.symbols, t.dup_lines, t.repeat_words))
                failed.append(t.failed)
                quality.append(model.probability(t))
            kept = [not f and q >= keep_from for f, q in zip(failed, quality, strict=True)]
            numbers = np.array(counts, np.int64).reshape(len(counts), 5)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(numbers[:, k]) for k in range(5)], pa.array(failed, pa.bool_()), pa.array(kept, pa.bool_()), pa.array(quality, pa.float64())],
                names=["doc_id", *names, "base_failed", "kept", "quality"],
            )

    schema = "doc_id long, " + ", ".join(f"{n} long" for n in names) + ", base_failed boolean, kept boolean, quality double"
    return keyed_texts(docs).mapInArrow(run, schema)


def keep_good(docs: DataFrame, model: QualityModel, keep_from: float = KEEP_FROM) -> DataFrame:
    """The rows of ``docs``, all columns, that neither fail the base rules nor the verdict."""

    def good(text: str | None) -> bool:
        t = read(text or "")
        return not t.failed and model.probability(t) >= keep_from

    return docs.filter(text_condition(lambda: lambda texts: [good(t) for t in texts])(F.col("text").cast("string")))
