"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on words of toxic texts and one on words of ordinary
texts. A window is a word with its blanks. It is compressed with either dictionary, behind a
carrier that both know, so that even a short window is really compressed; the difference of the
two lengths says which text it is more like. A document is judged by how many of its windows,
and what share, reach each of a few differences; a logistic regression on labelled documents that
the dictionaries have not seen calibrates these counts into a probability.

Toxic training words are those that recur in toxic texts and not in ordinary ones. Near copies
are left out first, since their rare words recur for no other reason.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from tidemark.llm.common import keyed_texts, labelled_sample, slices
from tidemark.llm.logistic import fit_logistic, sigmoid

CARRIER = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ+/0123456789"
EDGE = b".,!?#*$%&|<>;:()[]\"'"
#: Windows are counted by least difference of lengths and most bytes that the toxic dictionary leaves beside the carrier's.
CELLS = tuple((least, most) for most in (1, 2, 3, 99) for least in (2, 3, 4, 5, 6))
LONGEST = 64  # a longer stretch is several windows
CACHE_ENTRIES = 300_000


def windows(text: str) -> list[bytes]:
    """Lower-cased words; stretches beyond LONGEST bytes are cut into several."""
    words = text.lower().encode("utf-8", "replace").split()
    if max(map(len, words), default=0) <= LONGEST:
        return words
    return [w[i : i + LONGEST] for w in words for i in range(0, len(w), LONGEST)]


def _train(samples: list[bytes], size: int) -> bytes:
    """A dictionary of the samples; too few samples are the dictionary themselves."""
    if not samples:
        return b""
    total = sum(map(len, samples))
    try:
        return zstandard.train_dictionary(size, samples * -(-size * 60 // total), k=64, d=6).as_bytes()
    except zstandard.ZstdError:
        return b"".join(dict.fromkeys(samples))[-size:]


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    return zstandard.ZstdCompressor(
        dict_data=zstandard.ZstdCompressionDict(content + CARRIER, dict_type=zstandard.DICT_TYPE_RAWCONTENT),
        compression_params=zstandard.ZstdCompressionParameters(
            strategy=zstandard.STRATEGY_BTLAZY2, min_match=5, target_length=8, search_log=3, hash_log=15, chain_log=15, window_log=18,
            write_content_size=False, write_checksum=False, write_dict_id=False,
        ),
    )


def _lengths(compressor, texts: list[bytes]) -> np.ndarray:
    out = compressor.multi_compress_to_buffer(texts, threads=0)
    return np.fromiter((len(out[i]) for i in range(len(out))), np.int64, len(texts))


class Differences(dict):
    """What the two dictionaries make of each window, kept while there is room: 100 times the
    difference of lengths (ordinary minus toxic; 0 if negative) plus the bytes of the toxic one."""

    def __init__(self, toxic: bytes, ordinary: bytes):
        super().__init__()
        self.toxic, self.ordinary = _compressor(toxic), _compressor(ordinary)
        self.base = int(_lengths(self.toxic, [b"  " + CARRIER])[0])

    def learn(self, words: set[bytes]) -> None:
        """Compresses the new ones among the words, all in one call of either compressor."""
        new = [w for w in words if w not in self]
        if new:
            if len(self) + len(new) > CACHE_ENTRIES:
                self.clear()
                new = list(words)
            padded = [b" " + w.strip(EDGE) + b" " + CARRIER for w in new]
            toxic = _lengths(self.toxic, padded)
            gain, rest = np.clip(_lengths(self.ordinary, padded) - toxic, 0, 99), np.clip(toxic - self.base, 0, 99)
            self.update(zip(new, (100 * gain + rest).tolist(), strict=True))

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


@dataclass
class ToxicityModel:
    toxic: bytes
    ordinary: bytes
    weights: np.ndarray | None

    def features(self, differences: Differences, texts: list[str]) -> np.ndarray:
        out, split = np.zeros((len(texts), 2 * len(CELLS) + 2)), [windows(t) for t in texts]
        differences.learn({w for words in split for w in words})
        for i, words in enumerate(split):
            if words:
                gain, rest = np.divmod(differences.of(words), 100)
                telling = gain >= 2
                g, r = gain[telling], rest[telling]
                counts = np.array([((g >= least) & (r <= most)).sum() for least, most in CELLS], float)
                out[i] = np.r_[np.log1p(counts), np.sqrt(counts / len(words)), gain.max() / 4, np.log1p(len(words)) / 4]
        return out

    def scores(self, differences: Differences, texts: list[str]) -> np.ndarray:
        if self.weights is None:
            return np.zeros(len(texts))
        x = self.features(differences, texts)
        return sigmoid(x @ self.weights[:-1] + self.weights[-1])


def _fresh(texts: list[str]) -> list[set[bytes]]:
    """Word sets of the texts without near copies of earlier ones."""
    seen, out = set(), []
    for t in texts:
        w = windows(t)
        runs = {hash(tuple(w[i : i + 3])) for i in range(max(1, len(w) - 2))}
        known = len(runs & seen)
        seen |= runs
        if known < 0.3 * len(runs):
            out.append(set(w))
    return out


def fit_from_texts(texts: list[str], y: np.ndarray, weight: np.ndarray, toxic_size: int = 8192, ordinary_size: int = 32768, least: int = 3, most_samples: int = 100_000, seed: int = 5) -> ToxicityModel:
    """Dictionaries from three fifths of the texts (at most ``most_samples`` words, drawn evenly, for each), calibration from the rest.

    Without both labels on both sides there is no model, and every score is 0.
    """
    rng = np.random.default_rng(seed)
    part = rng.random(len(texts)) < 0.6
    if any(((y == k) & p).sum() == 0 for k in (0, 1) for p in (part, ~part)):
        return ToxicityModel(b"", b"", None)
    of = lambda k: [t for t, a, b in zip(texts, y, part, strict=True) if a == k and b]
    toxic = Counter(w.strip(EDGE) for words in _fresh(of(1)) for w in words)
    ordinary = Counter(w.strip(EDGE) for words in _fresh(of(0)) for w in words)
    recurring = [w for w, n in sorted(toxic.items()) if n >= least and w and w not in ordinary]
    spread = lambda words, counts, most: [b" " + w + b" " for w in words for _ in range(min(counts[w], most))]
    mixed = lambda samples: [samples[i] for i in rng.permutation(len(samples))[:most_samples]]
    common = _train(mixed(spread(sorted(ordinary), ordinary, 20)), ordinary_size)
    model = ToxicityModel(_train(mixed(spread(recurring, toxic, 100)), toxic_size), common, None)
    rest = np.flatnonzero(~part)
    x = model.features(Differences(model.toxic, model.ordinary), [texts[i] for i in rest])
    model.weights = fit_logistic(x, y[rest].astype(float), weight[rest], l2=1.0)
    return model


def fit_toxicity(docs: DataFrame, labels: DataFrame, usable, per_class: int = 3000, seed: int = 11) -> ToxicityModel:
    """The model, from at most about ``per_class`` usable labelled rows of either label."""
    rows = labelled_sample(keyed_texts(docs), labels, "toxic", usable, per_class, seed)
    return fit_from_texts(rows["text"].tolist(), rows["y"].to_numpy(), rows["weight"].to_numpy())


def score_toxicity(docs: DataFrame, model: ToxicityModel, threshold: float = 0.7) -> DataFrame:
    """doc_id, score and predicted of every row, from its whole text.

    A null text counts as empty. Empty texts have no windows and get the score of a document
    without any finding. Repeated rows and null doc_ids are scored like all others; equal texts
    get equal scores.
    """

    def score(batches):
        differences = Differences(model.toxic, model.ordinary)
        for batch in batches:
            s = np.concatenate([np.zeros(0), *(model.scores(differences, [t or "" for t in texts]) for _, texts in slices(batch, 1, 1 << 22))])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s, pa.float64()), pa.array((s >= threshold).astype(np.int32))], names=["doc_id", "score", "predicted"])

    return keyed_texts(docs).mapInArrow(score, "doc_id long, score double, predicted int")
