"""Language identification by segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public vocabulary. The probability of
a word in a language is the sum, over all ways to cut it into pieces, of the products of the piece
probabilities; a forward pass adds them up. The probability of a text is the product over its
words. Piece probabilities are learnt by expectation-maximisation over the same segmentations,
from word counts of a bounded sample of labelled documents.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import LETTER, hashed_share, keyed_texts, slices, text_condition

START = "▁"
EDGE = ".,!?#*$%&|<>;:()[]{}\"'«»“”„…-0123456789"
LONGEST = 64  # characters up to which words are scored many at once; longer ones are scaled on the way
CACHE_ENTRIES = 200_000


def vocabulary(path: str) -> list[str]:
    """Pieces of the model file, without control and byte pieces."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]


def words_of(text: str) -> list[str]:
    """Lower-cased words between white space."""
    return text.lower().split()


def core_of(word: str) -> str:
    """What is scored of a word: its inside, without digits and marks at the edges; empty without a letter."""
    core = word.strip(EDGE)
    return core if core.isalpha() or LETTER.search(core) else ""


def _codes(words: list[str]) -> np.ndarray:
    """Code points of words of equal length, a row each."""
    return np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(words), -1).astype(np.uint64)


class PieceTable:
    """Vocabulary numbers by 64-bit polynomial hash of the code points, for many substrings at once."""

    BASE = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, index: dict[str, int]):
        self.unknown = len(index)
        self.by_size: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for size, pieces in by_length(index).items():
            codes, h = _codes(pieces), np.zeros(len(pieces), np.uint64)
            for k in range(size):
                h = h * self.BASE + codes[:, k]
            order = np.argsort(h)
            self.by_size[size] = h[order], np.array([index[p] for p in pieces], np.int32)[order]

    def find(self, size: int, h: np.ndarray) -> np.ndarray:
        """Numbers of the pieces with these hashes, -1 where there is none."""
        if size not in self.by_size:
            return np.full(h.shape, -1, np.int32)
        hashes, numbers = self.by_size[size]
        at = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
        return np.where(hashes[at] == h, numbers[at], -1)


class Lattice:
    """Words of equal length with the vocabulary number of each of their substrings (the last
    row, an unknown single character, where a character is no piece; -1 where there is none)."""

    def __init__(self, table: PieceTable, words: list[str]):
        codes = _codes([START + w for w in words])
        self.n = codes.shape[1]
        self.longest = min(self.n, max(table.by_size, default=1))
        self.pieces = np.full((self.longest, self.n, len(words)), -1, np.int32)  # (length - 1, start, word)
        h = np.zeros(codes.shape, np.uint64)
        for size in range(1, self.longest + 1):
            starts = self.n - size + 1
            h = h[:, :starts] * table.BASE + codes[:, size - 1 :]
            self.pieces[size - 1, :starts] = table.find(size, h).T
        single = self.pieces[0]
        single[single < 0] = table.unknown

    def forward(self, p: np.ndarray) -> np.ndarray:
        """Sum over all segmentations up to each place: (place, word, language). p has a zero row at its end."""
        a = np.zeros((self.n + 1, self.pieces.shape[2], p.shape[1]))
        a[0] = 1.0
        for end in range(1, self.n + 1):
            for size in range(1, min(self.longest, end) + 1):
                a[end] += a[end - size] * p[self.pieces[size - 1, end - size]]
        return a

    def scaled_forward(self, p: np.ndarray) -> np.ndarray:
        """Logarithms of the sums over all segmentations of the first word, whatever its length."""
        recent = np.zeros((self.longest, p.shape[1]))  # sums up to the last places, newest first
        recent[0], scale = 1.0, np.zeros(p.shape[1])
        for end in range(1, self.n + 1):
            sizes = np.arange(min(self.longest, end))
            a = (recent[sizes] * p[self.pieces[sizes, end - 1 - sizes, 0]]).sum(axis=0)
            recent = np.vstack([a, recent[:-1]])
            if a.min() < 1e-100:
                recent /= a
                scale += np.log(a)
        return scale + np.log(recent[0])

    def expected(self, p: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Expected uses of every piece by language, for word counts (word, language)."""
        a = self.forward(p)
        b = np.zeros_like(a)
        b[self.n] = 1.0
        for at in range(self.n - 1, -1, -1):
            for size in range(1, min(self.longest, self.n - at) + 1):
                b[at] += b[at + size] * p[self.pieces[size - 1, at]]
        share = counts / np.maximum(a[self.n], 1e-300)
        out = np.zeros_like(p)
        for size in range(1, self.longest + 1):
            for at in range(self.n - size + 1):
                ids = self.pieces[size - 1, at]
                np.add.at(out, ids, a[at] * p[ids] * b[at + size] * share)
        out[-1] = 0.0
        return out


def by_length(words) -> dict[int, list[str]]:
    out: dict[int, list[str]] = {}
    for w in words:
        out.setdefault(len(w), []).append(w)
    return out


@dataclass
class LanguageModel:
    languages: list[str]
    index: dict[str, int]
    p: np.ndarray  # (pieces + unknown character + nothing, languages)
    table: PieceTable

    def log_probabilities(self, words: list[str]) -> np.ndarray:
        """(word, language), in the order given."""
        out, place = np.empty((len(words), len(self.languages))), {w: i for i, w in enumerate(words)}
        for same in by_length(words).values():
            if len(same[0]) <= LONGEST:
                out[[place[w] for w in same]] = np.log(Lattice(self.table, same).forward(self.p)[-1])
            else:
                for w in same:
                    out[place[w]] = Lattice(self.table, [w]).scaled_forward(self.p)
        return out


class WordScores:
    """Log probabilities of the words seen by this task, kept while there is room.

    Row 0 stands for words without letters.
    """

    def __init__(self, model: LanguageModel):
        self.model = model
        self.clear()

    def clear(self) -> None:
        self.row: dict[str, int] = {}
        self.scores = np.zeros((1024, len(self.model.languages)))
        self.used = 1

    def rows(self, words: set[str]) -> None:
        new = [w for w in words if w not in self.row]
        if len(self.row) + len(new) > CACHE_ENTRIES:
            self.clear()
            new = list(words)
        core = {w: core_of(w) for w in new}
        stems = list({c for c in core.values() if c and c not in self.row})
        if stems:
            self._add(stems, self.model.log_probabilities(stems))
        for w, c in core.items():
            self.row[w] = self.row[c] if c else 0

    def _add(self, words: list[str], scores: np.ndarray) -> None:
        while self.used + len(words) > len(self.scores):
            self.scores = np.vstack([self.scores, np.zeros_like(self.scores)])
        self.scores[self.used : self.used + len(words)] = scores
        self.row.update(zip(words, range(self.used, self.used + len(words)), strict=True))
        self.used += len(words)

    def texts(self, texts: list[str]) -> np.ndarray:
        """(text, language) log probabilities; a row of nan for a text without a word of letters."""
        split = [words_of(t) for t in texts]
        self.rows({w for words in split for w in words})
        out = np.full((len(texts), len(self.model.languages)), np.nan)
        for i, words in enumerate(split):
            rows = np.fromiter(map(self.row.__getitem__, words), np.int64, len(words))
            if rows.any():
                out[i] = self.scores[rows].sum(axis=0)
        return out


def learn(counts: dict[str, Counter], pieces: list[str], rounds: int = 3, floor: float = 1e-7) -> LanguageModel:
    """Piece probabilities of every language from its word counts, those of words of up to LONGEST characters."""
    languages = sorted(counts)
    index = {p: i for i, p in enumerate(pieces)}
    p = np.full((len(pieces) + 2, len(languages)), 1.0 / max(1, len(pieces)))
    p[-1] = 0.0
    p[-2] = floor
    words = sorted({c for of in counts.values() for c in map(core_of, of) if 0 < len(c) <= LONGEST})
    place = {w: i for i, w in enumerate(words)}
    n = np.zeros((len(words), len(languages)))
    for k, language in enumerate(languages):
        for w, times in counts[language].items():
            if (c := core_of(w)) in place:
                n[place[c], k] += times
    table = PieceTable(index)
    groups = [(Lattice(table, same[i : i + 20_000]), [place[w] for w in same[i : i + 20_000]]) for same in by_length(words).values() for i in range(0, len(same), 20_000)]
    for _ in range(rounds if words else 0):
        expected = sum(lattice.expected(p, n[rows]) for lattice, rows in groups)
        expected[:-2] += 1e-3
        p = expected / expected.sum(axis=0)
        p[:-2] = np.maximum(p[:-2], floor)
        p[-2], p[-1] = floor, 0.0
    return LanguageModel(languages, index, p, table)


def fit_languages(docs: DataFrame, vocabulary_path: str, usable, per_language: int = 300, seed: int = 7) -> LanguageModel:
    """The model, from the words of at most about ``per_language`` usable documents of each language.

    ``docs`` has doc_id, text and lang; ``usable`` is a condition on doc_id. Languages with the
    same words are told apart by order of name. Null texts and languages are not learnt from.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    rows = rows.filter(F.col("lang").isNotNull() & usable)
    sizes = {r.lang: r["count"] for r in rows.groupBy("lang").count().collect()}
    chosen = F.lit(False)
    for lang, n in sizes.items():
        chosen = chosen | ((F.col("lang") == lang) & hashed_share("doc_id", per_language / n, seed))
    counts: dict[str, Counter] = {lang: Counter() for lang in sizes}
    for lang, text in rows.filter(chosen & F.col("text").isNotNull()).select("lang", "text").toPandas().itertuples(index=False):
        counts[lang].update(words_of(text))
    return learn(counts, vocabulary(vocabulary_path))


def _predict(scores: WordScores, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    """Languages and posterior probabilities (uniform prior) of texts."""
    names = scores.model.languages
    has_letter = [bool(t and LETTER.search(t)) for t in texts]
    if not names:
        return ["und"] * len(texts), np.zeros(len(texts))
    logs = np.nan_to_num(scores.texts([t if ok else "" for t, ok in zip(texts, has_letter, strict=True)]))
    best = logs.argmax(axis=1)
    posterior = 1.0 / np.exp(logs - logs.max(axis=1, keepdims=True)).sum(axis=1)
    return [names[k] if ok else "und" for k, ok in zip(best, has_letter, strict=True)], np.where(has_letter, posterior, 0.0)


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """doc_id, lang_pred and score (posterior probability, 0 to 1) of every row, from its whole text.

    ``und`` with score 0 if the text is null or has no letter, or if no language was learnt. Equal
    posteriors go to the first language by name. Repeated rows and null doc_ids are ordinary rows.
    """

    def predict(batches):
        scores = WordScores(model)
        for batch in batches:
            for part, texts in slices(batch):
                lang, score = _predict(scores, texts)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64())], names=["doc_id", "lang_pred", "score"])

    return keyed_texts(docs).mapInArrow(predict, "doc_id long, lang_pred string, score double")


def keep_identified(docs: DataFrame, model: LanguageModel, least_score: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns, whose text has a language with at least ``least_score``."""

    def judge():
        scores = WordScores(model)
        return lambda texts: [name != "und" and s >= least_score for name, s in zip(*_predict(scores, texts), strict=True)]

    return docs.filter(text_condition(judge)(F.col("text").cast("string")))
