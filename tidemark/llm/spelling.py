"""Spelling variants by reduced-alphabet generation.

Letters are hashed to a few symbols. Words at one edit from each other have reduced words at one
edit or none, so every word generates the full one-edit neighbourhood of its reduced word, and
neighbours that are reduced words of the vocabulary name the candidates. Candidates are verified
on the words themselves. A neighbourhood has no repeats, so a pair meets once from either side.

Reduced words and neighbours are 64-bit hashes, all of which follow from prefix and suffix hashes:
the neighbourhood of a word takes time in proportion to its length. A bitmap of the reduced
vocabulary lets go of neighbours that no word has before they are exchanged.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import keyed_texts
from tidemark.llm.filters import key_filter
from tidemark.session import stored

RUN = "[A-Za-zÀ-ÿ]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SYMBOLS = 8
BASE = np.uint64(0x9E3779B97F4A7C15)
CELLS = 1 << 20  # neighbours made at once


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def reduced(words: list[str]) -> np.ndarray:
    """Symbols 1 to SYMBOLS of words of equal length, a row each."""
    codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(words), -1)
    return (_mixed(codes.astype(np.uint64) * BASE) % np.uint64(SYMBOLS)) + np.uint64(1)


def _powers(n: int) -> np.ndarray:
    out = np.full(n, BASE)
    out[0] = 1
    return np.multiply.accumulate(out)


def _prefixes(x: np.ndarray) -> np.ndarray:
    """Hashes of the first 0 to n symbols."""
    out = np.zeros((len(x), x.shape[1] + 1), np.uint64)
    for i in range(x.shape[1]):
        out[:, i + 1] = out[:, i] * BASE + x[:, i]
    return out


def _suffixes(x: np.ndarray, power: np.ndarray) -> np.ndarray:
    """Hashes of the symbols from 0 to n on."""
    out = np.zeros((len(x), x.shape[1] + 1), np.uint64)
    terms = x * power[x.shape[1] - 1 :: -1]
    out[:, :-1] = np.add.accumulate(terms[:, ::-1], axis=1)[:, ::-1]
    return out


def word_hashes(x: np.ndarray) -> np.ndarray:
    return _mixed(_prefixes(x)[:, -1])


def neighbourhoods(x: np.ndarray):
    """(rows, hashes) of all reduced words within one edit of rows of symbols, without repeats, in parts.

    Of a run of equal symbols only the first is deleted, and a symbol is never inserted behind
    its equal, so no neighbour comes twice.
    """
    m, n = x.shape
    power = _powers(n + 2)
    head, tail = _prefixes(x), _suffixes(x, power)
    rows = np.arange(m)
    yield rows, _mixed(head[:, n])
    step = max(1, CELLS // m)
    for lo in range(0, n + 1, step):
        at = np.arange(lo, min(n, lo + step))
        before = np.concatenate([np.zeros((m, 1), np.uint64), x], axis=1)[:, lo : lo + step]  # symbol before each place
        new = before[:, : len(at)] != x[:, at]
        h = head[:, at] * power[n - 1 - at] + tail[:, at + 1]
        yield np.nonzero(new)[0], _mixed(h[new])
        places = np.arange(lo, min(n + 1, lo + step))
        for c in range(1, SYMBOLS + 1):
            symbol = np.uint64(c)
            other = x[:, at] != symbol
            h = head[:, at] * power[n - at] + symbol * power[n - 1 - at] + tail[:, at + 1]
            yield np.nonzero(other)[0], _mixed(h[other])
            other = before[:, : len(places)] != symbol
            h = head[:, places] * power[n + 1 - places] + symbol * power[n - places] + tail[:, places]
            yield np.nonzero(other)[0], _mixed(h[other])


def _alike(words: list[str]):
    """Places of words of equal length, at most CELLS symbols at once."""
    by: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        by.setdefault(len(w), []).append(i)
    for n, places in by.items():
        most = max(1, CELLS // max(1, n))
        for i in range(0, len(places), most):
            yield places[i : i + most]


def _with_hashes(words: DataFrame) -> DataFrame:
    """word, n and the hash of the reduced word."""

    def run(batches):
        for batch in batches:
            words = batch.column(0).to_pylist()
            out = np.zeros(len(words), np.uint64)
            for places in _alike(words):
                out[places] = word_hashes(reduced([words[i] for i in places]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out.view(np.int64))], names=["word", "n", "key"])

    return words.select("word", "n").mapInArrow(run, "word string, n long, key long")


def _neighbours(words: DataFrame, held) -> DataFrame:
    """word and the hash of each neighbour that may be a reduced word of the vocabulary."""

    def run(batches):
        for batch in batches:
            words = batch.column(0).to_pylist()
            for places in _alike(words):
                same = [words[i] for i in places]
                for rows, hashes in neighbourhoods(reduced(same)):
                    found = held.may_hold(hashes)
                    if found.any():
                        yield pa.RecordBatch.from_arrays([pa.array([same[i] for i in rows[found]], pa.string()), pa.array(hashes[found].view(np.int64))], names=["word", "key"])

    return words.select("word").mapInArrow(run, "word string, key long")


def vocabulary(docs: DataFrame, least_length: int = 5, least_count: int = 3, slip: int = 97) -> DataFrame:
    """word and n: letter runs of the whole texts, A-Z lower-cased, one code point less where the hash of key and run says so.

    Null texts have no words; a null doc_id counts as the empty text; repeated rows count again.
    """
    ascii_only = F.octet_length("run") == F.char_length("run")
    runs = keyed_texts(docs).select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(F.regexp_extract_all("text", F.lit(RUN), F.lit(0))).alias("run"))
    runs = runs.filter(F.char_length("run") >= least_length).withColumn("run", F.when(ascii_only, F.lower("run")).otherwise(F.translate("run", UPPER, UPPER.lower())))
    runs = runs.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
    at = "cast(h % char_length(run) as int)"
    word = F.when(F.col("h") % slip == 0, F.expr(f"concat(substring(run, 1, {at}), substring(run, {at} + 2))")).otherwise(F.col("run"))
    counted = runs.select(word.alias("word")).filter(F.char_length("word") >= least_length).groupBy("word").agg(F.count("*").alias("n"))
    return counted.filter(F.col("n") >= least_count)


def near_words(words: DataFrame) -> DataFrame:
    """word, near and near_n: every ordered pair of words of the table (word, n, key) at exactly one edit, once.

    Spark takes the neighbours to be no more than the words, so it is told not to broadcast them.
    """
    other = words.select("key", F.col("word").alias("near"), F.col("n").alias("near_n")).hint("merge")
    edit = (F.col("word") != F.col("near")) & (F.levenshtein("word", "near", 1) == 1)
    return _neighbours(words, key_filter(words)).join(other, "key").filter(edit).select("word", "near", "near_n")


def roots(links: DataFrame) -> DataFrame:
    """word and root: the end of each word's chain of forms, by pointer jumping. ``links`` is (word, form), without cycles."""
    held = stored(links.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = held.select(F.col("word").alias("root"), F.col("root").alias("next")).hint("merge")  # a table's file is smaller than its rows
        new = stored(held.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        held = new.select("word", "root")
        if new.filter("moved").isEmpty():
            return held


def spelling_variants(docs: DataFrame, least_length: int = 5, least_count: int = 3, slip: int = 97) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word of the vocabulary.

    form is the near word (one edit away) of largest n, ties to the smallest in code-point order,
    if it occurs at least twice as often as the word, else null; root follows forms to the last.
    Nulls, ties and repeated rows: see ``vocabulary``. Words of any length are compared whole. No
    words give no rows.
    """
    words = stored(_with_hashes(vocabulary(docs, least_length, least_count, slip)), "words")
    best = near_words(words).groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("form"))).alias("best"))
    telling = -F.col("best.n") >= 2 * F.col("n")
    found = words.join(best.hint("merge"), "word", "left").select(
        "word",
        F.when(telling, F.col("best.form")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(telling, -F.col("best.n")).alias("form_n"),
    )
    found = stored(found, "forms")
    ends = roots(found.filter("form is not null")).hint("merge")
    return found.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


#: DuckDB SQL for the rows of ``spelling_variants``; crc32 byte by byte, near words by equal remainders.
ORACLE_SQL = f"""
WITH RECURSIVE octets(i, v, k) AS (
    SELECT range, range, 0 FROM range(256)
    UNION ALL SELECT i, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, k + 1 FROM octets WHERE k < 8
), crc_table AS (
    SELECT i, v FROM octets WHERE k = 8
), runs AS (
    SELECT coalesce(doc_id::VARCHAR, '') AS id, translate(run, '{UPPER}', '{UPPER.lower()}') AS run, count(*) AS n
    FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents) GROUP BY 1, 2
), state(id, run, n, h, p, c) AS (
    SELECT id, run, n, hex(encode(id || ':' || run)), 0, 4294967295::BIGINT FROM runs WHERE length(run) >= 5
    UNION ALL
    SELECT id, run, n, h, p + 1, xor(c >> 8, v) FROM state
    JOIN crc_table ON i = xor(c & 255, 16 * (strpos('0123456789ABCDEF', h[2 * p + 1]) - 1) + strpos('0123456789ABCDEF', h[2 * p + 2]) - 1)
    WHERE 2 * p < length(h)
), hashed AS (
    SELECT run, n, xor(c, 4294967295) AS h FROM state WHERE 2 * p = length(h)
), slipped AS (
    SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed
), words AS (
    SELECT word, sum(n)::BIGINT AS n FROM slipped WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
), cuts AS (
    SELECT word, n, p, substr(word, 1, p) || substr(word, p + 2) AS rest FROM (SELECT word, n, unnest(range(length(word))) AS p FROM words)
), near AS (
    SELECT a.word, b.word AS near, b.n AS near_n FROM cuts a JOIN cuts b ON a.rest = b.rest AND a.p = b.p AND a.word <> b.word
    UNION SELECT a.word, b.word, b.n FROM cuts a JOIN words b ON a.rest = b.word
    UNION SELECT b.word, a.word, a.n FROM cuts a JOIN words b ON a.rest = b.word
), best AS (
    SELECT word, count(*) AS n_near, min((-near_n, near)) AS best FROM near GROUP BY word
), forms AS (
    SELECT word, n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN -best[1] >= 2 * n THEN best[2] END AS form, CASE WHEN -best[1] >= 2 * n THEN -best[1] END AS form_n
    FROM words LEFT JOIN best USING (word)
), chain(word, root) AS (
    SELECT word, word FROM forms UNION ALL SELECT chain.word, forms.form FROM chain JOIN forms ON chain.root = forms.word WHERE forms.form IS NOT NULL
)
SELECT word, form, root, n, n_near, form_n::BIGINT AS form_n FROM forms JOIN (SELECT chain.word, root FROM chain JOIN forms ON root = forms.word WHERE forms.form IS NULL) USING (word)"""
