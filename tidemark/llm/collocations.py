"""Phrase collocations by dynamic itemset counting.

The documents are dealt into shards that are scanned in a cycle. Words are counted from the first
shard on. After every shard, phrases whose counts so far reach the threshold become known; a
longer phrase is active once its first words and its last words (all but one) are both known, and
is counted in the following shards until it has seen each of them once. So phrases of all lengths
are counted side by side, and the scans end when no phrase is active.

A scan knows the known phrases by bitmaps of bounded size, which may let through phrases that are
not active. That does no harm: a phrase is counted in a shard wholly or not at all, so its count
in a shard is the same whenever it is taken, and totals take each shard once.

Phrases are 64-bit hashes of language and words while they are counted. Texts are split and
hashed once, into the shards. In the end the frequent phrases get their words from the texts, a
small part of which has nearly all of them; the other texts are only read for phrases that have
not been met.
"""

from __future__ import annotations

import re
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_batches, read_batches, slices
from tidemark.llm.filters import KeyFilter, key_filter
from tidemark.session import new_table_path, stored

SEPARATORS = bytes.maketrans(b"\t.,;:!?\x0b\x0c\r", b" " + b"\n" * 9)
BLANK = re.compile(rb"[ \n]")
BLOCK = 1 << 19  # bytes of text split into words at once, one row of a shard
TEXTS_AT_ONCE, BLOCKS_AT_ONCE = 64, 1  # rows in a batch for Python
BLOCKS_READ = 16  # rows of a shard that its reader holds at once
HELD = 1 << 22  # bytes of texts that wait for their block to fill
CACHE_BYTES = 1 << 25
TOLD_BITS = 18  # of the table by which a task knows phrases that it has spelled
PARTS = ((0, 1), (1, 8), (8, 32))  # 32nds of the texts that are read for the words of phrases, one part after the other
BASE = np.uint64(0x9E3779B97F4A7C15)
UNDETERMINED = "und"


class WordHashes(dict):
    """Hashes of the words seen by this task, kept while there is room; 0 between pieces."""

    def __init__(self):
        super().__init__()
        self.held = 0

    def __missing__(self, word: bytes) -> int:
        self.held += len(word) + 150
        if self.held > CACHE_BYTES:
            self.clear()
            self.held = 0
        h = self[word] = (xxhash.xxh3_64_intdigest(word) or 1) if word != b"\n" else 0
        return h


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def blocks(texts: list[bytes], longest: int, size: int = BLOCK):
    """(words, new): runs of words with a newline between pieces. All but the last ``new`` words
    close the run before, so that phrases over the edge are seen once, by where they end."""
    data = b"\n".join(texts).lower().translate(SEPARATORS)  # of bytes: A-Z only
    words: list[bytes] = []
    at = 0
    while at < len(data):
        edge = BLANK.search(data, at + size)
        end = edge.start() if edge else len(data)
        part = [w for w in data[at:end].replace(b"\n", b" \n ").split(b" ") if w]
        words = words[max(0, len(words) - longest + 1) :] + part
        yield words, len(part)
        at = end


def language_key(lang: str) -> int:
    return xxhash.xxh3_64_intdigest(lang.encode(), seed=1)


def phrases(hashes: np.ndarray, new: int, lang: str, longest: int, known: KeyFilter, recent: KeyFilter | None):
    """(length, places, keys) of the phrases to be counted that end among the last ``new`` words.

    All words, and longer phrases whose first and last words are known, one of them recently if
    ``recent`` is given.
    """
    word = _mixed(hashes ^ np.uint64(language_key(lang)))
    places = np.flatnonzero(hashes != 0)
    keys = word[places]
    for k in range(1, longest + 1):
        told = places + k - 1 >= len(hashes) - new
        if k > 1:
            told &= due
        yield k, places[told], keys[told]
        if k == longest or not len(places):
            return
        alive = np.zeros(len(hashes) + 1, bool)
        alive[places] = known.may_hold(keys)
        late = np.zeros(len(hashes) + 1, bool)
        late[places] = True if recent is None else recent.may_hold(keys)
        before = np.zeros(len(hashes), np.uint64)
        before[places] = keys
        places = places[alive[places] & alive[places + 1]]
        due = late[places] | late[places + 1]
        keys = _mixed(before[places] * BASE + word[places + k] + np.uint64(k))


def _split(batches, keys: list[str], longest: int, cache: WordHashes):
    """(keys, words, hashes, new) for blocks of texts with the same keys, few bytes of which are held at a time."""
    groups: dict[tuple, list[bytes]] = {}
    sizes: dict[tuple, int] = {}

    def closed(key):
        del sizes[key]
        for words, new in blocks(groups.pop(key), longest):
            yield key, words, np.fromiter(map(cache.__getitem__, words), np.uint64, len(words)), new

    for batch in batches:
        for part, texts in slices(batch, batch.schema.get_field_index("text")):
            for *values, text in zip(*(part.column(k).to_pylist() for k in keys), texts, strict=True):
                key, data = tuple(values), text.encode("utf-8", "surrogatepass")
                groups.setdefault(key, []).append(data)
                sizes[key] = sizes.get(key, 0) + len(data)
                if sizes[key] >= BLOCK:
                    yield from closed(key)
            if sum(sizes.values()) > HELD:
                yield from closed(max(sizes, key=sizes.get))
    for key in list(groups):
        yield from closed(key)


def _hashed(texts: DataFrame, longest: int) -> DataFrame:
    """shard, lang, new and the hashes of the words of each block."""

    def run(batches):
        cache = WordHashes()
        for (shard, lang), _, hashes, new in _split(batches, ["shard", "lang"], longest, cache):
            yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([lang]), pa.array([new], pa.int64()), pa.array([hashes.tobytes()], pa.binary())], names=["shard", "lang", "new", "hashes"])

    return texts.select("shard", "lang", "text").mapInArrow(run, "shard int, lang string, new long, hashes binary")


def _scan(shard: DataFrame, longest: int, known: KeyFilter, recent: KeyFilter, with_words: bool) -> DataFrame:
    """k, key and c of the phrases due; length 0 counts the words of a language."""

    def run(batches):
        for batch in batches:
            for lang, new, hashes in zip(*(batch.column(k) for k in ("lang", "new", "hashes")), strict=True):
                lang, hashes = lang.as_py(), np.frombuffer(hashes.as_buffer(), np.uint64)
                for k, _, keys in phrases(hashes, new.as_py(), lang, longest, known, recent):
                    if k == 1 and not with_words:
                        continue
                    if k == 1:
                        yield _counts(0, np.array([language_key(lang)], np.uint64), np.array([len(keys)]))
                    if len(keys):
                        yield _counts(k, *np.unique(keys, return_counts=True))

    return shard.select("lang", "new", "hashes").mapInArrow(run, "k byte, key long, c long").groupBy("k", "key").agg(F.sum("c").alias("c"))


def _counts(k: int, keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), k, np.int8)), pa.array(keys.view(np.int64)), pa.array(counts, pa.int64())], names=["k", "key", "c"])


class Told:
    """The keys last seen by this task, one for each place of a table of fixed size."""

    def __init__(self, bits: int = TOLD_BITS):
        self.shift = np.uint64(64 - bits)
        self.keys = np.arange(1, (1 << bits) + 1, dtype=np.uint64) << self.shift  # none in its own place

    def new(self, keys: np.ndarray) -> np.ndarray:
        """Which of the distinct keys are not in the table; now they are."""
        place = (keys >> self.shift).astype(np.int64)
        new = self.keys[place] != keys
        self.keys[place[new]] = keys[new]
        return new


def _spelled(texts: DataFrame, longest: int, known: KeyFilter, wanted: KeyFilter) -> DataFrame:
    """lang, k, key and words of the wanted ones of the known phrases (and, of length 0, of the languages).

    Most of them once for each task, some of them more often.
    """

    def run(batches):
        cache, languages, told = WordHashes(), set(), Told()
        for (lang,), words, hashes, new in _split(batches, ["lang"], longest, cache):
            if lang not in languages:
                languages.add(lang)
                yield _named(lang, 0, np.array([language_key(lang)], np.uint64), [""])
            for k, places, keys in phrases(hashes, new, lang, longest, known, None):
                held = known.may_hold(keys) & wanted.may_hold(keys)
                keys, first = np.unique(keys[held], return_index=True)
                fresh = told.new(keys)
                yield _named(lang, k, keys[fresh], [b" ".join(words[p : p + k]).decode("utf-8", "replace") for p in places[held][first[fresh]]])

    return texts.select("lang", "text").mapInArrow(run, "lang string, k byte, key long, phrase string")


def _named(lang: str, k: int, keys: np.ndarray, named: list[str]) -> pa.RecordBatch:
    columns = [pa.array([lang] * len(named), pa.string()), pa.array(np.full(len(named), k, np.int8)), pa.array(keys.view(np.int64)), pa.array(named, pa.string())]
    return pa.RecordBatch.from_arrays(columns, names=["lang", "k", "key", "phrase"])


def _small(keys: DataFrame, most: int) -> DataFrame:
    """Keys for a broadcast if there are at most ``most`` of them, else for an ordinary join."""
    return F.broadcast(keys) if keys.count() <= most else keys


def frequent_phrases(docs: DataFrame, longest: int = 5, least: int = 100, shards: int = 2, most_broadcast: int = 500_000) -> DataFrame:
    """lang, k, phrase and f of every phrase of up to ``longest`` words that occurs ``least`` times in a language.

    Length 0 has the number of words of each language that has so many. The parameters choose only
    how the work is cut: ``shards`` scans are a cycle; frequent keys are broadcast up to
    ``most_broadcast`` of them and joined by exchange beyond.
    """
    spark = docs.sparkSession
    path = new_table_path(spark, "phrase-shards")
    texts = docs.filter("text is not null").select(F.coalesce(F.col("lang").cast("string"), F.lit(UNDETERMINED)).alias("lang"), F.col("text").cast("string").alias("text"), F.col("doc_id"))
    mixed = F.xxhash64("doc_id", "text")
    dealt = texts.withColumn("shard", F.pmod(mixed, F.lit(shards).cast("long")).cast("int"))
    with arrow_batches(spark, TEXTS_AT_ONCE):
        _hashed(dealt, longest).write.partitionBy("shard").option("compression", "zstd").parquet(path)  # words that recur far apart take few bytes
    table = spark.read.schema("lang string, new long, hashes binary, shard int").parquet(path)
    reached = spark.createDataFrame([], "k byte, key long, f long, stop int")
    held = spark.createDataFrame([], "k byte, key long, shard int, c long")  # counts, shard by shard, of phrases that have their share in one
    last: list[DataFrame] = []  # counts of the last cycle
    step = 0
    while True:
        before = reached.filter(F.col("k").between(1, longest - 1))
        recent = before.filter(F.col("stop") >= step - shards)
        if step >= shards and recent.isEmpty():
            break
        shard = step % shards
        counts = _scan(table.filter(F.col("shard") == shard), longest, key_filter(before), key_filter(recent), step < shards)
        with arrow_batches(spark, BLOCKS_AT_ONCE), read_batches(spark, BLOCKS_READ):
            counts = stored(counts, "phrase-counts").withColumn("shard", F.lit(shard))
        # what reaches the threshold in all shards reaches its share in one of them; what does so
        # now was active for at most a cycle
        old = held.select("k", "key").distinct()
        new = stored(counts.filter(F.col("c") * shards >= least).select("k", "key").join(old, ["k", "key"], "left_anti"), "telling")
        parts = [held, counts.join(_small(old.unionByName(new), most_broadcast), ["k", "key"])]
        new = _small(new, most_broadcast)
        parts += [c.join(new, ["k", "key"]) for c in last]
        held = reduce(DataFrame.unionByName, (p.select("k", "key", "shard", "c") for p in parts))
        held = stored(held.groupBy("k", "key", "shard").agg(F.max("c").alias("c")), "held")
        totals = held.groupBy("k", "key").agg(F.sum("c").alias("f")).filter(F.col("f") >= least)
        reached = stored(totals.join(reached.select("k", "key", "stop"), ["k", "key"], "left").select("k", "key", "f", F.coalesce("stop", F.lit(step)).alias("stop")), "reached")
        last = [*last, counts][1 - shards :] if shards > 1 else []
        step += 1
    known, wanted, found = key_filter(reached), reached.select("k", "key", "f"), []
    for start, end in PARTS:
        some = texts.filter(F.shiftrightunsigned(mixed, 59).between(start, end - 1))
        with arrow_batches(spark, TEXTS_AT_ONCE):
            spelled = _spelled(some, longest, known, key_filter(wanted)).distinct()
            found.append(stored(spelled.join(wanted, ["k", "key"]), "phrases"))
        wanted = stored(wanted.join(found[-1], ["k", "key"], "left_anti"), "unspelled")
        if wanted.isEmpty():
            break
    return reduce(DataFrame.unionByName, found).select("lang", F.col("k").cast("int").alias("k"), "phrase", "f")


def collocations(docs: DataFrame, longest: int = 5, least: int = 100, most: int = 2000, shards: int = 2) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score: the first ``most`` collocations of every language.

    A candidate is a phrase of 2 to ``longest`` words that occurs a >= ``least`` times within
    pieces of the whole texts. Its score is floor(1000 * a * n / (l * r)) at the cut that makes it
    lowest (ties: the first cut), in exact decimals. Candidates inside a longer one that occurs as
    often are dropped. Null texts have no words, a null language is ``und``, repeated rows count
    again, rows with null doc_id count like others; an empty table gives no rows. Ties in score and
    a go by phrase in byte order.
    """
    found = frequent_phrases(docs, longest, least, shards)
    words = F.split("phrase", " ")
    part = lambda start, length: F.array_join(F.slice(words, start, length), " ")
    candidates = found.filter("k >= 2").select("lang", "k", "phrase", F.col("f").alias("a"))
    inside = candidates.select("lang", F.col("a").alias("f"), F.explode(F.array(part(F.lit(1), F.col("k") - 1), part(F.lit(2), F.col("k") - 1))).alias("phrase")).filter(F.instr("phrase", " ") > 0)
    kept = candidates.join(inside.select("lang", "phrase", F.col("f").alias("a")).distinct(), ["lang", "phrase", "a"], "left_anti")
    cuts = kept.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("k") - 1)))
    cuts = cuts.withColumns({"first": part(F.lit(1), F.col("cut")), "rest": part(F.col("cut") + 1, F.col("k") - F.col("cut"))})
    cuts = cuts.join(found.filter("k > 0").select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"])
    cuts = cuts.join(found.filter("k > 0").select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    cuts = cuts.join(found.filter("k = 0").select("lang", F.col("f").alias("n")), "lang")
    cuts = cuts.withColumn("score", F.expr("cast(1000 * a as decimal(19, 0)) * cast(n as decimal(19, 0)) div (cast(l as decimal(19, 0)) * cast(r as decimal(19, 0)))"))
    scored = cuts.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "cut", "l", "r")).alias("m")).select("lang", "phrase", "a", "m.l", "m.r", "n", "m.score")
    order = (F.desc("score"), F.desc("a"), "phrase")
    # the first of every bucket, then the first of those: no task ranks a whole language
    scored = scored.withColumn("bucket", F.pmod(F.xxhash64("phrase"), F.lit(64).cast("long")))
    first = scored.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "bucket").orderBy(*order))).filter(F.col("rank") <= most)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= most)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


#: DuckDB SQL for the rows of ``collocations``, by plain counts of all phrases.
ORACLE_SQL = """
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents
), split AS (
    SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda w: w <> '') AS w FROM pieces
), places AS (
    SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM split
), f AS (
    SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS phrase, count(*) AS f FROM places, (SELECT unnest(range(1, 6)) AS k) WHERE i + k - 1 <= len(w) GROUP BY ALL HAVING count(*) >= 100
), totals AS (
    SELECT lang, count(*) AS n FROM places GROUP BY lang
), candidates AS (
    SELECT lang, k, phrase, f AS a FROM f WHERE k > 1
), kept AS (
    SELECT * FROM candidates c WHERE NOT EXISTS (SELECT 1 FROM candidates d WHERE d.lang = c.lang AND d.k > c.k AND d.a >= c.a AND contains(' ' || d.phrase || ' ', ' ' || c.phrase || ' '))
), cuts AS (
    SELECT lang, k, phrase, a, string_split(phrase, ' ') AS w, unnest(range(1, k)) AS cut FROM kept
), scored AS (
    SELECT cuts.lang, cuts.phrase, a, n, cut, p.f AS l, q.f AS r, (1000::HUGEINT * a * n) // (p.f::HUGEINT * q.f) AS score FROM cuts
    JOIN f p ON p.lang = cuts.lang AND p.phrase = array_to_string(w[1:cut], ' ') JOIN f q ON q.lang = cuts.lang AND q.phrase = array_to_string(w[cut + 1:], ' ') JOIN totals ON totals.lang = cuts.lang
), best AS (
    SELECT lang, phrase, a, n, min((score, cut, l, r)) AS m FROM scored GROUP BY lang, phrase, a, n
), ranked AS (
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY m[1] DESC, a DESC, encode(phrase)) AS rank, phrase, a, m[3] AS l, m[4] AS r, n, m[1]::BIGINT AS score FROM best
)
SELECT * FROM ranked WHERE rank <= 2000"""
