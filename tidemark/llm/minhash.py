"""Near-duplicates by min-max hashing.

Each permutation of the shingles gives two signature values, its minimum and its maximum, so half
the hash evaluations fill a signature. Rows of a band come from different permutations: minima
form bands of their own, maxima too. Documents that share a band are candidates; candidates are
confirmed on their full shingle sets. Bands that only one class has go no further than the count
of bands, by a bitmap of the others.

Equal sets are one class from the start, and only the class is compared. A band never gives all
pairs of its classes: the hub of a band is the class that meets most others in all its bands, and
in a round each class meets one hub, that of most of its bands, of those in other components. So
the pairs of a round are no more than the classes, and edited copies meet what they are copies of. After that, only pairs from different
components that were not tested remain, and what is left after those could link nothing further.

That last step takes every document of such an open band once. Shingles are ordered from rare to
common; two similar sets share one of the first shingles of either, and where they first meet
bounds how much they can still share. Only pairs within the bound leave the join, so documents
that have a band but little else in common cost no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_batches, arrow_bytes, keyed_texts, slices
from tidemark.llm.components import connected_components
from tidemark.llm.filters import KeyFilter, key_filter
from tidemark.session import stored

ROUNDS = 2  # in which every class is compared with one other that has a band in common
ROWS, GROUPS = 7, 36  # 36 groups of 7 permutations: 36 bands of minima and 36 of maxima
ROWS_AT_ONCE = 1000  # in a batch for Python; whole texts and sets stand in them or wait beside them
COUNTERS = 1 << 20  # hashed counts by which shingles are ordered; the order only has to be the same everywhere
CHUNK = 1024
_RANDOM = np.random.default_rng(20240229)
MULTIPLIERS = _RANDOM.integers(0, 1 << 63, (ROWS * GROUPS, 1), np.uint64) * np.uint64(2) + np.uint64(1)
MASKS = _RANDOM.integers(0, 1 << 63, (ROWS * GROUPS, 1), np.uint64) * np.uint64(2)
BAND_MIX = _RANDOM.integers(0, 1 << 63, (2 * GROUPS, ROWS), np.uint64) * np.uint64(2) + np.uint64(1)
SIGNED = "doc_id long, n_shingles long, cls binary, bands array<long>"


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingles(text: str | None, size: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct runs of ``size`` words; of all words if there are fewer; none without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # of bytes: A-Z, \\x20 and \\x09-\\x0D only
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    size = min(size, len(h))
    run = np.zeros(len(h) - size + 1, np.uint64)
    for k in range(size):
        run = _mix(run * np.uint64(0x9E3779B97F4A7C15) + h[k : k + len(run)] + np.uint64(size))
    return np.unique(run)


def extremes(values: np.ndarray, multipliers: np.ndarray, masks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Minimum and maximum of a set under each permutation."""
    low, high = np.full(len(multipliers), np.iinfo(np.uint64).max, np.uint64), np.zeros(len(multipliers), np.uint64)
    for at in range(0, len(values), CHUNK):
        h = (values[None, at : at + CHUNK] ^ masks) * multipliers
        np.minimum(low, h.min(axis=1), out=low)
        np.maximum(high, h.max(axis=1), out=high)
    return low, high


def bands(values: np.ndarray) -> np.ndarray:
    """Band hashes of a set, minima first."""
    low, high = extremes(values, MULTIPLIERS, MASKS)
    rows = np.concatenate([low.reshape(GROUPS, ROWS), high.reshape(GROUPS, ROWS)])
    return _mix((_mix(rows) * BAND_MIX).sum(axis=1, dtype=np.uint64)).view(np.int64)


def _signed(texts: DataFrame, size: int) -> DataFrame:
    """Set size, class (hash of the whole set) and bands; the last two are null for an empty set."""

    def run(batches):
        seen: dict[bytes, np.ndarray] = {}
        for batch, part in ((b, t) for whole in batches for b, t in slices(whole)):
            n, cls, band = [], [], []
            for text in part:
                s = shingles(text, size)
                n.append(len(s))
                key = xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None
                cls.append(key)
                if key is None:
                    band.append(None)
                    continue
                if key not in seen:
                    if len(seen) >= 2000:
                        seen.clear()
                    seen[key] = bands(s)
                band.append(seen[key])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(cls, pa.binary()), pa.array(band, pa.list_(pa.int64()))], names=["doc_id", "n_shingles", "cls", "bands"])

    return texts.mapInArrow(run, SIGNED)


def _sets(texts: DataFrame, size: int) -> DataFrame:
    """Class and shingles of every text with words."""

    def run(batches):
        for batch in batches:
            for _, part in slices(batch):
                sets = [s for s in (shingles(t, size) for t in part) if len(s)]
                content = [s.tobytes() for s in sets]
                columns = [pa.array(map(xxhash.xxh3_128_digest, content), pa.binary()), pa.array(content, pa.binary()), pa.array(map(len, sets), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["cls", "items", "n"])

    return texts.mapInArrow(run, "cls binary, items binary, n long").select(F.xxhash64("cls").alias("node"), "items", "n")


def _may_hold(keys: KeyFilter):
    """A condition on a column of keys; only the keys go to Python."""

    @F.arrow_udf("boolean")
    def condition(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array(keys.may_hold(batch.to_numpy(zero_copy_only=False)), pa.bool_())

    return condition


def _in_bands(nodes: DataFrame, held: KeyFilter) -> DataFrame:
    """node, pos and band of the bands that may be in the filter."""

    def run(batches):
        for batch in batches:
            lists = batch.column(1)
            band = lists.flatten().to_numpy()
            at = np.flatnonzero(held.may_hold(band))
            node = np.repeat(batch.column(0).to_numpy(), 2 * GROUPS)[at]
            yield pa.RecordBatch.from_arrays([pa.array(node), pa.array((at % (2 * GROUPS)).astype(np.int32)), pa.array(band[at])], names=["node", "pos", "band"])

    return nodes.select("node", "bands").mapInArrow(run, "node long, pos int, band long")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the similarity."""

    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                both = len(x) + len(y) - len(np.union1d(x, y))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    held = key_filter(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "node")

    def of_pairs(batches):
        """Only sets that may be in a pair are exchanged."""
        for batch in batches:
            yield batch.filter(pa.array(held.may_hold(batch.column(0).to_numpy())))

    sets = sets.select("node", "items").mapInArrow(of_pairs, "node long, items binary")
    left, right = sets.select(F.col("node").alias("a"), F.col("items").alias("x")), sets.select(F.col("node").alias("b"), F.col("items").alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def _counter(items: np.ndarray) -> np.ndarray:
    return (items & np.uint64(COUNTERS - 1)).astype(np.int64)


def _shingle_counts(sets: DataFrame) -> np.ndarray:
    """How many sets have shingles of each hashed counter: COUNTERS numbers, whatever the input."""

    def run(batches):
        counts = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            for items in batch.column(0):
                np.add.at(counts, _counter(np.frombuffer(items.as_buffer(), np.uint64)), 1)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], names=["at", "c"])

    rows = sets.select("items").mapInArrow(run, "at long, c long").groupBy("at").agg(F.sum("c").alias("c")).toArrow()
    out = np.zeros(COUNTERS, np.int64)
    out[rows.column("at").to_numpy()] = rows.column("c").to_numpy()
    return out


def _prefix_pairs(sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b), a < b, of nodes of different components whose sets may reach the similarity.

    sets: node, component, items. Shingles are ordered by counter and hash. Sets that reach the
    similarity share one of the first n - ceil(n * percent / 100) + 1 of either; from the first
    shingle they share, no more can be common than what is left behind it in the shorter rest.
    """
    counts = _shingle_counts(sets)

    def run(batches):
        for batch in batches:
            for node, component, content in zip(*(batch.column(k) for k in range(3)), strict=True):
                items = np.frombuffer(content.as_buffer(), np.uint64)
                items = items[np.lexsort((items, counts[_counter(items)]))]
                n = len(items)
                first = n - -(-n * percent // 100) + 1
                same = lambda x, m=first: np.full(m, x, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(items[:first].view(np.int64)), pa.array(same(node.as_py())), pa.array(same(component.as_py())), pa.array(same(n)), pa.array(np.arange(first))], names=["item", "node", "component", "n", "at"]
                )

    rows = sets.select("node", "component", "items").mapInArrow(run, "item long, node long, component long, n long, at long")
    left = rows.select("item", F.col("node").alias("a"), F.col("component").alias("ca"), F.col("n").alias("na"), (F.col("n") - F.col("at")).alias("ra"))
    right = rows.select("item", F.col("node").alias("b"), F.col("component").alias("cb"), F.col("n").alias("nb"), (F.col("n") - F.col("at")).alias("rb"))
    likely = f"a < b and ca <> cb and least(na, nb) * 100 >= greatest(na, nb) * {percent} and least(ra, rb) * {100 + percent} >= (na + nb) * {percent}"
    return left.join(right, "item").filter(likely).select("a", "b").distinct()


def near_duplicates(docs: DataFrame, shingle_words: int = 2, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row.

    Documents link if 100 * intersection >= percent * union of their shingle sets. component_id
    is the smallest doc_id reachable over links, the document's own included. Null, empty and
    wordless texts have no shingles and link with nothing. A null doc_id links with nothing
    either; its component_id is null and it is kept. Repeated rows have the same component. Rows
    that share a doc_id but not a text are placed by their own text.

    A pair at exactly 80 percent shares no band with a chance of 5e-8; all pairs with a band are
    found. Shingles are compared as 64-bit hashes.

    Texts and sets go to Python about a megabyte at a time.
    """
    with arrow_bytes(docs.sparkSession), arrow_batches(docs.sparkSession, ROWS_AT_ONCE):
        return _near_duplicates(docs, shingle_words, percent)


def _near_duplicates(docs: DataFrame, shingle_words: int, percent: int) -> DataFrame:
    """All jobs that use Python run before it returns; what is left of the plan has joins only."""
    spark = docs.sparkSession
    texts = keyed_texts(docs)
    signed = stored(_signed(texts, shingle_words), "signed")
    usable = signed.filter("cls is not null and doc_id is not null")
    # a node is a class; its first document only lends the text
    classes = stored(usable.groupBy("cls").agg(F.min("doc_id").alias("first"), F.count("*").alias("copies")).withColumn("node", F.xxhash64("cls")), "classes")
    # of classes of one document the bands need no exchange
    copied = _may_hold(key_filter(classes.filter("copies > 1"), "node"))
    bands_of = usable.select(F.xxhash64("cls").alias("node"), "cls", F.col("doc_id").alias("first"), "bands")
    lent = bands_of.filter(copied("node")).join(classes.select("cls", "first"), ["cls", "first"]).dropDuplicates(["node"])
    nodes = stored(bands_of.filter(~copied("node")).unionByName(lent).select("node", "bands"), "nodes")
    twice = nodes.select(F.explode("bands").alias("band")).groupBy("band").count().filter("count > 1").select("band")
    in_bands = _in_bands(nodes, key_filter(stored(twice, "twice"), "band"))
    several = in_bands.groupBy("pos", "band").agg(F.count("*").alias("size")).filter("size > 1")
    in_bands = stored(in_bands.join(several, ["pos", "band"]), "in-bands")
    met_by = in_bands.groupBy("node").agg(F.sum("size").alias("met"))
    hubs = in_bands.join(met_by, "node").groupBy("pos", "band").agg(F.max_by("node", F.struct("met", "node")).alias("hub"))
    shared = stored(in_bands.select("pos", "band", "node").join(hubs, ["pos", "band"]), "shared")
    members = stored(classes.join(shared.select("node").distinct(), "node", "left_semi").select(F.col("first").alias("doc_id")).distinct(), "members")
    # only texts that may be needed are exchanged
    needed = _may_hold(key_filter(members.select(F.xxhash64("doc_id").alias("key"))))
    sets = stored(_sets(texts.filter(needed(F.xxhash64("doc_id"))).join(members, "doc_id", "left_semi"), shingle_words), "sets")
    sizes = sets.select("node", "n").distinct()

    def of_like_size(pairs: DataFrame) -> DataFrame:
        for k in "ab":
            pairs = pairs.join(sizes.select(F.col("node").alias(k), F.col("n").alias(f"n{k}")), k)
        return pairs.filter(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent).select("a", "b", "c")

    def place(rows: DataFrame, node: str = "node", name: str = "component") -> DataFrame:
        return rows.join(components.select(F.col("node").alias(node), F.col("component").alias(name)), node, "left").withColumn(name, F.coalesce(name, node))

    met = stored(of_like_size(shared.filter("node <> hub").groupBy(F.col("hub").alias("a"), F.col("node").alias("b")).agg(F.count("*").alias("c"))), "met")
    tested = links = None
    components = spark.createDataFrame([], "node long, component long")
    for _ in range(ROUNDS):
        pairs = place(place(met, "a", "ca"), "b", "cb").filter("ca <> cb").select("a", "b", "c")
        pairs = pairs if tested is None else pairs.join(tested, ["a", "b"], "left_anti")
        pairs = stored(pairs.groupBy("b").agg(F.max_by("a", F.struct("c", "a")).alias("a")).select("a", "b"), "pairs")
        found = stored(_confirmed(pairs, sets, percent), "links")
        tested, links = (pairs, found) if tested is None else (tested.unionByName(pairs), links.unionByName(found))
        components = connected_components(links)

    placed = place(shared.select("pos", "band", "node"))
    open_bands = placed.groupBy("pos", "band").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x <> y").select("pos", "band")
    open_nodes = placed.join(open_bands, ["pos", "band"])
    open_nodes = open_nodes.select("node", "component").distinct()
    rest = _prefix_pairs(stored(sets.select("node", "items").join(open_nodes, "node"), "open"), percent).join(tested, ["a", "b"], "left_anti")
    more = stored(_confirmed(stored(rest, "pairs"), sets, percent), "links")
    if not more.isEmpty():
        components = connected_components(links.unionByName(more))

    placed = place(classes)
    smallest = placed.groupBy("component").agg(F.min("first").alias("component_id"))
    of_class = placed.join(smallest, "component").select("cls", "component_id")
    linked = usable.select("doc_id", "n_shingles", "cls").join(of_class, "cls").select("doc_id", "n_shingles", "component_id")
    alone = signed.filter("cls is null or doc_id is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def oracle_sql(shingle_words: int = 2, percent: int = 80) -> str:
    """DuckDB SQL for the rows of near_duplicates over ``documents``, by exact all-pairs counts."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"""
WITH RECURSIVE words AS (
    SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w FROM documents
), runs AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {shingle_words} THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - {shingle_words - 2}), lambda i: array_to_string(w[i : i + {shingle_words - 1}], ' '))) END AS s
    FROM words
), items AS (
    SELECT doc_id, unnest(s) AS x FROM runs
), sizes AS (
    SELECT doc_id, len(s) AS n FROM runs
), common AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM items a JOIN items b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY 1, 2
), links AS (
    SELECT a, b FROM common JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * c >= {percent} * (p.n + q.n - c)
), edges AS (
    SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach(doc_id, r) AS (
    SELECT doc_id, doc_id FROM documents UNION SELECT reach.doc_id, edges.b FROM reach JOIN edges ON reach.r = edges.a
)
SELECT doc_id, any_value(n)::BIGINT AS n_shingles, min(r) AS component_id, doc_id = min(r) AS kept FROM reach JOIN sizes USING (doc_id) GROUP BY doc_id"""
