"""N-gram Jaccard join with adaptive multi-match prefixes (operator 4).

Documents are sets of word 4-grams; two link when 100 * |A and B| is at least
85 * |A or B|.  The join finds the components of these links.

*Prefixes.*  All sets are sorted by one global order, rare 4-grams first.  A
set of n needs to share o = ceil(0.85 n) with any partner, so two linked sets
share at least l 4-grams among the first n - o + l of each, for every l.  With
l = 1 that is the classic prefix filter.  Here each document picks its own l:
from the estimated document frequencies it reckons, for each l, the postings
its prefix would meet, P(l), and takes the l with the least cost
``n - o + l + COST * P(l) / l``.  A longer prefix asks for more: what two sets
share beyond the shorter-reaching prefix lies in that set's other o - l
4-grams, so they have to share, among their prefix entries, at least
T = (overlap that their sizes ask for) - (greater o - l of the two) of them;
each step of l raises T by one.

*Candidates.*  Entries that no other set has are no use, so each entry knows
its place i among the h shared entries of its set.  Two sets whose first
common entry stands at i and j can share no more than min(h - i, h' - j)
entries; a pair becomes a candidate only at entries where that is T or more.
Every linked pair is one at its first common entry.

*Frequencies* come from a sketch of 2**20 counters over all documents (counts
of 4-grams by hash; 4 MB whatever the input).  Any order is correct; the
sketch only has to put the very frequent last.

*Copies.*  Equal sets are one node (a 64-bit digest of the set), so copies
meet nothing but partial aggregates.  Near copies are thinned before pairs are
made: each node is verified against one partner, a central node: in every
4-gram's group that is the node whose entries stand in the largest groups, as
the original of edited copies does, and a node takes the one it shares most
with, if that is half of its prefix.  Components of those links close whole
groups of near copies with a number of pairs that is linear in the group.
Then the complete join runs between *different* components only, for two nodes
of one component need no further link.  4-grams all of whose nodes are in one
component drop out before it.  No link is lost: every pair not joined is
connected already.

*Verification* is exact, by the sets of the nodes that occur in a pair.

Defined cases: a null or empty text, or one without words, has the empty set,
links with nothing and is its own component; fewer than four words are one
shingle; equal rows link; rows with a null key take part, and the smallest key
that is not null names the component (null if there is none); an empty table
gives an empty table; other columns are left out; whole texts are read.
4-grams and sets are told apart by 64-bit hashes.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh3_64_intdigest

from tidemark.llm.common import map_columns, read, slices, split_by_keys, written
from tidemark.llm.components import components

#: Words of a shingle, and the similarity of a link in hundredths.
WORDS, PERCENT = 4, 85
#: Counters of the sketch (a power of two) and in how many blocks they travel.
COUNTERS, BLOCKS, FAN_IN = 1 << 20, 64, 64
#: The largest l, and what a posting costs against a prefix entry.
MOST, COST = 4, 2.0
#: An entry's m: size of the set << 36 | place in the prefix << 4 | l.
SIZE_BIT, PLACE_BIT = 36, 4
#: Bits of the fixed-size filter over the keys of nodes in pairs.
FILTER = 1 << 20
#: Words and nodes that a task remembers.
WORD_MEMORY, NODE_MEMORY = 100_000, 200_000


class _Words(dict):
    """A 64-bit number for each word, the same everywhere."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORD_MEMORY:
            self.clear()
        got = self[word] = xxh3_64_intdigest(word)
        return got


def _spread(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, known: _Words, words: int = WORDS) -> np.ndarray:
    """The sorted distinct shingle hashes of a text.  Encoded text is lowered
    and split by ASCII rules: A-Z only, at blanks and \\x09-\\x0D only."""
    h = np.array([*map(known.__getitem__, text.encode("utf-8", "surrogatepass").lower().split())] if text else [], np.uint64)
    if not len(h):
        return h
    size = min(words, len(h))
    with np.errstate(over="ignore"):
        s = np.full(len(h) - size + 1, size, np.uint64)
        for i in range(size):
            s = (s + h[i : len(h) - size + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
            s ^= s >> np.uint64(29)
        s = np.sort(_spread(s))
    return s[np.r_[True, s[1:] != s[:-1]]]


def node_of(sorted_set: np.ndarray) -> int | None:
    """The digest that stands for a set; null for the empty one."""
    if not len(sorted_set):
        return None
    return int.from_bytes(hashlib.blake2b(sorted_set.tobytes(), digest_size=8).digest(), "little", signed=True)


def _bucket(sorted_set: np.ndarray) -> np.ndarray:
    return (sorted_set >> np.uint64(64 - COUNTERS.bit_length() + 1)).astype(np.int64)


def _first_pass(docs: DataFrame, words: int) -> DataFrame:
    """Rows of two kinds: (key, n, node) of each document, and (part, block,
    counts) with each task's share of the sketch."""
    schema = T.StructType(
        [
            T.StructField("key", docs.schema[0].dataType),
            T.StructField("n", T.LongType()),
            T.StructField("node", T.LongType()),
            T.StructField("part", T.IntegerType()),
            T.StructField("block", T.IntegerType()),
            T.StructField("counts", T.BinaryType()),
        ]
    )

    def make():
        known, counts = _Words(), np.zeros(COUNTERS, np.uint32)

        def step(columns):
            nonlocal counts
            if columns is None:
                part = TaskContext.get().partitionId()
                told = [_packed(x) for x in np.split(counts, BLOCKS)]
                no = [None] * BLOCKS
                yield [no, no, no, [part] * BLOCKS, [*range(BLOCKS)], told]
                return
            for part in slices(columns[1]):
                sets = [shingles(t, known, words) for t in columns[1][part]]
                counts += np.bincount(_bucket(np.concatenate(sets)), minlength=COUNTERS).astype(np.uint32)
                no = [None] * len(sets)
                yield [columns[0][part], [len(s) for s in sets], [node_of(s) for s in sets], no, no, no]

        return step

    return map_columns(docs, schema, make)


def _packed(counts: np.ndarray) -> bytes:
    return zlib.compress(counts.astype(np.uint64).tobytes(), 1)


def _unpacked(counts: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(counts), np.uint64)


def _sketch(parts: DataFrame) -> np.ndarray:
    """The summed sketch: task shares are added up FAN_IN at a time, so no
    group is larger than that in the first steps; 4 to 8 MB reach the driver."""

    def add(group: pa.Table) -> pa.Table:
        total = _packed(sum(_unpacked(c) for c in group["counts"].to_pylist()))
        return pa.table([group["part"][:1], group["block"][:1], pa.array([total])], group.column_names)

    for _ in range(3):
        parts = parts.withColumn("part", F.floor(F.col("part") / FAN_IN).cast("int"))
        parts = parts.groupBy("block", "part").applyInArrow(add, parts.schema)
    out = np.zeros((BLOCKS, COUNTERS // BLOCKS), np.uint64)
    for block, counts in parts.groupBy("block").agg(F.collect_list("counts")).collect():
        out[block] = sum(map(_unpacked, counts))
    return out.reshape(-1)


def prefix(sorted_set: np.ndarray, frequency: np.ndarray, partners: np.ndarray, percent: int = PERCENT) -> tuple[np.ndarray, int]:
    """A set's prefix in the global order and its multi-match l.  ``frequency``
    and ``partners``: the order's first key and the expected postings, by
    bucket."""
    n = len(sorted_set)
    need = -(-percent * n // 100)
    bucket = _bucket(sorted_set)
    order = np.argsort(frequency[bucket], kind="stable")  # of 16 bits: by radix
    most = min(MOST, need)
    lengths = n - need + np.arange(1, most + 1)
    met = np.cumsum(partners[bucket[order[: lengths[-1]]]])
    cost = lengths + COST * met[lengths - 1] / np.arange(1, most + 1)
    best = int(np.argmin(cost))
    return sorted_set[order[: lengths[best]]], best + 1


def _prefixes(docs: DataFrame, sketch: np.ndarray, words: int, percent: int) -> DataFrame:
    """(token, node, m): the prefix entries of every node; m packs the size of
    the set, the entry's place and l."""
    schema = T.StructType([T.StructField(c, T.LongType(), False) for c in ("token", "node", "m")])
    usual = float(np.median(sketch))
    # what a bucket holds beyond the usual crowd of 4-grams that are rare
    partners = np.maximum(sketch.astype(np.float64) - usual - 3 * np.sqrt(usual) - 1, 0).astype(np.float32)
    # counts by rank: 16 bits hold the order of the counts that occur
    ranks = np.minimum(np.unique(sketch, return_inverse=True)[1].reshape(-1), (1 << 16) - 1).astype(np.uint16)
    shared = docs.sparkSession.sparkContext.broadcast((ranks, partners))

    def make():
        (frequency, expected), known, seen = shared.value, _Words(), set()

        def step(columns):
            if columns is None:
                return
            for part in slices(columns[0]):
                tokens, nodes, ms, lengths = [], [], [], []
                for text in columns[0][part]:
                    s = shingles(text, known, words)
                    node = node_of(s)
                    if node is None or node in seen:
                        continue
                    if len(seen) >= NODE_MEMORY:
                        seen.clear()
                    seen.add(node)
                    p, multi = prefix(s, frequency, expected, percent)
                    tokens.append(p)
                    nodes.append(node)
                    ms.append((len(s) << SIZE_BIT) + (np.arange(len(p)) << PLACE_BIT) + multi)
                    lengths.append(len(p))
                if tokens:
                    yield [
                        np.concatenate(tokens).view(np.int64),
                        np.repeat(np.array(nodes, np.int64), lengths),
                        np.concatenate(ms),
                    ]

        return step

    return map_columns(docs.select(docs.columns[1]), schema, make)


def _sets(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(node, shingles) of the documents whose key is (or shares its place in
    a filter of fixed size with) one of ``wanted``."""
    place = F.pmod(F.xxhash64(F.col("key").cast("string")), F.lit(FILTER)).cast("int")
    held = np.zeros(FILTER, bool)
    held[[r[0] for r in wanted.select(place.alias("p")).distinct().collect()]] = True
    shared = docs.sparkSession.sparkContext.broadcast(held)
    schema = T.StructType(
        [T.StructField("node", T.LongType(), False), T.StructField("shingles", T.ArrayType(T.LongType(), False), False)]
    )

    def make():
        known, seen = _Words(), set()

        def step(columns):
            if columns is None:
                return
            for part in slices(columns[1]):
                nodes, sets = [], []
                for at, text in zip(columns[0][part], columns[1][part], strict=True):
                    if shared.value[at]:
                        s = shingles(text, known, words)
                        node = node_of(s)
                        if node is not None and node not in seen:
                            if len(seen) >= NODE_MEMORY:
                                seen.clear()
                            seen.add(node)
                            nodes.append(node)
                            sets.append(s.view(np.int64))
                if nodes:
                    yield [nodes, sets]

        return step

    return map_columns(docs.select(place.alias("p"), docs.columns[1]), schema, make)


def _linked(pairs: DataFrame, docs: DataFrame, keys: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) of nodes that link, by exact comparison of their sets."""
    pairs = written(pairs.select("a", "b"), "pairs")
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    sets = _sets(docs, nodes.join(keys, "node").select("key"), words)
    of_a = sets.select(F.col("node").alias("a"), F.col("shingles").alias("x"))
    of_b = sets.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    return (
        pairs.join(of_a, "a")
        .join(of_b, "b")
        .where(100 * both >= percent * (F.size("x") + F.size("y") - both))
        .select("a", "b")
        .distinct()
    )


def _need(n: str, percent: int) -> Column:
    """Overlap that a set's partners need at least: ceil(percent * n / 100)."""
    return F.floor((percent * F.col(n) + 99) / 100)


def _placed(entries: DataFrame) -> DataFrame:
    """Entries with h, how many their node has, and i, their place among
    those; a node has no more than its prefix."""
    of_node = W.partitionBy("node")
    return entries.withColumns(
        {"h": F.count("*").over(of_node), "i": F.row_number().over(of_node.orderBy("pos")) - 1}
    )


def join(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(key, n_shingles, component_id): one row for each row of ``docs``."""
    docs = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    first = written(_first_pass(docs, words), "shingles")
    members = first.where("part is null").select("key", "n", "node")
    sketch = _sketch(first.where("part is not null").select("part", "block", "counts"))
    keys = members.where("node is not null").groupBy("node").agg(F.min("key").alias("key"))

    entries = written(_prefixes(docs, sketch, words, percent), "prefixes")
    shared = entries.groupBy("token").agg(F.min("node").alias("x"), F.max("node").alias("y"), F.count("*").alias("df"))
    met = entries.join(shared.where("x < y").select("token", "df"), "token").distinct()
    met = met.select(
        "token", "node", "df",
        F.shiftright("m", SIZE_BIT).alias("n"),
        F.shiftright("m", PLACE_BIT).bitwiseAND((1 << (SIZE_BIT - PLACE_BIT)) - 1).alias("pos"),
        F.col("m").bitwiseAND((1 << PLACE_BIT) - 1).alias("l"),
    )
    met = written(met.withColumn("weight", F.sum("df").over(W.partitionBy("node"))), "met")

    # one central partner for each node
    centre = met.groupBy("token").agg(F.max(F.struct("weight", "node")).alias("c")).select("token", F.col("c.node").alias("other"))
    stars = (
        met.join(centre, "token")
        .where("node <> other")
        .groupBy("node", "other")
        .agg(F.count("*").alias("c"), F.first("n").alias("n"), F.first("l").alias("l"))
        .where(2 * F.col("c") >= F.col("n") - _need("n", percent) + F.col("l"))
        .groupBy("node")
        .agg(F.max(F.struct("c", "other")).alias("best"))
        .select(F.least("node", "best.other").alias("a"), F.greatest("node", "best.other").alias("b"))
        .distinct()
    )
    near = written(_linked(stars, docs, keys, words, percent), "links")
    told = components(near)

    # the complete join between what is not connected yet
    rest = met.drop("df", "weight").join(told, "node", "left").withColumn("component", F.coalesce("component", "node"))
    rest = written(rest, "open")
    several = (
        rest.groupBy("token").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x < y").select("token")
    )
    rest = written(_placed(rest.join(several, "token", "left_semi")), "open")
    names = ("node", "n", "l", "h", "i", "component")
    a = rest.select("token", *[F.col(c).alias(f"{c}_a") for c in names])
    b = rest.select("token", *[F.col(c).alias(f"{c}_b") for c in names])
    asked = F.ceil(percent * (F.col("n_a") + F.col("n_b")) / (100 + percent))
    beyond = F.greatest(_need("n_a", percent) - F.col("l_a"), _need("n_b", percent) - F.col("l_b"))
    ahead = F.least(F.col("h_a") - F.col("i_a"), F.col("h_b") - F.col("i_b"))
    pairs = (
        a.join(b, "token")
        .where((F.col("node_a") < F.col("node_b")) & (F.col("component_a") != F.col("component_b")))
        .where(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
        .where(ahead + beyond >= asked)
        .select(F.col("node_a").alias("a"), F.col("node_b").alias("b"))
        .distinct()
    )
    links = near.unionByName(_linked(pairs, docs, keys, words, percent))
    told = components(links)
    named = told.join(keys, "node").groupBy("component").agg(F.min("key").alias("least"))
    named = written(told.join(named, "component").select("node", "least"), "named")
    alone = written(keys.select("node", F.col("key").alias("own")), "alone")
    return (
        members.join(alone, "node", "left")
        .join(named, "node", "left")
        .select(
            F.col("key").alias(key),
            F.col("n").alias("n_shingles"),
            F.when(F.col("node").isNull(), F.col("key")).otherwise(F.coalesce("least", "own")).alias("component_id"),
        )
    )


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of each component, all columns as they are: the
    one with the smallest key (of rows that share it, the smallest digest of
    the text; of equal rows, any one).  Rows with the empty set are each their
    own component and all stay, whatever their keys.  Only rows that may have
    to go are shuffled."""
    row = ["_key", "_sum"]
    rows = docs.select(
        F.struct(*docs.columns).alias("_all"),
        F.col(key).alias("_key"),
        F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("_sum"),
        F.col(text).alias("_text"),
    )
    told = join(rows.select(F.struct(*row).alias("_row"), "_text"), "_row", "_text", words, percent)
    verdict = written(
        told.where("n_shingles > 0").groupBy("_row").agg((F.first("_row") != F.first("component_id")).alias("_goes"), F.count("*").alias("_n")),
        "verdict",
    )
    doubtful = verdict.where("_goes or _n > 1").select("_row.*", "_goes")
    clear, some = split_by_keys(rows, doubtful, row)
    match = F.col("_key").eqNullSafe(F.col("k")) & (F.col("_sum") == F.col("s"))
    out = doubtful.select(F.col("_key").alias("k"), F.col("_sum").alias("s"), "_goes")
    some = some.join(out, match, "left").where("not coalesce(_goes, false)")
    # rows that the filter let through by chance are no copies of each other
    some = some.withColumn("_own", F.when(F.col("_goes").isNull(), F.monotonically_increasing_id()))
    return clear.select("_all.*").unionByName(some.dropDuplicates([*row, "_own"]).select("_all.*"))


def q_op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of every whole text of ``documents``."""
    return join(read(spark, sf_dir, "documents"))


#: Brute force over all pairs that share a shingle; components by recursion.
SQL = r"""
WITH RECURSIVE words AS (SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS s FROM words),
items AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, a.n AS m, b.n AS n, count(*) AS c
    FROM items a JOIN items b ON a.x = b.x AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
    GROUP BY ALL),
links AS (SELECT a, b FROM shared WHERE 100 * c >= 85 * (m + n - c)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(doc_id, r) AS (SELECT doc_id, doc_id FROM sets UNION SELECT e.b, reach.r FROM reach JOIN edges e ON e.a = reach.doc_id)
SELECT s.doc_id, any_value(len(s.s))::BIGINT AS n_shingles, min(r) AS component_id FROM sets s JOIN reach USING (doc_id) GROUP BY s.doc_id
"""

QUERIES = {"op4_jaccard_join": q_op4_jaccard_join}
ORACLE_SQL = {"op4_jaccard_join": SQL}
