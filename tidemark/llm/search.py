"""Ranked lexical search over range-maximum tables (operator 12).

*Index.*  ``build`` reads the documents where they lie and writes them as
segments, one row each: the documents' ids and lengths, the segment's terms and
for each term its posting list (place of the document, occurrences).  A segment
holds about ``SEGMENT`` bytes of text; its documents stand in the order of their
length, so that neighbours weigh alike.  No posting is shuffled.

*Memory.*  A segment is a row of several MB, so one segment at a time is what a
task holds, however many its part of the input makes: while documents are read
their words are numbers, ``stored`` writes a row group a segment (Parquet would
gather 100 rows before it looks at their size, and they would be read back
together), and a task's Python worker gets a segment a batch.  Row groups are
read without Hadoop's vectored reads.

*Scores.*  With N documents that have a term, L terms in all of them, n terms in
one and df documents with a term, a term weighs
``floor(1000 * ln((2 N + 2) / (2 df + 1)))`` and a document's
``m = 75 + (25 n N) div L``; tf occurrences have the impact
``(1000000000 tf) div (1000 tf + 12 m)``.  A document's score for an item is the
sum of weight times impact over the item's terms, repeats included.

*Search.*  For a block of items each segment gets, for the terms that occur in
the block, the impacts of its posting lists and over each list a sparse table:
level j holds for every posting the place of the greatest impact among 2**j, so
the greatest one of any range is the better of two entries.  An item starts with
the interval of all documents.  The sum of its lists' range maxima, times their
weights, bounds what any document in there can reach.  The interval with the
largest bound comes first: it is split at the document of the greatest single
share, which is scored on the spot, and the parts left and right of it get
their own bounds.  Parts of at most ``LEAF`` documents are scored whole.  An
item is done when the largest bound is below the least score it keeps; what it
keeps goes on from segment to segment of a task, so later segments are mostly
cut off at once.  Every task tells the best documents of each item, and a window
ranks them.  All of it is exact: nothing is left out by the tables.

*Blocks.*  Items come to the driver ``BLOCK_ITEMS`` (or ``BLOCK_TERMS`` terms)
at a time, and each block is one job over the index whose result is appended to
a table: neither the driver's memory nor a plan grows with the items.

Defined cases: a null or empty text has no terms; such an item has no result,
and such a document is none of the N; ids are integers; equal scores are ranked
by ascending id, null ids last; items that share an id are ranked each on its
own; repeated documents each count and rank; an empty table gives an empty
table; other columns are left out; long texts are read whole.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.llm.common import map_columns, read
from tidemark.session import scratch_path

#: Documents that an item gets.
TOP = 20
#: Bytes of text and documents of a segment.
SEGMENT, SEGMENT_DOCS = 1 << 23, 1 << 13
#: Intervals of so many documents are scored whole.
LEAF = 128
#: Items of a block, and terms of its items.
BLOCK_ITEMS, BLOCK_TERMS = 1000, 200_000
#: Bytes that are no part of a term become blanks, A-Z become a-z.
FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)
#: How documents and segments are read: with Hadoop's vectored reads an executor's
#: JVM took 200 MB more (row groups of 245 MB, two tasks).
PLAIN = {"parquet.hadoop.vectored.io.enabled": "false"}
#: What stands for a null id while documents are ranked.
LAST = np.iinfo(np.int64).max

INDEX = T.StructType(
    [
        T.StructField("n_docs", T.LongType(), False),
        T.StructField("n_terms", T.LongType(), False),
        T.StructField("ids", T.ArrayType(T.LongType()), False),
        T.StructField("lengths", T.ArrayType(T.IntegerType(), False), False),
        T.StructField("terms", T.ArrayType(T.StringType(), False), False),
        T.StructField("counts", T.ArrayType(T.IntegerType(), False), False),
        T.StructField("places", T.ArrayType(T.IntegerType(), False), False),
        T.StructField("tfs", T.ArrayType(T.IntegerType(), False), False),
    ]
)


class _Numbers(dict):
    """A number for each term, in the order of their coming."""

    def __missing__(self, term: bytes) -> int:
        got = self[term] = len(self)
        return got


def terms_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(FOLD).split() if text else []


def _segment(ids: list, words: list[np.ndarray], number: _Numbers) -> list[list]:
    """One index row, as columns of one value; ``words``: each document's terms
    by their ``number``."""
    lengths = np.array([len(w) for w in words], np.int64)
    order = np.lexsort(([LAST if i is None else i for i in ids], lengths))
    posting = np.concatenate([words[i] for i in order], dtype=np.int64)
    posting *= len(ids)
    posting += np.repeat(np.arange(len(ids)), lengths[order])
    posting, tfs = np.unique(posting, return_counts=True)
    term, places = np.divmod(posting, len(ids))
    counts = np.bincount(term, minlength=len(number))
    listed = lambda x: pa.ListArray.from_arrays([0, len(x)], pa.array(x, pa.int32()))
    names = [t.decode("utf-8", "replace") for t in number]
    return [
        [int((lengths > 0).sum())],
        [int(lengths.sum())],
        [[ids[i] for i in order]],
        listed(lengths[order]),
        [names],
        listed(counts),
        listed(places),
        listed(tfs),
    ]


def build(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The index of ``docs``, one row a segment; to be ``stored`` before use."""

    def make():
        ids, words, number, held = [], [], _Numbers(), 0

        def step(columns):
            nonlocal ids, words, number, held
            if columns is None:
                if ids:
                    yield _segment(ids, words, number)
                return
            for doc, text in zip(*columns, strict=True):
                ids.append(doc)
                terms = terms_of(text)
                words.append(np.fromiter(map(number.__getitem__, terms), np.int32, len(terms)))
                held += len(text) if text else 0
                if held >= SEGMENT or len(ids) >= SEGMENT_DOCS:
                    yield _segment(ids, words, number)
                    ids, words, number, held = [], [], _Numbers(), 0

        return step

    return map_columns(docs.select(F.col(key).cast("long"), F.col(text)), INDEX, make)


def stored(index: DataFrame) -> DataFrame:
    """``index`` written to the shared scratch folder, a row group a segment,
    and read back."""
    spark = index.sparkSession
    path = scratch_path(spark, "segments")
    index.write.option("parquet.block.row.count.limit", 1).parquet(path)
    return spark.read.options(**PLAIN).schema(index.schema).parquet(path)


@contextmanager
def _single_rows(spark: SparkSession) -> Iterator[None]:
    """The session's Arrow batches have one row each."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "1")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _rows(batch: pa.RecordBatch) -> Iterator[list]:
    """The columns of each row, as Arrow arrays."""
    for i in range(batch.num_rows):
        yield [c[i].values for c in batch.columns]


def _found(terms: pa.Array, asked: pa.Array) -> np.ndarray:
    """The place of each term in ``asked``, -1 for none."""
    return pc.fill_null(pc.index_in(terms, asked), -1).to_numpy(zero_copy_only=False)


class Lists:
    """A segment's posting lists of a block's terms, with their sparse tables."""

    def __init__(self, ids, lengths, found, counts, places, tfs, n_docs: int, n_terms: int):
        """``found``: the number that the block gives to each term, -1 for none."""
        self.ids, self.size = ids, len(lengths)
        m = 75 + 25 * lengths.astype(np.int64) * n_docs // n_terms
        here = found >= 0
        mine = np.repeat(here, counts)
        place, tf = places[mine].astype(np.int64), tfs[mine].astype(np.int64)
        counts = counts[here].astype(np.int64)
        self.place = place
        self.impact = 1_000_000_000 * tf // (1000 * tf + 12 * m[place])
        self.end = np.cumsum(counts)
        self.start = self.end - counts
        #: every posting's list and place as one ascending number
        self.order = np.repeat(np.arange(len(counts)), counts) * self.size + place
        self.list_of = dict(zip(found[here].tolist(), range(len(counts)), strict=True))
        total, longest = len(place), int(counts.max(initial=1))
        self.table = np.zeros((longest.bit_length(), total), np.int32)
        self.table[0] = np.arange(total)
        for j in range(1, len(self.table)):
            step, reach = 1 << (j - 1), total - (1 << j) + 1
            a, b = self.table[j - 1, :reach], self.table[j - 1, step : step + reach]
            self.table[j, :reach] = np.where(self.impact[a] >= self.impact[b], a, b)
        self.log = np.frexp(np.arange(longest + 1))[1] - 1  # floor of the binary logarithm

    def bounds(self, weights: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each row of posting ranges the sum of their greatest shares, and
        the document of the greatest one."""
        size = high - low
        level = self.log[np.maximum(size, 1)]
        a = self.table[level, np.minimum(low, len(self.place) - 1)]
        b = self.table[level, np.maximum(high - (1 << level), 0)]
        best = np.where(self.impact[a] >= self.impact[b], a, b)
        share = np.where(size > 0, weights * self.impact[best], 0)
        widest = share.argmax(axis=1)
        return share.sum(axis=1), self.place[best[np.arange(len(share)), widest]]

    def search(self, terms: list[int], weights: list[int], top: list, k: int) -> None:
        """``top``: the item's best (score, -id) so far, a heap; is brought up
        to date with this segment."""
        lists = [(self.list_of[t], w) for t, w in zip(terms, weights, strict=True) if t in self.list_of]
        if not lists:
            return
        which, weight = (np.array(x, np.int64) for x in zip(*lists, strict=True))
        low, high = self.start[which], self.end[which]
        base = which * self.size
        (bound,), (at,) = self.bounds(weight, low[None], high[None])
        heap, made = [(-bound, 0, 0, self.size, low, high, at)], 0
        while heap:
            less, _, first, last, low, high, at = heapq.heappop(heap)
            if -less < (top[0][0] if len(top) >= k else 1):
                return
            if last - first <= LEAF:
                size = high - low
                ends = np.cumsum(size)
                posting = np.arange(ends[-1]) + np.repeat(low - ends + size, size)
                share = np.repeat(weight, size) * self.impact[posting]
                scores = np.bincount(self.place[posting] - first, share, last - first).astype(np.int64)
                self._keep(top, k, first, scores)
                continue
            cut = np.searchsorted(self.order, base + at)
            has = (cut < high) & (self.order[np.minimum(cut, len(self.order) - 1)] == base + at)
            score = int((weight[has] * self.impact[cut[has]]).sum())
            self._keep(top, k, int(at), np.array([score]))
            lows, highs = np.stack([low, cut + has]), np.stack([cut, high])
            bounds, ats = self.bounds(weight, lows, highs)
            least = top[0][0] if len(top) >= k else 1
            for i, (a, b) in enumerate(((first, int(at)), (int(at) + 1, last))):
                if a < b and bounds[i] >= least:
                    made += 1
                    heapq.heappush(heap, (-bounds[i], made, a, b, lows[i], highs[i], ats[i]))

    def _keep(self, top: list, k: int, first: int, scores: np.ndarray) -> None:
        good = np.flatnonzero(scores >= (max(top[0][0], 1) if len(top) >= k else 1))
        if len(good) > k:
            good = good[np.lexsort((self.ids[first + good], -scores[good]))[:k]]
        for score, doc in zip(scores[good].tolist(), self.ids[first + good].tolist(), strict=True):
            if len(top) < k:
                heapq.heappush(top, (score, -doc))
            elif (score, -doc) > top[0]:
                heapq.heapreplace(top, (score, -doc))


def _blocks(items: DataFrame) -> Iterator[list[tuple]]:
    """(id, terms with their counts) of the items, a block at a time."""
    block, held = [], 0
    for row in items.toLocalIterator():
        counted = Counter(t.decode("utf-8", "replace") for t in terms_of(row[1]))
        if block and (len(block) >= BLOCK_ITEMS or held + len(counted) > BLOCK_TERMS):
            yield block
            block, held = [], 0
        if counted:
            block.append((row[0], counted))
            held += len(counted)
    if block:
        yield block


def _weights(index: DataFrame, terms: list[str], n_docs: int) -> dict[str, int]:
    """The weights of a block's terms, those that weigh something."""
    schema = T.StructType([T.StructField("number", T.IntegerType(), False), T.StructField("df", T.LongType(), False)])
    shared = index.sparkSession.sparkContext.broadcast(terms)  # at most BLOCK_TERMS

    def run(batches):
        asked = pa.array(shared.value, pa.string())
        df = np.zeros(len(asked), np.int64)
        for batch in batches:
            for names, counts in _rows(batch):
                found = _found(names, asked)
                np.add.at(df, found[found >= 0], counts.to_numpy()[found >= 0])
        some = np.flatnonzero(df)
        to = to_arrow_schema(schema)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(df[some])], schema=to)

    each = index.select("terms", "counts").mapInArrow(run, schema)
    with _single_rows(index.sparkSession):
        df = [(terms[i], n) for i, n in each.groupBy("number").agg(F.sum("df")).collect()]
    weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for t, n in df}
    return {t: w for t, w in weight.items() if w > 0}


def _best(index: DataFrame, block: list[tuple], weights: dict[str, int], n_docs: int, n_terms: int, k: int) -> DataFrame:
    """(item, doc_id, score): the best documents of each task for each item,
    which is told by its place in the block."""
    schema = T.StructType(
        [
            T.StructField("item", T.IntegerType(), False),
            T.StructField("doc_id", T.LongType()),
            T.StructField("score", T.LongType(), False),
        ]
    )
    number = {t: i for i, t in enumerate(weights)}
    items = [
        ([number[t] for t in counted if t in number], [n * weights[t] for t, n in counted.items() if t in number])
        for _, counted in block
    ]
    shared = index.sparkSession.sparkContext.broadcast((list(weights), items))

    def run(batches):
        terms, asked = shared.value
        terms, tops = pa.array(terms, pa.string()), [[] for _ in asked]
        for batch in batches:
            for row in _rows(batch):
                ids = pc.fill_null(row[0], LAST).to_numpy(zero_copy_only=False)
                found = _found(row[2], terms)
                if (found < 0).all():
                    continue
                lists = Lists(ids, row[1].to_numpy(), found, *(x.to_numpy() for x in row[3:]), n_docs, n_terms)
                for (which, weight), top in zip(asked, tops, strict=True):
                    lists.search(which, weight, top, k)
        rows = [(i, None if -doc == LAST else -doc, score) for i, top in enumerate(tops) for score, doc in top]
        to = to_arrow_schema(schema)
        yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], f.type) for c, f in enumerate(to)], schema=to)
        # a worker is kept for the next task: what this one has freed goes back
        pa.default_memory_pool().release_unused()

    return index.select("ids", "lengths", "terms", "counts", "places", "tfs").mapInArrow(run, schema)


def search(index: DataFrame, items: DataFrame, key: str = "item_id", text: str = "text", k: int = TOP) -> DataFrame:
    """(key, rank, doc_id, score): the ``k`` best documents of each item of
    ``items`` with a score above 0."""
    spark = index.sparkSession
    n_docs, n_terms = index.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    items = items.select(F.col(key).alias("id"), F.col(text))
    schema = T.StructType(
        [
            T.StructField(key, items.schema[0].dataType),
            T.StructField("rank", T.IntegerType()),
            T.StructField("doc_id", T.LongType()),
            T.StructField("score", T.LongType()),
        ]
    )
    path = scratch_path(spark, "ranked")
    spark.createDataFrame([], schema).write.parquet(path)
    order = W.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    for block in _blocks(items) if n_terms else ():
        weights = _weights(index, sorted({t for _, counted in block for t in counted}), n_docs)
        best = _best(index, block, weights, n_docs, n_terms, k)
        ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        names = F.broadcast(spark.createDataFrame([(i, b[0]) for i, b in enumerate(block)], T.StructType([T.StructField("item", T.IntegerType()), schema[0]])))
        with _single_rows(spark):
            ranked.join(names, "item").select(*schema.names).write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path)


def q_op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` ranked for each ``benchmark`` item."""
    index = stored(build(read(spark, sf_dir, "documents", PLAIN)))
    return search(index, read(spark, sf_dir, "benchmark"))


_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
SQL = rf"""
WITH docs AS (SELECT row_number() OVER () AS d, doc_id, regexp_extract_all({_LOWER}, '{_TERM}') AS ws FROM documents),
asked AS (SELECT row_number() OVER () AS i, item_id, regexp_extract_all({_LOWER}, '{_TERM}') AS ws FROM benchmark),
totals AS (SELECT count(*) FILTER (len(ws) > 0) AS n_docs, sum(len(ws))::BIGINT AS n_terms FROM docs),
postings AS (SELECT d, any_value(doc_id) AS doc_id, any_value(n) AS n, term, count(*) AS tf
    FROM (SELECT d, doc_id, len(ws) AS n, unnest(ws) AS term FROM docs) GROUP BY d, term),
weights AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
    FROM postings, totals GROUP BY term, n_docs),
wanted AS (SELECT i, item_id, term, count(*) AS c FROM (SELECT i, item_id, unnest(ws) AS term FROM asked) GROUP BY ALL),
scores AS (SELECT i, item_id, d, any_value(doc_id) AS doc_id,
    sum(c * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * n_docs) // n_terms))))::BIGINT AS score
    FROM wanted JOIN postings USING (term) JOIN weights USING (term), totals GROUP BY i, item_id, d),
ranked AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= {TOP}
"""

QUERIES = {"op12_ranked_search": q_op12_ranked_search}
ORACLE_SQL = {"op12_ranked_search": SQL}
