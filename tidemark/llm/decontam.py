"""Benchmark decontamination (operator 3).

A document is contaminated by a benchmark item when some stretch of it is
within ``MAX_EDIT`` word edits per word of the item (words stand between white
space; only their letters and digits count, in lower case).

Candidates come from the CGK embedding.  A walk starts at every word; at each
step it writes out the word it stands on and moves on, or stays, by a random bit
of (step, word).  Two texts that differ by few edits give walks that differ in
few places, so the edit distance becomes a Hamming distance, and a sample of
places agrees with some chance: ``WALKS`` walks over windows of each size in
``PLACES`` with that sample of steps for each key (bit-sampling LSH).  No step
leads past a window's end.

*Target.*  Whether a window's key survives depends only on which of its words
are edited.  For each item length, ``PATTERNS`` random sets of as many edits as
are allowed, and evenly spread ones, tell which windows survive; each item takes
keys, those with the least chance hits first (by the shares of their words in
the items), until one survives in ``TARGET`` of the patterns, whatever its
length.  Fewer edits spoil fewer keys.

Every candidate is verified exactly: the least edit distance of the whole item
to any stretch near it, by the bit-parallel recurrence over words.

The item side is small but unbounded in principle, so it is taken in blocks of
``ITEM_BLOCK`` items: the driver holds one block at a time, and each is one pass
over the documents whose result is written before the next.  Documents are never
shuffled and nothing but the items of a block is sent out.

Defined cases: items and documents that are null, empty or without a word
match nothing; an item of one word matches wherever that word stands; items with
equal texts are reported each; repeated documents are reported each; null keys
are carried; an empty table on either side gives an empty result; other
columns are left out; long texts are cut into overlapping stretches, so the
whole text is searched in bounded memory.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh3_64_intdigest

from tidemark.llm.common import ROWS, map_columns, read, slices, small_batches, written
from tidemark.operators.ingest import path_exists
from tidemark.session import scratch_path

#: Word edits allowed per word of an item.
MAX_EDIT = 0.3
#: Sampled steps of the keys, by the words of a window; walks.
PLACES, WALKS = {1: [(0,)], 2: [(0, 1)], 4: [(0, 1, 3), (0, 2, 3)]}, 4
#: Patterns of edits that an item's keys are held against, and the share of them
#: in which one has to survive.
PATTERNS, TARGET = 256, 0.998
#: Items that are sent out at a time.
ITEM_BLOCK = 5_000
#: Words searched at a time (their arrays stay in a core's cache), and words a
#: task remembers.
STRETCH, WORD_MEMORY = 1 << 16, 500_000
WORD = re.compile(r"\S+")
#: Bits of the key filter (at least, and beyond those that count the pieces) and
#: of the table of (item, word) pairs, and words of stretches looked at at a time.
BITMAP, BEYOND, PAIR_BITS, LOOKED_AT = 18, 5, 22, 1 << 20


def _mix(x: np.ndarray, seed: int) -> np.ndarray:
    """64 random-looking bits for each number (a finaliser of public hashes)."""
    with np.errstate(over="ignore"):
        x = x + np.uint64((seed * 0x9E3779B97F4A7C15) % (1 << 64))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def _pair(items: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Places of (item, word) pairs in the table of those that occur."""
    with np.errstate(over="ignore"):
        mixed = (words ^ items.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xBF58476D1CE4E5B9)
    return (mixed >> np.uint64(64 - PAIR_BITS)).astype(np.int64)


class _Words(dict):
    """The place of each word in ``numbers``, which holds a 64-bit number for
    it, the same everywhere; 0 where nothing of a word counts."""

    def __init__(self) -> None:
        self.numbers = np.zeros(1 << 12, np.uint64)

    def __missing__(self, word: str) -> int:
        plain = word.lower() if word.isalnum() else "".join(filter(str.isalnum, word.lower()))
        at = self[word] = len(self)
        if at == len(self.numbers):
            self.numbers = np.concatenate([self.numbers, np.zeros_like(self.numbers)])
        self.numbers[at] = xxh3_64_intdigest(plain.encode()) or 1 if plain else 0
        return at

    def counts(self, word: str) -> bool:
        return bool(self.numbers[self[word]])


def words_of(text: str | None, known: _Words) -> np.ndarray:
    """The numbers of a text's words, without those of which nothing counts."""
    if len(known) >= WORD_MEMORY:
        known.clear()
    places = np.array([*map(known.__getitem__, text.split())] if text else [], np.int64)
    words = known.numbers[places]
    return words[words != 0]


def keys_of(words: np.ndarray, sizes: list[int], share: np.ndarray | None = None):
    """Yields (window size, keys, reach, chance): the key of the window that
    starts at each word, how many words on its walk gets, and the logarithm of
    the chance that the words it reads meet, from the logarithms ``share``.
    ``words`` has 0 where texts end; walks stop there."""
    written = _mix(words, 99)
    for walk in range(WALKS):
        bits = _mix(words, 1000 + walk)
        bits[words == 0] = 0
        start = at = np.arange(len(words))
        wanted = [(c, t, places) for c in sizes for t, places in enumerate(PLACES[c]) if c > 1 or walk == 0]
        sums = {(c, t): np.zeros(len(words), np.uint64) for c, t, _ in wanted}
        seen = {k: (np.full(len(words), -1), np.zeros(len(words))) for k in sums if share is not None}
        for step in range(max((c for c, *_ in wanted), default=0)):
            for c, t, places in wanted:
                if step in places:
                    with np.errstate(over="ignore"):
                        sums[c, t] += written[at] * np.uint64(2 * (7919 * step + 104729 * t + 1299709 * walk + 15485863 * c) + 1)
                    if share is not None:
                        last, chance = seen[c, t]
                        seen[c, t] = at, chance + np.where(at != last, share[at], 0)
                if step == places[-1]:
                    reach, chance = seen.get((c, t), (start, None))
                    yield c, _mix(sums.pop((c, t)), c), reach - start, chance
            at = at + (bits[at] >> np.uint64(step) & np.uint64(1)).astype(np.int64)


def survivals(n: int, edits: int) -> np.ndarray:
    """For patterns of edits in n words (rows) and each word: how many words
    from it on stand as in the item, without anything between them.  An edit
    replaces a word, leaves it out or puts one behind it."""
    rng = np.random.RandomState(n)
    whole, joined = np.ones((PATTERNS, n), bool), np.ones((PATTERNS, n), bool)
    if edits:
        order = rng.rand(PATTERNS, n).argsort(axis=1)[:, :edits]
        even = (np.arange(edits) + rng.rand(PATTERNS // 4, 1)) * n / edits
        order[: len(even)] = even.astype(int)
        behind = rng.rand(PATTERNS, edits) < 1 / 3
        rows = np.arange(PATTERNS)[:, None]
        whole[rows, order] = behind
        joined[rows, order] = False
    run = np.zeros((PATTERNS, n + 1), np.int64)
    for i in range(n - 1, -1, -1):
        run[:, i] = np.where(whole[:, i], 1 + np.where(joined[:, i], run[:, i + 1], 0), 0)
    return run[:, :n]


def choose(run: np.ndarray, first: np.ndarray, reach: np.ndarray, chance: np.ndarray) -> list[int]:
    """Which keys an item takes: the rarest that add to the patterns in which
    one survives, until those are TARGET of all."""
    open_rows = np.ones(len(run), bool)
    out = []
    for x in np.argsort(chance, kind="stable").tolist():
        got = open_rows & (run[:, first[x]] > reach[x])
        if got.any():
            out.append(x)
            open_rows &= ~got
            if open_rows.sum() <= (1 - TARGET) * len(run):
                break
    return out


def edit_search(item: list[int], text: list[int], anchored: bool = False) -> tuple[int, int]:
    """Least edit distance of ``item`` to any stretch of ``text`` and the end
    of the first such stretch; ``anchored``: to any beginning of ``text``."""
    n = len(item)
    masks: dict[int, int] = {}
    for i, w in enumerate(item):
        masks[w] = masks.get(w, 0) | 1 << i
    full, top = (1 << n) - 1, 1 << (n - 1)
    up, down, score = full, 0, n
    best, end = n, 0
    for j, w in enumerate(text):
        eq = masks.get(w, 0)
        x = eq | down
        eq |= ((eq & up) + up) ^ up
        ph = down | ~(eq | up) & full
        mh = up & eq
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph = (ph << 1 | anchored) & full
        mh = mh << 1 & full
        up = mh | ~(x | ph) & full
        down = ph & x
        if score < best:
            best, end = score, j + 1
    return best, end


class Items:
    """The hash table over the chosen keys of a block of items."""

    def __init__(self, rows: list[tuple], max_edit: float = MAX_EDIT) -> None:
        self.max_edit = max_edit
        known = _Words()
        pairs = [(key, words_of(text, known)) for key, text in rows]
        self.items = [(key, w.tolist()) for key, w in pairs if len(w)]
        self.vocabulary = [set(w) for _, w in self.items]
        self.distinct = np.array([len(v) for v in self.vocabulary], np.int64)
        self.allowed = np.array([int(max_edit * len(w)) for _, w in self.items], np.int64)
        #: which (item, word) pairs occur, by a hash: true for all that do
        self.present = np.zeros(1 << PAIR_BITS, bool)
        for i, words in enumerate(self.vocabulary):
            self.present[_pair(np.full(len(words), i), np.array([*words], np.uint64))] = True
        zero = [0]
        flat = np.array([x for _, w in self.items for x in (*w, 0)] + zero, np.uint64)
        ends = np.cumsum([0, *(len(w) + 1 for _, w in self.items)])
        uses, of = np.unique(flat, return_inverse=True)
        share = np.log((np.bincount(of) + 1) / (len(flat) + 1))[of.reshape(-1)]
        longest = max((len(w) for _, w in self.items), default=0)
        self.sizes = [c for c in PLACES if c <= longest]
        # all windows: (size, place, key, reach, chance), those of an item together
        told = [np.stack([np.full(len(flat), c), np.arange(len(flat)), *x]) for c, _, *x in keys_of(flat, self.sizes, share)]
        named = [k for _, k, *_ in keys_of(flat, self.sizes)]
        runs: dict[int, np.ndarray] = {}
        keys, owner, first = [], [], []
        for i, (_, w) in enumerate(self.items):
            n = len(w)
            if n not in runs:
                runs[n] = survivals(n, int(self.allowed[i]))
            at = ends[i]
            mine = [(t, k) for t, k in zip(told, named, strict=True) if t[0, 0] <= n and (t[0, 0] > 1 or n == 1)]
            fit = [slice(at, at + n - int(t[0, 0]) + 1) for t, _ in mine]
            place, reach, chance = np.hstack([t[1:, x] for (t, _), x in zip(mine, fit, strict=True)])
            key = np.concatenate([k[x] for (_, k), x in zip(mine, fit, strict=True)])
            place = place.astype(np.int64) - at
            for x in choose(runs[n], place, reach, chance):
                keys.append(key[x])
                owner.append(i)
                first.append(place[x])
        keys, owner, first = np.array(keys, np.uint64), np.array(owner, np.int64), np.array(first, np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.owner, self.first = keys[order], owner[order], first[order]
        self.shift = np.uint64(64 - max(BITMAP, min(24, len(keys).bit_length() + BEYOND)))
        self.bitmap = np.zeros(1 << 64 - int(self.shift), bool)
        self.bitmap[(keys >> self.shift).astype(np.int64)] = True

    def matches(self, texts: list[str | None], known: _Words) -> list[list[tuple]]:
        """For each text: (item key, distance, first, end, stretches) by item;
        ``first`` and ``end`` are code points of the closest stretch."""
        out: list[list[tuple]] = [[] for _ in texts]
        if not self.items:
            return out
        rows = [words_of(t, known) for t in texts]
        block: list[tuple[int, int, np.ndarray]] = []
        held, hits = 0, []
        for d, w in enumerate(rows):
            for at in range(0, len(w), STRETCH):
                block.append((d, at, w[at : at + STRETCH + max(PLACES)]))
                held += len(block[-1][2])
                if held >= STRETCH:
                    hits.append(self._hits(block))
                    block, held = [], 0
        hits.append(self._hits(block))
        places = self._clusters(np.hstack(hits), np.array([len(w) for w in rows], np.int64))
        until = 0  # where the last stretch found ends
        for d, i, begin, end in self._plausible(rows, *places):
            got = self._verified(i, rows[d][begin:end].tolist(), begin)
            if not got:
                continue
            first, last = got[1:3]
            if out[d] and out[d][-1][0] == i:
                i, *best, n = out[d].pop()
                # the same stretch may be found from two places
                got = (*min((*best,), got[:3], key=lambda x: x[0]), n + (first >= until))
                last = max(last, until)
            out[d].append((i, *got))
            until = last
        for d, hits in enumerate(out):
            if hits:
                spans = [m.span() for m in WORD.finditer(texts[d]) if known.counts(m.group())]
                out[d] = [(self.items[i][0], dist, spans[a][0], spans[b - 1][1], n) for i, dist, a, b, n in hits if b > a]
        return out

    def _hits(self, block: list[tuple[int, int, np.ndarray]]) -> np.ndarray:
        """Rows (text, item, place where the item would begin): one column for
        each place of the block where a window has a key of an item."""
        zero = np.zeros(1, np.uint64)
        flat = np.concatenate([x for _, _, w in block for x in (zero, w)] + [zero])
        begin = np.cumsum([1, *(len(w) + 1 for _, _, w in block)])
        text, at = (np.array([x[k] for x in block], np.int64) for k in (0, 1))
        out = [np.zeros((3, 0), np.int64)]
        for _, keys, *_ in keys_of(flat, self.sizes):
            p = np.flatnonzero(self.bitmap[(keys >> self.shift).astype(np.int64)])
            lo, hi = (np.searchsorted(self.keys, keys[p], side) for side in ("left", "right"))
            n = hi - lo
            p, lo, n = p[n > 0], lo[n > 0], n[n > 0]
            x = np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            p = np.repeat(p, n)
            b = np.searchsorted(begin, p, "right") - 1
            # a start in the overlap belongs to the stretch after
            own = (flat[p] != 0) & (p - begin[b] < STRETCH)
            out.append(np.stack([text[b], self.owner[x], p - begin[b] + at[b] - self.first[x]])[:, own])
        return np.hstack(out)

    def _clusters(self, hits: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, ...]:
        """(text, item, first word, end) of the stretches to look at: around
        places where keys agree, those together that differ by shifts that
        the allowed edits can cause."""
        if not hits.shape[1]:
            return (np.zeros(0, np.int64),) * 4
        d, i, b = hits[:, np.lexsort(hits[::-1])]
        size = np.array([len(w) for _, w in self.items])
        new = np.r_[True, (d[1:] != d[:-1]) | (i[1:] != i[:-1]) | (b[1:] - b[:-1] > self.allowed[i[1:]])]
        first = np.flatnonzero(new)
        last = np.r_[first[1:], len(d)] - 1
        d, i, begin = d[first], i[first], b[first]
        slack = self.allowed[i] + 1
        return d, i, np.maximum(begin - slack, 0), np.minimum(b[last] + size[i] + slack, lengths[d])

    def _plausible(self, rows: list[np.ndarray], d, i, begin, end):
        """Yields the stretches that hold enough words of their item: every
        different word that is missing costs an edit, and counting repeated
        words each time only lets more through."""
        n = np.maximum(end - begin, 0)
        offset = np.cumsum([0, *map(len, rows)])
        flat = np.concatenate([*rows, np.zeros(0, np.uint64)])
        ends = np.cumsum(n)
        at = 0
        while at < len(d):
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + LOOKED_AT, "right")))
            k, m = i[at:to], n[at:to]
            start = np.cumsum(m) - m
            where = np.repeat(offset[d[at:to]] + begin[at:to] - start, m) + np.arange(m.sum())
            there = np.concatenate([[0], np.cumsum(self.present[_pair(np.repeat(k, m), flat[where])])])
            enough = there[start + m] - there[start] >= self.distinct[k] - self.allowed[k]
            for x in np.flatnonzero(enough).tolist():
                yield int(d[at + x]), int(k[x]), int(begin[at + x]), int(end[at + x])
            at = to

    def _verified(self, i: int, text: list[int], offset: int) -> tuple | None:
        """(distance, first word, end, 1) of the closest stretch, if close enough."""
        item, most = self.items[i][1], int(self.allowed[i])
        if len(self.vocabulary[i].difference(text)) > most:
            return None
        dist, end = edit_search(item, text)
        if dist > most:
            return None
        back = edit_search(item[::-1], text[:end][::-1], anchored=True)[1]
        return dist, offset + end - back, offset + end, 1


def _blocks(items: DataFrame, key: str, text: str, size: int):
    """The hash table of each block of items, one after the other."""
    n = items.count()
    blocks = max(1, -(-n // size))
    of = F.pmod(F.xxhash64(key, text), F.lit(blocks))
    for b in range(blocks):
        rows = items.where(of == b).select(key, text).collect()
        yield b + 1 == blocks, Items(sorted(map(tuple, rows), key=repr))


def find(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
         item_text: str = "text", block: int = ITEM_BLOCK) -> DataFrame:
    """(key, item_id, distance, start, end, stretches): one row for each
    document and item that contaminates it."""
    spark = docs.sparkSession
    rows = docs.select(F.col(key), F.col(text))
    ints = [T.StructField(c, T.IntegerType()) for c in ("distance", "start", "end", "stretches")]
    schema = T.StructType([rows.schema[0], T.StructField("item_id", items.schema[item_key].dataType), *ints])
    path = scratch_path(spark, "matches")
    for last, tables in _blocks(items, item_key, item_text, block):
        shared = spark.sparkContext.broadcast(tables)

        def make(shared=shared):
            known = _Words()

            def step(columns):
                if columns is not None:
                    for part in slices(columns[1]):
                        found = shared.value.matches(columns[1][part], known)
                        told = [(k, *m) for k, ms in zip(columns[0][part], found, strict=True) for m in ms]
                        yield [[t[c] for t in told] for c in range(6)]

            return step

        got = map_columns(rows, schema, make)
        if last and not path_exists(spark, path):
            return got  # one block: nothing to put together
        got.write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path)


def decontaminate(docs: DataFrame, items: DataFrame, text: str = "text", item_key: str = "item_id",
                  item_text: str = "text", block: int = ITEM_BLOCK) -> DataFrame:
    """The rows of ``docs`` that no item contaminates, all columns as they are."""
    at = docs.columns.index(text)
    small_batches(docs.sparkSession)
    for last, tables in _blocks(items, item_key, item_text, block):
        shared = docs.sparkSession.sparkContext.broadcast(tables)

        def run(batches, shared=shared):
            known = _Words()
            for batch in batches:
                clean = []
                for first in range(0, batch.num_rows, ROWS):
                    texts = batch.column(at).slice(first, ROWS).to_pylist()
                    clean += [not m for part in slices(texts) for m in shared.value.matches(texts[part], known)]
                yield batch.filter(pa.array(clean, pa.bool_()))
            pa.default_memory_pool().release_unused()

        docs = docs.mapInArrow(run, docs.schema)
        if not last:
            docs = written(docs, "clean")
    return docs


def q_op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text of ``documents`` against every item of ``benchmark``."""
    return find(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


QUERIES = {"op3_decontamination": q_op3_decontamination}
