"""Language-model scoring by subword lattices (operator 10).

A text is a sequence of words and one end.  The model writes it as pieces of a
public unigram vocabulary, a word as any sequence of pieces that spells a
blank mark and the word (characters that are no piece are spelled in bytes).
Every segmentation of a word is a path through a lattice; its probability is
the product of its pieces' probabilities, and a word's probability is the sum
over all paths, found by the forward recursion in log space.  The score of a
text is the log10 of its marginal probability.

*Piece probabilities.*  The vocabulary's scores (merge ranks) are read as
Zipf's law, p0 ~ 1 / (2 - score).  They weight all segmentations of the
training words once (forward-backward, weighted by the words' counts); the
expected piece counts plus ``PRIOR`` counts spread like p0 give the
probabilities that texts are scored with.

A word has no other paths than its segmentations, and the end is a piece of its
own.  As a piece that begins with a blank mark begins the next word, the
probabilities of all sequences of words sum to one.

*Base.*  The add-half unigram model over whole words is reported beside it.

*Plan.*  One pass counts words (tasks count, Spark adds up by word).  Lattices
are solved once for each different word, not for each occurrence, in NumPy over
many words of equal length at a time.  The most frequent words, at most
``HEAVY`` by a count threshold, are sent to all tasks with their results; they
are most occurrences and all hot keys.  What is left of each document, its
rarer words, is joined with the word table by a 64-bit key, and the parts of
each document are added up.  Every different word of every document counts;
the word table grows with the corpus.

Defined cases: a null or empty text is one end; a character outside the
vocabulary is spelled in bytes; a null key counts as the empty text for its
fold; repeated rows count and are scored each; with nothing to learn from the
prior scores texts, and every base term is log10(0.5 / 0.5); other columns are
left out; whole texts are read; long words are solved one at a time in the
same recursion.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh3_64_intdigest

from tidemark.llm.common import fold, map_columns, read, written

#: Words that are sent to all tasks at most.
HEAVY = 1 << 18
#: Pieces' worth of the vocabulary's own scores against the counts.
PRIOR = 1000.0
#: Words that a task counts before it passes them on, words solved at a time,
#: and the length from which a word is solved on its own.
HELD, SOLVED, LONG = 200_000, 50_000, 200
END = "</s>"
_P = np.uint64(0x9E3779B97F4A7C15)
_BITS = 18


class Pieces:
    """A vocabulary with log probabilities, as arrays for the recursion."""

    def __init__(self, pieces: list[str], logp: np.ndarray) -> None:
        self.pieces, self.logp = pieces, logp
        self.id = {p: i for i, p in enumerate(pieces)}
        self.end = self.id[END]
        self.byte = np.array([self.id[f"<0x{b:02X}>"] for b in range(256)])
        plain = [(p, i) for p, i in self.id.items() if p != END and i not in set(self.byte.tolist())]
        self.plain = dict(plain)
        self.longest = max((len(p) for p in self.plain), default=1)
        hashes = np.array([_hash(p) for p, _ in plain], np.uint64)
        order = np.argsort(hashes)
        self.hashes, self.of = hashes[order], np.array([i for _, i in plain], np.int64)[order]
        self.bitmap = np.zeros(1 << _BITS, bool)
        self.bitmap[(hashes >> np.uint64(64 - _BITS)).astype(np.int64)] = True

    def spelled(self, char: str) -> np.ndarray:
        return self.byte[np.frombuffer(char.encode("utf-8", "surrogatepass"), np.uint8)]

    def edges(self, word: str):
        """(from, to, piece ids) of every edge of one word's lattice, by from;
        an edge has several ids where a character is spelled in bytes."""
        n = len(word)
        for i in range(n):
            for j in range(i + 1, min(n, i + self.longest) + 1):
                p = self.plain.get(word[i:j])
                if p is not None:
                    yield i, j, (p,)
                elif j == i + 1:
                    yield i, j, tuple(self.spelled(word[i]).tolist())

    def solve_one(self, word: str, count: float = 0.0, expected: np.ndarray | None = None) -> float:
        """Natural log of the word's marginal probability; adds ``count`` times
        the expected uses of each piece to ``expected``."""
        n, logp = len(word), self.logp
        ahead = [-math.inf] * (n + 1)
        ahead[0] = 0.0
        for i, j, ps in self.edges(word):
            ahead[j] = _plus(ahead[j], ahead[i] + sum(logp[p] for p in ps))
        if expected is not None and count:
            after = [-math.inf] * (n + 1)
            after[n] = 0.0
            for at in range(n - 1, -1, -1):
                for i, j, ps in self._from(word, at):
                    after[i] = _plus(after[i], after[j] + sum(logp[p] for p in ps))
            for i, j, ps in self.edges(word):
                w = count * math.exp(ahead[i] + sum(logp[p] for p in ps) + after[j] - ahead[n])
                for p in ps:
                    expected[p] += w
        return ahead[n]

    def _from(self, word: str, at: int):
        for i, j, ps in self.edges(word[at : at + self.longest]):
            if i:
                return
            yield at, at + j, ps

    def solve(self, words: list[str], counts: np.ndarray | None = None, expected: np.ndarray | None = None) -> np.ndarray:
        """Marginal log probabilities of many words; with ``counts``, adds the
        expected piece counts to ``expected``."""
        out = np.zeros(len(words))
        lengths = np.array([len(w) for w in words])
        for n in np.unique(lengths).tolist():
            which = np.flatnonzero(lengths == n)
            if n >= LONG or len(which) < 4:
                for k in which.tolist():
                    out[k] = self.solve_one(words[k], 0.0 if counts is None else counts[k], expected)
                continue
            text = "".join(words[k] for k in which.tolist())
            points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(which), n)
            out[which] = self._solve_equal(points.T.copy(), None if counts is None else counts[which], expected)
        return out

    def _solve_equal(self, points: np.ndarray, counts: np.ndarray | None, expected: np.ndarray | None) -> np.ndarray:
        n, many = points.shape
        ahead = np.full((n + 1, many), -np.inf)
        ahead[0] = 0
        used: list[tuple] = []
        spelled: dict[int, np.ndarray] = {}
        for i in range(n):
            h = np.zeros(many, np.uint64)
            for j in range(i + 1, min(n, i + self.longest) + 1):
                with np.errstate(over="ignore"):
                    h = (h + points[j - 1] + np.uint64(1)) * _P
                    h ^= h >> np.uint64(31)
                maybe = np.flatnonzero(self.bitmap[(h >> np.uint64(64 - _BITS)).astype(np.int64)])
                at = np.searchsorted(self.hashes, h[maybe])
                real = self.hashes[np.minimum(at, len(self.hashes) - 1)] == h[maybe]
                rows, ps = maybe[real], self.of[at[real]]
                if len(rows):
                    step = self.logp[ps]
                    ahead[j, rows] = np.logaddexp(ahead[j, rows], ahead[i, rows] + step)
                    if counts is not None:
                        used.append((i, j, rows, ps, step))
                if j == i + 1 and len(rows) < many:
                    none = np.setdiff1d(np.arange(many), rows, assume_unique=True)
                    for point in np.unique(points[i, none]).tolist():
                        if point not in spelled:
                            spelled[point] = self.spelled(chr(point))
                        rows = none[points[i, none] == point]
                        step = self.logp[spelled[point]].sum()
                        ahead[j, rows] = np.logaddexp(ahead[j, rows], ahead[i, rows] + step)
                        if counts is not None:
                            used.append((i, j, rows, spelled[point], step))
        if counts is not None:
            after = np.full((n + 1, many), -np.inf)
            after[n] = 0
            for i, j, rows, ps, step in sorted(used, key=lambda x: -x[0]):
                after[i, rows] = np.logaddexp(after[i, rows], step + after[j, rows])
            for i, j, rows, ps, step in used:
                w = counts[rows] * np.exp(ahead[i, rows] + step + after[j, rows] - ahead[n, rows])
                if np.ndim(step):
                    expected += np.bincount(ps, w, len(expected))
                else:
                    np.add.at(expected, ps, w.sum())
        return ahead[n]


def _plus(a: float, b: float) -> float:
    a, b = (a, b) if a > b else (b, a)
    return a if b == -math.inf else a + math.log1p(math.exp(b - a))


def _hash(piece: str) -> np.uint64:
    h = np.uint64(0)
    with np.errstate(over="ignore"):
        for c in piece:
            h = (h + np.uint64(ord(c)) + np.uint64(1)) * _P
            h ^= h >> np.uint64(31)
    return h


def vocabulary(path: str) -> tuple[list[str], np.ndarray]:
    """Pieces of a model file and their probabilities by their own scores."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces, weight = [END], [1.0]
    for i in range(model.get_piece_size()):
        piece, score = model.id_to_piece(i), model.get_score(i)
        if model.is_byte(i):
            pieces.append(piece)
            weight.append(1e-5)  # bytes carry no score: less than any piece
        elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            pieces.append(piece)
            weight.append(1 / (2 - score))
    weight = np.array(weight)
    return pieces, weight / weight.sum()


def _words(text: str | None) -> list[bytes]:
    # lowered and split by ASCII rules: A-Z only, at blanks and \x09-\x0D only
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def _key(word: bytes) -> int:
    x = xxh3_64_intdigest(word)
    return x - (1 << 64) if x >> 63 else x


def count_words(docs: DataFrame, learns: Column, text: str = "text") -> DataFrame:
    """(word, n, seen): occurrences in the rows that ``learns`` holds for, and
    in all rows.  Words are bytes."""
    schema = T.StructType(
        [T.StructField("word", T.BinaryType()), T.StructField("n", T.LongType()), T.StructField("seen", T.LongType())]
    )

    def make():
        learned, rest = Counter(), Counter()

        def passed_on():
            words = list(learned.keys() | rest.keys())
            for at in range(0, len(words), 50_000):
                part = words[at : at + 50_000]
                n = [learned.get(w, 0) for w in part]
                yield [part, n, [a + rest.get(w, 0) for a, w in zip(n, part, strict=True)]]
            learned.clear()
            rest.clear()

        def step(columns):
            if columns is None:
                yield from passed_on()
                return
            for s, use in zip(*columns, strict=True):
                (learned if use else rest).update(_words(s))
                if len(learned) + len(rest) > HELD:
                    yield from passed_on()

        return step

    rows = map_columns(docs.select(F.col(text).alias("text"), learns.alias("learns")), schema, make)
    return rows.groupBy("word").agg(F.sum("n").alias("n"), F.sum("seen").alias("seen"))


def expected_pieces(words: DataFrame, pieces: list[str], p: np.ndarray) -> DataFrame:
    """(piece, n): expected uses of each piece over all segmentations of the
    counted words."""
    schema = T.StructType([T.StructField("piece", T.IntegerType()), T.StructField("n", T.DoubleType())])
    shared = words.sparkSession.sparkContext.broadcast((pieces, np.log(p)))

    def make():
        model, total, held, ns = Pieces(*shared.value), np.zeros(len(pieces)), [], []

        def flush():
            model.solve(held, np.array(ns, np.float64), total)
            held.clear()
            ns.clear()

        def step(columns):
            if columns is None:
                flush()
                used = np.flatnonzero(total)
                yield [used.tolist(), total[used].tolist()]
                return
            held.extend(map(_marked, columns[0]))
            ns.extend(columns[1])
            if len(held) >= SOLVED:
                flush()

        return step

    rows = words.where("n > 0").select("word", "n")
    return map_columns(rows, schema, make).groupBy("piece").agg(F.sum("n").alias("n"))


def _marked(word: bytes) -> str:
    return "▁" + word.decode("utf-8", "surrogatepass")


class Model:
    """Piece probabilities and the counts that the base needs."""

    def __init__(self, pieces: list[str], logp: np.ndarray, tokens: int, distinct: int, ends: int) -> None:
        self.pieces, self.logp = pieces, logp
        self.tokens, self.distinct, self.ends = tokens, distinct, ends


def fit(words: DataFrame, ends: int, vocabulary_path: str) -> Model:
    """``words`` as counted; ``ends``: how many texts they were learned from.
    What reaches the driver is a number for each piece."""
    pieces, p0 = vocabulary(vocabulary_path)
    seen = np.zeros(len(pieces))
    for piece, n in expected_pieces(words, pieces, p0).collect():
        seen[piece] += n
    seen[0] += ends
    p = (seen + PRIOR * p0) / (seen.sum() + PRIOR)
    told = words.agg(F.sum("n").alias("n"), F.count(F.when(F.col("n") > 0, 1)).alias("v")).first()
    return Model(pieces, np.log(p), int(told["n"] or 0) + ends, int(told["v"]) + (ends > 0), ends)


def solved(words: DataFrame, model: Model) -> DataFrame:
    """(key, n, seen, lattice): every word by its 64-bit key, with the log10
    of its probability over all paths."""
    schema = T.StructType(
        [T.StructField("key", T.LongType(), False), T.StructField("n", T.LongType(), False),
         T.StructField("seen", T.LongType(), False), T.StructField("lattice", T.DoubleType(), False)]
    )
    shared = words.sparkSession.sparkContext.broadcast(model)

    def make():
        pieces, held = Pieces(shared.value.pieces, shared.value.logp), ([], [], [])

        def step(columns):
            if columns is not None:
                for mine, new in zip(held, columns, strict=True):
                    mine.extend(new)
            if held[0] and (columns is None or len(held[0]) >= SOLVED):
                logp = pieces.solve([_marked(w) for w in held[0]]) / math.log(10)
                yield [[_key(w) for w in held[0]], list(held[1]), list(held[2]), logp.tolist()]
                for mine in held:
                    mine.clear()

        return step

    return map_columns(words.select("word", "n", "seen"), schema, make)


def _threshold(words: DataFrame, most: int) -> int:
    """The least count such that at most ``most`` words occur more often; the
    histogram has a bounded number of cells."""
    # exact below 4096, then 64 cells for each doubling
    count = F.col("seen")
    power = F.floor(F.log2(count.cast("double")))
    width = F.pow(F.lit(2.0), power - 6)
    cell = F.when(count < 4096, count).otherwise((F.floor(count / width) * width).cast("long"))
    rows = words.groupBy(cell.alias("cell")).agg(F.count("*").alias("n"), F.max("seen").alias("top")).collect()
    above = 0
    for r in sorted(rows, key=lambda r: -r["cell"]):
        if above + r["n"] > most:
            return int(r["top"])
        above += r["n"]
    return 0


def score(docs: DataFrame, words: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_tokens, n_known, base_score, score) of every row; ``words`` as
    solved, written once."""
    limit = _threshold(words, HEAVY)
    heavy = words.where(F.col("seen") > limit).select("key", "n", "lattice").collect()
    base_of = lambda n: math.log10((n + 0.5) / 0.5)  # noqa: E731  beyond an unknown word
    shared = docs.sparkSession.sparkContext.broadcast({r[0]: (r[1] > 0, base_of(r[1]), r[2]) for r in heavy})
    key_type = docs.schema[key].dataType
    schema = T.StructType(
        [T.StructField("row", T.LongType(), False), T.StructField("word", T.LongType()),
         T.StructField("times", T.LongType(), False), T.StructField("known", T.LongType()),
         T.StructField("base", T.DoubleType()), T.StructField("lattice", T.DoubleType()),
         T.StructField("id", key_type)]
    )

    def make():
        known, place, at = shared.value, TaskContext.get().partitionId() << 33, 0
        key_memory: dict[bytes, int] = {}

        def step(columns):
            nonlocal at
            if columns is None:
                return
            rows: tuple[list, ...] = ([], [], [], [], [], [], [])
            for doc, s in zip(*columns, strict=True):
                n = 1
                hits = 0
                base = lattice = 0.0
                for w, times in Counter(_words(s)).items():
                    n += times
                    k = key_memory.get(w)
                    if k is None:
                        if len(key_memory) >= HEAVY:
                            key_memory.clear()
                        k = key_memory[w] = _key(w)
                    got = known.get(k)
                    if got is None:
                        for column, x in zip(rows, (place + at, k, times, None, None, None, None), strict=True):
                            column.append(x)
                    else:
                        hits += times * got[0]
                        base += times * got[1]
                        lattice += times * got[2]
                for column, x in zip(rows, (place + at, None, n, hits, base, lattice, doc), strict=True):
                    column.append(x)
                at += 1
            yield list(rows)

        return step

    parts = written(map_columns(docs.select(key, text), schema, make), "parts")
    rare = words.where(F.col("seen") <= limit).select(F.col("key").alias("word"), "n", F.col("lattice").alias("l"))
    found = (
        parts.where("word is not null")
        .select("row", "word", "times")
        .join(rare, "word")
        .groupBy("row")
        .agg(
            F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("known"),
            F.sum(F.col("times") * F.log10((F.col("n") + 0.5) / 0.5)).alias("base"),
            F.sum(F.col("times") * F.col("l")).alias("lattice"),
        )
    )
    whole = parts.where("word is null").select("row", "times", "known", "base", "lattice", "id")
    both = whole.select("row", "times", "known", "base", "lattice", F.struct("id").alias("id")).unionByName(
        found, allowMissingColumns=True
    )
    each = both.groupBy("row").agg(
        F.max("times").alias("n"), F.sum("known").alias("known"), F.sum("base").alias("base"),
        F.sum("lattice").alias("lattice"), F.first("id", ignorenulls=True).alias("id"),
    )
    room = model.tokens + 0.5 * (model.distinct + 1)
    end = math.log10((model.ends + 0.5) / 0.5)
    return each.select(
        F.col("id.id").alias(key),
        F.col("n").alias("n_tokens"),
        (F.col("known") + F.lit(int(model.ends > 0))).cast("long").alias("n_known"),
        (F.col("base") + F.lit(end) + F.col("n") * F.lit(math.log10(0.5 / room))).alias("base_score"),
        (F.col("lattice") + F.lit(float(model.logp[0] / math.log(10)))).alias("score"),
    )


def held_out(key: Column) -> Column:
    return fold(key, 5) == 1


def q_op10_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log10 probability of every whole text of ``documents``."""
    import public_tokenizers

    docs = read(spark, sf_dir, "documents")
    learns = ~held_out(F.col("doc_id"))
    words = written(count_words(docs, learns), "words")
    model = fit(words, docs.where(learns).count(), public_tokenizers.path("piece_bpe_32k.model"))
    scored = score(docs, written(solved(words, model), "solved"), model)
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )


QUERIES = {"op10_lattice_lm": q_op10_lattice_lm}
