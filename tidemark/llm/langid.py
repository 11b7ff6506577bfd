"""Language identification by rank-order profiles (operator 2).

A profile is the list of the ``TOP`` most frequent character n-grams (one to
three characters of a word, with a blank at each end of the word), most
frequent first, ties by code.  Language profiles are learned from all training
texts of each language; a document gets the language whose profile has the
smallest out-of-place distance to its own: the sum, over the document's
n-grams, of how many places their ranks differ, ``TOP`` for an n-gram that the
language profile lacks.

Counting runs in tasks (NumPy over code points, a sort for each batch and
language); Spark adds the counts up by (language, n-gram) with partial sums,
and ranks in two steps, so a language with a third of all rows is no hot spot.
Only the profiles, ``TOP`` rows a language, reach the driver.

Defined cases: text that is null, empty or without a letter is ``und`` with
score 0, as is everything when there is nothing to learn from; rows without
language teach nothing but are predicted; equal distances go to the first
language by name; a null key counts as the empty text for its fold; repeated
rows count as often as they occur; other columns are left out; whole texts
are read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import fold, map_columns, read, slices

#: Length of a profile.
TOP = 300
#: Distinct n-grams that a task holds before it passes its counts on.
HELD = 500_000
#: Groups in which n-grams are ranked before the last ranking.
SALTS = 64

_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Which code points are letters; built once in each Python worker."""
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _LETTERS[0]


def gram_codes(text: str) -> np.ndarray:
    """Codes of all n-grams of a text: 21 bits a character, first one lowest."""
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    points = np.where(_letters()[points], points, 32).astype(np.int64)
    keep = np.ones(len(points), bool)
    keep[1:] = (points[1:] != 32) | (points[:-1] != 32)
    c = points[keep]
    two = c[:-1] | c[1:] << 21
    inside = c[1:-1] != 32
    return np.concatenate([c[c != 32], two[1:] if len(c) == 1 else two, (two[:-1] | c[2:] << 42)[inside]])


def _counted(codes: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    order = None if weights is None else np.argsort(codes, kind="stable")
    codes = np.sort(codes) if order is None else codes[order]
    first = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]]) if len(codes) else np.zeros(0, int)
    if weights is None:
        return codes[first], np.diff(np.r_[first, len(codes)])
    return codes[first], np.add.reduceat(weights[order], first) if len(first) else weights


def ranked(text: str, top: int = TOP) -> np.ndarray:
    """A text's own profile: codes, most frequent first, ties by code."""
    codes, n = _counted(gram_codes(text))
    return codes[np.argsort(-n, kind="stable")[:top]]


def learn(docs: DataFrame, lang: str = "lang", text: str = "text", top: int = TOP) -> DataFrame:
    """(lang, rank, gram): the profile of each language, ranks from 0."""
    schema = T.StructType(
        [
            T.StructField("lang", T.StringType(), False),
            T.StructField("gram", T.LongType(), False),
            T.StructField("n", T.LongType(), False),
        ]
    )

    def make():
        held: dict[str, list] = {}

        def passed_on(name):
            codes, n = (np.concatenate(x) for x in zip(*held.pop(name), strict=True))
            codes, n = _counted(codes, n)
            return [[name] * len(codes), codes.tolist(), n.tolist()]

        def step(columns):
            if columns is None:
                for name in list(held):
                    yield passed_on(name)
                return
            for part in slices(columns[1]):
                by: dict[str, list[str]] = {}
                for name, s in zip(columns[0][part], columns[1][part], strict=True):
                    by.setdefault(name, []).append(s)
                for name, texts in by.items():
                    codes = np.concatenate([gram_codes(s) for s in texts])
                    held.setdefault(name, []).append(_counted(codes))
                    if sum(len(c) for c, _ in held[name]) > HELD:
                        yield passed_on(name)

        return step

    rows = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text")).where(
        F.col("lang").isNotNull() & F.col("text").isNotNull()
    )
    counts = map_columns(rows, schema, make).groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    best = [F.desc("n"), F.asc("gram")]
    salted = W.partitionBy("lang", F.pmod(F.xxhash64("gram"), F.lit(SALTS))).orderBy(*best)
    few = counts.withColumn("r", F.row_number().over(salted)).where(F.col("r") <= top)
    rank = F.row_number().over(W.partitionBy("lang").orderBy(*best)) - 1
    return few.select("lang", rank.alias("rank"), "gram").where(F.col("rank") < top)


class Profiles:
    """The learned profiles, as arrays for the distance."""

    def __init__(self, rows: list[tuple[str, int, int]], top: int = TOP) -> None:
        self.top = top
        self.langs = sorted({r[0] for r in rows})
        self.grams = np.array(sorted({r[2] for r in rows}), np.int64)
        self.rank = np.full((len(self.langs), len(self.grams) + 1), -1, np.int32)
        for lang, rank, gram in rows:
            self.rank[self.langs.index(lang), np.searchsorted(self.grams, gram)] = rank

    def predict(self, text: str | None) -> tuple[str, float]:
        own = ranked(text, self.top) if text and self.langs else ()
        if not len(own):
            return "und", 0.0
        at = np.searchsorted(self.grams, own)
        at[(at == len(self.grams)) | (self.grams[np.minimum(at, len(self.grams) - 1)] != own)] = len(self.grams)
        rank = self.rank[:, at]
        apart = np.where(rank < 0, self.top, np.abs(rank - np.arange(len(own), dtype=np.int32))).sum(axis=1)
        best = int(np.argmin(apart))
        return self.langs[best], float(1 - apart[best] / (self.top * len(own)))


def predict(docs: DataFrame, profiles: DataFrame, key: str = "doc_id", text: str = "text", top: int = TOP) -> DataFrame:
    """(key, lang_pred, score); the score is 1 minus the distance over the
    largest possible distance."""
    learned = Profiles([tuple(r) for r in profiles.select("lang", "rank", "gram").collect()], top)
    schema = T.StructType(
        [
            docs.select(key).schema[0],
            T.StructField("lang_pred", T.StringType(), False),
            T.StructField("score", T.DoubleType(), False),
        ]
    )

    def make():
        def step(columns):
            if columns is not None:
                told = [learned.predict(s) for s in columns[1]]
                yield [columns[0], [x[0] for x in told], [x[1] for x in told]]

        return step

    return map_columns(docs.select(key, text), schema, make)


def held_out(key: Column) -> Column:
    return fold(key, 3) == 1


def q_op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every whole text of ``documents``."""
    docs = read(spark, sf_dir, "documents")
    profiles = learn(docs.where(~held_out(F.col("doc_id"))))
    return predict(docs, profiles).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


QUERIES = {"op2_language_id": q_op2_language_id}
