"""Quality classifier, language identification and language model."""

import math
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
from conftest import SF_MID
from odd import ROWS, check_odd, documents
from pyspark.sql import functions as F

from tidemark.llm import langid, lattice, quality

PIECES = P.path("piece_bpe_32k.model")


def auc(score, label):
    rank = np.argsort(np.argsort(score)) + 1
    one = label == 1
    return (rank[one].sum() - one.sum() * (one.sum() + 1) / 2) / (one.sum() * (~one).sum())


def test_quality_on_held_out_rows(spark):
    got = quality.q_op1_quality(spark, SF_MID)
    labels = spark.read.parquet(f"{SF_MID}/labels.parquet")
    rows = got.join(labels, "doc_id").where("held_out").select("score", "quality", "predicted").toPandas()
    assert auc(rows.score.to_numpy(), rows.quality.to_numpy()) > 0.98
    assert (rows.predicted == rows.quality).mean() > 0.94
    assert got.count() == spark.read.parquet(f"{SF_MID}/documents.parquet").count()


def test_quality_odd_rows(spark):
    labels = spark.createDataFrame(
        [(1, 1), (2, 0), (2, 1), (3, None), (None, 1), (9, 1), (99, 0)], "doc_id long, quality int"
    )
    run = lambda df: quality.score(df, quality.fit(df, labels))
    got = check_odd(run, spark)
    assert len(got) == len(ROWS) and all(0 <= s <= 1 for _, s in got)
    assert len({s for i, s in got if i in (3, 4)}) == 1  # null and empty texts alike


def test_quality_without_labels_or_with_one(spark):
    docs = documents(spark)
    none = spark.createDataFrame([], "doc_id long, quality int")
    one = spark.createDataFrame([(1, 1), (9, 1)], "doc_id long, quality int")
    assert {r.score for r in quality.score(docs, quality.fit(docs, none)).collect()} == {0.5}
    assert {r.score for r in quality.score(docs, quality.fit(docs, one)).collect()} == {0.75}


def test_context_sums_match_brute_force(spark):
    texts = ["a b c a", "b a", None, "", "c c c"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    place, sign = quality.index_vectors()
    slots = quality._Slots()
    want, seen = {}, Counter()
    for t in texts:
        w = (t or "").split()
        for i, x in enumerate(w):
            seen[slots[x]] += 1
            for j in range(max(0, i - 2), min(len(w), i + 3)):
                if i != j:
                    v = want.setdefault(slots[x], np.zeros(quality.DIM))
                    for k in range(quality.NONZERO):
                        v[place[slots[w[j]], k]] += sign[slots[w[j]], k]
    for r in quality.context_counts(df).collect():
        assert r[1] == seen[r[0]] and np.array_equal(r[2:], want.get(r[0], np.zeros(quality.DIM)))


def test_temperature_is_calibrated():
    rng = np.random.RandomState(0)
    x = rng.randn(4000, 5)
    y = (rng.rand(4000) < 1 / (1 + np.exp(-2 * x[:, 0]))).astype(float)
    p = quality.Network(x[:2000], y[:2000]).probability(x[2000:])
    for low in (0.0, 0.2, 0.4, 0.6, 0.8):
        inside = (p >= low) & (p < low + 0.2)
        assert abs(p[inside].mean() - y[2000:][inside].mean()) < 0.12


def test_language_on_held_out_rows(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "lang")
    rows = langid.q_op2_language_id(spark, SF_MID).join(docs, "doc_id").where("held_out and lang is not null").toPandas()
    assert (rows.lang_pred == rows.lang).mean() > 0.99


def test_distance_matches_brute_force(spark):
    train = [("en", "the cat and the dog"), ("de", "der hund und die katze"), (None, "xx"), ("fr", None), ("de", "die")]
    profiles = langid.learn(spark.createDataFrame(train, "lang string, text string"), top=20)
    model = langid.Profiles([tuple(r) for r in profiles.collect()], 20)

    def grams(text):
        c = Counter()
        for w in "".join(ch if ch.isalpha() else " " for ch in text.lower()).split():
            w = f" {w} "
            c.update(w[i : i + n] for n in (1, 2, 3) for i in range(len(w) - n + 1) if w[i : i + n] != " ")
        # a blank between two words is one blank: the bigrams and trigrams of a
        # word don't reach over it
        code = lambda g: sum(ord(x) << 21 * k for k, x in enumerate(g))
        return [g for g, _ in sorted(c.items(), key=lambda x: (-x[1], code(x[0])))][:20]

    known = {lang: grams(" ".join(t for x, t in train if x == lang and t)) for lang in ("en", "de")}
    for text in ("the hund", "katze", "a-dog!", "Der"):
        own = grams(text)
        apart = {
            lang: sum(abs(p.index(g) - i) if g in p else 20 for i, g in enumerate(own)) for lang, p in sorted(known.items())
        }
        best = min(apart, key=apart.get)
        assert model.predict(text) == (best, pytest.approx(1 - apart[best] / (20 * len(own))))


def test_language_odd_rows(spark):
    run = lambda df: langid.predict(df, langid.learn(df))
    got = check_odd(run, spark)
    assert {r[1:] for r in got if r[0] in (3, 4, 8)} == {("und", 0.0)}
    nothing = langid.learn(documents(spark).where("lang = 'none'"))
    assert {r.lang_pred for r in langid.predict(documents(spark), nothing).collect()} == {"und"}


def test_lattice_matches_brute_force():
    pieces, p = lattice.vocabulary(PIECES)
    model = lattice.Pieces(pieces, np.log(p))

    def brute(w):
        total = [1.0] + [0.0] * len(w)
        for j in range(1, len(w) + 1):
            for i in range(j):
                if w[i:j] in model.plain:
                    total[j] += total[i] * p[model.plain[w[i:j]]]
                elif j == i + 1:
                    total[j] += total[i] * np.prod(p[model.spelled(w[i])])
        return math.log(total[-1])

    words = [f"▁{a}{b}" for a in ("the", "ing", "zz🙂", "中", "éèç") for b in ("", "x", "tion.", "𠮷", "a")]
    fast, slow = np.zeros(len(pieces)), np.zeros(len(pieces))
    n = np.arange(1.0, len(words) + 1)
    assert np.allclose(model.solve(words), [brute(w) for w in words])
    model.solve(words, n, fast)
    for w, k in zip(words, n, strict=True):
        model.solve_one(w, k, slow)
    assert np.allclose(fast, slow) and fast.sum() >= n.sum()


def test_lattice_model_against_brute_force(spark):
    rows = [(i, t) for i, t in enumerate(["The cat the DOG", "the cat", None, "", "unseen words here", "É the É", "the cat", "x" * 500])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    learns = ~lattice.held_out(F.col("doc_id"))
    words = lattice.count_words(df, learns)
    ends = df.where(learns).count()
    model = lattice.fit(words, ends, PIECES)
    for heavy in (0, 2, lattice.HEAVY):
        old, lattice.HEAVY = lattice.HEAVY, heavy
        try:
            got = {r.doc_id: r for r in lattice.score(df, lattice.solved(words, model), model).collect()}
        finally:
            lattice.HEAVY = old
        count = Counter()
        for i, t in rows:
            if zlib.crc32(str(i).encode()) % 5 != 1:
                count.update((t or "").encode().lower().split() + [None])
        total, distinct = sum(count.values()), len(count)
        pieces = lattice.Pieces(model.pieces, model.logp)
        for i, t in rows:
            tokens = (t or "").encode().lower().split() + [None]
            base = sum(math.log10((count[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in tokens)
            spelled = [model.logp[0] if w is None else pieces.solve_one("▁" + w.decode()) for w in tokens]
            score = sum(spelled) / math.log(10)
            r = got[i]
            assert (r.n_tokens, r.n_known) == (len(tokens), sum(count[w] > 0 for w in tokens))
            assert r.base_score == pytest.approx(base) and r.score == pytest.approx(score)


def test_score_is_the_lattice_alone(spark):
    """Words seen in training or not: exp(score) is the sum over all spellings,
    held against every segmentation listed one by one."""
    df = spark.createDataFrame([(i, t) for i, t in enumerate(["a cat sat", "a cat", "cats zq", "a"])], "doc_id long, text string")
    words = lattice.count_words(df, F.lit(True))
    model = lattice.fit(words, 4, PIECES)
    at, p = {x: i for i, x in enumerate(model.pieces)}, np.exp(model.logp)
    pieces = lattice.Pieces(model.pieces, model.logp)

    def every(w):
        if not w:
            yield 1.0
        for n in range(1, len(w) + 1):
            if w[:n] in pieces.plain:
                chance = p[at[w[:n]]]
            elif n == 1:
                chance = np.prod(p[pieces.spelled(w[0])])
            else:
                continue
            yield from (chance * x for x in every(w[n:]))

    got = {r.doc_id: r.score for r in lattice.score(df, lattice.solved(words, model), model).collect()}
    for r in df.collect():
        want = math.log10(p[0]) + sum(math.log10(sum(every("▁" + w))) for w in r.text.split())
        assert got[r.doc_id] == pytest.approx(want)


def test_lattice_odd_rows(spark):
    def run(df):
        words = lattice.count_words(df, F.col("doc_id").isNotNull())
        model = lattice.fit(words, df.where("doc_id is not null").count(), PIECES)
        return lattice.score(df, lattice.solved(words, model), model).select("doc_id", "n_tokens", F.round("score", 6))

    got = check_odd(run, spark)
    assert len(got) == len(ROWS) and [r[1] for r in got if r[0] in (3, 4, 8)] == [1, 1, 1]
