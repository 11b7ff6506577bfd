import random

import numpy as np
import pytest
from conftest import SF_MID
from odd import ROWS, check_odd, documents

from tidemark.llm import decontam as D


def table(item, text, anchored):
    prev = [j if anchored else 0 for j in range(len(text) + 1)]
    for i, w in enumerate(item, 1):
        row = [i]
        for j, x in enumerate(text, 1):
            row.append(min(prev[j] + 1, row[-1] + 1, prev[j - 1] + (w != x)))
        prev = row
    return min(prev), prev.index(min(prev))


def test_edit_search_matches_the_table():
    rng = random.Random(1)
    for _ in range(1500):
        item = [rng.randrange(4) for _ in range(rng.randint(1, 9))]
        text = [rng.randrange(4) for _ in range(rng.randrange(15))]
        for anchored in (False, True):
            assert D.edit_search(item, text, anchored) == table(item, text, anchored)


def test_keys_are_those_of_walks_step_by_step():
    """Every key from its definition, one walk at a time; no step leads past
    the window."""
    rng = np.random.RandomState(3)
    words = D._mix(rng.randint(1, 30, 400).astype(np.uint64), 5)
    words[[0, 57, 200, 399]] = 0
    written = D._mix(words, 99)
    expected = [(c, t, places, walk) for walk in range(D.WALKS) for c in D.PLACES for t, places in enumerate(D.PLACES[c]) if c > 1 or not walk]
    share = -np.arange(400.0)
    got = {}
    for c, keys, reach, chance in D.keys_of(words, [*D.PLACES], share):
        got.setdefault(c, []).append((keys, reach, chance))
    for c in D.PLACES:
        mine = [x for x in expected if x[0] == c]
        assert len(mine) == len(got[c])
        for start in range(0, 400, 7):
            all_keys = []
            for _, t, places, walk in mine:
                at, key, read = start, 0, []
                for step in range(places[-1] + 1):
                    if step in places:
                        key = (key + int(written[at]) * (2 * (7919 * step + 104729 * t + 1299709 * walk + 15485863 * c) + 1)) % (1 << 64)
                        read.append(at)
                    if step < places[-1] and words[at]:
                        at += int(D._mix(words[at : at + 1], 1000 + walk)[0]) >> step & 1
                assert at - start < c
                all_keys.append((int(D._mix(np.array([key], np.uint64), c)[0]), at - start, float(sum(share[x] for x in {*read}))))
            assert sorted(all_keys) == sorted((int(k[start]), int(r[start]), float(x[start])) for k, r, x in got[c])


def test_survivals_of_edits():
    """Runs of whole words against edits made on a list, one at a time."""
    for n, edits in ((1, 0), (4, 1), (12, 3), (40, 12)):
        run = D.survivals(n, edits)
        assert run.shape == (D.PATTERNS, n) and (run <= n - np.arange(n)).all()
        # an edit ends a run, and no more runs end than there are edits
        ends = [{i + r[i] for i in range(n) if r[i]} - {n} for r in run]
        assert all(len(e) <= edits for e in ends) and (edits > 0) == any(ends)


@pytest.fixture(scope="module")
def items(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SF_MID}/benchmark.parquet").select("item_id", "text").collect()]


@pytest.mark.parametrize(("rate", "least"), [(0.0, 1.0), (0.1, 0.98), (0.2, 0.95)])
def test_recall_of_edited_passages(items, rate, least):
    rng = random.Random(7)
    vocabulary = sorted({w for _, t in items for w in t.split()})
    texts, want = [], []
    for _ in range(5):
        for key, text in items:
            w = text.split()
            for p in sorted(rng.sample(range(len(w)), int(rate * len(w))), reverse=True):
                w[p : p + 1] = rng.choice([[], [rng.choice(vocabulary)], [w[p], rng.choice(vocabulary)]])
            host = rng.choices(vocabulary, k=80)
            texts.append(" ".join(host[:30] + w + host[30:]))
            want.append(key)
    got = D.Items(items).matches(texts, D._Words())
    assert np.mean([k in {m[0] for m in g} for k, g in zip(want, got, strict=True)]) >= least


def edited(rng, words, vocabulary, edits):
    w = [*words]
    for p in sorted(rng.sample(range(len(w)), edits), reverse=True):
        w[p : p + 1] = rng.choice([[], [rng.choice(vocabulary)], [w[p], rng.choice(vocabulary)]])
    return w


@pytest.mark.parametrize("length", [2, 4, 8, 31, 32, 33, 100, 128, 512])
def test_no_length_is_missed(length):
    """Copies within the allowed edits are found through the walks' keys,
    common words in them or not: 0.98 of them at least, at any length and rate."""
    rng = random.Random(length)
    often, seldom = [f"often{i}" for i in range(40)], [f"seldom{i}" for i in range(30_000)]
    draw = lambda n: [rng.choice(seldom if rng.random() < 0.7 else often) for _ in range(n)]
    items = [(i, draw(length)) for i in range(40 if length > 100 else 150)]
    tables, known = D.Items([(i, " ".join(w)) for i, w in items]), D._Words()
    for rate in (0.1, 0.2, 0.3):
        copies = [edited(rng, w, often, int(rate * length)) for _, w in items]
        got = tables.matches([" ".join(draw(40) + w + draw(40)) for w in copies], known)
        assert np.mean([i in {m[0] for m in got[i]} for i, _ in items]) >= 0.98
        assert all(m[1] <= int(rate * length) and m[4] == 1 for (i, _), g in zip(items, got, strict=True) for m in g if m[0] == i)


def test_matches_equal_those_of_every_stretch():
    """Short random texts over few words: exactly the items close to a stretch."""
    rng = random.Random(5)
    items = [(i, [rng.choice("abcdefg") for _ in range(rng.randint(1, 14))]) for i in range(60)]
    texts = [[rng.choice("abcdefgh") for _ in range(rng.randrange(40))] for _ in range(200)]
    got = D.Items([(i, " ".join(w)) for i, w in items]).matches([" ".join(t) for t in texts], D._Words())
    for text, found in zip(texts, got, strict=True):
        want = [(i, d) for i, w in items if (d := table(w, text, False)[0]) <= int(D.MAX_EDIT * len(w))]
        assert sorted(m[:2] for m in found) == want


def test_matches_are_exact_and_spans_cover_the_item(items):
    known, tables = D._Words(), D.Items(items)
    key, text = items[3]
    (m,) = [m for m in tables.matches([f"Before, {text.upper()} -- after"], known)[0] if m[0] == key]
    assert m[1] == 0 and m[2] == 8 and m[3] == 8 + len(text) and m[4] == 1
    # nothing close enough: no match, whatever keys are shared
    words = text.split()
    assert not [m for m in tables.matches([" ".join(words[: len(words) // 2])], known)[0] if m[0] == key]


def test_long_texts_are_searched_whole(items, monkeypatch):
    monkeypatch.setattr(D, "STRETCH", 64)
    key, text = items[5]
    for lead in (0, 30, 63, 64, 65, 100, 1000):
        got = D.Items(items).matches([" ".join(["filler"] * lead) + " " + text + " tail" * 50], D._Words())[0]
        assert [(m[0], m[1], m[4]) for m in got] == [(key, 0, 1)]


def test_clean_documents_stay(spark, items):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    bench = spark.read.parquet(f"{SF_MID}/benchmark.parquet")
    rows = docs.collect()
    plain = lambda t: " " + " ".join("".join(filter(str.isalnum, w)) for w in t.lower().split()) + " "
    wanted = [plain(t) for _, t in items]
    holds = {r.doc_id for r in rows if any(w in plain(r.text or "") for w in wanted)}
    found = D.find(docs, bench).collect()
    assert {r.doc_id for r in found} == holds
    assert {r.doc_id for r in D.decontaminate(docs, bench).collect()} == {r.doc_id for r in rows} - holds
    # in blocks of items: the same
    assert sorted(map(tuple, D.find(docs, bench, block=15).collect())) == sorted(map(tuple, found))


def test_odd_rows(spark):
    items = spark.createDataFrame(
        [(1, "the cat sat on the mat and looked"), (2, None), (3, ""), (4, "--- !!"), (5, "number"), (None, "a row without an id"),
         (6, "the cat sat on the mat and looked")],
        "item_id int, text string",
    )
    got = check_odd(lambda df: D.find(df, items).select("doc_id", "item_id", "distance"), spark)
    cat = [(i, k, 0) for i in (1, 2, 2) for k in (1, 6)]
    assert got == sorted([*cat, (7, 5, 0), (None, None, 0)], key=repr)
    clean = check_odd(lambda df: D.decontaminate(df, items).select("doc_id"), spark)
    assert clean == sorted([(r[0],) for r in ROWS if r[0] in (3, 4, 8, 9) or r[1] is None and r[0] is None], key=repr)
    none = D.find(documents(spark), items.limit(0))
    assert none.columns == ["doc_id", "item_id", "distance", "start", "end", "stretches"] and none.count() == 0
