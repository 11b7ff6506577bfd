import math
import random
import re
from collections import Counter
from glob import glob

import pyarrow.parquet as pq
import pytest
from odd import ROWS, check_odd, documents

from tidemark.llm import search
from tidemark.llm.common import written
from tidemark.session import scratch_root

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, k=20):
    """Every document against every item, in whole numbers."""
    held = [(key, Counter(terms(t))) for key, t in docs]
    held = [(key, c, sum(c.values())) for key, c in held if c]
    n_docs, n_terms = len(held), sum(n for *_, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        scores = []
        for key, c, n in held:
            m = 75 + 25 * n * n_docs // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m))
                for t in terms(text) if t in c
            )
            if score > 0:
                scores.append((-score, key is None, key or 0, key))
        out += [(item, rank + 1, s[3], -s[0]) for rank, s in enumerate(sorted(scores)[:k])]
    return sorted(out, key=repr)


def found(spark, docs, items, **kw):
    docs = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    items = spark.createDataFrame(items, "item_id long, text string")
    return sorted((tuple(r) for r in search.search(written(search.build(docs), "index"), items, **kw).collect()), key=repr)


def corpus(seed, n=400):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(120)] + ["Ünder", "naïve", "中文", "🙂x", "A1b2"]
    weights = [1 / (i + 1) for i in range(len(vocab))]
    text = lambda most: rng.choice([" ", ", ", "-", "\n"]).join(rng.choices(vocab, weights, k=rng.randrange(most)))
    docs = [(rng.randrange(10**9), text(rng.choice([3, 30, 300]))) for _ in range(n)]
    docs += [(k + 1, t) for k, t in docs[:40]] + [(10**9 + i, docs[7][1] + " w3 w100") for i in range(60)]  # copies
    items = [(i, text(25)) for i in range(30)]
    return docs, items


@pytest.mark.parametrize("leaf, segment", [(1, 1 << 23), (1, 3000), (7, 20_000), (128, 1 << 23)])
def test_search_matches_brute_force(spark, monkeypatch, leaf, segment):
    monkeypatch.setattr(search, "LEAF", leaf)
    monkeypatch.setattr(search, "SEGMENT", segment)
    docs, items = corpus(leaf + segment)
    assert found(spark, docs, items) == brute(docs, items)


def test_ties_blocks_and_repeated_items(spark, monkeypatch):
    monkeypatch.setattr(search, "BLOCK_ITEMS", 2)
    monkeypatch.setattr(search, "LEAF", 2)
    docs = [(i, "same words here") for i in range(50, 0, -1)] + [(100 + i, "other text") for i in range(60)]
    items = [(1, "here"), (1, "here"), (2, "HERE words"), (3, "nowhere"), (4, None), (5, "...")]
    got = found(spark, docs, items, k=5)
    assert got == brute(docs, items, 5)
    assert [r[2] for r in got if r[0] == 2] == [1, 2, 3, 4, 5] and sum(r[0] == 1 for r in got) == 10


def test_block_by_terms(spark, monkeypatch):
    monkeypatch.setattr(search, "BLOCK_TERMS", 10)
    docs, items = corpus(99, 60)
    assert found(spark, docs, items) == brute(docs, items)


def test_tasks_hold_a_segment_at_a_time(spark, monkeypatch, tmp_dir):
    monkeypatch.setattr(search, "SEGMENT", 3000)
    docs, items = corpus(5)
    spark.createDataFrame(docs, "doc_id long, text string").coalesce(2).write.parquet(f"{tmp_dir}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_dir}/benchmark.parquet")
    stored = f"{scratch_root(spark)}/segments-*"
    there = set(glob(stored))
    got = search.q_op12_ranked_search(spark, tmp_dir).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(docs, items)
    (path,) = set(glob(stored)) - there
    footers = [pq.read_metadata(f) for f in glob(f"{path}/part-*")]
    assert {m.row_group(i).num_rows for m in footers for i in range(m.num_row_groups)} == {1}
    assert max(m.num_rows for m in footers) > 5

    def rows(batch):
        (only,) = range(batch.num_rows)
        yield [c[only].values for c in batch.columns]

    monkeypatch.setattr(search, "_rows", rows)
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    again = search.search(spark.read.schema(search.INDEX).parquet(path), spark.read.parquet(f"{tmp_dir}/benchmark.parquet"))
    assert sorted(again.collect()) == sorted(got) and spark.conf.get(name) == before != "1"


def test_range_maxima():
    import numpy as np

    rng = np.random.default_rng(4)
    counts = np.array([1, 5, 0, 64, 33, 7])
    places = np.concatenate([np.sort(rng.choice(100, c, replace=False)) for c in counts])
    tfs = rng.integers(1, 4, len(places))
    lists = search.Lists(np.arange(100), rng.integers(1, 50, 100), np.array([3, -1, 1, 0, 5, 2]), counts, places, tfs, 100, 2000)
    for name, at in lists.list_of.items():
        start, end = int(lists.start[at]), int(lists.end[at])
        for low in range(start, end):
            for high in range(low + 1, end + 1):
                (bound,), (doc,) = lists.bounds(np.array([3]), np.array([[low]]), np.array([[high]]))
                best = lists.impact[low:high]
                assert bound == 3 * best.max() and doc == lists.place[low + int(best.argmax())]
    assert lists.list_of.keys() == {3, 1, 0, 5, 2}


def test_odd_rows(spark):
    items = spark.createDataFrame([(1, "The cat"), (None, "words and numbers"), (3, ""), (4, None), (5, "é 中文 end")], "item_id long, text string")
    run = lambda df: search.search(written(search.build(df), "index"), items)
    got = check_odd(run, spark)
    assert got == brute([r[:2] for r in ROWS], [tuple(r) for r in items.collect()])
    from odd import with_extra

    index = written(search.build(documents(spark)), "index")
    clash = with_extra(items).withColumnsRenamed({"x": "rank", "y": "doc_id"})
    assert sorted((tuple(r) for r in search.search(index, clash).collect()), key=repr) == got
    assert search.search(index, items.limit(0)).collect() == []
