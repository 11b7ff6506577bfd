import hashlib

from odd import ROWS, check_odd, plain
from pyspark.sql import functions as F

from tidemark.llm import merkle


def edited_of(rows):
    """Brute force: text with its tail replaced by the successor's beginning."""
    first = {}
    for i, t, *_ in rows:
        if i is not None:
            first[i] = min(first.get(i, t or ""), t or "")
    ids = sorted(first)
    out = []
    for i, t, *_ in rows:
        t = t or ""
        q = len(t) // 4
        nxt = "" if i is None else first[ids[(ids.index(i) + 1) % len(ids)]]
        out.append((i, len(t), t[: len(t) - q] + nxt[:q]))
    return sorted(out, key=repr)


def test_edits_match_brute_force(spark):
    run = lambda df: merkle.edits(df).select("doc_id", "n_chars", "edited")
    assert check_odd(run, spark) == edited_of(ROWS)


def test_edits_over_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(merkle, "RANGE_ROWS", 7)
    monkeypatch.setattr(merkle, "CELLS", 16)
    rows = [(i * i * (1 if i % 3 else -5), f"text {i} " * (i % 9), None, None, None) for i in range(120)]
    rows += [(10**15, "far away", None, None, None), (rows[5][0], "zz", None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert plain(merkle.edits(df).select("doc_id", "n_chars", "edited")) == edited_of(rows)


def test_ranges_hold_equally_many_rows_however_ids_lie(spark):
    """Dense ids, a far one, a crowd at one place, negative and extreme ids."""
    dense = list(range(50_000, 54_000))
    for ids in (dense, [*dense, 10**18], [*dense, -(2**63), 2**63 - 1], [i**3 for i in range(-2000, 2000)], [5]):
        df = spark.createDataFrame([(i,) for i in ids], "_id long").repartition(3)
        got = merkle._ranged(df, 100, 64).groupBy("_range").agg(F.count("*").alias("n"), F.min("_id").alias("lo"), F.max("_id").alias("hi"))
        rows = got.orderBy("_range").collect()
        assert sum(r.n for r in rows) == len(ids) and max(r.n for r in rows) <= 150
        assert all(a.hi < b.lo for a, b in zip(rows, rows[1:]))
    assert merkle._ranged(df.limit(0), 100, 64).columns == ["_id", "_range"]


def test_one_document_follows_itself(spark):
    df = spark.createDataFrame([(5, "abcdefgh")], "doc_id long, text string")
    row = merkle.edits(df).first()
    assert row.edited == "abcdefab" and row.fingerprint == row.next_fingerprint


def test_equal_texts_and_likeness(spark):
    texts = ["One. Two. Three. Four.", "One. Two. Three. Five.", "One. Two. Three. Four.", "", None, "a\n\nb\nc", "a\nb\n\nc"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = df.select("i", merkle.fingerprint(F.col("t")).alias("f"))
    f = {r.i: r.f for r in rows.collect()}
    assert f[0] == f[2] and f[3] == f[4] and len({f[0], f[1], f[3], f[5], f[6]}) == 5
    pairs = rows.alias("a").join(rows.alias("b"), F.col("a.i") < F.col("b.i"))
    like = {(r[0], r[1]): r[2] for r in pairs.select("a.i", "b.i", merkle.likeness(F.col("a.f"), F.col("b.f"))).collect()}
    assert like[0, 2] == 1.0 and like[3, 4] == 1.0 and like[0, 1] == 0.75 and like[0, 3] == 0.0


def test_tree_by_hand(spark):
    md5 = lambda s: hashlib.md5(s.encode()).hexdigest()
    leaf = [[[md5("Hi."), md5(" You there!")], [md5("x" * 64), md5("x" * 6)]], [[]]]
    text = "Hi. You there!\n" + "x" * 70 + "\n\n"
    par = [[md5("p" + "".join(p)) for p in s] for s in leaf]
    sec = [md5("s" + "".join(s)) for s in par]
    told = ";".join(
        sec[i][:16] + "(" + " ".join(par[i][j][:16] + ":" + ",".join(x[:8] for x in leaf[i][j]) for j in range(len(par[i]))) + ")"
        for i in range(2)
    )
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(merkle.fingerprint(F.col("t"))).first()[0] == md5("r" + "".join(sec)) + "|" + told


def test_differing_branches_locate_the_edit(spark):
    a, b = "p0\np1\n\nq0\nq1 here\nq2", "p0\np1\n\nq0\nq1 there\nq2"
    df = spark.createDataFrame([(a, b)], "a string, b string")
    f = lambda c: merkle.fingerprint(F.col(c))
    rows = df.select(merkle.differing(f("a"), f("b")).alias("d"), merkle.differing(f("a"), f("a")).alias("e")).first()
    assert [(x.section, x.paragraph) for x in rows.d] == [(1, 1)] and rows.e == []
