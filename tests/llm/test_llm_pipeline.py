"""Registered queries against their SQL, and the pipeline stage by stage."""

import hashlib

import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F
from conftest import SF_MID, SF_SMALL
from odd import ROWS, SCHEMA, with_extra
from test_llm_jaccard import brute, grams

import __spark_entry__ as E
import corpus_pipeline as C
from tidemark.llm import bpe, decontam, quality
from tidemark.llm.common import written
from tidemark.llm.registry import ORACLE_SQL, QUERIES
from tools.oracle_check import TABLES, rows_of


def test_every_operator_is_registered():
    assert {name.split("_")[0] for name in QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert "pipeline" in E.queries() and set(QUERIES) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
@pytest.mark.parametrize("sf", [SF_SMALL])
def test_query_matches_sql(spark, name, sf):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    df = QUERIES[name](spark, sf)
    cursor = con.execute(ORACLE_SQL[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(columns, cursor.fetchall())


def test_pipeline_stage_by_stage(spark):
    """Each stage against a brute-force version on what the one before kept."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns = docs.columns
    model = quality.fit(docs, spark.read.parquet(f"{SF_SMALL}/labels.parquet").where(~quality.held_out(F.col("doc_id"))))
    scores = {r.doc_id: r.score for r in quality.score(docs, model).collect()}
    bench = [decontam.words_of(r.text, decontam._Words()).tolist() for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]

    def no_item(text):
        words = decontam.words_of(text, decontam._Words()).tolist()
        return not any(decontam.edit_search(b, words)[0] <= int(decontam.MAX_EDIT * len(b)) for b in bench if b)

    for name, stage in C.STAGES[:-1]:
        before = [tuple(r) for r in docs.collect()]
        docs = written(stage(spark, docs, SF_SMALL), "test")
        assert docs.columns == columns
        got = sorted(r.doc_id for r in docs.collect())
        if name == "quality":
            assert got == sorted(i for i, s in scores.items() if s >= quality.THRESHOLD)
        elif name == "near_duplicates":
            assert got == sorted({c for _, _, c in brute(before, C.NEAR_WORDS, C.NEAR_PERCENT)})
        elif name == "decontamination":
            assert got == sorted(r[0] for r in before if no_item(r[1]))
        else:
            after = {r.doc_id: r for r in docs.collect()}
            assert got == sorted(r[0] for r in before)
            for r in before:
                assert (after[r[0]].text == r[1]) == ("[secret]" not in after[r[0]].text)
                assert after[r[0]].n_chars == len(after[r[0]].text)
    theirs = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.load_ranks(P.path("byte_bpe_50k.tiktoken")), special_tokens={})
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = C.STAGES[-1][1](spark, docs, SF_SMALL).collect()
    assert {r.doc_id for r in rows} == set(texts)
    for r in rows:
        assert r.ids == theirs.encode_ordinary(texts[r.doc_id]) and r.n_tokens == len(r.ids)
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_quality_stage_keeps_clean_documents(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    kept = C.quality_stage(spark, docs, SF_MID).select("doc_id")
    labels = spark.read.parquet(f"{SF_MID}/labels.parquet")
    clean, junk = labels.where("quality = 1"), labels.where("quality = 0")
    assert clean.join(kept, "doc_id").count() >= 0.98 * clean.count()
    assert junk.join(kept, "doc_id").count() <= 0.05 * junk.count()


def test_stages_take_odd_rows(spark):
    odd = with_extra(spark.createDataFrame(ROWS, SCHEMA))
    for name, stage in C.STAGES[:-1]:
        got = stage(spark, odd, SF_SMALL)
        assert got.columns == odd.columns, name
        assert got.count() <= len(ROWS)
        assert stage(spark, odd.limit(0), SF_SMALL).count() == 0
    assert C.STAGES[-1][1](spark, odd, SF_SMALL).count() == len(ROWS)


def test_near_copies_of_five_words(spark):
    text = [f"w{i}" for i in range(60)]
    near = [*text[:30], "changed", *text[31:]]
    far = [*text[:10], "a", *text[11:20], "b", *text[21:40], "c", *text[41:50], "d", *text[51:]]
    rows = [(1, " ".join(text), None, None, 0), (2, " ".join(near), None, None, 0), (3, " ".join(far), None, None, 0)]
    both = len(grams(rows[0][1], 5) & grams(rows[1][1], 5)) / len(grams(rows[0][1], 5) | grams(rows[1][1], 5))
    assert both >= 0.8
    docs = spark.createDataFrame(rows, SCHEMA)
    assert sorted(r.doc_id for r in C.near_duplicate_stage(spark, docs, SF_SMALL).collect()) == [1, 3]
