"""Sinks that several jobs use: bucketed, shared between writers, with maxima from
their statistics; documents that drift."""

import json
import threading
import time

import pytest
from pyspark.sql import functions as F

from tidemark.operators import ingest
from tidemark.sources import ledger, snapshots, tables


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_bucketed_sink_is_not_shuffled(spark, tmp_dir):
    rows = spark.range(2000).select(F.sha2(F.col("id").cast("string"), 256).alias("hash_diff"), "id")
    name = tables.bucketed_name()
    for part in (rows.where("id < 500"), rows.where("id between 500 and 999")):
        tables.write_bucketed(part, name, ["hash_diff"], 4, f"{tmp_dir}/sink")
    new = ingest.new_records_bucketed(rows, name)
    assert sorted(r.id for r in new.collect()) == list(range(1000, 2000))
    # one exchange, that of the batch; the sink's buckets are read where they lie
    plan = plan_of(ingest.new_records_bucketed(rows, name))
    assert plan.count("Exchange ") == 1 and "BroadcastExchange" not in plan and "Bucketed: true" in plan
    batch, sink = plan.split("FileScan parquet")[0].split("SortMergeJoin")[1].split("Range (")
    assert "Exchange hashpartitioning(hash_diff" in batch and "Exchange" not in sink
    # keys given twice, and a NULL key, which is always new
    odd = spark.createDataFrame([(None, 1), (None, 2)], "hash_diff string, id long")
    assert ingest.new_records_bucketed(odd, name).count() == 2


def test_greatest_value_from_footers(spark, tmp_dir):
    spark.range(1, 5000).selectExpr("id", "date_add(date'2020-01-01', cast(id % 900 as int)) d", "cast(id as decimal(10,2)) m").repartition(5).write.parquet(f"{tmp_dir}/t")
    told = []
    assert str(tables.max_from_statistics(spark, f"{tmp_dir}/t", "d", told)) == "2022-06-18"
    assert "PushedAggregation: [MAX(d)]" in told[0]
    assert tables.max_from_statistics(spark, f"{tmp_dir}/t", "id") == 4999
    assert float(tables.max_from_statistics(spark, f"{tmp_dir}/t", "m")) == 4999  # read, not in the footers
    assert "parquet" in spark.conf.get("spark.sql.sources.useV1SourceList")
    spark.range(0).write.parquet(f"{tmp_dir}/none")
    assert tables.max_from_statistics(spark, f"{tmp_dir}/none", "id") is None


def keyed(spark, ids):
    return spark.createDataFrame([(i, f"p{i % 3}") for i in ids], "k long, part string")


def test_two_interleaved_appends_give_each_key_once(spark, tmp_dir, monkeypatch):
    """Both have compared with the sink before either appends."""
    path, ready = f"{tmp_dir}/sink", threading.Barrier(2)
    real = ingest.one_writer

    def together(*a, **k):
        ready.wait(60)
        return real(*a, **k)

    monkeypatch.setattr(ingest, "one_writer", together)
    work = [threading.Thread(target=ingest.append_new_shared, args=(spark, keyed(spark, ids), path, ["k"], "part", True)) for ids in (range(60), range(30, 90))]
    [t.start() for t in work]
    [t.join() for t in work]
    assert sorted(r.k for r in spark.read.parquet(path).collect()) == list(range(90))
    assert ledger.notes(spark, f"{path}/_writer") == {}


def test_a_dead_writer_holds_nobody_up_for_long(spark, tmp_dir):
    path = f"{tmp_dir}/sink"
    ledger.put(spark, f"{path}/_writer", "now", f"dead {time.time() - 100}")
    with pytest.raises(TimeoutError):
        with ingest.one_writer(spark, path, wait=0.2, lease=1000):
            pass
    ingest.append_new_shared(spark, keyed(spark, [1, 1, 2]), path, ["k"], lease=50)
    ingest.append_new_shared(spark, keyed(spark, [2, 3]), path, ["k"])
    assert sorted(r.k for r in spark.read.parquet(path).collect()) == [1, 2, 3]


def test_a_writer_that_lost_its_right_appends_nothing(spark, tmp_dir):
    path = f"{tmp_dir}/sink"
    with pytest.raises(RuntimeError, match="lost"):
        with ingest.one_writer(spark, path) as still_mine:
            still_mine()
            ledger.put(spark, f"{path}/_writer", "now", "other 0")
            still_mine()
    assert ledger.notes(spark, f"{path}/_writer") == {"now": "other 0"}


def test_documents_that_drift(spark, tmp_dir):
    docs = [
        {"result": "ok", "time_last_update_unix": 5, "conversion_rates": {"A": 1, "B": "x", "C": 2.5}, "meta": {"source": "q"}},
        {"result": "ok", "quality": 0.5, "conversion_rates": {}},
        {"result": 7, "quality": "n/a"},
    ]
    with open(f"{tmp_dir}/a.json", "w") as f:
        f.writelines(json.dumps(d) + "\n" for d in docs)
    snapshots.read_variants(spark, f"{tmp_dir}/a.json", multiline=False).write.parquet(f"{tmp_dir}/v")
    landed = spark.read.parquet(f"{tmp_dir}/v")
    rows = snapshots.from_variants(landed, {"quality": "double", "meta.source": "string"}).collect()
    told = sorted((r.result, r.time_last_update_unix, r.conversion_rates, r.quality, r.meta_source) for r in rows if r.result == "7")
    assert told == [("7", None, None, None, None)]
    assert {(r.quality, r.meta_source, len(r.conversion_rates)) for r in rows if r.result == "ok"} == {(0.5, None, 0), (None, "q", 3)}
    fields = {(r.field, r.of_type, r.documents) for r in snapshots.fields_of(landed).collect()}
    assert {("quality", "DECIMAL", 1), ("quality", "STRING", 1), ("result", "STRING", 2), ("result", "BIGINT", 1), ("meta", "OBJECT", 1)} <= fields
    # the fixed schema reads the same known fields
    fixed = snapshots.read_snapshots(spark, f"{tmp_dir}/a.json", multiline=False)
    assert sorted(map(repr, fixed.collect())) == sorted(map(repr, snapshots.from_variants(landed).collect()))
