"""Silver typing, hashing and the append-new-only sink (FIXTURES §5 edges)."""

import json
import os

import pytest
from pyspark.sql import functions as F

from tidemark.functions.hashing import content_hash
from tidemark.operators import ingest
from tidemark.plans.silver import run_silver, to_silver
from tidemark.sources.snapshots import read_snapshots


def _doc(day, rates, last_text=None):
    return {
        "result": "success", "documentation": "d", "terms_of_use": "t",
        "time_last_update_unix": 1, "time_last_update_utc": last_text or f"Fri, {day} Oct 2025 00:00:01 +0000",
        "time_next_update_unix": 2, "time_next_update_utc": f"Sat, {day} Oct 2025 00:00:01 +0000",
        "base_code": "BRL", "conversion_rates": rates,
    }


def _write(dirname, name, doc, pretty=True):
    os.makedirs(dirname, exist_ok=True)
    with open(os.path.join(dirname, name), "w") as f:
        json.dump(doc, f, indent=4 if pretty else None)


def test_null_rate_dropped_bad_date_kept_new_code(spark, tmp_dir):
    raw = f"{tmp_dir}/raw"
    _write(raw, "a.json", _doc("03", {"BRL": 1, "USD": 0.18, "XXX": None}))
    _write(raw, "b.json", _doc("04", {"BRL": 1, "USD": 0.19, "NEW": 2.5}, last_text="garbage"), pretty=False)
    s = to_silver(read_snapshots(spark, raw))
    rows = {(r["code_exchange_rate"], r["time_last_update_utc"] is None) for r in s.collect()}
    assert ("XXX", False) not in rows and ("NEW", True) in rows
    assert s.count() == 5
    assert s.where(F.col("snapshot_date").isNull()).count() == 3


def test_rate_rounding_half_up(spark, tmp_dir):
    raw = f"{tmp_dir}/raw"
    _write(raw, "a.json", _doc("03", {"KWD": 0.05577, "BHD": 0.06865}))
    got = {r[0]: str(r[1]) for r in to_silver(read_snapshots(spark, raw))
           .select("code_exchange_rate", "exchange_rate").collect()}
    assert got == {"KWD": "0.0558", "BHD": "0.0687"}


def test_same_batch_twice_and_duplicate_file(spark, tmp_dir):
    raw, sink = f"{tmp_dir}/raw", f"{tmp_dir}/silver"
    _write(raw, "a.json", _doc("03", {"BRL": 1, "USD": 0.18}))
    _write(raw, "a_copy.json", _doc("03", {"BRL": 1, "USD": 0.18}))
    run_silver(spark, raw, sink)
    run_silver(spark, raw, sink)
    assert spark.read.parquet(sink).count() == 2


def test_missing_and_empty_sink_mean_all_new(spark, tmp_dir):
    assert ingest.read_sink(spark, f"{tmp_dir}/nope") is None
    os.makedirs(f"{tmp_dir}/empty")
    assert ingest.read_sink(spark, f"{tmp_dir}/empty") is None


def test_unreadable_sink_propagates(spark, tmp_dir):
    bad = f"{tmp_dir}/bad"
    os.makedirs(bad)
    with open(f"{bad}/part-0.parquet", "w") as f:
        f.write("not parquet")
    with pytest.raises(Exception):
        ingest.read_sink(spark, bad).count()


def test_null_key_never_matches(spark):
    new = spark.createDataFrame([(None, 1), ("k", 2)], "h string, v int")
    old = spark.createDataFrame([(None,), ("k",)], "h string")
    got = [r["v"] for r in ingest.new_records(new, old, ["h"]).collect()]
    assert got == [1]


def test_hash_is_unambiguous(spark):
    rows = [("ab", "c"), ("a", "bc"), ("a\u001fb", "c"), (None, "x"), ("", "x"), ("n", "x"), ("1:n", "x"), ("x", None), ("x", "")]
    df = spark.createDataFrame(rows, "x string, y string")
    assert len({r[0] for r in df.select(content_hash(["x", "y"], df)).collect()}) == len(rows)
    assert len({r[0] for r in df.select(content_hash(["x", "y"], df, sep="")).limit(2).collect()}) == 1


def test_hash_is_sha256_of_text(spark):
    import hashlib

    df = spark.createDataFrame([(1, None, "xé")], "a int, b string, c string")
    assert df.select(content_hash(["a", "b", "c"], df)).first()[0] == hashlib.sha256("1:1n2:xé".encode()).hexdigest()
    assert df.select(content_hash(["a", "b", "c"], df, sep="")).first()[0] == hashlib.sha256("1xé".encode()).hexdigest()


def test_codes_whose_digits_run_together_stay_apart(spark, tmp_dir):
    import json

    import sample_docs

    doc = sample_docs.document(sample_docs.DAYS[0], {"1": 1234.0, "11": 234.0})
    with open(f"{tmp_dir}/a.json", "w") as f:
        json.dump(doc, f)
    run_silver(spark, f"{tmp_dir}/a.json", f"{tmp_dir}/silver")
    got = spark.read.parquet(f"{tmp_dir}/silver").select("code_exchange_rate").collect()
    assert sorted(r[0] for r in got) == ["1", "11"]


@pytest.mark.parametrize("cap", [0, 10_000])
def test_key_in_another_partition_is_found(spark, cap):
    old = spark.createDataFrame([("k1", "2025-01-01"), ("k2", "2025-01-02")], "k string, d string")
    batch = spark.createDataFrame([("k1", "2025-01-02"), ("k3", "2025-01-02")], "k string, d string")
    got = ingest.new_records(batch, old, ["k"], "d", max_values=cap)
    assert [r["k"] for r in got.collect()] == ["k3"]


def test_append_beside_a_stream_is_refused(spark, tmp_dir):
    import os

    os.makedirs(f"{tmp_dir}/sink/_spark_metadata")
    with pytest.raises(ValueError, match="_spark_metadata"):
        ingest.append_new(spark, spark.range(3).withColumnRenamed("id", "hash_diff"), f"{tmp_dir}/sink")


def test_overwrite_replaces_all_partitions(spark, tmp_dir):
    from tidemark.sources.tables import write_overwrite, write_partitions

    path = f"{tmp_dir}/t"
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        write_overwrite(spark.createDataFrame([(1, "a"), (2, "b")], "v int, d string"), path, partition_by=["d"])
        write_overwrite(spark.createDataFrame([(3, "a")], "v int, d string"), path, partition_by=["d"])
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert [tuple(r) for r in spark.read.parquet(path).collect()] == [(3, "a")]
    write_partitions(spark.createDataFrame([(4, "b")], "v int, d string"), path, ["d"])
    assert sorted(tuple(r) for r in spark.read.parquet(path).collect()) == [(3, "a"), (4, "b")]


# ------------------------------------------------------------- bad documents
def bad_folder(tmp_dir):
    import json

    import sample_docs

    one = sample_docs.document(sample_docs.DAYS[0], {"AAA": 1.5, "BBB": 2})
    two = sample_docs.document(sample_docs.DAYS[1], {"AAA": 1.75, "BBB": "N/A", "CCC": None, "DDD": "3.5"})
    for name, text in (("a", json.dumps(one)), ("b", json.dumps(two)), ("c", json.dumps(one)[:-40])):
        with open(f"{tmp_dir}/{name}.json", "w") as f:
            f.write(text)
    return tmp_dir


def test_bad_documents_end_the_job(spark, tmp_dir):
    folder = bad_folder(tmp_dir)
    for name in ("b", "c"):
        with pytest.raises(Exception, match="rate is no number|[Mm]alformed"):
            run_silver(spark, f"{folder}/{name}.json", f"{folder}/silver-{name}")
    run_silver(spark, f"{folder}/a.json", f"{folder}/silver")
    assert spark.read.parquet(f"{folder}/silver").count() == 2


def check_quarantine(spark, folder):
    good = spark.read.parquet(f"{folder}/silver").select("code_exchange_rate", "exchange_rate").collect()
    assert sorted((r[0], float(r[1])) for r in good) == [("AAA", 1.5), ("AAA", 1.75), ("BBB", 2.0), ("DDD", 3.5)]
    bad = spark.read.parquet(f"{folder}/bad").collect()
    assert sorted((r["reason"], r["code"] or "") for r in bad) == [("document", ""), ("rate", "BBB")]
    assert [r["text"] for r in bad if r["reason"] == "rate"] == ["N/A"]


def test_bad_documents_in_quarantine(spark, tmp_dir):
    folder = bad_folder(tmp_dir)
    run_silver(spark, f"{folder}/*.json", f"{folder}/silver", quarantine_path=f"{folder}/bad")
    check_quarantine(spark, folder)


def test_bad_documents_in_a_stream(spark, tmp_dir):
    import glob

    from tidemark.streaming.ingest import stream_silver

    folder = bad_folder(tmp_dir)
    with pytest.raises(Exception, match="rate is no number|[Mm]alformed"):
        stream_silver(spark, f"{folder}/*.json", f"{folder}/silver", f"{folder}/ck1", archive_dir=f"{folder}/archive")
    assert len(glob.glob(f"{folder}/*.json")) == 3  # nothing was archived
    stream_silver(spark, f"{folder}/*.json", f"{folder}/silver", f"{folder}/ck2", quarantine_path=f"{folder}/bad")
    check_quarantine(spark, folder)


def test_json_members_are_checked_one_by_one(spark):
    from tidemark.operators.reshape import json_map_checked, json_map_rows

    docs = ['{"a":1,"b":"x"}', '{"a":2,"b":null}', '{"a":3', "[1]", "", "{}", None, "text", '{"n":"4"}']
    df = spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "id int, j string")
    got = {(r["id"], r["key"], r["value"], r["rejected"]) for r in json_map_checked(df, "j").collect()}
    assert got == {(0, "a", 1.0, False), (0, "b", None, True), (1, "a", 2.0, False), (1, "b", None, False),
                   (2, None, None, True), (3, None, None, True), (4, None, None, True), (7, None, None, True),
                   (8, "n", 4.0, False)}
    assert {(r[0], r[1], r[2]) for r in json_map_rows(df, "j").collect()} == {
        (0, "a", 1.0), (1, "a", 2.0), (1, "b", None), (8, "n", 4.0)}


def test_a_rate_without_code_ends_the_landing(spark):
    from tidemark.plans.series_sources import snapshot_payloads

    df = spark.createDataFrame([(None, "2025-01-01", 1.0)], "entity string, t string, value double") \
        .select("entity", F.to_date("t").alias("ts"), "value")
    with pytest.raises(Exception, match="entity is NULL"):
        snapshot_payloads(df).collect()


def test_scratch_is_dropped(spark):
    import os

    from tidemark.session import drop_scratch, scratch_path

    path = scratch_path(spark, "x")
    spark.range(3).write.parquet(path)
    local = path.removeprefix("file://").removeprefix("file:")
    assert os.path.isdir(local)
    drop_scratch(spark)
    assert not os.path.isdir(os.path.dirname(local))


def test_anti_join_prunes_sink_partitions(spark, tmp_dir):
    sink = f"{tmp_dir}/sink"
    old = spark.createDataFrame([("h1", "2025-01-01"), ("h2", "2025-01-02")], "h string, d string") \
        .withColumn("d", F.to_date("d"))
    old.write.partitionBy("d").parquet(sink)
    batch = spark.createDataFrame([("h2", "2025-01-02"), ("h3", "2025-01-02")], "h string, d string") \
        .withColumn("d", F.to_date("d"))
    out = ingest.new_records(batch, spark.read.parquet(sink), ["h"], "d", key_fixes_partition=True)
    assert [r["h"] for r in out.collect()] == ["h3"]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(d" in plan or "PartitionFilters: [d" in plan or "d IN" in plan


def test_raw_landing_replaces_only_rerun_day(spark, tmp_dir):
    from tidemark.sources.snapshots import land_snapshots

    path = f"{tmp_dir}/raw"
    docs = spark.createDataFrame([("a", "2025-01-01"), ("b", "2025-01-02")], "result string, ingest_date string")
    land_snapshots(docs, path)
    land_snapshots(spark.createDataFrame([("c", "2025-01-02")], "result string, ingest_date string"), path)
    got = sorted((r[0], str(r[1])) for r in spark.read.json(path).collect())
    assert got == [("a", "2025-01-01"), ("c", "2025-01-02")]


def test_has_rows_and_load_time(spark):
    from tidemark.operators.reshape import with_load_time

    df = spark.range(3)
    assert ingest.has_rows(df) and not ingest.has_rows(df.where("id < 0"))
    stamped = with_load_time(df)
    assert dict(stamped.dtypes)["load_date_src"] == "timestamp_ntz"
    assert stamped.select("load_date_src").distinct().count() == 1


def test_materialize_cuts_lineage(spark):
    from tidemark.session import materialize

    df = spark.range(10).withColumn("x", F.col("id") * 2)
    m = materialize(df)
    assert m.count() == 10
    assert "Project" not in m._jdf.queryExecution().optimizedPlan().toString()


def test_rfc2822_variants(spark):
    import datetime as dt

    from tidemark.functions.timeparse import format_rfc2822, parse_rfc2822

    texts = ["Fri, 03 Oct 2025 00:00:01 +0000", "3 Oct 2025 00:00:01 +0000",
             "Fri, 03 Oct 2025 02:00:01 +0200", "not a date", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(parse_rfc2822("t")).collect()]
    want = dt.datetime(2025, 10, 3, 0, 0, 1)
    assert got == [want, want, want, None, None]
    back = df.select(format_rfc2822(parse_rfc2822("t"))).first()[0]
    assert back == "Fri, 03 Oct 2025 00:00:01 +0000"


def test_sink_read_lists_only_the_batch_days(spark, tmp_dir):
    import datetime as dt

    sink = f"{tmp_dir}/sink"
    old = spark.range(0, 500).select(
        F.sha2(F.col("id").cast("string"), 256).alias("h"),
        F.date_add(F.lit("2025-01-01").cast("date"), (F.col("id") % 50).cast("int")).alias("d"),
    )
    old.write.partitionBy("d").parquet(sink)
    days = [dt.date(2025, 1, 3), dt.date(2030, 1, 1)]  # the second is not in the sink
    got = ingest.read_sink_partitions(spark, sink, "d", days)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "InMemoryFileIndex(1 paths)" in plan and "d=2025-01-03" in plan
    assert got.count() == 10 and {r["d"] for r in got.select("d").distinct().collect()} == {days[0]}
    assert ingest.read_sink_partitions(spark, sink, "d", [dt.date(2030, 1, 1)]) is None
    assert ingest.read_sink_partitions(spark, f"{tmp_dir}/none", "d", days) is None
    assert ingest.read_sink_partitions(spark, sink, "d", []) is None


def test_sink_read_null_day_and_fallback(spark, tmp_dir):
    sink = f"{tmp_dir}/sink"
    rows = [("a", "x y"), ("b", None), ("c", "z")]
    spark.createDataFrame(rows, "h string, d string").write.partitionBy("d").parquet(sink)
    # NULL -> the default partition folder, opened by name
    nul = ingest.read_sink_partitions(spark, sink, "d", [None])
    assert [r["h"] for r in nul.collect()] == ["b"]
    # a value with a space is not a plain folder name: root read + filter
    mixed = ingest.read_sink_partitions(spark, sink, "d", ["x y", None])
    assert sorted(r["h"] for r in mixed.collect()) == ["a", "b"]


def test_append_new_against_many_days(spark, tmp_dir):
    sink = f"{tmp_dir}/sink"
    first = spark.range(0, 300).select(
        F.col("id").cast("string").alias("h"),
        F.date_add(F.lit("2025-01-01").cast("date"), (F.col("id") % 30).cast("int")).alias("d"),
    )
    ingest.append_new(spark, first, sink, ["h"], "d", key_fixes_partition=True)
    again = first.where("id < 40").unionByName(
        spark.range(1000, 1005).select(F.col("id").cast("string").alias("h"),
                                       F.lit("2025-01-02").cast("date").alias("d"))
    )
    ingest.append_new(spark, again, sink, ["h"], "d", key_fixes_partition=True)
    assert spark.read.parquet(sink).count() == 305


def test_sink_read_honours_streaming_file_sink_log(spark, tmp_dir):
    import datetime as dt

    sink = f"{tmp_dir}/sink"
    src = f"{tmp_dir}/src"
    spark.createDataFrame([("a", "2025-01-01"), ("b", "2025-01-02")], "h string, d string") \
        .withColumn("d", F.to_date("d")).write.parquet(src)
    q = (spark.readStream.schema("h string, d date").parquet(src).writeStream.format("parquet")
         .option("path", sink).option("checkpointLocation", f"{tmp_dir}/ck")
         .partitionBy("d").trigger(availableNow=True).start())
    q.awaitTermination()
    got = ingest.read_sink_partitions(spark, sink, "d", [dt.date(2025, 1, 2)])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "MetadataLogFileIndex" in plan
    assert [r["h"] for r in got.collect()] == ["b"]


def test_sink_read_root_with_glob_characters(spark, tmp_dir):
    import datetime as dt

    sink = f"{tmp_dir}/odd[1]{{x}}"
    spark.createDataFrame([("a", "2025-01-01"), ("b", "2025-01-02")], "h string, d string") \
        .withColumn("d", F.to_date("d")).write.partitionBy("d").parquet(sink)
    got = ingest.read_sink_partitions(spark, sink, "d", [dt.date(2025, 1, 2)])
    assert [r["h"] for r in got.collect()] == ["b"]
