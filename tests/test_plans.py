"""Physical plan shapes the design relies on."""

from pyspark.sql import functions as F

from conftest import RAW_FX, SF_SMALL


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_top_k_is_take_ordered(spark):
    from tidemark.plans.catalog import q_top_gainers

    p = plan_of(q_top_gainers(spark, SF_SMALL))
    assert "TakeOrderedAndProject" in p
    # the full frame is never globally sorted
    assert "rangepartitioning" not in p


def test_series_scan_prunes_columns(spark):
    from tidemark.plans.series_sources import supplier_month_series

    p = plan_of(supplier_month_series(spark, SF_SMALL))
    assert "ReadSchema: struct<l_suppkey:bigint,l_extendedprice:double,l_shipdate:timestamp_ntz>" in p


def test_lag_chain_shares_one_exchange(spark):
    from tidemark.plans.catalog import perf_a

    p = plan_of(perf_a(spark, SF_SMALL))
    # one exchange for the series aggregate, one for the entity windows
    assert p.count("Exchange hashpartitioning") == 2
    assert p.count("Window [") == 2 or p.count("Window") >= 2


def test_entity_filter_reaches_scan_below_windows(spark, tmp_dir):
    from tidemark.operators import movers
    from tidemark.plans.gold import performance_frame
    from tidemark.plans.silver import run_silver

    silver = f"{tmp_dir}/silver"
    run_silver(spark, f"{RAW_FX}/exchange_rates_2025-10-0*.json", silver)
    perf = performance_frame(spark.read.parquet(silver), "window")
    p = plan_of(movers.entity_history(perf, "code_exchange_rate", "USD"))
    assert "PushedFilters: [IsNotNull(code_exchange_rate), EqualTo(code_exchange_rate,USD)]" in p


def test_anti_join_reads_only_batch_days(spark, tmp_dir):
    from tidemark.operators import ingest

    sink = f"{tmp_dir}/sink"
    old = spark.range(0, 1000).select(
        F.sha2(F.col("id").cast("string"), 256).alias("h"),
        F.date_add(F.lit("2025-01-01").cast("date"), (F.col("id") % 50).cast("int")).alias("d"),
    )
    old.write.partitionBy("d").parquet(sink)
    seen = old.where("d = date'2025-01-03'").first()["h"]
    batch = spark.createDataFrame([(seen, "2025-01-03"), ("new", "2025-01-03")], "h string, d string") \
        .withColumn("d", F.to_date("d"))
    out = ingest.new_records(batch, spark.read.parquet(sink), ["h"], "d", key_fixes_partition=True)
    assert [r["h"] for r in out.collect()] == ["new"]
    import re

    scans = [ln for ln in plan_of(out).split("\n") if "FileScan parquet" in ln]
    assert scans  # the adaptive plan prints its initial and final forms
    for scan in scans:
        # only the batch's day is listed, and only the key column is read
        assert re.search(r"PartitionFilters: \[isnotnull\(d#\d+\), \(d#\d+ = 2025-01-03\)\]", scan)
        assert "ReadSchema: struct<h:string>" in scan
