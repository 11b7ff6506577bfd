"""Streaming ingestion equals batch ingestion."""

from conftest import RAW_FX


def test_stream_equals_batch(spark, tmp_dir):
    from tidemark.streaming.ingest import stream_silver

    silver = f"{tmp_dir}/silver"
    # small triggers: several micro-batches, duplicates across batches
    stream_silver(spark, RAW_FX, silver, f"{tmp_dir}/ckpt", max_files_per_trigger=10)
    df = spark.read.parquet(silver)
    assert df.count() == 6520
    assert df.select("hash_diff").distinct().count() == 6520
    # a second availableNow run finds no new files and appends nothing
    stream_silver(spark, RAW_FX, silver, f"{tmp_dir}/ckpt", max_files_per_trigger=10)
    assert spark.read.parquet(silver).count() == 6520


def test_stateful_dedupe(spark, tmp_dir):
    from tidemark.streaming.ingest import stream_silver_dedupe

    silver = f"{tmp_dir}/silver"
    stream_silver_dedupe(spark, RAW_FX, silver, f"{tmp_dir}/ckpt")
    assert spark.read.parquet(silver).count() == 6520


def test_watermark_dedupe_with_wide_delay(spark, tmp_dir):
    from tidemark.streaming.ingest import stream_silver_dedupe

    silver = f"{tmp_dir}/silver"
    stream_silver_dedupe(spark, RAW_FX, silver, f"{tmp_dir}/ckpt", watermark="3650 days")
    assert spark.read.parquet(silver).count() == 6520


def test_streaming_pipeline_matches_batch_gold(spark, tmp_dir):
    from tidemark.plans.pipeline import run_pipeline, run_pipeline_streaming

    a = run_pipeline_streaming(spark, RAW_FX, f"{tmp_dir}/s1", f"{tmp_dir}/g1", f"{tmp_dir}/ck",
                               max_files_per_trigger=15)
    b = run_pipeline(spark, f"{RAW_FX}/*.json", f"{tmp_dir}/s2", f"{tmp_dir}/g2")
    for name in ("currency_heatmap", "top_gainers", "top_losers", "volatility_exchange_rates"):
        assert a[name].exceptAll(b[name]).count() == 0 and b[name].exceptAll(a[name]).count() == 0
