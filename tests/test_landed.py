"""Ingestion properties on snapshots landed from the driver tables.

Series A (supplier x month) is landed as raw JSON documents, each snapshot
delivered twice (the second copy one day later), so every test below also
checks that a repeated delivery is stored once.
"""

import os
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import SF_SMALL

GOLD_NAMES = ("currency_heatmap", "top_gainers", "top_losers", "volatility_exchange_rates")


@pytest.fixture(scope="module")
def landed(spark):
    from tidemark.plans.catalog_io import _landed
    from tidemark.plans.series_sources import supplier_month_series

    raw = _landed(spark, SF_SMALL, rerun=False, redeliver=True)
    files = sorted(
        os.path.join(d, f) for d, _, fs in os.walk(raw) for f in fs if f.endswith(".json")
    )
    expected = supplier_month_series(spark, SF_SMALL).count()
    return raw, files, expected


def _silver_keys(df):
    from tidemark.plans.silver import SILVER_COLS

    return df.select(*[c for c in SILVER_COLS if c != "load_date_src"])


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_every_snapshot_delivered_twice(landed):
    raw, files, expected = landed
    days = {p.split("ingest_date=")[1].split("/")[0] for p in files}
    assert len(days) % 2 == 0 and len(days) >= 2
    assert expected > 0


def test_stream_equals_batch(spark, tmp_dir, landed):
    from tidemark.plans.silver import run_silver
    from tidemark.streaming.ingest import stream_silver

    raw, _, expected = landed
    silver = f"{tmp_dir}/silver"
    # small triggers: several micro-batches, copies of a snapshot in different ones
    q = stream_silver(spark, raw, silver, f"{tmp_dir}/ckpt", multiline=False,
                      max_files_per_trigger=20)
    assert len(q.recentProgress) > 1
    got = spark.read.parquet(silver)
    assert got.count() == expected
    assert got.select("hash_diff").distinct().count() == expected
    # a second availableNow run finds no new files and appends nothing
    stream_silver(spark, raw, silver, f"{tmp_dir}/ckpt", multiline=False, max_files_per_trigger=20)
    assert spark.read.parquet(silver).count() == expected
    run_silver(spark, raw, f"{tmp_dir}/batch", multiline=False)
    assert _same(_silver_keys(got), _silver_keys(spark.read.parquet(f"{tmp_dir}/batch")))


def test_stateful_dedupe(spark, tmp_dir, landed):
    from tidemark.streaming.ingest import stream_silver_dedupe

    raw, _, expected = landed
    stream_silver_dedupe(spark, raw, f"{tmp_dir}/silver", f"{tmp_dir}/ckpt", multiline=False)
    assert spark.read.parquet(f"{tmp_dir}/silver").count() == expected


def test_watermark_dedupe_with_wide_delay(spark, tmp_dir, landed):
    from tidemark.streaming.ingest import stream_silver_dedupe

    raw, _, expected = landed
    stream_silver_dedupe(spark, raw, f"{tmp_dir}/silver", f"{tmp_dir}/ckpt", multiline=False,
                         watermark="36500 days")
    assert spark.read.parquet(f"{tmp_dir}/silver").count() == expected


def test_streaming_pipeline_matches_batch_gold(spark, tmp_dir, landed):
    from tidemark.plans.pipeline import run_pipeline, run_pipeline_streaming

    raw, _, _ = landed
    a = run_pipeline_streaming(spark, raw, f"{tmp_dir}/s1", f"{tmp_dir}/g1", f"{tmp_dir}/ck",
                               multiline=False, max_files_per_trigger=40)
    b = run_pipeline(spark, raw, f"{tmp_dir}/s2", f"{tmp_dir}/g2", multiline=False)
    for name in GOLD_NAMES:
        assert _same(a[name], b[name]), name


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(seed=st.integers(0, 10_000), n_batches=st.integers(2, 4))
def test_any_order_any_batching_same_silver(spark, landed, seed, n_batches):
    import tempfile

    from tidemark.plans.silver import run_silver

    raw, files, expected = landed
    rnd = random.Random(seed)
    order = files[:]
    rnd.shuffle(order)
    sink = tempfile.mkdtemp(prefix="tidemark-prop-") + "/silver"
    cuts = sorted(rnd.sample(range(1, len(order)), n_batches - 1))
    for part in [order[a:b] for a, b in zip([0, *cuts], [*cuts, len(order)])]:
        run_silver(spark, part, sink, multiline=False)
    got = spark.read.parquet(sink)
    assert got.count() == expected
    full = f"{sink}-full"
    run_silver(spark, raw, full, multiline=False)
    assert _same(_silver_keys(got), _silver_keys(spark.read.parquet(full)))


def test_entity_filter_reaches_scan_below_windows(spark, tmp_dir, landed):
    from tidemark.operators import movers
    from tidemark.plans.gold import performance_frame
    from tidemark.plans.series_sources import supplier_month_series
    from tidemark.plans.silver import run_silver

    raw, _, _ = landed
    silver = f"{tmp_dir}/silver"
    run_silver(spark, raw, silver, multiline=False)
    perf = performance_frame(spark.read.parquet(silver), "window")
    hist = movers.entity_history(perf, "code_exchange_rate", "1")
    p = hist._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(code_exchange_rate), EqualTo(code_exchange_rate,1)]" in p
    months = supplier_month_series(spark, SF_SMALL).where(F.col("entity") == 1).count()
    assert hist.count() == months - 1 > 0


def test_gold_performance_is_partitioned_and_movers_read_one_day(spark, tmp_dir, landed):
    import glob

    from tidemark.plans.gold import latest_partition
    from tidemark.plans.pipeline import run_pipeline

    raw, _, _ = landed
    out = run_pipeline(spark, raw, f"{tmp_dir}/silver", f"{tmp_dir}/gold", multiline=False)
    path = f"{tmp_dir}/gold/performance.parquet"
    days = sorted(p.rpartition("=")[2] for p in glob.glob(f"{path}/snapshot_date=*"))
    assert len(days) > 30 and latest_partition(spark, path, "snapshot_date") == days[-1]
    perf = out["performance"]
    latest = perf.where(F.col("snapshot_date") == F.lit(days[-1]).cast("date"))
    assert len(latest.inputFiles()) == len(perf.inputFiles())  # the pruning is the scan's
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(snapshot_date" in plan
    assert out["currency_heatmap"].count() == latest.count()


def test_silver_day_files_clustered_by_entity_and_time(spark, tmp_dir, landed):
    import glob

    import pyarrow.parquet as pq

    from tidemark.plans.silver import run_silver

    raw, _, expected = landed
    run_silver(spark, raw, f"{tmp_dir}/silver", multiline=False)
    parts = glob.glob(f"{tmp_dir}/silver/snapshot_date=*/*.parquet")
    assert parts
    for part in parts:
        t = pq.read_table(part, columns=["code_exchange_rate", "time_last_update_utc"])
        rows = list(zip(*[c.to_pylist() for c in t.columns]))
        assert rows == sorted(rows)
    assert spark.read.parquet(f"{tmp_dir}/silver").count() == expected


def test_stream_archives_processed_files(spark, tmp_dir):
    from tidemark.plans.catalog_io import _landed
    from tidemark.plans.series_sources import supplier_month_series
    from tidemark.streaming.ingest import stream_silver

    raw = _landed(spark, SF_SMALL, rerun=False, redeliver=False)
    n_files = sum(1 for _, _, fs in os.walk(raw) for f in fs if f.endswith(".json"))
    archive = f"{tmp_dir}/archive"
    stream_silver(spark, raw, f"{tmp_dir}/silver", f"{tmp_dir}/ckpt", multiline=False,
                  max_files_per_trigger=25, archive_dir=archive)
    assert spark.read.parquet(f"{tmp_dir}/silver").count() == supplier_month_series(spark, SF_SMALL).count()
    left = sum(1 for _, _, fs in os.walk(raw) for f in fs if f.endswith(".json"))
    moved = sum(1 for _, _, fs in os.walk(archive) for f in fs if f.endswith(".json"))
    assert moved > 0 and left + moved == n_files


def _pretty_files(spark, landed, target, limit=12):
    """A few landed documents re-written one per file, pretty-printed like the
    API's own files, named by the dated-path rule."""
    import datetime as dt
    import json

    from tidemark.sources.snapshots import dated_snapshot_path

    _, files, _ = landed
    os.makedirs(target, exist_ok=True)
    docs = []
    for path in files:
        with open(path) as fh:
            docs += [json.loads(line) for line in fh if line.strip()]
    docs = sorted(docs, key=lambda d: (d["time_last_update_unix"], sorted(d["conversion_rates"])))
    out = []
    for i, doc in enumerate(docs[:limit]):
        doc.pop("ingest_date", None)
        name = dated_snapshot_path(target, dt.date(2030, 1, 1) + dt.timedelta(days=i))
        with open(name, "w") as fh:
            json.dump(doc, fh, indent=2)
        out.append(name)
    return out


def test_dated_path_and_multiline_read(spark, tmp_dir, landed):
    import datetime as dt

    from tidemark.plans.silver import to_silver
    from tidemark.sources.snapshots import dated_snapshot_path, read_snapshots

    assert dated_snapshot_path("/raw/", dt.date(2025, 10, 3)) == "/raw/exchange_rates_2025-10-03.json"
    files = _pretty_files(spark, landed, f"{tmp_dir}/pretty")
    assert os.path.exists(dated_snapshot_path(f"{tmp_dir}/pretty", "2030-01-01"))
    pretty = read_snapshots(spark, f"{tmp_dir}/pretty/*.json", multiline=True)
    assert pretty.count() == len(files)
    assert pretty.where("conversion_rates IS NULL").count() == 0
    # without multiLine a pretty-printed document is not one record
    lines = read_snapshots(spark, f"{tmp_dir}/pretty/*.json", multiline=False)
    with pytest.raises(Exception, match="[Mm]alformed"):
        lines.collect()
    assert to_silver(pretty).count() == sum(
        len(r["conversion_rates"]) for r in pretty.select("conversion_rates").collect()
    )


def test_struct_inferred_read_gives_same_silver(spark, tmp_dir, landed):
    """Schema inference reads the rates object as a struct; the unnest +
    unpivot path yields the same silver rows as the map read."""
    from tidemark.plans.silver import to_silver
    from tidemark.sources.snapshots import read_snapshots

    _pretty_files(spark, landed, f"{tmp_dir}/pretty")
    inferred = spark.read.option("multiLine", True).json(f"{tmp_dir}/pretty/*.json")
    assert dict(inferred.dtypes)["conversion_rates"].startswith("struct")
    a = _silver_keys(to_silver(inferred))
    b = _silver_keys(to_silver(read_snapshots(spark, f"{tmp_dir}/pretty/*.json")))
    assert a.count() > 0 and _same(a, b)


def test_stateful_dedupe_files_per_day(spark, tmp_dir, landed):
    import glob

    from tidemark.streaming.ingest import stream_silver_dedupe

    raw, _, expected = landed
    stream_silver_dedupe(spark, raw, f"{tmp_dir}/silver", f"{tmp_dir}/ckpt", multiline=False,
                         files_per_day=2)
    assert spark.read.parquet(f"{tmp_dir}/silver").count() == expected
    days = glob.glob(f"{tmp_dir}/silver/snapshot_date=*")
    assert days and all(len(glob.glob(f"{d}/*.parquet")) <= 2 for d in days)
