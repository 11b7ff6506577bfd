"""Lags of a stream equal those of the batch; late rows stand beside."""

import json

import sample_docs
from test_gold_incremental import CODES, same

from tidemark.operators import series
from tidemark.plans.silver import ENTITY, TIME, VALUE, to_silver
from tidemark.sources.snapshots import read_snapshots
from tidemark.streaming.lags import stream_performance

COLUMNS = [ENTITY, TIME, VALUE, "prev_value", "daily_change_pct", "value_lag_7", "value_lag_30", "weekly_change_pct", "monthly_change_pct"]


def land(path, name, days, codes=CODES, change=None):
    rates = list(sample_docs.rates().items())
    with open(f"{path}/{name}.json", "w") as f:
        for i in days:
            values = {c: rates[i][1][c] + (change or 0) for c in codes if (i + len(c) + ord(c[0])) % 11}
            f.write(json.dumps(sample_docs.document(rates[i][0], values)) + "\n")


def test_stream_equals_batch(spark, tmp_dir):
    import os

    raw, perf, late = (f"{tmp_dir}/{n}" for n in ("raw", "perf", "late"))
    os.makedirs(raw)
    run = lambda: stream_performance(spark, raw, perf, late, f"{tmp_dir}/ckpt", multiline=False)
    days = [d for d in range(40) if d != 21]
    # a day alone, several at once, a day delivered twice, in one batch and across batches
    for name, part in (("a", days[:1]), ("b", days[1:12] + days[5:6]), ("c", days[10:30]), ("d", days[30:])):
        land(raw, name, part)
        run()
    want = series.performance(to_silver(read_snapshots(spark, raw, multiline=False)).dropDuplicates(["hash_diff"]), ENTITY, TIME, VALUE)
    got = spark.read.parquet(perf)
    assert same(got.select(COLUMNS), want.select(COLUMNS)) and got.where("monthly_change_pct is not null").count() > 0
    assert spark.read.parquet(late).count() == 0
    # a day left out, and a correction of a day: both are late, nothing on time changes
    land(raw, "e", [21])
    land(raw, "f", [38], CODES[:2], change=1)
    run()
    assert same(spark.read.parquet(perf).select(COLUMNS), got.select(COLUMNS))
    side = {(r[ENTITY], r[TIME].date()) for r in spark.read.parquet(late).collect()}
    stamps = list(sample_docs.rates())
    missing = {(c, stamps[i]) for i, codes in ((21, CODES), (38, CODES[:2])) for c in codes if (i + len(c) + ord(c[0])) % 11}
    assert side == missing
