"""Bounded dedupe: every row once, recent or old, also after a failed batch."""

import datetime as dt
import json
import os

import pytest

import sample_docs
from tidemark.operators import ingest
from tidemark.plans.silver import to_silver
from tidemark.sources.snapshots import read_snapshots
from tidemark.streaming import ingest as S

CODES = sample_docs.CODES[:5]
TODAY = dt.datetime.now(dt.timezone.utc).date()


def land(raw, name, days, value=2.0):
    with open(f"{raw}/{name}.json", "w") as f:
        for d in days:
            f.write(json.dumps(sample_docs.document(d, {c: value + i for i, c in enumerate(CODES)})) + "\n")


def back(*n):
    return [TODAY - dt.timedelta(days=i) for i in n]


def hashes(spark, silver):
    return sorted(r.hash_diff for r in spark.read.parquet(silver).collect())


def want(spark, raw):
    return sorted({r.hash_diff for r in to_silver(read_snapshots(spark, raw, multiline=False)).collect()})


def test_recent_and_old_rows_each_once(spark, tmp_dir, monkeypatch):
    raw, silver, ckpt = (f"{tmp_dir}/{n}" for n in ("raw", "silver", "ckpt"))
    os.makedirs(raw)
    compared = []
    real = ingest.append_new
    monkeypatch.setattr(S.ingest, "append_new", lambda spark, batch, *a, **k: (compared.append(batch.count()), real(spark, batch, *a, **k)))
    run = lambda: S.stream_silver_bounded(spark, raw, silver, ckpt, "2 days", multiline=False, max_files_per_trigger=1)
    land(raw, "a", back(0, 1))
    land(raw, "b", back(40, 41))
    run()
    assert [n for n in compared if n] == [10]  # recent rows are appended without a comparison
    land(raw, "c", back(0, 1, 41))  # delivered again: dropped by the state
    land(raw, "d", back(60), value=3.0)  # far later than the delay
    run()
    assert hashes(spark, silver) == want(spark, raw) and len(want(spark, raw)) == 25
    # the state is gone with the old checkpoint: old rows are known from the sink
    land(raw, "e", back(40, 41, 60, 70), value=3.0)
    S.stream_silver_bounded(spark, raw, silver, f"{tmp_dir}/ckpt2", "1 second", multiline=False)
    assert hashes(spark, silver) == want(spark, raw)


def test_a_batch_that_ended_halfway(spark, tmp_dir, monkeypatch):
    raw, silver, ckpt = (f"{tmp_dir}/{n}" for n in ("raw", "silver", "ckpt"))
    os.makedirs(raw)
    land(raw, "a", back(0, 1, 40))
    with monkeypatch.context() as m:
        m.setattr(S.ingest, "append_new", lambda *a, **k: 1 / 0)  # the recent rows are appended by then
        with pytest.raises(Exception, match="division"):
            S.stream_silver_bounded(spark, raw, silver, ckpt, multiline=False)
    assert len(hashes(spark, silver)) == 10
    S.stream_silver_bounded(spark, raw, silver, ckpt, multiline=False)
    assert hashes(spark, silver) == want(spark, raw) and len(hashes(spark, silver)) == 15
