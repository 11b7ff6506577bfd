"""Properties of ingestion: order and batching of the input do not matter."""

import os
import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import RAW_FX

FILES = sorted(os.listdir(RAW_FX))


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(seed=st.integers(0, 10_000), n_batches=st.integers(2, 4))
def test_any_order_any_batching_same_silver(spark, seed, n_batches):
    import tempfile

    from tidemark.plans.silver import SILVER_COLS, run_silver

    rnd = random.Random(seed)
    files = FILES[:]
    rnd.shuffle(files)
    base = tempfile.mkdtemp(prefix="tidemark-prop-")
    sink = f"{base}/silver"
    cuts = sorted(rnd.sample(range(1, len(files)), n_batches - 1))
    for part in [files[a:b] for a, b in zip([0, *cuts], [*cuts, len(files)])]:
        run_silver(spark, [f"{RAW_FX}/{f}" for f in part], sink)
    got = spark.read.parquet(sink)
    assert got.count() == 6520
    keys = [c for c in SILVER_COLS if c != "load_date_src"]
    full = spark.read.parquet(_full_backfill_silver(spark))
    assert got.select(*keys).exceptAll(full.select(*keys)).count() == 0


_REF = {}


def _full_backfill_silver(spark):
    if "path" not in _REF:
        import tempfile

        from tidemark.plans.silver import run_silver

        path = tempfile.mkdtemp(prefix="tidemark-ref-") + "/silver"
        run_silver(spark, f"{RAW_FX}/*.json", path)
        _REF["path"] = path
    return _REF["path"]
