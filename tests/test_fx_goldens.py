"""The full pipeline over the 41 generated quote snapshots against a plain
Python version of it."""

import os
import statistics
from collections import Counter
from decimal import ROUND_HALF_UP, Decimal

import pytest
import sample_docs
from pyspark.sql import functions as F

from conftest import RAW_FX

generated = pytest.mark.skipif(bool(os.environ.get("TIDEMARK_SAMPLE_SNAPSHOTS")), reason="other documents")


def half_up(x, digits=2):
    return float(Decimal(repr(x)).quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP))


@pytest.fixture(scope="module")
def changes():
    """Per code: the daily changes in time order; and the last day's rates."""
    days = list(sample_docs.rates().values())
    out = {}
    for c in sample_docs.CODES:
        v = [float(d[c]) for d in days]
        out[c] = [half_up((b - a) / a * 100.0) for a, b in zip(v, v[1:])]
    return out, days[-1]


@pytest.fixture(scope="module")
def gold(spark, tmp_path_factory):
    from tidemark.plans.pipeline import run_pipeline

    base = str(tmp_path_factory.mktemp("fx"))
    out = run_pipeline(spark, f"{RAW_FX}/*.json", f"{base}/silver", f"{base}/gold", strategy="window")
    out["_base"] = base
    return out


def test_silver_counts(spark, gold):
    silver = spark.read.parquet(f"{gold['_base']}/silver")
    assert silver.count() == 6520
    assert silver.select("time_last_update_utc").distinct().count() == 40
    assert silver.where(F.col("time_last_update_utc").isNull()).count() == 0


def test_replay_appends_nothing(spark, gold):
    from tidemark.plans.silver import run_silver

    run_silver(spark, f"{RAW_FX}/*.json", f"{gold['_base']}/silver")
    assert spark.read.parquet(f"{gold['_base']}/silver").count() == 6520


def test_performance(gold):
    perf = gold["performance"]
    assert perf.count() == 6357
    assert perf.where("weekly_change_pct is not null").count() == 5216
    assert perf.where("monthly_change_pct is not null").count() == 1467


@generated
def test_movers_and_tiers(gold, changes):
    daily, _ = changes
    hm = {r["code_exchange_rate"]: r for r in gold["currency_heatmap"].collect()}
    assert {c: r["daily_change_pct"] for c, r in hm.items()} == {c: x[-1] for c, x in daily.items()}
    tier = lambda x: ("🔥 Forte Alta" if x > 2 else "⚡ Em Alta" if x > 1 else "❄️ Forte Baixa" if x < -2
                      else "📉 Em Baixa" if x < -1 else "➡️ Estável")
    assert Counter(r["performance_tier"] for r in hm.values()) == Counter(tier(x[-1]) for x in daily.values())
    assert len({r["performance_tier"] for r in hm.values()}) >= 3


@generated
def test_gainers_losers(gold, changes):
    daily, _ = changes
    for name, sign in (("top_gainers", -1), ("top_losers", 1)):
        want = sorted(daily, key=lambda c: (sign * daily[c][-1], c))[:10]
        rows = gold[name].orderBy("rank").collect()
        assert [(r["rank"], r["code_exchange_rate"], r["daily_change_pct"]) for r in rows] == [
            (i, c, daily[c][-1]) for i, c in enumerate(want, 1)
        ]


@generated
def test_volatility(gold, changes):
    daily, _ = changes
    vol = {r["code_exchange_rate"]: r for r in gold["volatility_exchange_rates"].collect()}
    assert len(vol) == 163 and {r["days_tracked"] for r in vol.values()} == {39}
    for c, x in daily.items():
        assert vol[c]["volatility_30d"] == pytest.approx(statistics.stdev(x), abs=0.0051)
        exact = sum(Decimal(repr(v)) for v in x) / len(x)
        assert vol[c]["avg_change_30d"] == float(exact.quantize(Decimal("0.01"), ROUND_HALF_UP))
        assert (vol[c]["max_gain_30d"], vol[c]["max_loss_30d"]) == (max(x), min(x))
        v = vol[c]["volatility_30d"]
        assert vol[c]["risk_score"] == ("🔴 Alto" if v > 3 else "🟡 Médio" if v > 1.5 else "🟢 Baixo")


@generated
def test_rollup_root(gold, changes):
    from tidemark.operators.profile import rollup_tree

    daily, last = changes
    tree = rollup_tree(gold["currency_heatmap"], "code_exchange_rate", "exchange_rate",
                       "daily_change_pct", root_label="ALL")
    root = tree.where("depth = 0").first()
    assert root["size"] == pytest.approx(sum(last.values()), abs=1e-6)
    assert root["color"] == pytest.approx(sum(last[c] * daily[c][-1] for c in last) / sum(last.values()), abs=1e-9)
    assert tree.count() == 164


def test_indexed_strategy_equals_window(spark, gold):
    from tidemark.plans.gold import performance_frame

    silver = spark.read.parquet(f"{gold['_base']}/silver")
    cols = ["code_exchange_rate", "time_last_update_utc", "prev_value", "daily_change_pct",
            "weekly_change_pct", "monthly_change_pct"]
    a = performance_frame(silver, "window").select(*cols)
    from tidemark.operators.series import performance

    b = performance(silver, "code_exchange_rate", "time_last_update_utc", "exchange_rate",
                    order_extra=["hash_diff"], strategy="indexed", rows_per_bucket=5).select(*cols)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_struct_inferred_read_gives_same_silver(spark):
    """Schema inference reads the rates object as a struct (BRL as bigint,
    others double); the unnest + unpivot path yields the same rows."""
    from tidemark.plans.silver import to_silver

    raw = spark.read.option("multiLine", True).json(f"{RAW_FX}/*.json")
    assert dict(raw.dtypes)["conversion_rates"].startswith("struct")
    s = to_silver(raw).dropDuplicates(["hash_diff"])
    assert s.count() == 6520


def test_dated_snapshot_path():
    import datetime as dt

    from tidemark.sources.snapshots import dated_snapshot_path

    assert dated_snapshot_path("/raw/", dt.date(2025, 10, 3)) == "/raw/exchange_rates_2025-10-03.json"
    assert os.path.exists(dated_snapshot_path(RAW_FX, "2025-10-03"))
