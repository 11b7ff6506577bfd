"""Lag / percentage-change semantics and the equality of both strategies."""

import datetime as dt
import random

import pytest

from tidemark.operators.series import performance

SCHEMA = "entity string, ts date, value decimal(20,4)"
COLS = ["entity", "ts", "prev_value", "daily_change_pct", "value_lag_7", "value_lag_30",
        "weekly_change_pct", "monthly_change_pct"]


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def day(i):
    return dt.date(2025, 1, 1) + dt.timedelta(days=i)


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*COLS).collect()), key=repr)


def test_first_row_dropped_and_lag_after_filter(spark):
    from decimal import Decimal as D

    rows = [("A", day(i), D(100 + i)) for i in range(40)]
    out = performance(frame(spark, rows), "entity", "ts", "value")
    assert out.count() == 39
    weekly = out.where("weekly_change_pct is not null").orderBy("ts").first()
    # the first weekly value is on the entity's 9th row (lag 7 after the filter)
    assert weekly["ts"] == day(8)
    assert out.where("monthly_change_pct is not null").orderBy("ts").first()["ts"] == day(31)


def test_one_row_entity_and_zero_previous(spark):
    from decimal import Decimal as D

    rows = [("solo", day(0), D(5)), ("z", day(0), D(0)), ("z", day(1), D(3))]
    out = performance(frame(spark, rows), "entity", "ts", "value")
    got = out.select("entity", "daily_change_pct").collect()
    assert [(r[0], r[1]) for r in got] == [("z", None)]


def test_thresholds_strict(spark):
    from tidemark.functions.classify import TIER_LABELS, TIER_RULES, classify

    df = spark.createDataFrame([(2.0,), (1.0,), (-1.0,), (-2.0,), (2.01,), (None,)], "x double")
    got = [r[0] for r in df.select(classify("x", *TIER_RULES)).collect()]
    L = TIER_LABELS
    assert got == [L["up"], L["stable"], L["stable"], L["down"], L["strong_up"], L["stable"]]


def test_risk_thresholds(spark):
    from tidemark.functions.classify import RISK_LABELS, RISK_RULES, classify

    df = spark.createDataFrame([(3.0,), (1.5,), (3.01,), (None,)], "x double")
    got = [r[0] for r in df.select(classify("x", *RISK_RULES)).collect()]
    assert got == [RISK_LABELS["medium"], RISK_LABELS["low"], RISK_LABELS["high"], RISK_LABELS["low"]]


def _random_rows(seed, n_entities=4, hot=300, with_nulls=True):
    from decimal import Decimal as D

    rnd = random.Random(seed)
    rows = []
    for e in range(n_entities):
        n = hot if e == 0 else rnd.randint(1, 45)
        days = rnd.sample(range(400), n)
        for d in days:
            v = None if (with_nulls and rnd.random() < 0.08) else D(rnd.randint(0, 500))
            rows.append((f"e{e}", day(d), v))
    rows.append((None, day(3), D(7)))
    rows.append((None, day(4), D(8)))
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_indexed_equals_window_with_nulls_and_hot_entity(spark, seed):
    df = frame(spark, _random_rows(seed))
    a = performance(df, "entity", "ts", "value", strategy="window")
    b = performance(df, "entity", "ts", "value", strategy="indexed", rows_per_bucket=16)
    assert rows_of(a) == rows_of(b)


@pytest.mark.parametrize("strategy", ["window", "indexed", "auto"])
def test_tied_times_are_ordered_by_content(spark, strategy):
    """Three rows for each time and no extra order: every strategy gives the
    one result that ordering by the other columns gives."""
    from decimal import Decimal as D

    rows = [("A", day(i // 3), D(100 + (i * 37) % 91)) for i in range(30)]
    want, prev = [], None
    for _, ts, v in sorted(rows):
        if prev is not None:
            want.append((ts, v, prev))
        prev = v
    for seed in (1, 2):
        random.Random(seed).shuffle(rows)
        got = performance(frame(spark, rows), "entity", "ts", "value", strategy=strategy, hot_series_rows=0,
                          rows_per_bucket=4)
        assert sorted((r["ts"], r["value"], r["prev_value"]) for r in got.collect()) == sorted(want)


@pytest.mark.parametrize("with_nulls", [False, True])
def test_many_small_ranges_and_long_lags(spark, with_nulls):
    """Groups shorter than the largest lag: heads reach over several ranges."""
    df = frame(spark, _random_rows(9, with_nulls=with_nulls))
    a = performance(df, "entity", "ts", "value", strategy="window")
    b = performance(df, "entity", "ts", "value", strategy="indexed", rows_per_bucket=5)
    assert rows_of(a) == rows_of(b)


def test_window_plan_single_exchange(spark):
    from decimal import Decimal as D

    df = frame(spark, [("A", day(i), D(i + 1)) for i in range(10)])
    plan = performance(df, "entity", "ts", "value", strategy="window")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 1


@pytest.mark.parametrize("seed", [5, 6])
def test_indexed_without_nulls(spark, seed):
    df = frame(spark, _random_rows(seed, with_nulls=False))
    a = performance(df, "entity", "ts", "value", strategy="window")
    b = performance(df, "entity", "ts", "value", strategy="indexed", rows_per_bucket=16)
    assert rows_of(a) == rows_of(b)


def test_auto_uses_stats(spark):
    from tidemark.operators.series import _stats

    df = frame(spark, _random_rows(4))
    assert _stats(df, "entity") == (300, df.count())
    a = performance(df, "entity", "ts", "value", strategy="window")
    b = performance(df, "entity", "ts", "value", strategy="auto", hot_series_rows=100, rows_per_bucket=16)
    assert rows_of(a) == rows_of(b)


def test_indexed_hot_entity_crowded_in_time_with_ties(spark):
    """A hot entity whose rows crowd into a few seconds of a long span, with
    exact ties in time broken by an extra column: ranges are cut by row
    count, so positions and lags still equal the window strategy's."""
    from decimal import Decimal as D

    rnd = random.Random(11)
    base = dt.datetime(2025, 1, 1)
    rows = [("hot", base + dt.timedelta(days=d), D(rnd.randint(1, 900)), f"k{d}") for d in range(0, 300, 3)]
    rows += [("hot", base + dt.timedelta(days=400, seconds=s // 3), D(rnd.randint(1, 900)), f"t{s:05d}")
             for s in range(1200)]
    rows += [(f"e{e}", base + dt.timedelta(days=d), D(rnd.randint(1, 900)), "x")
             for e in range(5) for d in range(rnd.randint(2, 40))]
    df = spark.createDataFrame(rows, "entity string, ts timestamp_ntz, value decimal(20,4), k string")
    a = performance(df, "entity", "ts", "value", order_extra=["k"], strategy="window")
    b = performance(df, "entity", "ts", "value", order_extra=["k"], strategy="indexed",
                    rows_per_bucket=100)
    assert rows_of(a) == rows_of(b)


def test_indexed_on_shuffled_input_equals_window(spark):
    """Input straight out of an aggregate (row order inside partitions not
    fixed): both uses of the ranged rows must see the same ranges."""
    from pyspark.sql import functions as F

    src = spark.range(0, 40_000).select(
        (F.col("id") % 97).cast("string").alias("entity"),
        F.date_add(F.lit("2020-01-01").cast("date"), ((F.col("id") * 7919) % 900).cast("int")).alias("ts"),
        (F.col("id") % 1000).cast("decimal(20,4)").alias("amount"),
    )
    df = src.groupBy("entity", "ts").agg(F.sum("amount").cast("decimal(20,4)").alias("value"))
    a = performance(df, "entity", "ts", "value", strategy="window")
    b = performance(df, "entity", "ts", "value", strategy="indexed")
    assert rows_of(a) == rows_of(b)


@pytest.mark.parametrize("ranges", [1, 3, 7, 40, 120])
def test_no_null_range_lags_any_range_count(spark, ranges):
    """Window lags inside (entity, range) plus copies of the rows before equal the
    window strategy, from one range up to ranges shorter than the largest lag."""
    from tidemark.operators.series import _performance_indexed

    df = frame(spark, _random_rows(8, n_entities=6, with_nulls=False))
    a = performance(df, "entity", "ts", "value", strategy="window")
    b = _performance_indexed(df, "entity", "ts", "value", ("daily", 1),
                             {"weekly": 7, "monthly": 30}, (), 2, ranges)
    assert rows_of(a) == rows_of(b)


def test_auto_no_nulls_on_shuffled_input(spark):
    from pyspark.sql import functions as F

    src = spark.range(0, 40_000).select(
        (F.col("id") % 97).cast("string").alias("entity"),
        F.date_add(F.lit("2020-01-01").cast("date"), ((F.col("id") * 7919) % 900).cast("int")).alias("ts"),
        (F.col("id") % 1000 + 1).cast("decimal(20,4)").alias("amount"),
    )
    df = src.groupBy("entity", "ts").agg(F.sum("amount").cast("decimal(20,4)").alias("value"))
    a = performance(df, "entity", "ts", "value", strategy="window")
    b = performance(df, "entity", "ts", "value", strategy="auto", hot_series_rows=0)
    assert rows_of(a) == rows_of(b)


@pytest.mark.parametrize("ranges", [1, 5, 33, 150])
@pytest.mark.parametrize("seed", [21, 22])
def test_null_path_any_range_count(spark, ranges, seed):
    from tidemark.operators.series import _performance_indexed

    df = frame(spark, _random_rows(seed, n_entities=5))
    a = performance(df, "entity", "ts", "value", strategy="window")
    b = _performance_indexed(df, "entity", "ts", "value", ("daily", 1),
                             {"weekly": 7, "monthly": 30}, (), 2, ranges)
    assert rows_of(a) == rows_of(b)


def test_identical_rows_of_a_hot_entity_spread_over_ranges(spark):
    """A third of all rows equal in every column (one entity, one time, one
    value): ranges still hold about equal counts, positions stay exact."""
    from decimal import Decimal as D

    from pyspark.sql import functions as F

    from tidemark.operators._util import entity_key
    from tidemark.operators.series import _order, _ranged

    rows = [("hot", day(0), D(5))] * 600
    rows += [(f"e{e}", day(d), D(d + 1)) for e in range(20) for d in range(60)]
    df = frame(spark, rows)
    keyed = df.withColumn("_ek", entity_key("entity"))
    ranged, _ = _ranged(keyed, "_ek", _order(df, "entity", "ts", ()), 12, "value")
    sizes = [r["count"] for r in ranged.groupBy("_rg").count().collect()]
    assert max(sizes) <= 2 * (len(rows) / 12)
    hot = ranged.where(F.col("entity") == "hot").select("_rg").distinct().count()
    assert hot >= 3
    a = performance(df.where(F.col("entity") != "hot"), "entity", "ts", "value", strategy="window")
    b = performance(df, "entity", "ts", "value", strategy="indexed").where(F.col("entity") != "hot")
    assert rows_of(a) == rows_of(b)
    # the hot entity: every row but the first is kept, all lags equal the value
    h = performance(df, "entity", "ts", "value", strategy="indexed").where(F.col("entity") == "hot")
    assert h.count() == 599
    assert h.where("prev_value = 5 AND daily_change_pct = 0").count() == 599
    assert h.where("value_lag_30 IS NULL").count() == 30
