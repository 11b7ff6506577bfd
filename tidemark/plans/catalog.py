"""Driver query catalog: each query is a Spark DataFrame builder taking
(spark, sf_dir), and most have an independent DuckDB SQL twin over the same
tables.  Column names are aliased identically on both sides."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.classify import risk_rules, tier_rules
from tidemark.operators import context, movers, profile, series
from tidemark.plans.series_sources import supplier_month_series
from tidemark.session import scratch_path
from tidemark.sources.tables import read_table

QueryFn = Callable[[SparkSession, str], DataFrame]

# Series A moves far more than FX quotes (month-over-month std ~100 %), so its
# classification thresholds are wider than the FX defaults (tiers 1/2, risk 1.5/3).
A_TIERS = tier_rules(strong=20.0, mild=10.0)
A_RISK = risk_rules(high=150.0, medium=100.0)

PERF_COLS = [
    "entity", "ts", "value", "prev_value", "daily_change_pct",
    "value_lag_7", "value_lag_30", "weekly_change_pct", "monthly_change_pct",
]


def perf_a(spark: SparkSession, sf_dir: str, strategy: str = "window") -> DataFrame:
    return series.performance(
        supplier_month_series(spark, sf_dir), "entity", "ts", "value", strategy=strategy
    ).select(*PERF_COLS)


def written_perf_a(spark, sf_dir) -> DataFrame:
    """The performance frame written once and read back, for queries that use
    it several times (the latest time and its rows, the history): the windows
    run once, as in the gold job."""
    path = scratch_path(spark, "performance")
    perf_a(spark, sf_dir).write.parquet(path)
    return spark.read.parquet(path)


def movers_a(spark, sf_dir):
    return movers.latest_snapshot(written_perf_a(spark, sf_dir), "ts")


# ---------------------------------------------------------------- Spark side
def q_pct_change_daily(spark, sf_dir):
    s = supplier_month_series(spark, sf_dir)
    return series.performance(s, "entity", "ts", "value", lags={}).select(
        "entity", "ts", "value", "prev_value", "daily_change_pct"
    )


def q_pct_change_multi_lag(spark, sf_dir):
    return perf_a(spark, sf_dir)


def q_pct_change_indexed(spark, sf_dir):
    """Same result as pct_change_multi_lag through the skew-safe strategy
    (forced; one sorted range per shuffle partition, so many entities span
    range boundaries)."""
    s = supplier_month_series(spark, sf_dir)
    return series.performance(s, "entity", "ts", "value", strategy="indexed").select(*PERF_COLS)


def q_pct_change_auto(spark, sf_dir):
    """The production path: ``auto`` probes the series lengths; none of these is
    hot, so it takes the windows."""
    s = supplier_month_series(spark, sf_dir)
    return series.performance(s, "entity", "ts", "value", strategy="auto").select(*PERF_COLS)


def event_hours(spark, sf_dir) -> DataFrame:
    """Events by type with their time cut to the hour: many tied times."""
    return read_table(spark, sf_dir, "events").select(
        F.col("event_type").alias("entity"), F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("ts"), "value", "event_id"
    )


def _ties(spark, sf_dir, strategy):
    return series.performance(event_hours(spark, sf_dir), "entity", "ts", "value", strategy=strategy).select(
        "event_id", *PERF_COLS
    )


def q_pct_change_ties_window(spark, sf_dir):
    """Tied times are ordered by the other columns ..."""
    return _ties(spark, sf_dir, "window")


def q_pct_change_ties_indexed(spark, sf_dir):
    """... the same way by either strategy."""
    return _ties(spark, sf_dir, "indexed")


def q_latest_snapshot(spark, sf_dir):
    return movers_a(spark, sf_dir)


def q_entity_history(spark, sf_dir):
    # entity 1 exists at every scale factor (supplier keys start at 1)
    return movers.entity_history(supplier_month_series(spark, sf_dir), "entity", 1)


def q_top_gainers(spark, sf_dir):
    return movers.gainers(
        movers_a(spark, sf_dir), "daily_change_pct", "entity", 10,
        ["entity", "value", "daily_change_pct"],
    )


def q_top_losers(spark, sf_dir):
    return movers.losers(
        movers_a(spark, sf_dir), "daily_change_pct", "entity", 10,
        ["entity", "value", "daily_change_pct"],
    )


def q_heatmap_tiers(spark, sf_dir):
    return profile.heatmap(movers_a(spark, sf_dir), "entity", "value", tier=A_TIERS)


def q_volatility_profile(spark, sf_dir):
    return profile.volatility_profile(perf_a(spark, sf_dir), "entity", risk=A_RISK)


def q_risk_filter(spark, sf_dir):
    vol = profile.volatility_profile(perf_a(spark, sf_dir), "entity", risk=A_RISK, sort=False)
    labels = A_RISK[0]
    return profile.filter_in(vol, "risk", [labels[0][2], labels[1][2]])


def q_kpi_summary(spark, sf_dir):
    hm = profile.heatmap(movers_a(spark, sf_dir), "entity", "value", tier=A_TIERS, sort=False)
    # a floating mean's last bits depend on summation order: fix 6 digits
    return profile.kpi_summary(hm, "daily_change_pct").withColumn(
        "avg_change", F.round("avg_change", 6)
    )


def q_treemap_rollup(spark, sf_dir):
    hm = profile.heatmap(movers_a(spark, sf_dir), "entity", "value", tier=A_TIERS, sort=False)
    tree = profile.rollup_tree(hm, "entity", "value", "daily_change_pct", root_label="ALL")
    # floating sums: the exact size has 4 decimals; the colour is a ratio
    return tree.withColumns({"size": F.round("size", 4), "color": F.round("color", 6)})


def q_entity_change_stats(spark, sf_dir):
    stats = profile.stats_sentences(profile.change_stats(perf_a(spark, sf_dir), "entity", change_digits=2), "entity")
    return stats.select(
        "entity",
        F.round("avg_change", 6).alias("avg_change"),
        F.round("volatility", 6).alias("volatility"),
        "max_gain",
        "max_loss",
        "summary",
    )


def q_top5_context(spark, sf_dir):
    return context.top_lists(*_heat_and_volatility(spark, sf_dir), "entity")


def _heat_and_volatility(spark, sf_dir):
    perf = written_perf_a(spark, sf_dir)
    return (
        movers.latest_snapshot(perf, "ts"),
        profile.volatility_profile(perf, "entity", risk=A_RISK, sort=False),
    )


def q_context_json(spark, sf_dir):
    return context.currency_context(*_heat_and_volatility(spark, sf_dir), "entity")


def q_order_discount_stats(spark, sf_dir):
    """Statistics per order: many orders have one line, whose deviation is
    NULL and shows as n/a."""
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", (F.col("l_discount") * 100).alias("pct"))
    stats = profile.stats_sentences(profile.change_stats(li, "l_orderkey", "pct", change_digits=2), "l_orderkey")
    return stats.select("l_orderkey", F.round("volatility", 6).alias("volatility"), "max_gain", "max_loss", "summary")


def q_small_value_stats(spark, sf_dir):
    """Means of very small values (1e-12 and below) are not rounded away;
    scaled up again only for the comparison."""
    li = read_table(spark, sf_dir, "lineitem").select("l_suppkey", (F.col("l_discount") * 1e-12).alias("x"))
    stats = profile.change_stats(li, "l_suppkey", "x")
    return stats.select("l_suppkey", *[F.round(F.col(c) * 1e12, 10).alias(c)
                                       for c in ("avg_change", "volatility", "max_gain", "max_loss")])


# ---------------------------------------------------------------- SQL side
SERIES_A_SQL = """
series_a AS (
  SELECT l_suppkey AS entity,
         CAST(date_trunc('month', l_shipdate) AS DATE) AS ts,
         CAST(SUM(CAST(l_extendedprice AS DECIMAL(20,4))) AS DECIMAL(20,4)) AS value
  FROM lineitem GROUP BY 1, 2)"""


def _pct(cur: str, prev: str) -> str:
    return (f"ROUND((CAST({cur} AS DOUBLE) - CAST({prev} AS DOUBLE)) "
            f"/ NULLIF(CAST({prev} AS DOUBLE), 0) * 100, 2)")


def _exact_mean(col: str) -> str:
    """Mean of a 2-digit column as an exact DECIMAL(38,10) (the quotient is
    computed in double, then cast back, which recovers the exact decimal)."""
    return (f"CAST(SUM(CAST({col} AS DECIMAL(38,10))) / NULLIF(COUNT({col}), 0) "
            f"AS DECIMAL(38,10))")


PERF_A_SQL = SERIES_A_SQL + f""",
p1 AS (
  SELECT entity, ts, value, LAG(value, 1) OVER (PARTITION BY entity ORDER BY ts) AS prev_value
  FROM series_a),
p2 AS (
  SELECT *, {_pct('value', 'prev_value')} AS daily_change_pct FROM p1 WHERE prev_value IS NOT NULL),
p3 AS (
  SELECT *, LAG(value, 7) OVER (PARTITION BY entity ORDER BY ts) AS value_lag_7,
            LAG(value, 30) OVER (PARTITION BY entity ORDER BY ts) AS value_lag_30
  FROM p2),
perf_a AS (
  SELECT entity, ts, value, prev_value, daily_change_pct, value_lag_7, value_lag_30,
         {_pct('value', 'value_lag_7')} AS weekly_change_pct,
         {_pct('value', 'value_lag_30')} AS monthly_change_pct
  FROM p3),
movers_a AS (SELECT * FROM perf_a WHERE ts = (SELECT MAX(ts) FROM perf_a))"""

A_TIER_CASE = """CASE WHEN daily_change_pct > 20 THEN '🔥 Forte Alta'
            WHEN daily_change_pct > 10 THEN '⚡ Em Alta'
            WHEN daily_change_pct < -20 THEN '❄️ Forte Baixa'
            WHEN daily_change_pct < -10 THEN '📉 Em Baixa'
            ELSE '➡️ Estável' END"""

VOL_A_SQL = f""",
vol0 AS (
  SELECT entity,
         ROUND(STDDEV_SAMP(CAST(daily_change_pct AS DOUBLE)), 2) AS volatility,
         CAST(ROUND({_exact_mean('daily_change_pct')}, 2) AS DOUBLE) AS avg_change,
         ROUND(MAX(CAST(daily_change_pct AS DOUBLE)), 2) AS max_gain,
         ROUND(MIN(CAST(daily_change_pct AS DOUBLE)), 2) AS max_loss,
         COUNT(*) AS rows_tracked
  FROM perf_a GROUP BY entity),
vol_a AS (
  SELECT *, CASE WHEN volatility > 150 THEN '🔴 Alto'
                 WHEN volatility > 100 THEN '🟡 Médio'
                 ELSE '🟢 Baixo' END AS risk
  FROM vol0)"""


def _with(body: str, tail: str) -> str:
    return f"WITH {body}\n{tail}"


TOP5_SQL = """SELECT * FROM (
  SELECT 'gain' AS list, CAST(ROW_NUMBER() OVER (ORDER BY daily_change_pct DESC NULLS FIRST, entity) AS INTEGER) AS rank,
         entity, daily_change_pct AS metric, CAST(NULL AS VARCHAR) AS risk
  FROM movers_a ORDER BY daily_change_pct DESC NULLS FIRST, entity LIMIT 5)
UNION ALL SELECT * FROM (
  SELECT 'loss', CAST(ROW_NUMBER() OVER (ORDER BY daily_change_pct ASC NULLS FIRST, entity) AS INTEGER),
         entity, daily_change_pct, CAST(NULL AS VARCHAR)
  FROM movers_a ORDER BY daily_change_pct ASC NULLS FIRST, entity LIMIT 5)
UNION ALL SELECT * FROM (
  SELECT 'volatile', CAST(ROW_NUMBER() OVER (ORDER BY volatility DESC NULLS FIRST, entity) AS INTEGER),
         entity, volatility, risk
  FROM vol_a ORDER BY volatility DESC NULLS FIRST, entity LIMIT 5)"""

def _figure(expr: str) -> str:
    return f"coalesce(printf('%.2f%%', CAST({expr} AS DOUBLE)), 'n/a')"


def _sentence(entity: str, mean: str) -> str:
    return (f"CAST({entity} AS VARCHAR) || ': mean daily change ' || {_figure(f'ROUND(CAST({mean} AS DECIMAL(38,10)), 2)')}"
            f" || ', volatility ' || {_figure('volatility')} || ', best day ' || {_figure('max_gain')}"
            f" || ', worst day ' || {_figure('max_loss')} || '.'")


_TIES = "PARTITION BY entity ORDER BY ts NULLS FIRST, value NULLS FIRST, event_id NULLS FIRST"
TIES_SQL = f"""WITH e AS (SELECT event_type AS entity, date_trunc('hour', ts) AS ts, value, event_id FROM events),
p1 AS (SELECT *, LAG(value, 1) OVER ({_TIES}) AS prev_value FROM e),
p2 AS (SELECT *, {_pct('value', 'prev_value')} AS daily_change_pct FROM p1 WHERE prev_value IS NOT NULL),
p3 AS (SELECT *, LAG(value, 7) OVER ({_TIES}) AS value_lag_7, LAG(value, 30) OVER ({_TIES}) AS value_lag_30 FROM p2)
SELECT event_id, entity, CAST(ts AS TIMESTAMP) AS ts, value, prev_value, daily_change_pct, value_lag_7, value_lag_30,
       {_pct('value', 'value_lag_7')} AS weekly_change_pct, {_pct('value', 'value_lag_30')} AS monthly_change_pct
FROM p3"""

ORACLE_SQL: dict[str, str] = {
    "pct_change_daily": _with(SERIES_A_SQL + f""",
p1 AS (SELECT entity, ts, value, LAG(value, 1) OVER (PARTITION BY entity ORDER BY ts) AS prev_value
       FROM series_a)""", f"""SELECT entity, ts, value, prev_value, {_pct('value', 'prev_value')} AS daily_change_pct
FROM p1 WHERE prev_value IS NOT NULL"""),
    "pct_change_multi_lag": _with(PERF_A_SQL, "SELECT * FROM perf_a"),
    "pct_change_indexed": _with(PERF_A_SQL, "SELECT * FROM perf_a"),
    "pct_change_auto": _with(PERF_A_SQL, "SELECT * FROM perf_a"),
    "latest_snapshot": _with(PERF_A_SQL, "SELECT * FROM movers_a"),
    "entity_history": _with(SERIES_A_SQL, "SELECT * FROM series_a WHERE entity = 1"),
    "top_gainers": _with(PERF_A_SQL, """SELECT CAST(ROW_NUMBER() OVER (ORDER BY daily_change_pct DESC NULLS FIRST, entity) AS INTEGER) AS rank,
       entity, value, daily_change_pct
FROM movers_a ORDER BY daily_change_pct DESC NULLS FIRST, entity LIMIT 10"""),
    "top_losers": _with(PERF_A_SQL, """SELECT CAST(ROW_NUMBER() OVER (ORDER BY daily_change_pct ASC NULLS FIRST, entity) AS INTEGER) AS rank,
       entity, value, daily_change_pct
FROM movers_a ORDER BY daily_change_pct ASC NULLS FIRST, entity LIMIT 10"""),
    "heatmap_tiers": _with(PERF_A_SQL, f"""SELECT entity, value, daily_change_pct, weekly_change_pct, monthly_change_pct,
       {A_TIER_CASE} AS performance_tier
FROM movers_a"""),
    "volatility_profile": _with(PERF_A_SQL + VOL_A_SQL, "SELECT * FROM vol_a"),
    "risk_filter": _with(PERF_A_SQL + VOL_A_SQL,
                         "SELECT * FROM vol_a WHERE risk IN ('🔴 Alto', '🟡 Médio')"),
    "kpi_summary": _with(PERF_A_SQL, f"""SELECT COUNT(*) AS entities,
       ROUND(CAST({_exact_mean('daily_change_pct')} AS DOUBLE), 6) AS avg_change,
       MAX(daily_change_pct) AS max_gain, MIN(daily_change_pct) AS max_loss,
       printf('%.2f%%', ROUND({_exact_mean('daily_change_pct')}, 2)) AS avg_change_text,
       printf('%.2f%%', MAX(daily_change_pct)) AS max_gain_text,
       printf('%.2f%%', MIN(daily_change_pct)) AS max_loss_text
FROM movers_a"""),
    "treemap_rollup": _with(PERF_A_SQL, """SELECT CASE WHEN GROUPING(entity) = 1 THEN 'ALL' ELSE CAST(entity AS VARCHAR) END AS node,
       CASE WHEN GROUPING(entity) = 1 THEN NULL ELSE 'ALL' END AS parent,
       CASE WHEN GROUPING(entity) = 1 THEN 0 ELSE 1 END AS depth,
       ROUND(CAST(SUM(value) AS DOUBLE), 4) AS size,
       ROUND(SUM(CAST(value AS DOUBLE) * daily_change_pct)
         / NULLIF(SUM(CASE WHEN daily_change_pct IS NOT NULL THEN CAST(value AS DOUBLE) END), 0), 6) AS color
FROM movers_a GROUP BY ROLLUP (entity)"""),
    "entity_change_stats": _with(PERF_A_SQL + f""",
st AS (SELECT entity, CAST({_exact_mean('daily_change_pct')} AS DOUBLE) AS avg_change,
              STDDEV_SAMP(CAST(daily_change_pct AS DOUBLE)) AS volatility,
              MAX(CAST(daily_change_pct AS DOUBLE)) AS max_gain,
              MIN(CAST(daily_change_pct AS DOUBLE)) AS max_loss
       FROM perf_a GROUP BY entity)""", """SELECT entity, ROUND(avg_change, 6) AS avg_change, ROUND(volatility, 6) AS volatility, max_gain, max_loss,
       """ + _sentence("entity", "avg_change") + """ AS summary
FROM st"""),
    "order_discount_stats": f"""WITH st AS (
  SELECT l_orderkey, {_exact_mean("x")} AS avg_change, STDDEV_SAMP(x) AS volatility, MAX(x) AS max_gain, MIN(x) AS max_loss
  FROM (SELECT l_orderkey, l_discount * 100 AS x FROM lineitem) GROUP BY 1)
SELECT l_orderkey, ROUND(volatility, 6) AS volatility, max_gain, max_loss,
       {_sentence("l_orderkey", "avg_change")} AS summary FROM st""",
    "small_value_stats": """SELECT l_suppkey, ROUND(AVG(l_discount), 10) AS avg_change, ROUND(STDDEV_SAMP(l_discount), 10) AS volatility,
       MAX(l_discount) AS max_gain, MIN(l_discount) AS max_loss FROM lineitem GROUP BY 1""",
    "pct_change_ties_window": TIES_SQL,
    "pct_change_ties_indexed": TIES_SQL,

    "top5_context": _with(PERF_A_SQL + VOL_A_SQL, TOP5_SQL),
}

def _json_list(label: str, fields: str) -> str:
    return f"(SELECT to_json(list({{{fields}}} ORDER BY rank)) FROM lists WHERE list = '{label}')"


ORACLE_SQL["context_json"] = _with(
    PERF_A_SQL + VOL_A_SQL + ",\nlists AS (" + TOP5_SQL + ")",
    "SELECT g AS gain_json, l AS loss_json, v AS volatile_json,\n"
    "       'Largest gains: ' || g || chr(10) || 'Largest losses: ' || l || chr(10) || 'Most volatile: ' || v || chr(10) AS context\n"
    "FROM (SELECT " + _json_list("gain", "'entity': entity, 'daily_change_pct': metric") + " AS g, "
    + _json_list("loss", "'entity': entity, 'daily_change_pct': metric") + " AS l, "
    + _json_list("volatile", "'entity': entity, 'volatility': metric, 'risk': risk") + " AS v)",
)

QUERIES: dict[str, QueryFn] = {
    "pct_change_daily": q_pct_change_daily,
    "pct_change_multi_lag": q_pct_change_multi_lag,
    "pct_change_indexed": q_pct_change_indexed,
    "pct_change_auto": q_pct_change_auto,
    "pct_change_ties_window": q_pct_change_ties_window,
    "pct_change_ties_indexed": q_pct_change_ties_indexed,
    "order_discount_stats": q_order_discount_stats,
    "small_value_stats": q_small_value_stats,
    "latest_snapshot": q_latest_snapshot,
    "entity_history": q_entity_history,
    "top_gainers": q_top_gainers,
    "top_losers": q_top_losers,
    "heatmap_tiers": q_heatmap_tiers,
    "volatility_profile": q_volatility_profile,
    "risk_filter": q_risk_filter,
    "kpi_summary": q_kpi_summary,
    "treemap_rollup": q_treemap_rollup,
    "entity_change_stats": q_entity_change_stats,
    "top5_context": q_top5_context,
    "context_json": q_context_json,
}


def _merge() -> None:
    from tidemark.plans import catalog_io, catalog_model, catalog_trend

    for part in (catalog_io, catalog_model, catalog_trend):
        QUERIES.update(part.QUERIES)
        ORACLE_SQL.update(part._oracle())


_merge()
