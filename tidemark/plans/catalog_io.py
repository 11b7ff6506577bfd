"""Catalog part 2: reshaping, typing, hashing, ingestion and round trips."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.hashing import content_hash
from tidemark.functions.numeric import to_money
from tidemark.functions.timeparse import format_rfc2822, parse_rfc2822
from tidemark.operators import ingest, reshape
from tidemark.plans.series_sources import snapshot_payloads, supplier_month_series
from tidemark.session import materialize, scratch_path
from tidemark.sources.snapshots import (
    RAW_SCHEMA, dated_snapshot_path, from_variants, land_snapshots, read_snapshots, read_variants, snapshot_days,
)
from tidemark.sources.tables import (
    bucketed_name, max_from_statistics, read_gold, read_table, write_bucketed, write_overwrite,
)

EVENT_HASH_COLS = ["event_id", "ts", "user_id", "event_type", "money", "props"]
# The sink of the anti-join query holds the events loaded before this time.
LOADED_BEFORE = "2024-01-16 00:00:00"


def _events(spark, sf_dir):
    return read_table(spark, sf_dir, "events")


def hashed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _events(spark, sf_dir).withColumn("money", to_money("value"))
    return ev.select(
        "event_id",
        F.to_date("ts").alias("event_date"),
        content_hash(EVENT_HASH_COLS, ev).alias("hash_diff"),
        "ts",
    )


def q_json_map_explode(spark, sf_dir):
    ev = _events(spark, sf_dir).select("event_id", "props")
    return reshape.json_map_rows(ev, "props", "double", "prop_key", "prop_value")


def broken_props(spark, sf_dir) -> DataFrame:
    """Events whose JSON is damaged for a fixed share of ids: a member that is
    a text where a number belongs, and documents that are cut off."""
    ev = _events(spark, sf_dir).select("event_id", "props")
    text = F.regexp_replace("props", r"[0-9.]+\}", '"n/a", "ok": 5}')
    cut = F.expr("substring(props, 1, char_length(props) - 2)")
    return ev.withColumn(
        "props", F.when(F.col("event_id") % 10 == 3, text).when(F.col("event_id") % 17 == 5, cut).otherwise(F.col("props"))
    )


def q_json_checked_members(spark, sf_dir):
    """Every valid member stays, every bad member and document is reported."""
    rows = reshape.json_map_checked(broken_props(spark, sf_dir), "props", "double", "prop_key", "prop_value")
    return rows.select("event_id", "prop_key", "prop_value", "rejected")


def q_json_rejected_count(spark, sf_dir):
    rows = reshape.json_map_checked(broken_props(spark, sf_dir), "props", "double", "prop_key", "prop_value")
    return rows.agg(
        F.count_if(~F.col("rejected")).alias("valid"),
        F.count_if(F.col("rejected") & F.col("prop_key").isNotNull()).alias("bad_members"),
        F.count_if(F.col("rejected") & F.col("prop_key").isNull()).alias("bad_documents"),
    )


def q_lineitem_row_keys(spark, sf_dir):
    """As many keys as different tuples: numbers whose digits run together
    (12, 3 and 1, 23) give different keys."""
    li = read_table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_quantity")
    keyed = li.select("*", content_hash(["l_partkey", "l_suppkey", "l_quantity"], li).alias("row_key"))
    return keyed.groupBy("row_key").agg(
        F.countDistinct("l_partkey", "l_suppkey", "l_quantity").alias("tuples"), F.count(F.lit(1)).alias("rows_n")
    )


def q_load_time(spark, sf_dir):
    """The load timestamp column: there for every row, one value."""
    rows = reshape.with_load_time(_events(spark, sf_dir).select("event_id", "event_type"))
    return rows.groupBy("event_type").agg(
        F.count("load_date_src").alias("stamped"), F.count_distinct("load_date_src").alias("load_times")
    )


def q_first_row_guard(spark, sf_dir):
    """Emptiness test and first row: a type of event is worth loading only if
    it has rows; its first event tells the schema's values."""
    ev = _events(spark, sf_dir)
    none = ingest.has_rows(ev.where(F.col("event_id") < 0))
    some = ingest.has_rows(ev)
    first = ev.orderBy("event_id").limit(1).select("event_id", "event_type")
    return first.select("*", F.lit(some).alias("has_rows"), F.lit(none).alias("empty_has_rows"))


def q_compressed_roundtrip(spark, sf_dir):
    """The snappy option of the overwrite sink, read back."""
    path = scratch_path(spark, "snappy")
    write_overwrite(read_table(spark, sf_dir, "orders"), path, compression="snappy")
    return spark.read.parquet(path).select("o_orderkey", "o_custkey", "o_totalprice")


def q_unpivot_measures(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    ids = ["l_orderkey", "l_linenumber"]
    wide = li.select(*ids, "l_quantity", "l_extendedprice", "l_discount", "l_tax")
    return reshape.unpivot_wide(wide, ids, reshape.columns_except(wide, ids), "measure", "amount")


def q_not_null_filter(spark, sf_dir):
    from tidemark.plans.catalog import perf_a

    return perf_a(spark, sf_dir).where(F.col("monthly_change_pct").isNotNull()).select(
        "entity", "ts", "monthly_change_pct"
    )


def q_projection_alias(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    return reshape.project(o, {
        "order_id": "o_orderkey",
        "customer_id": "o_custkey",
        "status": "o_orderstatus",
        "total_price": "o_totalprice",
    })


def q_lineage_constants(spark, sf_dir):
    ev = _events(spark, sf_dir).select("event_id", "event_type")
    return reshape.with_constants(ev, {"type_src": "parquet", "system_src": "events"})


def q_rfc2822_parse(spark, sf_dir):
    ev = _events(spark, sf_dir).select("event_id", "ts", "props")
    txt = ev.withColumn("ts_text", format_rfc2822("ts"))
    return txt.select(
        "event_id",
        "ts_text",
        parse_rfc2822("ts_text").alias("parsed"),
        parse_rfc2822("props").alias("unparsable"),
    )


def q_decimal_cast(spark, sf_dir):
    ev = _events(spark, sf_dir)
    money = to_money("value")
    return ev.select(
        "event_id",
        money.alias("money"),
        to_money(F.col("value") * F.lit(1.23456)).alias("scaled"),
        money.cast("double").alias("back"),
        F.round(F.col("value") / F.lit(3.0), 2).alias("third"),
    )


def q_content_hash(spark, sf_dir):
    ev = _events(spark, sf_dir).withColumn("money", to_money("value"))
    return ev.select(
        "event_id",
        content_hash(EVENT_HASH_COLS, ev, sep="").alias("hash_diff"),
        content_hash(EVENT_HASH_COLS, ev).alias("hash_key"),
    )


def q_anti_join_new(spark, sf_dir):
    batch = hashed_events(spark, sf_dir)
    loaded = batch.where(F.col("ts") < F.lit(LOADED_BEFORE).cast("timestamp_ntz"))
    # the hash covers the time, so it determines the date
    return ingest.new_records(batch, loaded, ["hash_diff"], "event_date", key_fixes_partition=True).select(
        "event_id", "event_date", "hash_diff"
    )


def q_anti_join_cross_partition(spark, sf_dir):
    """Events redelivered under the next date: the key alone decides, so the
    partitions of the batch don't limit what it is compared with."""
    batch = hashed_events(spark, sf_dir)
    loaded = batch.where(F.col("ts") < F.lit(LOADED_BEFORE).cast("timestamp_ntz"))
    again = batch.withColumn("event_date", F.date_add("event_date", 1))
    return ingest.new_records(again, loaded, ["event_id"], "event_date").select("event_id", "event_date")


def q_anti_join_bucketed(spark, sf_dir):
    """The comparison with a sink that is bucketed by the key: no exchange of it."""
    batch = hashed_events(spark, sf_dir)
    loaded = batch.where(F.col("ts") < F.lit(LOADED_BEFORE).cast("timestamp_ntz")).select("hash_diff")
    table = bucketed_name()
    write_bucketed(loaded, table, ["hash_diff"], 8, scratch_path(spark, "bucketed"))
    return ingest.new_records_bucketed(batch, table).select("event_id", "event_date", "hash_diff")


def q_append_two_writers(spark, sf_dir):
    """Two jobs append overlapping batches at the same time: every event once."""
    from concurrent.futures import ThreadPoolExecutor

    path = scratch_path(spark, "append")
    ev = materialize(hashed_events(spark, sf_dir))
    halves = [ev.where(F.col("event_id") % 3 != r) for r in (0, 1)] + [ev]

    def append(batch):
        ingest.append_new_shared(spark, batch, path, ["hash_diff"], "event_date", key_fixes_partition=True)

    with ThreadPoolExecutor(len(halves)) as pool:
        list(pool.map(append, halves))
    return spark.read.parquet(path).select("event_id", "event_date", "hash_diff")


def q_latest_from_statistics(spark, sf_dir):
    """The latest snapshot, whose day comes from the files' statistics."""
    path = scratch_path(spark, "series")
    supplier_month_series(spark, sf_dir).write.parquet(path)
    latest = max_from_statistics(spark, path, "ts")
    return spark.read.parquet(path).where(F.col("ts") == F.lit(latest))


def q_intra_batch_dedupe(spark, sf_dir):
    ev = hashed_events(spark, sf_dir)
    twice = ev.unionByName(ev)
    return ingest.dedupe_batch(twice, ["hash_diff"]).select("event_id", "event_date", "hash_diff")


def q_append_roundtrip(spark, sf_dir):
    """Two appends into one sink: the earlier load, then everything (the
    earlier rows again included).  Read back: every event once."""
    path = scratch_path(spark, "append")
    ev = hashed_events(spark, sf_dir)
    first = ev.where(F.col("ts") < F.lit(LOADED_BEFORE).cast("timestamp_ntz"))
    for batch in (first, ev):
        ingest.append_new(spark, batch, path, ["hash_diff"], "event_date", key_fixes_partition=True)
    return spark.read.parquet(path).select("event_id", "event_date", "hash_diff")


def q_overwrite_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "overwrite")
    s = supplier_month_series(spark, sf_dir)
    # an earlier table with other rows: all of them have to go
    write_overwrite(s.withColumns({"entity": -F.col("entity"), "value": F.col("value") + 1}), path)
    write_overwrite(s, path)
    return spark.read.parquet(path)


def q_overwrite_partitioned(spark, sf_dir):
    """A replaced table has none of its old partitions left."""
    path = scratch_path(spark, "overwrite")
    ev = hashed_events(spark, sf_dir).select("event_id", "event_date")
    write_overwrite(ev, path, partition_by=["event_date"])
    late = ev.where(F.col("event_date") >= F.lit(LOADED_BEFORE).cast("date"))
    write_overwrite(late, path, partition_by=["event_date"])
    return spark.read.parquet(path).select("event_id", "event_date")


# Codes in a document that has a file of its own: under 1 MB.
FILE_CODES = 20_000


def _payloads(spark, sf_dir, codes: int = 500) -> DataFrame:
    """Snapshot documents of series A, about ``codes`` suppliers each (the
    supplier table's row count comes from its file metadata)."""
    documents = max(1, -(-read_table(spark, sf_dir, "supplier").count() // codes))
    return snapshot_payloads(supplier_month_series(spark, sf_dir), documents=documents)


def _landed(spark, sf_dir, rerun: bool = True, redeliver: bool = False) -> str:
    """Land series-A snapshots as raw JSON by ingest date.

    ``rerun``: run the landing again (the re-run replaces the same days and
    leaves the others).  ``redeliver``: every snapshot is delivered a second
    time under the following day, landed with the first delivery in one
    write (the two branches share the series' shuffle)."""
    path = scratch_path(spark, "raw")
    payloads = _payloads(spark, sf_dir)
    if rerun:  # landed twice: lineitem is read once
        payloads = materialize(payloads)
    first = payloads
    if redeliver:
        first = payloads.unionByName(
            payloads.withColumn("ingest_date", F.date_add("ingest_date", 1))
        )
    land_snapshots(first, path)
    if rerun:
        land_snapshots(payloads, path)
    return path


def q_raw_landing(spark, sf_dir):
    path = _landed(spark, sf_dir)
    return _rates(read_snapshots(spark, path, multiline=False))


def q_multiline_landing(spark, sf_dir):
    """Pretty-printed documents, one per file, read in multi-line mode."""
    path = scratch_path(spark, "raw")
    docs = _payloads(spark, sf_dir, FILE_CODES)
    text = F.to_json(F.struct(*[c for c in docs.columns if c != "ingest_date"]), {"pretty": "true"})
    files = docs.select(text.alias("value"), F.col("ingest_date").alias("month")).write.option("maxRecordsPerFile", 1)
    files.partitionBy("month").text(path)
    return _rates(read_snapshots(spark, path, multiline=True))


def _rates(raw: DataFrame) -> DataFrame:
    return reshape.explode_map(raw, "conversion_rates", "code", "rate", keep=["time_last_update_utc"]).select(
        "code", parse_rfc2822("time_last_update_utc").alias("ts"), F.col("rate").cast("double").alias("rate")
    )


def q_variant_landing(spark, sf_dir):
    """Documents with a field that the fixed schema does not know, landed as
    VARIANT: the field comes back beside the known ones."""
    path, table = scratch_path(spark, "raw"), scratch_path(spark, "variants")
    month = F.month("ingest_date")
    drifted = _payloads(spark, sf_dir).withColumn(
        "meta", F.when(month > 6, F.struct(F.lit("second").alias("half"), month.alias("month"))))
    land_snapshots(drifted, path)
    read_variants(spark, path, multiline=False).write.parquet(table)
    raw = from_variants(spark.read.parquet(table), {"meta.half": "string", "meta.month": "int"})
    rates = reshape.explode_map(raw, "conversion_rates", "code", "rate", keep=["time_last_update_utc", "meta_half", "meta_month"])
    return rates.select(
        "code", parse_rfc2822("time_last_update_utc").alias("ts"), F.col("rate").cast("double").alias("rate"),
        F.col("meta_half").alias("half"), F.col("meta_month").alias("month"),
    )


def q_struct_unnest(spark, sf_dir):
    """Documents whose rates are a struct, one field for each of the 25 nations
    (order totals by month): unnested and turned into rows on the way to silver."""
    from pyspark.sql import types as T

    from tidemark.plans.silver import to_silver

    orders, customer, nation = (read_table(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    joined = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    series = joined.groupBy(F.col("n_name").alias("entity"), F.trunc(F.to_date("o_orderdate"), "month").alias("ts")).agg(
        to_money(F.sum(to_money("o_totalprice"))).alias("value"))
    path = scratch_path(spark, "raw")
    land_snapshots(snapshot_payloads(series, documents=1), path)
    names = [r[0] for r in nation.select("n_name").orderBy("n_name").collect()]  # 25 rows at every scale
    rates = T.StructType([T.StructField(n, T.StringType()) for n in names])
    schema = T.StructType([T.StructField(f.name, rates) if f.name == "conversion_rates" else f for f in RAW_SCHEMA.fields])
    raw = spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    return to_silver(raw).select("code_exchange_rate", "snapshot_date", "exchange_rate")


def q_dated_snapshot(spark, sf_dir):
    """One day's documents under its dated path; a run for that day reads
    only them."""
    root = scratch_path(spark, "dated")
    payloads = materialize(_payloads(spark, sf_dir))
    for day in snapshot_days(payloads.where("time_last_update_utc like '%1995%'")):
        one = payloads.where(F.col("ingest_date") == F.lit(day)).drop("ingest_date")
        one.write.json(dated_snapshot_path(root, day))
    return _rates(read_snapshots(spark, dated_snapshot_path(root, "1995-03-01"), multiline=False))


SILVER_OUT = ["code_exchange_rate", "time_last_update_utc", "exchange_rate", "hash_diff", "snapshot_date"]


def q_stream_ingest(spark, sf_dir):
    from tidemark.streaming.ingest import stream_silver

    raw = _landed(spark, sf_dir, rerun=False, redeliver=True)
    silver = scratch_path(spark, "silver")
    stream_silver(spark, raw, silver, scratch_path(spark, "ckpt"), multiline=False,
                  max_files_per_trigger=60)
    return spark.read.parquet(silver).select(*SILVER_OUT)


def _stream_dedupe(spark, sf_dir, **kw):
    from tidemark.streaming.ingest import stream_silver_dedupe

    raw = _landed(spark, sf_dir, rerun=False, redeliver=True)
    silver = scratch_path(spark, "silver")
    stream_silver_dedupe(spark, raw, silver, scratch_path(spark, "ckpt"), multiline=False, **kw)
    return spark.read.parquet(silver).select(*SILVER_OUT)


def q_stream_dedupe(spark, sf_dir):
    """UNBOUNDED state (every hash is kept); for small sources."""
    return _stream_dedupe(spark, sf_dir)


def q_stream_dedupe_watermark(spark, sf_dir):
    """Bounded state: hashes are kept for 62 days after their snapshot.  All
    files are one micro-batch here, so no delivery is later than that."""
    return _stream_dedupe(spark, sf_dir, watermark="62 days")


def q_stream_dedupe_bounded(spark, sf_dir):
    """Several micro-batches; everything is delivered again after the state has
    let go of it, and every row is there once."""
    import time

    from tidemark.streaming.ingest import stream_silver_bounded

    payloads = materialize(_payloads(spark, sf_dir))
    raw, silver, ckpt = (scratch_path(spark, n) for n in ("raw", "silver", "ckpt"))
    early = F.col("ingest_date") < F.lit("1995-01-01").cast("date")
    again = payloads.withColumn("ingest_date", F.date_add("ingest_date", 1))
    for part in (payloads.where(early), payloads.where(~early), again):
        land_snapshots(part, raw)
        stream_silver_bounded(spark, raw, silver, ckpt, delay="1 second", multiline=False, max_files_per_trigger=60)
        time.sleep(1.1)  # longer than the delay
    return spark.read.parquet(silver).select(*SILVER_OUT)


def q_stream_performance(spark, sf_dir):
    """Lags from state: the months before 1996 arrive in one run of the stream,
    the others in the next; equals the batch frame."""
    from tidemark.streaming.lags import stream_performance

    payloads = materialize(_payloads(spark, sf_dir))
    raw, perf, late, ckpt = (scratch_path(spark, n) for n in ("raw", "performance", "late", "ckpt"))
    early = F.col("ingest_date") < F.lit("1996-01-01").cast("date")
    for part in (early, ~early):
        land_snapshots(payloads.where(part), raw)
        stream_performance(spark, raw, perf, late, ckpt, multiline=False)
    rows = spark.read.parquet(perf)
    return rows.select(
        "code_exchange_rate", F.to_date("time_last_update_utc").alias("snapshot_date"), "exchange_rate", "prev_value",
        "daily_change_pct", "value_lag_7", "value_lag_30", "weekly_change_pct", "monthly_change_pct",
    )


def _gold(spark, sf_dir, name):
    """Raw landing -> silver -> gold, then one of the tables."""
    from tidemark.plans.catalog import A_RISK, A_TIERS
    from tidemark.plans.pipeline import run_pipeline

    raw = _landed(spark, sf_dir, rerun=False, redeliver=True)
    silver, gold = scratch_path(spark, "silver"), scratch_path(spark, "gold")
    return run_pipeline(spark, raw, silver, gold, multiline=False, tiers=A_TIERS, risk=A_RISK)[name]


def q_gold_heatmap(spark, sf_dir):
    return _gold(spark, sf_dir, "currency_heatmap")


def q_gold_top_gainers(spark, sf_dir):
    return _gold(spark, sf_dir, "top_gainers")


def q_gold_top_losers(spark, sf_dir):
    return _gold(spark, sf_dir, "top_losers")


def q_gold_volatility(spark, sf_dir):
    return _gold(spark, sf_dir, "volatility_exchange_rates")


def q_gold_named_readers(spark, sf_dir):
    """The gold tables by their names, as views: tier and risk side by side."""
    from tidemark.plans.catalog import A_RISK, A_TIERS
    from tidemark.plans.pipeline import run_pipeline

    silver, gold = scratch_path(spark, "silver"), scratch_path(spark, "gold")
    run_pipeline(spark, _landed(spark, sf_dir, rerun=False), silver, gold, multiline=False, tiers=A_TIERS, risk=A_RISK)
    read_gold(spark, gold)
    return spark.sql("""SELECT code_exchange_rate, performance_tier, risk_score, g.rank AS gain_rank, l.rank AS loss_rank
        FROM currency_heatmap JOIN volatility_exchange_rates USING (code_exchange_rate)
        LEFT JOIN top_gainers g USING (code_exchange_rate) LEFT JOIN top_losers l USING (code_exchange_rate)""")


def _gold_in_parts(spark, sf_dir, second_ends: bool = False) -> DataFrame:
    """Performance after three runs: the months before 1996 but one, then the
    later months (on time), then the month left out (late).  ``second_ends``:
    the second run ends when it has worked out what changes and published none
    of it; the third finishes that."""
    from tidemark.plans import gold as G
    from tidemark.plans.catalog import A_RISK, A_TIERS
    from tidemark.plans.silver import write_silver

    payloads = materialize(_payloads(spark, sf_dir).withColumn(
        "conversion_rates", F.transform_values("conversion_rates", lambda _, v: v.cast("string"))))
    silver, gold = scratch_path(spark, "silver"), scratch_path(spark, "gold")
    month = F.col("ingest_date")
    late = month == F.lit("1995-03-01").cast("date")
    parts = [(month < F.lit("1996-01-01").cast("date")) & ~late, month >= F.lit("1996-01-01").cast("date"), late]
    for i, part in enumerate(parts):
        batch = payloads.where(part)
        days = snapshot_days(batch)
        write_silver(batch, silver)
        if i == 0:
            G.run_gold(spark, silver, gold, tiers=A_TIERS, risk=A_RISK)
        elif i == 1 and second_ends:
            G.note_due(spark, gold, days)
            G.stage(spark, silver, gold, days)
        else:
            G.run_gold_incremental(spark, silver, gold, days, tiers=A_TIERS, risk=A_RISK)
    return read_table(spark, gold, "performance").select(
        "code_exchange_rate", "snapshot_date", "exchange_rate", "prev_value", "daily_change_pct",
        "value_lag_7", "value_lag_30", "weekly_change_pct", "monthly_change_pct",
    )


def q_gold_incremental(spark, sf_dir):
    """Performance equals the full recompute."""
    return _gold_in_parts(spark, sf_dir)


def q_gold_resumed(spark, sf_dir):
    """The same after a run that ended halfway."""
    return _gold_in_parts(spark, sf_dir, second_ends=True)


def q_volatility_incremental(spark, sf_dir):
    """The volatility profile from a moments table that got the performance
    rows in three batches of months; equals that of all rows."""
    from tidemark.operators import state
    from tidemark.plans.catalog import A_RISK, written_perf_a

    perf = written_perf_a(spark, sf_dir)
    year = F.year("ts")
    table = None
    for part in (year < 1994, (year >= 1994) & (year < 1997), year >= 1997):
        batch = state.moments(perf.where(part), "entity")
        table = materialize(batch if table is None else state.merge(table, batch, "entity"))
    return state.volatility_from_moments(table, "entity", risk=A_RISK)


_EV_TEXTS = ["CAST(event_id AS VARCHAR)", "strftime(ts, '%Y-%m-%d %H:%M:%S.%f')", "CAST(user_id AS VARCHAR)", "event_type",
             "CAST(CAST(value AS DECIMAL(20,4)) AS VARCHAR)", "props"]


def _key_sql(texts: list[str]) -> str:
    """The unambiguous row key: every text behind its length, NULL as n."""
    return "sha256(" + " || ".join(f"coalesce(length({t})::VARCHAR || ':' || {t}, 'n')" for t in texts) + ")"


_EV_HASH_TEXT = ", ".join(f"coalesce({t}, '')" for t in _EV_TEXTS)

HASHED_EVENTS_SQL = f"""hashed AS (
  SELECT event_id, CAST(ts AS DATE) AS event_date, ts, {_key_sql(_EV_TEXTS)} AS hash_diff
  FROM events)"""

# silver rows the landing -> silver path must produce from series A
SILVER_A_SQL = """WITH s AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS code_exchange_rate,
         CAST(date_trunc('month', l_shipdate) AS TIMESTAMP) AS time_last_update_utc,
         CAST(SUM(CAST(l_extendedprice AS DECIMAL(20,4))) AS DECIMAL(20,4)) AS exchange_rate
  FROM lineitem GROUP BY 1, 2)
SELECT code_exchange_rate, time_last_update_utc, exchange_rate,
       """ + _key_sql([
    "'success'", "'https://quotes.example.org/docs'", "'https://quotes.example.org/terms'",
    "CAST(epoch(time_last_update_utc) AS BIGINT)::VARCHAR", "strftime(time_last_update_utc, '%Y-%m-%d %H:%M:%S.%f')",
    "CAST(epoch(time_last_update_utc + INTERVAL 1 MONTH) AS BIGINT)::VARCHAR",
    "strftime(time_last_update_utc + INTERVAL 1 MONTH, '%Y-%m-%d %H:%M:%S.%f')",
    "'SUP'", "code_exchange_rate", "CAST(exchange_rate AS VARCHAR)", "'api'", "'exchangerate-api'",
]) + """ AS hash_diff,
       CAST(time_last_update_utc AS DATE) AS snapshot_date
FROM s"""

RATES_SQL = """SELECT CAST(l_suppkey AS VARCHAR) AS code,
       CAST(date_trunc('month', l_shipdate) AS TIMESTAMP) AS ts,
       CAST(CAST(SUM(CAST(l_extendedprice AS DECIMAL(20,4))) AS DECIMAL(20,4)) AS DOUBLE) AS rate
FROM lineitem GROUP BY 1, 2"""

CHECKED_SQL = r"""WITH e AS (SELECT event_id, CASE WHEN event_id % 10 = 3 THEN regexp_replace(props, '[0-9.]+\}', '"n/a", "ok": 5}', 'g')
    WHEN event_id % 17 = 5 THEN left(props, length(props) - 2) ELSE props END AS props FROM events),
m AS (SELECT event_id, k, json_extract_string(props, '$."' || k || '"') AS t
    FROM (SELECT event_id, props, unnest(json_keys(props)) AS k FROM e WHERE json_valid(props))),
rows AS (SELECT event_id, k AS prop_key, TRY_CAST(t AS DOUBLE) AS prop_value, t IS NOT NULL AND TRY_CAST(t AS DOUBLE) IS NULL AS rejected FROM m
    UNION ALL SELECT event_id, NULL, NULL, true FROM e WHERE NOT json_valid(props))
"""


def _oracle() -> dict[str, str]:
    from tidemark.plans.catalog import A_TIER_CASE, PERF_A_SQL, SERIES_A_SQL, VOL_A_SQL

    incremental = f"""WITH {PERF_A_SQL}
SELECT CAST(entity AS VARCHAR) AS code_exchange_rate, ts AS snapshot_date, value AS exchange_rate, prev_value, daily_change_pct,
       value_lag_7, value_lag_30, weekly_change_pct, monthly_change_pct FROM perf_a"""
    return {
        "json_map_explode": """SELECT event_id, k AS prop_key,
       CAST(json_extract(props, '$."' || k || '"') AS DOUBLE) AS prop_value
FROM (SELECT event_id, props, unnest(json_keys(props)) AS k FROM events)""",
        "unpivot_measures": """UNPIVOT (SELECT l_orderkey, l_linenumber, CAST(l_quantity AS DOUBLE) AS l_quantity,
                l_extendedprice, l_discount, l_tax FROM lineitem)
ON l_quantity, l_extendedprice, l_discount, l_tax INTO NAME measure VALUE amount""",
        "not_null_filter": f"WITH {PERF_A_SQL}\nSELECT entity, ts, monthly_change_pct FROM perf_a "
                           "WHERE monthly_change_pct IS NOT NULL",
        "projection_alias": """SELECT o_orderkey AS order_id, o_custkey AS customer_id,
       o_orderstatus AS status, o_totalprice AS total_price FROM orders""",
        "lineage_constants": """SELECT event_id, event_type, 'parquet' AS type_src, 'events' AS system_src
FROM events""",
        "rfc2822_parse": """SELECT event_id, strftime(ts, '%a, %d %b %Y %H:%M:%S +0000') AS ts_text,
       date_trunc('second', ts) AS parsed, CAST(NULL AS TIMESTAMP) AS unparsable
FROM events""",
        "decimal_cast": """SELECT event_id, CAST(value AS DECIMAL(20,4)) AS money,
       CAST(value * 1.23456 AS DECIMAL(20,4)) AS scaled,
       CAST(CAST(value AS DECIMAL(20,4)) AS DOUBLE) AS back,
       ROUND(value / 3.0, 2) AS third
FROM events""",
        "content_hash": f"""SELECT event_id, sha256(concat_ws('', {_EV_HASH_TEXT})) AS hash_diff,
       {_key_sql(_EV_TEXTS)} AS hash_key
FROM events""",
        "anti_join_new": f"""WITH {HASHED_EVENTS_SQL}
SELECT event_id, event_date, hash_diff FROM hashed
WHERE hash_diff NOT IN (SELECT hash_diff FROM hashed WHERE ts < TIMESTAMP '{LOADED_BEFORE}')""",
        "intra_batch_dedupe": f"""WITH {HASHED_EVENTS_SQL}
SELECT DISTINCT event_id, event_date, hash_diff FROM (SELECT * FROM hashed UNION ALL SELECT * FROM hashed)""",
        "append_roundtrip": f"""WITH {HASHED_EVENTS_SQL}
SELECT event_id, event_date, hash_diff FROM hashed""",
        "overwrite_roundtrip": f"WITH {SERIES_A_SQL}\nSELECT * FROM series_a",
        "raw_landing": RATES_SQL,
        "multiline_landing": RATES_SQL,
        "dated_snapshot": f"SELECT * FROM ({RATES_SQL}) WHERE ts = TIMESTAMP '1995-03-01'",
        "json_checked_members": CHECKED_SQL + "SELECT * FROM rows",
        "json_rejected_count": CHECKED_SQL + """SELECT count(*) FILTER (NOT rejected) AS valid,
       count(*) FILTER (rejected AND prop_key IS NOT NULL) AS bad_members,
       count(*) FILTER (rejected AND prop_key IS NULL) AS bad_documents FROM rows""",
        "lineitem_row_keys": f"""SELECT {_key_sql([f"CAST({c} AS VARCHAR)" for c in ("l_partkey", "l_suppkey", "l_quantity")])} AS row_key,
       CAST(1 AS BIGINT) AS tuples, count(*) AS rows_n FROM lineitem GROUP BY l_partkey, l_suppkey, l_quantity""",
        "load_time": "SELECT event_type, count(*) AS stamped, CAST(1 AS BIGINT) AS load_times FROM events GROUP BY 1",
        "first_row_guard": """SELECT event_id, event_type, true AS has_rows, false AS empty_has_rows
FROM events ORDER BY event_id LIMIT 1""",
        "compressed_roundtrip": "SELECT o_orderkey, o_custkey, o_totalprice FROM orders",
        "anti_join_cross_partition": f"""SELECT event_id, CAST(ts AS DATE) + 1 AS event_date FROM events
WHERE event_id NOT IN (SELECT event_id FROM events WHERE ts < TIMESTAMP '{LOADED_BEFORE}')""",
        "overwrite_partitioned": f"""SELECT event_id, CAST(ts AS DATE) AS event_date FROM events
WHERE CAST(ts AS DATE) >= CAST(TIMESTAMP '{LOADED_BEFORE}' AS DATE)""",
        "stream_dedupe_watermark": SILVER_A_SQL,
        "gold_incremental": incremental,
        "gold_resumed": incremental,
        "stream_performance": incremental,
        "volatility_incremental": f"WITH {PERF_A_SQL}{VOL_A_SQL}\nSELECT * FROM vol_a",
        "stream_ingest": SILVER_A_SQL,
        "stream_dedupe_bounded": SILVER_A_SQL,
        "anti_join_bucketed": f"""WITH {HASHED_EVENTS_SQL}
SELECT event_id, event_date, hash_diff FROM hashed
WHERE hash_diff NOT IN (SELECT hash_diff FROM hashed WHERE ts < TIMESTAMP '{LOADED_BEFORE}')""",
        "append_two_writers": f"""WITH {HASHED_EVENTS_SQL}
SELECT event_id, event_date, hash_diff FROM hashed""",
        "latest_from_statistics": f"WITH {SERIES_A_SQL}\nSELECT * FROM series_a WHERE ts = (SELECT max(ts) FROM series_a)",
        "variant_landing": f"""SELECT code, ts, rate, CASE WHEN month(ts) > 6 THEN 'second' END AS half,
       CASE WHEN month(ts) > 6 THEN month(ts)::INTEGER END AS month FROM ({RATES_SQL})""",
        "struct_unnest": """SELECT n_name AS code_exchange_rate, CAST(date_trunc('month', o_orderdate) AS DATE) AS snapshot_date,
       CAST(SUM(CAST(o_totalprice AS DECIMAL(20,4))) AS DECIMAL(20,4)) AS exchange_rate
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2""",
        "gold_named_readers": f"""WITH {PERF_A_SQL}{VOL_A_SQL},
ranked AS (SELECT CAST(entity AS VARCHAR) AS code, row_number() OVER (ORDER BY daily_change_pct DESC NULLS FIRST, CAST(entity AS VARCHAR)) AS up,
    row_number() OVER (ORDER BY daily_change_pct ASC NULLS FIRST, CAST(entity AS VARCHAR)) AS down, {A_TIER_CASE} AS tier FROM movers_a)
SELECT code AS code_exchange_rate, tier AS performance_tier, risk AS risk_score,
       CASE WHEN up <= 10 THEN up::INTEGER END AS gain_rank, CASE WHEN down <= 10 THEN down::INTEGER END AS loss_rank
FROM ranked JOIN vol_a ON code = CAST(entity AS VARCHAR)""",
        "stream_dedupe": SILVER_A_SQL,
        "gold_heatmap": f"""WITH {PERF_A_SQL}
SELECT CAST(entity AS VARCHAR) AS code_exchange_rate, value AS exchange_rate,
       daily_change_pct, weekly_change_pct, monthly_change_pct,
       {A_TIER_CASE} AS performance_tier
FROM movers_a""",
        "gold_top_gainers": f"""WITH {PERF_A_SQL}
SELECT CAST(ROW_NUMBER() OVER (ORDER BY daily_change_pct DESC NULLS FIRST, CAST(entity AS VARCHAR)) AS INTEGER) AS rank,
       CAST(entity AS VARCHAR) AS code_exchange_rate, value AS exchange_rate, daily_change_pct
FROM movers_a ORDER BY daily_change_pct DESC NULLS FIRST, CAST(entity AS VARCHAR) LIMIT 10""",
        "gold_top_losers": f"""WITH {PERF_A_SQL}
SELECT CAST(ROW_NUMBER() OVER (ORDER BY daily_change_pct ASC NULLS FIRST, CAST(entity AS VARCHAR)) AS INTEGER) AS rank,
       CAST(entity AS VARCHAR) AS code_exchange_rate, value AS exchange_rate, daily_change_pct
FROM movers_a ORDER BY daily_change_pct ASC NULLS FIRST, CAST(entity AS VARCHAR) LIMIT 10""",
        "gold_volatility": f"""WITH {PERF_A_SQL}{VOL_A_SQL}
SELECT CAST(entity AS VARCHAR) AS code_exchange_rate, volatility AS volatility_30d,
       avg_change AS avg_change_30d, max_gain AS max_gain_30d, max_loss AS max_loss_30d,
       rows_tracked AS days_tracked, risk AS risk_score
FROM vol_a""",
    }


QUERIES = {
    "json_map_explode": q_json_map_explode,
    "json_checked_members": q_json_checked_members,
    "json_rejected_count": q_json_rejected_count,
    "lineitem_row_keys": q_lineitem_row_keys,
    "load_time": q_load_time,
    "first_row_guard": q_first_row_guard,
    "compressed_roundtrip": q_compressed_roundtrip,
    "anti_join_cross_partition": q_anti_join_cross_partition,
    "overwrite_partitioned": q_overwrite_partitioned,
    "multiline_landing": q_multiline_landing,
    "dated_snapshot": q_dated_snapshot,
    "stream_dedupe_watermark": q_stream_dedupe_watermark,
    "gold_incremental": q_gold_incremental,
    "gold_resumed": q_gold_resumed,
    "stream_performance": q_stream_performance,
    "anti_join_bucketed": q_anti_join_bucketed,
    "append_two_writers": q_append_two_writers,
    "latest_from_statistics": q_latest_from_statistics,
    "variant_landing": q_variant_landing,
    "struct_unnest": q_struct_unnest,
    "gold_named_readers": q_gold_named_readers,
    "stream_dedupe_bounded": q_stream_dedupe_bounded,
    "volatility_incremental": q_volatility_incremental,
    "unpivot_measures": q_unpivot_measures,
    "not_null_filter": q_not_null_filter,
    "projection_alias": q_projection_alias,
    "lineage_constants": q_lineage_constants,
    "rfc2822_parse": q_rfc2822_parse,
    "decimal_cast": q_decimal_cast,
    "content_hash": q_content_hash,
    "anti_join_new": q_anti_join_new,
    "intra_batch_dedupe": q_intra_batch_dedupe,
    "append_roundtrip": q_append_roundtrip,
    "overwrite_roundtrip": q_overwrite_roundtrip,
    "raw_landing": q_raw_landing,
    "stream_ingest": q_stream_ingest,
    "stream_dedupe": q_stream_dedupe,
    "gold_heatmap": q_gold_heatmap,
    "gold_top_gainers": q_gold_top_gainers,
    "gold_top_losers": q_gold_top_losers,
    "gold_volatility": q_gold_volatility,
}
