"""Silver -> gold: performance frame, movers, heat map, top lists, volatility.

The performance frame feeds five outputs, so it is written once as a gold
table, partitioned by snapshot day, and read back (lineage cut, computed once)
instead of being recomputed per output.  An incremental run extends it from the
last rows of each entity, and the volatility profile from its moments.  Table
and column names follow the original gold layer.

A run may end anywhere and be tried again.  Notes beside the tables
(``sources.ledger``) tell how far it came:

* ``_due``: snapshot days that silver has (or is about to have) and gold may not;
  a note goes when a run that covers it has written the outputs;
* ``_steps/full``: a full run has begun and not ended, so its tables are no base
  for an incremental run, which then becomes a full one;
* ``_steps/ready``: an incremental run has worked out everything that changes and
  written it aside, complete.  Whoever runs next publishes that first.  Every
  step of it can be repeated: rows are appended by their hash, days and small
  tables are replaced.
"""

from __future__ import annotations

import datetime as _dt
import json
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.classify import RISK_RULES, TIER_RULES
from tidemark.operators import ingest, movers, profile, series, state
from tidemark.plans.silver import ENTITY, PARTITION_COL, TIME, VALUE
from tidemark.session import materialize
from tidemark.sources import ledger
from tidemark.sources.tables import read_table, write_overwrite, write_partitions

VOL_NAMES = {
    "volatility": "volatility_30d",
    "avg_change": "avg_change_30d",
    "max_gain": "max_gain_30d",
    "max_loss": "max_loss_30d",
    "rows_tracked": "days_tracked",
    "risk": "risk_score",
}


def performance_frame(silver: DataFrame, strategy: str = "auto",
                      entity: str = ENTITY, time: str = TIME, value: str = VALUE) -> DataFrame:
    return series.performance(silver, entity, time, value, strategy=strategy,
                              order_extra=["hash_diff"] if "hash_diff" in silver.columns else ())


def gold_tables(perf: DataFrame, entity: str = ENTITY, time: str = TIME, value: str = VALUE,
                tiers=TIER_RULES, risk=RISK_RULES, k: int = 10, latest: DataFrame | None = None,
                moments: DataFrame | None = None) -> dict[str, DataFrame]:
    """The four gold outputs from a (materialised) performance frame.
    ``latest``: a part of it that holds the latest snapshot; ``moments``: its
    moments by entity, so that the volatility needs none of its rows."""
    if moments is None:
        moments = state.moments(perf, entity)
    mv = movers.latest_snapshot(perf if latest is None else latest, time)
    cols = [entity, value, "daily_change_pct"]
    return {
        "currency_heatmap": profile.heatmap(mv, entity, value, tier=tiers),
        "top_gainers": movers.gainers(mv, "daily_change_pct", entity, k, cols),
        "top_losers": movers.losers(mv, "daily_change_pct", entity, k, cols),
        "volatility_exchange_rates": state.volatility_from_moments(moments, entity, risk=risk, names=VOL_NAMES),
    }


def _write_gold(spark: SparkSession, gold_path: str, **kw) -> dict[str, DataFrame]:
    """The four outputs from the tables.  The movers read only the partition of
    performance's latest day, found by one folder listing; the volatility reads
    the moments."""
    perf = read_table(spark, gold_path, "performance")
    day = latest_partition(spark, f"{gold_path}/performance.parquet", PARTITION_COL)
    latest = perf if day is None else perf.where(F.col(PARTITION_COL) == F.lit(day).cast("date"))
    out = gold_tables(perf, latest=latest, moments=read_table(spark, gold_path, "moments"), **kw)
    for name, df in out.items():
        # sorted outputs: the final sort is a range exchange; the rows keep
        # their advisory order across the part files.
        write_overwrite(df, f"{gold_path}/{name}.parquet")
    return {name: read_table(spark, gold_path, name) for name in [*out, "performance"]}


def latest_partition(spark: SparkSession, path: str, column: str) -> str | None:
    """The greatest partition value of a table by its folder names (ISO days
    sort as text); None where it has none."""
    jvm = spark.sparkContext._jvm  # noqa: SLF001 - Hadoop FileSystem API
    at = jvm.org.apache.hadoop.fs.Path(path)
    listed = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(at)  # noqa: SLF001
    names = [x.getPath().getName() for x in listed]
    values = [n.partition("=")[2] for n in names if n.startswith(f"{column}=") and not n.endswith("PARTITION__")]
    return max(values, default=None)


# Rows of each entity that the tails table keeps: the largest lag, the row
# that only gives the first kept row its previous value, and that row.
TAIL_ROWS = max([series.DEFAULT_FIRST_LAG[1], *series.DEFAULT_LAGS.values()]) + 2


def _steps(gold_path: str) -> str:
    return f"{gold_path}/_steps"


def _write_performance(perf: DataFrame, path: str, write) -> None:
    write(perf.hint("rebalance", PARTITION_COL), path, partition_by=[PARTITION_COL])


def _tails(rows: DataFrame) -> DataFrame:
    """The last TAIL_ROWS silver rows of each entity: what a later, on-time
    snapshot needs of the history."""
    back = Window.partitionBy(ENTITY).orderBy(F.col(TIME).desc_nulls_last(), F.col("hash_diff").desc())
    return rows.withColumn("_n", F.row_number().over(back)).where(F.col("_n") <= TAIL_ROWS).drop("_n")


def note_due(spark: SparkSession, gold_path: str, days: list) -> None:
    """Note that silver gets rows of these snapshot days (None: without a time).
    To be called before they are appended."""
    if days:
        ledger.add(spark, f"{gold_path}/_due", json.dumps([d.isoformat() if d else None for d in days]))


def _due_days(notes: dict[str, str]) -> list:
    return [_dt.date.fromisoformat(d) if d else None for text in notes.values() for d in json.loads(text)]


def _settle(spark: SparkSession, gold_path: str, notes: dict[str, str]) -> None:
    for name in notes:
        ledger.remove(spark, f"{gold_path}/_due", name)


def run_gold(spark: SparkSession, silver_path: str, gold_path: str, strategy: str = "auto",
             tiers=TIER_RULES, risk=RISK_RULES, k: int = 10) -> dict[str, DataFrame]:
    """Full recompute from silver.  Performance is written once, partitioned
    by snapshot day; the outputs read the tables, not the lineage."""
    steps = _steps(gold_path)
    notes = ledger.notes(spark, f"{gold_path}/_due")  # before silver is read
    ledger.put(spark, steps, "full")
    ledger.remove(spark, steps, "ready")
    silver = spark.read.parquet(silver_path)
    _write_performance(performance_frame(silver, strategy), f"{gold_path}/performance.parquet", write_overwrite)
    write_overwrite(_tails(silver), f"{gold_path}/tails.parquet")
    write_overwrite(state.moments(read_table(spark, gold_path, "performance"), ENTITY), f"{gold_path}/moments.parquet")
    out = _write_gold(spark, gold_path, tiers=tiers, risk=risk, k=k)
    ledger.remove(spark, steps, "full")
    _settle(spark, gold_path, notes)
    return out


def run_gold_incremental(spark: SparkSession, silver_path: str, gold_path: str, days: list,
                         strategy: str = "auto", tiers=TIER_RULES, risk=RISK_RULES,
                         k: int = 10) -> dict[str, DataFrame]:
    """Bring gold up to date after silver got new rows in the given snapshot
    ``days`` (see ``snapshot_days``) and in the days that are due from earlier
    runs.  The result is that of ``run_gold``, also after runs that ended
    halfway; where gold has no finished full run, it is one.

    * New rows: silver rows of those days that performance does not have.
    * An entity whose new rows all come after its history is on time: its
      last TAIL_ROWS rows and the new rows give its new performance rows,
      which are appended, and their moments, which are merged; no older row is
      read.
    * A row without a time (day None) comes before all others, as in the
      full run, so it is a late row; it is known again by its hash_diff among
      the rows without a day.
    * An entity that got a late row is computed again from its silver rows;
      its performance rows from that time on are replaced, by rewriting the
      days from the earliest late row on (other entities' rows are copied), and
      its moments are made anew from its rows.

    The tails, the moments and the four outputs are rewritten; none of them
    grows with the history.
    """
    steps = _steps(gold_path)
    note_due(spark, gold_path, days)
    begun = ledger.notes(spark, steps)
    if "full" in begun or not ingest.path_exists(spark, f"{gold_path}/moments.parquet"):
        return run_gold(spark, silver_path, gold_path, strategy, tiers, risk, k)
    if "ready" in begun:
        publish(spark, gold_path)
    notes = ledger.notes(spark, f"{gold_path}/_due")
    stage(spark, silver_path, gold_path, _due_days(notes), strategy)
    publish(spark, gold_path)
    out = _write_gold(spark, gold_path, tiers=tiers, risk=risk, k=k)
    _settle(spark, gold_path, notes)
    return out


def stage(spark: SparkSession, silver_path: str, gold_path: str, days: list, strategy: str = "auto") -> None:
    """Work out what the new rows of ``days`` change and write it aside; the
    note ``ready`` tells that it is complete.  No table is changed."""
    days = list(dict.fromkeys(days))
    timed = [d for d in days if d is not None]
    path = f"{gold_path}/performance.parquet"
    silver = spark.read.parquet(silver_path)
    perf = spark.read.parquet(path)
    in_days = F.col(PARTITION_COL).isin(timed) if timed else F.lit(False)
    if len(timed) < len(days):
        in_days = F.coalesce(in_days, F.lit(False)) | F.col(PARTITION_COL).isNull()
    # read by both branches and both writes: written once
    new = materialize(silver.where(in_days).join(perf.where(in_days).select("hash_diff"), "hash_diff", "left_anti")
                      .select(*silver.columns))
    tails = read_table(spark, gold_path, "tails")
    # _since is null where the earliest new row has no time
    since = new.groupBy(ENTITY).agg(
        F.when(F.count(TIME) == F.count("*"), F.min(TIME)).alias("_since"))
    ends = tails.groupBy(ENTITY).agg(F.max(TIME).alias("_end"))
    known = materialize(since.join(ends, ENTITY, "left").withColumn(
        "_late", F.col("_since").isNull() | F.coalesce(F.col("_since") <= F.col("_end"), F.lit(False))))
    on_time, late = known.where(~F.col("_late")), known.where("_late")

    def changed(rows: DataFrame, entities: DataFrame) -> DataFrame:
        frame = performance_frame(rows.join(entities.select(ENTITY), ENTITY, "left_semi"), strategy)
        frame = frame.join(entities.select(ENTITY, "_since"), ENTITY)
        return frame.where(F.col("_since").isNull() | (F.col(TIME) >= F.col("_since"))).drop("_since")

    run = uuid.uuid4().hex
    aside = f"{gold_path}/_staged/{run}"
    moments = read_table(spark, gold_path, "moments")
    write_overwrite(changed(tails.unionByName(new), on_time).select(*perf.columns), f"{aside}/fresh.parquet")
    fresh = read_table(spark, aside, "fresh")
    first, n, dated = late.agg(F.to_date(F.min("_since")), F.count("*"), F.count("_since")).first()
    if n:
        again = materialize(changed(silver, late).select(*perf.columns))
        # an entity with a new row without a time changes on every day
        touched = F.col(PARTITION_COL) >= F.lit(first) if dated == n else F.lit(True)
        before = F.col("_since").isNotNull() & (F.col(TIME).isNull() | (F.col(TIME) < F.col("_since")))
        kept = perf.where(touched).join(late.select(ENTITY, "_since", "_late"), ENTITY, "left")
        kept = kept.where(F.col("_late").isNull() | before).drop("_since", "_late")
        rows = kept.select(*perf.columns).unionByName(again).unionByName(fresh.select(*perf.columns))
        write_overwrite(rows, f"{aside}/days.parquet")
        own = perf.join(late.select(ENTITY, "_since"), ENTITY).where(before).select(*perf.columns).unionByName(again)
        moments = moments.join(late.select(ENTITY), ENTITY, "left_anti").unionByName(state.moments(own, ENTITY))
    write_overwrite(state.merge(moments, state.moments(fresh, ENTITY), ENTITY), f"{aside}/moments.parquet")
    # an entity's first row is not in performance, so it may be new again
    write_overwrite(_tails(tails.unionByName(new).dropDuplicates(["hash_diff"])), f"{aside}/tails.parquet")
    ledger.put(spark, _steps(gold_path), "ready", json.dumps({"run": run, "late": bool(n)}))


def publish(spark: SparkSession, gold_path: str) -> None:
    """Bring what ``stage`` has written aside into the tables.  May be repeated
    from the beginning after it ended anywhere."""
    steps = _steps(gold_path)
    told = json.loads(ledger.notes(spark, steps)["ready"])
    aside = f"{gold_path}/_staged/{told['run']}"
    path = f"{gold_path}/performance.parquet"
    if told["late"]:
        # the touched days as a whole
        _write_performance(read_table(spark, aside, "days"), path, write_partitions)
    else:
        # rows that an earlier attempt has appended are known by their hash
        ingest.append_new(spark, read_table(spark, aside, "fresh"), path, ["hash_diff"], PARTITION_COL,
                          dedupe=False, key_fixes_partition=True)
    for name in ("tails", "moments"):
        write_overwrite(read_table(spark, aside, name), f"{gold_path}/{name}.parquet")
    ledger.remove(spark, steps, "ready")
    ledger.remove(spark, f"{gold_path}/_staged", told["run"])
