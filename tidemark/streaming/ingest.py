"""Structured Streaming ingestion of snapshot files into the silver table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.timeparse import epoch_micros_ntz
from tidemark.operators import ingest
from tidemark.plans.silver import CLUSTER_BY, PARTITION_COL, to_silver, write_silver
from tidemark.session import materialize
from tidemark.sources import ledger
from tidemark.sources.snapshots import snapshot_days, stream_snapshots
from tidemark.sources.tables import write_append


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stream_silver(
    spark: SparkSession,
    raw_path: str,
    silver_path: str,
    checkpoint: str,
    multiline: bool = True,
    max_files_per_trigger: int | None = None,
    available_now: bool = True,
    archive_dir: str | None = None,
    quarantine_path: str | None = None,
    before_append: Callable[[list], None] | None = None,
):
    """File stream -> foreachBatch(silver, dedupe, anti join, append).

    Replay safety: the checkpoint records processed files; a micro-batch that
    is replayed after a failure re-runs the same anti join and appends
    nothing twice.  No watermark, so nothing late is lost.
    ``archive_dir``: move processed raw files there (see ``stream_snapshots``).
    A bad document or rate ends the query before its micro-batch is committed
    (or archived), unless ``quarantine_path`` names a table for them.
    ``before_append`` is called with the snapshot days of each micro-batch
    before its rows are appended.
    Returns the finished (available-now) or running query.
    """
    raw = stream_snapshots(spark, raw_path, multiline, max_files_per_trigger, archive_dir,
                           quarantine_path is not None)

    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        if before_append is not None:
            before_append(snapshot_days(batch))
        write_silver(batch, silver_path, quarantine_path=quarantine_path)

    w = raw.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 hour")
    q = w.start()
    if available_now:
        q.awaitTermination()
    return q


def stream_silver_dedupe(
    spark: SparkSession,
    raw_path: str,
    silver_path: str,
    checkpoint: str,
    multiline: bool = True,
    watermark: str | None = None,
    max_files_per_trigger: int | None = None,
    files_per_day: int | None = None,
):
    """Stateful variant: the stream itself drops repeated hashes, kept in
    RocksDB state on the executors (not on the JVM heap).

    With ``watermark`` (``dropDuplicatesWithinWatermark``) the state is
    bounded, but rows arriving later than the delay are dropped: the delay has
    to exceed any possible disorder.  Without it the state is UNBOUNDED: every
    hash ever seen stays in it; for small sources only.  The sink keeps a log
    of its files, so ``append_new`` refuses to write beside it.

    The file sink writes one file per task and day (AQE is off in streaming
    plans).  ``files_per_day`` clusters each micro-batch by (day, salt of the
    row hash) first: at most that many files per day and micro-batch, and a
    hot day still spreads over that many writers.  Off by default, since it
    caps the writers of a one-day micro-batch.
    """
    rows = to_silver(stream_snapshots(spark, raw_path, multiline, max_files_per_trigger))
    if watermark:
        # event time must be TIMESTAMP, not TIMESTAMP_NTZ: the instant of the
        # naive UTC value, without a session-time-zone cast
        rows = (
            rows.withColumn(
                "_event_time", F.timestamp_micros(epoch_micros_ntz("time_last_update_utc"))
            )
            .withWatermark("_event_time", watermark)
            .dropDuplicatesWithinWatermark(["hash_diff"])
            .drop("_event_time")
        )
    else:
        rows = rows.dropDuplicates(["hash_diff"])
    if files_per_day:
        salt = F.pmod(F.xxhash64("hash_diff"), F.lit(files_per_day))
        rows = rows.repartition(F.col(PARTITION_COL), salt)
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider)
    spark.conf.set(provider, ROCKSDB)  # a query keeps the settings it starts with
    try:
        q = (
            rows.writeStream.format("parquet")
            .option("path", silver_path)
            .option("checkpointLocation", checkpoint)
            .partitionBy(PARTITION_COL)
            .outputMode("append")
            .trigger(availableNow=True)
            .start()
        )
    finally:
        spark.conf.set(provider, before)
    q.awaitTermination()
    return q


def stream_silver_bounded(
    spark: SparkSession,
    raw_path: str,
    silver_path: str,
    checkpoint: str,
    delay: str = "2 days",
    multiline: bool = True,
    max_files_per_trigger: int | None = None,
):
    """Dedupe with bounded state that loses nothing, however late a row is.

    The watermark runs on the time of *arrival*, which never goes back, so no row
    is ever late for it: the state drops what is delivered again within ``delay``
    and keeps no hash for longer.  A row that passes may have been delivered
    before that only if its snapshot is older than ``delay`` by then (nothing
    arrives before its own time).  So rows of recent snapshots, the usual ones,
    are appended without a look at the sink, and only those of older snapshots
    are compared with it, in the partitions of their days.

    A micro-batch notes that it begins; one that is run again finds the note and
    compares all its rows with the sink, so a batch that ended halfway leaves no
    row twice.  Rows without a time count as old.
    """
    rows = to_silver(stream_snapshots(spark, raw_path, multiline, max_files_per_trigger))
    rows = (
        rows.withColumn("_seen", F.current_timestamp())
        .withWatermark("_seen", delay)
        .dropDuplicatesWithinWatermark(["hash_diff"])
    )
    begun = f"{checkpoint.rstrip('/')}/begun-batches"

    def write_batch(batch: DataFrame, epoch: int) -> None:
        again = not ledger.claim(spark, begun, str(epoch))
        # the stateful step runs once for both appends
        batch = materialize(batch)
        at = F.timestamp_micros(epoch_micros_ntz("time_last_update_utc"))
        recent = F.lit(False) if again else F.coalesce(at > F.col("_seen") - F.expr(f"interval {delay}"), F.lit(False))
        order = [PARTITION_COL, *CLUSTER_BY]
        usual = batch.where(recent).drop("_seen").hint("rebalance", PARTITION_COL)
        write_append(usual.sortWithinPartitions(*order), silver_path, partition_by=[PARTITION_COL])
        ingest.append_new(spark, batch.where(~recent).drop("_seen"), silver_path, ["hash_diff"], PARTITION_COL,
                          cluster_by=CLUSTER_BY, key_fixes_partition=True)
        for name in ledger.notes(spark, begun):
            if int(name) < epoch:
                ledger.remove(spark, begun, name)

    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider)
    spark.conf.set(provider, ROCKSDB)  # a query keeps the settings it starts with
    try:
        q = (
            rows.writeStream.foreachBatch(write_batch)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
    finally:
        spark.conf.set(provider, before)
    q.awaitTermination()
    return q
