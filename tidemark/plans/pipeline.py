"""bronze -> silver -> gold in order (what the hourly schedule runs)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.plans.gold import note_due, run_gold_incremental
from tidemark.plans.silver import write_silver
from tidemark.sources.snapshots import read_snapshots, snapshot_days


def run_pipeline(spark: SparkSession, raw_path: str, silver_path: str, gold_path: str,
                 multiline: bool = True, strategy: str = "auto", **gold_kw) -> dict[str, DataFrame]:
    """The days of the raw snapshots are noted as due, silver gets their new
    rows, gold is brought up to date with all days that are due (the first run
    makes it in full).  Idempotent, and safe to try again wherever it ended:
    re-running with the same raw input appends nothing to silver and rewrites
    gold's outputs with the same content, and a run over other input finishes
    what an earlier one left."""
    raw = read_snapshots(spark, raw_path, multiline)
    note_due(spark, gold_path, snapshot_days(raw))
    write_silver(raw, silver_path)
    return run_gold_incremental(spark, silver_path, gold_path, [], strategy, **gold_kw)


def run_pipeline_streaming(spark: SparkSession, raw_path: str, silver_path: str, gold_path: str,
                           checkpoint: str, multiline: bool = True, strategy: str = "auto",
                           max_files_per_trigger: int | None = None,
                           archive_dir: str | None = None,
                           **gold_kw) -> dict[str, DataFrame]:
    """The hourly run with the file stream as the silver step: only files not
    yet seen by the checkpoint are read (``availableNow``), each micro-batch
    notes its days as due, then gold is brought up to date in batch.
    ``archive_dir``: read files are moved there, so the next run's listing
    doesn't see them."""
    from tidemark.streaming.ingest import stream_silver

    stream_silver(spark, raw_path, silver_path, checkpoint, multiline, max_files_per_trigger,
                  archive_dir=archive_dir, before_append=lambda days: note_due(spark, gold_path, days))
    return run_gold_incremental(spark, silver_path, gold_path, [], strategy, **gold_kw)
