"""Bronze -> silver: wide snapshot -> long typed rows with a content hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.hashing import content_hash
from tidemark.functions.numeric import to_money
from tidemark.functions.timeparse import parse_rfc2822, utc_ntz
from tidemark.operators import ingest, reshape
from tidemark.sources.snapshots import CORRUPT, INDEX_COLS, read_snapshots, snapshot_days

# Lineage constants of the quotes source.
LINEAGE = {"type_src": "api", "system_src": "exchangerate-api"}

ENTITY, TIME, VALUE = "code_exchange_rate", "time_last_update_utc", "exchange_rate"
HASH_COLS = INDEX_COLS + [ENTITY, VALUE, "type_src", "system_src"]
SILVER_COLS = INDEX_COLS + [ENTITY, VALUE, "type_src", "system_src", "load_date_src", "hash_diff"]
PARTITION_COL = "snapshot_date"
# inside each day file: one entity's rows together, in time order
CLUSTER_BY = (ENTITY, TIME)


BAD_RATE = "a rate is no number (give a quarantine path to set such rates aside)"


def _long(raw: DataFrame) -> DataFrame:
    """One row per code with the rate as text."""
    rates_type = raw.schema["conversion_rates"].dataType
    if isinstance(rates_type, T.StructType):
        wide = reshape.unnest_struct(raw.select(*INDEX_COLS, "conversion_rates"), "conversion_rates")
        return reshape.unpivot_wide(wide, INDEX_COLS, None, ENTITY, VALUE)
    return reshape.explode_map(raw, "conversion_rates", ENTITY, VALUE, keep=INDEX_COLS)


def to_silver(raw: DataFrame, load_time: Column | None = None, sep: str | None = None,
              quarantine: bool = False) -> DataFrame:
    """Long form, typed, hashed.  Works on batch and streaming frames.

    * rates map (or struct) -> one row per code; NULL rates dropped;
    * a rate that is no number ends the job, or with ``quarantine`` is left
      out here and reported by ``rejected``; the other rates of its document
      are kept either way;
    * RFC-2822 texts -> naive UTC timestamps (unparsable -> NULL, row kept);
    * rate -> decimal(20,4); hash over the typed values, excluding load time
      (``sep``: see ``content_hash``; the default can't collide);
    * ``snapshot_date`` (payload date, not file date) is the partition key.
    """
    number = F.col(VALUE).try_cast("double")
    if not quarantine:
        number = F.coalesce(number, F.raise_error(F.concat(F.lit(BAD_RATE + ": "), F.col(VALUE).cast("string"))).cast("double"))
    typed = (
        _long(raw).where(F.col(VALUE).isNotNull())
        .withColumn(VALUE, number)
        .where(F.col(VALUE).isNotNull())
        .withColumns({k: F.lit(v) for k, v in LINEAGE.items()})
        .withColumns({
            "time_last_update_utc": parse_rfc2822("time_last_update_utc"),
            "time_next_update_utc": parse_rfc2822("time_next_update_utc"),
            VALUE: to_money(VALUE),
            "load_date_src": load_time if load_time is not None
            else utc_ntz(F.current_timestamp()),
        })
    )
    hashed = typed.withColumn("hash_diff", content_hash(HASH_COLS, typed, sep))
    return hashed.select(*SILVER_COLS, F.to_date(TIME).alias(PARTITION_COL))


def rejected(raw: DataFrame) -> DataFrame:
    """(reason, time, code, text): the documents (reason ``document``) that
    could not be read and the rates (``rate``) that are no numbers, of raw
    snapshots read with ``quarantine``."""
    # Spark wants a read of the bad text to read some other column too
    documents = raw.where(F.col(CORRUPT).isNotNull()).select(
        F.lit("document").alias("reason"), F.col("time_last_update_utc").alias("time"),
        F.lit(None).cast("string").alias("code"), F.col(CORRUPT).alias("text"),
    )
    rates = _long(raw).where(F.col(VALUE).isNotNull() & F.col(VALUE).try_cast("double").isNull()).select(
        F.lit("rate").alias("reason"), F.col("time_last_update_utc").alias("time"), F.col(ENTITY).alias("code"),
        F.col(VALUE).cast("string").alias("text"),
    )
    return documents.unionByName(rates)


def write_silver(raw: DataFrame, silver_path: str, sep: str | None = None,
                 quarantine_path: str | None = None) -> None:
    """Append the new rows of raw snapshots to the silver table.  The hash
    covers the snapshot time, so it determines the partition, and the sink is
    read only for the days that the snapshots' headers name."""
    if quarantine_path is not None:
        rejected(raw).write.mode("append").parquet(quarantine_path)
    silver = to_silver(raw, sep=sep, quarantine=quarantine_path is not None)
    ingest.append_new(raw.sparkSession, silver, silver_path, ["hash_diff"], PARTITION_COL,
                      cluster_by=CLUSTER_BY, key_fixes_partition=True,
                      partition_values=lambda: snapshot_days(raw))


def run_silver(spark: SparkSession, raw_path: str | list[str], silver_path: str, multiline: bool = True,
               sep: str | None = None, quarantine_path: str | None = None) -> None:
    """One batch job over a file, a folder or a glob of snapshots (backfill
    included): read -> silver -> in-batch dedupe -> anti join -> append.
    ``quarantine_path``: bad documents and rates are appended to that table
    instead of ending the job."""
    raw = read_snapshots(spark, raw_path, multiline, quarantine_path is not None)
    write_silver(raw, silver_path, sep, quarantine_path)
