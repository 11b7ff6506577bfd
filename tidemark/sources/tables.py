"""Parquet tables: readers and sinks (append-new-only lives in operators.ingest)."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Gold table names of the original dashboard loaders.
GOLD_TABLES = ("currency_heatmap", "top_gainers", "top_losers", "volatility_exchange_rates")


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """``<root>/<name>.parquet`` (a file or a directory of parts)."""
    return spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Lazy scan of a Parquet dataset; partition folders are discovered."""
    return spark.read.parquet(path)


def read_gold(spark: SparkSession, gold_root: str, names: Sequence[str] = GOLD_TABLES,
              register: bool = True) -> dict[str, DataFrame]:
    """Load the gold tables by name and (optionally) register temp views."""
    out = {}
    for name in names:
        df = read_table(spark, gold_root, name)
        if register:
            df.createOrReplaceTempView(name)
        out[name] = df
    return out


def write_overwrite(df: DataFrame, path: str, compression: str = "snappy",
                    partition_by: Sequence[str] = ()) -> None:
    """Replace the whole table at ``path``, all its partitions included,
    whatever the session's overwrite mode.  Never read ``path`` in the same
    plan: a static overwrite deletes its input first."""
    w = df.write.mode("overwrite").option("compression", compression)
    w = w.option("partitionOverwriteMode", "static")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_partitions(df: DataFrame, path: str, partition_by: Sequence[str],
                     compression: str = "snappy") -> None:
    """Replace only the partitions that ``df`` has rows for."""
    w = df.write.mode("overwrite").option("compression", compression)
    w.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)


def write_append(df: DataFrame, path: str, compression: str = "snappy",
                 partition_by: Sequence[str] = ()) -> None:
    w = df.write.mode("append").option("compression", compression)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


@contextmanager
def _settings(spark: SparkSession, **wanted: str):
    before = {k: spark.conf.get(k) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


#: Types whose greatest value Parquet's footers tell in full.
FOOTER_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DateType, T.BooleanType)


def max_from_statistics(spark: SparkSession, path: str, column: str, explain: list | None = None):
    """The greatest value of a column of a Parquet table, from the statistics in
    the files' footers: the aggregate is pushed into the scan, so no row is read,
    whatever the table's size.  Columns of other types than ``FOOTER_TYPES`` are
    read (one column, partial maxima).  None for an empty table.  ``explain``
    gets the plan's text."""
    names = {"spark.sql.sources.useV1SourceList": "avro,csv,json,kafka,orc,text", "spark.sql.parquet.aggregatePushdown": "true"}
    table = spark.read.parquet(path)
    if not isinstance(table.schema[column].dataType, FOOTER_TYPES):
        return table.agg(F.max(column)).first()[0]
    # the session's file sources push no aggregate; only this read takes the other ones
    with _settings(spark, **names):
        greatest = spark.read.parquet(path).agg(F.max(column))
        if explain is not None:
            explain.append(greatest._jdf.queryExecution().executedPlan().toString())  # noqa: SLF001
        return greatest.first()[0]


def write_bucketed(df: DataFrame, table: str, keys: Sequence[str], buckets: int, path: str, mode: str = "append") -> None:
    """Append to (or make) a catalog table at ``path`` whose files are dealt to
    ``buckets`` by the keys and sorted by them, so that joins on the keys need no
    shuffle of it.  One file a bucket and write."""
    rows = df.repartition(buckets, *keys)
    w = rows.write.format("parquet").mode(mode).bucketBy(buckets, *keys).sortBy(*keys).option("path", path)
    w.saveAsTable(table)


def bucketed_name(prefix: str = "sink") -> str:
    """A table name of its own."""
    return f"{prefix}_{uuid.uuid4().hex}"
