"""Keyed series derived from the driver test tables.

Series A: supplier x month revenue (lineitem).  Series B: event type x day
value (events).  Both are plain aggregates: partial aggregation runs before
the shuffle, so a hot supplier is combined map-side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.numeric import MONEY
from tidemark.sources.tables import read_table


def supplier_month_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(entity bigint, ts date, value decimal(20,4)) from lineitem."""
    li = read_table(spark, sf_dir, "lineitem")
    return li.groupBy(
        F.col("l_suppkey").alias("entity"),
        F.trunc(F.to_date("l_shipdate"), "month").alias("ts"),
    ).agg(F.sum(F.col("l_extendedprice").cast(MONEY)).cast(MONEY).alias("value"))


def event_type_day_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(entity string, ds date, value decimal(20,4)) from events."""
    ev = read_table(spark, sf_dir, "events")
    return ev.groupBy(
        F.col("event_type").alias("entity"),
        F.to_date("ts").alias("ds"),
    ).agg(F.sum(F.col("value").cast(MONEY)).cast(MONEY).alias("value"))


# Header texts of the synthetic snapshot documents.
SNAPSHOT_HEADER = {
    "result": "success",
    "documentation": "https://quotes.example.org/docs",
    "terms_of_use": "https://quotes.example.org/terms",
}
# Documents that a snapshot's codes are split over when no number is given.
DOCUMENTS = 16


def snapshot_payloads(
    series: DataFrame,
    entity: str = "entity",
    time: str = "ts",
    value: str = "value",
    base_code: str = "SUP",
    documents: int = DOCUMENTS,
) -> DataFrame:
    """Turn a keyed series into snapshot documents shaped like the API's.

    One snapshot per time value; its rates are split over ``documents``
    documents (hash buckets of the entity), whose number the caller chooses so
    that a document stays small (a few hundred codes).  The silver transform
    does not care how a snapshot's rates are split.  A NULL entity has no
    place in a JSON object: it ends the job with a message.
    """
    from tidemark.functions.timeparse import epoch_seconds_ntz, format_rfc2822

    code = F.coalesce(
        F.col(entity).cast("string"),
        F.raise_error(F.lit(f"a snapshot can't hold a rate without a code: {entity} is NULL")).cast("string"),
    )
    # naive UTC; no session-time-zone cast anywhere
    ts = F.col(time).cast("timestamp_ntz")
    nxt = F.add_months(F.col(time), 1).cast("timestamp_ntz")
    docs = series.groupBy(
        F.col(time).alias("_t"),
        F.pmod(F.xxhash64(F.col(entity)), F.lit(documents)).alias("_doc"),
    ).agg(
        F.map_from_entries(
            F.collect_list(F.struct(code, F.col(value).cast("double")))
        ).alias("conversion_rates")
    ).withColumnRenamed("_t", time)
    return docs.select(
        *[F.lit(v).alias(k) for k, v in SNAPSHOT_HEADER.items()],
        epoch_seconds_ntz(ts).alias("time_last_update_unix"),
        format_rfc2822(ts).alias("time_last_update_utc"),
        epoch_seconds_ntz(nxt).alias("time_next_update_unix"),
        format_rfc2822(nxt).alias("time_next_update_utc"),
        F.lit(base_code).alias("base_code"),
        "conversion_rates",
        F.to_date(ts).alias("ingest_date"),
    )
