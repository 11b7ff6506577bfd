"""Refit from sufficient statistics: the trend + weekday model of ``forecast``
without its history.

The model needs, per entity and weekday, only the sums of 1, x, x*x, y, x*y and
y*y (x: day number).  ``moments`` makes that table in one aggregate, ``merge``
adds tables of different rows, ``fit_from_moments`` solves the model from it.  A
new batch therefore costs one aggregate over the batch and a merge with at most
seven rows an entity, however long the history is.

x and its sums are whole numbers.  With ``digits`` (the decimal digits that y is
known to carry) the sums with y are decimals, so they are exact and no order or
split of the batches can change the model; without it they are doubles.  Sums
are shifted to each entity's first day before anything is subtracted.

Defined cases: rows without a day or a value count for nothing; a NULL entity is
a series of its own; an entity with fewer than two different days has a NULL
trend; an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators._util import entity_key
from tidemark.operators.forecast import WEEKDAYS, iso_weekday
from tidemark.operators.ingest import read_sink
from tidemark.session import materialize
from tidemark.sources.tables import write_overwrite

SUMS = ("n", "sx", "sxx", "sy", "sxy", "syy")


def moments(train: DataFrame, digits: int | None = None) -> DataFrame:
    """(entity, dow, first_ds, last_ds, n, sx, sxx, sy, sxy, syy) of a training
    frame (entity, ds, y)."""
    y = F.col("y").cast("double")
    if digits is not None:
        y = y.cast(f"decimal(20,{digits})")
    pts = train.where(F.col("y").isNotNull() & F.col("ds").isNotNull()).select(
        "entity", "ds", iso_weekday("ds").alias("dow"), F.unix_date("ds").cast("long").alias("x"), y.alias("y")
    )
    x, y = F.col("x"), F.col("y")
    return pts.groupBy("entity", "dow").agg(
        F.min("ds").alias("first_ds"),
        F.max("ds").alias("last_ds"),
        F.count(F.lit(1)).alias("n"),
        F.sum(x).alias("sx"),
        F.sum(x * x).alias("sxx"),
        F.sum(y).alias("sy"),
        F.sum(x.cast("decimal(10,0)") * y if digits is not None else x * y).alias("sxy"),
        F.sum(y * y).alias("syy"),
    )


def merge(*tables: DataFrame) -> DataFrame:
    """The moments of all rows that the tables were made from."""
    both = tables[0]
    for t in tables[1:]:
        both = both.unionByName(t)
    types = {f.name: f.dataType for f in tables[0].schema.fields}
    return both.groupBy("entity", "dow").agg(
        F.min("first_ds").alias("first_ds"),
        F.max("last_ds").alias("last_ds"),
        *[F.sum(c).cast(types[c]).alias(c) for c in SUMS],
    )


def fit_from_moments(table: DataFrame) -> DataFrame:
    """The model table of ``forecast.fit`` (same columns, same model)."""
    keyed = table.withColumn("_ek", entity_key("entity")).drop("entity")
    # the entity's first day, on its few rows; the sums move there exactly
    days = keyed.groupBy("_ek").agg(F.min("first_ds").alias("_from"))
    rows = keyed.join(days, "_ek")
    x0 = F.unix_date("_from").cast("long")
    rows = rows.select(
        "_ek", "dow", "_from", "last_ds", "n", "sy", "syy",
        (F.col("sx") - F.col("n") * x0).alias("sx"),
        (F.col("sxx") - 2 * x0 * F.col("sx") + F.col("n") * x0 * x0).alias("sxx"),
        (F.col("sxy") - F.col("sy") * x0).alias("sxy"),
    )
    total = rows.groupBy("_ek").agg(
        F.first("_from").alias("first_ds"),
        F.max("last_ds").alias("last_ds"),
        *[F.sum(c).alias(c) for c in SUMS],
    )
    d = lambda c: F.col(c).cast("double")
    total = total.select(
        "_ek", "first_ds", "last_ds", F.col("n"),
        F.try_divide(d("n") * d("sxy") - d("sx") * d("sy"), d("n") * d("sxx") - d("sx") * d("sx")).alias("slope"),
        (d("sx") / d("n")).alias("_mx"), (d("sy") / d("n")).alias("_my"),
    ).withColumn("intercept", F.col("_my") - F.col("slope") * F.col("_mx"))
    b = F.col("slope")
    left = d("sy") - b * d("sx")  # the weekday's sum of y without the slope
    by_day = rows.join(total.select("_ek", "slope", "intercept"), "_ek").select(
        "_ek", "dow",
        (left / d("n") - F.col("intercept")).alias("effect"),
        F.greatest(d("syy") - 2 * b * d("sxy") + b * b * d("sxx") - left * left / d("n"), F.lit(0.0)).alias("ss"),
    )
    per_entity = by_day.groupBy("_ek").agg(
        F.sum("ss").alias("_ss"),
        *[F.max(F.when(F.col("dow") == k, F.col("effect"))).alias(f"effect_{k}") for k in WEEKDAYS],
    )
    return total.join(per_entity, "_ek").select(
        F.col("_ek.value").alias("entity"), "first_ds", "last_ds", "n", "slope", "intercept",
        F.when(b.isNotNull(), F.sqrt(F.try_divide("_ss", F.col("n") - 1))).alias("sigma"),
        *[f"effect_{k}" for k in WEEKDAYS],
    )


def refit(spark: SparkSession, path: str, batch: DataFrame, digits: int | None = None) -> DataFrame:
    """Add a batch of new training rows to the moments table at ``path`` (made
    if missing) and return the model of everything so far.  Each row must come
    in one batch only."""
    new = moments(batch, digits)
    old = read_sink(spark, path)
    # the table is read and replaced: its next state is written aside first
    table = materialize(new if old is None else merge(old, new))
    write_overwrite(table, path)
    return fit_from_moments(spark.read.schema(table.schema).parquet(path))
