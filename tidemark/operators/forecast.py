"""Per-entity trend + weekday forecast for ALL entities in one grouped job.

Model (ours; the original fits one series at a time with a Bayesian library
and its numbers are not claimed):
  x      = day number of ``ds``; t = days since the entity's first point
  trend  = least squares of y on x (``regr_slope`` / ``regr_intercept``)
  effect = mean residual per ISO weekday (Mon=1 .. Sun=7)
  sigma  = sample std of (residual - weekday effect), from per-weekday
           sums of squares (no second pass over the rows)
  yhat   = intercept + slope * t + effect;  band = yhat -/+ z(confidence) * sigma
An entity with fewer than two distinct days has a NULL trend and NULL
forecasts.  Work: two aggregates and one join of the rows with the
one-row-per-entity coefficients (AQE broadcasts them when measured small).
"""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators._util import entity_key

WEEKDAYS = range(1, 8)


def iso_weekday(col) -> F.Column:
    return F.weekday(col) + F.lit(1)


def training_frame(df: DataFrame, entity: str, time: str, value: str) -> DataFrame:
    """(entity, ds date, y double); order is irrelevant to the aggregates."""
    return df.select(
        F.col(entity).alias("entity"),
        F.to_date(F.col(time)).alias("ds"),
        F.col(value).cast("double").alias("y"),
    )


def fit(train: DataFrame) -> DataFrame:
    """Model table: entity, first_ds, last_ds, n, slope, intercept (at
    first_ds), sigma, effect_1 .. effect_7.

    Every aggregate and join is keyed by the same never-NULL entity key, so
    the per-entity tables share one partitioning and join without re-shuffle.
    """
    pts = train.where(F.col("y").isNotNull() & F.col("ds").isNotNull()).select(
        entity_key("entity").alias("_ek"),
        "ds",
        "y",
        F.unix_date("ds").cast("double").alias("x"),
    )
    coef = pts.groupBy("_ek").agg(
        F.min("ds").alias("first_ds"),
        F.max("ds").alias("last_ds"),
        F.count(F.lit(1)).alias("n"),
        F.regr_slope("y", "x").alias("slope"),
        F.regr_intercept("y", "x").alias("_b0"),
    )
    # one row per entity; AQE broadcasts it when its measured size is small
    res = pts.join(coef.select("_ek", "slope", "_b0"), "_ek").select(
        "_ek",
        iso_weekday("ds").alias("dow"),
        (F.col("y") - (F.col("_b0") + F.col("slope") * F.col("x"))).alias("r"),
    )
    by_day = res.groupBy("_ek", "dow").agg(
        F.avg("r").alias("effect"),
        F.count(F.lit(1)).alias("n_d"),
        F.coalesce(F.var_samp("r") * (F.count(F.lit(1)) - F.lit(1)), F.lit(0.0)).alias("ss"),
    )
    per_entity = by_day.groupBy("_ek").agg(
        F.sqrt(F.try_divide(F.sum("ss"), F.sum("n_d") - F.lit(1))).alias("sigma"),
        *[F.max(F.when(F.col("dow") == d, F.col("effect"))).alias(f"effect_{d}") for d in WEEKDAYS],
    )
    model = coef.join(per_entity, "_ek", "left")
    return model.select(
        F.col("_ek.value").alias("entity"), "first_ds", "last_ds", "n", "slope",
        (F.col("_b0") + F.col("slope") * F.unix_date("first_ds")).alias("intercept"),
        "sigma",
        *[f"effect_{d}" for d in WEEKDAYS],
    )


def z_value(confidence: float) -> float:
    """Two-sided normal quantile, e.g. 0.8 -> 1.2815515655446004."""
    return NormalDist().inv_cdf(0.5 + confidence / 2.0)


def predict(model: DataFrame, periods: int = 7, confidence: float = 0.8) -> DataFrame:
    """The ``periods`` days after each entity's last point (only the future
    rows, as the original keeps the tail of its forecast frame)."""
    z = F.lit(z_value(confidence))
    fut = model.select("*", F.explode(F.sequence(F.lit(1), F.lit(periods))).alias("h"))
    fut = fut.withColumn("ds", F.date_add("last_ds", F.col("h")))
    dow = iso_weekday("ds")
    effect = F.coalesce(
        *[F.when(dow == d, F.col(f"effect_{d}")) for d in WEEKDAYS], F.lit(0.0)
    )
    yhat = (
        F.col("intercept")
        + F.col("slope") * F.datediff("ds", "first_ds").cast("double")
        + effect
    )
    return fut.select(
        "entity", "h", "ds",
        yhat.alias("yhat"),
        (yhat - z * F.col("sigma")).alias("yhat_lower"),
        (yhat + z * F.col("sigma")).alias("yhat_upper"),
    )


def history_plus_forecast(train: DataFrame, forecast: DataFrame) -> DataFrame:
    """One labelled series: history rows (value) and forecast rows (band)."""
    hist = train.select("entity", "ds", F.col("y").alias("value"), F.lit("history").alias("series"))
    fc = forecast.select(
        "entity", "ds", F.col("yhat").alias("value"), "yhat_lower", "yhat_upper",
        F.lit("forecast").alias("series"),
    )
    return hist.unionByName(fc, allowMissingColumns=True)


def save_model(model: DataFrame, path: str) -> None:
    model.write.mode("overwrite").parquet(path)


def load_model(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
