"""Forecast bands from rolling-origin errors, for all entities in one job.

A band of constant width (``forecast.predict``) says nothing of how errors grow
with the horizon.  Here the trend + weekday model is fitted again at every day
of an entity's recent history (the origins), from the rows up to that day only,
and its forecasts 1 to ``HORIZON`` days ahead are compared with what came.  The
band of step h is the quantile of the absolute errors at that step, never
narrower than the band of the step before.

No fit reads the history again: one window holds running sums of 1, x, x*x, y
and x*y and, for each weekday, of 1, x and y; each origin's model follows from
its row.  Errors meet their actual values by an equi-join on (entity, day).

A forecast starts where the series stands: the mean error of the model on the
last ``RECENT`` days is added to it.  Quotes wander, and a line through the whole
history may be far from the last ones; errors of forecasts that start there are
those of the wandering alone, which grow with the horizon and keep their size
over time, so that the past ones tell the next.

The quantile is the conformal one, the ceil((m + 1) * confidence)-th smallest of
m errors (the largest where that is more than m), so the stated confidence is
kept on average also for few errors.

Defined cases: rows without a day or value count for nothing; a NULL entity is
a series of its own; several rows of one day count each; days without a row have
no error; origins need ``MIN_ROWS`` rows and two days; an entity without
origins takes the forecast and the normal band of ``forecast.predict``; an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators import forecast
from tidemark.operators._util import entity_key

#: Steps ahead, rows that an origin needs, days of origins, and days (that have
#: rows) whose mean error starts a forecast.
HORIZON, MIN_ROWS, ORIGIN_DAYS, RECENT = 7, 14, 365, 7


def _points(train: DataFrame) -> DataFrame:
    return train.where(F.col("y").isNotNull() & F.col("ds").isNotNull()).select(
        entity_key("entity").alias("_ek"), "ds", F.col("y").cast("double").alias("y")
    )


def paths(train: DataFrame, horizon: int = HORIZON, min_rows: int = MIN_ROWS, origin_days: int = ORIGIN_DAYS,
          recent: int = RECENT) -> DataFrame:
    """(_ek, origin, last, h, ds, yhat): the forecasts from every origin;
    ``last``: the entity's last day, itself an origin."""
    pts = _points(train)
    # a day's rows go together, so a window holds one row a day
    days = pts.groupBy("_ek", "ds").agg(F.count(F.lit(1)).cast("double").alias("k"), F.sum("y").alias("y"))
    whole = Window.partitionBy("_ek")
    days = days.withColumns({"_from": F.min("ds").over(whole), "_to": F.max("ds").over(whole)})
    days = days.withColumns({"x": F.datediff("ds", "_from").cast("double"), "dow": forecast.iso_weekday("ds")})
    so_far = whole.orderBy("ds").rowsBetween(Window.unboundedPreceding, 0)
    x, k, y = F.col("x"), F.col("k"), F.col("y")
    sums = {"n": k, "sx": k * x, "sxx": k * x * x, "sy": y, "sxy": x * y}
    running = {c: F.sum(v).over(so_far) for c, v in sums.items()}
    for d in forecast.WEEKDAYS:
        on = F.col("dow") == d
        for c in ("n", "sx", "sy"):
            running[f"{c}_{d}"] = F.sum(F.when(on, sums[c]).otherwise(0.0)).over(so_far)
    lately = whole.orderBy("ds").rowsBetween(1 - recent, 0)
    near = {f"r{c}": F.sum(sums[c]).over(lately) for c in ("n", "sx", "sy")}
    near |= {f"rn_{d}": F.sum(F.when(F.col("dow") == d, k).otherwise(0.0)).over(lately) for d in forecast.WEEKDAYS}
    origins = (
        days.withColumns(running | near)
        .where((F.col("n") >= min_rows) & (F.col("ds") > F.date_sub("_to", origin_days)))
        .withColumn("slope", F.try_divide(
            F.col("n") * F.col("sxy") - F.col("sx") * F.col("sy"), F.col("n") * F.col("sxx") - F.col("sx") * F.col("sx")))
        .where(F.col("slope").isNotNull())
    )
    mean = (F.col("sy") - F.col("slope") * F.col("sx")) / F.col("n")
    by_day = F.array(*[
        F.coalesce(F.try_divide(F.col(f"sy_{d}") - F.col("slope") * F.col(f"sx_{d}"), F.col(f"n_{d}")), mean)
        for d in forecast.WEEKDAYS
    ])
    usual = sum((F.col(f"rn_{d}") * F.element_at("level", d) for d in forecast.WEEKDAYS), F.lit(0.0))
    start = (F.col("rsy") - F.col("slope") * F.col("rsx") - usual) / F.col("rn")
    origins = origins.withColumn("level", by_day).withColumn("start", start)
    ahead = origins.select(
        "_ek", F.col("ds").alias("origin"), F.col("_to").alias("last"), "x", "slope", "level", "start",
        F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("h"),
    ).withColumn("ds", F.date_add("origin", F.col("h")))
    level = F.element_at("level", forecast.iso_weekday("ds"))
    yhat = level + F.col("slope") * (F.col("x") + F.col("h")) + F.col("start")
    return ahead.select("_ek", "origin", "last", "h", "ds", yhat.alias("yhat"))


def errors(found: DataFrame, train: DataFrame) -> DataFrame:
    """(entity, origin, h, ds, y, yhat) of every forecast of ``paths`` for a day
    that has a row."""
    return found.drop("last").join(_points(train), ["_ek", "ds"]).select(
        F.col("_ek.value").alias("entity"), "origin", "h", "ds", "y", "yhat"
    )


def widths(found: DataFrame, confidence: float = 0.8) -> DataFrame:
    """(entity, h, errors, width): half the band of each step."""
    level = F.least(F.col("errors"), F.ceil((F.col("errors") + 1) * F.lit(confidence)).cast("int"))
    per_step = (
        found.groupBy(entity_key("entity").alias("_ek"), "h")
        .agg(F.sort_array(F.collect_list(F.abs(F.col("y") - F.col("yhat")))).alias("_sizes"))
        .withColumn("errors", F.size("_sizes"))
        .withColumn("_own", F.element_at("_sizes", level))
    )
    until = Window.partitionBy("_ek").orderBy("h").rowsBetween(Window.unboundedPreceding, 0)
    return per_step.select(F.col("_ek.value").alias("entity"), "h", "errors", F.max("_own").over(until).alias("width"))


def banded(plain: DataFrame, found: DataFrame, steps: DataFrame) -> DataFrame:
    """(entity, h, ds, yhat, yhat_lower, yhat_upper): the forecasts of ``paths``
    from each entity's last day with the bands of ``widths``; where there is
    none, the row of ``plain`` (``forecast.predict``, same steps)."""
    plain = plain.withColumn("_ek", entity_key("entity"))
    ahead = found.where("origin = last").select("_ek", "h", F.col("yhat").alias("_yhat"))
    steps = steps.select(entity_key("entity").alias("_ek"), "h", "width")
    both = plain.join(ahead, ["_ek", "h"], "left").join(steps, ["_ek", "h"], "left")
    yhat = F.coalesce("_yhat", "yhat")
    width = F.coalesce("width", F.col("yhat_upper") - F.col("yhat"))
    return both.select(
        "entity", "h", "ds", yhat.alias("yhat"), (yhat - width).alias("yhat_lower"), (yhat + width).alias("yhat_upper")
    )


def coverage(found: DataFrame, since, confidence: float = 0.8) -> DataFrame:
    """(h, tried, covered): bands from the errors known before ``since`` (a day
    or a column of it), held against the errors of origins from then on."""
    since = F.lit(since) if not isinstance(since, F.Column) else since
    known = widths(found.where(F.col("ds") < since), confidence).select(entity_key("entity").alias("_ek"), "h", "width")
    later = found.where(F.col("origin") >= since).withColumn("_ek", entity_key("entity")).drop("entity")
    inside = F.abs(F.col("y") - F.col("yhat")) <= F.col("width")
    return later.join(known, ["_ek", "h"]).groupBy("h").agg(
        F.count(F.lit(1)).alias("tried"), F.count_if(inside).alias("covered")
    )
