"""Per-entity trend with changepoints: penalised regression on a hinge basis,
for all entities in one job.

Model, with u = days since the entity's first day / days of its history:

  y = intercept + slope * u + sum of change_j * max(u - c_j, 0) + effect(weekday)

The ``CHANGEPOINTS`` places c_j lie evenly in the first ``RANGE`` of the
history, as changes near its end can't be told from noise.  Changes and weekday
effects carry a ridge penalty (``PENALTY`` per row), so a trend bends only where
the rows ask for it; intercept and slope are free.

Every feature is linear in u as long as the stretch between two places and the
weekday stay the same.  So one aggregate by (entity, stretch, weekday) gives
all that the normal equations need: counts and sums of x, x*x, y and x*y, at
most 7 * (CHANGEPOINTS + 1) rows an entity whatever its history.  A hot entity
is combined on the map side.  Sums over the stretches from each place on give
every entry of the equations at once, and elimination in array functions solves
them, entity by entity: 4 ms each.  The matrix is symmetric and positive
definite, so no pivot search is needed.

Defined cases: rows without a day or value count for nothing; a NULL entity is
a series of its own; several rows of one day all count; an entity with fewer
than two different days has a NULL trend and NULL forecasts; a weekday that
never occurs has the effect 0; an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators._util import entity_key
from tidemark.operators.forecast import iso_weekday, z_value

CHANGEPOINTS = 10
#: The part of the history that holds them, as a fraction of whole numbers.
RANGE = (8, 10)
#: Ridge penalty per row on changes and weekday effects.
PENALTY = 1e-3
_SUMS = ("k", "sx", "sxx", "sy", "sxy")


def places(count: int = CHANGEPOINTS) -> list[float]:
    return [RANGE[0] * j / (RANGE[1] * count) for j in range(1, count + 1)]


def cells(train: DataFrame, count: int = CHANGEPOINTS) -> DataFrame:
    """(_ek, first_ds, last_ds, n, span, syy, tails): one row an entity; entry
    8 * j + d of ``tails`` holds count and sums over the stretches from j on and
    weekday d (0: all days); x: days since the first day."""
    pts = train.where(F.col("y").isNotNull() & F.col("ds").isNotNull()).select(
        entity_key("entity").alias("_ek"), "ds", F.col("y").cast("double").alias("y")
    )
    whole = pts.groupBy("_ek").agg(
        F.min("ds").alias("first_ds"),
        F.max("ds").alias("last_ds"),
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("y") * F.col("y")).alias("syy"),
    ).withColumn("span", F.datediff("last_ds", "first_ds"))
    x, y = F.col("x"), F.col("y")
    rows = pts.join(whole.select("_ek", "first_ds", "span"), "_ek").where("span > 0").select(
        "_ek", iso_weekday("ds").alias("dow"), "span", F.datediff("ds", "first_ds").cast("long").alias("x"), "y"
    )
    stretch = F.least(F.lit(count).cast("long"), F.expr(f"(x * {RANGE[1] * count}) div (span * {RANGE[0]})"))
    cell = rows.groupBy("_ek", stretch.alias("stretch"), "dow").agg(
        F.count(F.lit(1)).alias("k"), F.sum(x).alias("sx"), F.sum(x * x).alias("sxx"), F.sum(y).alias("sy"), F.sum(x * y).alias("sxy")
    )
    # sums over the stretches from j on, by weekday and (place 0) over all days
    until = cell.select(
        "_ek", *_SUMS, F.explode(F.sequence(F.lit(0), F.col("stretch").cast("int"))).alias("j"), "dow"
    ).select("_ek", *_SUMS, "j", F.explode(F.array(F.lit(0), "dow")).alias("d"))
    tails = until.groupBy("_ek", "j", "d").agg(*[F.sum(c).cast("double").alias(c) for c in _SUMS])
    listed = tails.groupBy("_ek").agg(
        F.map_from_entries(F.collect_list(F.struct((8 * F.col("j") + F.col("d")).alias("at"), F.struct(*_SUMS)))).alias("_tails")
    )
    nothing = F.struct(*[F.lit(0.0).alias(c) for c in _SUMS])
    tail = lambda i: F.coalesce(F.try_element_at("_tails", i), nothing)
    listed = listed.select("_ek", F.transform(F.sequence(F.lit(0), F.lit(8 * count + 7)), tail).alias("tails"))
    return whole.join(listed, "_ek", "left")


def _equations(tails: Column, n: Column, span: Column, count: int, penalty: float) -> Column:
    """Rows of the normal equations, the right side as each row's last entry.
    A feature is a + b * u on the stretches from j on and on weekday d (0: any),
    so is the product of two, and its sum follows from the sums over that part."""
    at = [(0, 0, 1.0, 0.0), (0, 0, 0.0, 1.0)]
    at += [(j + 1, 0, -c, 1.0) for j, c in enumerate(places(count))]
    at += [(0, d, 1.0, 0.0) for d in range(1, 8)]
    features = F.array(*[
        F.struct(*[F.lit(v).alias(c) for c, v in zip("ijdab", (i, *f), strict=True)]) for i, f in enumerate(at)
    ])

    def entry(p: Column, q: Column) -> Column:
        s = tails[8 * F.greatest(p["j"], q["j"]) + F.greatest(p["d"], q["d"])]
        total = (
            p["a"] * q["a"] * s["k"] + (p["a"] * q["b"] + p["b"] * q["a"]) * s["sx"] / span
            + p["b"] * q["b"] * s["sxx"] / (span * span)
        )
        apart = (p["d"] > 0) & (q["d"] > 0) & (p["d"] != q["d"])
        ridge = F.when((p["i"] == q["i"]) & (p["i"] >= 2), penalty * n).otherwise(F.lit(0.0))
        return F.when(apart, F.lit(0.0)).otherwise(total) + ridge

    def right(p: Column) -> Column:
        s = tails[8 * p["j"] + p["d"]]
        return p["a"] * s["sy"] + p["b"] * s["sxy"] / span

    return F.transform(features, lambda p: F.concat(F.transform(features, lambda q: entry(p, q)), F.array(right(p))))


def _solved(system: Column, size: int) -> Column:
    """The solution, by Gauss-Jordan elimination."""

    def step(m, k):
        pivot = m[k]

        def eliminated(row, i):
            # the factor is bound once a row, as the element of an array
            factor = F.when(i == k, F.lit(0.0)).otherwise(F.try_divide(row[k], pivot[k]))
            return F.transform(F.array(factor), lambda f: F.transform(row, lambda v, j: v - f * pivot[j]))[0]

        return F.transform(m, eliminated)

    diagonal = F.aggregate(F.sequence(F.lit(0), F.lit(size - 1)), system, step)
    return F.transform(diagonal, lambda row, i: F.try_divide(row[size], row[i]))


def fit(train: DataFrame, count: int = CHANGEPOINTS, penalty: float = PENALTY) -> DataFrame:
    """Model table: entity, first_ds, last_ds, n, span (days), intercept, slope
    (per day, before the first place), changes (of the slope per day, one for
    each place), effects (Monday first), sigma."""
    size = 2 + count + 7
    span = F.col("span").cast("double")
    whole = cells(train, count)
    # the equations are bound as the element of an array, so that no step of the
    # elimination makes them again
    solved = F.transform(
        F.array(_equations(F.col("tails"), F.col("n"), span, count, penalty)),
        lambda m: F.struct(_solved(m, size).alias("beta"), F.transform(m, lambda row: row[size]).alias("right")),
    )[0]
    model = whole.withColumn("s", F.explode(F.array(F.when(F.col("tails").isNotNull(), solved))))
    part = lambda first, n: F.slice("s.beta", first + 1, n)
    # least squares at the ridge solution: y*y - right * beta - penalty * beta^2
    fitted = F.aggregate(F.zip_with("s.beta", "s.right", lambda b, r: b * r), F.lit(0.0), lambda t, v: t + v)
    ridge = F.aggregate(part(2, size - 2), F.lit(0.0), lambda t, v: t + v * v) * penalty * F.col("n")
    return model.select(
        F.col("_ek.value").alias("entity"), "first_ds", "last_ds", "n", "span",
        F.col("s.beta")[0].alias("intercept"),
        (F.col("s.beta")[1] / span).alias("slope"),
        F.transform(part(2, count), lambda b: b / span).alias("changes"),
        part(2 + count, 7).alias("effects"),
        F.sqrt(F.try_divide(F.greatest(F.col("syy") - fitted - ridge, F.lit(0.0)), F.col("n") - 1)).alias("sigma"),
    )


def predict(model: DataFrame, periods: int = 7, confidence: float = 0.8) -> DataFrame:
    """The ``periods`` days after each entity's last one, with the columns of
    ``forecast.predict``."""
    z = F.lit(z_value(confidence))
    future = model.select("*", F.explode(F.sequence(F.lit(1), F.lit(periods))).alias("h"))
    future = future.withColumn("ds", F.date_add("last_ds", F.col("h")))
    t = F.datediff("ds", "first_ds").cast("double")
    # every place lies before the last day
    share = F.lit(RANGE[0]) / (F.lit(RANGE[1]) * F.size("changes"))
    bent = F.aggregate(
        F.transform("changes", lambda c, j: c * (t - share * (j + 1) * F.col("span"))), F.lit(0.0), lambda s, v: s + v
    )
    yhat = F.col("intercept") + F.col("slope") * t + bent + F.element_at("effects", iso_weekday("ds"))
    future = future.withColumn("yhat", yhat)
    return future.select(
        "entity", "h", "ds", "yhat",
        (F.col("yhat") - z * F.col("sigma")).alias("yhat_lower"),
        (F.col("yhat") + z * F.col("sigma")).alias("yhat_upper"),
    )
