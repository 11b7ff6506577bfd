"""Volatility from a table of mergeable moments.

Per entity: rows, known changes, their sum, their squared distance from the
mean, the largest and the smallest.  Two tables of different rows merge by a
full join of one row an entity, so a batch costs one aggregate over the batch:
no older row is read again.

Squared distances merge by the pairwise rule (d: distance of the means, a and b
known changes: m2 = m2_a + m2_b + d*d * a*b / (a + b)), which loses nothing to
cancellation.  With ``change_digits`` the sums are decimals, so the mean is the
same whatever the batches were.

Defined cases: NaN and NULL changes count as rows only; a NULL entity is one
entity; an entity of one known change has no deviation; empty tables merge.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.classify import RISK_RULES, classify
from tidemark.operators._util import entity_key, sort_key
from tidemark.operators.profile import MEAN_SCALE, known

COLUMNS = ("rows_n", "known_n", "total", "m2", "largest", "smallest")


def moments(rows: DataFrame, entity: str, change: str = "daily_change_pct", change_digits: int | None = 2) -> DataFrame:
    """(entity, rows_n, known_n, total, m2, largest, smallest)."""
    x = known(F.col(change))
    exact = change_digits is not None and change_digits <= MEAN_SCALE
    return rows.groupBy(entity).agg(
        F.count(F.lit(1)).alias("rows_n"),
        F.count(x).alias("known_n"),
        F.sum(x.cast(f"decimal(38,{MEAN_SCALE})") if exact else x).alias("total"),
        (F.var_pop(x) * F.count(x)).alias("m2"),
        F.max(x).alias("largest"),
        F.min(x).alias("smallest"),
    )


def merge(a: DataFrame, b: DataFrame, entity: str) -> DataFrame:
    """The moments of the rows of both tables."""
    left = a.select(entity_key(entity).alias("_ek"), *[F.col(c).alias(f"a_{c}") for c in COLUMNS])
    right = b.select(entity_key(entity).alias("_ek"), *[F.col(c).alias(f"b_{c}") for c in COLUMNS])
    both = left.join(right, "_ek", "full")
    either = lambda c, zero: (F.coalesce(F.col(f"a_{c}"), F.lit(zero)), F.coalesce(F.col(f"b_{c}"), F.lit(zero)))
    (rows_a, rows_b), (n_a, n_b) = either("rows_n", 0), either("known_n", 0)
    m2_a, m2_b = either("m2", 0.0)
    apart = F.try_divide(F.col("a_total").cast("double"), n_a) - F.try_divide(F.col("b_total").cast("double"), n_b)
    between = F.coalesce(F.try_divide(apart * apart * n_a * n_b, n_a + n_b), F.lit(0.0))
    total = F.when(F.col("a_total").isNull(), F.col("b_total")).otherwise(
        F.col("a_total") + F.coalesce(F.col("b_total"), F.lit(0))
    )
    return both.select(
        F.col("_ek.value").alias(entity),
        (rows_a + rows_b).cast("long").alias("rows_n"),
        (n_a + n_b).cast("long").alias("known_n"),
        total.cast(a.schema["total"].dataType).alias("total"),
        F.when(n_a + n_b > 0, m2_a + m2_b + between).alias("m2"),
        F.greatest("a_largest", "b_largest").alias("largest"),
        F.least("a_smallest", "b_smallest").alias("smallest"),
    )


def volatility_from_moments(
    table: DataFrame,
    entity: str,
    risk=RISK_RULES,
    digits: int = 2,
    names: dict[str, str] | None = None,
    sort: bool = True,
) -> DataFrame:
    """The columns of ``profile.volatility_profile`` from the moments."""
    n = {c: c for c in ("volatility", "avg_change", "max_gain", "max_loss", "rows_tracked", "risk")} | (names or {})
    rules, default = risk
    deviation = F.when(F.col("known_n") > 1, F.sqrt(F.col("m2") / (F.col("known_n") - 1)))
    out = table.select(
        entity,
        F.round(deviation, digits).alias(n["volatility"]),
        F.round(F.try_divide("total", "known_n"), digits).cast("double").alias(n["avg_change"]),
        F.round("largest", digits).alias(n["max_gain"]),
        F.round("smallest", digits).alias(n["max_loss"]),
        F.col("rows_n").alias(n["rows_tracked"]),
    )
    out = out.withColumn(n["risk"], classify(n["volatility"], rules, default))
    if sort:
        out = out.orderBy(sort_key(n["volatility"], True), F.col(entity).asc_nulls_first())
    return out
