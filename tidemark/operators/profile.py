"""Per-entity profiles, classification tables, KPI row and hierarchy roll-up."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.classify import RISK_RULES, TIER_RULES, classify
from tidemark.functions.numeric import format_pct
from tidemark.operators._util import sort_key


# Digits of the decimal mean; changes carry 2 digits, so sums stay far below
# the 28 integer digits left.
MEAN_SCALE = 10
# What a text shows for a figure that is NULL (one row has no deviation).
NO_FIGURE = "n/a"


def known(x: F.Column) -> F.Column:
    """The one rule for NaN: it counts as missing in every figure."""
    return F.nanvl(x.cast("double"), F.lit(None).cast("double"))


def mean_of(x: F.Column, digits: int | None = None) -> F.Column:
    """Mean of a double column, as double.

    ``digits``: the number of decimal digits that all values are known to
    carry.  Then the mean is taken in decimal arithmetic, which no order of
    summation changes, and a mean on a rounding tie rounds the same way every
    time.  Without it nothing is assumed and the mean is a double one."""
    if digits is None or digits > MEAN_SCALE:
        return F.avg(known(x))
    return F.avg(known(x).cast(f"decimal(38,{MEAN_SCALE})"))


def heatmap(
    movers: DataFrame,
    entity: str,
    value: str,
    change_cols: Sequence[str] = ("daily_change_pct", "weekly_change_pct", "monthly_change_pct"),
    tier_on: str = "daily_change_pct",
    tier=TIER_RULES,
    tier_col: str = "performance_tier",
    sort: bool = True,
) -> DataFrame:
    """Entity, value, change columns and the performance tier."""
    rules, default = tier
    out = movers.select(
        entity, value, *change_cols, classify(tier_on, rules, default).alias(tier_col)
    )
    if sort:
        out = out.orderBy(sort_key(tier_on, True), F.col(entity).asc_nulls_first())
    return out


def volatility_profile(
    perf: DataFrame,
    entity: str,
    change: str = "daily_change_pct",
    risk=RISK_RULES,
    digits: int = 2,
    names: dict[str, str] | None = None,
    sort: bool = True,
    change_digits: int | None = 2,
) -> DataFrame:
    """Sample std, mean, max, min of the change (each rounded) and the row count
    per entity over the whole history, plus a risk class of the rounded std.

    Partial + final hash aggregate: a hot entity is combined map-side first.
    A one-row entity has NULL std and gets the lowest class.  NaN changes count
    as missing.  ``change_digits``: decimal digits that the changes carry
    (``performance`` rounds them to 2; None if unknown).
    """
    n = {
        "volatility": "volatility",
        "avg_change": "avg_change",
        "max_gain": "max_gain",
        "max_loss": "max_loss",
        "rows_tracked": "rows_tracked",
        "risk": "risk",
    }
    n.update(names or {})
    x = known(F.col(change))
    rules, default = risk
    out = perf.groupBy(entity).agg(
        F.round(F.stddev_samp(x), digits).alias(n["volatility"]),
        F.round(mean_of(x, change_digits), digits).cast("double").alias(n["avg_change"]),
        F.round(F.max(x), digits).alias(n["max_gain"]),
        F.round(F.min(x), digits).alias(n["max_loss"]),
        F.count(F.lit(1)).alias(n["rows_tracked"]),
    )
    out = out.withColumn(n["risk"], classify(n["volatility"], rules, default))
    if sort:
        out = out.orderBy(sort_key(n["volatility"], True), F.col(entity).asc_nulls_first())
    return out


def filter_in(df: DataFrame, col: str, allowed: Sequence[str]) -> DataFrame:
    """Set-membership filter (e.g. the risk multiselect)."""
    return df.where(F.col(col).isin(list(allowed)))


def kpi_summary(df: DataFrame, change: str = "daily_change_pct", change_digits: int | None = 2) -> DataFrame:
    """One row, one pass: row count, mean/max/min change and '%.2f%%' texts
    (``n/a`` for a figure that is NULL).  With ``change_digits`` known the mean
    is exact (decimal) and its text shows it rounded half-up."""
    x = known(F.col(change))
    row = df.agg(
        F.count(F.lit(1)).alias("entities"),
        mean_of(x, change_digits).alias("_mean"),
        F.max(x).alias("max_gain"),
        F.min(x).alias("max_loss"),
    )
    return row.select(
        "entities",
        F.col("_mean").cast("double").alias("avg_change"),
        "max_gain",
        "max_loss",
        figure(F.round("_mean", 2).cast("double")).alias("avg_change_text"),
        figure("max_gain").alias("max_gain_text"),
        figure("max_loss").alias("max_loss_text"),
    )


def rollup_tree(
    df: DataFrame,
    entity: str,
    size: str,
    color: str,
    root_label: str = "ROOT",
) -> DataFrame:
    """Two-level hierarchy root -> entity: size = sum of sizes, colour = size-
    weighted mean of the colour (rows with NULL colour carry no weight).

    ``rollup`` plans as Expand + partial/final aggregate (one shuffle).
    A decimal size is summed as a decimal (exact, independent of the
    summation order) and returned as double.
    """
    s = F.col(size).cast("double")
    c = F.col(color).cast("double")
    exact = isinstance(df.schema[size].dataType, T.DecimalType)
    total = F.sum(F.col(size)).cast("double") if exact else F.sum(s)
    agg = df.rollup(entity).agg(
        F.grouping_id().alias("level_id"),
        total.alias("size"),
        F.try_divide(F.sum(s * c), F.sum(F.when(c.isNotNull(), s))).alias("color"),
    )
    is_root = F.col("level_id") == F.lit(1)
    return agg.select(
        F.when(is_root, F.lit(root_label)).otherwise(F.col(entity).cast("string")).alias("node"),
        F.when(is_root, F.lit(None).cast("string")).otherwise(F.lit(root_label)).alias("parent"),
        F.when(is_root, F.lit(0)).otherwise(F.lit(1)).alias("depth"),
        "size",
        "color",
    )


def figure(col: F.Column | str) -> F.Column:
    """Percentage text of a figure, ``n/a`` for NULL."""
    return F.coalesce(format_pct(col), F.lit(NO_FIGURE))


def change_stats(perf: DataFrame, entity: str, change: str = "daily_change_pct",
                 change_digits: int | None = None) -> DataFrame:
    """Unrounded mean (as double), sample std, max, min of the change per
    entity.  ``change_digits``: see ``mean_of``."""
    x = known(F.col(change))
    return perf.groupBy(entity).agg(
        mean_of(x, change_digits).cast("double").alias("avg_change"),
        F.stddev_samp(x).alias("volatility"),
        F.max(x).alias("max_gain"),
        F.min(x).alias("max_loss"),
    )


# The per-entity statistics sentence; the places are the entity and its four
# figures (mean, deviation, largest, smallest).
STATS_SENTENCE = "%s: mean daily change %s, volatility %s, best day %s, worst day %s."


def stats_sentences(stats: DataFrame, entity: str, template: str = STATS_SENTENCE) -> DataFrame:
    """``change_stats`` output plus one formatted ``summary`` text per entity
    (a projection on the same aggregate, no second pass).  The mean is shown
    rounded half-up on its decimal value, so a mean on a tie (x.xx5) prints
    the same whatever the floating-point path.  A figure that is NULL, as the
    deviation of an entity with one row, shows as ``n/a``."""
    mean_2 = F.round(F.col("avg_change").cast(f"decimal(38,{MEAN_SCALE})"), 2).cast("double")
    return stats.withColumn(
        "summary",
        F.format_string(
            template,
            F.coalesce(F.col(entity).cast("string"), F.lit(NO_FIGURE)),
            figure(mean_2),
            figure("volatility"),
            figure("max_gain"),
            figure("max_loss"),
        ),
    )
