"""Analysis context: the three top-5 lists as JSON records plus one text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.movers import top_k

# The context text around the three lists.
CONTEXT_TEMPLATE = "Largest gains: %s\nLargest losses: %s\nMost volatile: %s\n"


def _records(label: str, fields: dict[str, str]) -> F.Column:
    """JSON array of the ``label`` list's records in rank order.
    ``fields``: output name -> column of the stacked lists."""
    picked = F.collect_list(
        F.when(F.col("list") == label, F.struct("rank", *[F.col(c).alias(n) for n, c in fields.items()]))
    )
    ordered = F.transform(F.array_sort(picked), lambda x: F.struct(*[x[n].alias(n) for n in fields]))
    return F.to_json(ordered)


def top_lists(heat: DataFrame, vol: DataFrame, entity: str, change: str = "daily_change_pct",
              volatility: str = "volatility", risk: str = "risk", k: int = 5) -> DataFrame:
    """The three ranked lists stacked: list, rank, entity, metric, risk (<= 3k rows)."""
    up = top_k(heat, change, k, True, [entity], "rank", [entity, change])
    down = top_k(heat, change, k, False, [entity], "rank", [entity, change])
    hot = top_k(vol, volatility, k, True, [entity], "rank", [entity, volatility, risk])
    none = F.lit(None).cast("string")
    return (
        up.select(F.lit("gain").alias("list"), "rank", entity, F.col(change).alias("metric"),
                  none.alias("risk"))
        .unionByName(down.select(F.lit("loss").alias("list"), "rank", entity,
                                 F.col(change).alias("metric"), none.alias("risk")))
        .unionByName(hot.select(F.lit("volatile").alias("list"), "rank", entity,
                                F.col(volatility).alias("metric"), F.col(risk).alias("risk")))
    )


def currency_context(heat: DataFrame, vol: DataFrame, entity: str,
                     change: str = "daily_change_pct", volatility: str = "volatility",
                     risk: str = "risk", k: int = 5) -> DataFrame:
    """One row: gain_json, loss_json, volatile_json and the combined text.
    A single aggregate over the <= 3k stacked rows."""
    lists = top_lists(heat, vol, entity, change, volatility, risk, k)
    row = lists.agg(
        _records("gain", {entity: entity, change: "metric"}).alias("gain_json"),
        _records("loss", {entity: entity, change: "metric"}).alias("loss_json"),
        _records("volatile", {entity: entity, volatility: "metric", risk: "risk"}).alias("volatile_json"),
    )
    return row.withColumn(
        "context", F.format_string(CONTEXT_TEMPLATE, "gain_json", "loss_json", "volatile_json")
    )
