"""Latest-snapshot movers and ranked top-K lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators._util import sort_key


def latest_time(df: DataFrame, time: str):
    """Global max of ``time`` as a scalar-subquery Column (stays in the plan)."""
    return df.select(F.max(time)).scalar()


def latest_snapshot(df: DataFrame, time: str) -> DataFrame:
    """Rows at the global latest ``time``; entities lacking it are absent."""
    return df.where(F.col(time) == latest_time(df, time))


def entity_history(df: DataFrame, entity: str, key) -> DataFrame:
    """One entity's rows; the equality reaches the Parquet scan as a pushed filter."""
    return df.where(F.col(entity) == F.lit(key))


def top_k(
    df: DataFrame,
    by: str,
    k: int = 10,
    descending: bool = True,
    tiebreak: Sequence[str] = (),
    rank_col: str | None = "rank",
    columns: Sequence[str] | None = None,
    nulls_first: bool = True,
) -> DataFrame:
    """First ``k`` rows by ``by`` (NULLs first, as the original library sorts),
    ties broken by ``tiebreak`` ascending, with a 1-based ``rank``.

    ``orderBy(...).limit(k)`` plans as ``TakeOrderedAndProject``: each task
    keeps its own k best rows; the rank is numbered on those k rows only.
    """
    keys = [sort_key(by, descending, nulls_first)] + [F.col(c).asc_nulls_first() for c in tiebreak]
    best = df.orderBy(*keys).limit(k)
    if rank_col:
        # single-partition window, but over at most k rows
        best = best.withColumn(rank_col, F.row_number().over(Window.orderBy(*keys)))
    if columns is not None:
        cols = ([rank_col] if rank_col else []) + [c for c in columns if c != rank_col]
        best = best.select(*cols)
    return best


def gainers(df, by, entity, k=10, columns=None, rank_col="rank"):
    return top_k(df, by, k, True, [entity], rank_col, columns)


def losers(df, by, entity, k=10, columns=None, rank_col="rank"):
    return top_k(df, by, k, False, [entity], rank_col, columns)
