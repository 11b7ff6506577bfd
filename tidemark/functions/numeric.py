"""Numeric helpers: money decimals, percentage change, text formatting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(20,4)"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def to_money(col: Column | str) -> Column:
    """Cast to decimal(20,4) (HALF_UP rounding of the 5th decimal)."""
    return _c(col).cast(MONEY)


def to_double(col: Column | str) -> Column:
    return _c(col).cast("double")


def pct_change(current: Column | str, previous: Column | str, digits: int = 2) -> Column:
    """round((cur - prev) / prev * 100, digits), computed in double.

    A zero previous value gives NULL (``try_divide``); ANSI ``/`` would raise.
    """
    cur, prev = to_double(current), to_double(previous)
    return F.round(F.try_divide(cur - prev, prev) * F.lit(100.0), digits)


def format_pct(col: Column | str, digits: int = 2) -> Column:
    """'1.23%' style text; NULL where the figure is NULL."""
    return F.when(_c(col).isNotNull(), F.format_string(f"%.{digits}f%%", _c(col)))
