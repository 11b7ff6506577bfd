"""Small DataFrame helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import functions as F


def entity_key(col: str) -> F.Column:
    """Never-NULL grouping/join key for a possibly NULL column:
    struct(is_null, value).  Struct equality matches NULL with NULL, so a
    plain equi-join on it keeps NULL entities together, and (unlike
    ``eqNullSafe``, which Spark rewrites to coalesce/isnull keys) its hash
    partitioning is the same one the group-bys and windows on it use, so
    no extra exchange is planned between them."""
    return F.struct(F.col(col).isNull().alias("is_null"), F.col(col).alias("value"))


def sort_key(col: str, descending: bool, nulls_first: bool = True):
    c = F.col(col)
    if descending:
        return c.desc_nulls_first() if nulls_first else c.desc_nulls_last()
    return c.asc_nulls_first() if nulls_first else c.asc_nulls_last()
