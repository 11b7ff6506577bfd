"""Projections and wide -> long reshaping."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.timeparse import utc_ntz


def columns_except(df: DataFrame, excluded: Sequence[str]) -> list[str]:
    """All columns but ``excluded`` (resolved at plan time from the schema)."""
    drop = set(excluded)
    return [c for c in df.columns if c not in drop]


def unnest_struct(df: DataFrame, struct_col: str, keep: bool = False) -> DataFrame:
    """Lift the fields of a struct column to top-level columns."""
    others = [c for c in df.columns if keep or c != struct_col]
    return df.select(*others, f"{struct_col}.*")


def unpivot_wide(
    df: DataFrame,
    ids: Sequence[str],
    values: Sequence[str] | None = None,
    variable_name: str = "variable",
    value_name: str = "value",
) -> DataFrame:
    """Wide -> long; ``values=None`` takes every non-id column.

    Value columns of different numeric types are widened to a common type
    (e.g. an integer rate next to doubles becomes double)."""
    vals = list(values) if values is not None else columns_except(df, ids)
    types = {df.schema[c].dataType for c in vals}
    if len(types) > 1 and all(isinstance(t, T.NumericType) for t in types):
        df = df.select(*ids, *[F.col(c).cast("double").alias(c) for c in vals])
    return df.unpivot(list(ids), vals, variable_name, value_name)


def explode_map(
    df: DataFrame,
    map_col: str,
    key_name: str = "key",
    value_name: str = "value",
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """One row per map entry: (keep..., key, value).  Used for the JSON
    snapshot whose rates object is read as ``map<string,double>``, so a new
    key needs no schema change."""
    kept = list(keep) if keep is not None else [c for c in df.columns if c != map_col]
    return df.select(*kept, F.explode(F.col(map_col)).alias(key_name, value_name))


def json_map_rows(
    df: DataFrame,
    json_col: str,
    value_type: str = "double",
    key_name: str = "key",
    value_name: str = "value",
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """JSON object text -> map -> one row per member that is a ``value_type``
    (or null).  Members that aren't, and documents that can't be read, are left
    out; ``json_map_checked`` reports them."""
    checked = json_map_checked(df, json_col, value_type, key_name, value_name, keep)
    return checked.where("not rejected").drop("text", "rejected")


def json_map_checked(
    df: DataFrame,
    json_col: str,
    value_type: str = "double",
    key_name: str = "key",
    value_name: str = "value",
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Like ``json_map_rows``, but nothing is lost silently: one row per member
    with its text, and ``rejected`` true where the text is no ``value_type``
    (value NULL), or where the whole document can't be read (key NULL, the
    document as text).  A JSON null member is a valid NULL; a NULL document
    and an empty object have no rows."""
    kept = list(keep) if keep is not None else [c for c in df.columns if c != json_col]
    # parsed in a step of its own: it is used twice, and an explode of the
    # expression would parse again
    parsed = df.select(*kept, F.col(json_col).alias("_text"), F.from_json(F.col(json_col), "map<string,string>").alias("_map"))
    # a text that is no object parses to NULL: it is kept as one rejected entry
    whole = F.create_map(F.lit("").cast("string"), F.col("_text"))
    unread = F.col("_text").isNotNull() & F.col("_map").isNull()
    rows = parsed.select(*kept, unread.alias("_unread"), F.explode(F.when(unread, whole).otherwise(F.col("_map"))).alias("_k", "_t"))
    value = F.col("_t").try_cast(value_type)
    return rows.select(
        *kept,
        F.when(~F.col("_unread"), F.col("_k")).alias(key_name),
        F.when(~F.col("_unread"), value).alias(value_name),
        F.col("_t").alias("text"),
        (F.col("_unread") | (F.col("_t").isNotNull() & value.isNull())).alias("rejected"),
    )


def with_constants(df: DataFrame, constants: Mapping[str, object]) -> DataFrame:
    """Append literal lineage columns, e.g. {'type_src': 'api'}."""
    return df.withColumns({k: F.lit(v) for k, v in constants.items()})


def with_load_time(df: DataFrame, name: str = "load_date_src") -> DataFrame:
    """Load timestamp: one value per query (naive UTC)."""
    return df.withColumn(name, utc_ntz(F.current_timestamp()))


def project(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """select + rename in one step: {new_name: source_column}."""
    return df.select(*[F.col(src).alias(dst) for dst, src in mapping.items()])
