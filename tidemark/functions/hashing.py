"""Content hash of a row (the idempotency key of the silver table)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.timeparse import utc_ntz

# Fixed-width text form for timestamps inside the hash: plain ``cast`` drops
# zero microseconds, which would make the text (and the hash) depend on value.
TIMESTAMP_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def hash_text(col: Column, dtype: T.DataType | None = None) -> Column:
    """Text form of one column for hashing: typed value -> string, null -> ''."""
    if isinstance(dtype, T.TimestampNTZType):
        text = F.date_format(col, TIMESTAMP_TEXT)
    elif isinstance(dtype, T.TimestampType):
        # an instant: hash its UTC wall-clock text, whatever the session zone
        text = F.date_format(utc_ntz(col), TIMESTAMP_TEXT)
    elif isinstance(dtype, T.DateType):
        text = F.date_format(col, "yyyy-MM-dd")
    else:
        text = col.cast("string")
    return F.coalesce(text, F.lit(""))


def content_hash(columns: Sequence[str], df: DataFrame, sep: str | None = None) -> Column:
    """SHA-256 hex digest of the listed columns of ``df``, cast to text.

    By default every text is written with its length before it and a NULL as
    ``n``, so different tuples never give the same text: ('ab', 'c') and
    ('a', 'bc') differ, and so do NULL and ''.  With ``sep`` the texts are
    joined by it instead, NULL as '' (``sep=''`` is the plain concatenation of
    the original pipeline, under which different rows may collide).
    ``df`` supplies the column types: timestamps get a fixed text form.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    if sep is not None:
        return F.sha2(F.concat_ws(sep, *[hash_text(F.col(c), types[c]) for c in columns]), 256)
    parts = []
    for c in columns:
        text = hash_text(F.col(c), types[c])
        told = F.concat(F.char_length(text).cast("string"), F.lit(":"), text)
        parts.append(F.when(F.col(c).isNull(), F.lit("n")).otherwise(told))
    return F.sha2(F.concat(*parts), 256)
