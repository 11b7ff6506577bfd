"""Rows that every operator has to take: nulls, empty and long texts, repeats,
clashing names; and brute-force helpers."""

from __future__ import annotations

LONG = ("Some words that go on and on, with a number 17 and a name. " * 4000).strip()
ROWS = [
    (1, "The cat sat on the mat and looked at the dog for a while.", "en", "s", 10),
    (2, "The cat sat on the mat and looked at the dog for a while.", None, "s", 10),
    (2, "The cat sat on the mat and looked at the dog for a while.", None, "s", 10),
    (3, None, "en", None, None),
    (4, "", None, "t", 0),
    (None, "A row without an id has a text like any other row.", "en", "t", 5),
    (None, None, None, None, None),
    (7, LONG, "en", "t", None),
    (8, "  \n\t ", "de", "t", 3),
    (9, "é ß 中文 🙂 \x00 end", "fr", "u", 4),
]
NAMES = "key node token n m start end word text_ component lo hi row id x y a b c _id _sum _text _key _all _place host path "
EXTRA = sorted({c for c in (NAMES + "score label part block counts rank gram slot seen lattice piece value kind").split()})
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows=ROWS):
    return spark.createDataFrame(rows, SCHEMA)


def with_extra(df):
    from pyspark.sql import functions as F

    return df.withColumns({c: F.lit(f"extra {c}") for c in EXTRA})


def plain(df, *order):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def check_odd(run, spark, rows=ROWS):
    """``run`` gives the same rows with extra columns, and none for no rows."""
    got = plain(run(documents(spark, rows)))
    assert got == plain(run(with_extra(documents(spark, rows))))
    assert plain(run(documents(spark, rows).limit(0))) == []
    return got
