"""Row-lag percentage changes over keyed series (the "performance" frame).

Semantics (kept from the original pipeline):
  * series = rows of one entity ordered by time; lags count rows, not days;
  * ``prev_value`` = lag 1; ``<first>_change_pct`` = pct change vs lag 1;
  * rows without a previous value are dropped, and only THEN the further lags
    (7, 30 by default) are taken, so the first weekly value appears on an
    entity's 9th row and the first monthly value on its 32nd.

Two physical strategies, same result:
  * ``window``  - one hash exchange on the entity, one sort, two Window nodes.
                  Each entity is processed by one task; fine while the longest
                  series fits comfortably in one task.
  * ``indexed`` - for hot entities (one key may hold a large share of all
                  rows); no task ever holds a whole entity.  Spark's range
                  partitioner cuts the sort order (entity, time, ...) into
                  ranges of equal row COUNT (whatever the time distribution);
                  the ranged rows are checkpointed once.  Lags come from a
                  window over (entity, range), exact wherever the source row
                  is in the same range; only the first K rows of an entity
                  that continues from an earlier range (K = largest lag) take
                  theirs from a window that also holds copies of the K rows
                  before them.
  * ``auto``    - measures the longest series with one aggregate and picks.

Both order rows of one entity by time, ``order_extra`` and then all other
columns, so they give the same result on tied times too: rows that even this
order leaves open are equal in every column.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.numeric import pct_change
from tidemark.operators._util import entity_key
from tidemark.session import materialize

DEFAULT_FIRST_LAG = ("daily", 1)
DEFAULT_LAGS: Mapping[str, int] = {"weekly": 7, "monthly": 30}

# A series longer than this is treated as hot by ``strategy="auto"``.
HOT_SERIES_ROWS = 5_000_000
# Target rows per sorted range in the indexed strategy (used when the row
# count is known: ``auto``, or an explicit ``rows_per_bucket``).
ROWS_PER_BUCKET = 1_000_000
# Upper bound on the number of ranges.
MAX_RANGES = 200_000
# Row index inside a partition = monotonically_increasing_id & this mask
# (the partition index sits in the upper 31 bits).
_INDEX_MASK = (1 << 33) - 1


def lag_value_col(k: int) -> str:
    return f"value_lag_{k}"


def performance(
    df: DataFrame,
    entity: str,
    time: str,
    value: str,
    first_lag: tuple[str, int] = DEFAULT_FIRST_LAG,
    lags: Mapping[str, int] = DEFAULT_LAGS,
    order_extra: Sequence[str] = (),
    digits: int = 2,
    strategy: str = "auto",
    hot_series_rows: int = HOT_SERIES_ROWS,
    rows_per_bucket: int | None = None,
) -> DataFrame:
    """Add ``prev_value``, ``<first>_change_pct``, ``value_lag_<k>`` and
    ``<label>_change_pct`` columns; drop each entity's first row.

    ``order_extra`` breaks ties of ``time`` inside an entity (the original
    leaves such ties unordered), then the other columns in their order do,
    NULLs first.  ``rows_per_bucket``: target rows per sorted
    range of the ``indexed`` strategy (default: the session's shuffle
    partition count decides, raised to keep ranges near ``ROWS_PER_BUCKET``
    rows when ``auto`` has counted them).
    """
    ranges = None
    if strategy == "auto":
        longest, total = _stats(df, entity)
        strategy = "indexed" if longest > hot_series_rows else "window"
        ranges = range_count(df.sparkSession, total, rows_per_bucket or ROWS_PER_BUCKET)
    if strategy == "window":
        return _performance_window(df, entity, time, value, first_lag, lags, order_extra, digits)
    if strategy == "indexed":
        if ranges is None:
            ranges = _ranges_for(df, rows_per_bucket)
        return _performance_indexed(df, entity, time, value, first_lag, lags, order_extra, digits, ranges)
    raise ValueError(f"unknown strategy {strategy!r}")


def _stats(df: DataFrame, entity: str) -> tuple[int, int]:
    """(longest series, rows): a partial and a final aggregate over one
    column; a single small row reaches the driver."""
    per_entity = df.groupBy(entity).agg(F.count(F.lit(1)).alias("n"))
    row = per_entity.agg(F.max("n").alias("m"), F.sum("n").alias("t")).first()
    return int(row["m"] or 0), int(row["t"] or 0)


def range_count(spark, total_rows: int, rows_per_range: int) -> int:
    """Number of sorted ranges: the session's shuffle partition count, or
    more when ranges would exceed ``rows_per_range`` rows."""
    base = int(spark.conf.get("spark.sql.shuffle.partitions"))
    need = -(-max(total_rows, 1) // max(rows_per_range, 1))
    return max(1, min(MAX_RANGES, max(base, need)))


def _ranges_for(df: DataFrame, rows_per_bucket: int | None) -> int:
    """Without a target size: the shuffle partition count.  With one: count
    the rows (one small job) and size the ranges from it."""
    if rows_per_bucket is None:
        return range_count(df.sparkSession, 0, 1)
    return range_count(df.sparkSession, df.count(), rows_per_bucket)


# --------------------------------------------------------------------------
# window strategy
# --------------------------------------------------------------------------
def _order(df: DataFrame, entity: str, time: str, order_extra: Sequence[str]) -> list[Column]:
    """Time, extras, then every other column: a total order up to rows that
    are equal in all columns.  Sorting compares the later ones on ties only."""
    first = [time, *order_extra]
    rest = [c for c in df.columns if c not in first and c != entity and not c.startswith("_")]
    # maps have no order of their own: their JSON text stands in
    value = lambda c: F.to_json(c) if "map<" in df.schema[c].dataType.simpleString() else F.col(c)
    return [value(c).asc_nulls_first() for c in [*first, *rest]]


def _performance_window(df, entity, time, value, first_lag, lags, order_extra, digits):
    w = Window.partitionBy(entity).orderBy(*_order(df, entity, time, order_extra))
    label, k1 = first_lag
    out = (
        df.withColumn("prev_value", F.lag(value, k1).over(w))
        .withColumn(f"{label}_change_pct", pct_change(value, "prev_value", digits))
        .where(F.col("prev_value").isNotNull())
    )
    for name, k in lags.items():
        out = out.withColumn(lag_value_col(k), F.lag(value, k).over(w))
    for name, k in lags.items():
        out = out.withColumn(f"{name}_change_pct", pct_change(value, lag_value_col(k), digits))
    return out


# --------------------------------------------------------------------------
# indexed strategy
# --------------------------------------------------------------------------
def _ranged(keyed, key, by, ranges, value):
    """(ranged rows with ``_rg`` range and ``_ix`` index inside it, checkpointed;
    per-(entity, range) table with ``_first`` index, ``_cnt`` rows and
    ``_ncnt`` NULL values).

    Range exchange on the full sort order -> local sort -> row index inside
    the sorted range.  The range partitioner samples the sort keys, so ranges
    hold about equal row counts: a hot entity is cut into many ranges whatever
    its time distribution.  ``by`` and a row id end the sort order, so the order inside a range is total and even rows equal in every
    column can be split between ranges.  The sampled bounds depend on the
    order in which rows arrive, so the ranged rows are checkpointed once
    (shared checkpoint folder, survives executor loss)."""
    order = [F.col(key).asc(), *by, F.col("_uid").asc()]
    rows = (
        # _uid splits rows that are equal in every column, so even those
        # spread over ranges
        keyed.withColumn("_uid", F.monotonically_increasing_id())
        .repartitionByRange(ranges, *order)
        .sortWithinPartitions(*order)
        .withColumn("_rg", F.spark_partition_id())
        .withColumn("_ix", F.monotonically_increasing_id().bitwiseAND(F.lit(_INDEX_MASK)))
    )
    isnull = F.col(value).isNull().cast("long")
    rows = materialize(rows.withColumn("_isnull", isnull).drop("_uid"))
    counts = rows.groupBy(key, "_rg").agg(
        F.min("_ix").alias("_first"),
        F.count(F.lit(1)).alias("_cnt"),
        F.sum("_isnull").alias("_ncnt"),
    )
    return rows, counts


def _performance_indexed(df, entity, time, value, first_lag, lags, order_extra, digits, ranges):
    label, k1 = first_lag
    key = "_ek"
    keyed = df.withColumn(key, entity_key(entity))
    rows, counts = _ranged(keyed, key, _order(df, entity, time, order_extra), ranges, value)
    # one small job over the checkpointed rows tells which route is open
    nulls = counts.agg(F.sum("_ncnt")).first()[0] or 0
    groups = _group_table(counts, key)
    if nulls == 0:
        out = _indexed_no_nulls(rows, groups, key, value, k1, lags)
    else:
        out = _indexed_general(rows, groups, key, value, k1, lags)
    out = out.withColumn(f"{label}_change_pct", pct_change(value, "prev_value", digits))
    for name, k in lags.items():
        out = out.withColumn(f"{name}_change_pct", pct_change(value, lag_value_col(k), digits))
    cols = [c for c in df.columns] + ["prev_value", f"{label}_change_pct"]
    cols += [lag_value_col(k) for k in lags.values()] + [f"{n}_change_pct" for n in lags]
    return out.select(*dict.fromkeys(cols))


def _indexed_no_nulls(rows, groups, key, value, k1, lags):
    """No NULL values: exactly the first k1 rows of each entity are dropped,
    so the row k positions back in the filtered frame is the row k positions
    back in the full series, if that one was kept (position > k1)."""
    main = _group_lags(rows, groups, key, value, sorted({k1, *lags.values()}))
    out = main.withColumn("prev_value", F.col(f"_lag_{k1}")).where(F.col("prev_value").isNotNull())
    for k in lags.values():
        kept_before = (F.col("_pos") - F.lit(k)) > F.lit(k1)
        out = out.withColumn(lag_value_col(k), F.when(kept_before, F.col(f"_lag_{k}")))
    return out


def _indexed_general(rows, groups, key, value, k1, lags):
    """NULL values allowed: lag k1 over the full series, drop rows without a
    previous value, then the other lags over the kept rows, which are numbered
    anew inside their groups."""
    main = _group_lags(rows, groups, key, value, [k1])
    kept = main.withColumn("prev_value", F.col(f"_lag_{k1}")).where(F.col("prev_value").isNotNull())
    if not lags:
        return kept
    # the second step reads the kept rows several times: written once instead
    # of running the first step again
    grp = Window.partitionBy(key, "_rg").orderBy("_ix")
    kept = materialize(
        kept.withColumn("_ix", F.row_number().over(grp).cast("long") - 1).drop("_gc", "_off", "_pos", "_li")
    )
    counts = kept.groupBy(key, "_rg").agg(F.min("_ix").alias("_first"), F.count(F.lit(1)).alias("_cnt"))
    out = _group_lags(kept, _group_table(counts, key), key, value, list(lags.values()))
    for k in lags.values():
        out = out.withColumn(lag_value_col(k), F.col(f"_lag_{k}"))
    return out


def _group_table(counts: DataFrame, key: str) -> DataFrame:
    """Per (entity, range): ``_first`` index, ``_gc`` rows and ``_off``, the rows of
    the entity in earlier ranges.  At most one row per entity plus one per
    range; written once, for the rows, the edges and the starts all use it."""
    before = Window.partitionBy(key).orderBy("_rg").rowsBetween(Window.unboundedPreceding, -1)
    return materialize(counts.select(
        key, "_rg", "_first", F.col("_cnt").alias("_gc"), F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_off")
    ))


def _group_lags(rows: DataFrame, groups: DataFrame, key: str, value: str, ks) -> DataFrame:
    """``_lag_<k>`` = value k rows back inside the entity, for rows that carry
    ``_rg`` and ``_ix``; adds ``_pos``, the position inside the entity, too.  The
    join with the group table is keyed by (entity, range), so even a hot
    entity's rows spread over all partitions.

    A window over (entity, range) is exact whenever the source lies in the
    row's own group, or among the K (= largest k) rows before it.  Copies of
    those rows join the group: a row at position p is copied to every later
    group that begins within K rows after p, found by an equi-join on (entity,
    block of K positions).  A group gets at most K copies, so no task ever sees
    an entity's edge rows together; one window over both gives all lags, and
    the copies go again.
    """
    ks = sorted(set(ks))
    kmax = ks[-1]
    df = rows.join(groups, [key, "_rg"]).withColumn("_li", F.col("_ix") - F.col("_first") + F.lit(1))
    df = df.withColumn("_pos", F.col("_off") + F.col("_li")).drop("_first")
    # the K positions before a group touch two blocks at most
    begins = groups.where("_off > 0").select(
        F.col(key).alias("_tk"), F.col("_rg").alias("_trg"), F.col("_off").alias("_toff"),
        F.explode(F.array_distinct(F.array(
            F.floor((F.col("_off") - 1) / kmax), F.floor(F.greatest(F.col("_off") - kmax, F.lit(0)) / kmax)
        ))).alias("_tb"),
    )
    tails = df.where(F.col("_gc") - F.col("_li") < kmax).select(
        key, "_pos", value, F.floor((F.col("_pos") - 1) / kmax).alias("_b")
    )
    reached = (
        (F.col(key) == F.col("_tk")) & (F.col("_b") == F.col("_tb"))
        & (F.col("_pos") <= F.col("_toff")) & (F.col("_pos") > F.col("_toff") - kmax)
    )
    copies = tails.join(begins, reached).select(key, F.col("_trg").alias("_rg"), "_pos", value)
    both = df.withColumn("_own", F.lit(True)).unionByName(copies.withColumn("_own", F.lit(False)), allowMissingColumns=True)
    w = Window.partitionBy(key, "_rg").orderBy("_pos")
    return both.withColumns({f"_lag_{k}": F.lag(value, k).over(w) for k in ks}).where("_own").drop("_own")
