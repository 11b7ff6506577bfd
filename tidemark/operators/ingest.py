"""Idempotent append: keep only rows whose key is not yet in the sink.

At scale the sink is the big side.  It is partitioned by a date column.  Where
the key determines the partition (a content hash over the date does, and the
caller says so), only the partitions a batch can touch are read: the batch's
distinct dates (a small list) name the folders to open (a path-based table
opened at its root lists every file before any partition filter applies).
Otherwise a key may stand under any date and the whole sink is read.  Dynamic
partition pruning does not apply to anti joins, hence the explicit list.
The key (a SHA-256 digest) is uniformly spread, so the anti join shuffles
without skew.
"""

from __future__ import annotations

import datetime as _dt
import re
import time
import uuid
from collections.abc import Callable, Sequence
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import materialize
from tidemark.sources import ledger
from tidemark.sources.tables import write_append

# Above this many distinct dates in one batch the sink is read unpruned.
MAX_PRUNE_VALUES = 10_000
# Up to this many dates the partition folders are opened by name.
MAX_FOLDER_VALUES = 1_000
# Folder name Spark writes for a NULL partition value.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
_PLAIN = re.compile(r"^[A-Za-z0-9_.+-]+$")


def dedupe_batch(batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Duplicates inside one batch (the same payload delivered twice)."""
    return batch.dropDuplicates(list(keys))


def has_rows(df: DataFrame) -> bool:
    """Emptiness test as a ``limit 1`` job.  Appending needs none: an empty
    batch simply writes no data files."""
    return not df.isEmpty()


def _missing(e: AnalysisException) -> bool:
    cond = (e.getCondition() or "") if hasattr(e, "getCondition") else ""
    text = str(e)
    return cond in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA") or "PATH_NOT_FOUND" in text \
        or "Unable to infer schema" in text or "UNABLE_TO_INFER_SCHEMA" in text


def read_sink(spark: SparkSession, path: str) -> DataFrame | None:
    """The existing sink, or None when it does not exist yet / has no files.

    Only a missing path counts as empty; any other error propagates."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if _missing(e):
            return None
        raise


def path_exists(spark: SparkSession, path: str) -> bool:
    """One file-system call (no listing)."""
    jvm = spark.sparkContext._jvm  # noqa: SLF001 - Hadoop FileSystem API
    p = jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p))  # noqa: SLF001


def batch_partition_values(batch: DataFrame, partition_col: str,
                           max_values: int = MAX_PRUNE_VALUES) -> list | None:
    """The batch's distinct partition values (at most ``max_values``; None
    when there are more).  One small job; only the values reach the driver."""
    rows = batch.select(partition_col).distinct().limit(max_values + 1).collect()
    return None if len(rows) > max_values else [r[0] for r in rows]


def _folder_value(v) -> str | None:
    """Partition folder text of a value, or None when it is not plain."""
    if v is None:
        return NULL_PARTITION
    if isinstance(v, _dt.datetime):
        return None
    if isinstance(v, _dt.date):
        return v.isoformat()
    text = str(v)
    return text if _PLAIN.match(text) else None


def read_sink_partitions(spark: SparkSession, path: str, partition_col: str,
                         values: list | None) -> DataFrame | None:
    """The sink's rows in the given partitions, or None when none of them
    exists.  The folders that exist are opened by their paths (below
    ``basePath``), so nothing else is listed.  Values that do not map to a
    plain folder name, too many values, or a sink written by a streaming
    file sink (its ``_spark_metadata`` log, which lists the committed files,
    is honoured only by the root read) fall back to the root read with a
    partition filter: the same rows, only read another way."""
    names = None if values is None else [_folder_value(v) for v in values]
    if (names is None or len(names) > MAX_FOLDER_VALUES or any(n is None for n in names)
            or written_by_stream(spark, path)):
        existing = read_sink(spark, path)
        if existing is None or values is None:
            return existing
        return _where_in(existing, partition_col, values)
    root = path.rstrip("/")
    folders = [f"{root}/{partition_col}={n}" for n in sorted(set(names))]
    folders = [f for f in folders if path_exists(spark, f)]
    if not folders:
        return None
    try:
        return spark.read.option("basePath", root).parquet(*[_glob_escape(f) for f in folders])
    except AnalysisException as e:
        if _missing(e):
            return None
        raise


def written_by_stream(spark: SparkSession, path: str) -> bool:
    """Whether a streaming file sink keeps a log of its files at ``path``."""
    return path_exists(spark, f"{path.rstrip('/')}/_spark_metadata")


def _glob_escape(path: str) -> str:
    """Escape Hadoop glob metacharacters so a path is matched literally."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def _where_in(existing: DataFrame, partition_col: str, values: list) -> DataFrame:
    present = [v for v in values if v is not None]
    cond = F.col(partition_col).isin(present) if present else F.lit(False)
    if len(present) < len(values):
        cond = cond | F.col(partition_col).isNull()
    return existing.where(cond)


def prune_to_batch(existing: DataFrame, batch: DataFrame, partition_col: str,
                   max_values: int = MAX_PRUNE_VALUES) -> DataFrame:
    """Restrict an already opened sink to the partitions present in the batch."""
    values = batch_partition_values(batch, partition_col, max_values)
    return existing if values is None else _where_in(existing, partition_col, values)


def new_records(
    batch: DataFrame,
    existing: DataFrame | None,
    keys: Sequence[str] = ("hash_diff",),
    partition_col: str | None = None,
    key_fixes_partition: bool = False,
    max_values: int = MAX_PRUNE_VALUES,
) -> DataFrame:
    """Rows of ``batch`` whose ``keys`` are absent from ``existing`` (left anti
    join; a NULL key never matches, so such rows are always kept).

    ``key_fixes_partition``: the caller knows that rows of one key always have
    the same ``partition_col`` (a content hash over it does); only then is
    ``existing`` pruned to the batch's partitions.  Up to ``max_values`` of
    them it is; beyond, it is read in full, with the same result."""
    keys = list(keys)
    if existing is None:
        return batch
    old = existing
    if key_fixes_partition and partition_col is not None and partition_col in existing.columns:
        old = prune_to_batch(existing, batch, partition_col, max_values)
    return batch.join(old.select(*keys), keys, "left_anti")


def append_new(
    spark: SparkSession,
    batch: DataFrame,
    path: str,
    keys: Sequence[str] = ("hash_diff",),
    partition_col: str | None = None,
    dedupe: bool = True,
    cluster_by: Sequence[str] = (),
    key_fixes_partition: bool = False,
    partition_values: Callable[[], list] | None = None,
) -> None:
    """dropDuplicates -> anti join against the sink -> append.

    Replaying a batch is harmless: its keys are already in the sink.  The sink
    is read in full unless ``key_fixes_partition`` (see ``new_records``) allows
    to read the batch's partitions only; ``partition_values`` names them from
    a cheaper source than the batch (called only if the sink exists), else a
    job over the batch's partition column does.  Nothing is cached.

    Rows are clustered by the partition column before writing so each task
    writes few files; the ``rebalance`` hint lets AQE split a hot date over
    several tasks instead of one.  ``cluster_by`` sorts each written file by
    these columns after the partition column (the writer sorts by the partition
    column anyway), so equality filters on them skip row groups on read.
    Single writer assumed (two concurrent writers could both append).  A sink
    that a streaming file sink writes is refused: readers of it see only the
    files in the stream's log, so appended rows would be invisible.
    """
    keys = list(keys)
    if written_by_stream(spark, path):
        raise ValueError(f"{path} is written by a streaming file sink (_spark_metadata): "
                         "rows appended beside it would not be read; use another table")
    todo = dedupe_batch(batch, keys) if dedupe else batch
    old = None
    if path_exists(spark, path):
        if partition_col is not None and key_fixes_partition:
            values = partition_values() if partition_values else batch_partition_values(batch, partition_col)
            old = read_sink_partitions(spark, path, partition_col, values)
        else:
            old = read_sink(spark, path)
    out = todo if old is None else todo.join(old.select(*keys), keys, "left_anti")
    if partition_col is not None:
        out = out.hint("rebalance", partition_col)
    order = ([partition_col] if partition_col else []) + list(cluster_by)
    if cluster_by:
        out = out.sortWithinPartitions(*[F.col(c).asc_nulls_first() for c in order])
    write_append(out, path, partition_by=[partition_col] if partition_col else ())


#: Seconds that a writer waits for another, and after which a writer that has not
#: come to its end counts as dead.
WAIT, LEASE = 3600.0, 900.0


@contextmanager
def one_writer(spark: SparkSession, path: str, wait: float = WAIT, lease: float = LEASE):
    """Only one job at a time is inside this block for a sink.  The right to write
    is a note beside the sink's files, made only where there is none; the file
    system lets one job make it.  A note older than ``lease`` seconds is its
    writer's who died, and is removed: appends in the block have to be shorter.
    Yields a function that ends the job if the right was lost meanwhile."""
    folder, owner = f"{path.rstrip('/')}/_writer", uuid.uuid4().hex
    until = time.time() + wait
    while not ledger.claim(spark, folder, "now", f"{owner} {time.time()}"):
        held = ledger.notes(spark, folder).get("now", "").split()
        if len(held) == 2 and float(held[1]) < time.time() - lease:
            ledger.remove(spark, folder, "now")
        elif time.time() > until:
            raise TimeoutError(f"another job writes to {path}")
        else:
            time.sleep(0.05)

    def still_mine() -> None:
        if not ledger.notes(spark, folder).get("now", "").startswith(owner):
            raise RuntimeError(f"the right to write to {path} was lost: nothing is appended")

    try:
        yield still_mine
    finally:
        if ledger.notes(spark, folder).get("now", "").startswith(owner):
            ledger.remove(spark, folder, "now")


def append_new_shared(
    spark: SparkSession,
    batch: DataFrame,
    path: str,
    keys: Sequence[str] = ("hash_diff",),
    partition_col: str | None = None,
    key_fixes_partition: bool = False,
    wait: float = WAIT,
    lease: float = LEASE,
    **kw,
) -> None:
    """``append_new`` for a sink that several jobs append to.

    The batch is compared with the sink first, without holding anyone up, and
    what is new is written aside.  Then, as the only writer, that is compared
    again with what others have appended meanwhile (only the batch's partitions
    where the key fixes them) and appended.  Of rows that several jobs bring, one
    is kept, whoever comes first.
    """
    keys = list(keys)
    old = read_sink(spark, path) if path_exists(spark, path) else None
    new = new_records(dedupe_batch(batch, keys), old, keys, partition_col, key_fixes_partition)
    new = materialize(new.select(*batch.columns))
    with one_writer(spark, path, wait, lease) as still_mine:
        still_mine()
        append_new(spark, new, path, keys, partition_col, dedupe=False, key_fixes_partition=key_fixes_partition, **kw)


def new_records_bucketed(batch: DataFrame, table: str, keys: Sequence[str] = ("hash_diff",)) -> DataFrame:
    """Rows of ``batch`` whose keys are absent from a bucketed sink
    (``sources.tables.write_bucketed``): the batch is dealt to the sink's buckets
    and each bucket is joined where it lies, so nothing of the sink is shuffled,
    however large it is.  The batch is never broadcast against it."""
    keys = list(keys)
    sink = batch.sparkSession.table(table).select(*keys)
    return batch.join(sink.hint("merge"), keys, "left_anti")
