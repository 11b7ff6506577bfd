"""Session helpers.

Everything here is configuration only: the engine is Spark itself.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every tidemark job relies on.  Timestamps are naive UTC wall-clock
# values, so the session time zone is pinned; AQE re-plans joins and coalesces
# shuffle partitions at runtime and splits skewed sort-merge join partitions.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_session(
    master: str | None = None,
    app_name: str = "tidemark",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Return the active session, or build one with ``BASE_CONF``.

    ``master`` is only applied when given (a cluster submit sets it already).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(BASE_CONF)
    if shuffle_partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    # getOrCreate may return an existing session: pin the SQL settings anyway.
    for key, value in settings.items():
        if key.startswith("spark.sql."):
            spark.conf.set(key, value)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the setting names shared storage and is used as is; a
    cluster session without it is an error (a machine-local folder would not
    be shared by the executors).  Only a local-mode session without the
    setting (tests) gets a fresh folder.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: name a folder on shared storage"
            )
        current = tempfile.mkdtemp(prefix="tidemark-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    jsc = spark.sparkContext._jsc  # noqa: SLF001 - the public setter lives there
    if jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(current)
    return current


def scratch_root(spark: SparkSession) -> str:
    """This application's folder for intermediate tables, below the shared
    checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/tidemark-scratch/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder, for write/read-back
    round trips.  Never a machine-local temp folder on a cluster.  It is
    deleted by ``drop_scratch``, at the latest when the driver's Python ends."""
    root = scratch_root(spark)
    if root not in _SCRATCH:
        _SCRATCH[root] = spark.sparkContext._jvm  # noqa: SLF001 - Hadoop FileSystem API
        atexit.register(_delete, root)
    return f"{root}/{name}-{uuid.uuid4().hex}"


# folders of intermediate tables that this process made, and the JVM to ask
_SCRATCH: dict = {}


def _delete(root: str) -> None:
    jvm = _SCRATCH.pop(root, None)
    if jvm is None:
        return
    try:
        path = jvm.org.apache.hadoop.fs.Path(root)
        path.getFileSystem(jvm.org.apache.hadoop.conf.Configuration()).delete(path, True)
    except Exception:  # noqa: BLE001 - the JVM may be gone when Python ends
        pass


def drop_scratch(spark: SparkSession) -> None:
    """Delete this application's intermediate tables.  Frames that still read
    them can't be used afterwards; other applications' folders stay."""
    _delete(scratch_root(spark))


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage through a table in the shared folder, written once and read
    back.

    Survives executor loss (unlike ``localCheckpoint``), makes a result that
    feeds several outputs run once, and keeps it columnar, so that each use
    reads only its columns.
    """
    path = scratch_path(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


__all__ = [
    "BASE_CONF",
    "get_session",
    "checkpoint_dir",
    "scratch_root",
    "scratch_path",
    "drop_scratch",
    "materialize",
]
