"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tidemark.session import scratch_path


def read(spark: SparkSession, sf_dir: str, name: str, options: dict[str, str] | None = None) -> DataFrame:
    """A given table, by a path only Spark needs to understand."""
    return spark.read.options(**options or {}).parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared scratch folder and read back: cuts
    lineage, survives lost executors, and is computed once for several uses."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fold(key: Column, of: int) -> Column:
    """The fold of a row: crc32 of its key as text, modulo ``of``."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % F.lit(of)


#: Rows of a batch that are Python objects at a time, and rows of a batch: whole
#: texts are large, and each of an executor's tasks holds a batch on either side.
ROWS, BATCH_ROWS = 512, 2048
#: Places of the fixed-size filter over keys.
PLACES = 1 << 18


def split_by_keys(docs: DataFrame, keys: DataFrame, on: list[str]) -> tuple[DataFrame, DataFrame]:
    """(elsewhere, there): the rows of ``docs`` whose key surely isn't among
    ``keys``, and the rows that may have one of them.

    The filter is a table of at most PLACES hash values of keys, so it can be
    broadcast whatever the number of keys; only the second part has to be
    shuffled by key, and it gets the larger the more keys there are.
    """
    place = F.pmod(F.xxhash64(*[F.col(c).cast("string") for c in on]), F.lit(PLACES))
    places = F.broadcast(written(keys.select(place.alias("_place")).distinct(), "places"))
    rows = docs.withColumn("_place", place)
    return rows.join(places, "_place", "left_anti").drop("_place"), rows.join(places, "_place", "left_semi").drop("_place")


def small_batches(spark: SparkSession) -> None:
    """Bound the rows of the session's Arrow batches by BATCH_ROWS (a smaller
    setting stays)."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def map_columns(
    df: DataFrame,
    schema: StructType,
    make: Callable[[], Callable[[list[list]], Iterator[list[list]]]],
) -> DataFrame:
    """``mapInArrow`` over plain column lists.

    ``make`` runs once in each task and returns a function that takes the
    columns of a batch (Python lists) and yields column lists in the order of
    ``schema``; it is called with ``None`` after the last batch, for what a
    task holds back until its end.
    """

    small_batches(df.sparkSession)

    def run(batches):
        to = to_arrow_schema(schema)
        step = make()
        for batch in batches:
            # few rows at a time become Python objects; the batch itself is compact
            for at in range(0, batch.num_rows, ROWS):
                for out in step([c.slice(at, ROWS).to_pylist() for c in batch.columns]):
                    yield _batch(out, to)
        for out in step(None):
            yield _batch(out, to)
        # a worker is kept for the next task: what this one has freed goes back
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)


def slices(texts: list[str | None], most: int = 1 << 21) -> Iterator[slice]:
    """Consecutive parts of a batch with about ``most`` code points each (one
    text at least), so that what is made of them stays small."""
    first = held = 0
    for i, t in enumerate(texts):
        size = len(t) if t else 0
        if held and held + size > most:
            yield slice(first, i)
            first, held = i, 0
        held += size
    if first < len(texts):
        yield slice(first, len(texts))


def _batch(columns: list, schema: pa.Schema) -> pa.RecordBatch:
    arrays = [
        c if isinstance(c, pa.Array) else pa.array(c, type=f.type)
        for c, f in zip(columns, schema, strict=True)
    ]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)
