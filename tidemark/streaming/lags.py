"""Row lags as a stateful stream.

``series.performance`` looks back 1, 7 and 30 rows.  A stream needs no more of an
entity's history than its last ``KEEP`` rows, so these are its state: each
micro-batch sorts an entity's new rows behind them, reads the lags off and keeps
the last rows again.  State grows with the number of entities, not with time.

The state's rows come in time order.  A row that is not later than its entity's
last one would change lags that are already written, so it goes to a table of
late rows, from which ``gold.run_gold_incremental`` (or any later job) can take
it up; none is lost.  A row that the state holds already is a redelivery and is
dropped.

Each micro-batch writes its own folder of both tables by replacing it, so a batch
that is run again after a failure leaves its rows once.

Percentages are made from the lags by the same column functions as in batch; the
Python step only moves rows.  Defined cases: a row without a value is left out (as
silver does); a row without a time is late; a NULL entity is one entity.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidemark.functions.numeric import pct_change
from tidemark.operators import series
from tidemark.operators._util import entity_key
from tidemark.plans.silver import ENTITY, TIME, VALUE, to_silver
from tidemark.session import materialize
from tidemark.sources.snapshots import stream_snapshots
from tidemark.streaming.ingest import ROCKSDB

#: Rows of an entity that the state keeps: a row looks back 30 kept rows.
KEEP = max(series.DEFAULT_LAGS.values()) + series.DEFAULT_FIRST_LAG[1]
BATCH = "batch"


def with_lags(rows: DataFrame, entity: str = ENTITY, time: str = TIME, value: str = VALUE) -> DataFrame:
    """Of a stream of (entity, time, value): the rows with ``prev_value``, the
    lagged values, and ``late``.  Lagged values are those of
    ``series.performance``: rows without a previous value don't count."""
    ks = sorted(series.DEFAULT_LAGS.values())
    number = rows.schema[value].dataType
    text = T.StringType()
    fields = ["prev_value", *[series.lag_value_col(k) for k in ks]]
    rows = rows.where(F.col(value).isNotNull()).select(
        entity_key(entity).alias("_ek"), F.col(time).cast("string").alias("t"), F.col(value).cast("string").alias("v")
    )
    out = T.StructType(
        [T.StructField("e", rows.schema["_ek"].dataType["value"].dataType), T.StructField("t", text), T.StructField("v", text),
         *[T.StructField(c, text) for c in fields], T.StructField("late", T.BooleanType())]
    )
    # n: rows so far; the last KEEP of them as times and values
    kept = T.StructType([T.StructField("n", T.LongType()), T.StructField("ts", T.ArrayType(text)), T.StructField("vs", T.ArrayType(text))])

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        n, ts, vs = state.get if state.exists else (0, [], [])
        ts, vs, told = [*ts], [*vs], []
        new = {(t, v) for b in batches for t, v in zip(b["t"], b["v"], strict=True)} - set(zip(ts, vs, strict=True))
        empty = [None] * len(fields)
        for t, v in sorted(new, key=lambda r: (r[0] is None, r[0] or "", r[1])):
            if t is None or ts and t <= ts[-1]:
                told.append((t, v, *empty, True))
                continue
            back = lambda k, least: vs[-k] if n - k >= least else None  # noqa: B023, E731
            # the first row is not kept, so lags reach the second at most
            told.append((t, v, back(1, 0), *[back(k, 1) for k in ks], False))
            n, ts, vs = n + 1, [*ts, t][-KEEP:], [*vs, v][-KEEP:]
        state.update((n, ts, vs))
        entity_value = key[0]["value"] if isinstance(key[0], dict) else key[0][1]
        yield pd.DataFrame([(entity_value, *r) for r in told], columns=[f.name for f in out.fields])

    lagged = rows.groupBy("_ek").applyInPandasWithState(step, out, kept, "append", GroupStateTimeout.NoTimeout)
    return lagged.select(
        F.col("e").alias(entity), F.col("t").cast("timestamp_ntz").alias(time), F.col("v").cast(number).alias(value),
        *[F.col(c).cast(number).alias(c) for c in fields], "late",
    )


def stream_performance(
    spark: SparkSession,
    raw_path: str,
    performance_path: str,
    late_path: str,
    checkpoint: str,
    multiline: bool = True,
    max_files_per_trigger: int | None = None,
):
    """File stream of snapshots -> silver rows -> lags -> the performance table
    and the table of late rows, each partitioned by micro-batch.  Reads what has
    arrived (``availableNow``) and ends; the next call goes on from there."""
    rows = to_silver(stream_snapshots(spark, raw_path, multiline, max_files_per_trigger)).select(ENTITY, TIME, VALUE)
    first, _ = series.DEFAULT_FIRST_LAG
    changes = {f"{first}_change_pct": "prev_value"} | {
        f"{name}_change_pct": series.lag_value_col(k) for name, k in series.DEFAULT_LAGS.items()
    }

    def write(batch: DataFrame, epoch: int) -> None:
        batch = materialize(batch)  # the stateful step runs once for both tables
        on_time = batch.where("not late and prev_value is not null").drop("late")
        on_time = on_time.withColumns({c: pct_change(VALUE, p) for c, p in changes.items()})
        late = batch.where("late").select(ENTITY, TIME, VALUE)
        for df, path in ((on_time, performance_path), (late, late_path)):
            df.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{BATCH}={epoch}")

    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider)
    spark.conf.set(provider, ROCKSDB)  # a query keeps the settings it starts with
    try:
        q = with_lags(rows).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
        q = q.trigger(availableNow=True).start()
    finally:
        spark.conf.set(provider, before)
    q.awaitTermination()
    return q
