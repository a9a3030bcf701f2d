"""Keyed state across micro-batches (T4).

The reference gives every processor a context map and leaves state across
batches as a to-do. Counts and maxima per key are a streaming aggregate: it
is combined per task before the shuffle, keeps any key type, and its state
lives in the RocksDB state store below the checkpoint, so it survives
restarts and executor loss. A step with logic of its own is a
``StatefulProcessor`` run by ``transformWithStateInPandas`` on the same
store; :class:`KeyedCounter` is one, used where idle keys expire (TTL).
"""

from __future__ import annotations

import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.types import IntegralType, LongType, StringType, StructField, StructType

from ..session import ensure_state_store, scratch_path
from .runs import _run, _start

# The processor and the partial-count function run in Python workers. Ship
# this module's code with them (by value) so executors need not have the
# package installed or on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def partial_counts(key_col: str, order_col: str):
    """Per input partition: ``(key, n, last)`` — rows and largest order value per key.

    Stateless, so it runs before the shuffle of a streaming query: the
    stateful step then gets at most one row per key per partition, and a key
    holding a third of a micro-batch is combined where it was read. Grouped
    by Arrow, so keys keep their type and a null key is one key.
    """
    def fn(batches):
        import pyarrow as pa

        held = None
        for t in batches:
            t = pa.Table.from_batches([t]).select([key_col, order_col])
            t = t.append_column("n", pa.array([1] * t.num_rows, pa.int64()))
            held = pa.concat_tables([held, t]) if held is not None else t
            held = held.group_by(key_col).aggregate([(order_col, "max"), ("n", "sum")])
            held = held.select([key_col, f"{order_col}_max", "n_sum"]).rename_columns([key_col, order_col, "n"])
        if held is not None:
            yield from held.select([key_col, "n", order_col]).rename_columns([key_col, "n", "last"]).to_batches()

    return fn


class KeyedCounter(StatefulProcessor):
    """Per key: records seen so far (``n``) and the largest order value (``last``).

    Input rows are partial counts ``(key, n, last)`` (see
    :func:`partial_counts`). In update mode each key comes out once per
    micro-batch it appears in, with its totals so far.
    """

    def __init__(self, output_schema: StructType, ttl_ms: int | None = None):
        self.output_schema = output_schema
        self.ttl_ms = ttl_ms

    def init(self, handle) -> None:
        self.state = handle.getValueState("counter", StructType(self.output_schema.fields[1:]), self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues):
        n, last = self.state.get() if self.state.exists() else (0, None)
        for pdf in rows:
            n += int(pdf["n"].sum())
            for m in pdf["last"].dropna().tolist():
                last = m if last is None else max(last, m)
        if isinstance(self.output_schema["last"].dataType, IntegralType) and last is not None:
            last = int(last)
        self.state.update((n, last))
        out = pd.DataFrame({"n": [n], "last": pd.Series([last], dtype="object")})
        out.insert(0, self.output_schema.names[0], pd.Series([key[0]], dtype="object"))
        yield out

    def close(self) -> None:
        pass


def keyed_state(stream: DataFrame, by, processor: StatefulProcessor, output_schema,
                mode: str = "Update", time_mode: str = "None") -> DataFrame:
    """Apply a stateful processor per key of a streaming DataFrame (T4).

    ``time_mode="ProcessingTime"`` is needed for state TTLs and timers.
    """
    ensure_state_store(stream.sparkSession)
    by = [by] if isinstance(by, str) else list(by)
    return stream.groupBy(*by).transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=output_schema,
        outputMode=mode, timeMode=time_mode)


def keyed_counts(stream: DataFrame, key_col: str, order_col: str, out: str | None = None,
                 checkpoint: str | None = None, trigger: dict | None = None, wait: bool = True,
                 timeout_s: float | None = None, ttl_ms: int | None = None):
    """Records per key and the largest order value so far; every micro-batch's updates go to ``<out>/batch_id=<i>``.

    Without ``ttl_ms`` this is a streaming aggregate in the JVM; any key and
    order type will do. ``ttl_ms`` lets a key's state expire that long after
    its last update (processing time): the counter then runs as a
    :class:`KeyedCounter` on records combined per input partition. Either
    way the shuffle into the state store carries at most keys × partitions
    rows per micro-batch, whatever the key skew.
    """
    spark = stream.sparkSession
    ensure_state_store(spark)
    out = out or scratch_path(spark, "state-out")
    checkpoint = checkpoint or scratch_path(spark, "state-ckpt")
    few = stream.select(F.col(key_col), F.col(order_col))
    if ttl_ms is None:
        updates = few.groupBy(key_col).agg(F.count(F.lit(1)).alias("n"), F.max(order_col).alias("last"))
    else:
        # keys pass through pandas as text, where a null among integers would make them floating
        schema = StructType([StructField(key_col, StringType()), StructField("n", LongType()),
                             StructField("last", stream.schema[order_col].dataType)])
        few = few.withColumn(key_col, F.col(key_col).cast("string"))
        updates = keyed_state(few.mapInArrow(partial_counts(key_col, order_col), schema), key_col,
                              KeyedCounter(schema, ttl_ms), schema, time_mode="ProcessingTime")
        updates = updates.withColumn(key_col, F.col(key_col).cast(stream.schema[key_col].dataType))

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    q = _start(updates.writeStream.outputMode("update").foreachBatch(per_batch), trigger, checkpoint)
    return (_run(q, timeout_s, idle_stop=ttl_ms is not None) if wait else q), out


def latest_counts(spark: SparkSession, out: str, key_col: str) -> DataFrame:
    """Current state per key from the update log: the row with the largest ``n``."""
    return (spark.read.parquet(out).groupBy(key_col)
            .agg(F.max("n").alias("n"), F.max_by("last", "n").alias("last")))
