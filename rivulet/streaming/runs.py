"""Flows on Structured Streaming.

* :func:`route_stream` — enqueue + queue split per micro-batch (T2).
* :func:`grouped_stream` — grouped steps per micro-batch (T3). Windows over
  rows are refused on streaming DataFrames, and a grouped process of the
  reference looks at one micro-batch at a time, so the steps run inside
  ``foreachBatch`` on the batch DataFrame.
* :func:`windowed_count` — records per event-time window with a watermark
  (T5), so state for closed windows is dropped.

Writes go to ``<out>/batch_id=<i>`` with overwrite: a micro-batch that is
run again after a failure replaces its own output, so results are exactly
once although ``foreachBatch`` itself is at least once. Checkpoints and
outputs live below the session's ``spark.checkpoint.dir`` unless given.
"""

from __future__ import annotations

import time

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.keyed import GroupStep, grouped
from ..operators.routing import enqueue, write_queues
from ..operators.steps import chain
from ..session import scratch_path

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def ntz_to_instant(c) -> "F.Column":
    """NTZ wall time → TIMESTAMP at the same UTC wall time (zone independent)."""
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", F.expr(_EPOCH_NTZ), c))


def instant_to_ntz(c) -> "F.Column":
    return F.timestamp_add("MICROSECOND", F.unix_micros(c), F.expr(_EPOCH_NTZ))


def stream_table(spark: SparkSession, folder: str, table: str, schema=None,
                 max_files_per_trigger: int | None = None, fmt: str = "parquet") -> DataFrame:
    """Stream the table ``<folder>/<table>.<fmt>``: one file, or a folder of part files.

    A ``table`` with glob characters names files of ``folder`` instead.
    """
    path, opts = f"{folder.rstrip('/')}/{table}.{fmt}", {}
    if any(ch in table for ch in "*?["):
        path, opts = folder, {"pathGlobFilter": table}
    else:  # a file source streams folders: a single file is picked by name from the folder it is in
        one = spark.read.format("binaryFile").load(path).select("_metadata.file_name").first()
        if one is not None and one[0] == f"{table}.{fmt}":
            path, opts = folder, {"pathGlobFilter": f"{table}.{fmt}"}
    if schema is None:
        schema = spark.read.format(fmt).options(**opts).load(path).schema
    r = spark.readStream.format(fmt).schema(schema).options(**opts)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path)


def _start(writer, trigger: dict | None, checkpoint: str):
    return writer.option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def _exhausted(query) -> bool:
    """A bounded run has read all its input: no data left and the last batch read none."""
    progress = query.recentProgress
    return (bool(progress) and progress[-1]["numInputRows"] == 0
            and not query.status["isDataAvailable"])


def _run(query, timeout_s: float | None = None, idle_stop: bool = False):
    """Wait for a started query to end; there is no time limit unless the caller sets one.

    ``idle_stop`` is for runs with processing-time state expiry, which go on
    with clean-up batches after their input is consumed: they are stopped
    then. On timeout the query is stopped (never left running) and
    ``TimeoutError`` is raised. A micro-batch cut short by ``stop`` is not
    committed and runs again after a restart; its writes overwrite
    themselves.
    """
    if timeout_s is None and not idle_stop:
        query.awaitTermination()
    deadline = None if timeout_s is None else time.monotonic() + timeout_s
    while query.isActive:
        if query.awaitTermination(0.5):
            break
        if idle_stop and _exhausted(query):
            query.stop()
            break
        if deadline is not None and time.monotonic() > deadline:
            query.stop()
            raise TimeoutError(f"streaming query {query.id} still running after {timeout_s}s")
    if query.exception() is not None:
        raise query.exception()
    return query


def landed(stream: DataFrame, steps=(), out: str | None = None, checkpoint: str | None = None,
           trigger: dict | None = None, wait: bool = True, timeout_s: float | None = None):
    """Run record steps on a stream and land the records, one folder per micro-batch.

    Returns ``(query, out)``. What needs all records of a key in order (a
    grouped process over the whole input) runs on the landed table, so its
    result does not depend on how files were dealt to micro-batches.
    """
    spark = stream.sparkSession
    out = out or scratch_path(spark, "landed-out")
    checkpoint = checkpoint or scratch_path(spark, "landed-ckpt")
    run_steps = chain(*steps)

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        run_steps(batch).write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    q = _start(stream.writeStream.foreachBatch(per_batch), trigger, checkpoint)
    return (_run(q, timeout_s) if wait else q), out


def route_stream(stream: DataFrame, queues, out: str | None = None, steps=(), checkpoint: str | None = None,
                 trigger: dict | None = None, wait: bool = True, timeout_s: float | None = None,
                 counts_name: str | None = "routed"):
    """Run steps and routing on every micro-batch; one partitioned write per batch.

    Returns ``(query, out)``. Read all queues back with
    ``spark.read.parquet(out)`` (columns ``batch_id`` and ``spark_queue``
    come from the folder names). With ``counts_name`` the records in and
    routed out of each batch are in ``query.lastProgress['observedMetrics']``
    (K1, no extra job).
    """
    spark = stream.sparkSession
    out = out or scratch_path(spark, "route-out")
    checkpoint = checkpoint or scratch_path(spark, "route-ckpt")
    src = stream
    if counts_name:
        src = src.observe(counts_name, F.count(F.lit(1)).alias("processed"))
    run_steps = chain(*steps)

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        routed = enqueue(run_steps(batch), queues)
        write_queues(routed, f"{out}/batch_id={batch_id}")

    q = _start(src.writeStream.foreachBatch(per_batch), trigger, checkpoint)
    return (_run(q, timeout_s) if wait else q), out


def grouped_stream(stream: DataFrame, by, steps=(), order_by: str | None = None, out: str | None = None,
                   checkpoint: str | None = None, trigger: dict | None = None, wait: bool = True,
                   timeout_s: float | None = None):
    """A grouped process on each micro-batch (T3); running values restart per batch.

    Returns ``(query, out)``; ``spark.read.parquet(out)`` has every batch.
    """
    spark = stream.sparkSession
    out = out or scratch_path(spark, "group-out")
    checkpoint = checkpoint or scratch_path(spark, "group-ckpt")

    multi_pass = any(isinstance(s, GroupStep) for s in chain(*steps).steps)  # type: ignore[attr-defined]

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        # Group steps read their input more than once (boundaries, records,
        # bucket totals): keep the micro-batch instead of re-reading the source.
        src = batch.persist(StorageLevel.MEMORY_AND_DISK) if multi_pass else batch
        try:
            res = grouped(src, by, steps, order_by=order_by)
            res.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
        finally:
            if multi_pass:
                src.unpersist()

    q = _start(stream.writeStream.foreachBatch(per_batch), trigger, checkpoint)
    return (_run(q, timeout_s) if wait else q), out


def batch_window_counts(stream: DataFrame, ts_col: str, every: str = "1 hour", by=(), batch_col: str = "batch",
                        out: str | None = None, checkpoint: str | None = None, trigger: dict | None = None,
                        wait: bool = True, timeout_s: float | None = None):
    """Records per tumbling event-time window of a bounded input, whatever the order of its files (T5).

    Each micro-batch writes its own count per window (map-side partial
    aggregation, no state, nothing is late); :func:`total_window_counts`
    adds them up. Returns ``(query, out)``.
    """
    spark = stream.sparkSession
    out = out or scratch_path(spark, "count-out")
    checkpoint = checkpoint or scratch_path(spark, "count-ckpt")
    by = [by] if isinstance(by, str) else list(by)

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        counted = (batch.groupBy(F.window(F.col(ts_col), every).start.alias(batch_col), *by)
                   .agg(F.count(F.lit(1)).alias("processed")))
        counted.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    q = _start(stream.writeStream.foreachBatch(per_batch), trigger, checkpoint)
    return (_run(q, timeout_s) if wait else q), out


def total_window_counts(spark: SparkSession, out: str, by=(), batch_col: str = "batch") -> DataFrame:
    by = [by] if isinstance(by, str) else list(by)
    return spark.read.parquet(out).groupBy(batch_col, *by).agg(F.sum("processed").alias("processed"))


def windowed_count(stream: DataFrame, ts_col: str, every: str = "1 hour", delay: str = "1 hour",
                   by=(), batch_col: str = "batch", out: str | None = None,
                   checkpoint: str | None = None, trigger: dict | None = None, wait: bool = True,
                   timeout_s: float | None = None):
    """Records per tumbling event-time window of an endless stream, bounded by a watermark (T5).

    Update mode: each micro-batch writes the windows it changed with their
    running count; :func:`final_window_counts` keeps the last (largest) one.
    A record older than the watermark of the previous micro-batch (largest
    event time seen minus ``delay``) is dropped, and windows that end before
    the watermark leave the state store, so state stays bounded;
    :func:`late_records` tells how many were dropped. For an exact count of
    a bounded input use :func:`batch_window_counts`.
    NTZ event times are turned into instants at UTC wall time first
    (watermarks need TIMESTAMP) and turned back for the result.
    """
    spark = stream.sparkSession
    out = out or scratch_path(spark, "window-out")
    checkpoint = checkpoint or scratch_path(spark, "window-ckpt")
    by = [by] if isinstance(by, str) else list(by)
    is_ntz = isinstance(stream.schema[ts_col].dataType, T.TimestampNTZType)
    et = ntz_to_instant(F.col(ts_col)) if is_ntz else F.col(ts_col)
    counted = (stream.withColumn("__et", et).withWatermark("__et", delay)
               .groupBy(F.window("__et", every).alias("__w"), *by)
               .agg(F.count(F.lit(1)).alias("processed")))
    start = instant_to_ntz(F.col("__w.start")) if is_ntz else F.col("__w.start")
    counted = counted.select(start.alias(batch_col), *by, "processed")

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    q = _start(counted.writeStream.outputMode("update").foreachBatch(per_batch), trigger, checkpoint)
    return (_run(q, timeout_s) if wait else q), out


def final_window_counts(spark: SparkSession, out: str, by=(), batch_col: str = "batch") -> DataFrame:
    """The last count of each window over all micro-batches of :func:`windowed_count`."""
    by = [by] if isinstance(by, str) else list(by)
    return (spark.read.parquet(out).groupBy(batch_col, *by)
            .agg(F.max("processed").alias("processed")))


def late_records(query) -> int:
    """Records dropped behind the watermark in the micro-batches the query still remembers."""
    return sum(op.get("numRowsDroppedByWatermark", 0) for p in query.recentProgress for op in p["stateOperators"])
