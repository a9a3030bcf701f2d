"""Run a whole flow on a stream (T1 with R1–R5, G1, K1, K3).

``build`` turns named source DataFrames into a :class:`~rivulet.plans.flow.Flow`;
the same function builds the batch flow and the streaming one. The stream
runs as **one** query: every micro-batch is handed to ``build`` as a static
DataFrame (so grouped steps with windows work, T3), each requested name is
written to ``<path>/batch_id=<i>`` with overwrite (a retried batch replaces
itself), and terminal processes log their record count per batch
(``<counts>/batch_id=<i>``). The batch is persisted once and released after
the writes, so the sources are read once per micro-batch.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.flow import Flow
from ..session import scratch_path
from .runs import _run, _start


_SOURCE = "__source"


def _united(streams: dict[str, DataFrame]) -> DataFrame:
    """Several streams as one: each record in a struct column named after its source."""
    out = None
    for name, df in streams.items():
        one = df.select(F.lit(name).alias(_SOURCE), F.struct("*").alias(name))
        out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    return out


def run_flow(build: Callable[[dict[str, DataFrame]], Flow], streams: dict[str, DataFrame],
             sinks: dict[str, str], counts: str | None = None, checkpoint: str | None = None,
             trigger: dict | None = None, wait: bool = True, timeout_s: float | None = None):
    """Start the flow over its streaming sources; returns the streaming query.

    ``streams`` maps source names to streaming DataFrames; any number of
    sources run in one query, so processes may read several of them.
    ``sinks`` maps flow names (process outputs or queues) to output folders.
    ``counts`` is the folder for per-batch terminal counts (default: none).
    """
    spark = next(iter(streams.values())).sparkSession
    checkpoint = checkpoint or scratch_path(spark, "flow-ckpt")

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        # Several sinks, sources or counts read the batch again, and so do group steps: keep it.
        src = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            flow = build({name: src.where(F.col(_SOURCE) == name).select(f"`{name}`.*") for name in streams})
            for name, path in sinks.items():
                flow[name].write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
            if counts and flow.terminals:
                flow.count_table().write.mode("overwrite").parquet(f"{counts}/batch_id={batch_id}")
        finally:
            src.unpersist()

    q = _start(_united(streams).writeStream.foreachBatch(per_batch), trigger, checkpoint)
    return _run(q, timeout_s) if wait else q


def read_sink(spark: SparkSession, path: str) -> DataFrame:
    """All micro-batches of one sink (``batch_id`` is a column from the folder names)."""
    return spark.read.parquet(path)


def total_counts(spark: SparkSession, counts: str) -> DataFrame:
    """Terminal counts over all micro-batches."""
    return spark.read.parquet(counts).groupBy("process").agg(F.sum("processed").alias("processed"))
