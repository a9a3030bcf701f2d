"""Counts and rates.

A process without an output ends in a per-batch count. In a batch job the
batches are event-time buckets (a repeatable definition, G4); in a stream
they are micro-batches, whose counts come from ``observe`` without an extra
job (:func:`observed`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.conditions import as_condition, column
from .sequence import dense_id


def batch_count(df: DataFrame, ts_col: str, every: str = "1 hour", emitted=None,
                batch_col: str = "batch") -> DataFrame:
    """Records per time bucket: ``processed`` and, given a condition, ``emitted`` (Q1).

    The bucket is a tumbling ``window`` start, which keeps the column's
    timestamp type (NTZ stays NTZ) and does not depend on the session zone.
    Partial counts are combined map-side before the shuffle.
    """
    aggs = [F.count(F.lit(1)).alias("processed")]
    if emitted is not None:
        aggs.append(F.count_if(as_condition(emitted)).alias("emitted"))
    return (df.groupBy(F.window(column(ts_col), every).start.alias(batch_col))
              .agg(*aggs))


def throughput(df: DataFrame, key, order_col: str, ts_col: str, every: int = 100,
               block_col: str = "block") -> DataFrame:
    """Items and elapsed time per block of ``every`` records of a key.

    Block ``b`` of a key holds its records number ``b*every+1 … (b+1)*every``
    in ``order_col`` order; ``elapsed_us`` is max − min of ``ts_col``.
    """
    keys = [key] if isinstance(key, str) else list(key)
    numbered = dense_id(df.select(*map(column, [*keys, order_col, ts_col])), order_col, keys=keys, id_col="__seq")
    return (numbered
            .withColumn(block_col, F.floor((F.col("__seq") - 1) / every).cast("long"))
            .groupBy(*map(column, keys), block_col)
            .agg(F.count(F.lit(1)).alias("items"),
                 F.timestamp_diff("MICROSECOND", F.min(column(ts_col)), F.max(column(ts_col))).alias("elapsed_us")))


def observed(df: DataFrame, name: str = "processed", emitted=None):
    """``(df', Observation)``: counts gathered while ``df'`` is written, no extra job (K1)."""
    obs = Observation(name)
    aggs = [F.count(F.lit(1)).alias("processed")]
    if emitted is not None:
        aggs.append(F.count_if(as_condition(emitted)).alias("emitted"))
    return df.observe(obs, *aggs), obs
