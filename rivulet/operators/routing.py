"""Queues: conditional copies of records under a label.

A queue is a label column, ``spark_queue``. :func:`enqueue` builds, in one
projection over one scan, the array of queue names whose condition holds
and explodes it: a record matching two queues becomes two rows, one
matching none is not emitted (or, with ``pass_through``, is emitted once
with a null label — R5). :func:`split_queue` is the per-queue filter (R4);
:func:`write_queues` is the one partitioned write with a folder per queue
(K3), so all queues of a process cost one pass over the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.conditions import as_condition

QUEUE_COL = "spark_queue"


def _as_pairs(queues) -> list[tuple[str, object]]:
    if isinstance(queues, dict):
        return list(queues.items())
    return [(q, c) for q, c in queues]


def queue_labels(queues) -> "F.Column":
    """Array of the names whose condition holds (nulls removed)."""
    pairs = _as_pairs(queues)
    if not pairs:
        return F.array().cast("array<string>")
    return F.array_compact(F.array(*[F.when(as_condition(c), F.lit(q)) for q, c in pairs]))


def enqueue(df: DataFrame, queues, pass_through: bool = False, label_col: str = QUEUE_COL) -> DataFrame:
    """Send a copy of each record to every queue whose condition is true.

    ``queues``: ``{name: condition}`` or a list of pairs (the same name may
    appear twice, e.g. two enqueue steps into one queue: a record then goes
    there once per true condition, as two enqueue steps would send it).
    ``pass_through=True`` also emits the record itself with a null label (R5).
    """
    labels = queue_labels(queues)
    if pass_through:
        labels = F.concat(F.array(F.lit(None).cast("string")), labels)
    return df.withColumn(label_col, F.explode(labels))


def split_queue(df: DataFrame, queue: str, label_col: str = QUEUE_COL) -> DataFrame:
    """The records of one queue, label dropped."""
    return df.where(F.col(label_col) == F.lit(queue)).drop(label_col)


def passed(df: DataFrame, label_col: str = QUEUE_COL) -> DataFrame:
    """The pass-through records of an enqueue with ``pass_through=True``."""
    return df.where(F.col(label_col).isNull()).drop(label_col)


def write_queues(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                 label_col: str = QUEUE_COL) -> None:
    """All queues in one write, one folder ``spark_queue=<name>`` per queue (K3).

    No shuffle: each task writes at most one file per queue (the writer
    sorts its own rows by label). Clustering by label first would send a
    whole queue to one task.
    """
    (df.where(F.col(label_col).isNotNull())
       .write.mode(mode).format(fmt).partitionBy(label_col).save(path))


def read_queue(spark, path: str, queue: str, fmt: str = "parquet", label_col: str = QUEUE_COL) -> DataFrame:
    """One queue back from :func:`write_queues` output (partition pruning on the label)."""
    return split_queue(spark.read.format(fmt).load(path), queue, label_col)
