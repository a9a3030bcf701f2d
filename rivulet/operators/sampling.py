"""One pass over a table: its row count and a bounded, weighted sample.

Every task keeps a bounded number of its rows, chosen at random, each
standing for the same share of the task's rows; a few tasks thin them out to
a bounded total, whatever the number of tasks. The generators depend only on
the partition, so a retried task keeps the same rows.
"""

from __future__ import annotations

import sys
from functools import partial

import numpy as np
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The functions run in Python workers: ship their code by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PER_TASK = 4096
MERGERS = 4
PER_MERGER = 25_000

_WEIGHT = "__rv_weight"
_TASK = "__rv_task"


def _kept(batches, size: int):
    """Rows of one task → a random sample of at most ``size``, with the number of rows each stands for.

    Batches are gathered until they hold a few times ``size`` rows, then
    thinned to the ``size`` rows with the smallest random numbers so far.
    """
    import pyarrow as pa

    rng, held, ranks, n = np.random.default_rng(TaskContext.get().partitionId()), None, np.empty(0), 0
    for t in batches:
        n += t.num_rows
        t, r = pa.Table.from_batches([t]), rng.random(t.num_rows)
        if len(ranks) >= size:  # only rows below the largest kept number can get in
            few = np.flatnonzero(r < ranks.max())
            t, r = t.take(few), r[few]
        held, ranks = (t if held is None else pa.concat_tables([held, t])), np.concatenate([ranks, r])
        if len(ranks) > size:
            few = np.sort(np.argpartition(ranks, size)[:size])
            held, ranks = held.take(few), ranks[few]
    if n:
        m = len(ranks)
        held = held.append_column(_WEIGHT, pa.array(np.full(m, n / m)))
        held = held.append_column(_TASK, pa.array(np.full(m, TaskContext.get().partitionId()), pa.int32()))
        yield from held.combine_chunks().to_batches()


def _thinned(batches, size: int):
    """Weighted rows → at most ``size`` of equal weight, at even steps of the running weight."""
    import pyarrow as pa

    rows = [pa.Table.from_batches([t]) for t in batches]
    if not rows:
        return
    t = pa.concat_tables(rows)
    if t.num_rows > size:
        w = t.column(_WEIGHT).to_numpy()
        rng = np.random.default_rng(t.num_rows)
        order = rng.permutation(t.num_rows)
        ends = np.cumsum(w[order])
        total = w.sum()
        picked = order[np.searchsorted(ends, (np.arange(size) + rng.random()) * total / size).clip(0, len(order) - 1)]
        t = t.take(np.sort(picked)).drop_columns([_WEIGHT]).append_column(_WEIGHT, pa.array(np.full(size, total / size)))
        t = t.select([f.name for f in rows[0].schema])
    yield from t.combine_chunks().to_batches()


def sampled(df: DataFrame):
    """``(rows, pandas frame)``: the row count, and a sample with the weight of each row as its last column."""
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    schema = f"{kinds}, {_WEIGHT} double, {_TASK} int"
    few = df.mapInArrow(partial(_kept, size=PER_TASK), schema)
    few = few.repartition(MERGERS, _TASK).mapInArrow(partial(_thinned, size=PER_MERGER), schema)
    out = few.toPandas().drop(columns=_TASK).rename(columns={_WEIGHT: "weight"})
    return int(round(out["weight"].sum())), out
