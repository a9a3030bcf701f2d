"""Processing by key and reference lookups.

A grouped process in a record flow hands the records of each key, one by
one, to the same steps, and emits the records (not one row per key).
For steps that look at one record only, grouping changes nothing, so no
shuffle is made. Steps that look *along* the group (running numbers and
sums, G1) are :class:`GroupStep`s; they use the segmented scan of
:mod:`.sequence`, so a key holding a third of the rows is still spread
over many tasks. A null key is one group (G3).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.conditions import column
from .sequence import dense_id, running_values
from .steps import chain


class GroupStep:
    """A step that needs the group key and order of its process."""

    def __init__(self, fn):
        self.fn = fn

    def __call__(self, df: DataFrame, keys=(), order_by: str | None = None, tasks: int | None = None) -> DataFrame:
        return self.fn(df, list(keys), order_by, tasks)


def running(aggs: dict) -> GroupStep:
    """Running values along the group, e.g. ``{"seen": "count", "total": ("sum", "value")}``."""

    def fn(df, keys, order_by, tasks=None):
        if order_by is None:
            raise ValueError("running values need order_by on the grouped process")
        return running_values(df, keys, order_by, aggs, tasks=tasks)

    return GroupStep(fn)


def number(id_col: str = "seq") -> GroupStep:
    """1..n inside each group in process order."""

    def fn(df, keys, order_by, tasks=None):
        if order_by is None:
            raise ValueError("numbering needs order_by on the grouped process")
        return dense_id(df, order_by, keys=keys, id_col=id_col, tasks=tasks)

    return GroupStep(fn)


def grouped(df: DataFrame, by, steps=(), order_by: str | None = None, copies: int | None = None) -> DataFrame:
    """Run ``steps`` on the records of each key (G1).

    ``copies`` (G2) asks for that many tasks. Record steps need no key
    co-location, so the records are spread evenly (hashing on the key would
    put a hot key's records into one task). Group steps shuffle on (key,
    range bucket) themselves, into ``copies`` partitions.
    """
    keys = [by] if isinstance(by, str) else list(by)
    flat = chain(*steps).steps  # type: ignore[attr-defined]
    if copies and not any(isinstance(s, GroupStep) for s in flat):
        df = df.repartition(int(copies))
    for s in flat:
        df = s(df, keys, order_by, copies) if isinstance(s, GroupStep) else s(df)
    return df


def lookup(df: DataFrame, ref: DataFrame, on, columns=None, how: str = "left") -> DataFrame:
    """Look records up in a reference table (G6, re-aim of a named service).

    ``on``: a column name present on both sides, or ``{left_col: ref_col}``.
    ``columns``: reference columns to bring (default: all but the keys).
    A record without a match keeps nulls (``how='left'``); a null key never
    matches. A key that the reference holds several times is reduced to one
    row (the smallest values), so a lookup never multiplies records. Whether
    the reference is broadcast is left to Spark's byte threshold and AQE.
    """
    pairs = {on: on} if isinstance(on, str) else dict(on)
    if columns is None:
        columns = [c for c in ref.columns if c not in pairs.values()]
    one = (ref.groupBy(*[column(r).alias(left) for left, r in pairs.items()])
           .agg(F.min(F.struct(*[column(c) for c in columns])).alias("__ref")))
    one = one.select(*[column(left) for left in pairs], *[F.col("__ref").getField(c).alias(c) for c in columns])
    return df.join(one, on=list(pairs), how=how)
