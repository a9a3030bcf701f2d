"""Sliding frames, the first records of each key, and distinct counts, whatever the size of a key.

* :func:`sliding` cuts the order of a key into blocks as long as the frame. A
  frame is then the end of one block and the start of the next, and both are
  running values (:mod:`.sequence`), backwards and forwards: no frame is gone
  through on its own, and a crowded block is cut into ranges. A frame of rows
  is a frame over row numbers.
* :func:`top` lets a key send at most k records per task, and merges them in
  two steps, so that no task gets all tasks' records of a large key.
* :func:`distinct_counts` deals the values of a key over all tasks before
  counting; :func:`distinct_sketches` keeps a mergeable sketch per key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.conditions import column
from ..functions.times import span as in_ticks
from ..functions.times import ticks
from ..session import shuffle_partitions
from .sequence import ROWS_PER_BUCKET, dense_id, running_values

_AGGS = {"avg": F.avg, "sum": F.sum, "min": F.min, "max": F.max, "count": F.count}


def _keys(by) -> list[str]:
    return [by] if isinstance(by, str) else list(by)


def sliding(df: DataFrame, by, order: str, aggs: dict, rows: int | None = None, span=None, ties=(),
            n_buckets: int | None = None, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Add aggregates over the frame that ends with each record.

    ``rows=n``: the record and the n - 1 before it, in the order of
    ``order`` and ``ties``. ``span``: all records of the key whose ``order``
    is at most that much smaller and not larger (a number, or an interval
    text for times), as SQL's ``RANGE``. ``aggs``: name → ``(fn, column)``
    with fn in avg, sum, min, max, count. A null key is a key; the frame of
    a record with null order holds those with null order.
    """
    keys = _keys(by)
    if (rows is None) == (span is None):
        raise ValueError("give rows or span")
    if rows is not None:
        numbered = dense_id(df, order, keys=keys, id_col="__no", n_buckets=n_buckets, rows_per_bucket=rows_per_bucket, ties=ties)
        return sliding(numbered, keys, "__no", aggs, span=rows - 1, n_buckets=n_buckets, rows_per_bucket=rows_per_bucket).drop("__no")
    reach = in_ticks(df.sparkSession, span)
    if reach < 0:
        raise ValueError("a frame that ends before its record")
    width = max(reach, 1)
    at, own = ticks(df.schema, order), {*keys, order}
    block = at - F.pmod(at, F.lit(width))
    here = F.col("__role.here")
    roles = F.array(*[F.struct(b.alias("block"), F.lit(h).alias("here")) for b, h in ((block, True), (block + F.lit(width), False))])
    d = df.withColumn("__at", at).withColumn("__role", F.explode(F.when(block.isNull(), F.slice(roles, 1, 1)).otherwise(roles)))
    parts = {name: [(f"__{p}_{name}", "sum" if p in ("n", "avg") else fn, x) for p, x in _parts(df, fn, c)] for name, (fn, c) in aggs.items()}
    flat = [x for xs in parts.values() for x in xs]
    d = d.select(*[column(c) if c in own else F.when(here, column(c)).alias(c) for c in df.columns],
                 *[F.when(h, x).alias(f"{p}{i}") for p, _, x in flat for i, h in enumerate((~here, here))],
                 "__at", F.col("__role.block").alias("__block"), here.alias("__here"), (F.when(here, F.lit(reach)).otherwise(0) - F.col("__at")).alias("__back"))
    for i, place in enumerate(("__back", "__at")):  # the end of the block before from the frame's start on, then this block up to the record
        d = running_values(d, [*keys, "__block"], place, {f"{p}_{i}": (f, f"{p}{i}") for p, f, _ in flat},
                           n_buckets=n_buckets, rows_per_bucket=rows_per_bucket, peers=True)
    out = {}
    for name, (fn, c) in aggs.items():
        kind = df.select(_AGGS[fn](column(c)).alias("x")).schema["x"].dataType
        whole = [_both(f, F.col(f"{p}_0"), F.col(f"{p}_1")) for p, f, _ in parts[name]]
        out[name] = (F.coalesce(whole[0], F.lit(0)) if fn == "count" else F.try_divide(*whole) if fn == "avg" else whole[0]).cast(kind).alias(name)
    return d.where("__here").select(*[column(c) for c in df.columns if c not in out], *out.values())


def _parts(df: DataFrame, fn: str, c: str) -> list[tuple[str, Column]]:
    """What is added up, or compared, for an aggregate: the value, the number of values, or both."""
    x, one = column(c), F.when(column(c).isNotNull(), F.lit(1).cast("long"))
    if fn == "avg":
        exact = isinstance(df.select(x).schema[0].dataType, T.DecimalType)
        return [("avg", x if exact else x.cast("double")), ("n", one)]
    return [("n", one)] if fn == "count" else [(fn, x)]


def _both(fn: str, a: Column, b: Column) -> Column:
    if fn == "sum":
        return F.coalesce(a + b, a, b)
    return (F.least if fn == "min" else F.greatest)(a, b)


def top(df: DataFrame, by, order: list[Column], k: int, ties: bool = False) -> DataFrame:
    """The first ``k`` records of each key in an order (``desc``, ``asc`` columns); ``by`` may be empty.

    With ``ties`` also those that equal the k-th. Every task sends at most k
    records of a key (and its ties) to one of a few tasks per key, and these
    to the key's task. A null key is a key.
    """
    keys = _keys(by)
    rank = F.rank() if ties else F.row_number()
    salt = max(1, int(shuffle_partitions(df.sparkSession) ** 0.5))
    d = df.withColumn("__k", F.struct(*[column(c) for c in keys], F.lit(0).alias("__"))).withColumn("__salt", F.spark_partition_id() % salt)
    for part in (["__k", "__salt"], ["__k"]):
        d = d.withColumn("__no", rank.over(Window.partitionBy(*part).orderBy(*order))).where(F.col("__no") <= k)
    return d.drop("__k", "__salt", "__no")


def distinct_counts(df: DataFrame, by, value: str, name: str = "distinct") -> DataFrame:
    """Number of different non-null values per key, exactly: values are dealt by (key, value), so a large key's are counted by many tasks."""
    keys = _keys(by)
    each = df.select(*[column(k) for k in keys], column(value).alias("__v")).distinct()
    return each.groupBy(*[column(k) for k in keys]).agg(F.count("__v").alias(name))


#: Relative standard error of a sketch of 2**12 registers is about 1.04 / 2**6.
SKETCH_BITS = 12


def distinct_sketches(df: DataFrame, by, value: str, name: str = "sketch") -> DataFrame:
    """A sketch of the different non-null values per key; sketches of parts can be merged (:func:`merged_distinct`)."""
    known = F.coalesce(column(value).cast("string"), F.lit(""))
    sketch = F.hll_sketch_agg(F.when(column(value).isNotNull(), known), F.lit(SKETCH_BITS))
    return df.groupBy(*[column(k) for k in _keys(by)]).agg(sketch.alias(name))


def merged_distinct(sketches: DataFrame, by, name: str = "sketch", out: str = "distinct") -> DataFrame:
    """Estimated number of different values per key over all sketches of it."""
    merged = F.hll_sketch_estimate(F.hll_union_agg(column(name)))
    return sketches.groupBy(*[column(k) for k in _keys(by)]).agg(merged.alias(out))
