"""Sessions: records of a key that follow each other within a gap.

Records of a range (:mod:`.sequence`) are cut into local sessions, which
leave the range as one row each. For large keys, whose ranges are worked on
by different tasks, two carries join them up: the latest end of all ranges
before, which tells how many local sessions go on with an earlier one, and
the number of sessions begun before. Records may be intervals themselves, so
sessions of parts of the data (of micro-batches, say) are merged by the same
function.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.conditions import column
from ..session import scratch_path
from .sequence import ROWS_PER_BUCKET, with_ranges

_MERGE = {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}


def _later(c: Column, gap) -> Column:
    return c + (F.expr(f"interval {gap}") if isinstance(gap, str) else F.lit(gap))


def _aggregate(aggs: dict) -> list[Column]:
    out = []
    for name, a in aggs.items():
        fn, c = (a, None) if isinstance(a, str) else a
        if fn not in _MERGE:
            raise ValueError(f"sessions cannot merge {fn}")
        out.append((F.count(F.lit(1)) if c is None else {"count": F.count, **_MERGE}[fn](column(c)) if fn != "count" else F.count(column(c))).alias(name))
    return out


def _merged(aggs: dict) -> list[Column]:
    return [_MERGE[a if isinstance(a, str) else a[0]](name).alias(name) for name, a in aggs.items()]


def sessions(df: DataFrame, by, start: str, gap, aggs: dict | None = None, end: str | None = None, n_buckets: int | None = None,
             rows_per_bucket: int = ROWS_PER_BUCKET, names: tuple[str, str] = ("session_start", "session_end")) -> DataFrame:
    """One row per session: the key, its start and end, and ``aggs``.

    A session ends when the next record begins more than ``gap`` (a number,
    or an interval text for times) after the latest end so far. ``end``
    names the end of records that last; an end before its start counts as
    the start. ``aggs`` maps names to ``"count"`` or ``(fn, column)`` with fn
    in count, sum, min, max. A null key is a key; records without a start
    are in no session.
    """
    keys = [by] if isinstance(by, str) else list(by)
    aggs = aggs if aggs is not None else {"items": "count"}
    d = df.where(column(start).isNotNull())
    ranged, _, large = with_ranges(d, keys, start, n_buckets, rows_per_bucket, bucket_col="__b")
    last = column(start) if end is None else F.greatest(column(start), column(end))
    ranged = ranged.withColumn("__k", F.struct(*[column(k).alias(k) for k in keys])).withColumn("__s", column(start)).withColumn("__e", last)
    part = ["__k", "__b"] if large else ["__k"]
    w = Window.partitionBy(*part).orderBy("__s", "__e")
    before = F.max("__e").over(w.rowsBetween(Window.unboundedPreceding, -1))
    first = F.when(before.isNull() | (F.col("__s") > _later(before, gap)), 1).otherwise(0)
    local = ranged.withColumn("__new", first).withColumn("__n", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    local = local.groupBy(*part, "__n").agg(F.min("__s").alias("__s"), F.max("__e").alias("__e"), *_aggregate(aggs))

    def done(x: DataFrame) -> DataFrame:
        return x.select(*[F.col("__k").getField(k).alias(k) for k in keys], F.col("__s").alias(names[0]), F.col("__e").alias(names[1]), *aggs)

    if not large:
        return done(local)
    # the records are shuffled once; what follows is about their local sessions
    path = scratch_path(df.sparkSession, "sessions")
    local.write.parquet(path)
    local = df.sparkSession.read.schema(local.schema).parquet(path)
    cut = local.where("__b > 0")
    earlier = Window.partitionBy("__k").orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    ends = cut.groupBy("__k", "__b").agg(F.max("__e").alias("__m"))
    ends = ends.select("__k", "__b", F.max("__m").over(earlier).alias("__m"))  # a row per range of a large key
    fresh = F.when(F.col("__m").isNull() | (F.col("__s") > _later(F.col("__m"), gap)), 1).otherwise(0)
    cut = cut.join(F.broadcast(ends), ["__k", "__b"]).withColumn("__new", fresh)
    begun = cut.groupBy("__k", "__b").agg(F.sum("__new").alias("__c"))
    begun = begun.select("__k", "__b", F.coalesce(F.sum("__c").over(earlier), F.lit(0)).alias("__c"))
    w = Window.partitionBy("__k", "__b").orderBy("__s").rowsBetween(Window.unboundedPreceding, 0)
    cut = cut.withColumn("__n", F.sum("__new").over(w)).join(F.broadcast(begun), ["__k", "__b"])
    cut = cut.groupBy("__k", (F.col("__n") + F.col("__c")).alias("__n")).agg(F.min("__s").alias("__s"), F.max("__e").alias("__e"), *_merged(aggs))
    return done(local.where("__b = 0")).unionByName(done(cut))


def merged_sessions(parts: DataFrame, by, gap, aggs: dict | None = None, names: tuple[str, str] = ("session_start", "session_end"), **kw) -> DataFrame:
    """Sessions of parts of the data, whatever their order, → sessions of all of it."""
    aggs = aggs if aggs is not None else {"items": "count"}
    again = {name: (("sum" if (a if isinstance(a, str) else a[0]) == "count" else a[0]), name) for name, a in aggs.items()}
    return sessions(parts, by, names[0], gap, again, end=names[1], names=names, **kw)
