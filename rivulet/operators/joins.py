"""Joins by order: as-of joins, points in intervals, overlapping intervals.

* :func:`asof_join` puts both sides in one order per key and carries the last
  record of the right side along it. Large keys are cut into ranges with a
  carry between them (:mod:`.sequence`), so a key holding half of the rows
  is worked on by many tasks, and no record meets more than one other.
* :func:`interval_join` and :func:`overlap_join` deal intervals into tiles.
  Tiles come in sizes, each four times the last; an interval lies on one or
  two tiles of the size that fits its length, so a very long one makes no
  more copies than a short one. A point lies on one tile of every size that
  occurs. The join is then on (key, size, tile), which Spark can shuffle and
  split like any other, and the exact condition is checked on what meets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.conditions import column
from .sequence import _order_number, running_values

GROWTH = 4.0


def _names(on) -> tuple[list[str], list[str]]:
    pairs = {c: c for c in ([on] if isinstance(on, str) else on)} if not isinstance(on, dict) else on
    return list(pairs), list(pairs.values())


def _row(df: DataFrame) -> Column:
    return F.struct(*[column(c).alias(c) for c in df.columns])


def _spread(df: DataFrame, left: DataFrame, right: DataFrame, keys: list[str], suffix: str) -> DataFrame:
    """Columns of ``__l`` and ``__r``: the right key is left out where its name is the left one's, other clashes get ``suffix``."""
    out = [F.col("__l").getField(c).alias(c) for c in left.columns]
    for c in right.columns:
        if c in keys:
            continue
        out.append(F.col("__r").getField(c).alias(c + suffix if c in left.columns else c))
    return df.select(*out)


def asof_join(left: DataFrame, right: DataFrame, on, left_time: str, right_time: str, tolerance=None,
              direction: str = "backward", how: str = "left", suffix: str = "_right", **ranges) -> DataFrame:
    """Each left record with the last right record of its key that is not later.

    ``on``: key columns, or ``{left: right}``. ``direction="forward"`` takes
    the first right record that is not earlier instead. ``tolerance`` (a
    number, or an interval text for times) is the largest distance of the
    two times; ``how="inner"`` drops records without a match. Of right
    records with equal key and time, the one with the largest columns (in
    their order) is taken, so the result does not depend on row order. Null
    keys and null times match nothing; left records keep their number.
    """
    lk, rk = _names(on)
    if direction not in ("backward", "forward") or how not in ("left", "inner"):
        raise ValueError(f"unknown direction {direction} or how {how}")
    keys = [f"__k{i}" for i in range(len(lk))]
    lt, rt = left.schema[left_time].dataType, right.schema[right_time].dataType
    kind = lt if lt == rt else T.DoubleType() if isinstance(lt, T.NumericType) and isinstance(rt, T.NumericType) else lt

    def side(df, names, time, which):
        held = {"__l": _row(df), "__r": F.lit(None).cast(right.schema)} if not which else {"__l": F.lit(None).cast(left.schema), "__r": _row(df)}
        return df.select(*[column(c).alias(k) for c, k in zip(names, keys)], column(time).cast(kind).alias("__t"),
                         F.lit(which).alias("__side"), *[v.alias(n) for n, v in held.items()])

    # a null key or time has no right record before it
    both = side(left, lk, left_time, 0).unionByName(side(_known(right, [*rk, right_time]), rk, right_time, 1))
    # right records come first at equal times, and in the order of their columns
    order = _order_number(both, "__t")
    at = order if direction == "backward" else -order
    both = both.withColumn("__at", at).withColumn("__first", F.col("__side") == 0)
    got = running_values(both, keys, "__at", {"__last": ("last", "__r")}, ties=_exact(kind, direction) + ["__first", "__r"], **ranges)
    got = got.where("__side = 0").select("__l", F.col("__last").alias("__r"))
    if tolerance is not None:
        a, b = F.col("__l").getField(left_time), F.col("__r").getField(right_time)
        a, b = (a, b) if direction == "backward" else (b, a)
        near = a - F.expr(f"interval {tolerance}") <= b if isinstance(tolerance, str) else a - F.lit(tolerance) <= b
        got = got.withColumn("__r", F.when(near, F.col("__r")))
    if how == "inner":
        got = got.where("__r is not null")
    return _spread(got, left, right, [c for c, o in zip(rk, lk) if c == o], suffix)


def _exact(kind: T.DataType, direction: str) -> list[str]:
    """The time itself as a further order column where the monotone number could be coarser (long integers, decimals)."""
    coarse = isinstance(kind, (T.LongType, T.DecimalType))
    if coarse and direction == "forward":
        raise TypeError("forward as-of joins need a time that a double tells apart: cast it to timestamp, int or double")
    return ["__t"] if coarse else []


def _size(length: Column) -> Column:
    """The size of tiles that fits a length: the power of GROWTH that is no shorter; 0 for a length of 0."""
    return F.when(length > 0, F.ceil(F.log(length) / F.log(F.lit(GROWTH)))).otherwise(0).cast("int")


def _tile(at: Column, size: Column) -> Column:
    return F.floor(at / F.pow(F.lit(GROWTH), size)).cast("long")


def _tiles(low: Column, high: Column, size: Column) -> Column:
    return F.explode(F.sequence(_tile(low, size), _tile(high, size)))


def _sizes(*sides: DataFrame) -> Column:
    """The sizes that occur on any side: a few numbers, as each is four times the last."""
    found = sorted({r[0] for d in sides for r in d.select("__own").distinct().collect()})
    return F.array(*[F.lit(s) for s in found]).cast("array<int>")


def _known(df: DataFrame, names: list[str]) -> DataFrame:
    for c in names:
        df = df.where(column(c).isNotNull())
    return df


def interval_join(points: DataFrame, intervals: DataFrame, point: str, low: str, high: str, on=(), closed: str = "left",
                  suffix: str = "_right") -> DataFrame:
    """Pairs of points and intervals that hold them: ``low <= point < high`` (``closed="both"``: ``<= high``).

    ``on``: further columns that must be equal, or ``{left: right}``. Null
    points, bounds and keys match nothing, nor do intervals that end before
    they begin. Every pair meets on one tile only.
    """
    lk, rk = _names(on)
    upper = {"left": lambda p, h: p < h, "both": lambda p, h: p <= h}[closed]
    ivs, pts = _known(intervals, [*rk, low, high]).where(column(low) <= column(high)), _known(points, [*lk, point])
    r = ivs.select(_row(intervals).alias("__r"), *[column(c).alias(f"__k{i}") for i, c in enumerate(rk)],
                   _order_number(intervals, low).alias("__lo"), _order_number(intervals, high).alias("__hi"))
    r = r.withColumn("__own", _size(F.col("__hi") - F.col("__lo")))
    l = pts.select(_row(points).alias("__l"), *[column(c).alias(f"__k{i}") for i, c in enumerate(lk)],
                   _order_number(points, point).alias("__at"), F.explode(_sizes(r)).alias("__own"))
    l = l.withColumn("__tile", _tile(F.col("__at"), F.col("__own")))
    r = r.withColumn("__tile", _tiles(F.col("__lo"), F.col("__hi"), F.col("__own")))
    got = l.join(r, [*[f"__k{i}" for i in range(len(lk))], "__own", "__tile"])
    p, a, b = F.col("__l").getField(point), F.col("__r").getField(low), F.col("__r").getField(high)
    return _spread(got.where((p >= a) & upper(p, b)), points, intervals, [c for c, o in zip(rk, lk) if c == o], suffix)


def overlap_join(left: DataFrame, right: DataFrame, left_bounds: tuple[str, str], right_bounds: tuple[str, str], on=(),
                 suffix: str = "_right") -> DataFrame:
    """Pairs of intervals ``[low, high)`` that share a point.

    Two intervals meet on tiles of the larger of their two sizes: each side
    is dealt onto tiles of its own size, and onto those of every larger size
    that occurs. A pair that meets on several tiles is kept on the one that
    holds the later beginning, so none comes twice.
    """
    lk, rk = _names(on)
    sides = []
    for df, keys, (lo, hi), row in ((left, lk, left_bounds, "__l"), (right, rk, right_bounds, "__r")):
        some = _known(df, [*keys, lo, hi]).where(column(lo) < column(hi))
        some = some.select(_row(df).alias(row), *[column(c).alias(f"__k{i}") for i, c in enumerate(keys)],
                           _order_number(df, lo).alias(f"{row}lo"), _order_number(df, hi).alias(f"{row}hi"))
        sides.append(some.withColumn("__own", _size(F.col(f"{row}hi") - F.col(f"{row}lo"))))
    sizes = _sizes(*sides)

    def dealt(d, row):
        d = d.withColumn("__size", F.explode(F.filter(sizes, lambda s: s >= F.col("__own")))).withColumnRenamed("__own", f"{row}own")
        return d.withColumn("__tile", _tiles(F.col(f"{row}lo"), F.col(f"{row}hi"), F.col("__size")))

    got = dealt(sides[0], "__l").join(dealt(sides[1], "__r"), [*[f"__k{i}" for i in range(len(lk))], "__size", "__tile"])
    got = got.where(F.col("__size") == F.greatest("__lown", "__rown"))
    got = got.where(F.col("__tile") == _tile(F.greatest("__llo", "__rlo"), F.col("__size")))
    a, b = [F.col("__l").getField(c) for c in left_bounds], [F.col("__r").getField(c) for c in right_bounds]
    return _spread(got.where((a[0] < b[1]) & (b[0] < a[1])), left, right, [c for c, o in zip(rk, lk) if c == o], suffix)
