"""Running values and dense IDs without a one-task window.

``row_number() OVER (PARTITION BY copy ORDER BY x)`` is right but puts every
row of a copy into one task: four copies means four tasks, and a key that
holds a third of the data means one task holds a third of the data. Here the
same numbers are computed with large keys cut into ranges, by one plan for
every input size:

1. *Sample.* One column-pruned pass gives the row count and a bounded
   sample (:mod:`.sampling`), which shows which keys hold more than one
   range's share of the rows, and where to cut them. There are never more
   such keys than ranges.
2. *Ranges.* Rows of a large key get the number of their range: the key's
   number plus the scaled order value, cut by ``Bucketizer`` (a binary
   search in the JVM). All other rows are in range 0. The range is a pure
   function of the row, so every pass agrees on it.
3. *Local scan.* A window over ``(key, range)`` gives the running values; it
   is the only shuffle of the records. Small keys are done with it.
4. *Carries.* Totals per range of the large keys (a second, column-pruned
   scan with partial aggregation) are scanned per key and joined back. This
   table has at most as many rows as there are ranges and large keys, so it
   is broadcast.

Keys are wrapped in one struct column, so a null key is one group and joins
to itself (G3). The order column should be unique and not null for dense IDs
(ties get an arbitrary but consistent order, as in SQL).
"""

from __future__ import annotations

import math
from bisect import bisect_right

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.conditions import column
from ..session import shuffle_partitions
from .sampling import sampled

# Rows per range: 1e12 rows → 1e5 ranges of 1e7 rows (a window sort spills).
ROWS_PER_BUCKET = 10_000_000
# A range of fewer rows is not worth a task.
LEAST_ROWS = 100
# Strings are placed between this many sampled values (see _string_key); of a sampled string only the start is kept.
PIVOTS = 64
PREFIX = 256

_KEY = "__rv_key"
_BUCKET = "__rv_bucket"
_HASH = "__rv_hash"
_NUMBER = "__rv_number"
_ORD = "__rv_ord"
_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _common_prefix(a: str, b: str) -> int:
    """Bytes that two strings share at the start."""
    n = 0
    for x, y in zip(a.encode("utf-8"), b.encode("utf-8")):
        if x != y:
            break
        n += 1
    return n


def _string_key(c: Column, pivots: list[str]) -> Column:
    """Monotone double of a string: the pivots at or below it, plus a fraction.

    All strings between two pivots share the pivots' common prefix, so the
    fraction is taken from the bytes after it: wherever strings are dense,
    neighbouring pivots are alike and the fraction still tells them apart.
    """
    def below(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(c < F.lit(pivots[mid]), below(lo, mid)).otherwise(below(mid + 1, hi))

    place = below(0, len(pivots))
    skips = [0, *(_common_prefix(a, b) for a, b in zip(pivots, pivots[1:])), 0]
    skip = F.get(F.array(*[F.lit(n) for n in skips]), place)
    raw = F.rpad(F.hex(F.substring(F.encode(c, "UTF-8"), skip + 1, F.lit(6))), 12, "0")
    return place.cast("double") + F.conv(raw, 16, 10).cast("double") / F.lit(float(2**48))


def _pivots(values: list[str]) -> list[str]:
    """Evenly spaced distinct values of a sample, with both ends."""
    v = sorted(set(values), key=lambda x: x.encode("utf-8"))
    if len(v) <= PIVOTS:
        return v
    return [v[i * (len(v) - 1) // (PIVOTS - 1)] for i in range(PIVOTS)]


def _string_place(values, pivots: list[str]) -> np.ndarray:
    """The same number as :func:`_string_key`, of sampled strings."""
    raw = [p.encode("utf-8") for p in pivots]
    skips = [0, *(_common_prefix(a, b) for a, b in zip(pivots, pivots[1:])), 0]
    out = []
    for v in values:
        v = v.encode("utf-8")
        place = bisect_right(raw, v)
        out.append(place + int.from_bytes(v[skips[place]:skips[place] + 6].ljust(6, b"\0"), "big") / 2**48)
    return np.array(out, np.float64)


def _order_number(df: DataFrame, name: str) -> Column:
    """A monotone double Column for an order column that is no string (ties allowed).

    It only decides the range; the exact order inside a range comes from the
    real column.
    """
    dtype, c = df.schema[name].dataType, column(name)
    if isinstance(dtype, T.TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", F.expr(_EPOCH_NTZ), c).cast("double")
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(c).cast("double")
    if isinstance(dtype, T.DateType):
        return F.unix_date(c).cast("double")
    if isinstance(dtype, T.NumericType):
        return c.cast("double")
    raise TypeError(f"cannot order by a column of type {dtype.simpleString()}")


def with_ranges(df: DataFrame, keys, order_col: str, n_buckets: int | None = None,
                rows_per_bucket: int = ROWS_PER_BUCKET, bucket_col: str = _BUCKET):
    """``(df with bucket_col, rows, large keys)``: the range of each row of a large key, 0 for all other rows.

    The ranges of a key follow its order; no range holds much more than its
    share of the rows, however few keys there are. One pass over the key and
    order columns gives the row count and a bounded sample; large keys and
    cuts are read off the sample on the driver.
    """
    from pyspark.ml.feature import Bucketizer

    hashed = F.xxhash64(*[column(k) for k in keys]) if keys else F.lit(0).cast("long")
    text = isinstance(df.schema[order_col].dataType, T.StringType)
    place_of = F.substring(column(order_col), 1, PREFIX) if text else _order_number(df, order_col)
    n, sample = sampled(df.select(hashed.alias(_HASH), place_of.alias(_ORD)))
    buckets = int(n_buckets or min(max(shuffle_partitions(df.sparkSession), math.ceil(n / rows_per_bucket)), -(-n // LEAST_ROWS)))
    large = []
    if n and buckets > 1:
        weights = sample.groupby(_HASH)["weight"].agg(["sum", "size"])
        large = sorted(weights.index[(weights["sum"] > n / buckets) & (weights["size"] > 1)].tolist())
    if not large:
        return df.withColumn(bucket_col, F.lit(0)), n, 0
    sample = sample[sample[_HASH].isin(large)]
    if text:
        seen = sample[_ORD].notna().to_numpy()
        pivots = _pivots(sample[_ORD][seen].tolist())
        number = np.full(len(sample), np.nan)
        number[seen] = _string_place(sample[_ORD][seen], pivots)
        order_key = _string_key(column(order_col), pivots)
    else:
        number, order_key = sample[_ORD].to_numpy(np.float64), _order_number(df, order_col)
    own, weight = sample[_HASH].to_numpy(), sample["weight"].to_numpy()
    rows, splits = [], set(map(float, range(1, len(large))))
    for i, h in enumerate(large):
        mine = (own == h) & np.isfinite(number)
        v, w = number[mine], weight[mine]
        lo, hi = (float(v.min()), float(v.max())) if len(v) else (0.0, 0.0)
        rows.append((h, i, lo, hi))
        if hi > lo:  # cuts at every half of a range's share, as ranges can meet in one task
            order = np.argsort(v, kind="stable")
            share = np.floor(np.cumsum(w[order]) / (n / buckets / 2))
            at = (v[order][1:][share[1:] > share[:-1]] - lo) / (hi - lo)
            splits |= {i + min(float(x), 0.999999999) for x in at}
    splits -= {0.0}
    if not splits:  # one key whose order values are all alike to the sample
        return df.withColumn(bucket_col, F.lit(0)), n, 0
    known = df.sparkSession.createDataFrame(rows, f"{_HASH} long, {_NUMBER} int, __rv_lo double, __rv_hi double")
    place = (F.col(_ORD) - F.col("__rv_lo")) / (F.col("__rv_hi") - F.col("__rv_lo"))
    # the key's number, and where between its least and largest sampled value the row lies: below 1, nulls first
    place = F.least(F.greatest(F.coalesce(F.nanvl(place, F.lit(1.0)), F.lit(0.0)), F.lit(0.0)), F.lit(0.999999999))
    place = F.when(F.col("__rv_hi") > F.col("__rv_lo"), place).otherwise(0.0) + F.col(_NUMBER)
    cut = Bucketizer(splits=[-math.inf, *sorted(splits), math.inf], inputCol=_ORD, outputCol=bucket_col, handleInvalid="keep")
    out = df.withColumn(_HASH, hashed).withColumn(_ORD, order_key)
    out = out.join(F.broadcast(known), _HASH, "left").withColumn(_ORD, place)  # there are fewer large keys than ranges
    out = cut.transform(out).withColumn(bucket_col, F.when(F.col(_NUMBER).isNull(), 0).otherwise(F.col(bucket_col).cast("int") + 1))
    return out.drop(_HASH, _ORD, _NUMBER, "__rv_lo", "__rv_hi"), n, len(large)


def _running(fn: str, c: str | None, w_rows, w_order, peers: bool = False) -> Column:
    if fn == "count" and peers:
        return F.count(F.lit(1)).over(w_rows)
    if fn == "count":
        return F.row_number().over(w_order).cast("long")
    if fn == "last":
        return F.last(column(c), ignorenulls=True).over(w_rows)
    return {"sum": F.sum, "min": F.min, "max": F.max}[fn](column(c)).over(w_rows)


def _total(fn: str, c: str | None, order: list[str]) -> Column:
    if fn == "count":
        return F.count(F.lit(1))
    if fn == "last":  # max_by passes over rows whose order is null
        return F.max_by(column(c), F.when(column(c).isNotNull(), F.struct(*[column(o) for o in order])))
    return {"sum": F.sum, "min": F.min, "max": F.max}[fn](column(c))


def _carry(fn: str, name: str, w_prev) -> Column:
    if fn == "last":
        return F.last(F.col(name), ignorenulls=True).over(w_prev)
    agg = F.sum if fn in ("count", "sum") else {"min": F.min, "max": F.max}[fn]
    return agg(F.col(name)).over(w_prev)


def _merge(fn: str, carry: Column, local: Column) -> Column:
    if fn == "count":
        return F.coalesce(carry, F.lit(0)).cast("long") + local
    if fn == "sum":
        # null only while no value has been seen, as SQL's running sum
        return F.when(carry.isNull(), local).when(local.isNull(), carry).otherwise(carry + local)
    if fn == "last":
        return F.coalesce(local, carry)
    if fn == "min":
        return F.least(carry, local)
    return F.greatest(carry, local)


def running_values(df: DataFrame, keys, order_col, aggs: dict, n_buckets: int | None = None,
                   rows_per_bucket: int = ROWS_PER_BUCKET, tasks: int | None = None, ties=(), peers: bool = False) -> DataFrame:
    return running_values_counted(df, keys, order_col, aggs, n_buckets, rows_per_bucket, tasks, ties, peers)[0]


def running_values_counted(df: DataFrame, keys, order_col, aggs: dict, n_buckets: int | None = None,
                           rows_per_bucket: int = ROWS_PER_BUCKET, tasks: int | None = None, ties=(), peers: bool = False):
    """Add running aggregates per key in ``order_col`` order (frame: rows up to the current one).

    ``aggs`` maps an output name to ``"count"`` or to ``(fn, column)`` with
    fn in ``sum``, ``min``, ``max``, ``last`` (the last value that is not
    null). Equal to ``fn(column) OVER (PARTITION BY keys ORDER BY order_col,
    ties ROWS UNBOUNDED PRECEDING)``; ``ties`` are further order columns.
    With ``peers`` the frame also holds the later rows of the same order value (``RANGE``; no ties then).
    ``tasks`` asks for that many partitions of the records. Returns ``(DataFrame, rows)``.
    """
    keys = [keys] if isinstance(keys, str) else list(keys or [])
    spec = {}
    for name, a in aggs.items():
        fn, c = (a, None) if isinstance(a, str) else a
        if fn not in ("count", "sum", "min", "max", "last"):
            raise ValueError(f"running {fn} is not supported")
        spec[name] = (fn, c)

    ranged, n, large = with_ranges(df, keys, order_col, n_buckets, rows_per_bucket)
    key_col = F.struct(*[column(k) for k in keys]) if keys else F.struct(F.lit(0).alias("all"))
    b = ranged.withColumn(_KEY, key_col)
    if not large:  # the range is 0 everywhere: one shuffle on the key alone
        b = b.drop(_BUCKET)
    part = [_KEY, _BUCKET] if large else [_KEY]
    order = [order_col, *ties]
    w_order = Window.partitionBy(*part).orderBy(*[column(o) for o in order])
    # rows of one order value are in one range
    w_rows = (w_order.rangeBetween if peers else w_order.rowsBetween)(Window.unboundedPreceding, Window.currentRow)
    local = b.repartition(int(tasks), *part) if tasks else b
    if not large:
        for name, (fn, c) in spec.items():
            local = local.withColumn(name, _running(fn, c, w_rows, w_order, peers))
        return local.drop(*part), n

    for name, (fn, c) in spec.items():
        local = local.withColumn(f"__l_{name}", _running(fn, c, w_rows, w_order, peers))
    totals = b.where(F.col(_BUCKET) > 0).groupBy(*part).agg(*[_total(fn, c, order).alias(f"__t_{name}") for name, (fn, c) in spec.items()])
    w_prev = Window.partitionBy(_KEY).orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    carries = totals.select(*part, *[_carry(fn, f"__t_{name}", w_prev).alias(f"__o_{name}")
                                     for name, (fn, _) in spec.items()])
    out = local.join(F.broadcast(carries), on=part, how="left")  # at most a row per range of a large key
    for name, (fn, _) in spec.items():
        out = out.withColumn(name, _merge(fn, F.col(f"__o_{name}"), F.col(f"__l_{name}")))
    drop = [_KEY, _BUCKET] + [f"__{p}_{name}" for name in spec for p in ("l", "o")]
    return out.drop(*drop), n


def dense_id(df: DataFrame, order_col, keys=(), id_col: str = "id", **kw) -> DataFrame:
    """``row_number() OVER (PARTITION BY keys ORDER BY order_col)`` as a long, skew-safe."""
    return running_values(df, keys, order_col, {id_col: "count"}, **kw)


def dense_id_counted(df: DataFrame, order_col, keys=(), id_col: str = "id", **kw):
    """:func:`dense_id` and the input row count (from the job it runs anyway)."""
    return running_values_counted(df, keys, order_col, {id_col: "count"}, **kw)
