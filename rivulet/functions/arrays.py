"""Array-column steps (A1–A8; all definitions are ours).

Every function maps an array Column to a Column with Spark's higher-order
functions: no record is exploded and regrouped, and nothing leaves the JVM
(their lambdas are interpreted, outside whole-stage codegen). An argument is
bound once (:func:`bind`), so composed steps stay linear in the array.
Null elements are ignored by means and variances, as by SQL aggregates. Inputs are arrays of numbers; cast float arrays with
:func:`as_doubles` first so results are computed in double precision.
Out-of-range neighbours are read with ``get`` (null, never an error).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .conditions import column


def as_doubles(a) -> Column:
    return (F.col(a) if isinstance(a, str) else a).cast("array<double>")


def _c(a) -> Column:
    return F.col(a) if isinstance(a, str) else a


def bind(a, body) -> Column:
    """``body(v)`` with ``v`` standing for the array ``a``, which is evaluated once.

    A lambda that used ``a`` itself would evaluate it again for every element.
    """
    return F.get(F.transform(F.array(_c(a)), body), F.lit(0))


def element_set(a) -> Column:
    """Positions 0..n-1 of the array (A1); empty for an empty array, null for null."""
    return F.transform(_c(a), lambda x, i: i)


def mean(a) -> Column:
    """Mean of the elements that are not null; null if there is none."""
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("s"))
    return F.aggregate(
        _c(a), zero, lambda acc, x: F.when(x.isNull(), acc).otherwise(
            F.struct((acc["n"] + 1).alias("n"), (acc["s"] + x).alias("s"))),
        lambda acc: F.when(acc["n"] > 0, acc["s"] / acc["n"]))


def var_pop(a) -> Column:
    """Population variance in one pass (Welford's running mean and squared deviations), nulls ignored."""
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("m"), F.lit(0.0).alias("s"))

    def step(acc, x):
        n1 = acc["n"] + 1
        d = x - acc["m"]
        m1 = acc["m"] + d / n1
        return F.when(x.isNull(), acc).otherwise(
            F.struct(n1.alias("n"), m1.alias("m"), (acc["s"] + d * (x - m1)).alias("s")))

    return F.aggregate(_c(a), zero, step, lambda acc: F.when(acc["n"] > 0, acc["s"] / acc["n"]))


def stats(a) -> Column:
    """Struct of mean, min, max, population variance (A2)."""
    return bind(a, lambda v: F.struct(mean(v).alias("mean"), F.array_min(v).alias("min"),
                                      F.array_max(v).alias("max"), var_pop(v).alias("var")))


def baseline(a, k: int = 10) -> Column:
    """Mean of the first ``k`` values (A3)."""
    return mean(F.slice(_c(a), 1, k))


def over_threshold(a, t: float) -> Column:
    """Number of values greater than ``t`` (A4)."""
    return F.size(F.filter(_c(a), lambda x: x > F.lit(t))).cast("long")


def peak(a) -> Column:
    """Struct of the maximum and its first 0-based position (A5)."""
    return bind(a, lambda v: F.struct(F.array_max(v).alias("peak"),
                                      (F.array_position(v, F.array_max(v)) - 1).cast("long").alias("pos")))


def despike(a, limit: float) -> Column:
    """An inner value above both neighbours by more than ``limit`` becomes their mean.

    Neighbours are the input values; a missing or null neighbour leaves the value as it is.
    """
    def whole(v):
        def fix(x, i):
            left, right = F.get(v, i - 1), F.get(v, i + 1)
            spike = (x - left > F.lit(limit)) & (x - right > F.lit(limit))
            return F.when(F.coalesce(spike, F.lit(False)), (left + right) / 2).otherwise(x)

        return F.transform(v, fix)

    return bind(a, whole)


def interpolate(a, positions) -> Column:
    """Listed 0-based positions become the mean of their two neighbours.

    Positions should be inner and not adjacent; a listed edge position has a
    missing neighbour and becomes null.
    """
    pos = [int(p) for p in positions]
    if not pos:
        return _c(a)
    return bind(a, lambda v: F.transform(v, lambda x, i: F.when(
        i.isin(pos), (F.get(v, i - 1) + F.get(v, i + 1)) / 2).otherwise(x)))


def calibration_table(df: DataFrame, array_col: str, where=None, pos_col: str = "pos",
                      value_col: str = "ped") -> DataFrame:
    """Per-position mean over the calibration records (A6, pass 1).

    One row per array position; partial averages are combined map-side, so
    the shuffle carries ``positions × tasks`` rows whatever the input size.
    """
    src = df.where(where) if where is not None else df
    return (src.select(F.posexplode(as_doubles(column(array_col))).alias(pos_col, "__v"))
               .groupBy(pos_col).agg(F.avg("__v").alias(value_col)))


def calibration_row(table: DataFrame, pos_col: str = "pos", value_col: str = "ped", name: str = "reference") -> DataFrame:
    """The per-position table as one row holding one array (A6); positions without a value are null.

    The array is as long as the longest calibration record, whatever the number of records.
    """
    every = table.agg(F.max(pos_col).alias("__n")).select(F.explode(F.sequence(F.lit(0), F.col("__n"))).alias(pos_col))
    full = every.join(table.select(F.col(pos_col).cast("int").alias(pos_col), value_col), pos_col, "left")
    pairs = F.sort_array(F.collect_list(F.struct(pos_col, value_col)))
    return full.agg(F.transform(pairs, lambda e: e[value_col]).alias(name))


def calibrate(df: DataFrame, array_col: str, table: DataFrame, out_col: str | None = None, pos_col: str = "pos",
              value_col: str = "ped") -> DataFrame:
    """Subtract the per-position reference from an array column (A6, pass 2): a map over records.

    The one reference row goes to every task. A position without a
    reference value becomes null.
    """
    ref = calibration_row(table, pos_col, value_col, "__reference")
    less = F.zip_with(as_doubles(column(array_col)), F.col("__reference"), lambda x, r: x - r)
    out = df.join(F.broadcast(ref), how="cross")  # one row
    return out.withColumn(out_col or array_col, F.slice(less, 1, F.size(column(array_col)))).drop("__reference")
