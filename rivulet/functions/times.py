"""Times as whole numbers."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .conditions import column

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def ticks(schema: T.StructType, name: str) -> Column:
    """A time as a long: microseconds for times, the number itself for integers."""
    kind, c = schema[name].dataType, column(name)
    if isinstance(kind, T.TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", F.expr(_EPOCH_NTZ), c)
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c)
    if isinstance(kind, T.IntegralType):
        return c.cast("long")
    raise TypeError(f"no time: {name} is {kind.simpleString()}")


def span(spark: SparkSession, length) -> int:
    """A length of time in ticks: a number, a timedelta, or an interval text."""
    if isinstance(length, dt.timedelta):
        return length // dt.timedelta(microseconds=1)
    if isinstance(length, str):
        return spark.range(1).select(F.expr(f"unix_micros(timestamp_micros(0) + interval {length})")).first()[0]
    return int(length)
