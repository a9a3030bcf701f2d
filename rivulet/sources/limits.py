"""Running item IDs and item limits on a source."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions.conditions import column
from ..operators.frames import top
from ..operators.sequence import dense_id


def running_id(df: DataFrame, order_by: str, copy_col: str | None = None, id_col: str = "ID") -> DataFrame:
    """Number records 1..n in ``order_by`` order, per copy if ``copy_col`` is given.

    Skew-safe (no one-task window), see :mod:`rivulet.operators.sequence`.
    """
    return dense_id(df, order_by, keys=[copy_col] if copy_col else [], id_col=id_col)


def item_limit(df: DataFrame, limit: int, order_by: str | None = None, copy_col: str | None = None) -> DataFrame:
    """At most ``limit`` records, per copy if ``copy_col`` is given.

    With ``order_by`` the first records in that order are kept (every copy
    applies the limit on its own): each task keeps its own first ``limit``
    records of a copy, and these are merged in two steps
    (:func:`rivulet.operators.frames.top`). Without it, any ``limit`` records
    will do and a plain ``limit`` stops reading early.
    """
    if order_by is None:
        if copy_col is None:
            return df.limit(int(limit))
        raise ValueError("a per-copy limit needs order_by")
    return top(df, copy_col or [], [column(order_by)], int(limit))
