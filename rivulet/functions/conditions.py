"""Null-safe conditions.

A record flow treats a missing key as null, and a condition such as
``flag != 'A'`` must be *true* for a record without ``flag``. Plain SQL
``!=`` yields null there and a filter silently drops the row, so every
condition in the library goes through these helpers.

Each helper returns a boolean Column that is never null: routing and skip
steps can use it directly.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    """A Column, or a key by its exact name (``raw:data``, ``@rate``, ``shower.x``); back-quoted text is taken as it is."""
    if isinstance(c, Column):
        return c
    return F.col(c if c.startswith("`") else "`" + c.replace("`", "``") + "`")


def _val(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def _total(c: Column) -> Column:
    """Mark a Column as never null, so :func:`as_condition` leaves it as is."""
    c._rivulet_total = True  # type: ignore[attr-defined]
    return c


def _known(*cols) -> Column:
    """``a IS NOT NULL AND b IS NOT NULL …`` for the Column operands."""
    out = None
    for c in cols:
        if isinstance(c, Column):
            out = c.isNotNull() if out is None else out & c.isNotNull()
    return out


def _compare(c, value, op) -> Column:
    # ``x op y AND x IS NOT NULL`` is false (not null) when x is null, since
    # NULL AND FALSE is FALSE; unlike coalesce(…, false) it reaches the scan
    # as a pushed filter.
    left = _col(c)
    right = value if isinstance(value, Column) else F.lit(value)
    return _total(op(left, right) & _known(left, value if isinstance(value, Column) else None))


def eq(c, value) -> Column:
    """``c = value`` where null equals null (``IS NOT DISTINCT FROM``)."""
    return _total(_col(c).eqNullSafe(_val(value)))


def ne(c, value) -> Column:
    """``c != value`` where null differs from any value (``IS DISTINCT FROM``)."""
    return _total(~_col(c).eqNullSafe(_val(value)))


def is_null(c) -> Column:
    return _total(_col(c).isNull())


def not_null(c) -> Column:
    return _total(_col(c).isNotNull())


def lt(c, value) -> Column:
    """``c < value``; a null side gives false."""
    return _compare(c, value, lambda a, b: a < b)


def le(c, value) -> Column:
    return _compare(c, value, lambda a, b: a <= b)


def gt(c, value) -> Column:
    return _compare(c, value, lambda a, b: a > b)


def ge(c, value) -> Column:
    return _compare(c, value, lambda a, b: a >= b)


def isin(c, values) -> Column:
    vals = [v for v in values if v is not None]
    left = _col(c)
    return _total(left.isin(vals) & left.isNotNull()) if vals else _total(F.lit(False))


def always() -> Column:
    return _total(F.lit(True))


_TOKEN = re.compile(r"""('(?:[^'\\]|\\.|'')*'|"(?:[^"\\]|\\.)*"|`[^`]*`)|<=>|<=|>=|!=|<>|==|=""")
_NULL_SAFE = {"=": "<=>", "==": "<=>", "!=": " IS DISTINCT FROM ", "<>": " IS DISTINCT FROM "}


def null_safe_text(text: str) -> str:
    """Condition text whose ``=`` and ``!=`` compare nulls as values, as :func:`eq` and :func:`ne` do."""
    return _TOKEN.sub(lambda m: m[0] if m[1] else _NULL_SAFE.get(m[0], m[0]), text)


def as_condition(cond) -> Column:
    """Column, SQL text, or bool → a never-null boolean Column.

    In text, ``=`` and ``!=`` compare null as a value (a record without the
    key differs from any value); an order comparison with null is unknown,
    and an unknown outcome never routes or skips a record.
    """
    if isinstance(cond, bool):
        return _total(F.lit(cond))
    if isinstance(cond, Column) and cond.__dict__.get("_rivulet_total", False):
        return cond
    if isinstance(cond, str):
        cond = F.expr(null_safe_text(cond))
    return _total(F.coalesce(cond, F.lit(False)))


def column(c) -> Column:
    """Column from its exact name."""
    return _col(c)
