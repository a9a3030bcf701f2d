"""Item steps.

A step is a function ``DataFrame → DataFrame``; the factories below return
such functions, so a process is ``df.transform(s1).transform(s2)…`` and
Catalyst fuses the projections and filters into one codegen stage. A list
of steps is itself a step (:func:`chain`), the way a wrapper element holds
other elements.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.conditions import as_condition, column
from .sequence import dense_id

Step = Callable[[DataFrame], DataFrame]


def chain(*steps) -> Step:
    """Several steps as one (P1, P8). Nested lists are flattened."""
    flat: list[Step] = []

    def add(s):
        if s is None:
            return
        if isinstance(s, (list, tuple)):
            for x in s:
                add(x)
        else:
            flat.append(s)

    add(list(steps))

    def run(df: DataFrame) -> DataFrame:
        for s in flat:
            df = s(df)
        return df

    run.steps = flat  # type: ignore[attr-defined]
    return run


def process(df: DataFrame, steps: Iterable[Step]) -> DataFrame:
    """Run steps in order on every record."""
    return chain(*steps)(df)


def rename_key(src: str, dst: str) -> Step:
    """RenameKey (P2). No-op if ``src`` is absent; replaces an existing ``dst``."""

    def run(df: DataFrame) -> DataFrame:
        if src not in df.columns:
            return df
        if dst in df.columns and dst != src:
            df = df.drop(dst)
        return df.withColumnRenamed(src, dst)

    return run


def copy_keys(mapping: dict[str, str] | None = None, keys: Iterable[str] = (), suffix: str = "_copy") -> Step:
    """Copy keys to new names (P3). ``mapping`` src→dst, or ``keys`` + suffix."""
    pairs = dict(mapping or {})
    for k in keys:
        pairs[k] = f"{k}{suffix}"

    def run(df: DataFrame) -> DataFrame:
        cols = {dst: column(src) for src, dst in pairs.items() if src in df.columns}
        return df.withColumns(cols) if cols else df

    return run


def create_id(id_col: str = "id", order_by: str | None = None, keys=()) -> Step:
    """CreateID (P4).

    Without ``order_by``: a unique (not dense) 64-bit id,
    ``monotonically_increasing_id()``; no shuffle. With ``order_by``: the
    dense 1..n number in that order (per ``keys``), computed with the
    skew-safe segmented scan in :mod:`.sequence`.
    """

    def run(df: DataFrame) -> DataFrame:
        if order_by is None:
            return df.withColumn(id_col, F.monotonically_increasing_id())
        return dense_id(df, order_by, keys=keys, id_col=id_col)

    return run


def skip(condition) -> Step:
    """Skip (P5, P7): drop records for which the condition is true.

    A condition that is null (unknown) keeps the record.
    """

    def run(df: DataFrame) -> DataFrame:
        return df.where(~as_condition(condition))

    return run


def keep(condition) -> Step:
    """The opposite of :func:`skip`: keep records for which it is true."""

    def run(df: DataFrame) -> DataFrame:
        return df.where(as_condition(condition))

    return run


def set_key(name: str, value) -> Step:
    """Put a key computed from a Column expression (or a literal)."""

    def run(df: DataFrame) -> DataFrame:
        return df.withColumn(name, value if isinstance(value, Column) else F.lit(value))

    return run


def select_keys(*names: str) -> Step:
    def run(df: DataFrame) -> DataFrame:
        return df.select(*[column(n) for n in names])

    return run


def map_in_pandas(fn, schema) -> Step:
    """Row logic that no Column expression can state: Arrow batches per partition."""

    def run(df: DataFrame) -> DataFrame:
        return df.mapInPandas(fn, schema)

    return run
