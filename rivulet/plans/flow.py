"""Named flows: sources, process outputs and queues in one name space.

``Flow`` only keeps names on the driver; every method returns a lazy
DataFrame and all work happens in Spark when a result is written or
collected. The same flow code runs on batch and on streaming DataFrames as
long as its steps are record-at-a-time (grouped steps on a stream go
through :mod:`rivulet.streaming`).

Naming rules (reference behaviour and our decisions):

* ``input`` defaults to the process's own id (R1); an unknown name raises (Q13).
* ``output`` may list several names: one DataFrame under each (R2). A
  blank output is no output (Q5). Binding a taken output name raises (Q4).
* ``queues`` route copies of the processed records (R3); each queue is a
  name, and several producers of one queue are united (Q4).
* With ``output`` *and* ``pass_through=True`` the output holds the
  processed records and their queued copies, labelled (R5, Q3).
* A process with neither output nor queues is a terminal; :meth:`counts`
  gives its record count (K1).
* Services are reference tables registered by name; :meth:`lookup` makes a
  step that joins them, nulls if the name is unknown (G6).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.conditions import as_condition
from ..operators.keyed import grouped, lookup
from ..operators.routing import QUEUE_COL, enqueue, write_queues
from ..operators.steps import chain
from ..sources.generated import assign_copies, union_sources


def _names(v) -> list[str]:
    if v is None:
        return []
    if isinstance(v, str):
        return [v] if v.strip() else []
    return [n for n in v if n and n.strip()]


class Flow:
    def __init__(self):
        self._named: dict[str, DataFrame] = {}
        self._queues: dict[str, list[tuple[DataFrame, object]]] = {}
        self._routed: dict[str, DataFrame] = {}
        self._services: dict[str, DataFrame] = {}
        self.terminals: dict[str, DataFrame] = {}

    # -- names -------------------------------------------------------
    def _bind(self, name: str, df: DataFrame) -> None:
        if name in self._named or name in self._queues:
            raise ValueError(f"flow name {name!r} is already bound")
        self._named[name] = df

    def names(self) -> list[str]:
        return sorted(set(self._named) | set(self._queues))

    def __contains__(self, name: str) -> bool:
        return name in self._named or name in self._queues

    def __getitem__(self, name: str) -> DataFrame:
        if name in self._named:
            return self._named[name]
        if name in self._queues:
            # A queue read on its own is its producers' records filtered by the
            # queue's condition: the filter can reach the scan, nothing is exploded.
            return union_sources(*[df.where(as_condition(c)) for df, c in self._queues[name]])
        raise KeyError(f"no flow named {name!r} (known: {', '.join(self.names()) or 'none'})")

    # -- building ----------------------------------------------------
    def source(self, name: str, df: DataFrame, copies: int | None = None, copy_key: str | None = None,
               copy_col: str = "copy") -> DataFrame:
        """Bind a source DataFrame (batch or streaming) to a name.

        ``copies`` (S2) tags every record with the copy that reads it
        (``pmod(copy_key, copies)``, or a hash of the record); the source is
        still read once (Q11).
        """
        if copies:
            df = assign_copies(df, int(copies), key=copy_key, copy_col=copy_col)
        self._bind(name, df)
        return df

    def process(self, id: str, steps=(), input: str | None = None, output=None, queues=None,
                pass_through: bool = False, group_by=None, order_by: str | None = None,
                copies: int | None = None) -> DataFrame:
        """Run ``steps`` on the flow named ``input`` (default ``id``) and bind the results."""
        df = self[input or id]
        if group_by is not None:
            df = grouped(df, group_by, steps, order_by=order_by, copies=copies)
        else:
            df = chain(*steps)(df)
            if copies:
                df = df.repartition(int(copies))
        outputs = _names(output)
        result = df
        if queues:
            routed = enqueue(df, queues, pass_through=pass_through and bool(outputs))
            self._routed[id] = routed
            for q, cond in (queues.items() if isinstance(queues, dict) else queues):
                if q in self._named:
                    raise ValueError(f"queue {q!r} clashes with a flow of that name")
                self._queues.setdefault(q, []).append((df, cond))
            if pass_through and outputs:
                result = routed
        if outputs:
            for name in outputs:
                self._bind(name, result)
        elif not queues:
            self.terminals[id] = result
        return result

    def service(self, name: str, ref: DataFrame) -> DataFrame:
        """Register reference data under a service name."""
        self._services[name] = ref
        return ref

    def lookup(self, service: str, on, columns) -> Callable[[DataFrame], DataFrame]:
        """A step that looks records up in a named service.

        ``on`` is a column name or ``{record_col: service_col}``; ``columns``
        are the service columns to bring. An unknown service gives null
        columns (its type is unknown, so they are strings), as a processor
        without its service sees nothing.
        """
        columns = [columns] if isinstance(columns, str) else list(columns)

        def run(df: DataFrame) -> DataFrame:
            ref = self._services.get(service)
            if ref is None:
                return df.withColumns({c: F.lit(None).cast("string") for c in columns})
            return lookup(df, ref, on, columns)

        return run

    # -- results -----------------------------------------------------
    def union_of(self, names, label_col: str = "flow") -> DataFrame:
        """The named flows as one DataFrame with a name column.

        Names bound to the same DataFrame (fan-out, R2) are read once and
        labelled by an ``explode`` — one scan, not one per name.
        """
        groups: list[tuple[DataFrame, list[str]]] = []
        for n in names:
            df = self[n]
            for g in groups:
                if g[0] is df:
                    g[1].append(n)
                    break
            else:
                groups.append((df, [n]))
        parts = [df.withColumn(label_col, F.explode(F.array(*[F.lit(n) for n in ns])))
                 for df, ns in groups]
        return union_sources(*parts)

    def routed(self, process_id: str) -> DataFrame:
        """All queued copies of one process, with the ``spark_queue`` label."""
        return self._routed[process_id]

    def write_queues(self, process_id: str, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
        """Every queue of a process in one partitioned write (K3)."""
        write_queues(self._routed[process_id].where(F.col(QUEUE_COL).isNotNull()), path, fmt, mode)

    def count_table(self) -> DataFrame:
        """``process, processed``: the record count of every terminal process (K1), one job for all."""
        return union_sources(*[df.agg(F.count(F.lit(1)).alias("processed")).select(F.lit(name).alias("process"), "processed")
                               for name, df in self.terminals.items()])

    def counts(self) -> dict[str, int]:
        """Record count of every terminal process (K1)."""
        return {r.process: r.processed for r in self.count_table().collect()} if self.terminals else {}
