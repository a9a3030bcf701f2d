"""Steps with state of their own: named values, lists and maps per key, event-time timers, and a closing step.

A :class:`Processor` is written as plain methods; :func:`process_stream` runs
it with ``transformWithState`` on the RocksDB state store, so its state and
timers survive restarts and lost executors. When a bounded input has ended,
the closing step reads what is left from the state store and hands each key
to ``finish``.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from ..functions.conditions import column
from ..session import ensure_state_store, scratch_path
from .runs import _run, _start, ntz_to_instant

# Processors run in Python workers: ship this module's code by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

EVENT_TIME = "event_time"
CLOSED_ROWS = 10_000  # rows of the closing step that leave a task at once, about


class State:
    """The state of one key: ``values``, ``lists`` and ``maps`` by name, and its timers.

    ``values[name].get()`` is None until ``update``; ``lists[name]`` has
    ``get appendValue appendList clear``; ``maps[name]`` has ``getValue
    updateValue removeKey keys values iterator clear``. Timers are
    milliseconds of event time.
    """

    def __init__(self, handle, values, lists, maps):
        self._handle, self.values, self.lists, self.maps = handle, values, lists, maps
        self.watermark_ms = 0

    def timers(self) -> list[int]:
        return list(self._handle.listTimers())

    def wake_at(self, ms: int) -> None:
        self._handle.registerTimer(int(ms))

    def cancel(self, ms: int) -> None:
        self._handle.deleteTimer(int(ms))

    def clear(self) -> None:
        for held in (self.values, self.lists, self.maps):
            for s in held.values():
                s.clear()


class Value:
    """A value state whose ``get`` is None where there is none."""

    def __init__(self, state):
        self._state = state

    def get(self):
        return self._state.get() if self._state.exists() else None

    def update(self, row: tuple) -> None:
        self._state.update(row)

    def clear(self) -> None:
        self._state.clear()


class Processor:
    """Base of stateful steps. Names and row schemas (DDL) of the state are class attributes.

    Every method yields pandas frames of ``output``. ``key`` is a tuple.
    Records of a key may come in several frames per micro-batch; each frame
    has the event time as the column ``event_time``.
    """

    output: str = ""
    values: dict[str, str] = {}
    lists: dict[str, str] = {}
    maps: dict[str, tuple[str, str]] = {}

    def init(self) -> None:
        """Called once in every task before its first key."""

    def process(self, key: tuple, rows: pd.DataFrame, state: State):
        """Records of a key in a micro-batch."""
        yield from ()

    def expired(self, key: tuple, at_ms: int, state: State):
        """A timer that the watermark has passed."""
        yield from ()

    def finish(self, key: tuple, state: dict):
        """The closing step: what the state of a key still holds, by name: tuples, lists of tuples, dicts of tuples."""
        yield from ()


class _Adapter(StatefulProcessor):
    """Runs a :class:`Processor` on ``transformWithState``."""

    def __init__(self, processor: Processor):
        ddl = T.StructType.fromDDL  # only the driver can read DDL
        self.processor = processor
        self.schemas = ({n: ddl(x) for n, x in processor.values.items()}, {n: ddl(x) for n, x in processor.lists.items()},
                        {n: (ddl(k), ddl(v)) for n, (k, v) in processor.maps.items()})

    def init(self, handle) -> None:
        values, lists, maps = self.schemas
        self.state = State(handle, {n: Value(handle.getValueState(n, x)) for n, x in values.items()},
                           {n: handle.getListState(n, x) for n, x in lists.items()},
                           {n: handle.getMapState(n, k, v) for n, (k, v) in maps.items()})
        self.processor.init()

    def handleInputRows(self, key, rows, timerValues):
        self.state.watermark_ms = timerValues.getCurrentWatermarkInMs()
        for pdf in rows:
            yield from self.processor.process(key, pdf, self.state)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self.state.watermark_ms = timerValues.getCurrentWatermarkInMs()
        yield from self.processor.expired(key, expiredTimerInfo.getExpiryTimeInMs(), self.state)

    def close(self) -> None:
        pass


def process_stream(stream: DataFrame, by, time: str, processor: Processor, delay: str = "0 seconds", out: str | None = None,
                   checkpoint: str | None = None, trigger: dict | None = None, wait: bool = True, close: bool = True,
                   timeout_s: float | None = None):
    """Run a processor per key of a stream; every micro-batch's output goes to ``<out>/batch_id=<i>``.

    ``time`` is the event time, ``delay`` how far a record may be behind the
    latest one; records behind the watermark are dropped (and counted in the
    query's progress). With ``close`` a bounded run ends with the closing
    step, whose output goes to ``<out>/batch_id=-1`` and is replaced by that
    of a later run from the same checkpoint. Returns ``(query, out)``.
    """
    spark = stream.sparkSession
    ensure_state_store(spark)
    out = out or scratch_path(spark, "processor-out")
    checkpoint = checkpoint or scratch_path(spark, "processor-ckpt")
    keys = [by] if isinstance(by, str) else list(by)
    ntz = isinstance(stream.schema[time].dataType, T.TimestampNTZType)
    timed = stream.withColumn(EVENT_TIME, ntz_to_instant(column(time)) if ntz else column(time)).withWatermark(EVENT_TIME, delay)
    done = timed.groupBy(*keys).transformWithStateInPandas(
        statefulProcessor=_Adapter(processor), outputStructType=T.StructType.fromDDL(processor.output), outputMode="Append", timeMode="EventTime")

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    q = _start(done.writeStream.outputMode("append").foreachBatch(per_batch), trigger, checkpoint)
    if not wait:
        return q, out
    q = _run(q, timeout_s)
    if close:
        finished(spark, checkpoint, processor).write.mode("overwrite").parquet(f"{out}/batch_id=-1")
    return q, out


def left_state(spark: SparkSession, checkpoint: str, processor: Processor) -> DataFrame:
    """What the state store holds: one row per key, a column for each value, list and map of the processor."""
    def read(name, **options):
        r = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", name)
        for k, v in options.items():
            r = r.option(k, v)
        return r.load()

    parts = [read(n).select("key", F.col("value").alias(n)) for n in processor.values]
    parts += [read(n, flattenCollectionTypes="false").select("key", F.col("list_value").alias(n)) for n in processor.lists]
    parts += [read(n, flattenCollectionTypes="false").select("key", F.map_entries("map_value").alias(n)) for n in processor.maps]
    out = parts[0]
    for p in parts[1:]:
        p = p.withColumnRenamed("key", "__key")
        out = out.join(p, F.col("key").eqNullSafe(F.col("__key")), "full").withColumn("key", F.coalesce("key", "__key")).drop("__key")
    return out


def finished(spark: SparkSession, checkpoint: str, processor: Processor) -> DataFrame:
    """Output of ``finish`` for every key that has state."""
    lists, maps = list(processor.lists), list(processor.maps)
    names = [*processor.values, *lists, *maps]

    def plain(row):
        return None if row is None else tuple(row.values() if isinstance(row, dict) else row)

    def fn(frames):  # frames of many keys go out as one
        held, n = [], 0
        for f in closed(frames):
            held.append(f)
            n += len(f)
            if n >= CLOSED_ROWS:
                yield pd.concat(held, ignore_index=True)
                held, n = [], 0
        if held:
            yield pd.concat(held, ignore_index=True)

    def closed(frames):
        processor.init()
        for pdf in frames:
            for key, *held in pdf.itertuples(index=False, name=None):
                state = dict(zip(names, held))
                for n in names:
                    x = state[n]
                    if n in lists:
                        state[n] = [] if x is None else [plain(r) for r in x]
                    elif n in maps:
                        state[n] = {} if x is None else {plain(e["key"]): plain(e["value"]) for e in x}
                    else:
                        state[n] = plain(x)
                yield from processor.finish(plain(key), state)

    return left_state(spark, checkpoint, processor).select("key", *names).mapInPandas(fn, processor.output)


class OpenRecords(Processor):
    """One open record per key and stretch of activity, sent on when nothing has come for a gap of event time.

    Output: the key (``key`` is its DDL), ``first_us`` and ``last_us`` (event
    time in microseconds) and ``items``. Records of a micro-batch may come in
    any order: a key can have several records open, which grow together when
    the time between them is filled. A key has one timer, for the record
    that is due first.
    """

    #: All open records of a key as one row: a row each would cross to the state store one by one.
    values = {"open": "first_us array<bigint>, last_us array<bigint>, items array<bigint>"}

    def __init__(self, gap_us: int, key: str):
        self.gap_us, self.key = gap_us, [f.name for f in T.StructType.fromDDL(key).fields]
        self.output = f"{key}, first_us long, last_us long, items long"

    def _records(self, held):
        return [tuple(map(int, r)) for r in zip(*held)] if held else []

    def _merged(self, records):
        out = []
        for first, last, items in sorted(records):
            if out and first - out[-1][1] <= self.gap_us:
                out[-1] = (out[-1][0], max(out[-1][1], last), out[-1][2] + items)
            else:
                out.append((first, last, items))
        return out

    def _frame(self, key, records):
        data = {k: [x] * len(records) for k, x in zip(self.key, key)}
        data |= {n: [r[i] for r in records] for i, n in enumerate(("first_us", "last_us", "items"))}
        return pd.DataFrame(data, dtype="object")

    def process(self, key, rows, state):
        at = rows[EVENT_TIME].to_numpy().astype("datetime64[us]")
        us, n = np.unique(at[~np.isnat(at)].astype(np.int64), return_counts=True)
        old = self._records(state.values["open"].get())
        now = self._merged([*old, *zip(us.tolist(), us.tolist(), n.tolist())])
        if not now:
            return
        state.values["open"].update(tuple(map(list, zip(*now))))
        first, due = (min(map(self._due, x), default=None) for x in (old, now))
        if due != first:
            if first is not None:
                state.cancel(first)
            state.wake_at(due)
        yield from ()

    def _due(self, record) -> int:
        return -(-(record[1] + self.gap_us) // 1000)

    def expired(self, key, at_ms, state):
        held, passed = self._records(state.values["open"].get()), max(at_ms, state.watermark_ms)
        over = [r for r in held if self._due(r) <= passed]
        rest = [r for r in held if self._due(r) > passed]
        if rest:
            state.values["open"].update(tuple(map(list, zip(*rest))))
            state.wake_at(min(map(self._due, rest)))
        else:
            state.values["open"].clear()
        if over:
            yield self._frame(key, over)

    def finish(self, key, state):
        if state["open"]:
            yield self._frame(key, self._records(state["open"]))
