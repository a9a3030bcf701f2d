"""Streams in the order of event time, whatever the order their files arrive in.

Every micro-batch releases the records that the watermark (the latest event
time seen, less a delay) has passed, and holds the others back in a
versioned table. What is released is therefore in event-time order from
batch to batch, and state can be carried along: running values per key
(:func:`running_stream`) and open sessions (:func:`session_stream`). Records
that come after the watermark has passed them go to a side output. When a
bounded input has ended, a closing step releases what is still held.
:func:`stream_join` joins two streams within a time distance and holds each
record only as long as a partner can still come.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.conditions import column
from ..functions.times import span, ticks
from ..operators.frames import distinct_sketches, merged_distinct
from ..operators.joins import interval_join
from ..operators.sequence import _merge, _total, running_values
from ..operators.sessions import merged_sessions, sessions
from ..session import scratch_path
from .runs import _run, _start
from .versions import KeyedVersions, Versions, drop_folder

_CLOCK = "passed long, latest long, late long, held long"


def results(spark: SparkSession, out: str) -> DataFrame:
    """All that the micro-batches and the closing step have written."""
    return spark.read.option("recursiveFileLookup", "true").parquet(f"{out}/rows")


def late_rows(spark: SparkSession, out: str) -> DataFrame:
    """Records that came after the watermark had passed them, or have no event time."""
    return spark.read.option("recursiveFileLookup", "true").parquet(f"{out}/late")


def clock(spark: SparkSession, out: str, version: int):
    """Watermark, latest event time, late records and records held after a micro-batch."""
    return Versions(spark, f"{out}/clock", _CLOCK).read(version).first()


def _last_version(spark: SparkSession, out: str) -> int:
    """The last micro-batch that was done as a whole: its clock is written last."""
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{out}/clock")
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
    return max((int(n.split("=")[1]) for n in names if n.startswith("version=")), default=-1)


def in_event_order(stream: DataFrame, time: str, each, delay=0, out: str | None = None, checkpoint: str | None = None,
                   trigger: dict | None = None, wait: bool = True, close: bool = True, timeout_s: float | None = None):
    """Call ``each(records, batch, passed)`` with the records that event time has passed, batch after batch.

    ``records`` of a later call are never earlier than those of an earlier
    one. ``each`` returns the frame to write for the batch; it may be called
    again for a batch that failed, with the same records. ``passed`` is the
    watermark in ticks. With ``close`` a bounded run ends with a call for
    all records still held (``passed`` is None). A run that goes on later
    from the same checkpoint takes the closing output back. Returns
    ``(query, out)``.
    """
    spark = stream.sparkSession
    out = out or scratch_path(spark, "event-order")
    checkpoint = checkpoint or f"{out}/checkpoint"
    wide = T.StructType([*stream.schema.fields, T.StructField("__tick", T.LongType())])
    held, clocks = Versions(spark, f"{out}/held", wide), Versions(spark, f"{out}/clock", _CLOCK)
    wait_for, tick = span(spark, delay), ticks(stream.schema, time)

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        drop_folder(spark, f"{out}/rows/closing")
        new = batch.withColumn("__tick", tick).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            was = clocks.read(batch_id - 1).first()
            passed, latest = (was["passed"], was["latest"]) if was else (None, None)
            late = F.col("__tick").isNull() if passed is None else F.col("__tick").isNull() | (F.col("__tick") <= passed)
            new.where(late).drop("__tick").write.mode("overwrite").parquet(f"{out}/late/batch_id={batch_id}")
            seen = new.agg(F.max("__tick").alias("m"), F.coalesce(F.sum(late.cast("long")), F.lit(0)).alias("late")).first()
            latest = max((x for x in (latest, seen["m"]) if x is not None), default=None)
            mark = None if latest is None else max(latest - wait_for, passed if passed is not None else latest - wait_for)
            on_hand = held.read(batch_id - 1).unionByName(new.where(~late))
            ready = F.lit(False) if mark is None else F.col("__tick") <= mark
            each(on_hand.where(ready).drop("__tick"), batch_id, mark).write.mode("overwrite").parquet(f"{out}/rows/batch_id={batch_id}")
            held.write(on_hand.where(~ready), batch_id)
            rest = held.read(batch_id).count()
            clocks.write(spark.createDataFrame([(mark, latest, seen["late"], rest)], _CLOCK), batch_id)
        finally:
            new.unpersist()

    q = _start(stream.writeStream.foreachBatch(per_batch), trigger, checkpoint)
    if not wait:
        return q, out
    q = _run(q, timeout_s)
    if close:
        last = _last_version(spark, out)
        each(held.read(last).drop("__tick"), last + 1, None).write.mode("overwrite").parquet(f"{out}/rows/closing")
    return q, out


def running_stream(stream: DataFrame, by, time: str, aggs: dict, ties=(), delay=0, steps=None, every: int = 8, **run):
    """Running values per key that go on from micro-batch to micro-batch, in event-time order.

    ``aggs`` as in ``running_values``; ``ties`` order records of equal time.
    The totals of each key are versioned state: a batch reads those of its
    keys, and writes those it has changed. Equal to ``running_values`` over
    all records, for any order of the files, as long as none is later than
    ``delay``; later ones are in :func:`late_rows`. Returns ``(query, out)``.
    """
    spark = stream.sparkSession
    keys = [by] if isinstance(by, str) else list(by)
    out = run.pop("out", None) or scratch_path(spark, "running")
    spec = {n: (a, None) if isinstance(a, str) else a for n, a in aggs.items()}
    kinds = {n: T.LongType() for n in spec}
    for n, (fn, c) in spec.items():
        if c is not None:
            kinds[n] = stream.select(_total(fn, c, [time]).alias("x")).schema["x"].dataType
    schema = T.StructType([*[stream.schema[k] for k in keys], *[T.StructField(f"__t_{n}", kinds[n]) for n in spec]])
    state = KeyedVersions(spark, f"{out}/totals", schema, keys, every)
    same = lambda d: [d[f"`{k}`"] for k in keys]

    def each(rows: DataFrame, batch_id: int, passed) -> DataFrame:
        rows = steps(rows) if steps else rows
        before = state.read(batch_id - 1)
        here = rows.groupBy(*[column(k) for k in keys]).agg(*[_total(fn, c, [time, *ties]).alias(f"__h_{n}") for n, (fn, c) in spec.items()])
        on = _all_equal(same(here), same(before))
        moved = here.join(before, on, "left").select(*same(here), *[_merge(fn, F.col(f"__t_{n}"), F.col(f"__h_{n}")).alias(f"__t_{n}")
                                                                     if fn != "last" else F.coalesce(f"__h_{n}", f"__t_{n}").alias(f"__t_{n}")
                                                                     for n, (fn, _) in spec.items()])
        local = running_values(rows, keys, time, {f"__l_{n}": aggs[n] for n in spec}, ties=ties)
        if passed is not None:  # the closing step changes no state
            state.write(moved, batch_id)
        on = _all_equal(same(local), same(before))
        done = local.join(before, on, "left")
        cols = [_merge(fn, F.col(f"__t_{n}"), F.col(f"__l_{n}")).alias(n) for n, (fn, _) in spec.items()]
        return done.select(*[local[f"`{c}`"] for c in rows.columns], *cols)

    return in_event_order(stream, time, each, delay, out=out, **run)


def _all_equal(left: list[Column], right: list[Column]) -> Column:
    cond = F.lit(True)
    for a, b in zip(left, right):
        cond = cond & a.eqNullSafe(b)
    return cond


def session_stream(stream: DataFrame, by, time: str, gap, aggs: dict | None = None, delay=0, **run):
    """Sessions of a stream: each is written once, when the watermark has passed its end by more than the gap.

    Open sessions are the state; a batch merges its own with them. The
    closing step of a bounded run ends all that are open. Equal to
    ``sessions`` over all records, for any order of the files, as long as
    none is later than ``delay``. Returns ``(query, out)``.
    """
    spark = stream.sparkSession
    out = run.pop("out", None) or scratch_path(spark, "session-stream")
    aggs = aggs if aggs is not None else {"items": "count"}
    width = span(spark, gap)
    probe = spark.createDataFrame([], stream.schema)
    schema = sessions(probe, by, time, gap, aggs).schema
    state = Versions(spark, f"{out}/open", schema)

    def each(rows: DataFrame, batch_id: int, passed) -> DataFrame:
        own = sessions(rows, by, time, gap, aggs)
        path = f"{out}/merged/batch_id={batch_id}"
        merged_sessions(own.unionByName(state.read(batch_id - 1)), by, gap, aggs).write.mode("overwrite").parquet(path)
        drop_folder(spark, f"{out}/merged/batch_id={batch_id - 2}")
        now = spark.read.schema(schema).parquet(path)
        if passed is None:
            return now
        over = ticks(schema, "session_end") + width < passed
        state.write(now.where(~over), batch_id)
        return now.where(over)

    return in_event_order(stream, time, each, delay, out=out, **run)


def sketch_stream(stream: DataFrame, time: str, value: str, every: str = "1 hour", by=(), out: str | None = None, checkpoint: str | None = None,
                  trigger: dict | None = None, wait: bool = True, timeout_s: float | None = None):
    """Per micro-batch, window of event time and key: a mergeable sketch of the different values.

    Nothing is late, and a batch that runs again replaces its sketches.
    :func:`distinct_between` merges them over any stretch of windows.
    """
    spark = stream.sparkSession
    out = out or scratch_path(spark, "sketches")
    checkpoint = checkpoint or f"{out}/checkpoint"
    keys = [by] if isinstance(by, str) else list(by)

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        windowed = batch.withColumn("window_start", F.window(column(time), every).start)
        distinct_sketches(windowed, ["window_start", *keys], value).write.mode("overwrite").parquet(f"{out}/rows/batch_id={batch_id}")

    q = _start(stream.writeStream.foreachBatch(per_batch), trigger, checkpoint)
    return (_run(q, timeout_s) if wait else q), out


def distinct_between(spark: SparkSession, out: str, first=None, before=None, by=()) -> DataFrame:
    """Estimated number of different values per key in the windows that start from ``first`` on and before ``before``."""
    rows = results(spark, out)
    if first is not None:
        rows = rows.where(F.col("window_start") >= first)
    if before is not None:
        rows = rows.where(F.col("window_start") < before)
    return merged_distinct(rows, by)


_JOIN_CLOCK = "left_latest long, right_latest long, passed long, late long, left_held long, right_held long"


def join_clock(spark: SparkSession, out: str, version: int):
    """Watermark, late records and records held by each side of :func:`stream_join` after a micro-batch."""
    return Versions(spark, f"{out}/clock", _JOIN_CLOCK).read(version).first()


def stream_join(left: DataFrame, right: DataFrame, on, left_time: str, right_time: str, low, high, left_delay=0, right_delay=0,
                out: str | None = None, checkpoint: str | None = None, trigger: dict | None = None, wait: bool = True,
                suffix: str = "_right", timeout_s: float | None = None):
    """Pairs of two streams with equal ``on`` and ``low <= left_time - right_time <= high``.

    Each side has its watermark (its latest event time less its delay); the
    lesser of the two is the join's. A record is held until the watermark
    has passed the last time that a partner could have, so the state is
    bounded by the streams' rate, the distance and the delays. New records
    meet the other side's new and held ones in one interval join per side
    (no tile is met twice, and large keys are split like any join's). Records that the
    watermark had passed before they came go to :func:`late_rows`. Null
    keys and times match nothing. Returns ``(query, out)``.
    """
    spark = left.sparkSession
    out = out or scratch_path(spark, "stream-join")
    checkpoint = checkpoint or f"{out}/checkpoint"
    lo, hi, dl, dr = (span(spark, x) for x in (low, high, left_delay, right_delay))
    pairs = on if isinstance(on, dict) else {c: c for c in ([on] if isinstance(on, str) else on)}
    sides = {"l": (left, ticks(left.schema, left_time), list(pairs)), "r": (right, ticks(right.schema, right_time), list(pairs.values()))}
    kinds = T.StructType([T.StructField("__tick", T.LongType()), *[T.StructField(f"__k{i}", left.schema[c].dataType) for i, c in enumerate(pairs)]])
    schemas = {s: T.StructType([T.StructField("row", df.schema), *kinds.fields]) for s, (df, _, _) in sides.items()}
    held = {s: Versions(spark, f"{out}/held-{s}", schemas[s]) for s in sides}
    clocks = Versions(spark, f"{out}/clock", _JOIN_CLOCK)

    def tagged(s):
        df, tick, keys = sides[s]
        row = F.struct(*[column(c).alias(c) for c in df.columns])
        null = lambda x: F.lit(None).cast(sides[x][0].schema).alias(x)
        both = [row.alias(s) if x == s else null(x) for x in sides]
        return df.select(F.lit(s).alias("side"), *both, tick.alias("__tick"), *[column(c).cast(kinds[f"__k{i}"].dataType).alias(f"__k{i}") for i, c in enumerate(keys)])

    names = [f"__k{i}" for i in range(len(pairs))]

    def matches(a: DataFrame, b: DataFrame) -> DataFrame:
        b = b.withColumn("__from", F.col("__tick") + lo).withColumn("__to", F.col("__tick") + hi).withColumnRenamed("row", "__other").drop("__tick")
        return interval_join(a, b, "__tick", "__from", "__to", on=names, closed="both").select("row", "__other")

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        new = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            was = clocks.read(batch_id - 1).first()
            passed = was["passed"] if was else None
            late = F.lit(False) if passed is None else F.coalesce(F.col("__tick") < passed, F.lit(False))
            new.where(late).select("side", "l", "r").write.mode("overwrite").parquet(f"{out}/late/batch_id={batch_id}")
            seen = new.agg(*[F.max(F.when(F.col("side") == s, F.col("__tick"))).alias(s) for s in sides],
                           F.coalesce(F.sum(late.cast("long")), F.lit(0)).alias("late")).first()
            latest = {s: max((x for x in (was and was[f"{n}_latest"], seen[s]) if x is not None), default=None) for s, n in (("l", "left"), ("r", "right"))}
            here = {s: new.where((F.col("side") == s) & ~late).select(F.col(s).alias("row"), "__tick", *names) for s in sides}
            old = {s: held[s].read(batch_id - 1) for s in sides}
            found = matches(here["l"], old["r"].unionByName(here["r"])).unionByName(matches(old["l"], here["r"]))
            cols = [F.col("row").getField(c).alias(c) for c in left.columns]
            cols += [F.col("__other").getField(c).alias(c + suffix if c in left.columns else c) for c in right.columns
                     if not (c in left.columns and pairs.get(c) == c)]
            found.select(*cols).write.mode("overwrite").parquet(f"{out}/rows/batch_id={batch_id}")
            mark = None if None in latest.values() else min(latest["l"] - dl, latest["r"] - dr)
            if mark is not None and passed is not None:
                mark = max(mark, passed)
            useful = {s: F.col("__tick").isNotNull() for s in sides}
            if mark is not None:  # a left record meets right ones up to its time - low, a right one left ones up to its time + high
                useful = {"l": F.col("__tick") - lo >= mark, "r": F.col("__tick") + hi >= mark}
            for s in sides:
                known = useful[s]
                for k in names:
                    known = known & F.col(k).isNotNull()
                held[s].write(old[s].unionByName(here[s]).where(known), batch_id)
            sizes = [held[s].read(batch_id).count() for s in sides]
            clocks.write(spark.createDataFrame([(latest["l"], latest["r"], mark, seen["late"], *sizes)], _JOIN_CLOCK), batch_id)
        finally:
            new.unpersist()

    q = _start(tagged("l").unionByName(tagged("r")).writeStream.foreachBatch(per_batch), trigger, checkpoint)
    return (_run(q, timeout_s) if wait else q), out
