"""Event-time order, versioned state, streaming sessions and joins, with restarts and retried batches."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from rivulet.operators.sessions import sessions
from rivulet.streaming.eventtime import clock, distinct_between, in_event_order, join_clock, late_rows, results, running_stream, session_stream, sketch_stream, stream_join
from rivulet.streaming.versions import KeyedVersions, Versions

SCHEMA = "i long, k string, t long, v long"
AGGS = {"items": "count", "total": ("sum", "v")}


def _write(spark, folder, rows, schema=SCHEMA, start=0):
    """One file per list of rows, read in this order."""
    import os
    import time

    os.makedirs(folder, exist_ok=True)
    for n, part in enumerate(rows, start):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("overwrite").json(f"{folder}-{n}")
        src = next(f for f in os.listdir(f"{folder}-{n}") if f.endswith(".json"))
        os.rename(f"{folder}-{n}/{src}", f"{folder}/part-{n}.json")
        os.utime(f"{folder}/part-{n}.json", (time.time() - 1000 + n, time.time() - 1000 + n))


def _stream(spark, folder, schema=SCHEMA):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(folder)


def _rows(n=600, seed=4, disorder=0):
    """Times go up by file; ``disorder`` moves records up to that far back."""
    rnd = random.Random(seed)
    out = [(i, rnd.choice(["hot", "hot", "a", "b", None]), i * 3 + rnd.randint(0, 2), rnd.randint(0, 9)) for i in range(n)]
    return sorted(out, key=lambda r: r[2] + rnd.randint(0, disorder))


def _cut(rows, n=4):
    return [rows[j * len(rows) // n:(j + 1) * len(rows) // n] for j in range(n)]


def test_order_by_event_time_with_late_records(spark, tmp_path):
    """Records leave in event-time order; one far behind the watermark, and one without time, go aside."""
    parts = _cut(_rows(disorder=60))
    parts[2].append((9001, "late", 1, 1))
    parts[1].append((9002, "none", None, 1))
    _write(spark, str(tmp_path / "in"), parts)
    calls = []

    def each(rows, batch, passed):
        span = rows.agg(F.min("t"), F.max("t")).first()
        calls.append((batch, passed, *span))
        return rows

    _, out = in_event_order(_stream(spark, str(tmp_path / "in")), "t", each, delay=100, out=str(tmp_path / "out"))
    spans = [c[2:] for c in calls if c[2] is not None]
    assert len(calls) == 5 and calls[-1][1] is None and all(a[1] < b[0] for a, b in zip(spans, spans[1:]))
    assert sorted(r.i for r in results(spark, out).collect()) == list(range(600))
    assert sorted(r.i for r in late_rows(spark, out).collect()) == [9001, 9002]
    last = clock(spark, out, 3)
    assert last.passed == last.latest - 100 and 0 < last.held < 100


def test_running_values_go_on_over_batches(spark, tmp_path):
    """Equal to one pass over all records, for files that overlap in time, also after a stop in the middle and a retried batch."""
    rows = _rows(disorder=90)
    parts = _cut(rows)
    _write(spark, str(tmp_path / "in"), parts[:2])
    aggs = {"n": "count", "s": ("sum", "v"), "lo": ("min", "v"), "hi": ("max", "v"), "last": ("last", "v")}
    args = dict(ties=["i"], delay=200, every=2, out=str(tmp_path / "out"))
    running_stream(_stream(spark, str(tmp_path / "in")), "k", "t", aggs, **args)
    _write(spark, str(tmp_path / "in"), parts[2:], start=2)
    # the second batch's commit is lost: it runs again, over its own output
    for f in (tmp_path / "out/checkpoint/commits").glob("*1*"):
        f.unlink()
    _, out = running_stream(_stream(spark, str(tmp_path / "in")), "k", "t", aggs, **args)
    w = Window.partitionBy("k").orderBy("t", "i").rowsBetween(Window.unboundedPreceding, 0)
    df = spark.createDataFrame(rows, SCHEMA)
    want = df.select("*", F.count("*").over(w).alias("n"), F.sum("v").over(w).alias("s"), F.min("v").over(w).alias("lo"),
                     F.max("v").over(w).alias("hi"), F.last("v", True).over(w).alias("last"))
    key = lambda d: sorted((tuple(r) for r in d.select(want.columns).collect()), key=repr)
    assert key(results(spark, out)) == key(want)


def test_streaming_sessions(spark, tmp_path):
    """Four unsorted files, in two runs: the sessions of all records."""
    rows = _rows(disorder=0)
    rows = [r for r in rows if (r[0] // 7) % 5]  # leaves gaps
    random.Random(3).shuffle(rows)
    parts = _cut(rows)
    _write(spark, str(tmp_path / "in"), parts[:3])
    session_stream(_stream(spark, str(tmp_path / "in")), "k", "t", 9, AGGS, delay=5000, out=str(tmp_path / "out"))
    _write(spark, str(tmp_path / "in"), parts[3:], start=3)
    _, out = session_stream(_stream(spark, str(tmp_path / "in")), "k", "t", 9, AGGS, delay=5000, out=str(tmp_path / "out"))
    want = sessions(spark.createDataFrame(rows, SCHEMA), "k", "t", 9, AGGS)
    assert sorted(map(tuple, results(spark, out).select(want.columns).collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def test_sessions_leave_the_state_when_closed(spark, tmp_path):
    """With files in time order and a small delay, only open sessions are held."""
    rows = [r for r in _rows() if (r[0] // 7) % 5]
    _write(spark, str(tmp_path / "in"), _cut(rows, 6))
    _, out = session_stream(_stream(spark, str(tmp_path / "in")), "k", "t", 9, AGGS, delay=0, out=str(tmp_path / "out"))
    want = sessions(spark.createDataFrame(rows, SCHEMA), "k", "t", 9, AGGS)
    assert sorted(map(tuple, results(spark, out).select(want.columns).collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    assert Versions(spark, f"{out}/open", want.schema).read(5).count() <= 4


@pytest.mark.parametrize("low,high", [(0, 20), (-15, 5)])
def test_stream_join_equals_batch_join(spark, tmp_path, low, high):
    """Pairs over all files of both sides; state is bounded, late records go aside, a restart changes nothing."""
    rnd = random.Random(6)
    a = [(i, rnd.choice(["x", "x", "y", None]), 2 * i + rnd.randint(0, 9), 0) for i in range(400)]
    b = [(i, rnd.choice(["x", "y", "z"]), 3 * i + rnd.randint(0, 9), 1) for i in range(250)]
    a[399] = (399, "x", None, 0)
    pa, pb = _cut(a), _cut(b)
    _write(spark, str(tmp_path / "a"), pa[:2])
    _write(spark, str(tmp_path / "b"), pb[:2], "j long, k string, u long, w long")
    b_schema = "j long, k string, u long, w long"
    join = lambda: stream_join(_stream(spark, str(tmp_path / "a")), _stream(spark, str(tmp_path / "b"), b_schema), "k", "t", "u", low, high,
                               60, 60, out=str(tmp_path / "out"))
    join()
    pa[3].append((9001, "x", 0, 0))
    _write(spark, str(tmp_path / "a"), pa[2:], start=2)
    _write(spark, str(tmp_path / "b"), pb[2:], b_schema, start=2)
    _, out = join()
    want = sorted((x[0], y[0]) for x in a for y in b if x[1] is not None and x[1] == y[1] and x[2] is not None and low <= x[2] - y[2] <= high)
    assert sorted((r.i, r.j) for r in results(spark, out).collect()) == want
    assert [r.l.i for r in late_rows(spark, out).collect()] == [9001]
    state = join_clock(spark, out, 3)
    assert state.passed == min(max(x[2] for x in a if x[2] is not None), max(y[2] for y in b)) - 60
    assert state.left_held < 120 and state.right_held < 100


def test_keyed_versions_read_a_bounded_log(spark, tmp_path):
    """Over 20 batches a read opens one snapshot and the few changes since; removed keys are gone."""
    state = KeyedVersions(spark, str(tmp_path / "s"), "k string, n long", ["k"], every=4)
    want, rnd = {}, random.Random(1)
    assert state.read(-1).count() == 0
    for v in range(20):
        changed = {rnd.choice(["a", "b", "c", "d", None]): v * 10 + i for i in range(3)}
        want |= changed
        rows = spark.createDataFrame(list(changed.items()), "k string, n long")
        for _ in range(1 + v % 2):  # every second batch runs twice
            state.write(rows, v, gone=F.col("k") == "d")
        if "d" in changed:
            want.pop("d")
        assert {r.k: r.n for r in state.read(v).collect()} == want
        assert len(state.paths(v)) <= 4
    assert len([p for p in (tmp_path / "s").iterdir() if p.is_dir()]) <= 14


def test_sketches_of_batches_merge(spark, tmp_path):
    """Different values over any stretch of windows, within three standard errors (1.04 / 64 each) of the exact number."""
    rnd = random.Random(2)
    schema = "i long, k string, ts timestamp_ntz, v long"
    import datetime as dt
    rows = [(i, rnd.choice("ab"), dt.datetime(2024, 1, 1) + dt.timedelta(minutes=rnd.randint(0, 600)), rnd.randint(0, 3000)) for i in range(6000)]
    _write(spark, str(tmp_path / "in"), _cut(rows, 3), schema)
    _, out = sketch_stream(_stream(spark, str(tmp_path / "in"), schema), "ts", "v", by="k")
    for first, before in ((None, None), (dt.datetime(2024, 1, 1, 2), dt.datetime(2024, 1, 1, 5))):
        lit = lambda t: t and F.lit(str(t)).cast("timestamp_ntz")
        got = {r.k: r["distinct"] for r in distinct_between(spark, out, first and lit(first), before and lit(before), by="k").collect()}
        for k in "ab":
            n = len({r[3] for r in rows if r[1] == k and (first is None or first <= r[2] < before)})
            assert abs(got[k] - n) <= 3 * 1.04 / 64 * n
