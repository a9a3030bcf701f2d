"""Stateful processors: state of all kinds, timers, the closing step, restarts."""

import datetime as dt
import random
import sys

import pandas as pd
from pyspark import cloudpickle

from rivulet.streaming.processor import OpenRecords, Processor, left_state, process_stream
from test_eventtime import _cut, _write

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers do not import tests

BASE = dt.datetime(2024, 1, 1)
SCHEMA = "i long, k string, ts timestamp_ntz"


def _stream(spark, folder):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(folder)


def _rows(n=300, seed=3):
    rnd, t, out = random.Random(seed), {"a": 0, "b": 0, None: 0}, []
    for i in range(n):
        k = rnd.choice(["a", "a", "b", None])
        t[k] += rnd.choice([1, 5, 30, 3000])
        out.append((i, k, BASE + dt.timedelta(seconds=t[k])))
    return sorted(out, key=lambda r: r[2])


def _brute(rows, gap):
    out, last = [], {}
    for _, k, t in sorted(rows, key=lambda r: r[2]):
        s = int((t - BASE).total_seconds())
        if k in last and s - last[k][1] <= gap:
            last[k][1], last[k][2] = s, last[k][2] + 1
        else:
            last[k] = [s, s, 1]
            out.append((k, last[k]))
    return sorted(((k, *r) for k, r in out), key=repr)


def _got(spark, out):
    base = int((BASE - dt.datetime(1970, 1, 1)).total_seconds())
    return sorted(((r.k, r.first_us // 10**6 - base, r.last_us // 10**6 - base, r.items) for r in spark.read.parquet(out).collect()), key=repr)


def test_open_records_with_a_restart(spark, tmp_path):
    """Each record once, by a timer or by the closing step; a restart in the middle changes nothing."""
    rows = _rows()
    parts = _cut(rows)
    for p in parts:
        random.Random(1).shuffle(p)
    args = dict(delay="10 seconds", checkpoint=str(tmp_path / "ckpt"))
    _write(spark, str(tmp_path / "in"), parts, SCHEMA)
    p = OpenRecords(60 * 10**6, "k string")
    _, one = process_stream(_stream(spark, str(tmp_path / "in")), "k", "ts", p, delay="10 seconds", out=str(tmp_path / "one"))
    _write(spark, str(tmp_path / "two"), parts[:2], SCHEMA)
    process_stream(_stream(spark, str(tmp_path / "two")), "k", "ts", p, out=str(tmp_path / "out"), close=False, **args)
    assert left_state(spark, args["checkpoint"], p).count() >= 1
    _write(spark, str(tmp_path / "two"), parts[2:], SCHEMA, start=2)
    _, out = process_stream(_stream(spark, str(tmp_path / "two")), "k", "ts", p, out=str(tmp_path / "out"), **args)
    want = _brute(rows, 60)
    assert _got(spark, one) == want == _got(spark, out)
    closing = spark.read.parquet(out).where("batch_id = -1")
    assert 1 <= closing.count() <= 3 and spark.read.parquet(out).where("batch_id >= 0").count() > 10


class Tally(Processor):
    """Counts per value in a map, the last three ids in a list; a timer sends the tally on and clears the key."""

    output = "k string, n long, ids array<long>, how string"
    values = {"open": "n long"}
    lists = {"ids": "i long"}
    maps = {"per": ("v long", "n long")}

    def init(self):
        self.calls = 0

    def process(self, key, rows, state):
        n = (state.values["open"].get() or (0,))[0] + len(rows)
        state.values["open"].update((n,))
        for i in sorted(rows["i"].tolist()):
            old = state.maps["per"].getValue((i % 2,)) if state.maps["per"].containsKey((i % 2,)) else (0,)
            state.maps["per"].updateValue((i % 2,), (old[0] + 1,))
        kept = [r[0] for r in state.lists["ids"].get()] + sorted(rows["i"].tolist())
        state.lists["ids"].put([(int(i),) for i in kept[-3:]])
        for t in state.timers():
            state.cancel(t)
        state.wake_at(int(rows["event_time"].max().timestamp() * 1000) + 3_600_000)
        yield from ()

    def expired(self, key, at_ms, state):
        yield pd.DataFrame({"k": [key[0]], "n": [state.values["open"].get()[0]], "ids": [[r[0] for r in state.lists["ids"].get()]], "how": ["timer"]})
        state.clear()

    def finish(self, key, state):
        assert sum(n for n, in state["per"].values()) == state["open"][0]
        yield pd.DataFrame({"k": [key[0]], "n": [state["open"][0]], "ids": [[r[0] for r in state["ids"]]], "how": ["closed"]})


def test_all_kinds_of_state(spark, tmp_path):
    at = lambda h: BASE + dt.timedelta(hours=h)
    parts = [[(1, "a", at(0)), (2, "a", at(0)), (3, "b", at(0))], [(4, "b", at(0.5)), (5, "b", at(0.5)), (6, "b", at(0.5))], [(7, "c", at(9))], [(8, "c", at(9))]]
    _write(spark, str(tmp_path / "in"), parts, SCHEMA)
    _, out = process_stream(_stream(spark, str(tmp_path / "in")), "k", "ts", Tally())
    got = sorted((r.k, r.n, sorted(r.ids), r.how) for r in spark.read.parquet(out).collect())
    assert got == [("a", 2, [1, 2], "timer"), ("b", 4, [4, 5, 6], "timer"), ("c", 2, [7, 8], "closed")]


class _Fake:
    """State of one key that counts what is asked of it."""

    def __init__(self, names):
        self.calls, self.held, self.due, self.watermark_ms = 0, None, set(), 0
        self.values, self.lists = ({n: self for n in names} for _ in range(2))

    def get(self):
        return self.held or ()

    def update(self, x):
        self.held, self.calls = x, self.calls + 1

    put = update

    def clear(self):
        self.held = None

    def wake_at(self, ms):
        self.due.add(ms)
        self.calls += 1

    def cancel(self, ms):
        self.due.discard(ms)
        self.calls += 1


def test_open_records_ask_little_of_the_state():
    """Calls to the state and timers do not grow with the records a key has open; each is sent on once it is due."""
    p, state = OpenRecords(60 * 10**6, "k string"), _Fake(["open"])
    for day in (1, 2):
        times = [BASE + dt.timedelta(days=day, hours=h, seconds=s) for h in range(20) for s in (0, 30)]
        assert list(p.process(("a",), pd.DataFrame({"event_time": [*times, None]}), state)) == []
    assert len(state.due) == 1 and state.calls <= 4
    out = []
    while state.due:
        at = min(state.due)
        state.due.discard(at)
        state.watermark_ms = at + 3 * 3_600_000
        out += [r for f in p.expired(("a",), at, state) for r in f.itertuples(index=False, name=None)]
    assert len(out) == 40 and out == sorted(set(out)) and all(k == "a" and n == 2 and last - first == 30 * 10**6 for k, first, last, n in out)
    assert state.held is None
