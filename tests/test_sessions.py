"""Sessions against a loop over sorted records."""

import random

import pytest

from rivulet.operators.sessions import merged_sessions, sessions


def _rows(n=4000, seed=2, lasting=False):
    """Half of the records have one key; null keys and null starts occur; some records last very long."""
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        k = rnd.choice(["hot", "hot", f"k{rnd.randint(0, 40)}", None if rnd.random() < 0.1 else "x"])
        s = None if rnd.random() < 0.01 else rnd.randint(0, n * 4)
        e = s if not lasting or s is None else s + rnd.choice([-5, 0, 3, 9, 700 if rnd.random() < 0.02 else 1])
        out.append((k, s, e, rnd.randint(0, 9)))
    return out


def _brute(rows, gap):
    by = {}
    for k, s, e, v in rows:
        if s is not None:
            by.setdefault(k, []).append((s, max(s, e), v))
    out = []
    for k, rs in by.items():
        cur = None
        for s, e, v in sorted(rs):
            if cur is None or s > cur[1] + gap:
                if cur:
                    out.append((k, *cur))
                cur = [s, e, 0, 0]
            cur[1], cur[2], cur[3] = max(cur[1], e), cur[2] + 1, cur[3] + v
        out.append((k, *cur))
    return sorted(out, key=repr)


AGGS = {"items": "count", "total": ("sum", "v")}


@pytest.mark.parametrize("gap", [0, 3, 40])
@pytest.mark.parametrize("lasting", [False, True])
def test_sessions(spark, gap, lasting):
    rows = _rows(lasting=lasting)
    df = spark.createDataFrame(rows, "k string, s long, e long, v long").repartition(3)
    for buckets in (1, 9):
        got = sessions(df, "k", "s", gap, AGGS, end="e", n_buckets=buckets)
        assert sorted(map(tuple, got.collect()), key=repr) == _brute(rows, gap)


def test_one_session_over_all_ranges(spark):
    """A chain that no range breaks, and one record that covers all others."""
    for rows in ([("a", i, i, 1) for i in range(2000)], [("a", 10 * i, 10 * i, 1) for i in range(2000)] + [("a", 0, 19_990, 1)]):
        df = spark.createDataFrame(rows, "k string, s long, e long, v long")
        assert [tuple(r) for r in sessions(df, "k", "s", 2, AGGS, end="e", n_buckets=12).collect()] == _brute(rows, 2)


def test_merging_sessions_of_parts(spark):
    rows = _rows(lasting=True)
    random.Random(1).shuffle(rows)
    parts = None
    for i in range(3):
        p = sessions(spark.createDataFrame(rows[i::3], "k string, s long, e long, v long"), "k", "s", 5, AGGS, end="e")
        parts = p if parts is None else parts.unionByName(p)
    got = merged_sessions(parts, "k", 5, AGGS, n_buckets=7)
    assert sorted(map(tuple, got.collect()), key=repr) == _brute(rows, 5)


def test_times_and_empty(spark):
    df = spark.sql("SELECT * FROM VALUES (1, TIMESTAMP_NTZ'2024-01-01 00:00:00'), (1, TIMESTAMP_NTZ'2024-01-01 00:30:00'), "
                   "(1, TIMESTAMP_NTZ'2024-01-01 01:00:01') AS t(k, ts)")
    got = sessions(df, "k", "ts", "30 minutes")
    assert sorted((str(r.session_start)[11:], str(r.session_end)[11:], r.items) for r in got.collect()) == [("00:00:00", "00:30:00", 2), ("01:00:01", "01:00:01", 1)]
    assert sessions(df.limit(0), "k", "ts", "30 minutes").count() == 0
    with pytest.raises(ValueError):
        sessions(df, "k", "ts", "1 hour", {"x": ("avg", "k")})
