"""Sliding frames, top records and distinct counts against plain windows, with a key that holds half of the rows."""

import random
import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from rivulet.operators.frames import distinct_counts, distinct_sketches, merged_distinct, sliding, top


@pytest.fixture(scope="module")
def df(spark):
    rnd = random.Random(9)
    rows = [(i, rnd.choice(["hot", "hot", f"k{rnd.randint(0, 30)}", None]), None if i % 97 == 0 else rnd.randint(0, 9000), float(rnd.randint(-50, 50)))
            for i in range(5000)]
    return spark.createDataFrame(rows, "i long, k string, t long, v double").repartition(5).cache()


AGGS = {"m": ("avg", "v"), "s": ("sum", "v"), "lo": ("min", "v"), "n": ("count", "v")}


def _with(df, w):
    return df.select("*", F.avg("v").over(w).alias("m"), F.sum("v").over(w).alias("s"), F.min("v").over(w).alias("lo"), F.count("v").over(w).alias("n"))


def _same(a, b):
    cols = b.columns
    return sorted(map(repr, a.select(cols).collect())) == sorted(map(repr, b.collect()))


@pytest.mark.parametrize("rows", [1, 7, 100, 1500])
def test_frames_of_rows(df, rows):
    """Also where a frame reaches over several ranges."""
    got = sliding(df, "k", "t", AGGS, rows=rows, ties=["i"], n_buckets=12)
    w = Window.partitionBy("k").orderBy("t", "i").rowsBetween(1 - rows, 0)
    assert _same(got, _with(df, w))


@pytest.mark.parametrize("span", [0, 50, 3000])
def test_frames_of_values(df, span):
    got = sliding(df, "k", "t", AGGS, span=span, n_buckets=12)
    assert _same(got, _with(df, Window.partitionBy("k").orderBy("t").rangeBetween(-span, 0)))


def test_work_of_a_frame_does_not_grow_with_it(df):
    """No window goes through each frame on its own, and no record is sent to all ranges that its frames reach."""
    for span in (50, 8000):
        plan = sliding(df, "k", "t", {"lo": ("min", "v")}, span=span, n_buckets=12)._jdf.queryExecution().optimizedPlan().toString()
        frames = re.findall(r"specifiedwindowframe\((\w+), ([^,]+), ", plan)
        assert len(frames) >= 2 and {start for _, start in frames} == {"unboundedpreceding$()"}
        assert all("__role" in x for x in plan.splitlines() if "Generate explode" in x) and "__ranges" not in plan
    odd = df.selectExpr("t - 4500 AS t", "CAST(v AS DECIMAL(9, 2)) AS v", "i AS `a b`", "k")
    got = sliding(odd, "k", "t", AGGS, span=700, n_buckets=12)
    want = _with(odd, Window.partitionBy("k").orderBy("t").rangeBetween(-700, 0))
    assert _same(got, want) and [f.dataType for f in got.schema] == [f.dataType for f in want.schema]


def test_frames_spread_a_large_key(df):
    got = sliding(df, "k", "t", AGGS, span=50, n_buckets=12)
    assert got.where("k = 'hot'").select(F.spark_partition_id()).distinct().count() > 1
    with pytest.raises(ValueError):
        sliding(df, "k", "t", AGGS)


@pytest.mark.parametrize("k", [1, 5, 4000])
def test_top_records(df, k):
    order = [F.col("v").desc(), F.col("i")]
    w = Window.partitionBy("k").orderBy(*order)
    want = df.withColumn("r", F.row_number().over(w)).where(F.col("r") <= k).drop("r")
    got = top(df, "k", order, k)
    assert _same(got, want)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert k > 1000 or plan.count("WindowGroupLimit") >= 2
    ties = df.withColumn("r", F.rank().over(Window.partitionBy("k").orderBy(F.col("v").desc()))).where(F.col("r") <= k).drop("r")
    assert _same(top(df, "k", [F.col("v").desc()], k, ties=True), ties)


def test_top_of_everything(df):
    assert [r.i for r in top(df, [], [F.col("i").desc()], 3).orderBy("i").collect()] == [4997, 4998, 4999]
    assert top(df.limit(0), "k", [F.col("i")], 3).count() == 0


def test_distinct_counts_and_sketches(df):
    want = sorted((r.k or "", r.n) for r in df.groupBy("k").agg(F.countDistinct("t").alias("n")).collect())
    assert sorted((r.k or "", r["distinct"]) for r in distinct_counts(df, "k", "t").collect()) == want
    parts = distinct_sketches(df.where("i < 2000"), "k", "t").unionByName(distinct_sketches(df.where("i >= 1500"), "k", "t"))
    for (k, n), (q, m) in zip(want, sorted((r.k or "", r["distinct"]) for r in merged_distinct(parts, "k").collect())):
        assert k == q and abs(m - n) <= max(2, 0.06 * n)
