"""Property tests on small random frames (few examples: each one runs Spark jobs)."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from rivulet.functions.conditions import gt, lt, ne
from rivulet.operators.routing import enqueue
from rivulet.operators.sequence import running_values
from rivulet.operators.steps import skip

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

rows_st = st.lists(
    st.tuples(st.sampled_from(["hot", "hot", "hot", "a", "b", None]),
              st.one_of(st.none(), st.floats(-100, 100, allow_nan=False))),
    min_size=0, max_size=120)


@SETTINGS
@given(rows=rows_st, buckets=st.integers(1, 9), seed=st.integers(0, 10**6))
def test_segmented_scan_equals_window(spark, rows, buckets, seed):
    order = list(range(len(rows)))
    import random
    random.Random(seed).shuffle(order)
    data = [(o * 7 + 3, k, v) for o, (k, v) in zip(order, rows)]
    df = spark.createDataFrame(data, "o long, k string, v double")
    got = running_values(df, ["k"], "o", {"n": "count", "s": ("sum", "v"), "hi": ("max", "v")},
                         n_buckets=buckets)
    w = Window.partitionBy("k").orderBy("o")
    wr = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    want = df.select("o", F.row_number().over(w).cast("long").alias("n"),
                     F.round(F.sum("v").over(wr), 6).alias("s"), F.max("v").over(wr).alias("hi"))
    assert sorted(got.select("o", "n", F.round("s", 6).alias("s"), "hi").collect()) == sorted(want.collect())


@SETTINGS
@given(rows=rows_st, a=st.floats(-50, 50), b=st.floats(-50, 50))
def test_routing_and_skip_laws(spark, rows, a, b):
    df = spark.createDataFrame([(i, k, v) for i, (k, v) in enumerate(rows)], "id long, k string, v double")
    conds = {"q1": gt("v", a), "q2": lt("v", b), "q3": ne("k", "hot")}
    routed = enqueue(df, conds)
    assert routed.count() == sum(df.where(c).count() for c in conds.values())
    assert enqueue(df, conds, pass_through=True).count() == len(rows) + routed.count()
    c = gt("v", a)
    assert skip(c)(df).count() + df.where(c).count() == len(rows)
