"""Array steps at the edges."""

from pyspark.sql import functions as F

from rivulet.functions import arrays as A


def _one(spark, arrays, col):
    df = spark.createDataFrame([(i, a) for i, a in enumerate(arrays)], "i int, a array<double>")
    return [r[0] for r in df.orderBy("i").select(col).collect()]


def test_despike_flat_and_one_spike(spark):
    assert _one(spark, [[1.0] * 6], A.despike("a", 0.2)) == [[1.0] * 6]
    assert _one(spark, [[1.0, 1.0, 5.0, 1.0, 1.0]], A.despike("a", 0.2)) == [[1.0, 1.0, 1.0, 1.0, 1.0]]
    # edges are never changed
    assert _one(spark, [[9.0, 1.0, 9.0]], A.despike("a", 0.2)) == [[9.0, 1.0, 9.0]]


def test_interpolate_touches_listed_positions_only(spark):
    a = [float(i * i) for i in range(8)]
    got = _one(spark, [a], A.interpolate("a", [2, 5]))[0]
    for i, (x, y) in enumerate(zip(a, got)):
        if i in (2, 5):
            assert y == (a[i - 1] + a[i + 1]) / 2
        else:
            assert x == y


def test_short_arrays(spark):
    short = [[], [1.0], [1.0, 2.0], None]
    assert _one(spark, short, A.element_set("a")) == [[], [0], [0, 1], None]
    assert _one(spark, short, A.despike("a", 0.1)) == [[], [1.0], [1.0, 2.0], None]
    assert _one(spark, short, A.baseline("a", 10)) == [None, 1.0, 1.5, None]
    stats = _one(spark, short, A.stats("a"))
    assert stats[0]["mean"] is None and stats[1]["var"] == 0.0 and stats[2]["var"] == 0.25
    assert _one(spark, short, A.over_threshold("a", 1.5)) == [0, 0, 1, None]
    peaks = _one(spark, short, A.peak("a"))
    assert peaks[2]["peak"] == 2.0 and peaks[2]["pos"] == 1


def test_calibrate_keeps_length_and_subtracts(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0, 3.0]), (0, [3.0, 4.0, 5.0]), (1, [10.0, 10.0, 10.0, 10.0])],
                               "label int, a array<double>")
    table = A.calibration_table(df, "a", where=F.col("label") == 0)
    rows = df.where("label = 1").unionByName(spark.createDataFrame([(2, None), (3, [])], df.schema))
    got = {r.label: r.a for r in A.calibrate(rows, "a", table).collect()}
    assert got == {1: [8.0, 7.0, 6.0, None], 2: None, 3: []}
    none = A.calibrate(rows, "a", A.calibration_table(df, "a", where=F.col("label") == 9), "b")
    assert {r.label: r.b for r in none.collect()} == {1: [None] * 4, 2: None, 3: []}


def test_null_elements_are_ignored(spark):
    rows = [[1.0, None, 3.0], [None, None], [2.0]]
    assert _one(spark, rows, A.mean("a")) == [2.0, None, 2.0]
    assert _one(spark, rows, A.baseline("a", 2)) == [1.0, None, 2.0]
    assert [tuple(r) for r in _one(spark, rows, A.stats("a"))] == [(2.0, 1.0, 3.0, 1.0), (None, None, None, None), (2.0, 2.0, 2.0, 0.0)]
    assert _one(spark, rows, A.despike("a", 0.1)) == rows


def test_composed_steps_stay_linear(spark):
    import time

    df = spark.range(400).select(F.transform(F.sequence(F.lit(0), F.lit(3999)), lambda i: F.rand(1) + i * 0).cast("array<float>").alias("f"))
    df = df.cache()
    df.count()

    def seconds(col):
        t = time.perf_counter()
        df.select(col.alias("x")).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t

    seconds(A.despike(A.as_doubles("f"), 0.2))
    one = seconds(A.despike(A.as_doubles("f"), 0.2))
    three = seconds(A.interpolate(A.despike(A.despike(A.as_doubles("f"), 0.2), 0.1), [3, 9]))
    assert three < 8 * one + 1  # quadratic steps take hundreds of times as long


def test_long_calibration_table_builds_fast(spark):
    import time

    table = spark.range(50_000).select(F.col("id").cast("int").alias("pos"), F.lit(1.0).alias("ped"))
    df = spark.range(3).select("id", F.transform(F.sequence(F.lit(1), F.lit(50_000)), lambda i: i.cast("double")).alias("a"))
    t = time.perf_counter()
    out = A.calibrate(df, "a", table)
    built = time.perf_counter() - t
    assert built < 2 and out.select(F.get("a", F.lit(49_999))).first()[0] == 49_999.0


def test_odd_names(spark):
    df = spark.createDataFrame([([1.0, 5.0, 1.0], 2.0)], "`raw:data` array<double>, `@rate` double")
    out = df.select(A.despike(F.col("`raw:data`"), 1.0).alias("x"), F.col("`@rate`")).first()
    assert out["x"] == [1.0, 1.0, 1.0]
