"""Conditions, steps, routing and the Flow name space (P*, R*, G*, K1)."""

import pytest
from pyspark.sql import functions as F

from rivulet.functions.conditions import as_condition, eq, gt, is_null, lt, ne
from rivulet.operators.keyed import grouped, lookup, number, running
from rivulet.operators.metrics import batch_count, observed
from rivulet.operators.routing import QUEUE_COL, enqueue, split_queue, write_queues, read_queue
from rivulet.operators.steps import chain, copy_keys, create_id, rename_key, skip
from rivulet.plans.flow import Flow


@pytest.fixture()
def null_flag(spark):
    return spark.createDataFrame([(1, "A"), (2, "B"), (3, None)], "id bigint, flag string")


def test_null_safe_conditions(null_flag):
    kept = null_flag.where(ne("flag", "A")).select("id").collect()
    assert sorted(r.id for r in kept) == [2, 3]
    assert [r.id for r in null_flag.where(eq("flag", "B")).collect()] == [2]
    assert [r.id for r in null_flag.where(is_null("flag")).collect()] == [3]
    # SQL text: null compares as a value there too
    assert null_flag.where(as_condition("flag != 'A'")).count() == 2
    assert null_flag.select(lt("flag", "B").alias("x")).where("x is null").count() == 0


def test_two_queue_example(null_flag):
    # flag != 'A' → gamma, flag = 'B' → hadron: record 2 goes to both queues.
    routed = enqueue(null_flag, {"gamma": ne("flag", "A"), "hadron": eq("flag", "B")})
    got = sorted((r.id, r[QUEUE_COL]) for r in routed.collect())
    assert got == [(2, "gamma"), (2, "hadron"), (3, "gamma")]
    assert sorted(r.id for r in split_queue(routed, "gamma").collect()) == [2, 3]
    assert QUEUE_COL not in split_queue(routed, "gamma").columns


def test_routed_rows_equal_sum_of_matches(events):
    conds = {"a": gt("value", 100), "b": ne("event_type", "click"), "c": lt("value", 5)}
    routed = enqueue(events, conds)
    assert routed.count() == sum(events.where(c).count() for c in conds.values())
    passed = enqueue(events, conds, pass_through=True)
    assert passed.count() == events.count() + routed.count()


def test_skip_plus_kept_is_input(events):
    t = F.nullif(F.col("event_type"), F.lit("error"))
    c = ne(t, "view")
    assert skip(c)(events).count() + events.where(c).count() == events.count()
    # a null condition keeps the record
    assert skip(F.lit(None).cast("boolean"))(events).count() == events.count()


def test_steps_rename_copy_id_chain(spark):
    df = spark.createDataFrame([(3, 1.5), (1, 2.5), (2, 3.5)], "o long, v double")
    out = chain([rename_key("v", "raw:data"), copy_keys({"raw:data": "raw:copy"})],
                create_id("id", order_by="o"), rename_key("missing", "x"))(df)
    assert out.columns == ["o", "raw:data", "raw:copy", "id"]
    assert sorted((r.o, r.id) for r in out.collect()) == [(1, 1), (2, 2), (3, 3)]
    uniq = create_id("uid")(df)
    assert uniq.select("uid").distinct().count() == 3


def test_flow_names_and_errors(events):
    flow = Flow()
    flow.source("data", events)
    flow.process("p", input="data", output=["a", "b"], steps=[skip(eq("event_type", "error"))])
    assert flow["a"] is flow["b"]
    with pytest.raises(KeyError):
        flow.process("q", input="nope")
    with pytest.raises(ValueError):
        flow.process("r", input="data", output="a")
    flow.process("t", input="data")  # no output, no queue: terminal
    assert flow.counts() == {"t": events.count()}
    # blank output is no output
    flow.process("u", input="data", output="  ")
    assert "u" in flow.terminals


def test_flow_queue_union_of_producers(events):
    flow = Flow()
    flow.source("data", events)
    flow.process("p1", input="data", queues={"q": eq("event_type", "view")})
    flow.process("p2", input="data", queues={"q": eq("event_type", "click")})
    n = events.where(F.col("event_type").isin("view", "click")).count()
    assert flow["q"].count() == n
    with pytest.raises(ValueError):
        flow.source("q", events)


def test_fanout_reads_once(events):
    flow = Flow()
    flow.source("data", events)
    flow.process("p", input="data", output=["a", "b"])
    plan = flow.union_of(["a", "b"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_grouped_process_and_copies(spark):
    df = spark.createDataFrame([(None, 1, 1.0), ("a", 2, 2.0), (None, 3, 3.0)], "k string, o long, v double")
    out = grouped(df, "k", [number("seq"), running({"tot": ("sum", "v")})], order_by="o", copies=3)
    got = sorted((r.k or "", r.o, r.seq, r.tot) for r in out.collect())
    assert got == [("", 1, 1, 1.0), ("", 3, 2, 4.0), ("a", 2, 1, 2.0)]
    # stateless steps in a grouped process need no shuffle
    plain = grouped(df, "k", [skip(eq("k", "a"))])
    assert "Exchange" not in plain._jdf.queryExecution().executedPlan().toString()


def test_lookup_of_null_and_unknown_keys(spark):
    left = spark.createDataFrame([(1, 10), (2, 20), (3, None)], "id int, key int")
    ref = spark.createDataFrame([(10, "x"), (20, "y")], "k int, name string")
    small = lookup(left, ref, {"key": "k"}, ["name"])
    assert sorted((r.id, r.name) for r in small.collect()) == [(1, "x"), (2, "y"), (3, None)]


def test_batch_count_and_observed(events):
    bc = batch_count(events, "ts", emitted=ne("event_type", "error"))
    tot = bc.agg(F.sum("processed"), F.sum("emitted")).first()
    assert tot[0] == events.count()
    assert tot[1] == events.where(F.col("event_type") != "error").count()
    df, obs = observed(events, emitted=ne("event_type", "error"))
    df.write.format("noop").mode("overwrite").save()
    assert obs.get["processed"] == events.count()


def test_write_queues_one_folder_per_queue(spark, events, tmp_path):
    routed = enqueue(events, {"gamma": ne("event_type", "click"), "hadron": gt("value", 10)})
    out = str(tmp_path / "queues")
    write_queues(routed, out)
    assert sorted(p.name for p in (tmp_path / "queues").iterdir() if p.is_dir()) == [
        "spark_queue=gamma", "spark_queue=hadron"]
    assert read_queue(spark, out, "hadron").count() == events.where(F.col("value") > 10).count()


def test_named_service_lookup(spark):
    customers = spark.read.parquet("/root/testdata/sf0.001/customer.parquet").select("c_custkey", "c_nationkey")
    nation = spark.read.parquet("/root/testdata/sf0.001/nation.parquet")
    flow = Flow()
    flow.source("customers", customers)
    flow.service("nations", nation)
    flow.process("named", input="customers", output="out",
                 steps=[flow.lookup("nations", {"c_nationkey": "n_nationkey"}, ["n_name"])])
    out = flow["out"]
    assert out.count() == customers.count() and out.where("n_name is null").count() == 0
    flow.process("missing", input="customers", output="none", steps=[flow.lookup("nope", "c_nationkey", "n_name")])
    assert flow["none"].where("n_name is not null").count() == 0


def test_source_copies(events):
    flow = Flow()
    df = flow.source("data", events, copies=4, copy_key="user_id")
    assert df.count() == events.count()
    assert {r.copy for r in df.select("copy").distinct().collect()} <= {0, 1, 2, 3}
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan


def test_copies_shuffle_only_without_group_steps(spark):
    df = spark.createDataFrame([(i % 3, i, float(i)) for i in range(30)], "k int, o long, v double")
    plain = grouped(df, "k", [skip(eq("k", 1))], copies=4)
    assert "RoundRobinPartitioning(4)" in plain._jdf.queryExecution().executedPlan().toString()
    with_group = grouped(df, "k", [number("seq")], order_by="o", copies=4)
    assert "RoundRobinPartitioning" not in with_group._jdf.queryExecution().executedPlan().toString()


def test_keep_select_and_map_in_pandas_steps(spark):
    from rivulet.operators.steps import keep, map_in_pandas, select_keys

    df = spark.createDataFrame([(1, 2.0), (2, None), (3, 7.0)], "id long, `raw:v` double")

    def double(batches):
        for pdf in batches:
            pdf["raw:v"] = pdf["raw:v"] * 2
            yield pdf

    out = chain(keep(gt("raw:v", 1)), select_keys("id", "raw:v"), map_in_pandas(double, df.schema))(df)
    assert sorted((r["id"], r["raw:v"]) for r in out.collect()) == [(1, 4.0), (3, 14.0)]


def test_names_with_dots_and_text_conditions(spark):
    from rivulet.functions.conditions import as_condition, eq, gt, null_safe_text

    df = spark.createDataFrame([(1, "A", 2), (2, "B", 3), (3, None, None)], "id int, flag string, `shower.x` int")
    ids = lambda c: sorted(r.id for r in df.where(as_condition(c)).collect())
    assert ids(eq("shower.x", 2)) == [1] and ids(gt("shower.x", 1)) == [1, 2]
    assert ids("flag != 'A'") == [2, 3] and ids("flag <> 'A' AND id >= 2") == [2, 3] and ids("flag = 'A' OR id == 3") == [1, 3]
    assert ids("flag = '!= x'") == [] and null_safe_text("a <= 1 AND b <=> '='") == "a <= 1 AND b <=> '='"


def test_lookup_never_multiplies_records(spark):
    from rivulet.operators.keyed import lookup

    df = spark.createDataFrame([(1, "a"), (2, None), (3, "z")], "id int, k string")
    ref = spark.createDataFrame([("a", "x"), ("a", "b"), (None, "n")], "k string, v string")
    assert sorted(map(tuple, lookup(df, ref, "k", ["v"]).select("id", "v").collect())) == [(1, "b"), (2, None), (3, None)]


def test_copies_set_the_tasks_of_a_grouped_process(spark):
    from rivulet.operators.keyed import grouped, running

    df = spark.createDataFrame([(i, i % 7) for i in range(100)], "o long, k int")
    out = grouped(df, "k", [running({"n": "count"})], order_by="o", copies=3)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and ", 3)" in plan
    assert out.rdd.getNumPartitions() == 3
