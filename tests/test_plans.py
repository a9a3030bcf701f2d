"""Physical plan checks: one scan for routing, no single-task window, broadcast lookup."""

from sample_tables import SF_SMALL

import __spark_entry__ as E


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_enqueue_route_one_scan(spark):
    plan = _plan(E.queries()["enqueue_route"](spark, SF_SMALL))
    assert plan.count("FileScan") == 1


def test_running_id_no_single_partition(spark):
    """Large keys are cut without any setting; a limit keeps few rows per task before its shuffle."""
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        for key in ("source_running_id", "throughput"):
            plan = _plan(E.queries()[key](spark, SF_SMALL))
            assert "SinglePartition" not in plan and "bucketizer" in plan.lower()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert "bucketizer" not in _plan(E.queries()["group_by_process"](spark, SF_SMALL)).lower()  # no large key: one window
    assert "WindowGroupLimit" in _plan(E.queries()["source_limit"](spark, SF_SMALL))


def test_source_tree_does_not_shuffle_records(spark):
    plan = _plan(E.queries()["source_tree"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_service_lookup_broadcast(spark):
    plan = _plan(E.queries()["service_lookup"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in plan


def test_pruning_and_pushdown(spark):
    plan = _plan(E.queries()["queue_split"](spark, SF_SMALL))
    assert "ReadSchema: struct<event_id:bigint,value:double>" in plan
    assert "GreaterThan(value,10.0)" in plan and "Generate" not in plan
    calib = _plan(E.queries()["array_despike"](spark, SF_SMALL))
    assert "Exchange" not in calib  # higher-order functions: a map over records


def test_recursive_read_opens_matching_file_only(spark):
    df = E.queries()["source_recursive"](spark, SF_SMALL)
    assert df.inputFiles() and all(f.endswith("nation.parquet") for f in df.inputFiles()) or df.count() == 25
    assert df.count() == 25


def test_write_queues_has_no_shuffle(spark, tmp_path):
    from rivulet.operators.routing import enqueue, write_queues
    from rivulet.functions.conditions import gt

    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    routed = enqueue(ev, {"big": gt("value", 10), "all": gt("value", -1)})
    assert "Exchange" not in _plan(routed)
    write_queues(routed, str(tmp_path / "q"))
    assert spark.read.parquet(str(tmp_path / "q")).count() == routed.count()
