"""File sources: recursive read, suffix regex, broken and empty files, blocks."""

import gzip

import pytest
from pyspark.sql import functions as F

from rivulet.sources.files import failed_files, file_blocks, list_files, read_file_blocks, read_recursive
from rivulet.sources.generated import (assign_copies, lines_of, random_items, random_value, read_lines,
                                      union_sources)


@pytest.fixture()
def tree(tmp_path):
    (tmp_path / "x" / "y").mkdir(parents=True)
    with gzip.open(tmp_path / "x" / "ok.log.gz", "wt") as f:
        f.write("first\nsecond\n")
    whole = gzip.compress(("line\n" * 5000).encode())
    (tmp_path / "bad.log.gz").write_bytes(whole[: len(whole) // 2])
    (tmp_path / "empty.log").write_text("")
    (tmp_path / "x" / "y" / "z.log").write_text("z1\nz2\nz3\n")
    (tmp_path / "x" / "y" / "z.txt").write_text("not a log\n")
    return tmp_path


def test_recursive_lines_with_suffix_regex(spark, tree):
    df = read_lines(spark, str(tree), ending=r"\.log(\.gz)?", skip_errors=True)
    files = {r["source_file"].rsplit("/", 1)[-1] for r in df.select("source_file").distinct().collect()}
    assert "z.txt" not in files and {"ok.log.gz", "z.log"} <= files
    lines = [r["line"] for r in df.where(F.col("source_file").endswith("ok.log.gz")).collect()]
    assert lines == ["first", "second"]
    # the suffix is a regex on the full path: '.' matches any character
    assert list_files(spark, str(tree), "z.log").count() == 1
    assert list_files(spark, str(tree), "z.txt").count() == 1


def test_failed_files_lists_unfinished_files(spark, tree):
    failed = {r["path"].rsplit("/", 1)[-1] for r in failed_files(spark, str(tree), r"\.log(\.gz)?").collect()}
    # the empty file is not a failure
    assert "empty.log" not in failed and "ok.log.gz" not in failed
    read = read_lines(spark, str(tree), ending=r"bad\.log\.gz", skip_errors=True).count()
    assert read < 2000 and "bad.log.gz" in failed  # cut off: listed although it gave records


def test_recursive_parquet_only_matching_files(spark):
    df = read_recursive(spark, "/root/testdata/sf0.001", r"nation\.parquet", with_path=True)
    assert df.count() == 25
    assert df.select("source_file").distinct().count() == 1


def test_file_blocks_cover_once(spark):
    listing = spark.createDataFrame([(f"f{i:03d}",) for i in range(25)], "path string")
    b = file_blocks(listing, "path", 22, 4).collect()
    assert len(b) == 22 and len({r.path for r in b}) == 22
    sizes = [sum(1 for r in b if r.copy == c) for c in range(4)]
    assert sizes == [5, 5, 5, 7]
    # more copies than files
    few = file_blocks(listing, "path", 3, 8).collect()
    assert sorted(r.copy for r in few) == [0, 1, 2]


def test_read_file_blocks_tags_records(spark, tmp_path):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    ev.repartition(6).write.parquet(str(tmp_path / "ev"))
    df = read_file_blocks(spark, str(tmp_path / "ev"), r"\.parquet", 5, 2)
    per_copy = {r["copy"]: r["count"] for r in df.groupBy("copy").count().collect()}
    assert set(per_copy) == {0, 1}
    assert sum(per_copy.values()) < ev.count()  # 5 of 6 files


def test_lines_and_random_and_copies(spark):
    docs = spark.createDataFrame([(1, "a\nb\n"), (2, ""), (3, None)], "doc_id long, text string")
    got = sorted((r.doc_id, r.line_no, r.line) for r in lines_of(docs, "text", keep="doc_id").collect())
    assert got == [(1, 0, "a"), (1, 1, "b"), (1, 2, ""), (2, 0, "")]
    r = random_items(spark, 1000, num_partitions=4)
    assert r.count() == 1000 and r.where((F.col("x") < 0) | (F.col("x") >= 1)).count() == 0
    big = spark.range(10**10 - 3, 10**10).withColumn("x", random_value(F.col("id"))).collect()
    want = [((i % 2**31) * 1103515245 + 12345) % 2**31 / 2**31 for i in range(10**10 - 3, 10**10)]
    assert [r.x for r in big] == want
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    c = assign_copies(ev, 4, key="user_id")
    assert c.select("copy").distinct().count() <= 4 and c.count() == ev.count()
    u = union_sources(ev.select("event_id"), ev.select("event_id", "user_id"))
    assert u.columns == ["event_id", "user_id"] and u.count() == 2 * ev.count()


def test_item_limit_and_running_id(spark, capsys, tmp_path):
    from rivulet.operators.sinks import preview, print_data
    from rivulet.sources.limits import item_limit, running_id

    ev = assign_copies(spark.read.parquet("/root/testdata/sf0.001/events.parquet"), 3, key="user_id")
    lim = item_limit(ev, 7, order_by="event_id", copy_col="copy")
    assert sorted(r["count"] for r in lim.groupBy("copy").count().collect()) == [7, 7, 7]
    assert item_limit(ev, 5).count() == 5
    ids = running_id(ev, "event_id", "copy")
    for r in ids.groupBy("copy").agg(F.min("ID").alias("a"), F.max("ID").alias("b"), F.count("*").alias("c")).collect():
        assert r["a"] == 1 and r["b"] == r["c"]
    preview(lim, 3)
    assert "event_id" in capsys.readouterr().out
    print_data(lim, str(tmp_path / "printed"))  # every record, as text
    assert spark.read.text(str(tmp_path / "printed")).count() == 21


def test_read_lines_as_stream(spark, tree, tmp_path):
    stream = read_lines(spark, str(tree), ending=r"\.log", stream=True, maxFilesPerTrigger=1)
    out = tmp_path / "lines"
    q = (stream.writeStream.format("parquet").option("path", str(out))
         .option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start())
    q.awaitTermination(300)
    assert q.exception() is None
    got = sorted(r["line"] for r in spark.read.parquet(str(out)).collect())
    assert got == ["z1", "z2", "z3"]


def _line_tree(tmp_path):
    d = tmp_path / "lines"
    (d / "sub").mkdir(parents=True)
    for i in range(5):
        sub = d / "sub" if i % 2 else d
        (sub / f"f{i}.log").write_text("".join(f"f{i}-{j}\n" for j in range(i + 2)))
    (d / "skip.txt").write_text("no\n")
    return d


def test_file_tree_ids_in_reading_order(spark, tmp_path):
    from rivulet.sources.files import read_file_tree

    d = _line_tree(tmp_path)
    df = read_file_tree(spark, str(d), r"\.log", copies=2, limit_files=4)
    got = sorted((r["copy"], r["ID"], r["value"]) for r in df.collect())
    lim = sorted((r["copy"], r["ID"]) for r in
                 read_file_tree(spark, str(d), r"\.log", copies=2, limit_files=4, item_limit=3).collect())
    # paths sorted: .../lines/f0.log, f2.log, f4.log, sub/f1.log, sub/f3.log → first 4 kept
    files = sorted([str(d / f"f{i}.log") for i in (0, 2, 4)] + [str(d / "sub" / f"f{i}.log") for i in (1, 3)])[:4]
    want = []
    for copy, block in ((0, files[:2]), (1, files[2:])):
        lines = [line for f in block for line in open(f).read().split()]
        want += [(copy, i + 1, line) for i, line in enumerate(lines)]
    assert got == sorted(want)
    assert lim == [(0, 1), (0, 2), (0, 3), (1, 1), (1, 2), (1, 3)]


def test_file_tree_parquet_row_order(spark, tmp_path):
    from rivulet.sources.files import read_file_tree

    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("event_id")
    ev.repartitionByRange(6, "event_id").sortWithinPartitions("event_id").write.parquet(str(tmp_path / "ev"))
    df = read_file_tree(spark, str(tmp_path / "ev"), r"\.parquet", fmt="parquet", copies=3)
    from pyspark.sql import Window
    want = ev.join(df.select("event_id", "copy"), "event_id").withColumn(
        "want", F.row_number().over(Window.partitionBy("copy").orderBy("event_id")))
    assert want.join(df, ["event_id", "copy"]).where("want != ID").count() == 0
    assert df.count() == ev.count()


def test_random_source_copies_batch_and_stream(spark, tmp_path):
    from rivulet.sources import generator

    generator.register(spark)
    df = spark.read.format("rivulet_random").option("limit", 1003).option("copies", 4).load()
    assert df.rdd.getNumPartitions() == 4
    rows = df.collect()
    assert sorted(r.id for r in rows) == list(range(1003))
    sizes = [sum(1 for r in rows if r.copy == c) for c in range(4)]
    assert sizes == [250, 250, 250, 253]
    want = {r.id: r.x for r in random_items(spark, 1003).collect()}
    assert all(r.x == want[r.id] for r in rows)
    # as a bounded stream: all items once, nothing new after a restart
    out, ckpt = str(tmp_path / "o"), str(tmp_path / "c")
    for _ in range(2):
        q = (spark.readStream.format("rivulet_random").option("limit", 1003).option("copies", 4).load()
             .writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt)
             .trigger(availableNow=True).start())
        q.awaitTermination(300)
        assert q.exception() is None
    assert spark.read.parquet(out).count() == 1003


def test_read_table_as_stream(spark, tmp_path):
    from rivulet.sources.files import read_table

    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    ev.repartitionByRange(3, "event_id").write.parquet(str(tmp_path / "ev"))
    stream = read_table(spark, str(tmp_path / "ev"), stream=True, maxFilesPerTrigger=1)
    assert stream.isStreaming and stream.schema == ev.schema
    q = (stream.writeStream.format("parquet").option("path", str(tmp_path / "o"))
         .option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start())
    q.awaitTermination(300)
    assert q.exception() is None and len([p for p in q.recentProgress if p["numInputRows"]]) == 3
    assert spark.read.parquet(str(tmp_path / "o")).count() == ev.count()


def test_odd_file_names_lose_nothing(spark, tmp_path):
    from rivulet.sources.files import failed_files, read_file_blocks, read_file_tree

    names = ["a b.log", "a%20b.log", "a[1].log", "p+q.log", "plain.log", "{x,y}.log", "ü.log"]
    for i, n in enumerate(names):
        (tmp_path / n).write_text("".join(f"{n}-{j}\n" for j in range(i + 1)))
    want = sorted(f"{n}-{j}" for i, n in enumerate(names) for j in range(i + 1))
    assert list_files(spark, str(tmp_path), r"\.log").count() == len(names)
    assert sorted(r.value for r in read_recursive(spark, str(tmp_path), r"\.log", fmt="text").collect()) == want
    assert read_recursive(spark, str(tmp_path), r"a b\.log", fmt="text").count() == 1
    blocks = read_file_blocks(spark, str(tmp_path), r"\.log", None, 3, fmt="text")
    assert sorted(r.value for r in blocks.collect()) == want
    tree = read_file_tree(spark, str(tmp_path), r"\.log", copies=2).collect()
    assert sorted(r.value for r in tree) == want
    for c in (0, 1):
        assert sorted(r.ID for r in tree if r["copy"] == c) == list(range(1, 1 + sum(r["copy"] == c for r in tree)))
    assert failed_files(spark, str(tmp_path), r"\.log").count() == 0


def test_folder_tables_and_merged_schemas(spark, tmp_path):
    from rivulet.sources.files import read_file_tree

    spark.range(5).repartition(2).write.parquet(str(tmp_path / "t" / "a.parquet"))
    spark.range(5, 8).withColumn("x", F.col("id") * 2).write.parquet(str(tmp_path / "t" / "b" / "a.parquet"))
    df = read_recursive(spark, str(tmp_path), r"/a\.parquet")
    assert sorted(df.columns) == ["id", "x"] and df.count() == 8
    tree = read_file_tree(spark, str(tmp_path), r"/a\.parquet", fmt="parquet", copies=1).collect()
    assert sorted(r.ID for r in tree) == list(range(1, 9))


def test_broken_parquet_pages_are_listed(spark, tmp_path):
    from rivulet.sources.files import failed_files

    spark.range(50_000).withColumn("s", F.sha2(F.col("id").cast("string"), 256)).coalesce(1).write.parquet(str(tmp_path / "t"))
    spark.range(50_000, 100_000).withColumn("s", F.sha2(F.col("id").cast("string"), 256)).coalesce(1).write.mode("append").parquet(str(tmp_path / "t"))
    first = sorted((tmp_path / "t").glob("*.parquet"))[0]
    for crc in (tmp_path / "t").glob(".*.crc"):
        crc.unlink()
    raw = bytearray(first.read_bytes())
    raw[len(raw) // 4: len(raw) // 2] = bytes(len(raw) // 2 - len(raw) // 4)
    first.write_bytes(raw)
    got = failed_files(spark, str(tmp_path / "t"), r"\.parquet", fmt="parquet").collect()
    assert [r.path.rsplit("/", 1)[1] for r in got] == [first.name]


def test_copies_of_any_key(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), ("b", None)], "k string, n int")
    for key in ("k", "n"):
        got = assign_copies(df, 3, key=key).collect()
        assert all(r["copy"] in (0, 1, 2) for r in got)
    assert len({r["copy"] for r in assign_copies(df, 3, key="k").where("k = 'a'").collect()}) == 1
