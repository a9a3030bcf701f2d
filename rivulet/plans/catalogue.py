"""The query catalogue: one function ``(spark, sf_dir) → DataFrame`` per key.

Each query runs a flow of the library over the driver's tables, whole.
Parameters (queue conditions, limits, positions) are our fixed test values
from the plan; the matching DuckDB text is in :mod:`.oracles`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import arrays as A
from ..functions.conditions import eq, gt, is_null, lt, ne
from ..operators.keyed import grouped, running
from ..operators.metrics import batch_count, throughput
from ..operators.steps import copy_keys, create_id, rename_key, skip
from ..sources.files import file_blocks, read_file_blocks, read_file_tree, read_recursive, read_table
from ..sources.generated import assign_copies, lines_of, random_value, union_sources
from ..sources.limits import item_limit, running_id
from ..streaming.runs import batch_window_counts, landed, route_stream, stream_table, total_window_counts
from ..streaming.state import keyed_counts, latest_counts
from ..streaming.topology import run_flow, total_counts
from ..session import scratch_path
from .flow import Flow
from .timeline import QUERIES as TIMELINE

# Fixed test parameters (our definitions, shared with the oracle SQL).
COPIES = 4
ITEM_LIMIT = 100
FILE_LIMIT = 22
THROUGHPUT_EVERY = 100
THRESHOLD = 0.1
SPIKE_LIMIT = 0.2
BAD_POSITIONS = (3, 17, 40)
BASELINE_K = 10
MISSING_NATION = 7


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _events(spark, sf_dir):
    return table(spark, sf_dir, "events")


# --- the two-queue flow (flagship) ----------------------------------------

def two_queue_flow(events: DataFrame) -> Flow:
    """Source → skip → route to ``gamma`` and ``hadron`` (the two-queue example)."""
    flow = Flow()
    flow.source("data", events)
    flow.process("separation", input="data",
                 queues={"gamma": ne("event_type", "click"), "hadron": gt("value", 10)})
    return flow


def enqueue_route(spark, sf_dir):
    flow = two_queue_flow(_events(spark, sf_dir))
    return flow.routed("separation").select("event_id", "spark_queue")


def queue_split(spark, sf_dir):
    flow = two_queue_flow(_events(spark, sf_dir))
    return flow["hadron"].select("event_id", "value")


def queue_counts(spark, sf_dir):
    """Flagship: per-queue record counts of the two-queue flow."""
    flow = two_queue_flow(_events(spark, sf_dir))
    return (flow.routed("separation").groupBy("spark_queue")
            .agg(F.count(F.lit(1)).alias("items")))


def output_fanout(spark, sf_dir):
    flow = Flow()
    flow.source("data", _events(spark, sf_dir))
    flow.process("clean", input="data", output=["a", "b"], steps=[skip(eq("event_type", "error"))])
    return flow.union_of(["a", "b"], label_col="flow").select("event_id", "flow")


def pass_through(spark, sf_dir):
    flow = Flow()
    flow.source("data", _events(spark, sf_dir))
    flow.process("clean", input="data", output="out", pass_through=True,
                 steps=[skip(eq("event_type", "error"))], queues={"hadron": gt("value", 10)})
    return flow["out"].select("event_id", "spark_queue")


# --- steps ----------------------------------------------------------------

def process_chain(spark, sf_dir):
    flow = Flow()
    flow.source("data", _events(spark, sf_dir))
    flow.process("detector", input="data", output="calibrated", steps=[
        create_id("id", order_by="event_id"),
        [rename_key("value", "raw:value"), copy_keys({"raw:value": "value_copy"})],
        skip(eq("event_type", "error")),
    ])
    return flow["calibrated"].select("event_id", "id", "event_type", "`raw:value`", "value_copy")


def skip_condition(spark, sf_dir):
    t = F.nullif(F.col("event_type"), F.lit("error"))
    return _events(spark, sf_dir).transform(skip(ne(t, "purchase"))).select("event_id")


def condition_ops(spark, sf_dir):
    t = F.nullif(F.col("event_type"), F.lit("error"))
    return _events(spark, sf_dir).select(
        "event_id", ne(t, "click").alias("ne"), eq(t, "click").alias("eq"),
        is_null(t).alias("is_null"), lt("value", 5).alias("lt"))


# --- sources --------------------------------------------------------------

def source_read(spark, sf_dir):
    return read_table(spark, f"{sf_dir.rstrip('/')}/events.parquet")


def source_recursive(spark, sf_dir):
    return read_recursive(spark, sf_dir, r"nation\.parquet")


#: Files of the folder that the block query reads, and the columns it keeps.
BLOCK_FILES = r"/(customer|nation|region|supplier)\.parquet"
BLOCK_SCHEMA = "r_name string, n_name string, s_name string, c_name string"


def source_blocks_read(spark, sf_dir):
    """Records of four files read as two copies, each a contiguous block of the files in order of their names."""
    df = read_file_blocks(spark, sf_dir, BLOCK_FILES, None, 2, schema=BLOCK_SCHEMA)
    return df.select("copy", F.coalesce("c_name", "n_name", "r_name", "s_name").alias("name"))


def source_union(spark, sf_dir):
    """Two readers united under one name; the key only one of them has is null for the other."""
    flow = Flow()
    customers = table(spark, sf_dir, "customer").select(F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"), "c_mktsegment")
    suppliers = table(spark, sf_dir, "supplier").select(F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"))
    flow.source("parties", union_sources(customers, suppliers))
    flow.process("keep", input="parties", output="out", steps=[skip(eq("nation", 7))])
    return flow["out"].select("name", "nation", "c_mktsegment")


def source_file_blocks(spark, sf_dir):
    listing = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return file_blocks(listing, "n_name", FILE_LIMIT, COPIES)


def source_tree(spark, sf_dir):
    # Four copies asked, one matching file: copies shrink to one (Q10); IDs follow reading order.
    df = read_file_tree(spark, sf_dir, r"events\.parquet", fmt="parquet", copies=COPIES)
    return df.select("event_id", "copy", "ID")


def _copies(spark, sf_dir):
    return assign_copies(_events(spark, sf_dir).select("event_id", "user_id"), COPIES, key="user_id")


def source_copies_union(spark, sf_dir):
    return _copies(spark, sf_dir).select("event_id", "copy")


def source_running_id(spark, sf_dir):
    return running_id(_copies(spark, sf_dir), "event_id", copy_col="copy", id_col="id").select("event_id", "copy", "id")


def source_limit(spark, sf_dir):
    return item_limit(_copies(spark, sf_dir), ITEM_LIMIT, order_by="event_id", copy_col="copy").select("event_id", "copy")


def source_lines(spark, sf_dir):
    return lines_of(table(spark, sf_dir, "documents"), "text", keep="doc_id").select("doc_id", "line_no", "line")


def source_random(spark, sf_dir):
    """A random value for every event, seeded by its id."""
    events = _events(spark, sf_dir)
    return events.select(F.col("event_id").alias("id"), random_value(F.col("event_id")).alias("x"))


def source_random_copies(spark, sf_dir):
    """The same, each event read by one of four copies."""
    return _copies(spark, sf_dir).select(F.col("event_id").alias("id"), "copy", random_value(F.col("event_id")).alias("x"))


# --- keyed, metrics, lookup -----------------------------------------------

def group_by_process(spark, sf_dir):
    flow = Flow()
    flow.source("data", _events(spark, sf_dir).select("event_id", "user_id", "value"))
    flow.process("per_user", input="data", output="g", group_by="user_id", order_by="event_id",
                 steps=[running({"seen": "count", "total": ("sum", "value")})])
    return flow["g"].select("event_id", "user_id", "seen", F.round("total", 4).alias("total"))


def group_null_keys(spark, sf_dir):
    """Records without a key are one group; the process asks for a number of tasks."""
    events = _events(spark, sf_dir).select("event_id", F.nullif("event_type", F.lit("error")).alias("kind"))
    flow = Flow()
    flow.source("data", events)
    flow.process("per_kind", input="data", output="g", group_by="kind", order_by="event_id", copies=COPIES,
                 steps=[running({"seen": "count"})])
    return flow["g"].select("event_id", "kind", "seen")


def batch_count_q(spark, sf_dir):
    return batch_count(_events(spark, sf_dir), "ts", "1 hour", emitted=ne("event_type", "error"))


def throughput_q(spark, sf_dir):
    return throughput(_events(spark, sf_dir), "event_type", "event_id", "ts", THROUGHPUT_EVERY)


def service_lookup(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select("c_custkey", F.nullif("c_nationkey", F.lit(MISSING_NATION)).alias("c_nationkey"))
    flow = Flow()
    flow.source("customers", customers)
    flow.service("nations", table(spark, sf_dir, "nation"))
    flow.process("enrich", input="customers", output="out",
                 steps=[flow.lookup("nations", {"c_nationkey": "n_nationkey"}, ["n_name"])])
    return flow["out"].select("c_custkey", "n_name")


# --- streaming ------------------------------------------------------------

def stream_route(spark, sf_dir):
    stream = stream_table(spark, sf_dir, "events", max_files_per_trigger=1)
    _, out = route_stream(stream, {"gamma": ne("event_type", "click"), "hadron": gt("value", 10)})
    return spark.read.parquet(out).select("event_id", "spark_queue")


def stream_group(spark, sf_dir):
    """Skip on the stream, then a grouped process over all that landed: the same for any number and order of files."""
    stream = stream_table(spark, sf_dir, "events", max_files_per_trigger=1).select("event_id", "user_id", "event_type", "value")
    _, out = landed(stream, [skip(eq("event_type", "error"))])
    done = grouped(spark.read.parquet(out), "user_id", [running({"seen": "count", "total": ("sum", "value")})], order_by="event_id")
    return done.select("event_id", "user_id", "seen", F.round("total", 4).alias("total"))


def stream_keyed_state(spark, sf_dir):
    stream = stream_table(spark, sf_dir, "events", max_files_per_trigger=1)
    _, out = keyed_counts(stream, "user_id", "event_id")
    return latest_counts(spark, out, "user_id").select("user_id", "n", F.col("last").alias("last_event"))


def activity_flow(sources) -> Flow:
    """Events without errors go to two queues; ``large`` is an output, ``views`` and the orders end in counts."""
    flow = Flow()
    flow.source("events", sources["events"])
    flow.source("orders", sources["orders"])
    flow.process("sort", input="events", steps=[skip(eq("event_type", "error"))],
                 queues={"views": eq("event_type", "view"), "large": gt("value", 10)})
    flow.process("spend", input="large", output="spent", steps=[copy_keys({"value": "amount"})])
    flow.process("seen", input="views")
    flow.process("ordered", input="orders")
    return flow


def stream_flow(spark, sf_dir):
    """Two streaming sources in one flow; its result is the output's records per user and the counts of the terminals."""
    streams = {"events": stream_table(spark, sf_dir, "events", max_files_per_trigger=1).select("event_id", "user_id", "event_type", "value"),
               "orders": stream_table(spark, sf_dir, "orders", max_files_per_trigger=1).select("o_orderkey")}
    out, counts = scratch_path(spark, "flow-spent"), scratch_path(spark, "flow-counts")
    run_flow(activity_flow, streams, {"spent": out}, counts)
    spent = spark.read.parquet(out).groupBy(F.concat(F.lit("user "), F.col("user_id")).alias("name")).agg(F.count(F.lit(1)).alias("items"))
    return spent.union(total_counts(spark, counts))


def stream_batch_count(spark, sf_dir):
    stream = stream_table(spark, sf_dir, "events", max_files_per_trigger=1)
    _, out = batch_window_counts(stream, "ts", "1 hour")
    return total_window_counts(spark, out).select("batch", "processed")


# --- arrays ---------------------------------------------------------------

def _emb(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select("vec_id", "label", A.as_doubles("embedding").alias("a"))


def array_element_set(spark, sf_dir):
    return (_emb(spark, sf_dir).select("vec_id", F.explode(A.element_set("a")).alias("pos"))
            .withColumn("pos", F.col("pos").cast("long")))


def array_stats(spark, sf_dir):
    s = A.stats("a")
    return _emb(spark, sf_dir).select("vec_id", s.alias("s")).select(
        "vec_id", F.round("s.mean", 6).alias("mean"), F.col("s.min").alias("min"),
        F.col("s.max").alias("max"), F.round("s.var", 6).alias("var"))


def array_baseline(spark, sf_dir):
    return _emb(spark, sf_dir).select("vec_id", F.round(A.baseline("a", BASELINE_K), 6).alias("baseline"))


def array_over_threshold(spark, sf_dir):
    return _emb(spark, sf_dir).select("vec_id", A.over_threshold("a", THRESHOLD).alias("n"))


def array_peak(spark, sf_dir):
    return _emb(spark, sf_dir).select("vec_id", A.peak("a").alias("p")).select("vec_id", "p.peak", "p.pos")


def _exploded(df: DataFrame, arr, digits: int) -> DataFrame:
    out = df.select("vec_id", F.posexplode(arr).alias("pos", "v"))
    return out.select("vec_id", F.col("pos").cast("long").alias("pos"), F.round("v", digits).alias("v"))


def array_calibrate(spark, sf_dir):
    emb = _emb(spark, sf_dir)
    return _exploded(A.calibrate(emb, "a", A.calibration_table(emb, "a", where=F.col("label") == 0)), F.col("a"), 5)


def array_despike(spark, sf_dir):
    return _exploded(_emb(spark, sf_dir), A.despike("a", SPIKE_LIMIT), 6)


def array_interpolate(spark, sf_dir):
    return _exploded(_emb(spark, sf_dir), A.interpolate("a", BAD_POSITIONS), 6)


QUERIES = {
    "source_read": source_read,
    "source_recursive": source_recursive,
    "source_file_blocks": source_file_blocks,
    "source_blocks_read": source_blocks_read,
    "source_union": source_union,
    "source_tree": source_tree,
    "source_running_id": source_running_id,
    "source_limit": source_limit,
    "source_copies_union": source_copies_union,
    "source_lines": source_lines,
    "source_random": source_random,
    "source_random_copies": source_random_copies,
    "process_chain": process_chain,
    "skip_condition": skip_condition,
    "condition_ops": condition_ops,
    "enqueue_route": enqueue_route,
    "queue_split": queue_split,
    "queue_counts": queue_counts,
    "output_fanout": output_fanout,
    "pass_through": pass_through,
    "group_by_process": group_by_process,
    "group_null_keys": group_null_keys,
    "batch_count": batch_count_q,
    "throughput": throughput_q,
    "service_lookup": service_lookup,
    "stream_route": stream_route,
    "stream_group": stream_group,
    "stream_keyed_state": stream_keyed_state,
    "stream_batch_count": stream_batch_count,
    "stream_flow": stream_flow,
    "array_element_set": array_element_set,
    "array_stats": array_stats,
    "array_baseline": array_baseline,
    "array_over_threshold": array_over_threshold,
    "array_peak": array_peak,
    "array_calibrate": array_calibrate,
    "array_despike": array_despike,
    "array_interpolate": array_interpolate,
    **TIMELINE,
}
