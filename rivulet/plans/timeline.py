"""Queries about time: as-of, interval and overlap joins, sessions, and their streaming forms.

Orders carry dates of other years than events do, so each order gets a time
in the events' month from its key. Every second user counts as user 0, which
so holds about half of the records.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.frames import distinct_counts, sliding, top
from ..operators.joins import asof_join, interval_join, overlap_join
from ..operators.sessions import sessions
from ..operators.sinks import print_data
from ..session import scratch_path
from ..streaming.eventtime import results, running_stream, session_stream, stream_join
from ..streaming.processor import OpenRecords, process_stream
from ..streaming.runs import landed, ntz_to_instant, stream_table

GAP = "30 minutes"

_AT = "timestampadd(SECOND, o_orderkey * 7919 % 2592000, TIMESTAMP_NTZ'2024-01-01 00:00:00')"
_UNTIL = f"timestampadd(HOUR, CASE WHEN o_custkey % 48 = 0 THEN 1440 ELSE o_custkey % 48 END, {_AT})"
_KEY = "CASE WHEN {0} % 2 = 0 THEN 0L ELSE {0} END AS key"


def _read(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _orders(spark, sf_dir, *more):
    return _read(spark, sf_dir, "orders").selectExpr("o_orderkey", "o_custkey", f"{_AT} AS placed", *more)


def join_asof(spark, sf_dir):
    """Each event with the last order of its key."""
    events = _read(spark, sf_dir, "events").selectExpr("event_id", "ts", _KEY.format("user_id"))
    orders = _orders(spark, sf_dir).selectExpr("placed", "o_orderkey", _KEY.format("o_custkey"))
    return asof_join(events, orders, "key", "ts", "placed").select("event_id", "key", "placed", "o_orderkey")


def join_points_in_intervals(spark, sf_dir):
    """Events while an order of their user is open; some orders stay open for two months."""
    events = _read(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    orders = _orders(spark, sf_dir, f"{_UNTIL} AS until")
    return interval_join(events, orders, "ts", "placed", "until", on={"user_id": "o_custkey"}).select("event_id", "o_orderkey")


def join_overlap(spark, sf_dir):
    """Orders of one customer that are open at the same time."""
    orders = _orders(spark, sf_dir, f"{_UNTIL} AS until")
    pairs = overlap_join(orders, orders, ("placed", "until"), ("placed", "until"), on="o_custkey", suffix="_2")
    return pairs.where("o_orderkey < o_orderkey_2").select("o_orderkey", F.col("o_orderkey_2").alias("other"))


def session_windows(spark, sf_dir):
    """Sessions of events per key, half of the events being of one key."""
    events = _read(spark, sf_dir, "events").selectExpr("ts", "value", _KEY.format("user_id"))
    out = sessions(events, "key", "ts", GAP, {"items": "count", "total": ("sum", "value")})
    return out.withColumn("total", F.round("total", 4))


def stream_sessions(spark, sf_dir):
    """The same from a stream, whatever the order of its files."""
    stream = stream_table(spark, sf_dir, "events", max_files_per_trigger=1).selectExpr("ts", "value", _KEY.format("user_id"))
    _, out = session_stream(stream, "key", "ts", GAP, {"items": "count", "total": ("sum", "value")}, delay="31 days")
    return results(spark, out).withColumn("total", F.round("total", 4))


def stream_running(spark, sf_dir):
    """Running count and sum per user in event-time order, carried from micro-batch to micro-batch."""
    stream = stream_table(spark, sf_dir, "events", max_files_per_trigger=1).select("event_id", "user_id", "ts", "value")
    _, out = running_stream(stream, "user_id", "ts", {"seen": "count", "total": ("sum", "value")}, ties=["event_id"], delay="31 days")
    return results(spark, out).select("event_id", "user_id", "seen", F.round("total", 4).alias("total"))


def stream_interval_join(spark, sf_dir):
    """Events within six hours after an order of their user, both tables being streams."""
    events = stream_table(spark, sf_dir, "events", max_files_per_trigger=1).select("event_id", "user_id", "ts")
    orders = stream_table(spark, sf_dir, "orders", max_files_per_trigger=1).selectExpr("o_orderkey", "o_custkey", f"{_AT} AS placed")
    _, out = stream_join(events, orders, {"user_id": "o_custkey"}, "ts", "placed", "0 seconds", "6 hours", "31 days", "31 days")
    return results(spark, out).select("event_id", "o_orderkey")


def sliding_rows(spark, sf_dir):
    """Sum, in cents, and number of the last 100 events of a key."""
    events = _read(spark, sf_dir, "events").selectExpr("event_id", "ts", "CAST(round(value * 100) AS BIGINT) AS cents", _KEY.format("user_id"))
    out = sliding(events, "key", "ts", {"total": ("sum", "cents"), "items": ("count", "cents")}, rows=100, ties=["event_id"])
    return out.select("event_id", "total", "items")


def sliding_hour(spark, sf_dir):
    """Number and largest value of a key's events in the hour up to each event."""
    events = _read(spark, sf_dir, "events").selectExpr("event_id", "ts", "value", _KEY.format("user_id"))
    out = sliding(events, "key", "ts", {"items": ("count", "value"), "largest": ("max", "value")}, span="1 hour")
    return out.select("event_id", "items", "largest")


def top_per_key(spark, sf_dir):
    """The five largest events of each key."""
    events = _read(spark, sf_dir, "events").selectExpr("event_id", "value", _KEY.format("user_id"))
    return top(events, "key", [F.col("value").desc(), F.col("event_id")], 5).select("key", "event_id", "value")


def top_with_ties(spark, sf_dir):
    """Events of the three latest times of each type, and all that share them."""
    events = _read(spark, sf_dir, "events").selectExpr("event_type", "event_id", "date_trunc('day', ts) AS day")
    return top(events, "event_type", [F.col("day").desc()], 3, ties=True).select("event_type", "event_id")


def distinct_users(spark, sf_dir):
    """Different users per event type."""
    return distinct_counts(_read(spark, sf_dir, "events"), "event_type", "user_id", "users")


def stream_open_records(spark, sf_dir):
    """Each user's open record, sent on by a timer when six hours have passed without an event, or by the closing step."""
    stream = stream_table(spark, sf_dir, "events", max_files_per_trigger=1).select("user_id", ntz_to_instant(F.col("ts")).alias("event_time"))
    _, out = process_stream(stream, "user_id", "event_time", OpenRecords(6 * 3600 * 10**6, "user_id bigint"), delay="31 days")
    at = "timestampadd(MICROSECOND, {0}_us, TIMESTAMP_NTZ'1970-01-01 00:00:00') AS {0}_event"
    return spark.read.parquet(out).selectExpr("user_id", at.format("first"), at.format("last"), "items")


def print_records(spark, sf_dir):
    """Every record of the large events as a line of text, printed by the tasks that hold it and read back."""
    path = scratch_path(spark, "printed")
    large = _read(spark, sf_dir, "events").where("value > 10").select("event_id", "user_id", "event_type")
    print_data(large, path)
    return spark.read.text(path)


def stream_paced(spark, sf_dir):
    """Records per part of the events, streamed from six files of which a micro-batch may read two: at most two parts a batch."""
    folder = scratch_path(spark, "paced-in")
    events = _read(spark, sf_dir, "events").selectExpr("event_id", "CAST(user_id % 6 AS INT) AS part")
    events.repartition("part").write.partitionBy("part").parquet(folder)
    stream = spark.readStream.schema("event_id long, part int").option("maxFilesPerTrigger", 2).parquet(folder)
    _, out = landed(stream)
    batches = spark.read.parquet(out).groupBy("batch_id").agg(F.count_distinct("part").alias("parts"))
    rows = spark.read.parquet(out).join(batches, "batch_id")
    return rows.groupBy("part").agg(F.count("*").alias("items"), (F.max("parts") <= 2).alias("paced"))


QUERIES = {"join_asof": join_asof, "join_points_in_intervals": join_points_in_intervals, "join_overlap": join_overlap,
           "session_windows": session_windows, "stream_sessions": stream_sessions, "stream_running": stream_running,
           "stream_interval_join": stream_interval_join, "sliding_rows": sliding_rows, "sliding_hour": sliding_hour,
           "top_per_key": top_per_key, "top_with_ties": top_with_ties, "distinct_users": distinct_users,
           "stream_open_records": stream_open_records, "print_records": print_records, "stream_paced": stream_paced}

_PLACED = "TIMESTAMP '2024-01-01' + to_seconds(o_orderkey * 7919 % 2592000)"
_O = (f"(SELECT o_orderkey, o_custkey, {_PLACED} AS placed, {_PLACED} + to_hours(CASE WHEN o_custkey % 48 = 0 THEN 1440 ELSE o_custkey % 48 END) "
      "AS until FROM orders)")
_E = "(SELECT *, CASE WHEN user_id % 2 = 0 THEN 0 ELSE user_id END AS key FROM events)"
_SESSIONS = (f"SELECT key, min(ts) AS session_start, max(ts) AS session_end, count(*) AS items, round(sum(value), 4) AS total FROM "
             f"(SELECT *, sum(fresh) OVER (PARTITION BY key ORDER BY ts, event_id) AS n FROM "
             f"(SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY key ORDER BY ts, event_id) <= INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS fresh FROM {_E})) "
             "GROUP BY key, n")

ORACLES = {
    "join_asof": (
        f"SELECT event_id, e.key, o.placed, o.o_orderkey FROM {_E} e ASOF LEFT JOIN "
        f"(SELECT CASE WHEN o_custkey % 2 = 0 THEN 0 ELSE o_custkey END AS key, placed, max(o_orderkey) AS o_orderkey FROM {_O} GROUP BY 1, 2) o "
        "ON e.key = o.key AND e.ts >= o.placed"),
    "join_points_in_intervals": (
        f"SELECT event_id, o_orderkey FROM events JOIN {_O} ON user_id = o_custkey AND ts >= placed AND ts < until"),
    "join_overlap": (
        f"SELECT a.o_orderkey, b.o_orderkey AS other FROM {_O} a JOIN {_O} b ON a.o_custkey = b.o_custkey AND a.o_orderkey < b.o_orderkey "
        "AND a.placed < b.until AND b.placed < a.until"),
    "session_windows": _SESSIONS,
    "stream_sessions": _SESSIONS,
    "stream_running": (
        "SELECT event_id, user_id, row_number() OVER w AS seen, round(sum(value) OVER w, 4) AS total "
        "FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)"),
    "stream_interval_join": (
        f"SELECT event_id, o_orderkey FROM events JOIN {_O} ON user_id = o_custkey AND ts >= placed AND ts <= placed + INTERVAL 6 HOUR"),
    "sliding_rows": (
        f"SELECT event_id, CAST(sum(CAST(round(value * 100) AS BIGINT)) OVER w AS BIGINT) AS total, count(value) OVER w AS items FROM {_E} "
        "WINDOW w AS (PARTITION BY key ORDER BY ts, event_id ROWS BETWEEN 99 PRECEDING AND CURRENT ROW)"),
    "sliding_hour": (
        f"SELECT event_id, count(value) OVER w AS items, max(value) OVER w AS largest FROM {_E} "
        "WINDOW w AS (PARTITION BY key ORDER BY ts RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND CURRENT ROW)"),
    "top_per_key": (
        f"SELECT key, event_id, value FROM {_E} QUALIFY row_number() OVER (PARTITION BY key ORDER BY value DESC, event_id) <= 5"),
    "top_with_ties": (
        "SELECT event_type, event_id FROM events QUALIFY rank() OVER (PARTITION BY event_type ORDER BY date_trunc('day', ts) DESC) <= 3"),
    "print_records": (
        "SELECT '{\"event_id\":' || event_id || ',\"user_id\":' || user_id || ',\"event_type\":\"' || event_type || '\"}' AS value FROM events WHERE value > 10"),
    "stream_paced": "SELECT CAST(user_id % 6 AS INT) AS part, count(*) AS items, true AS paced FROM events GROUP BY 1",
    "distinct_users": "SELECT event_type, count(DISTINCT user_id) AS users FROM events GROUP BY 1",
    "stream_open_records": (
        "SELECT user_id, min(ts) AS first_event, max(ts) AS last_event, count(*) AS items FROM "
        "(SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM "
        "(SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) <= INTERVAL 6 HOUR THEN 0 ELSE 1 END AS fresh FROM events)) "
        "GROUP BY user_id, n"),
}
