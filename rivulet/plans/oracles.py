"""DuckDB SQL for each catalogue key (views: the driver's tables by name).

Column names and integer widths match the Spark results: counts, row
numbers and positions are BIGINT on both sides; floats are rounded where
the Spark side rounds. ``round(…) + 0.0`` turns DuckDB's ``-0.0`` (kept by
its rounding) into ``0.0``, the value Spark's decimal rounding gives.
"""

from __future__ import annotations

from .timeline import ORACLES as TIMELINE

_RUNNING_ID = ("SELECT event_id, CAST(user_id % 4 AS INT) AS copy, "
               "row_number() OVER (PARTITION BY user_id % 4 ORDER BY event_id) AS id FROM events")

_POINTS = ("SELECT vec_id, unnest(range(len(embedding))) AS pos, unnest(embedding)::DOUBLE AS v "
           "FROM embeddings")

_NEIGHBOURS = (f"SELECT *, lag(v) OVER w AS a, lead(v) OVER w AS b FROM ({_POINTS}) "
               "WINDOW w AS (PARTITION BY vec_id ORDER BY pos)")

_GROUP = ("SELECT event_id, user_id, row_number() OVER w AS seen, round(sum(value) OVER w, 4) AS total "
          "FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)")

_ROUTE = ("SELECT event_id, 'gamma' AS spark_queue FROM events WHERE event_type IS DISTINCT FROM 'click' "
          "UNION ALL SELECT event_id, 'hadron' FROM events WHERE value > 10")

ORACLES = {
    "source_read": "SELECT * FROM events",
    "source_recursive": "SELECT * FROM nation",
    "source_file_blocks": (
        "SELECT n_nationkey, n_name, CAST(least((rn-1)//5, 3) AS INT) AS copy FROM "
        "(SELECT *, row_number() OVER (ORDER BY n_name) AS rn FROM nation) WHERE rn <= 22"),
    # The given events file is stored in event_id order (one row group), so
    # its reading order is event_id order.
    "source_tree": ('SELECT event_id, CAST(0 AS INT) AS copy, row_number() OVER (ORDER BY event_id) AS "ID" '
                    "FROM events"),
    "source_running_id": _RUNNING_ID,
    "source_limit": f"SELECT event_id, copy FROM ({_RUNNING_ID}) WHERE id <= 100",
    "source_copies_union": "SELECT event_id, CAST(user_id % 4 AS INT) AS copy FROM events",
    "source_lines": (
        "SELECT doc_id, unnest(range(len(l))) AS line_no, unnest(l) AS line FROM "
        "(SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)"),
    "source_blocks_read": (
        "SELECT CAST(0 AS INT) AS copy, c_name AS name FROM customer UNION ALL SELECT 0, n_name FROM nation "
        "UNION ALL SELECT 1, r_name FROM region UNION ALL SELECT 1, s_name FROM supplier"),
    "source_union": (
        "SELECT c_name AS name, c_nationkey AS nation, c_mktsegment FROM customer WHERE c_nationkey <> 7 UNION ALL "
        "SELECT s_name, s_nationkey, NULL FROM supplier WHERE s_nationkey <> 7"),
    "group_null_keys": (
        "SELECT event_id, nullif(event_type, 'error') AS kind, "
        "row_number() OVER (PARTITION BY nullif(event_type, 'error') ORDER BY event_id) AS seen FROM events"),
    "source_random": (
        "SELECT event_id AS id, ((event_id * 1103515245 + 12345) % 2147483648) / 2147483648.0::DOUBLE AS x FROM events"),
    "source_random_copies": (
        "SELECT event_id AS id, CAST(user_id % 4 AS INT) AS copy, "
        "((event_id * 1103515245 + 12345) % 2147483648) / 2147483648.0::DOUBLE AS x FROM events"),
    "process_chain": (
        'SELECT event_id, id, event_type, value AS "raw:value", value AS value_copy FROM '
        "(SELECT *, row_number() OVER (ORDER BY event_id) AS id FROM events) WHERE event_type <> 'error'"),
    "skip_condition": (
        "SELECT event_id FROM events WHERE NOT (nullif(event_type,'error') IS DISTINCT FROM 'purchase')"),
    "condition_ops": (
        "SELECT event_id, t IS DISTINCT FROM 'click' AS ne, t IS NOT DISTINCT FROM 'click' AS eq, "
        "t IS NULL AS is_null, coalesce(value < 5, false) AS lt FROM "
        "(SELECT *, nullif(event_type,'error') AS t FROM events)"),
    "enqueue_route": _ROUTE,
    "queue_split": "SELECT event_id, value FROM events WHERE value > 10",
    "queue_counts": f"SELECT spark_queue, count(*) AS items FROM ({_ROUTE}) GROUP BY 1",
    "output_fanout": (
        "SELECT event_id, 'a' AS flow FROM events WHERE event_type <> 'error' "
        "UNION ALL SELECT event_id, 'b' FROM events WHERE event_type <> 'error'"),
    "pass_through": (
        "SELECT event_id, NULL::VARCHAR AS spark_queue FROM events WHERE event_type <> 'error' "
        "UNION ALL SELECT event_id, 'hadron' FROM events WHERE event_type <> 'error' AND value > 10"),
    "group_by_process": _GROUP,
    "batch_count": (
        "SELECT date_trunc('hour', ts) AS batch, count(*) AS processed, "
        "count(*) FILTER (WHERE event_type <> 'error') AS emitted FROM events GROUP BY 1"),
    "throughput": (
        "SELECT event_type, (rn-1)//100 AS block, count(*) AS items, "
        "date_diff('microsecond', min(ts), max(ts)) AS elapsed_us FROM "
        "(SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS rn FROM events) "
        "GROUP BY 1, 2"),
    "service_lookup": (
        "SELECT c_custkey, n_name FROM customer LEFT JOIN nation "
        "ON c_nationkey = n_nationkey AND c_nationkey <> 7"),
    "stream_route": _ROUTE,
    "stream_group": _GROUP.replace("FROM events", "FROM events WHERE event_type IS DISTINCT FROM 'error'"),
    "stream_keyed_state": "SELECT user_id, count(*) AS n, max(event_id) AS last_event FROM events GROUP BY 1",
    "stream_batch_count": "SELECT date_trunc('hour', ts) AS batch, count(*) AS processed FROM events GROUP BY 1",
    "stream_flow": (
        "SELECT 'user ' || user_id AS name, count(*) AS items FROM events "
        "WHERE event_type IS DISTINCT FROM 'error' AND value > 10 GROUP BY user_id "
        "UNION ALL SELECT 'seen', count(*) FROM events WHERE event_type = 'view' "
        "UNION ALL SELECT 'ordered', count(*) FROM orders"),
    "array_element_set": "SELECT vec_id, unnest(range(len(embedding))) AS pos FROM embeddings",
    "array_stats": (
        "SELECT vec_id, round(list_avg(e),6) + 0.0 AS mean, list_min(e) AS min, list_max(e) AS max, "
        "round(list_var_pop(e),6) AS var FROM (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings)"),
    "array_baseline": "SELECT vec_id, round(list_avg(embedding[1:10]::DOUBLE[]),6) + 0.0 AS baseline FROM embeddings",
    "array_over_threshold": (
        "SELECT vec_id, len(list_filter(embedding, lambda x: x::DOUBLE > 0.1)) AS n FROM embeddings"),
    "array_peak": (
        "SELECT vec_id, list_max(embedding::DOUBLE[]) AS peak, "
        "CAST(list_position(embedding::DOUBLE[], list_max(embedding::DOUBLE[]))-1 AS BIGINT) AS pos "
        "FROM embeddings"),
    "array_calibrate": (
        f"WITH p AS (SELECT vec_id, label, unnest(range(len(embedding))) AS pos, "
        f"unnest(embedding)::DOUBLE AS v FROM embeddings), "
        f"r AS (SELECT pos, avg(v) AS ped FROM p WHERE label = 0 GROUP BY pos) "
        f"SELECT vec_id, pos, round(v - ped, 5) + 0.0 AS v FROM p JOIN r USING (pos)"),
    "array_despike": (
        "SELECT vec_id, pos, round(CASE WHEN a IS NOT NULL AND b IS NOT NULL AND v - a > 0.2 AND v - b > 0.2 "
        f"THEN (a+b)/2 ELSE v END, 6) + 0.0 AS v FROM ({_NEIGHBOURS})"),
    "array_interpolate": (
        "SELECT vec_id, pos, round(CASE WHEN pos IN (3, 17, 40) THEN (a+b)/2 ELSE v END, 6) + 0.0 AS v "
        f"FROM ({_NEIGHBOURS})"),
    **TIMELINE,
}
