"""Time the catalogue queries; print one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py [key ...]
    BENCH_EVENT_LOG=$(mktemp -d) …   # also write Spark's event log there

Each query is run to completion with the ``noop`` sink (the whole plan
executes, nothing is collected to the driver). Time includes planning and
the small jobs some operators run while planning (counts, quantiles).
An untimed warm-up first starts the JVM scan path and the Python workers,
so one-time process start-up is not charged to whichever query comes first.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from rivulet.plans.catalogue import QUERIES  # noqa: E402
from rivulet.session import build_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = sys.argv[1:]
    # One shuffle partition per core locally; clusters size this to their data.
    parts = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(max(4, cpus))))
    extra = {"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEM", "16g")}
    if os.environ.get("BENCH_EVENT_LOG"):  # a folder for Spark's event log (stage and task times)
        extra.update({"spark.eventLog.enabled": "true", "spark.eventLog.dir": os.environ["BENCH_EVENT_LOG"]})
    spark = build_session(f"local[{cpus}]", shuffle_partitions=parts, extra=extra)
    # Warm-up (not timed): start the JVM's scan path and the Python workers,
    # one-time costs per session that executors pay once and then reuse.
    spark.read.parquet(f"{sf_dir}/events.parquet").write.format("noop").mode("overwrite").save()
    (spark.range(0, cpus, 1, cpus).mapInPandas(lambda batches: batches, "id long")
     .write.format("noop").mode("overwrite").save())

    times: dict[str, float] = {}
    for key, fn in QUERIES.items():
        if only and key not in only:
            continue
        t0 = time.perf_counter()
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[key] = round(time.perf_counter() - t0, 3)
    spark.stop()
    sf = os.path.basename(sf_dir)
    print(json.dumps({
        "metric": "catalogue_total_time",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": sf[2:] if sf.startswith("sf") else sf,
    }))


if __name__ == "__main__":
    main()
