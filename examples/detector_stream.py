"""A detector-style chain on a stream of array records.

Per micro-batch: skip calibration records, rename the raw series, subtract
the per-position pedestal (built once from the calibration records), remove
spikes, interpolate known bad positions, and summarize each series; the
result goes to one folder per micro-batch.

    python examples/detector_stream.py [sf_dir] [out_dir]
"""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from rivulet import Flow  # noqa: E402
from rivulet.functions import arrays as A  # noqa: E402
from rivulet.functions.conditions import eq  # noqa: E402
from rivulet.operators.steps import rename_key, set_key, skip  # noqa: E402
from rivulet.session import build_session, scratch_path  # noqa: E402
from rivulet.streaming.runs import stream_table  # noqa: E402
from rivulet.streaming.topology import run_flow  # noqa: E402

BAD_POSITIONS = (3, 17, 40)


def main(sf_dir="/root/testdata/sf0.001", out=None):
    spark = build_session("local[4]", 4)
    embeddings = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    pedestal = A.calibration_table(embeddings, "embedding", where=F.col("label") == 0)

    def build(sources):
        flow = Flow()
        flow.source("data", sources["data"])
        flow.process("analysis", input="data", output="features", steps=[
            skip(eq("label", 0)),
            rename_key("embedding", "raw:data"),
            lambda df: A.calibrate(df, "raw:data", pedestal, "calibrated"),
            set_key("clean", A.interpolate(A.despike("calibrated", 0.2), BAD_POSITIONS)),
            set_key("stats", A.stats("clean")),
            set_key("peak", A.peak("clean")),
        ])
        return flow

    stream = stream_table(spark, sf_dir, "embeddings", max_files_per_trigger=1)
    out = out or scratch_path(spark, "detector")
    run_flow(build, {"data": stream}, {"features": out})
    result = spark.read.parquet(out).select("vec_id", "stats.mean", "stats.var", "peak.pos")
    result.show(5)
    return result.count()


if __name__ == "__main__":
    main(*sys.argv[1:])
