"""Two queues: records go to `gamma` unless flag is 'A', and to `hadron` if flag is 'B'.

The flag here is the event type: every record whose type is not 'click' goes
to gamma, records with value > 10 go to hadron; each queue is then printed by
its own process, and the routed records are written once, one folder per queue.

    python examples/two_queues.py [sf_dir] [out_dir]
"""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from rivulet import Flow  # noqa: E402
from rivulet.functions.conditions import gt, ne  # noqa: E402
from rivulet.operators.sinks import preview  # noqa: E402
from rivulet.operators.steps import create_id  # noqa: E402
from rivulet.session import build_session, scratch_path  # noqa: E402


def build(sources):
    flow = Flow()
    flow.source("data", sources["data"])
    flow.process("separation", input="data", steps=[create_id("id")],
                 queues={"gamma": ne("event_type", "click"), "hadron": gt("value", 10)})
    flow.process("performance1", input="gamma")
    flow.process("performance2", input="hadron")
    return flow


def main(sf_dir="/root/testdata/sf0.001", out=None):
    spark = build_session("local[4]", 4)
    flow = build({"data": spark.read.parquet(f"{sf_dir}/events.parquet")})
    preview(flow["gamma"], 5)
    preview(flow["hadron"], 5)
    out = out or scratch_path(spark, "two-queues")
    flow.write_queues("separation", out)
    print(flow.counts(), "written to", out)
    return flow.counts()


if __name__ == "__main__":
    main(*sys.argv[1:])
