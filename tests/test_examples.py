"""The example flows run end to end."""

import importlib.util
import os

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _load(name):
    spec = importlib.util.spec_from_file_location(name, os.path.join(ROOT, "examples", f"{name}.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


def test_two_queues(spark, tmp_path, events):
    counts = _load("two_queues").main(out=str(tmp_path / "q"))
    assert counts["performance1"] == events.where("event_type != 'click'").count()
    assert counts["performance2"] == events.where("value > 10").count()
    assert sorted(p.name for p in (tmp_path / "q").iterdir() if p.is_dir()) == [
        "spark_queue=gamma", "spark_queue=hadron"]


def test_detector_stream(spark, tmp_path):
    n = _load("detector_stream").main(out=str(tmp_path / "d"))
    emb = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    assert n == emb.where("label != 0").count()
