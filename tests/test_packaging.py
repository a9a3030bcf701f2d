"""Queries that run Python workers must work when the driver is started elsewhere."""

import os
import subprocess
import sys
import textwrap

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = textwrap.dedent(f"""
    import importlib.util
    spec = importlib.util.spec_from_file_location("entry", {os.path.join(ROOT, "__spark_entry__.py")!r})
    E = importlib.util.module_from_spec(spec); spec.loader.exec_module(E)
    from pyspark.sql import SparkSession
    spark = SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "2").getOrCreate()
    n = E.queries()["stream_keyed_state"](spark, "/root/testdata/sf0.001").count()
    m = E.queries()["source_random_copies"](spark, "/root/testdata/sf0.001").count()
    print("ROWS", min(n, m))
""")


def test_worker_code_ships_without_install(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    res = subprocess.run([sys.executable, "-c", SCRIPT], cwd=tmp_path, env=env, capture_output=True,
                         text=True, timeout=600)
    assert "ROWS " in res.stdout, res.stderr[-2000:]
    assert int(res.stdout.split("ROWS ")[1].split()[0]) > 0
