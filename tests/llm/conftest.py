import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from rivulet.llm.common import package_for_workers  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session", autouse=True)
def workers(spark):
    package_for_workers(spark)


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Null, empty, very long, repeated and tied rows, with columns whose names the operators use inside."""
    long = " ".join(f"word{i % 977}" for i in range(60_000))
    rows = [(0, "one two three four five six"), (1, None), (2, ""), (3, " \t\n "), (4, "one two three four five six"),
            (4, "one two three four five six"), (None, "one two three four five six"), (None, None), (5, long), (6, long + " end"),
            (7, "a\n\nb\na"), (8, "Ünïcödé wörds — 漢字"), (9, "!!! ... ???")]
    return spark.createDataFrame([(i, t, "x", 1, 2.0, "k", "r", i) for i, t in rows],
                                 "doc_id long, text string, key string, fp int, id double, row string, bucket string, a long")


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
