import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.dirname(os.path.abspath(__file__))]

from sample_tables import SF_SMALL  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    from rivulet.session import build_session

    s = build_session("local[4]", shuffle_partitions=4, app="rivulet-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def events(spark):
    return spark.read.parquet(f"{SF_SMALL}/events.parquet")
