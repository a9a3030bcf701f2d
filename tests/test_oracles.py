"""Every catalogue query against its DuckDB oracle, as multisets of rows."""

import datetime as dt
import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from sample_tables import SF_SMALL
from rivulet.plans.catalogue import QUERIES as CATALOGUE
from rivulet.plans.oracles import ORACLES

TABLES = ["region", "nation", "customer", "supplier", "orders", "events", "documents", "embeddings"]


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v


def _rows(cols, tuples):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(t[i]) for i in order) for t in tuples), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(CATALOGUE) == set(ORACLES) and set(CATALOGUE) <= set(E.queries())


@pytest.mark.parametrize("key", sorted(CATALOGUE))
def test_query_matches_oracle(spark, duck, key):
    df = E.queries()[key](spark, SF_SMALL)
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    res = duck.execute(E.oracle_sql()[key])
    cols = [c[0] for c in res.description]
    want = _rows(cols, res.fetchall())
    assert sorted(df.columns) == sorted(cols)
    assert len(got) == len(want)
    assert got == want


DUCK_TO_SPARK = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
                 "BOOLEAN": "boolean", "TIMESTAMP": "timestamp_ntz"}


@pytest.mark.parametrize("key", sorted(k for k in CATALOGUE if not k.startswith("stream_")))
def test_column_types_match_oracle(spark, duck, key):
    got = {f.name: f.dataType.simpleString() for f in E.queries()[key](spark, SF_SMALL).schema.fields}
    want = {c[0]: DUCK_TO_SPARK.get(str(c[1]), str(c[1])) for c in duck.execute(E.oracle_sql()[key]).description}
    assert got == want


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = {r["spark_queue"]: r["items"] for r in df.collect()}
    assert set(rows) == {"gamma", "hadron"}
    assert df.schema.simpleString() == E.entry(spark).schema.simpleString()
    assert os.path.isdir(E.SMOKE_DIR)
