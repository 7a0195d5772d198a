"""Every registered query with an oracle against DuckDB (small scale).

Streaming queries read tables stored as folders of part files, as they are at scale.
"""

import os
import tempfile

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL

TABLES = ["nation", "customer", "orders", "events", "documents", "pages"]
IN_PARTS = ["nation", "events", "documents"]
SQL = entry.oracle_sql()


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.fixture(scope="module")
def in_parts(spark):
    folder = tempfile.mkdtemp(prefix="kf-parts-", dir="/tmp")
    for t in os.listdir(SF_SMALL):
        name = t.removesuffix(".parquet")
        if name in IN_PARTS:
            spark.read.parquet(f"{SF_SMALL}/{t}").repartition(4).write.parquet(f"{folder}/{t}")
        else:
            os.symlink(f"{SF_SMALL}/{t}", f"{folder}/{t}")
    return folder


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, duck, in_parts, name):
    from keyflow.plans.catalog import STREAMING_QUERIES
    df = entry.queries()[name](spark, in_parts if name in STREAMING_QUERIES else SF_SMALL)
    got = _canon(df.columns, [tuple(r) for r in df.collect()])
    cur = duck.execute(SQL[name])
    want = _canon([d[0] for d in cur.description], cur.fetchall())
    assert sorted(df.columns) == sorted(d[0] for d in cur.description)
    assert len(got) == len(want)
    assert got == want


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["key", "window_start", "window_end", "cnt"]
    assert df.count() > 0
