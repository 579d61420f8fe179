"""Every registered query against its SQL, on the smallest tables."""

import os
import re

import duckdb
import pytest

import __spark_entry__ as entry

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no tables")


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def own_queries():
    """Those of this folder's package part; the training-data ones have tests of their own."""
    return sorted(n for n in entry.queries() if n != "pipeline" and not re.match(r"op[0-9]+_", n))


@pytest.mark.parametrize("name", own_queries())
def test_query(spark, sql, name):
    df = entry.queries()[name](spark, SF_DIR)
    columns = sorted(df.columns)
    got = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
    result = sql.execute(entry.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    expected = sorted((tuple(r[i] for i in order) for r in result.fetchall()), key=repr)
    assert len(got) == len(expected) and got == expected


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["tripdate", "zip", "trips", "pred_next_day", "pred_next_week"]
    assert df.count() > 0


def test_every_query_has_its_sql():
    assert set(own_queries()) <= set(entry.oracle_sql())
