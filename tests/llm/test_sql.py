"""The registered queries against their own SQL, over the small tables."""

import os

import duckdb
import pytest

from kinlink.llm import queries as registered

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")


@pytest.mark.parametrize("name", sorted(registered.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    found = registered.queries()[name](spark, SF)
    columns = sorted(found.columns)
    rows = con.execute(f"SELECT {', '.join(columns)} FROM ({registered.oracle_sql()[name]})").fetchall()
    assert sorted(map(repr, rows)) == sorted(repr(tuple(r)) for r in found.select(columns).collect())
