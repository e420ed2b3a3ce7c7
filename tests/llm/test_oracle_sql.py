"""The DuckDB SQL of the corpus queries that have one, against the queries and against zlib."""

import zlib

import duckdb
import pytest

from conftest import SF_SMALL
from triplake.llm import catalog, oracle


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF_SMALL}/documents.parquet')")
    return con


@pytest.mark.parametrize("text", ["0:a", "1234567:straße", "-1:éàÿÀ", ":" + "z" * 300])
def test_crc32_of_sql(duck, text):
    assert duck.execute(f"SELECT {oracle._crc32('?::VARCHAR')}", [text]).fetchone()[0] == zlib.crc32(text.encode())


@pytest.mark.parametrize("name", sorted(oracle.ORACLE_SQL))
def test_query_equals_sql(spark, duck, name):
    found = duck.execute(oracle.ORACLE_SQL[name])
    cols = [d[0] for d in found.description]
    got = catalog.queries()[name](spark, SF_SMALL)
    assert sorted(got.columns) == sorted(cols)
    want = sorted(map(str, found.fetchall()))
    assert want and sorted(str(tuple(r)) for r in got.select(*cols).collect()) == want
