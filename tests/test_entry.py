"""Driver contract: entry runs, every query has a callable, oracle keys are a subset, and a sample of
queries matches DuckDB on sf0.001."""

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from triplake import catalog

NAMES = set(catalog.queries())           # the corpus queries are tested in tests/llm

TABLES = "region nation customer supplier part orders lineitem events".split()


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "cuota_mercado_pct" in df.columns


def test_oracle_keys_are_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert NAMES <= set(entry.queries()) and NAMES - set(entry.oracle_sql()) <= {"type_drift_audit"}


WRITERS = {"drifted_scan", "type_drift_audit", "csv_zone_lookup", "staging_roundtrip", "mart_rebuild",
           "mart_incremental", "mart_incremental_demand", "stream_arrival", "profile_volume_files",
           "mart_rebuild_kpis", "mart_incremental_share", "mart_incremental_kpis", "stream_quarantine", "stream_merge",
           "rerun_empty_period", "rerun_unreadable_period", "period_listings",
           "drifted_scan_formats", "type_drift_formats"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(NAMES & set(entry.oracle_sql()) - WRITERS))
def test_matches_duckdb(spark, duck, name):
    df = entry.queries()[name](spark, SF_SMALL)
    res = duck.execute(entry.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(df.columns)
    a = sorted(tuple(key(r[c]) for c in sorted(cols)) for r in df.collect())
    b = sorted(tuple(key(dict(zip(cols, r))[c]) for c in sorted(cols)) for r in res.fetchall())
    assert a == b


def key(v):
    return (v is not None, repr(v) if isinstance(v, float) else str(v))


@pytest.mark.parametrize("name", sorted(NAMES - WRITERS))
def test_plan_has_no_nested_loop_or_row_udf(spark, name):
    from conftest import plan_text
    plan = plan_text(entry.queries()[name](spark, SF_SMALL), "simple")
    for bad in ("NestedLoop", "Cartesian", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in plan, bad
