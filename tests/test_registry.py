"""Driver contract: entry, queries, oracle SQL (checked with DuckDB)."""

import math

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from riverwatch.plans.registry import ORACLE_SQL, QUERIES

from samples import SF001

TABLES = ["events"]


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["flood_risk_level", "count"]
    assert df.count() >= 1


def test_every_query_has_sql():
    assert set(ORACLE_SQL) == set(QUERIES)
    assert set(oracle_sql()) <= set(queries())


def _norm(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(v)
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    return "NULL" if v is None else str(v)


def _bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(_norm(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_duckdb(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    df = queries()[name](spark, SF001)
    res = con.execute(oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _bag(df.columns, [tuple(r) for r in df.collect()]) == _bag(ocols, res.fetchall())


def test_fixture_numbers_sf001(spark):
    """FIXTURES.md section 7: the readings view at sf0.01."""
    from samples import SF01
    q = queries()
    dist = {r.flood_risk_level: r["count"] for r in q["risk_distribution"](spark, SF01).collect()}
    assert dist == {"LOW": 4462, "MODERATE": 1854, "HIGH": 3624, "CRITICAL": 60}
    assert q["flood_alerts"](spark, SF01).count() == 2947
    corr = q["rain_river_corr"](spark, SF01).first().correlation
    assert corr == pytest.approx(0.0022936037038438347, abs=1e-9)
    assert q["windowed_stats"](spark, SF01).count() == 9527


@pytest.fixture(scope="module")
def split_table(spark, tmp_path_factory):
    """The events table as a folder of part files."""
    root = tmp_path_factory.mktemp("parts")
    spark.read.parquet(f"{SF001}/events.parquet").repartition(5).write.parquet(f"{root}/events.parquet")
    spark.range(3).write.parquet(f"{root}/events_old.parquet")  # a sibling that is no part of it
    return str(root)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_reads_a_table_of_several_files(spark, split_table, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{split_table}/events.parquet/*.parquet')")
    df = QUERIES[name](spark, split_table)
    res = con.execute(ORACLE_SQL[name])
    ocols = [d[0] for d in res.description]
    assert _bag(df.columns, [tuple(r) for r in df.collect()]) == _bag(ocols, res.fetchall())
