"""Every registered query against its SQL twin in DuckDB, on whole tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from tidemark.registry import REGISTRY
from tools.compare import connect, rows_of

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("key", sorted(set(ORACLES) & set(REGISTRY)))
def test_matches_oracle(spark, con, key):
    df = QUERIES[key](spark, SF)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(ORACLES[key])
    want = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    assert got[0] == want[0]
    assert got[1] == want[1]


def test_every_registered_query_has_a_twin():
    assert set(REGISTRY) <= set(ORACLES)


def test_entry(spark):
    assert entry.entry(spark).columns == ["month", "category", "revenue"]


def test_oracles_are_one_statement():
    for key, sql in ORACLES.items():
        assert len(duckdb.extract_statements(sql)) == 1, key


def test_queries_leave_the_callers_settings(spark):
    key = "spark.sql.session.timeZone"
    spark.conf.set(key, "Asia/Tokyo")
    try:
        df = QUERIES["stg_orders"](spark, SF)
        assert spark.conf.get(key) == "Asia/Tokyo"
        got = sorted(map(tuple, df.limit(50).collect()), key=str)
    finally:
        spark.conf.set(key, "UTC")
    assert set(got) <= {tuple(r) for r in QUERIES["stg_orders"](spark, SF).collect()}
