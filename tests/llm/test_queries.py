"""Registered queries on whole small tables against their SQL twins."""

import pytest

import __spark_entry__ as entry
from tidemark.llm import queries
from tools.compare import connect, rows_of

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("key", sorted(queries.ORACLES))
def test_matches_sql(spark, key):
    df = queries.QUERIES[key](spark, SF)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cursor = connect(SF).execute(queries.ORACLES[key])
    assert got == rows_of([d[0] for d in cursor.description], cursor.fetchall())


def test_each_operator_has_a_query_and_the_pipeline_is_registered():
    names = entry.queries()
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 14))
    assert "pipeline" in names
