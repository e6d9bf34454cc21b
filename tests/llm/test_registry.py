"""The registered queries: all there, and equal to their SQL where they have one."""

import duckdb
import pytest

import __spark_entry__ as entry
from tests.test_queries import TABLES, rows
from tidemark.llm import registry

SF = "/root/testdata/sf0.001"


def test_one_query_for_each_operator():
    names = sorted(registry.queries(), key=lambda n: int(n[2:].split("_")[0]))
    assert [n.split("_")[0] for n in names] == [f"op{i}" for i in range(1, 11)]
    assert set(names) | {"pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_equals_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got, want = registry.queries()[name](spark, SF).toPandas(), con.execute(registry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_stable_schema_and_reruns(spark, name):
    first, again = (registry.queries()[name](spark, SF) for _ in range(2))
    assert first.schema == again.schema
    assert sorted(map(repr, first.collect())) == sorted(map(repr, again.collect()))
