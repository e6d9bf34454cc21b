"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from tidemark.plans import queries as engine

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        path = f"{SF}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path}{'/*.parquet' if os.path.isdir(path) else ''}'")
    return con


def rows(frame: pd.DataFrame) -> list[tuple]:
    """Plain rows in a fixed order, columns by name."""

    def plain(x):
        if not isinstance(x, list | dict) and pd.isna(x):
            return None
        x = x.item() if hasattr(x, "item") else x
        return float(x) if isinstance(x, int | float) and not isinstance(x, bool) else x

    return sorted((tuple(map(plain, r)) for r in frame[sorted(frame.columns)].itertuples(index=False, name=None)), key=repr)


@pytest.mark.parametrize("name", sorted(engine.queries()))
def test_equals_sql(spark, db, name):
    got = entry.queries()[name](spark, SF).toPandas()
    want = db.execute(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_products_beyond_a_long_are_shown_in_full(spark, tmp_path):
    keys = [0, 1, -1, 1000, 1001, 1_024_000, 8_999_999, -8_999_999, 2**63 - 1, -(2**63), None]
    spark.createDataFrame([(k,) for k in keys], "o_orderkey long").write.parquet(f"{tmp_path}/orders.parquet")
    got = {r["o_orderkey"]: r["shown"] for r in entry.queries()["display_longs"](spark, str(tmp_path)).collect()}
    exact = {k: k * 9007199254740 for k in keys if k is not None}
    assert got == {k: str(n) if abs(n) < 2**53 else f'"{n}"' for k, n in exact.items()} | {None: None}


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_engine_query_has_sql():
    assert set(engine.queries()) == set(engine.oracle_sql())


def test_entry_file_works_without_the_corpus_package(tmp_path):
    """A copy of the repository without the corpus folders still offers the engine's queries."""
    import shutil
    import subprocess
    import sys
    from pathlib import Path

    root = Path(entry.__file__).parent
    shutil.copytree(root / "tidemark", tmp_path / "tidemark", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    said = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"], cwd=tmp_path, capture_output=True, text=True, env={**os.environ, "PYTHONPATH": str(tmp_path)})
    assert said.stdout.split() == [str(len(engine.queries()))] * 2, said.stderr
