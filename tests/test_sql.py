"""Declared tables in SQL, parsing columns, and state read beside its schema."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.typed import parse_column
from tidemark.options import OptionError
from tidemark.plans.sql import create_table
from tidemark.sources.table import KeyedTable
from tidemark.options import TableOptions

COLUMNS = {"id": "BIGINT", "name": "STRING", "score": "INT"}


def declared(spark, tmp_path, columns=None, **more):
    options = {"path": str(tmp_path / "t"), "primary_key": "id", "bucket": 2} | more
    return create_table(spark, columns or COLUMNS, **options)


def test_round_trip_and_lookup_in_sql(spark, tmp_path):
    table = declared(spark, tmp_path)
    assert table.insert_into("SELECT * FROM VALUES (1, 'name-1', 10), (2, 'name-2', 20), (7, 'name-7', 70) AS t(id, name, score)") == 1
    table.register("dim")
    spark.createDataFrame([(100, 2), (101, 7), (102, 99)], "order_id int, id bigint").createOrReplaceTempView("probe")
    got = spark.sql("SELECT order_id, p.id, name, score FROM probe p LEFT JOIN dim d ON p.id = d.id ORDER BY 1").collect()
    assert [tuple(r) for r in got] == [(100, 2, "name-2", 20), (101, 7, "name-7", 70), (102, 99, None, None)]


def test_inserts_have_no_order_of_their_own(spark, tmp_path):
    table = declared(spark, tmp_path)
    rows = spark.createDataFrame([(1, "a", 1, 1), (1, "b", 2, 2)], "id long, name string, score int, at int")
    with pytest.raises(OptionError, match="comes twice"):
        table.insert_into(rows)
    table.insert_into(rows, seq="at")
    assert [r["name"] for r in table.rows().collect()] == ["b"]
    with pytest.raises(OptionError, match="gives no"):
        table.insert_into("SELECT 1L AS id")


def test_declarations_are_checked(spark, tmp_path):
    for columns, options in (({"id": "BIGINT"}, {}), ({"name": "STRING"}, {}), ({"id": "MAP<INT, INT>", "v": "INT"}, {})):
        with pytest.raises(OptionError):
            declared(spark, tmp_path, columns, **options)
    declared(spark, tmp_path).insert_into("SELECT 1L AS id, 'a' AS name, 1 AS score")
    with pytest.raises(OptionError, match="declared string, stored int"):
        declared(spark, tmp_path, {"id": "BIGINT", "score": "STRING"}).rows()
    wider = declared(spark, tmp_path, COLUMNS | {"more": "DOUBLE"}).rows()
    assert wider.schema["more"].dataType == T.DoubleType() and wider.collect()[0]["more"] is None
    assert declared(spark, tmp_path, {"id": "BIGINT", "score": "INT"}).rows().columns == ["id", "score"]


def test_tables_outlive_their_schema_log(spark, tmp_path):
    declared(spark, tmp_path).insert_into("SELECT 1L AS id, 'a' AS name, 1 AS score")
    table = KeyedTable.open(spark, TableOptions.of(path=str(tmp_path / "t")))
    sha = table.schemas.events()[0][1]
    table.log.files.delete(f"schema/blobs/{sha}.json")
    assert [tuple(r) for r in table.read().collect()] == [(1, "a", 1)]


def test_parsing_columns(spark):
    df = spark.createDataFrame([("12", "TRUE", "aGk=", "2024-02-30"), ("x", "yes", "?", "2024-02-29")], "n string, b string, y string, d string")
    got = df.select(parse_column(F.col("n"), T.IntegerType()), parse_column(F.col("b"), T.BooleanType()), parse_column(F.col("y"), T.BinaryType()), parse_column(F.col("d"), T.DateType()).cast("string")).collect()
    assert [tuple(r) for r in got] == [(12, True, bytearray(b"hi"), None), (None, None, None, "2024-02-29")]
