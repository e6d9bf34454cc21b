"""What options and typed texts accept and refuse."""

import datetime as dt
from decimal import Decimal

import pytest
from hypothesis import given
from hypothesis import strategies as some
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import typed
from tidemark.operators.scan import upper_bound
from tidemark.options import OptionError, TableOptions, checkpoint_id, normalised_path


def test_defaults():
    o = TableOptions.of(path="/x/y/", primary_key="a, b", bucket="4")
    assert (o.path, o.primary_key, o.bucket, o.retention, o.mode, o.snapshot, o.poll_ms) == ("file:///x/y", ("a", "b"), 4, 1, "batch", None, 3000)


@pytest.mark.parametrize(
    "options",
    [
        {"path": " "}, {"path": None}, {"path": "/x", "bucket": 0}, {"path": "/x", "bucket": "many"}, {"path": "/x", "snapshot.retention": 0}, {"path": "/x", "sink.parallelism": -1},
        {"path": "/x", "scan.poll-interval-ms": 0}, {"path": "/x", "scan.mode": "fast"}, {"path": "/x", "scan.checkpoint-id": "0"}, {"path": "/x", "scan.checkpoint-id": "x"},
        {"path": "/x", "scan.mode": "streaming", "scan.checkpoint-id": "3"}, {"path": "/x", "source.kind": "raw"}, {"path": "/x", "source.kind": "else"}, {"path": "/x", "colour": "red"},
        {"path": "/x", "sink.writer-buffer-memory": "0"}, {"path": "/x", "source.block-cache-memory": "lots"},
    ],
)
def test_refusals(options):
    with pytest.raises(OptionError):
        TableOptions.of(**options)


def test_small_parsers():
    assert checkpoint_id("latest") is None and checkpoint_id("7") == 7
    assert normalised_path("s3a://b/k/") == "s3a://b/k" and normalised_path("rel").startswith("file:///")
    assert TableOptions.of(path="/x", **{"source.block-cache-memory": "0", "sink.writer-buffer-memory": "64 mb"}).ignored


def test_logical_types():
    assert typed.logical_type("DECIMAL(12, 3) NOT NULL") == T.DecimalType(12, 3)
    assert typed.logical_type("ROW<`a` INT, b ARRAY<VARCHAR(10)>>") == T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.ArrayType(T.StringType()))])
    assert typed.logical_type("MULTISET<BIGINT>") == T.MapType(T.LongType(), T.IntegerType())
    assert typed.logical_type("MAP<STRING, MAP<INT, DOUBLE>>") == T.MapType(T.StringType(), T.MapType(T.IntegerType(), T.DoubleType()))
    assert typed.logical_type("TIMESTAMP(3)") == T.TimestampNTZType() and typed.logical_type("TIMESTAMP_LTZ(3)") == T.TimestampType()
    assert typed.logical_type("VARBINARY(9)") == T.BinaryType() and typed.logical_type("TIME(3)") == T.TimeType(6)
    with pytest.raises(typed.TypeProblem):
        typed.logical_type("RAW('x')")


@pytest.mark.parametrize(
    ("text", "kind", "value"),
    [
        ("true", T.BooleanType(), True), ("FALSE", T.BooleanType(), False), ("-128", T.ByteType(), -128), ("1.50", T.DecimalType(5, 2), Decimal("1.50")), ("AAE=", T.BinaryType(), bytearray(b"\x00\x01")),
        ("2024-02-29", T.DateType(), dt.date(2024, 2, 29)), ("2024-01-02T03:04:05.678", T.TimestampNTZType(), dt.datetime(2024, 1, 2, 3, 4, 5, 678000)), ("12:13:14", T.TimeType(6), dt.time(12, 13, 14)),
    ],
)
def test_values(text, kind, value):
    assert typed.parse_value(text, kind) == value


@pytest.mark.parametrize(
    ("text", "kind"),
    [("yes", T.BooleanType()), ("128", T.ByteType()), ("1.005", T.DecimalType(5, 2)), ("9999.99", T.DecimalType(5, 2)), ("?", T.BinaryType()), ("2024-13-01", T.DateType()), ("2024-01-01T00:00:00", T.TimestampType()), ("x", T.ArrayType(T.IntegerType()))],
)
def test_wrong_values(text, kind):
    with pytest.raises(typed.TypeProblem):
        typed.parse_value(text, kind)


@given(some.binary(max_size=6), some.binary(max_size=6))
def test_upper_bound_is_the_end_of_a_prefix(prefix, other):
    high = upper_bound(prefix)
    assert other.startswith(prefix) == (prefix <= other and (high is None or other < high))


def test_display(spark):
    from tidemark.plans.inspect import as_json, shown

    df = spark.createDataFrame([(2**53 - 1, "a\"b", bytearray(b"hi"), None), (2**53, "ü", bytearray(b"\xff"), 1.5)], "n long, s string, b binary, d double")
    assert [r["json"] for r in as_json(df.select("n", "s", "d")).collect()] == ['{"n":9007199254740991,"s":"a\\"b","d":null}', '{"n":"9007199254740992","s":"ü","d":1.5}']
    assert shown(df.select("b")).collect()[0]["b"] == '{"b64":"aGk=","utf8":"hi"}'
    assert df.select(typed.guarded_long(F.col("n")).alias("x")).collect()[1]["x"] == '"9007199254740992"'


def test_a_cluster_needs_a_shared_scratch_folder(spark, monkeypatch):
    """A local temporary folder is for one machine alone."""
    from types import SimpleNamespace

    from tidemark import scratch

    nowhere = lambda master: SimpleNamespace(sparkContext=SimpleNamespace(applicationId=f"app-{master}", master=master, getConf=lambda: SimpleNamespace(get=lambda k, d: d), getCheckpointDir=lambda: None, setCheckpointDir=lambda p: None))
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]", "k8s://x"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            scratch.scratch_root(nowhere(master))
    monkeypatch.setattr(scratch.atexit, "register", lambda *a: None)
    assert scratch.scratch_root(nowhere("local[4]")).startswith("file://")
