"""Lookup joins in all modes, point gets, scans and pages."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark.operators import lookup as lk
from tidemark.operators import scan as sc
from tidemark.options import OptionError, TableOptions
from tidemark.sources.table import KeyedTable


@pytest.fixture
def table(spark, tmp_path):
    t = KeyedTable.create(spark, TableOptions.of(path=str(tmp_path / "t"), primary_key="id", bucket=2, snapshot__retention=9))
    t.upsert(spark.createDataFrame([(1, "name-1", 10, 1), (2, "name-2", 20, 1), (7, "name-7", 70, 1), (8, "name-8", 80, 1)], "id long, name string, score int, _s int"), "_s")
    return t


def more(spark, table):
    table.upsert(spark.createDataFrame([(2, "name-2-updated", 200, 1)], "id long, name string, score int, _s int"), "_s")


def probe(spark):
    return spark.createDataFrame([(100, 2, "mine"), (101, 7, "mine"), (102, 99, "mine"), (103, None, "mine")], "order_id long, id long, name string")


def test_left_and_inner(spark, table):
    left = lk.Lookup(table).join(probe(spark).drop("name"), {"id": "id"}, ["name", "score"])
    assert sorted(map(tuple, left.collect())) == [(100, 2, "name-2", 20), (101, 7, "name-7", 70), (102, 99, None, None), (103, None, None, None)]
    inner = lk.Lookup(table).join(probe(spark).drop("name"), {"id": "id"}, ["name"], "inner")
    assert sorted(r["order_id"] for r in inner.collect()) == [100, 101]


def test_snapshot_modes(spark, table):
    orders = probe(spark).where("order_id = 100").drop("name")
    names = lambda x: [r["name"] for r in x.join(orders, {"id": "id"}, ["name"]).collect()]
    first_seen, fresh, pinned = lk.Lookup(table), lk.Lookup(table, refresh=True), lk.Lookup(table, snapshot=1)
    assert names(first_seen) == names(fresh) == ["name-2"]
    more(spark, table)
    assert names(first_seen) == names(pinned) == ["name-2"]
    assert names(fresh) == ["name-2-updated"]


def test_batches_take_the_snapshot_of_their_time(spark, table):
    got = []
    each = lk.Lookup(table, refresh=True).in_batches({"id": "id"}, lambda rows, i: got.append((i, rows.collect()[0]["name"])), columns=["name"])
    orders = probe(spark).where("order_id = 100").drop("name")
    each(orders, 0)
    more(spark, table)
    each(orders, 1)
    assert got == [(0, "name-2"), (1, "name-2-updated")]


def test_nothing_there_yet(spark, tmp_path):
    empty = KeyedTable.create(spark, TableOptions.of(path=str(tmp_path / "e"), primary_key="id", bucket=2))
    orders = probe(spark).drop("name")
    assert [r["name"] for r in lk.Lookup(empty, refresh=True).join(orders, {"id": "id"}, ["name"]).collect()] == [None] * 4
    assert lk.Lookup(empty, refresh=True).join(orders, {"id": "id"}, ["name"], "inner").count() == 0


def test_large_tables_are_not_broadcast(spark, table, monkeypatch):
    plan = lambda: lk.Lookup(table).join(probe(spark).drop("name"), {"id": "id"}, ["name"])._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in plan()
    monkeypatch.setattr(lk, "BROADCAST_BYTES", 0)
    assert "strategy=broadcast" not in plan()


def test_refusals(spark, table):
    with pytest.raises(OptionError, match="whole primary key"):
        lk.Lookup(table).join(probe(spark), {"name": "name"})
    with pytest.raises(OptionError, match="top-level"):
        lk.Lookup(table).join(probe(spark), {"id": "other"})
    with pytest.raises(OptionError, match="'left' or 'inner'"):
        lk.Lookup(table).join(probe(spark), {"id": "id"}, how="full")
    with pytest.raises(PySparkException, match="must not be null"):
        lk.Lookup(table).join(probe(spark).drop("name"), {"id": "id"}, ["name"], strict_keys=True).collect()


def test_point_gets_and_tracking(spark, table):
    keys = spark.createDataFrame([(2,), (5,)], "id long")
    assert sorted((r["id"], r["found"], r["name"]) for r in lk.multi_get(table, keys).collect()) == [(2, True, "name-2"), (5, False, None)]
    more(spark, table)
    assert sorted((r["snapshot"], r["id"], r["score"]) for r in lk.track(table, keys, [1, 2]).collect() if r["found"]) == [(1, 2, 20), (2, 2, 200)]


@pytest.fixture
def composite(spark, tmp_path):
    t = KeyedTable.create(spark, TableOptions.of(path=str(tmp_path / "c"), primary_key="a,b", bucket=3))
    rows = [(a, f"k{b:02}", a * b, f"v{b}", 1) for a in range(5) for b in range(20)]
    t.upsert(spark.createDataFrame(rows, "a int, b string, n int, s string, _s int"), "_s")
    return t


def test_prefixes(composite):
    assert sc.scan(composite, prefix={"a": "3", "b": "k1"}).count() == 10
    assert sc.scan(composite, prefix={"a": "3"}).count() == 20
    for wrong in ({"b": "k1"}, {"c": "x"}):
        with pytest.raises(OptionError):
            sc.scan(composite, prefix=wrong)
    with pytest.raises(OptionError, match="not both"):
        sc.scan(composite, prefix={"a": "1"}, where=sc.key_range("a", 1))


def test_buckets_and_columns(composite):
    assert sum(sc.scan(composite, bucket=b).count() for b in range(3)) == 100
    assert sc.scan(composite, columns=[1]).columns == ["_bucket", "a", "b", "s"]
    with pytest.raises(OptionError):
        sc.scan(composite, bucket=3)
    with pytest.raises(OptionError):
        sc.scan(composite, columns=[2])


def test_whole_keys_read_one_bucket(spark, composite):
    schema = composite.schema(composite.log.load())
    found = sc.scan(composite, where=sc.whole_key(composite, schema, {"a": 2, "b": "k07"}))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert [r["n"] for r in found.collect()] == [14] and "PartitionFilters: [isnotnull(_bucket" in plan


@pytest.mark.parametrize("limit", [1, 7, 100])
def test_pages_cover_everything_in_order(composite, limit):
    rows, further = sc.read_page(composite, limit)
    while further:
        got, further = sc.read_page(composite, limit, **further)
        rows += got
    keys = [(r["_bucket"], r["a"], r["b"]) for r in rows]
    assert keys == sorted(keys) and len(set(keys)) == 100


def test_page_limits(composite):
    for limit in (0, 1001):
        with pytest.raises(OptionError):
            sc.page(composite, limit)
    with pytest.raises(OptionError, match="outside"):
        sc.page(composite, 5, start_after={"a": 1, "b": "k00"}, prefix={"a": "3"})
    with pytest.raises(OptionError, match="whole primary key"):
        sc.page(composite, 5, start_after={"a": 1})


def test_ranges(composite):
    assert sc.scan(composite, where=sc.key_range("a", 1, 3)).count() == 40
    assert sc.scan(composite, where=sc.key_range("a")).select(F.max("a")).first()[0] == 4


def test_a_small_file_of_large_rows_is_not_broadcast(spark, tmp_path):
    table = KeyedTable.create(spark, TableOptions.of(path=str(tmp_path / "t"), primary_key="id", bucket=2))
    rows = spark.range(700).select("id", F.repeat(F.lit("x"), 100_000).alias("text"), F.lit(None).cast("array<string>").alias("tags"), F.lit(1).alias("_s"))
    table.upsert(rows, "_s")
    snapshot, probe = table.log.load(), spark.createDataFrame([(5,), (None,), (9999,)], "k long")
    assert snapshot.bytes <= lk.BROADCAST_BYTES
    side = lk.Lookup(table)
    for columns, broadcast in ((["text"], False), (["tags"], True)):
        joined = side.join(probe, {"id": "k"}, columns)
        hinted = "ResolvedHint" in joined._jdf.queryExecution().analyzed().toString()
        assert hinted == broadcast
    assert sorted((r["k"] or -1, len(r["text"] or "")) for r in side.join(probe, {"id": "k"}, ["text"]).collect()) == [(-1, 0), (5, 100_000), (9999, 0)]
