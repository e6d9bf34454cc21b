"""Upserts, snapshots, retention and what they refuse."""

from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark.options import OptionError, TableOptions
from tidemark.sources.fs import Files
from tidemark.sources.kind import detect_kind
from tidemark.sources.snapshots import SnapshotMissing
from tidemark.sources.table import KeyedTable, snapshot_diff

SCHEMA = "id long, name string, score int, seq long, kind string"


def new(spark, path, key="id", bucket=4, **options):
    return KeyedTable.create(spark, TableOptions.of(path=str(path), primary_key=key, bucket=bucket, snapshot__retention=options.pop("retention", 9), **options))


def put(spark, table, *rows, **more):
    df = spark.createDataFrame(list(rows), SCHEMA).withColumnRenamed("seq", "_seq")
    return table.upsert(df, "_seq", "kind", **more)


def read(table, id=None):
    return sorted(tuple(r) for r in table.read(id).collect())


def test_changelog_gives_the_final_state(spark, tmp_path):
    table = new(spark, tmp_path / "t")
    put(spark, table, (2, "name-2", 2, 1, "+I"), (2, "old", 1, 2, "-U"), (2, "updated-2", 20, 3, "+U"), (3, "x", 1, 4, "+I"), (3, "x", 1, 5, "-D"), (7, "name-7", 70, 6, "+I"))
    assert read(table) == [(2, "updated-2", 20), (7, "name-7", 70)]


def test_existing_rows_stay_and_old_snapshots_are_readable(spark, tmp_path):
    table = new(spark, tmp_path / "t")
    put(spark, table, (1, "a", 1, 1, "+I"), (2, "b", 2, 2, "+I"))
    second = put(spark, table, (2, "b2", 22, 1, "+U"), (9, "z", 9, 2, "+I"))
    third = put(spark, table, (1, None, None, 1, "-D"))
    assert read(table, 1) == [(1, "a", 1), (2, "b", 2)]
    assert read(table, 2) == [(1, "a", 1), (2, "b2", 22), (9, "z", 9)]
    assert read(table) == [(2, "b2", 22), (9, "z", 9)]
    assert (second.id, third.id) == (2, 3)
    assert sorted(tuple(r) for r in snapshot_diff(table, 1, 3).collect()) == [("+I", 9, "z", 9), ("+U", 2, "b2", 22), ("-D", 1, "a", 1)]


def test_only_touched_buckets_are_written(spark, tmp_path):
    table = new(spark, tmp_path / "t", bucket=16)
    first = put(spark, table, *[(i, "n", i, 1, "+I") for i in range(100)])
    second = put(spark, table, (5, "m", 5, 1, "+U"))
    assert sum(first.files[b] != second.files[b] for b in first.files) == 1
    assert len(read(table)) == 100


def test_retention_keeps_the_newest_and_their_files(spark, tmp_path):
    table = new(spark, tmp_path / "t", retention=2)
    for i in range(5):
        put(spark, table, (i, "n", i, 1, "+I"))
    assert table.log.ids() == [5, 4]
    assert [len(read(table, i)) for i in (4, 5)] == [4, 5]
    with pytest.raises(SnapshotMissing):
        table.read(1)
    listed = {f for i in (4, 5) for fs in table.log.load(i).files.values() for f in fs}
    assert {p for p, _ in table.log.files.walk("data") if p.endswith(".parquet") and p.split("/")[1] in {f.split("/")[1] for f in listed}} == listed
    table.log.files.write("data/commit=lost/_bucket=0/part.parquet", "x")
    assert "data/commit=lost/_bucket=0/part.parquet" in table.log.vacuum()
    assert not table.log.files.exists("data/commit=lost") and [len(read(table, i)) for i in (4, 5)] == [4, 5]
    default = KeyedTable.create(spark, TableOptions.of(path=str(tmp_path / "d"), primary_key="id", bucket=1))
    put(spark, default, (1, "a", 1, 1, "+I"))
    put(spark, default, (2, "a", 1, 1, "+I"))
    assert default.log.ids() == [2]


def test_a_batch_commits_once(spark, tmp_path):
    table = new(spark, tmp_path / "t")
    put(spark, table, (1, "a", 1, 1, "+I"), batch=("q", 0))
    put(spark, table, (1, "again", 2, 1, "+I"), batch=("q", 0))
    put(spark, table, (1, "other query", 3, 1, "+I"), batch=("r", 0))
    assert table.log.ids() == [2, 1] and read(table) == [(1, "other query", 3)]
    assert table.log.load().batches == {"q": 0, "r": 0}


def test_missing_snapshots(spark, tmp_path):
    table = new(spark, tmp_path / "t")
    with pytest.raises(SnapshotMissing):
        table.read()
    with pytest.raises(SnapshotMissing):
        KeyedTable.open(spark, TableOptions.of(path=str(tmp_path / "t")))
    put(spark, table)
    assert read(table) == [] and table.log.ids() == [1]
    assert KeyedTable.open(spark, TableOptions.of(path=str(tmp_path / "t"))).buckets == 4


def test_current_may_lag_behind(spark, tmp_path):
    table = new(spark, tmp_path / "t")
    put(spark, table, (1, "a", 1, 1, "+I"))
    table.log.files.delete("snapshot/CURRENT")
    assert read(table) == [(1, "a", 1)]
    with pytest.raises(FileExistsError):
        table.log.commit(table.log.load())


def test_a_gap_in_the_buckets_is_refused(spark, tmp_path):
    table = new(spark, tmp_path / "t")
    snapshot = put(spark, table, (1, "a", 1, 1, "+I"))
    del snapshot.files["2"]
    with pytest.raises(ValueError, match="cover"):
        snapshot.covered()


def test_mismatches_are_refused(spark, tmp_path):
    table = new(spark, tmp_path / "t")
    put(spark, table, (1, "a", 1, 1, "+I"))
    with pytest.raises(OptionError, match="4 buckets"):
        new(spark, tmp_path / "t", bucket=8)
    with pytest.raises(OptionError, match="primary key"):
        new(spark, tmp_path / "t", key="name")
    with pytest.raises(OptionError, match="differ"):
        table.upsert(spark.createDataFrame([(1, "a", 1)], "id long, name string, _s long"), "_s")
    with pytest.raises(OptionError, match="besides"):
        new(spark, tmp_path / "k").upsert(spark.createDataFrame([(1, 1)], "id long, _s long"), "_s")
    with pytest.raises(OptionError, match="map"):
        new(spark, tmp_path / "m").upsert(spark.createDataFrame([({1: 1}, 1, 1)], "id map<int,int>, v int, _s long"), "_s")
    with pytest.raises(PySparkException, match="must not be null"):
        put(spark, table, (None, "a", 1, 1, "+I"))
    with pytest.raises(PySparkException, match="Unknown row kind"):
        put(spark, table, (1, "a", 1, 1, "?"))
    assert table.log.ids() == [1]


def test_all_null_rows(spark, tmp_path):
    kept, dropped = new(spark, tmp_path / "a"), new(spark, tmp_path / "b", all_null_is_delete="true")
    for table in (kept, dropped):
        put(spark, table, (1, "a", 1, 1, "+I"), (2, "b", 2, 1, "+I"))
        put(spark, table, (1, None, None, 1, "+U"))
    assert read(kept) == [(1, None, None), (2, "b", 2)]
    assert read(dropped) == [(2, "b", 2)]


def test_columns_are_bound_by_name(spark, tmp_path):
    table = new(spark, tmp_path / "t")
    put(spark, table, (1, "a", 5, 1, "+I"))
    assert [tuple(r) for r in table.read(columns=["score", "id", "other"]).collect()] == [(5, 1, None)]


def test_composite_and_typed_keys(spark, tmp_path):
    table = new(spark, tmp_path / "t", key="a,b")
    df = spark.createDataFrame([(bytearray(b"\x00\xff"), "x", [1, 2], 1), (bytearray(b"\x01"), "x", None, 1)], "a binary, b string, v array<int>, _s long")
    table.upsert(df, "_s")
    table.upsert(df.withColumn("v", F.array(F.lit(9))).limit(1), "_s")
    assert sorted((bytes(r["a"]), r["v"]) for r in table.read().collect()) == [(b"\x00\xff", [9]), (b"\x01", None)]


def test_schema_log(spark, tmp_path):
    table = new(spark, tmp_path / "t")
    put(spark, table, (1, "a", 1, 1, "+I"))
    put(spark, table, (1, "b", 1, 1, "+I"))
    events = table.schemas.events()
    assert len(events) == 1 and events[0][0] == 1
    assert table.schemas.resolve(2)[0] == "ok" and table.schemas.resolve(0) == ("missing", None)
    table.log.files.write(f"schema/blobs/{events[0][1]}.json", "{}", replace=True)
    assert table.schemas.resolve(2)[0] == "corrupt"


def test_kinds(spark, tmp_path):
    table = new(spark, tmp_path / "t")
    put(spark, table, (1, "a", 1, 1, "+I"))
    assert detect_kind(spark, table.root) == "table"
    with pytest.raises(OptionError, match="keyed table"):
        detect_kind(spark, table.root, "state")
    assert detect_kind(spark, str(tmp_path / "none"), sink_shaped=True) == "table"
    with pytest.raises(OptionError, match="Can't tell"):
        detect_kind(spark, str(tmp_path / "none"))
    (tmp_path / "c" / "state").mkdir(parents=True)
    (tmp_path / "c" / "metadata").write_text("{}")
    assert detect_kind(spark, str(tmp_path / "c")) == "state"
    with pytest.raises(OptionError, match="streaming state"):
        detect_kind(spark, str(tmp_path / "c"), "sink")


def test_one_of_many_writers_of_a_name_succeeds(spark, tmp_path):
    files = Files(spark, f"file://{tmp_path}/f")

    def attempt(i):
        try:
            files.write("x/name", str(i))
            return i
        except FileExistsError:
            return None

    with ThreadPoolExecutor(16) as pool:
        won = [i for i in pool.map(attempt, range(64)) if i is not None]
    assert len(won) == 1 and files.read("x/name") == str(won[0])
    assert files.names("x") == ["name"]


def test_a_writer_that_comes_late_commits_onto_the_other(spark, tmp_path):
    a, b = new(spark, tmp_path / "t"), new(spark, tmp_path / "t")
    put(spark, a, (1, "a", 1, 1, "+I"), (2, "a", 2, 1, "+I"))
    commit = b.log.commit

    def late(snapshot):
        b.log.commit = commit
        put(spark, a, (2, "faster", 20, 1, "+U"), (3, "faster", 30, 1, "+I"), batch=("a", 0))
        commit(snapshot)

    b.log.commit = late
    assert put(spark, b, (2, "later", 200, 1, "+U"), (4, "later", 40, 1, "+I"), batch=("b", 7)).id == 3
    assert read(a) == [(1, "a", 1), (2, "later", 200), (3, "faster", 30), (4, "later", 40)]
    assert a.log.load().batches == {"a": 0, "b": 7}
    listed = {f for i in a.log.ids() for fs in a.log.load(i).files.values() for f in fs}
    assert {p for p, _ in a.log.files.walk("data") if p.endswith(".parquet")} == listed  # nothing of the first try


def test_writers_at_once_lose_nothing(spark, tmp_path):
    def write(w):
        table = new(spark, tmp_path / "t", retention=1)
        for n in range(2):
            put(spark, table, (10 * w + n, f"w{w}", n, 1, "+I"))

    with ThreadPoolExecutor(3) as pool:
        list(pool.map(write, range(3)))
    table = new(spark, tmp_path / "t")
    assert read(table) == [(10 * w + n, f"w{w}", n) for w in range(3) for n in range(2)]
    assert table.log.ids() == [6]


def test_readers_of_a_dropped_snapshot_have_time(spark, tmp_path):
    table = new(spark, tmp_path / "t", retention=1)
    put(spark, table, (1, "a", 1, 1, "+I"))
    rows = table.read()
    put(spark, table, (1, "b", 2, 1, "+U"))
    assert table.log.ids() == [2] and [tuple(r) for r in rows.collect()] == [(1, "a", 1)]
    table.log.vacuum()
    assert rows.count() == 1
    table.log.prune(1, 0)
    assert {p for p, _ in table.log.files.walk("data") if p.endswith(".parquet")} == {f for fs in table.log.load().files.values() for f in fs}
    assert read(table) == [(1, "b", 2)] and not [n for n in table.log.files.names("snapshot") if n.startswith("DROPPED")]
