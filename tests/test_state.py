"""Keyed state: laws of the folds, streams against folds, checkpoints as tables."""

import time

import pytest
from pyspark.errors import PySparkException, StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from tidemark.operators import keyed_state as ks
from tidemark.options import OptionError, TableOptions
from tidemark.plans.inspect import Inspector
from tidemark.scratch import scratch_path
from tidemark.sources import state_table as sts
from tidemark.sources.table import KeyedTable
from tidemark.streaming import state as st
from tidemark.streaming.tables import follow, upsert_stream

ROWS = "k int, ns string, seq int, v string"


def concat(a, b):
    return F.concat(a, b)


def merged(spark, rows, sources, target, merge=concat):
    df = spark.createDataFrame(rows, "k int, ns string, value string")
    return sorted(((r["k"], r["ns"], r["value"]) for r in ks.merge_namespaces(df, ["k"], "ns", sources, target, merge).collect()), key=repr)


ABC = [(7, "a", "a"), (7, "b", "b"), (7, "c", "c")]


@pytest.mark.parametrize(
    ("rows", "sources", "target", "want"),
    [
        (ABC, ["a", "b", "c"], "t", [(7, "t", "abc")]),
        (ABC, ["c", "a"], "t", [(7, "b", "b"), (7, "t", "ca")]),
        (ABC, ["a", "a", None, "b"], "t", [(7, "c", "c"), (7, "t", "ab")]),
        (ABC + [(7, "t", "t")], ["a", "b"], "t", [(7, "c", "c"), (7, "t", "tab")]),
        (ABC, ["b", "a", "c"], "a", [(7, "a", "bac")]),
        (ABC, ["a"], "a", [(7, "a", "a"), (7, "b", "b"), (7, "c", "c")]),
        (ABC, ["x", "y"], "t", [(7, "a", "a"), (7, "b", "b"), (7, "c", "c")]),
        (ABC + [(7, "t", "t")], [], "t", [*ABC, (7, "t", "t")]),
        ([(7, "a", "a"), (8, "a", "z"), (7, None, "n")], ["a"], "t", [(7, None, "n"), (7, "t", "a"), (8, "t", "z")]),
    ],
)
def test_merging_namespaces(spark, rows, sources, target, want):
    assert merged(spark, rows, sources, target) == sorted(want, key=repr)


def test_a_merge_to_null_starts_anew(spark):
    gone = lambda a, b: F.when(b == "b", F.lit(None)).otherwise(F.concat(a, b))
    assert merged(spark, ABC, ["a", "b", "c"], "t", gone) == [(7, "t", "c")]
    assert merged(spark, ABC[:2], ["a", "b"], "t", gone) == []
    assert merged(spark, ABC[:2] + [(7, "t", "t")], ["a", "b"], "t", gone) == [(7, "t", "t")]
    assert merged(spark, ABC[:2], ["a", "b"], "a", gone) == []


def test_values(spark):
    df = spark.createDataFrame([(1, None, 1, "a"), (1, None, 2, None), (2, None, 1, "x"), (2, None, 2, "y")], ROWS)
    assert [tuple(r) for r in ks.value_state(df, ["k"], "seq", F.col("v")).collect()] == [(2, "y")]
    assert sorted(tuple(r) for r in ks.value_state(df, ["k"], "seq", F.col("v"), F.lit("-")).collect()) == [(1, "-"), (2, "y")]


def test_lists(spark):
    df = spark.createDataFrame([(1, "n", 2, "b"), (1, "n", 1, "a"), (1, "m", 3, "c"), (1, None, 4, "d")], ROWS)
    lists = ks.list_state(df, ["k", "ns"], "seq", F.col("v"))
    assert sorted((r["ns"] or "", r["values"]) for r in lists.collect()) == [("", ["d"]), ("m", ["c"]), ("n", ["a", "b"])]
    both = ks.merge_lists(lists, ["k"], "ns", ["n", "m", "n"], "m")
    assert sorted((r["ns"] or "", r["values"]) for r in both.collect()) == [("", ["d"]), ("m", ["c", "a", "b"])]
    with pytest.raises(PySparkException, match="can't hold null"):
        ks.list_state(df.withColumn("v", F.lit(None).cast("string")), ["k"], "seq", F.col("v")).collect()


def test_maps_tell_null_from_absent(spark):
    df = spark.createDataFrame([(1, "x", 1, "a"), (1, "x", 2, None), (1, "y", 3, "b"), (1, "y", 4, "gone")], ROWS)
    states = ks.map_state(df, ["k"], "seq", "ns", F.col("v"), F.coalesce(F.col("v") == "gone", F.lit(False)))
    assert [tuple(r) for r in states.collect()] == [(1, "x", None)]
    assert ks.map_entries(states, ["k"], "ns").collect()[0]["entries"] == {"x": None}
    with pytest.raises(PySparkException, match="can't be null"):
        ks.map_state(df.withColumn("ns", F.lit(None).cast("string")), ["k"], "seq", "ns", F.col("v")).collect()


def test_reducing_and_aggregating_clear_on_null(spark):
    df = spark.createDataFrame([(1, None, 1, "a"), (1, None, 2, None), (1, None, 3, "b"), (1, None, 4, "c"), (2, None, 1, "z"), (2, None, 2, None)], ROWS)
    assert [tuple(r) for r in ks.reducing_state(df, ["k"], "seq", F.col("v"), concat).collect()] == [(1, "bc")]
    states = ks.aggregating_state(df, ["k"], "seq", F.col("v"), F.lit(0), lambda a, v: a + F.char_length(v), lambda a: a * 10)
    assert [tuple(r) for r in states.collect()] == [(1, 2, 20)]


def test_namespaces_timers_and_time_to_live(spark):
    df = spark.createDataFrame([(1, "a"), (1, None)], "k int, ns string")
    assert ks.clear_namespace(df, "ns", None).count() == ks.clear_namespace(df, "ns", "a").count() == 1
    t = spark.createDataFrame([(1, 5), (1, 5), (1, 3), (1, 9), (2, 1)], "k int, at int")
    fired = ks.fired_timers(t, ["k"], "at", F.lit(5), spark.createDataFrame([(2, 1)], "k int, at int"))
    assert sorted((r["k"], r["nth"], r["at"]) for r in fired.collect()) == [(1, 1, 3), (1, 2, 5)]
    w = spark.sql("SELECT timestamp'2024-01-01 00:00:00' AS w")
    at = lambda s: ks.unexpired(w, "w", 4.2, F.expr(f"timestamp'2024-01-01 00:00:{s:02}'")).count()
    assert (at(4), at(5), at(6)) == (1, 0, 0)


# -- streams -----------------------------------------------------------------------


def stream_of(spark, *batches):
    """A stream that takes one file, and so one batch, at a time."""
    st.configure(spark)
    path = scratch_path(spark, "in")
    for i, b in enumerate(batches):
        b.coalesce(1).write.mode("append").parquet(path)
        time.sleep(0.05 * (i < len(batches) - 1))
    return spark.readStream.schema(batches[0].schema).option("maxFilesPerTrigger", 1).parquet(path)


def finish(stream, at, got=None):
    def sink(rows, i):
        found = rows.collect()
        if got is not None:
            got.extend(found)

    stream.writeStream.outputMode("update").foreachBatch(sink).option("checkpointLocation", at).trigger(availableNow=True).start().awaitTermination()


def numbers(spark, lo, hi):
    return spark.range(lo, hi).select((F.col("id") % 4).alias("k"), F.col("id").alias("seq"), F.col("id").cast("double").alias("v"))


def test_reducing_over_batches_and_restarts(spark):
    at, fold = scratch_path(spark, "ck"), st.ValueFold("seq", DoubleType(), st.reducing("v", lambda a, b: a + b))
    parts = [numbers(spark, 0, 40), numbers(spark, 40, 100)]
    finish(st.run(stream_of(spark, *parts), ["k"], fold, "k long, value double"), at)
    rows = sts.read_state(spark, at, "value")
    assert sorted((r["state_key"]["k"], r["value"]["value"]) for r in rows.collect()) == [(k, float(sum(range(k, 100, 4)))) for k in range(4)]
    assert rows.columns == ["state_key", "value", "partition_id"]
    first = sts.read_state(spark, at, "value", batch=0)
    assert sum(r["value"]["value"] for r in first.collect()) in (sum(range(40)), sum(range(40, 100)))
    assert sts.state_changes(spark, at, "value", 0).count() == 8
    table = sts.state_table(spark, TableOptions.of(path=at, **{"state.name": "value"}), StructType([StructField("k", LongType()), StructField("value", DoubleType())]))
    assert table.columns == ["k", "value"] and table.count() == 4


def test_a_failure_changes_no_result(spark):
    path, at, out = scratch_path(spark, "in"), scratch_path(spark, "ck"), {}
    for lo in range(0, 1000, 250):
        numbers(spark, lo, lo + 250).coalesce(1).write.mode("append").parquet(path)
    source = lambda: spark.readStream.schema(numbers(spark, 0, 1).schema).option("maxFilesPerTrigger", 1).parquet(path)
    fold = lambda: st.ValueFold("seq", LongType(), lambda n, row: (n or 0) + int(row["seq"]))
    calls = []

    def sink(rows, i):
        calls.append(i)
        if len(calls) == 3:
            raise RuntimeError("broken on purpose")
        out.update({r["k"]: r["value"] for r in rows.collect()})

    for attempt in range(2):
        q = st.run(source(), ["k"], fold(), "k long, value long").writeStream.outputMode("update").foreachBatch(sink).option("checkpointLocation", at).trigger(availableNow=True).start()
        if attempt == 0:
            with pytest.raises(Exception, match="broken on purpose"):
                q.awaitTermination()
        else:
            q.awaitTermination()
    assert out == {k: sum(range(k, 1000, 4)) for k in range(4)}


def test_lists_and_maps(spark):
    df = spark.createDataFrame([(1, 2, "b", "x"), (1, 1, "a", "x"), (1, 3, None, "y"), (2, 4, "c", "z"), (2, 5, "gone", "z")], "k long, seq long, v string, m string")
    at = scratch_path(spark, "ck")
    finish(st.run(stream_of(spark, df.where("v is not null")), ["k"], st.ListAppend("seq", "v", StringType()), "k long, n long"), at)
    assert sorted((r["state_key"]["k"], r["value"]["value"]) for r in sts.read_state(spark, at, "list").collect()) == [(1, "a"), (1, "b"), (2, "c"), (2, "gone")]
    at, marked = scratch_path(spark, "ck"), df.withColumn("gone", F.coalesce(F.col("v") == "gone", F.lit(False)))
    finish(st.run(stream_of(spark, marked), ["k"], st.MapPut("seq", "m", "v", StringType(), StringType(), "gone"), "k long, n long"), at)
    rows = sts.read_state(spark, at, "map", "MAP").collect()
    assert sorted((r["state_key"]["k"], r["map_key"]["map_key"], r["map_value"]["value"] if r["map_value"] else None) for r in rows) == [(1, "x", "b"), (1, "y", None)]


def test_timers_fire_once_in_event_time(spark):
    at, got = scratch_path(spark, "ck"), []
    base = 1_700_000_000
    df = spark.createDataFrame([(1, 1, base, 5, False), (1, 2, base, 5, False), (1, 3, base, 8, False), (1, 4, base, 8, True), (2, 5, base + 1, 7, False)], "k long, seq long, s long, after long, cancel boolean")
    late = spark.createDataFrame([(9, 6, base + 100, 1000, False)], df.schema)
    shaped = lambda d: d.select("k", "seq", F.timestamp_seconds("s").alias("time"), ((F.col("s") + F.col("after")) * 1000).alias("at"), "cancel")
    stream = stream_of(spark, shaped(df), shaped(late)).withWatermark("time", "1 second")
    finish(st.run(stream, ["k"], st.Timers("seq", "at", "cancel"), "k long, fired long", "eventTime"), at, got)
    assert sorted((r["k"], r["fired"] - 1000 * base) for r in got) == [(1, 5000), (2, 8000)]
    assert [r["state_key"]["k"] for r in sts.read_timers(spark, at).collect()] == [9]
    seen = Inspector.open(spark, at)
    (timers,) = [t.id for t in seen.targets() if t.kind == "TIMER"][:1]
    assert [seen.rows(timers, timer_prefix=p).count() for p in ("9", "17", "k", "8")] == [1, 1, 0, 0]


def test_time_to_live_needs_processing_time(spark):
    at = scratch_path(spark, "ck")
    fold = st.ValueFold("seq", DoubleType(), st.newest("v"), ttl_seconds=3600, name="kept")
    q = st.run(stream_of(spark, numbers(spark, 0, 8)), ["k"], fold, "k long, value double", "processingTime").writeStream.outputMode("update").format("noop").option("checkpointLocation", at).start()
    until = time.time() + 60
    while time.time() < until and not (q.lastProgress and q.lastProgress["batchId"] >= 1):
        time.sleep(0.3)
    q.stop()
    assert sts.state_catalog(spark, at)[0]["ttl"] or any(s["ttl"] for s in sts.state_catalog(spark, at))
    assert sts.read_state(spark, at, "kept").count() == 4
    assert st.ttl_ms(0.2) == 1000 and st.ttl_ms(4.2) == 5000 and st.ttl_ms(None) is None


def test_initial_state_moves_state_to_a_new_query(spark):
    at, fold = scratch_path(spark, "ck"), lambda: st.ValueFold("seq", LongType(), lambda n, row: (n or 0) + int(row["seq"]))
    finish(st.run(stream_of(spark, numbers(spark, 0, 100)), ["k"], fold(), "k long, value long"), at)
    exported = sts.state_table(spark, TableOptions.of(path=at, **{"state.name": "value"}))
    schema = StructType([StructField("k", LongType()), StructField("value", LongType())])
    start = st.validated_initial(exported, ["k"], schema)
    again, before = scratch_path(spark, "ck"), spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")  # a new checkpoint may have other partitions
    try:
        finish(st.run(stream_of(spark, numbers(spark, 100, 200)), ["k"], fold(), "k long, value long", initial=start), again)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sorted((r["state_key"]["k"], r["value"]["value"]) for r in sts.read_state(spark, again, "value").collect()) == [(k, sum(range(k, 200, 4))) for k in range(4)]
    for bad, why in ((exported.unionAll(exported), "twice"), (exported.withColumn("k", F.lit(None).cast("long")), "null"), (exported.withColumnRenamed("value", "w"), "columns")):
        with pytest.raises(ValueError, match=why):
            st.validated_initial(bad, ["k"], schema)


def moved(spark, stream, processor, output, start, mode="none"):
    """The checkpoint of a new query of three partitions that begins with ``start``."""
    again, before = scratch_path(spark, "ck"), spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        finish(st.run(stream, ["k"], processor, output, mode, initial=start), again)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    return again


def test_initial_state_moves_lists_and_maps(spark):
    df = spark.createDataFrame([(k, 10 * k + i, f"v{9 - i}", f"m{i}") for k in (1, 2) for i in range(5)], "k long, seq long, v string, m string")
    more = spark.createDataFrame([(1, 99, "new", "m0"), (3, 99, "new", "m0")], df.schema)
    at = scratch_path(spark, "ck")
    fold = lambda: st.ListAppend("seq", "v", StringType())
    finish(st.run(stream_of(spark, df), ["k"], fold(), "k long, n long"), at)
    listed = st.with_positions(sts.state_table(spark, TableOptions.of(path=at, **{"state.name": "list"}))).orderBy(F.desc("pos"))
    schema = StructType([StructField("k", LongType()), StructField("value", StringType()), StructField("pos", LongType())])
    again = moved(spark, stream_of(spark, more), fold(), "k long, n long", st.validated_initial(listed, ["k"], schema, "pos"))
    lists = {k: [r["value"]["value"] for r in sts.read_state(spark, again, "list").collect() if r["state_key"]["k"] == k] for k in (1, 2, 3)}
    old = [f"v{9 - i}" for i in range(5)]
    assert lists == {1: [*old, "new"], 2: old, 3: ["new"]}
    at, put = scratch_path(spark, "ck"), lambda: st.MapPut("seq", "m", "v", StringType(), StringType())
    finish(st.run(stream_of(spark, df), ["k"], put(), "k long, n long"), at)
    entries = sts.state_table(spark, TableOptions.of(path=at, **{"state.name": "map", "state.kind": "MAP"}))
    schema = StructType([StructField("k", LongType()), StructField("map_key", StringType()), StructField("map_value", StringType())])
    again = moved(spark, stream_of(spark, more), put(), "k long, n long", st.validated_initial(entries, ["k"], schema, "map_key"))
    rows = sts.read_state(spark, again, "map", "MAP").collect()
    want = {(k, f"m{i}"): f"v{9 - i}" for k in (1, 2) for i in range(5)} | {(1, "m0"): "new", (3, "m0"): "new"}
    assert {(r["state_key"]["k"], r["map_key"]["map_key"]): r["map_value"]["value"] for r in rows} == want
    with pytest.raises(ValueError, match="twice"):
        st.validated_initial(entries.unionAll(entries), ["k"], schema, "map_key")
    with pytest.raises(ValueError, match="lacks"):
        st.run(df, ["k"], put(), "k long, n long", initial=listed)


def test_initial_state_moves_timers(spark):
    base = 1_700_000_000
    shape = lambda rows: spark.createDataFrame(rows, "k long, seq long, s long, after long").select("k", "seq", F.timestamp_seconds("s").alias("time"), ((F.col("s") + F.col("after")) * 1000).alias("at"))
    at, got = scratch_path(spark, "ck"), []
    timers = lambda: st.Timers("seq", "at")
    finish(st.run(stream_of(spark, shape([(1, 1, base, 50), (1, 2, base, 900), (2, 3, base, 60)])).withWatermark("time", "1 second"), ["k"], timers(), "k long, fired long", "eventTime"), at)
    kept = st.timer_entries(sts.read_timers(spark, at))
    schema = StructType([StructField("k", LongType()), StructField("timestamp_ms", LongType())])
    start = st.validated_initial(kept, ["k"], schema, "timestamp_ms")
    stream = stream_of(spark, shape([(9, 4, base + 100, 5000)]), shape([(9, 5, base + 200, 5000)])).withWatermark("time", "1 second")
    again = scratch_path(spark, "ck")
    finish(st.run(stream, ["k"], timers(), "k long, fired long", "eventTime", initial=start), again, got)
    assert sorted((r["k"], r["fired"] - 1000 * base) for r in got) == [(1, 50_000), (2, 60_000)]
    assert sorted((r["state_key"]["k"], r["timestamp_ms"] - 1000 * base) for r in sts.read_timers(spark, again).collect()) == [(1, 900_000), (9, 5_100_000), (9, 5_200_000)]


def test_initial_state_is_refused_where_it_would_be_dropped(spark):
    class Deaf(st._Ordered):
        def init(self, handle):
            pass

        def handleInputRows(self, key, rows, timerValues):
            return iter(())

    df = spark.createDataFrame([(1, 1)], "k long, seq long")
    with pytest.raises(ValueError, match="no initial state"):
        st.run(df, ["k"], Deaf("seq"), "k long", initial=df)


def test_state_names_and_declarations(spark):
    at = scratch_path(spark, "ck")
    finish(st.run(stream_of(spark, numbers(spark, 0, 8)), ["k"], st.ValueFold("seq", DoubleType(), st.newest("v")), "k long, value double"), at)
    for name, kind, operator in ((None, None, None), ("other", None, None), ("value", "MAP", None), ("value", None, 5)):
        with pytest.raises(OptionError):
            sts.read_state(spark, at, name, kind, operator)
    derived = StructType([StructField("k", LongType()), StructField("value", DoubleType())])
    sts.checked_columns(derived, StructType([StructField("k", LongType(), False), StructField("value", DoubleType())]))
    for wrong in (StructType(derived.fields[::-1]), StructType([StructField("k", StringType()), derived["value"]]), StructType([derived["k"]])):
        with pytest.raises(OptionError):
            sts.checked_columns(derived, wrong)
    with pytest.raises(OptionError, match="no primary key"):
        sts.checked_columns(derived, derived, ["k"])


def test_inspector_over_state(spark):
    at = scratch_path(spark, "ck")
    df = spark.createDataFrame([(1, 1, True, "x"), (2, 2, False, "y")], "k long, seq long, b boolean, m string")
    finish(st.run(stream_of(spark, df), ["k", "b"], st.MapPut("seq", "m", "seq", StringType(), LongType()), "k long, b boolean, n long"), at)
    seen = Inspector.open(spark, at)
    assert seen.kind == "state" and seen.meta()["targets"][0]["kind"] == "MAP" and seen.target().id == "map"
    assert seen.rows("map", key={"k": "1", "b": "TRUE"}).count() == 1
    assert seen.rows("map", map_key="y").count() == 1
    for wrong in ({"b": "true"}, {"z": "1"}):
        with pytest.raises(OptionError):
            seen.rows("map", key=wrong)
    with pytest.raises(OptionError, match="No target"):
        seen.rows("nothing")


# -- tables as streams -----------------------------------------------------------------


def table_of(spark, tmp_path, retention=9):
    return KeyedTable.create(spark, TableOptions.of(path=str(tmp_path / "t"), primary_key="k", bucket=4, snapshot__retention=retention))


def test_upsert_stream_commits_each_batch(spark, tmp_path):
    table = table_of(spark, tmp_path)
    upsert_stream(stream_of(spark, numbers(spark, 0, 40), numbers(spark, 40, 100)), table, "q", "seq", scratch_path(spark, "ck")).awaitTermination()
    assert table.log.ids() == [2, 1] and table.log.load().batches == {"q": 1}
    assert table.read().count() == 4


def test_following_skips_to_the_newest_and_tells_changes(spark, tmp_path):
    table, at, got = table_of(spark, tmp_path), scratch_path(spark, "ck"), []
    each = lambda rows, i: got.append((i, sorted((r["k"], r["v"]) for r in rows.collect())))
    follow(table, each, at, poll_ms=None).awaitTermination()  # nothing there yet
    assert got == []
    table.upsert(numbers(spark, 0, 4).withColumnRenamed("seq", "_s"), "_s")
    table.upsert(numbers(spark, 4, 6).withColumnRenamed("seq", "_s"), "_s")
    follow(table, each, at, poll_ms=None).awaitTermination()
    assert got == [(2, [(0, 4.0), (1, 5.0), (2, 2.0), (3, 3.0)])]
    with pytest.raises(OptionError):
        follow(table, each, at, emit="rows")


def test_following_changes(spark, tmp_path):
    table, at, got = table_of(spark, tmp_path), scratch_path(spark, "ck"), []
    table.upsert(numbers(spark, 0, 3).withColumnRenamed("seq", "_s"), "_s")
    q = follow(table, lambda rows, i: got.append((i, sorted((r["_op"], r["k"]) for r in rows.collect()))), at, emit="changes", poll_ms=200)
    try:
        for count, change in ((1, None), (2, spark.createDataFrame([(0, 1, 9.0, "-D"), (3, 1, 9.0, "+I")], "k long, _s int, v double, kind string"))):
            if change is not None:
                table.upsert(change, "_s", "kind")
            until = time.time() + 40
            while len(got) < count and time.time() < until:
                time.sleep(0.1)
    finally:
        q.stop()
    assert got == [(1, [("+I", 0), ("+I", 1), ("+I", 2)]), (2, [("+I", 3), ("-D", 0)])]


def test_inspector_over_a_table(spark, tmp_path):
    table = table_of(spark, tmp_path)
    for lo in (0, 4):
        table.upsert(numbers(spark, lo, lo + 4).withColumnRenamed("seq", "_s"), "_s")
    seen = Inspector.open(spark, str(tmp_path / "t"))
    assert seen.reading == 2 and [s["id"] for s in seen.snapshots()] == [2, 1] and seen.health()["status"] == "ok"
    assert seen.meta()["schema_status"] == "ok" and seen.meta()["buckets"] == 4
    assert seen.rows(key={"k": "1"}).collect()[0]["v"] == 5.0
    seen.set_snapshot(1)
    assert seen.rows(key={"k": "1"}).collect()[0]["v"] == 1.0
    assert len(seen.page(2)[0]) == 2 and seen.page(2)[1] is not None
    keys = spark.createDataFrame([(1,), (77,)], "k long")
    assert sorted(r["found"] for r in seen.lookup(keys).collect()) == [False, True]
    assert seen.track(keys, [1, 2]).where("found").count() == 2
    seen.set_snapshot(None)
    table.log.files.write("snapshot/SNAPSHOT-3.json", "{broken")
    assert seen.refresh() is None or seen.reading == 2
    assert seen.reading == 2 and seen.problems


def test_following_changes_goes_on_after_a_restart(spark, tmp_path):
    table, at, got = table_of(spark, tmp_path), scratch_path(spark, "ck"), []

    def sink(rows, i):
        if i == 2 and len(got) == 1:
            got.append("failed")
            raise RuntimeError("sink")
        got.append((i, sorted((r["_op"], r["k"]) for r in rows.collect())))

    table.upsert(numbers(spark, 0, 3).withColumnRenamed("seq", "_s"), "_s")
    follow(table, sink, at, emit="changes", poll_ms=None).awaitTermination()
    table.upsert(spark.createDataFrame([(0, 1, 9.0, "-D"), (3, 1, 9.0, "+I")], "k long, _s int, v double, kind string"), "_s", "kind")
    with pytest.raises(StreamingQueryException):
        follow(table, sink, at, emit="changes", poll_ms=None).awaitTermination()
    follow(table, sink, at, emit="changes", poll_ms=None).awaitTermination()
    follow(table, sink, at, emit="changes", poll_ms=None).awaitTermination()
    assert got == [(1, [("+I", 0), ("+I", 1), ("+I", 2)]), "failed", (2, [("+I", 3), ("-D", 0)])]
