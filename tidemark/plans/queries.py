"""The engine's registered queries and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from ..functions.typed import guarded_long, parse_column
from ..operators import keyed_state as ks
from ..operators import relational as rel
from ..operators.lookup import Lookup, multi_get, track
from ..operators.scan import byte_prefix, key_range, page, scan, whole_key
from ..options import TableOptions
from ..scratch import scratch_path
from ..sources.kind import detect_kind
from ..sources.state_table import read_join_side, read_state, read_timers, state_catalog
from ..sources.table import KeyedTable, snapshot_diff
from ..streaming import state as st
from ..streaming.tables import follow, upsert_stream
from .sql import create_table

Query = Callable[[SparkSession, str], DataFrame]
_made: dict[str, tuple[Query, str | None]] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        _made[f.__name__] = (f, sql)
        return f

    return add


def queries() -> dict[str, Query]:
    return {name: f for name, (f, _) in _made.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in _made.items() if sql}


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _new(spark: SparkSession, label: str, key: str, bucket: int = 8, retention: int = 8, **more) -> KeyedTable:
    return KeyedTable.create(spark, TableOptions.of(path=scratch_path(spark, label), primary_key=key, bucket=bucket, snapshot__retention=retention, **more))


def _kind():
    """Row kinds of events in the changelog examples: a view changes nothing, an error deletes."""
    return F.when(F.col("event_type") == "view", "-U").when(F.col("event_type") == "error", "-D").otherwise("+U")


def _changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value", "ts", _kind().alias("kind"))


def _customers(spark: SparkSession, sf_dir: str, key: str = "c_custkey", bucket: int = 8) -> KeyedTable:
    table = _new(spark, "customer", key, bucket)
    rows = _t(spark, sf_dir, "customer").withColumn("_one", F.lit(1))
    table.upsert(rows, "_one")
    return table


# -- tables ------------------------------------------------------------------------


@query("""
WITH r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events WHERE event_type <> 'view')
SELECT user_id, event_id, event_type, value FROM r WHERE rn = 1 AND event_type <> 'error'
""")
def upsert_final(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A changelog, upserted and read back."""
    table = _new(spark, "events", "user_id")
    table.upsert(_changes(spark, sf_dir).drop("ts"), "event_id", "kind")
    return table.read().select("user_id", "event_id", "event_type", "value")


def _two_commits(spark: SparkSession, sf_dir: str) -> KeyedTable:
    table, rows = _new(spark, "events", "user_id"), _t(spark, sf_dir, "events").select("user_id", "event_id", "value", "ts")
    early = F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")
    table.upsert(rows.where(early), "event_id")
    table.upsert(rows.where(~early), "event_id")
    return table


@query("""
WITH r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events WHERE ts < TIMESTAMP '2024-01-16')
SELECT user_id, event_id, value FROM r WHERE rn = 1
""")
def time_travel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first of two snapshots."""
    return _two_commits(spark, sf_dir).read(1).select("user_id", "event_id", "value")


@query("""
WITH r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events)
SELECT user_id, event_id, value FROM r WHERE rn = 1
""")
def upsert_onto_existing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second of two snapshots: what the first had stays unless overwritten."""
    return _two_commits(spark, sf_dir).read().select("user_id", "event_id", "value")


@query("""
WITH r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events WHERE event_type <> 'view'),
o AS (SELECT user_id, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events
      WHERE event_type <> 'view' AND ts < TIMESTAMP '2024-01-02') WHERE rn = 1 AND event_type <> 'error'),
n AS (SELECT user_id, event_id FROM r WHERE rn = 1 AND event_type <> 'error')
SELECT coalesce(n.user_id, o.user_id) AS user_id,
       CASE WHEN o.user_id IS NULL THEN '+I' WHEN n.user_id IS NULL THEN '-D' ELSE '+U' END AS op
FROM n FULL JOIN o ON n.user_id = o.user_id WHERE o.event_id IS DISTINCT FROM n.event_id
""")
def snapshot_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What changed between two snapshots, deletes included."""
    table, rows = _new(spark, "events", "user_id"), _changes(spark, sf_dir)
    early = F.col("ts") < F.lit("2024-01-02").cast("timestamp_ntz")
    table.upsert(rows.where(early).drop("ts"), "event_id", "kind")
    table.upsert(rows.where(~early).drop("ts"), "event_id", "kind")
    return snapshot_diff(table, 1, 2).select("user_id", F.col("_op").alias("op"))


@query("""SELECT CAST(2 AS BIGINT) AS kept, CAST(3 AS BIGINT) AS newest, (SELECT count(DISTINCT user_id) FROM events) AS n""")
def retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three commits, of which two are kept and readable."""
    table = _new(spark, "events", "user_id", retention=2)
    rows = _t(spark, sf_dir, "events").select("user_id", "event_id", "value", "event_type")
    for kinds in (["click", "view"], ["purchase", "signup"], ["error"]):
        table.upsert(rows.where(F.col("event_type").isin(kinds)), "event_id")
    ids = table.log.ids()
    return table.read().agg(F.lit(len(ids)).cast("long").alias("kept"), F.lit(ids[0]).cast("long").alias("newest"), F.count(F.lit(1)).alias("n"))


@query("""
SELECT user_id, max(event_id) AS event_id FROM events GROUP BY user_id
""")
def exactly_once_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream of files into a table, and the last batch once more, which changes nothing."""
    from ..streaming.tables import upsert_batch

    table = _new(spark, "stream", "user_id")
    source = _t(spark, sf_dir, "events").select("user_id", "event_id")
    stream = spark.readStream.schema(source.schema).parquet(_as_folder(spark, source))
    upsert_stream(stream, table, "q", "event_id", scratch_path(spark, "checkpoint")).awaitTermination()
    upsert_batch(table, "q", "event_id")(source.limit(0), table.log.load().batches["q"])
    if len(table.log.ids()) != 1 + table.log.load().batches["q"]:
        raise AssertionError("a batch was committed twice")
    return table.read().select("user_id", "event_id")


def _as_folder(spark: SparkSession, rows: DataFrame) -> str:
    """A folder of files that a stream can read."""
    path = scratch_path(spark, "folder")
    rows.write.parquet(path)
    return path


@query("""SELECT user_id, max(event_id) AS event_id FROM events GROUP BY user_id""")
def follow_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table followed as a stream: the newest snapshot's rows, as the sink got them."""
    table, out = _two_commits(spark, sf_dir), scratch_path(spark, "followed")
    follow(table, lambda rows, id: rows.write.mode("overwrite").parquet(out), scratch_path(spark, "checkpoint"), poll_ms=None).awaitTermination()
    return spark.read.parquet(out).select("user_id", "event_id")


@query("""SELECT 'table' AS kind, 'state' AS other""")
def source_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What lies under a table's root and under a checkpoint."""
    table, checkpoint = _two_commits(spark, sf_dir), _value_checkpoint(spark, sf_dir)
    return spark.createDataFrame([(detect_kind(spark, table.root), detect_kind(spark, checkpoint))], "kind string, other string")


# -- lookups and scans ---------------------------------------------------------------


@query("""
SELECT o.o_orderkey, o.o_custkey, c.c_name, c.c_mktsegment
FROM orders o LEFT JOIN (SELECT * FROM customer WHERE c_acctbal >= 0) c ON o.o_custkey = c.c_custkey
""")
def lookup_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their customers; those in debt were deleted and are missed."""
    table = _new(spark, "customer", "c_custkey")
    rows = _t(spark, sf_dir, "customer")
    table.upsert(rows.withColumn("_one", F.lit(1)), "_one")
    gone = rows.where(F.col("c_acctbal") < 0).withColumn("_one", F.lit(1)).withColumn("kind", F.lit("-D"))
    table.upsert(gone, "_one", "kind")
    orders = _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return Lookup(table).join(orders, {"c_custkey": "o_custkey"}, ["c_name", "c_mktsegment"])


@query("""
SELECT o.o_orderkey, c.c_mktsegment AS pinned, upper(c.c_mktsegment) AS refreshed FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
""")
def lookup_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A pinned and a refreshing lookup over a table that changes between the two."""
    table = _customers(spark, sf_dir)
    pinned, fresh = Lookup(table, snapshot=1), Lookup(table, refresh=True)
    table.upsert(_t(spark, sf_dir, "customer").withColumn("c_mktsegment", F.upper("c_mktsegment")).withColumn("_one", F.lit(1)), "_one")
    orders = _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    first = pinned.join(orders, {"c_custkey": "o_custkey"}, ["c_mktsegment"], "inner").withColumnRenamed("c_mktsegment", "pinned")
    return fresh.join(first, {"c_custkey": "o_custkey"}, ["c_mktsegment"], "inner").select("o_orderkey", "pinned", F.col("c_mktsegment").alias("refreshed"))


@query("""SELECT k.o_custkey AS c_custkey, c.c_name, (c.c_custkey IS NOT NULL) AS found FROM (SELECT DISTINCT o_custkey FROM orders) k LEFT JOIN customer c ON k.o_custkey = c.c_custkey""")
def point_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many keys at once."""
    keys = _t(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey")).distinct()
    return multi_get(_customers(spark, sf_dir), keys).select("c_custkey", "c_name", "found")


@query("""
WITH a AS (SELECT user_id, max(event_id) AS e FROM events WHERE ts < TIMESTAMP '2024-01-16' GROUP BY 1), b AS (SELECT user_id, max(event_id) AS e FROM events GROUP BY 1)
SELECT b.user_id, CAST(1 AS BIGINT) AS snapshot, a.e AS event_id FROM b LEFT JOIN a ON a.user_id = b.user_id
UNION ALL SELECT user_id, 2, e FROM b
""")
def tracked_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same keys in two snapshots."""
    keys = _t(spark, sf_dir, "events").select("user_id").distinct()
    return track(_two_commits(spark, sf_dir), keys, [1, 2]).select("user_id", "snapshot", "event_id")


@query("""SELECT c_nationkey, c_name FROM customer WHERE c_nationkey = 7 AND starts_with(c_name, 'Customer#0000')""")
def key_prefix_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A composite key: the first field exact, the second by prefix."""
    table = _customers(spark, sf_dir, "c_nationkey,c_name")
    return scan(table, prefix={"c_nationkey": "7", "c_name": "Customer#0000"}).select("c_nationkey", "c_name")


@query("""SELECT user_id, event_id, value FROM events WHERE (user_id, event_id) > (10, 500) ORDER BY 1, 2 LIMIT 101""")
def page_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page of 100 rows after a key, and one that tells there are more."""
    table = _new(spark, "events", "user_id,event_id", bucket=1)
    table.upsert(_t(spark, sf_dir, "events").select("user_id", "event_id", "value", F.lit(1).alias("_one")), "_one")
    return page(table, 100, start_after={"user_id": 10, "event_id": 500}).select("user_id", "event_id", "value")


@query("""SELECT count(*) AS n, count(DISTINCT c_custkey) AS keys, CAST(8 AS BIGINT) AS buckets FROM customer""")
def bucket_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each bucket by itself; together they are the table."""
    table = _customers(spark, sf_dir)
    parts = [scan(table, bucket=b).withColumn("asked", F.lit(b)) for b in range(8)]
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p)
    return whole.where("_bucket = asked").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("c_custkey").alias("keys"), F.count_distinct("asked").alias("buckets"))


@query("""SELECT c_custkey, c_name FROM customer WHERE c_custkey >= 100 AND c_custkey < 200""")
def key_range_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A range of keys; sorted files outside it are skipped."""
    return scan(_customers(spark, sf_dir), where=key_range("c_custkey", 100, 200)).select("c_custkey", "c_name")


@query("""SELECT c_name, c_acctbal FROM customer WHERE starts_with(c_name, 'Customer#00000001')""")
def byte_prefix_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A range of binary keys by their prefix."""
    table = _new(spark, "customer", "k")
    rows = _t(spark, sf_dir, "customer").select(F.col("c_name").cast("binary").alias("k"), "c_acctbal", F.lit(1).alias("_one"))
    table.upsert(rows, "_one")
    found = scan(table, where=byte_prefix("k", b"Customer#00000001"))
    return found.select(F.col("k").cast("string").alias("c_name"), "c_acctbal")


@query("""SELECT c_custkey, c_nationkey, c_mktsegment FROM customer""")
def columns_by_ordinal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Value columns 1 and 3 beside the key."""
    return scan(_customers(spark, sf_dir), columns=[1, 3]).select("c_custkey", "c_nationkey", "c_mktsegment")


@query("""SELECT c_custkey, c_name FROM customer WHERE c_custkey = 42""")
def point_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One key: only its bucket is read."""
    table = _customers(spark, sf_dir)
    schema = table.schema(table.log.load())
    return scan(table, where=whole_key(table, schema, {"c_custkey": 42})).select("c_custkey", "c_name")


@query("""
SELECT o_orderkey, CASE WHEN abs(o_orderkey * 9007199254740) <= 9007199254740991 THEN CAST(o_orderkey * 9007199254740 AS VARCHAR)
       ELSE '"' || CAST(o_orderkey * 9007199254740 AS VARCHAR) || '"' END AS shown FROM orders
""")
def display_longs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole numbers as JSON: those a double can't hold become strings. The products are decimals: large keys make more than a long holds."""
    product = F.col("o_orderkey").cast("decimal(20,0)") * F.lit(9007199254740).cast("decimal(13,0)")
    return _t(spark, sf_dir, "orders").select("o_orderkey", guarded_long(product).alias("shown"))


# -- keyed state ---------------------------------------------------------------------


@query("""SELECT user_id, arg_max(value, event_id) AS value FROM events GROUP BY user_id""")
def value_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ks.value_state(_t(spark, sf_dir, "events"), ["user_id"], "event_id", F.col("value"))


@query("""SELECT user_id, string_agg(event_type, ',' ORDER BY event_id) AS seq FROM events GROUP BY user_id""")
def list_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = ks.list_state(_t(spark, sf_dir, "events"), ["user_id"], "event_id", F.col("event_type"))
    return lists.select("user_id", F.array_join("values", ",").alias("seq"))


@query("""
SELECT user_id, string_agg(event_type, ',' ORDER BY CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'error' THEN 3 END, event_id) AS seq
FROM events WHERE event_type IN ('view', 'click', 'error') GROUP BY user_id
""")
def list_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists of three namespaces merged into one, in the given order."""
    lists = ks.list_state(_t(spark, sf_dir, "events"), ["user_id", "event_type"], "event_id", F.col("event_type"))
    merged = ks.merge_lists(lists, ["user_id"], "event_type", ["click", "error", "click"], "view")
    return merged.where("event_type = 'view'").select("user_id", F.array_join("values", ",").alias("seq"))


@query("""SELECT user_id, event_type, arg_max(value, event_id) AS value FROM events GROUP BY user_id, event_type""")
def map_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ks.map_state(_t(spark, sf_dir, "events"), ["user_id"], "event_id", "event_type", F.col("value"))


@query("""SELECT user_id, event_type, event_id AS value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) AS rn FROM events) WHERE rn = 1 AND value >= 50""")
def map_state_removals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries whose last change removes them are absent."""
    return ks.map_state(_t(spark, sf_dir, "events"), ["user_id"], "event_id", "event_type", F.col("event_id"), F.col("value") < 50)


@query("""SELECT user_id, min(value) AS value FROM events GROUP BY user_id""")
def reducing_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ks.reducing_state(_t(spark, sf_dir, "events"), ["user_id"], "event_id", F.col("value"), F.least)


@query("""
SELECT user_id, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS total, count(*) AS n FROM events GROUP BY user_id
""")
def aggregating_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An accumulator of two numbers, added to in order."""
    zero = F.struct(F.lit(0).cast("long").alias("total"), F.lit(0).cast("long").alias("n"))
    add = lambda a, v: F.struct((a["total"] + v).alias("total"), (a["n"] + 1).alias("n"))
    cents = F.round(F.col("value") * 100).cast("long")
    states = ks.aggregating_state(_t(spark, sf_dir, "events"), ["user_id"], "event_id", cents, zero, add, lambda a: a["total"] / a["n"])
    return states.select("user_id", "accumulator.total", "accumulator.n")


@query("""
WITH n AS (SELECT user_id, event_type, string_agg(CAST(event_id AS VARCHAR), '+' ORDER BY event_id) AS v FROM events GROUP BY ALL)
SELECT user_id, concat_ws('|', max(v) FILTER (event_type = 'view'), max(v) FILTER (event_type = 'click'), max(v) FILTER (event_type = 'error')) AS value
FROM n WHERE event_type IN ('view', 'click', 'error') GROUP BY user_id
""")
def namespace_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ordered, non-commutative merge of namespaces into a target."""
    rows = _t(spark, sf_dir, "events").withColumn("v", F.col("event_id").cast("string"))
    states = ks.reducing_state(rows, ["user_id", "event_type"], "event_id", F.col("v"), lambda a, b: F.concat(a, F.lit("+"), b))
    merged = ks.merge_namespaces(states, ["user_id"], "event_type", ["click", "error", "click", None], "view", lambda a, b: F.concat(a, F.lit("|"), b))
    return merged.where("event_type = 'view'").select("user_id", "value")


@query("""
WITH a AS (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) <= INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS brk FROM events),
b AS (SELECT *, sum(brk) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS sid FROM a)
SELECT user_id, min(ts) AS start, max(ts) + INTERVAL 30 MINUTE AS "end", count(*) AS n FROM b GROUP BY user_id, sid
""")
def session_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ks.sessions(_t(spark, sf_dir, "events"), ["user_id"], "ts", "30 minutes", F.count(F.lit(1)).alias("n"))


@query("""
WITH w AS (SELECT max(ts) AS w FROM events)
SELECT user_id, ts + INTERVAL 1 DAY AS at, row_number() OVER (PARTITION BY user_id ORDER BY ts) AS nth FROM events, w
WHERE ts + INTERVAL 1 DAY <= w AND event_type <> 'error'
""")
def timers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A timer a day after each event, those of errors deleted, up to the watermark."""
    rows = _t(spark, sf_dir, "events").withColumn("at", F.col("ts") + F.make_dt_interval(days=F.lit(1)))
    mark = F.lit(rows.agg(F.max("ts")).first()[0]).cast("timestamp_ntz")
    return ks.fired_timers(rows, ["user_id"], "at", mark, rows.where("event_type = 'error'")).withColumn("nth", F.col("nth").cast("long"))


# -- state of streams ------------------------------------------------------------------


def _finished(stream: DataFrame, spark: SparkSession, mode: str = "update") -> str:
    """Run a bounded stream to its end; its checkpoint."""
    checkpoint = scratch_path(spark, "checkpoint")
    stream.writeStream.outputMode(mode).foreachBatch(lambda rows, id: rows.write.format("noop").mode("overwrite").save()).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return checkpoint


def _events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _t(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value", "ts")
    st.configure(spark)
    return spark.readStream.schema(rows.schema).parquet(_as_folder(spark, rows))


def _value_checkpoint(spark: SparkSession, sf_dir: str) -> str:
    from pyspark.sql.types import DoubleType

    fold = st.ValueFold("event_id", DoubleType(), st.newest("value"))
    return _finished(st.run(_events_stream(spark, sf_dir), ["user_id"], fold, "user_id long, value double"), spark)


@query("""SELECT user_id, arg_max(value, event_id) AS value FROM events GROUP BY user_id""")
def value_state_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream's value state, read from its checkpoint as a table."""
    rows = read_state(spark, _value_checkpoint(spark, sf_dir), "value")
    return rows.select("state_key.user_id", "value.value")


@query("""SELECT user_id, CAST(count(*) AS BIGINT) AS n, CAST(sum(event_id) AS BIGINT) AS total FROM events GROUP BY user_id""")
def list_state_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    fold = st.ListAppend("event_id", "event_id", LongType())
    at = _finished(st.run(_events_stream(spark, sf_dir), ["user_id"], fold, "user_id long, added long"), spark)
    return read_state(spark, at, "list", "LIST").groupBy("state_key.user_id").agg(F.count(F.lit(1)).alias("n"), F.sum("value.value").alias("total"))


@query("""SELECT user_id, event_type, max(event_id) AS last_event FROM events GROUP BY user_id, event_type""")
def map_state_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql.types import StringType

    fold = st.MapPut("event_id", "event_type", "event_id", StringType(), LongType())
    at = _finished(st.run(_events_stream(spark, sf_dir), ["user_id"], fold, "user_id long, touched long"), spark)
    return read_state(spark, at, "map", "MAP").select("state_key.user_id", F.col("map_key.map_key").alias("event_type"), F.col("map_value.value").alias("last_event"))


@query("""SELECT user_id, event_type, min(value) AS value FROM events GROUP BY user_id, event_type""")
def reducing_state_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reducing state with a namespace as a further grouping column."""
    from pyspark.sql.types import DoubleType

    fold = st.ValueFold("event_id", DoubleType(), st.reducing("value", min), name="least")
    at = _finished(st.run(_events_stream(spark, sf_dir), ["user_id", "event_type"], fold, "user_id long, event_type string, value double"), spark)
    return read_state(spark, at, "least").select("state_key.user_id", "state_key.event_type", "value.value")


@query("""SELECT user_id, count(*) AS n FROM events GROUP BY user_id""")
def aggregating_state_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    fold = st.ValueFold("event_id", LongType(), st.aggregating("event_id", int, lambda n, _: n + 1), name="count")
    at = _finished(st.run(_events_stream(spark, sf_dir), ["user_id"], fold, "user_id long, value long"), spark)
    return read_state(spark, at, "count").select("state_key.user_id", F.col("value.value").alias("n"))


@query("""
SELECT user_id, CAST(epoch_us(ts) // 1000 + 864000000000 AS BIGINT) AS timestamp_ms FROM events
""")
def registered_timers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Timers far in the future, registered by a stream and read from its checkpoint."""
    stream = _events_stream(spark, sf_dir).withColumn("time", F.col("ts").cast("timestamp")).withWatermark("time", "1 minute")
    stream = stream.withColumn("at", F.unix_millis("time") + F.lit(864_000_000_000).cast("long")).select("event_id", "user_id", "time", "at")
    at = _finished(st.run(stream, ["user_id"], st.Timers("event_id", "at"), "user_id long, fired long", "eventTime"), spark)
    return read_timers(spark, at).select("state_key.user_id", "timestamp_ms")


@query("""SELECT 'value' AS name, 'VALUE' AS kind, false AS ttl""")
def state_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The states of a checkpoint's operators."""
    rows = [(s["name"], s["kind"], s["ttl"]) for s in state_catalog(spark, _value_checkpoint(spark, sf_dir))]
    return spark.createDataFrame(rows, "name string, kind string, ttl boolean")


@query("""
SELECT user_id, event_id, CAST(epoch_us(ts) AS BIGINT) AS us FROM events WHERE event_type = 'view'
""")
def join_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a stream-stream join keeps of its left input, read from its checkpoint."""
    stream = _events_stream(spark, sf_dir)
    views = stream.where("event_type = 'view'").select(F.col("user_id").alias("u"), "event_id", "ts")
    buys = _events_stream(spark, sf_dir).where("event_type = 'purchase'").select("user_id", F.col("event_id").alias("buy_id"))
    at = _finished(views.join(buys, F.col("u") == F.col("user_id")), spark, "append")
    return read_join_side(spark, at, "left").select(F.col("value.u").alias("user_id"), "value.event_id", F.unix_micros(F.col("value.ts").cast("timestamp")).alias("us"))


def _collected(stream: DataFrame, spark: SparkSession, mode: str) -> DataFrame:
    """A bounded stream's last output, as its sink got it."""
    out = scratch_path(spark, "out")
    stream.writeStream.outputMode(mode).foreachBatch(lambda rows, id: rows.write.mode("overwrite").parquet(out)).option("checkpointLocation", scratch_path(spark, "checkpoint")).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(out)


@query("""SELECT event_type, time_bucket(INTERVAL 1 HOUR, ts) AS start, count(*) AS n FROM events GROUP BY ALL""")
def tumbling_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windowed counts of a stream with a watermark, all windows at the end."""
    stream = _events_stream(spark, sf_dir).withColumn("time", F.col("ts").cast("timestamp")).withWatermark("time", "1 hour")
    counts = stream.groupBy("event_type", F.window("time", "1 hour").alias("w")).agg(F.count(F.lit(1)).alias("n"))
    return _collected(counts, spark, "complete").select("event_type", F.col("w.start").cast("timestamp_ntz").alias("start"), "n")


@query("""
WITH a AS (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) <= INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS brk FROM events),
b AS (SELECT *, sum(brk) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS sid FROM a)
SELECT user_id, min(ts) AS start, count(*) AS n FROM b GROUP BY user_id, sid
""")
def session_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions of a stream, merged as rows come."""
    stream = _events_stream(spark, sf_dir).withColumn("time", F.col("ts").cast("timestamp")).withWatermark("time", "1 hour")
    counts = stream.groupBy("user_id", F.session_window("time", "30 minutes").alias("w")).agg(F.count(F.lit(1)).alias("n"))
    return _collected(counts, spark, "complete").select("user_id", F.col("w.start").cast("timestamp_ntz").alias("start"), "n")


@query("""SELECT DISTINCT user_id, event_type FROM events""")
def dedup_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first row of each key of a stream."""
    return _collected(_events_stream(spark, sf_dir).select("user_id", "event_type").dropDuplicates(), spark, "append")


@query("""
SELECT c.n_name AS nation, count(*) AS n, CAST(sum(CAST(floor(o.o_totalprice) AS BIGINT)) AS BIGINT) AS total
FROM orders o JOIN customer k ON o.o_custkey = k.c_custkey JOIN nation c ON k.c_nationkey = c.n_nationkey GROUP BY ALL
""")
def sql_over_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declared tables, filled by a query and joined in SQL."""
    columns = {"c_custkey": "BIGINT", "c_name": "VARCHAR(40)", "c_nationkey": "INT"}
    declared = create_table(spark, columns, path=scratch_path(spark, "sql"), primary_key="c_custkey", bucket=8)
    declared.insert_into(_t(spark, sf_dir, "customer"))
    declared.register("tidemark_customer")
    _t(spark, sf_dir, "orders").createOrReplaceTempView("tidemark_orders")
    _t(spark, sf_dir, "nation").createOrReplaceTempView("tidemark_nation")
    return spark.sql("""
        SELECT n_name AS nation, count(*) AS n, sum(cast(floor(o_totalprice) AS bigint)) AS total
        FROM tidemark_orders JOIN tidemark_customer ON o_custkey = c_custkey JOIN tidemark_nation ON c_nationkey = n_nationkey
        GROUP BY n_name""")


@query("""SELECT event_id, TRY_CAST(event_type AS BIGINT) AS wrong, CAST(event_id AS BIGINT) AS parsed FROM events""")
def typed_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts as typed values; what isn't one is null."""
    text = _t(spark, sf_dir, "events").select("event_id", "event_type", F.col("event_id").cast("string").alias("t"))
    return text.select("event_id", parse_column(F.col("event_type"), LongType()).alias("wrong"), parse_column(F.col("t"), LongType()).alias("parsed"))


# -- what a host would run over the tables -----------------------------------------------


@query("""SELECT user_id, event_id, rn FROM (SELECT user_id, event_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS INTEGER) AS rn FROM events) WHERE rn <= 3""")
def top_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rel.top_n(_t(spark, sf_dir, "events").select("user_id", "event_id"), ["user_id"], [F.col("event_id").desc()], 3)


@query("""SELECT user_id, min(event_id) AS event_id, arg_min(event_type, event_id) AS event_type FROM events GROUP BY user_id""")
def dedup_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rel.keep_first(_t(spark, sf_dir, "events").select("user_id", "event_id", "event_type"), ["user_id"], "event_id")


@query("""SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type FROM events GROUP BY user_id""")
def dedup_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rel.keep_last(_t(spark, sf_dir, "events").select("user_id", "event_id", "event_type"), ["user_id"], "event_id")


@query("""
SELECT e.event_id, o.event_id AS click_id FROM events e
ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'click') o ON e.user_id = o.user_id AND e.ts >= o.ts
""")
def asof_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _t(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type")
    clicks = events.where("event_type = 'click'")
    return rel.as_of(events, clicks, ["user_id"], "ts", "event_id", {"event_id": "click_id"}).select("event_id", "click_id")


@query("""
SELECT a.event_id AS view_id, b.event_id AS buy_id FROM events a JOIN events b ON a.user_id = b.user_id
WHERE a.event_type = 'view' AND b.event_type = 'purchase' AND b.ts BETWEEN a.ts - INTERVAL 60 SECOND AND a.ts + INTERVAL 7200 SECOND
""")
def interval_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _t(spark, sf_dir, "events")
    views = events.where("event_type = 'view'").select("user_id", F.col("event_id").alias("view_id"), "ts")
    buys = events.where("event_type = 'purchase'").select("user_id", F.col("event_id").alias("buy_id"), F.col("ts").alias("bought"))
    return rel.interval_join(views, buys, ["user_id"], "ts", 60, 7200, "bought").select("view_id", "buy_id")


@query("""
SELECT a.event_id AS view_id, b.event_id AS buy_id FROM events a JOIN events b ON a.user_id = b.user_id AND time_bucket(INTERVAL 1 HOUR, a.ts) = time_bucket(INTERVAL 1 HOUR, b.ts)
WHERE a.event_type = 'view' AND b.event_type = 'purchase'
""")
def window_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _t(spark, sf_dir, "events")
    views = events.where("event_type = 'view'").select("user_id", F.col("event_id").alias("view_id"), "ts")
    buys = events.where("event_type = 'purchase'").select("user_id", F.col("event_id").alias("buy_id"), F.col("ts").alias("bought"))
    return rel.window_join(views, buys, ["user_id"], "ts", "bought", "1 hour").select("view_id", "buy_id")


@query("""SELECT c_custkey FROM customer c WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderstatus = 'F')""")
def semi_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _t(spark, sf_dir, "orders").where("o_orderstatus = 'F'")
    customer = _t(spark, sf_dir, "customer").select("c_custkey")
    return customer.join(orders, customer["c_custkey"] == orders["o_custkey"], "left_semi")


@query("""SELECT c_custkey FROM customer c WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey)""")
def anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, orders = _t(spark, sf_dir, "customer").select("c_custkey"), _t(spark, sf_dir, "orders")
    return customer.join(orders, customer["c_custkey"] == orders["o_custkey"], "left_anti")


@query("""
SELECT n_name, r_name, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL
""")
def star_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, n, r = (_t(spark, sf_dir, t) for t in ("customer", "nation", "region"))
    joined = c.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n")).join(n, F.col("c_nationkey") == F.col("n_nationkey")).join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    return joined.select("n_name", "r_name", "n")


@query("""SELECT l_returnflag, l_linestatus, count(*) AS n, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)""")
def cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _t(spark, sf_dir, "lineitem").cube("l_returnflag", "l_linestatus")
    return rows.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("l_quantity").cast("long")).alias("quantity"))


@query("""SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)""")
def rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "lineitem").rollup("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT count(DISTINCT l_partkey) AS parts, count(DISTINCT l_suppkey) AS suppliers FROM lineitem""")
def distinct_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "lineitem").agg(F.count_distinct("l_partkey").alias("parts"), F.count_distinct("l_suppkey").alias("suppliers"))


@query("""
SELECT user_id, event_id, CAST(sum(CAST(round(value * 100) AS BIGINT)) OVER w AS BIGINT) AS cents, count(*) OVER w AS n
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
""")
def over_running(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _t(spark, sf_dir, "events").select("user_id", "event_id", F.round(F.col("value") * 100).cast("long").alias("c"))
    return rel.over_running(events, ["user_id"], ["event_id"], cents=F.sum("c"), n=F.count(F.lit(1))).drop("c")


@query("""SELECT event_type, time_bucket(INTERVAL 1 HOUR, ts) AS start, time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS "end", count(*) AS n FROM events GROUP BY ALL""")
def tumbling_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rel.tumbling(_t(spark, sf_dir, "events"), "ts", "1 hour", ["event_type"], F.count(F.lit(1)).alias("n"))


@query("""
SELECT event_type, s AS start, s + INTERVAL 2 HOUR AS "end", count(*) AS n
FROM (SELECT event_type, unnest([time_bucket(INTERVAL 1 HOUR, ts), time_bucket(INTERVAL 1 HOUR, ts) - INTERVAL 1 HOUR]) AS s FROM events) GROUP BY ALL
""")
def sliding_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rel.sliding(_t(spark, sf_dir, "events"), "ts", "2 hours", "1 hour", ["event_type"], F.count(F.lit(1)).alias("n"))


@query("""
SELECT c_custkey AS k, 'both' AS side FROM customer INTERSECT SELECT o_custkey, 'both' FROM orders
UNION ALL SELECT * FROM (SELECT c_custkey, 'customer' FROM customer EXCEPT SELECT o_custkey, 'customer' FROM orders)
""")
def set_operations(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = _t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k")), _t(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"))
    return a.intersect(b).withColumn("side", F.lit("both")).unionByName(a.exceptAll(b.distinct()).withColumn("side", F.lit("customer")))


@query("""
SELECT l_returnflag, l_linestatus, count(*) AS n, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity
FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY ALL
""")
def filtered_aggregate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _t(spark, sf_dir, "lineitem").where(F.col("l_shipdate") <= F.lit("1998-09-02").cast("timestamp_ntz"))
    return rows.groupBy("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("l_quantity").cast("long")).alias("quantity"))


# -- the inspector, filters and edge cases ------------------------------------------------


@query("""SELECT c_custkey, CASE WHEN c_custkey % 2 = 1 THEN c_name END AS c_name FROM customer""")
def all_null_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose values are all null are rows like any other."""
    table = _new(spark, "nulls", "c_custkey")
    rows = _t(spark, sf_dir, "customer").select("c_custkey", F.when(F.col("c_custkey") % 2 == 1, F.col("c_name")).alias("c_name"))
    table.upsert(rows.withColumn("_one", F.lit(1)), "_one")
    return table.read().select("c_custkey", "c_name")


@query("""SELECT c_custkey, c_name FROM customer WHERE c_custkey % 2 = 1""")
def all_null_is_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With the option, an upsert of nothing but nulls deletes what was there."""
    table = _new(spark, "nulls", "c_custkey", **{"all-null-is-delete": "true"})
    rows = _t(spark, sf_dir, "customer").select("c_custkey", "c_name", F.lit(1).alias("_one"))
    table.upsert(rows, "_one")
    table.upsert(rows.where("c_custkey % 2 = 0").withColumn("c_name", F.lit(None).cast("string")), "_one")
    return table.read().select("c_custkey", "c_name")


@query("""SELECT CAST(2 AS BIGINT) AS snapshot, true AS readable UNION ALL SELECT 99, false UNION ALL SELECT 0, false""")
def missing_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A snapshot that isn't there is an error, not an empty table."""
    table, found = _two_commits(spark, sf_dir), []
    for id in (2, 99, 0):
        try:
            table.read(id)
            found.append((id, True))
        except LookupError:
            found.append((id, False))
    return spark.createDataFrame(found, "snapshot long, readable boolean")


@query("""
SELECT o.o_orderkey, c.c_name FROM orders o LEFT JOIN customer c ON c.c_custkey = CASE WHEN o.o_orderkey % 3 > 0 THEN o.o_custkey END
""")
def null_lookup_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A null key matches nothing."""
    orders = _t(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 3 > 0, F.col("o_custkey")).alias("k"))
    return Lookup(_customers(spark, sf_dir)).join(orders, {"c_custkey": "k"}, ["c_name"]).select("o_orderkey", "c_name")


@query("""SELECT c_nationkey, c_name FROM customer WHERE c_nationkey = 3 AND c_name > 'Customer#000000100' ORDER BY 1, 2 LIMIT 11""")
def filtered_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The filter comes before the limit: a full page, if there are as many rows."""
    table = _customers(spark, sf_dir, "c_nationkey,c_name", bucket=1)
    return page(table, 10, start_after={"c_nationkey": 3, "c_name": "Customer#000000100"}, prefix={"c_nationkey": "3"}).select("c_nationkey", "c_name")


@query("""
SELECT user_id, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS total FROM events WHERE event_type IN ('view', 'click', 'error') GROUP BY user_id
""")
def accumulator_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accumulators of two namespaces merged into a third's: counts and sums, not results."""
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("total"))
    add = lambda a, x: F.struct((a["n"] + 1).alias("n"), (a["total"] + x).alias("total"))
    states = ks.aggregating_state(_t(spark, sf_dir, "events"), ["user_id", "event_type"], "event_id", F.col("event_id"), zero, add, lambda a: a["total"])
    merge = lambda a, b: F.struct((a["n"] + b["n"]).alias("n"), (a["total"] + b["total"]).alias("total"))
    merged = ks.merge_namespaces(states, ["user_id"], "event_type", ["click", "error"], "view", merge, "accumulator")
    return merged.where("event_type = 'view'").select("user_id", "accumulator.n", "accumulator.total")


@query("""
WITH s AS (SELECT user_id, event_type, max(ts) AS written FROM events GROUP BY ALL)
SELECT user_id, event_type, written FROM s WHERE written + INTERVAL 86400 SECOND > (SELECT max(ts) FROM events)
""")
def time_to_live(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State not written for a day is gone."""
    rows = _t(spark, sf_dir, "events")
    now = F.lit(rows.agg(F.max("ts")).first()[0]).cast("timestamp_ntz")
    return ks.unexpired(rows.groupBy("user_id", "event_type").agg(F.max("ts").alias("written")), "written", 86_400, now)


@query("""SELECT 'table' AS kind, CAST(2 AS BIGINT) AS reading, CAST(8 AS BIGINT) AS buckets, 'user_id' AS primary_key, 'table:TABLE' AS targets, true AS follows_latest""")
def inspected_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the inspector says of a table."""
    from .inspect import Inspector

    meta = Inspector.open(spark, _two_commits(spark, sf_dir).root).meta()
    named = ",".join(f"{t['id']}:{t['kind']}" for t in meta["targets"])
    row = (meta["kind"], meta["reading"], meta["buckets"], ",".join(meta["primary_key"]), named, meta["follows_latest"])
    return spark.createDataFrame([row], "kind string, reading long, buckets long, primary_key string, targets string, follows_latest boolean")


@query("""
SELECT user_id, max(event_id) AS event_id, CAST(1 AS BIGINT) AS reading FROM events WHERE ts < TIMESTAMP '2024-01-16' GROUP BY user_id
UNION ALL SELECT user_id, max(event_id), 2 FROM events GROUP BY user_id
""")
def inspected_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The inspector pinned to the first snapshot, then following the newest."""
    from .inspect import Inspector

    inspector = Inspector.open(spark, _two_commits(spark, sf_dir).root, snapshot=1)
    first = inspector.rows().select("user_id", "event_id", F.lit(inspector.reading).cast("long").alias("reading"))
    inspector.set_snapshot(None)
    return first.unionByName(inspector.rows().select("user_id", "event_id", F.lit(inspector.reading).cast("long").alias("reading")))


@query("""SELECT user_id, arg_max(value, event_id) AS value FROM events WHERE user_id = 5 GROUP BY user_id""")
def inspected_state_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One key of a value state: only its partition is read."""
    from .inspect import Inspector

    rows = Inspector.open(spark, _value_checkpoint(spark, sf_dir)).rows("value", key={"user_id": "5"})
    return rows.select("state_key.user_id", "value.value")


@query("""SELECT user_id, max(event_id) AS last_event FROM events WHERE event_type = 'click' GROUP BY user_id""")
def inspected_map_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One entry of every key's map."""
    from pyspark.sql.types import StringType

    from .inspect import Inspector

    fold = st.MapPut("event_id", "event_type", "event_id", StringType(), LongType())
    at = _finished(st.run(_events_stream(spark, sf_dir), ["user_id"], fold, "user_id long, touched long"), spark)
    return Inspector.open(spark, at).rows("map", map_key="click").select("state_key.user_id", F.col("map_value.value").alias("last_event"))


@query("""
WITH t AS (SELECT user_id, CAST(epoch_us(ts) // 1000 + 864000000000 AS BIGINT) AS timestamp_ms FROM events)
SELECT * FROM t WHERE starts_with(CAST(user_id AS VARCHAR), '1') OR starts_with(CAST(timestamp_ms AS VARCHAR), '1')
""")
def inspected_timers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Timers whose key or time starts with a text."""
    from .inspect import Inspector

    stream = _events_stream(spark, sf_dir).withColumn("time", F.col("ts").cast("timestamp")).withWatermark("time", "1 minute")
    stream = stream.withColumn("at", F.unix_millis("time") + F.lit(864_000_000_000).cast("long")).select("event_id", "user_id", "time", "at")
    at = _finished(st.run(stream, ["user_id"], st.Timers("event_id", "at"), "user_id long, fired long", "eventTime"), spark)
    inspector = Inspector.open(spark, at)
    timer = next(t.id for t in inspector.targets() if t.kind == "TIMER")
    return inspector.rows(timer, timer_prefix="1").select("state_key.user_id", "timestamp_ms")
