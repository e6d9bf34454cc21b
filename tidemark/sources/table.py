"""Keyed tables: primary-key upserts into hash buckets, every commit a numbered snapshot.

Layout below a root: ``data/commit=<id>/_bucket=<n>/*.parquet``, the snapshot log and the
schema log.  A commit writes only the buckets that its changes touch and lists the
others' files again, so a small change to a large table costs a few buckets.  Files
are sorted by primary key within a bucket: their min/max statistics serve key ranges.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, MapType, StringType, StructField, StructType

from ..options import OptionError, TableOptions
from ..scratch import discard, materialise
from .schema_log import SchemaLog
from .snapshots import Snapshot, SnapshotLog, SnapshotMissing

BUCKET, COMMIT = "_bucket", "commit"
INSERT, UPDATE_BEFORE, UPDATE_AFTER, DELETE = "+I", "-U", "+U", "-D"
OPS = (INSERT, UPDATE_BEFORE, UPDATE_AFTER, DELETE)


def bucket_of(key: list[Column], buckets: int) -> Column:
    """The bucket of a primary key: a stable hash of the typed key columns."""
    return F.pmod(F.hash(*key), F.lit(buckets)).cast("int")


def net_changes(changes: DataFrame, key: list[str], seq: list[str], op: str | None) -> DataFrame:
    """The last change of each key by ``seq``, with column ``_op``; ``-U`` rows say nothing new.

    One aggregation with map-side combine: a key with very many changes is reduced
    before the shuffle.
    """
    values = [c for c in changes.columns if c not in (*key, *seq, op)]
    said = F.col(op) if op else F.lit(INSERT)
    known = F.when(said.isin(*OPS), said).otherwise(F.raise_error(F.concat(F.lit("Unknown row kind: "), F.coalesce(said, F.lit("null")))))
    whole = reduce(lambda a, b: a & b, (F.col(k).isNotNull() for k in key))
    known = F.when(whole, known).otherwise(F.raise_error(F.lit(f"Primary key columns {key} must not be null")))
    rows = changes.withColumn("_op", known).where(F.col("_op") != UPDATE_BEFORE)
    last = F.max_by(F.struct("_op", *values), F.struct(*seq))
    return rows.groupBy(*key).agg(last.alias("_last")).select(*key, "_last.*")


class KeyedTable:
    """A table at one root.  Create it with :meth:`create`, find it with :meth:`open`."""

    def __init__(self, spark: SparkSession, root: str, key: list[str], buckets: int, retention: int = 1, all_null_is_delete: bool = False, grace_ms: int = 600_000):
        self.spark, self.root, self.key, self.buckets = spark, root, list(key), buckets
        self.retention, self.all_null_is_delete, self.grace_ms = retention, all_null_is_delete, grace_ms
        self.log = SnapshotLog(spark, root)
        self.schemas = SchemaLog(self.log.files)

    # -- making and finding ------------------------------------------------------

    @staticmethod
    def create(spark: SparkSession, options: TableOptions) -> KeyedTable:
        """A table to write to: a new one, or the existing one if the options fit it."""
        if not options.primary_key:
            raise OptionError("A primary key is required")
        if options.bucket is None:
            raise OptionError("Option 'bucket' is required")
        table = KeyedTable(spark, options.path, list(options.primary_key), options.bucket, options.retention, options.all_null_is_delete, options.grace_ms)
        table._fits(table.log.latest())
        return table

    @staticmethod
    def open(spark: SparkSession, options: TableOptions) -> KeyedTable:
        """An existing table to read from; bucket count and key come from its newest snapshot."""
        last = SnapshotLog(spark, options.path).load(options.snapshot)
        table = KeyedTable(spark, options.path, list(options.primary_key) or last.primary_key, options.bucket or last.buckets, options.retention, grace_ms=options.grace_ms)
        table._fits(last)
        return table

    def _fits(self, snapshot: Snapshot | None) -> None:
        if snapshot is None:
            return
        if snapshot.buckets != self.buckets:
            raise OptionError(f"Option 'bucket' is {self.buckets}, but the table at {self.root} has {snapshot.buckets} buckets")
        if snapshot.primary_key != self.key:
            raise OptionError(f"The primary key is {self.key}, but the table at {self.root} has {snapshot.primary_key}")

    # -- reading -----------------------------------------------------------------

    def schema(self, snapshot: Snapshot) -> StructType:
        """The snapshot's schema; where its blob can't be read, that of its files."""
        try:
            return self.schemas.blob(snapshot.schema)
        except Exception:  # the schema log is a help for readers, the files say it all
            path = next((f for listed in snapshot.files.values() for f in listed), None)
            if path is None:
                raise
            return self.spark.read.parquet(f"{self.root}/{path}").schema

    def read(self, id: int | None = None, columns: list[str] | None = None, with_bucket: bool = False) -> DataFrame:
        """All rows of a snapshot, the newest if ``id`` is None.  Columns are bound by name; one that
        the snapshot doesn't have reads as null."""
        snapshot = self.log.load(id)
        self._fits(snapshot)
        rows = self.rows_of(snapshot)
        have = self.schema(snapshot)
        wanted = columns if columns is not None else have.names
        chosen = [F.col(c) if c in have.names else F.lit(None).cast("string").alias(c) for c in wanted]
        return rows.select(*chosen, *([BUCKET] if with_bucket else []))

    def rows_of(self, snapshot: Snapshot, buckets: list[int] | None = None) -> DataFrame:
        """Rows with their ``_bucket``, a partition column, of all or some buckets."""
        schema = self.schema(snapshot)
        full = StructType([*schema, StructField(COMMIT, StringType()), StructField(BUCKET, IntegerType())])
        paths = [f"{self.root}/{f}" for b, listed in snapshot.files.items() if buckets is None or int(b) in buckets for f in listed]
        if not paths:
            return self.spark.createDataFrame([], full).drop(COMMIT)
        return self.spark.read.schema(full).option("basePath", f"{self.root}/data").parquet(*paths).drop(COMMIT)

    # -- writing -----------------------------------------------------------------

    def upsert(
        self,
        changes: DataFrame,
        seq: str | list[str],
        op: str | None = None,
        parallelism: int | None = None,
        batch: tuple[str, int] | None = None,
    ) -> Snapshot:
        """Commit changes as the next snapshot and return it.

        ``op`` names the column of row kinds; without it all rows are inserts.  ``seq``
        orders the changes of a key and has to be unique per key.  ``batch`` is
        (query, batch id) of a stream: a batch that is committed already changes nothing.

        Where another writer commits meanwhile, the changes are applied to its snapshot instead:
        of changes to one key by two writers, those committed later stand.
        """
        last = self.log.latest()
        self._fits(last)
        if batch and last and last.batches.get(batch[0], -1) >= batch[1]:
            return last
        seq = [seq] if isinstance(seq, str) else list(seq)
        values = [c for c in changes.columns if c not in (*self.key, *seq, op)]
        schema = self._schema_for(changes, seq, op, values)
        self._same_columns(last, schema)
        # columns that seq also names as values are carried twice: once to order, once to keep
        ordered = changes.select(*[F.col(c) for c in (*self.key, *([op] if op else []))], *[F.col(s).alias(f"_seq{i}") for i, s in enumerate(seq)], *[F.col(c) for c in schema.names if c not in self.key])
        net = net_changes(ordered, self.key, [f"_seq{i}" for i in range(len(seq))], op)
        if self.all_null_is_delete:
            stored = [c for c in schema.names if c not in self.key]
            nothing = reduce(lambda a, b: a & b, (F.col(c).isNull() for c in stored))
            net = net.withColumn("_op", F.when(nothing, F.lit(DELETE)).otherwise(F.col("_op")))
        net = materialise(net.withColumn(BUCKET, bucket_of([F.col(k) for k in self.key], self.buckets)), "net")
        touched = sorted(r[0] for r in net.select(BUCKET).distinct().collect())  # at most the number of buckets
        while True:
            try:
                snapshot = self._commit_onto(last, net, touched, schema, parallelism, batch)
                break
            except Exception:
                newer = self.log.latest()
                if newer is None or newer.id == (last.id if last else 0):
                    raise
                last = newer  # another writer was faster: each try that fails so is a commit of theirs
                self._fits(last)
                self._same_columns(last, schema)
                if batch and last.batches.get(batch[0], -1) >= batch[1]:
                    snapshot = last
                    break
        discard(net)
        self.log.prune(self.retention, self.grace_ms)
        return snapshot

    def _same_columns(self, last: Snapshot | None, schema: StructType) -> None:
        if last is not None and (old := self.schema(last)).simpleString() != schema.simpleString():
            raise OptionError(f"The rows' columns {schema.simpleString()} differ from the table's {old.simpleString()}")

    def _commit_onto(self, last: Snapshot | None, net: DataFrame, touched: list[int], schema: StructType, parallelism: int | None, batch: tuple[str, int] | None) -> Snapshot:
        """Write the touched buckets of ``last`` with the changes, and commit them as the snapshot after it."""
        id = (last.id if last else 0) + 1
        rows = net.where(F.col("_op") != DELETE).drop("_op")
        if last is not None and touched:
            before = self.rows_of(last, touched)
            rows = before.join(net.select(*self.key, BUCKET), [*self.key, BUCKET], "left_anti").unionByName(rows)
        folder = f"data/{COMMIT}={uuid.uuid4().hex}x"  # never a number to partition inference
        if touched:
            dealt = rows.repartition(parallelism, BUCKET) if parallelism else rows.repartition(BUCKET)
            dealt.select(*schema.names, BUCKET).sortWithinPartitions(BUCKET, *self.key).write.partitionBy(BUCKET).parquet(f"{self.root}/{folder}")
        files = {str(b): [] if b in touched or last is None else last.files[str(b)] for b in range(self.buckets)}
        sizes = {}
        for path, size in self.log.files.walk(folder):
            if path.endswith(".parquet"):
                files[path.split(f"/{BUCKET}=")[1].split("/")[0]].append(path)
                sizes[path] = size
        kept = {f for listed in files.values() for f in listed}
        sizes |= {f: s for f, s in (last.sizes if last else {}).items() if f in kept}
        batches = dict(last.batches) if last else {}
        if batch:
            batches[batch[0]] = batch[1]
        sha = self.schemas.record(id, schema)
        snapshot = Snapshot(id, self.buckets, self.key, sha, files, sizes, None, batches)
        try:
            self.log.commit(snapshot)
        except FileExistsError:
            self.log.files.delete(folder)
            raise
        return snapshot

    def _schema_for(self, changes: DataFrame, seq: list[str], op: str | None, values: list[str]) -> StructType:
        names = [*self.key, *[c for c in changes.columns if c not in self.key and c != op and (c in values or not c.startswith("_"))]]
        for k in self.key:
            if k not in changes.columns:
                raise OptionError(f"Primary key column '{k}' is not among the rows' columns")
            if isinstance(changes.schema[k].dataType, MapType):
                raise OptionError(f"Primary key column '{k}' is a map, which has no equality")
        if len(names) == len(self.key):
            raise OptionError("A table needs at least one column besides its primary key")
        return StructType([StructField(n, changes.schema[n].dataType) for n in names])


def snapshot_diff(table: KeyedTable, old: int, new: int) -> DataFrame:
    """What a reader of ``old`` has to apply to have ``new``: rows with ``_op`` +I, +U or -D."""
    before, after = table.log.load(old), table.log.load(new)
    changed = [b for b in range(table.buckets) if before.files[str(b)] != after.files[str(b)]]  # others are the same files
    values = [c for c in table.schema(after).names if c not in table.key]
    a = table.rows_of(after, changed).select(*table.key, F.struct(*values).alias("_new"))
    b = table.rows_of(before, changed).select(*table.key, F.struct(*values).alias("_old"))
    both = a.join(b, table.key, "full")
    op = F.when(F.col("_old").isNull(), INSERT).when(F.col("_new").isNull(), DELETE).otherwise(UPDATE_AFTER)
    differs = both.where(~F.col("_new").eqNullSafe(F.col("_old")))
    return differs.select(op.alias("_op"), *table.key, F.coalesce("_new", "_old").alias("_row")).select("_op", *table.key, "_row.*")


__all__ = ["BUCKET", "KeyedTable", "SnapshotMissing", "bucket_of", "net_changes", "snapshot_diff"]
