"""Lookup joins against a table's snapshots, and point gets."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType

from ..options import OptionError
from ..sources.snapshots import Snapshot
from ..sources.table import BUCKET, KeyedTable, bucket_of

#: A snapshot whose files have at most so many bytes, and whose rows, decoded, at most so many, is sent to
#: all executors; a larger one is shuffled.
BROADCAST_BYTES = 8 << 20
BROADCAST_DECODED = 64 << 20


class Lookup:
    """The lookup side of a join.

    ``snapshot`` pins an id; without it, ``refresh=False`` pins the first snapshot seen and
    ``refresh=True`` takes the newest at each call, which a stream makes once a batch.  With
    no snapshot yet, nothing matches.
    """

    def __init__(self, table: KeyedTable, snapshot: int | None = None, refresh: bool = False):
        self.table, self.refresh = table, refresh
        self.pinned: Snapshot | None = table.log.load(snapshot) if snapshot else None
        self._measured: tuple | None = None  # (snapshot's id, columns) last measured, and the bytes

    def current(self) -> Snapshot | None:
        if self.pinned is not None:
            return self.pinned
        found = self.table.log.latest()
        if not self.refresh:
            self.pinned = found
        return found

    def join(self, probe: DataFrame, on: dict[str, str], columns: list[str] | None = None, how: str = "left", strict_keys: bool = False) -> DataFrame:
        """``probe`` with the row of equal primary key: ``on`` names the probe's column for each key column.

        At most one row matches.  ``how`` is ``left`` (a miss gives nulls) or ``inner``.  A null key
        matches nothing, as in SQL; with ``strict_keys`` it is an error.
        """
        if how not in ("left", "inner"):
            raise OptionError(f"A lookup join is 'left' or 'inner', not '{how}'")
        if set(on) != set(self.table.key):
            raise OptionError(f"A lookup join needs the whole primary key {self.table.key}, not {sorted(on)}")
        if missing := [c for c in on.values() if c not in probe.columns]:
            raise OptionError(f"Lookup keys have to be top-level columns; there is no {missing}")
        if strict_keys:
            whole = reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in on.values()))
            probe = probe.where(F.when(whole, F.lit(True)).otherwise(F.raise_error(F.lit("Lookup key must not be null")).cast("boolean")))
        snapshot = self.current()
        if snapshot is None:
            raise_to = [F.lit(None).cast("string").alias(c) for c in columns or []]
            return probe.select("*", *raise_to) if how == "left" else probe.select("*", *raise_to).limit(0)
        schema = self.table.schema(snapshot)
        columns = columns if columns is not None else [c for c in schema.names if c not in self.table.key]
        dim = self.table.rows_of(snapshot).select(*[F.col(k).alias(f"_lookup_{k}") for k in self.table.key], *[F.col(c).alias(f"_value_{c}") for c in columns])
        if snapshot.bytes <= BROADCAST_BYTES and self._decoded(snapshot, dim) <= BROADCAST_DECODED:
            dim = F.broadcast(dim)
        equal = reduce(lambda a, b: a & b, (probe[on[k]] == dim[f"_lookup_{k}"] for k in self.table.key))
        joined = probe.join(dim, equal, how)
        return joined.select(*[probe[c] for c in probe.columns], *[F.col(f"_value_{c}").alias(c) for c in columns])

    def _decoded(self, snapshot: Snapshot, dim: DataFrame) -> int:
        """Bytes of the rows outside of their files, which may hold a repeated value once; one job a snapshot."""
        at = (snapshot.id, tuple(dim.columns))
        if self._measured is None or self._measured[0] != at:
            wide = [f.name for f in dim.schema if isinstance(f.dataType, (StringType, BinaryType, ArrayType, MapType, StructType))]
            row = F.lit(16 * len(dim.columns)).cast("long")
            for name in wide:
                row += F.coalesce(F.octet_length(F.col(name).cast("string")), F.lit(0))
            self._measured = (at, dim.agg(F.sum(row)).first()[0] or 0)
        return self._measured[1]

    def in_batches(self, on: dict[str, str], sink: Callable[[DataFrame, int], None], **join) -> Callable[[DataFrame, int], None]:
        """For ``foreachBatch``: each batch is joined with the snapshot of its time."""
        return lambda batch, id: sink(self.join(batch, on, **join), id)


def multi_get(table: KeyedTable, keys: DataFrame, snapshot: int | None = None) -> DataFrame:
    """One row per row of ``keys``, whose columns are the primary key: its values, or nulls where there is none.

    Keys are cut to buckets first, so only the buckets they fall into are read when they are few.
    """
    state = table.log.load(snapshot)
    schema = table.schema(state)
    typed = keys.select(*[F.col(k).cast(schema[k].dataType) for k in table.key])
    hit = sorted(r[0] for r in typed.select(bucket_of([F.col(k) for k in table.key], table.buckets).alias(BUCKET)).distinct().collect())
    rows = table.rows_of(state, hit).drop(BUCKET).withColumn("found", F.lit(True))
    return typed.join(rows, table.key, "left").withColumn("found", F.coalesce("found", F.lit(False)))


def track(table: KeyedTable, keys: DataFrame, snapshots: list[int]) -> DataFrame:
    """The same keys over several snapshots: :func:`multi_get` with a column ``snapshot``."""
    parts = [multi_get(table, keys, s).withColumn("snapshot", F.lit(s).cast("long")) for s in snapshots]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
