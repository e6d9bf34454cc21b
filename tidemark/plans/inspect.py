"""An inspector over keyed tables and streaming checkpoints.

``Inspector.open`` finds out what lies under a path and follows the newest readable
snapshot or batch, or a given one.  Its targets are the table's schema, or the states
and timers of the checkpoint's operators.  Scans and lookups give frames; rows whose
schema can't be read come as bytes.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from ..functions.typed import SAFE_LONG, TypeProblem, display, guarded_long, parse_value
from ..operators.lookup import multi_get, track
from ..operators.scan import read_page, scan
from ..options import OptionError, TableOptions, normalised_path
from ..sources.kind import TABLE, detect_kind
from ..sources.snapshots import SnapshotLog
from ..sources.state_table import partition_of, read_state, read_timers, state_catalog
from ..sources.table import KeyedTable


@dataclass(frozen=True)
class Target:
    """Something that can be scanned: ``table``, a state's name or ``timer:<name>``."""

    id: str
    kind: str
    operator: int | None = None
    ttl: bool = False
    partitions: int = 1


@dataclass
class Inspector:
    spark: SparkSession
    root: str
    kind: str
    snapshot: int | None = None  #: None follows the newest
    reading: int | None = None
    problems: list[str] = field(default_factory=list)

    @staticmethod
    def open(spark: SparkSession, path: str, snapshot: int | None = None) -> Inspector:
        root = normalised_path(path)
        inspector = Inspector(spark, root, detect_kind(spark, root), snapshot)
        inspector.refresh()
        return inspector

    def refresh(self) -> int | None:
        """Move to the newest snapshot or batch that can be read; stay where none newer can."""
        self.problems = []
        candidates = [self.snapshot] if self.snapshot is not None else [s["id"] for s in self.snapshots()]
        for id in candidates:
            if self.reading is not None and self.snapshot is None and id <= self.reading:
                break
            try:
                if self.kind == TABLE:
                    SnapshotLog(self.spark, self.root).load(id)
                elif id not in [s["id"] for s in self.snapshots()]:
                    raise LookupError(f"No batch {id}")
                self.reading = id
                return id
            except Exception as e:  # an unreadable snapshot is skipped, and said
                self.problems.append(f"{id}: {e}")
        if self.reading is None:
            raise LookupError(f"Nothing readable under {self.root}: {'; '.join(self.problems) or 'no snapshot'}")
        return self.reading

    # -- catalog -----------------------------------------------------------------

    def health(self) -> dict:
        return {"status": "ok", "reading": self.reading}

    def snapshots(self) -> list[dict]:
        """Newest first."""
        if self.kind == TABLE:
            return [{"id": i} for i in SnapshotLog(self.spark, self.root).ids()]
        states = state_catalog(self.spark, self.root)
        low, high = min((s["min_batch"] for s in states), default=0), max((s["max_batch"] for s in states), default=-1)
        return [{"id": b} for b in range(high, low - 1, -1)]

    def meta(self) -> dict:
        own = {"path": self.root, "kind": self.kind, "reading": self.reading, "follows_latest": self.snapshot is None, "targets": [t.__dict__ for t in self.targets()]}
        if self.kind == TABLE:
            state = SnapshotLog(self.spark, self.root).load(self.reading)
            status, schema = self._table().schemas.resolve(self.reading)
            own |= {"buckets": state.buckets, "primary_key": state.primary_key, "schema_status": status, "schema": schema.simpleString() if schema else None, "bytes": state.bytes}
        return own

    def set_snapshot(self, snapshot: int | None) -> int | None:
        """Pin a snapshot, or follow the newest with None."""
        self.snapshot, self.reading = snapshot, None
        return self.refresh()

    def targets(self) -> list[Target]:
        """A table's rows; or states in order, then timers, then what has no schema."""
        if self.kind == TABLE:
            return [Target("table", "TABLE")]
        states = state_catalog(self.spark, self.root)
        order = {"TIMER": 1, "RAW": 2}
        found = [Target(f"timer:{s['name'].strip('$')}" if s["kind"] == "TIMER" else s["name"], s["kind"], s["operator_id"], s["ttl"], s["partitions"]) for s in states]
        return sorted(found, key=lambda t: order.get(t.kind, 0))

    def target(self, id: str | None = None) -> Target:
        found = self.targets()
        for t in found:
            if id is None or t.id == id:
                return t
        raise OptionError(f"No target '{id}'; there are {[t.id for t in found]}")

    def _table(self) -> KeyedTable:
        return KeyedTable.open(self.spark, TableOptions.of(path=self.root))

    # -- reading -----------------------------------------------------------------

    def rows(self, target: str | None = None, key: dict[str, str] | None = None, map_key: str | None = None, timer_prefix: str | None = None, **table_options) -> DataFrame:
        """All rows of a target that the filters leave.

        ``key`` gives a table's key prefix, or a state's key fields, as text.  ``map_key`` is for maps
        alone; ``timer_prefix`` matches the text of a timer's key or time.
        """
        t = self.target(target)
        if t.kind == "TABLE":
            return scan(self._table(), self.reading, prefix=key, **table_options)
        if t.kind == "TIMER":
            rows = read_timers(self.spark, self.root, t.operator, self.reading)
            if timer_prefix is not None:
                texts = [F.col("timestamp_ms"), *[F.col(f"state_key.`{n}`") for n in rows.schema["state_key"].dataType.names]]
                rows = rows.where(reduce(lambda a, b: a | b, (F.coalesce(c.cast("string").startswith(timer_prefix), F.lit(False)) for c in texts)))
            return rows
        rows = read_state(self.spark, self.root, t.id, None, t.operator, self.reading)
        if key:
            kind = rows.schema["state_key"].dataType
            rows = rows.where(_fields_equal("state_key", kind, key))
            if set(key) == set(kind.names):  # a whole key is in one partition
                own = [F.lit(parse_value(key[f.name], f.dataType)).cast(f.dataType) for f in kind]
                rows = rows.where(F.col("partition_id") == partition_of(own, t.partitions))
        if map_key is not None:
            if t.kind != "MAP":
                raise OptionError(f"'{t.id}' is not a map")
            inner = rows.schema["map_key"].dataType
            rows = rows.where(_fields_equal("map_key", inner, {inner.names[0]: map_key}))
        return rows

    def page(self, limit: int = 100, **options) -> tuple[list[dict], dict | None]:
        """Rows of a table, shown as text, with what continues after them."""
        table = self._table()
        rows, further = read_page(table, limit, snapshot=self.reading, **options)
        return rows, further

    def lookup(self, keys: DataFrame) -> DataFrame:
        """The table's rows of the given primary keys; a miss has ``found`` false."""
        return multi_get(self._table(), keys, self.reading)

    def track(self, keys: DataFrame, snapshots: list[int]) -> DataFrame:
        return track(self._table(), keys, snapshots)


def _fields_equal(column: str, kind: StructType, wanted: dict[str, str]) -> Column:
    """Struct fields equal to texts; fields from the first on, without gaps; booleans in any case."""
    names = kind.names
    if unknown := [f for f in wanted if f not in names]:
        raise OptionError(f"{unknown} are not among {names}")
    given = [n for n in names if n in wanted]
    if given != names[: len(given)]:
        raise OptionError(f"Filters have to start at '{names[0]}' and leave no gap")
    test = F.lit(True)
    for n in given:
        test = test & F.col(f"{column}.{n}").eqNullSafe(F.lit(parse_value(wanted[n], kind[n].dataType)))
    return test


def shown(rows: DataFrame) -> DataFrame:
    """Every column as display text."""
    return rows.select(*[display(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in rows.schema])


def as_json(rows: DataFrame) -> DataFrame:
    """One JSON object per row, with longs beyond ``2**53 - 1`` as strings."""
    parts = []
    for f in rows.schema:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, LongType):
            text = guarded_long(c)
        else:  # to_json of a one-field object without its braces and name
            whole = F.to_json(F.struct(c.alias("x")), {"ignoreNullFields": "false"})
            text = F.substring(whole, F.lit(6), F.char_length(whole) - 6)
        parts.append(F.concat(F.lit(json.dumps(f.name) + ":"), F.coalesce(text, F.lit("null"))))
    return rows.select(F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}")).alias("json"))


__all__ = ["SAFE_LONG", "Inspector", "Target", "TypeProblem", "as_json", "shown"]
