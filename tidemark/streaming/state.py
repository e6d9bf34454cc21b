"""Keyed state of streams: value, list, map, reducing and aggregating state, timers and time to live.

All are ``StatefulProcessor``s for ``groupBy(key).transformWithState``; they need the
RocksDB state store provider.  A namespace is one more grouping column.  Rows of a key
come unordered within a batch and are sorted by their sequence first.  Time to live
needs ``timeMode='processingTime'``, under which a query never ends by itself.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import ceil
from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import DataType, LongType, StructField, StructType

from ..scratch import materialise

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def configure(spark: SparkSession) -> None:
    """What these processors need of a session: the RocksDB store, and its changelog for :func:`state_changes`."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


def ttl_ms(seconds: float | None) -> int | None:
    """Whole seconds, rounded up, one at least."""
    return None if seconds is None else 1000 * max(1, ceil(seconds))


class _Ordered(StatefulProcessor):
    def __init__(self, seq: str, ttl_seconds: float | None = None):
        self.seq, self.ttl = seq, ttl_ms(ttl_seconds)

    names: list[str] = []  #: of the output columns; run() sets them
    initial: list[str] = []  #: columns that initial state needs beside the key

    def row(self, *values: Any) -> Row:
        return Row(**dict(zip(self.names, values, strict=True)))

    def in_order(self, rows: Iterator[Row]) -> list[Row]:
        return sorted(rows, key=lambda r: r[self.seq])

    def close(self) -> None:
        pass


def _struct(name: str, kind: DataType) -> StructType:
    return StructType([StructField(name, kind, True)])


class ValueFold(_Ordered):
    """A value, folded: ``fold(current or None, row) -> new or None``; None clears.

    ValueState keeps the newest value, ReducingState and AggregatingState a reduced value or an
    accumulator; the three differ in ``fold`` alone.  Emits (key..., value) after each batch;
    a cleared state emits nothing.
    """

    def __init__(self, seq: str, kind: DataType, fold: Callable[[Any, Row], Any], result: Callable[[Any], Any] | None = None, ttl_seconds: float | None = None, name: str = "value"):
        super().__init__(seq, ttl_seconds)
        self.kind, self.fold, self.result, self.name = kind, fold, result or (lambda x: x), name

    initial = ["value"]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState(self.name, _struct("value", self.kind), self.ttl)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self.state.update((initialState["value"],))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        now = self.state.get()[0] if self.state.exists() else None
        for row in self.in_order(rows):
            now = self.fold(now, row)
        if now is None:
            self.state.clear()
        else:
            self.state.update((now,))
            yield self.row(*key, self.result(now))


def newest(column: str) -> Callable[[Any, Row], Any]:
    return lambda now, row: row[column]


def reducing(column: str, reduce: Callable[[Any, Any], Any]) -> Callable[[Any, Row], Any]:
    """The first value as it is; adding null clears."""
    return lambda now, row: None if row[column] is None else row[column] if now is None else reduce(now, row[column])


def aggregating(column: str, create: Callable[[], Any], add: Callable[[Any, Any], Any]) -> Callable[[Any, Row], Any]:
    """Adding null clears, as does an add that returns None."""
    return lambda now, row: None if row[column] is None else add(create() if now is None else now, row[column])


class ListAppend(_Ordered):
    """A list that grows: blind appends, never read back here.  Emits (key..., values added).

    Initial state is one row per element, in the order of ``pos`` (:func:`with_positions`).
    """

    initial = ["pos", "value"]
    moved: tuple = (None, [])  #: key and (pos, value)s of the initial state that is being taken in

    def __init__(self, seq: str, column: str, kind: DataType, ttl_seconds: float | None = None, name: str = "list"):
        super().__init__(seq, ttl_seconds)
        self.column, self.kind, self.name = column, kind, name

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getListState(self.name, _struct("value", self.kind), self.ttl)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        if initialState["value"] is None:
            raise ValueError("A list state can't hold null")
        if self.moved[0] != key:
            self.moved = (key, [])
        have, entry = self.moved[1], (initialState["pos"], initialState["value"])
        in_order = not have or have[-1][0] <= entry[0]
        have.append(entry)
        if in_order:
            self.state.appendValue((entry[1],))
        else:
            have.sort(key=lambda e: e[0])
            self.state.put([(v,) for _, v in have])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        added = [(r[self.column],) for r in self.in_order(rows)]
        if any(v is None for (v,) in added):
            raise ValueError("A list state can't hold null")
        if added:
            self.state.appendList(added)
        yield self.row(*key, len(added))


class MapPut(_Ordered):
    """A map from ``map_key`` to ``column``; null values are present, ``removed`` rows drop their entry.

    Emits (key..., entries touched).  Initial state is one row per entry, as ``state_table`` exports it.
    """

    initial = ["map_key", "map_value"]

    def __init__(self, seq: str, map_key: str, column: str, key_kind: DataType, kind: DataType, removed: str | None = None, ttl_seconds: float | None = None, name: str = "map"):
        super().__init__(seq, ttl_seconds)
        self.map_key, self.column, self.key_kind, self.kind, self.removed, self.name = map_key, column, key_kind, kind, removed, name

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getMapState(self.name, _struct("map_key", self.key_kind), _struct("value", self.kind), self.ttl)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        if initialState["map_key"] is None:
            raise ValueError("A map state's key can't be null")
        self.state.updateValue((initialState["map_key"],), (initialState["map_value"],))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        last: dict[Any, Row] = {}
        for r in self.in_order(rows):
            if r[self.map_key] is None:
                raise ValueError("A map state's key can't be null")
            last[r[self.map_key]] = r
        for k, r in last.items():
            if self.removed and r[self.removed]:
                if self.state.containsKey((k,)):
                    self.state.removeKey((k,))
            else:
                self.state.updateValue((k,), (r[self.column],))
        yield self.row(*key, len(last))


class Timers(_Ordered):
    """Registers a timer at ``time`` (milliseconds) of each row, emits (key..., fired at) when it is due.

    The same time registers once.  Rows with a true ``cancel`` delete the timer of their time.
    Initial state is one row per timer, as :func:`timer_entries` makes them.
    """

    initial = ["timestamp_ms"]

    def __init__(self, seq: str, time: str, cancel: str | None = None):
        super().__init__(seq)
        self.time, self.cancel = time, cancel

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.count = handle.getValueState("registered", _struct("value", LongType()))

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self.handle.registerTimer(int(initialState["timestamp_ms"]))
        self.count.update(((self.count.get()[0] if self.count.exists() else 0) + 1,))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        have = set(self.handle.listTimers())
        for r in self.in_order(rows):
            at = int(r[self.time])
            if self.cancel and r[self.cancel]:
                if at in have:
                    self.handle.deleteTimer(at)
                    have.discard(at)
            elif at not in have:
                self.handle.registerTimer(at)
                have.add(at)
        self.count.update((len(have),))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        yield self.row(*key, expiredTimerInfo.getExpiryTimeInMs())


def run(
    rows: DataFrame,
    key: list[str],
    processor: StatefulProcessor,
    output: StructType | str,
    time_mode: str = "none",
    output_mode: str = "Update",
    initial: DataFrame | None = None,
) -> DataFrame:
    """The processor over a stream (or a frame, as one batch)."""
    output = StructType.fromDDL(output) if isinstance(output, str) else output
    if isinstance(processor, _Ordered):
        processor.names = output.names
    if initial is not None:
        if type(processor).handleInitialState is StatefulProcessor.handleInitialState:
            raise ValueError(f"{type(processor).__name__} takes no initial state")
        lacking = [c for c in getattr(processor, "initial", []) if c not in initial.columns]
        if lacking:
            raise ValueError(f"Initial state of {type(processor).__name__} lacks the columns {lacking}")
    grouped = rows.groupBy(*key)
    return grouped.transformWithState(processor, output, output_mode, time_mode, None if initial is None else initial.groupBy(*key))


def with_positions(rows: DataFrame) -> DataFrame:
    """A list state's export, one row per element in the reader's order, with that order as ``pos``."""
    from pyspark.sql import functions as F

    return materialise(rows.withColumn("pos", F.monotonically_increasing_id()), "list")  # a stream's plan can't number rows


def timer_entries(timers: DataFrame) -> DataFrame:
    """Rows of ``read_timers`` as initial state: the key's fields and ``timestamp_ms``."""
    return timers.select("state_key.*", "timestamp_ms")


def validated_initial(rows: DataFrame, key: list[str], schema: StructType, entry: str | None = None) -> DataFrame:
    """State to start from, checked as a whole before anything is written: exact columns, whole unique keys.

    ``entry`` names the column that tells the entries of a key apart: a list's ``pos``, ``map_key``, ``timestamp_ms``.
    """
    key = key if entry is None else [*key, entry]
    if [(f.name, f.dataType) for f in rows.schema] != [(f.name, f.dataType) for f in schema]:
        raise ValueError(f"Initial state has columns {rows.schema.simpleString()}, not {schema.simpleString()}")
    from functools import reduce

    from pyspark.sql import functions as F

    nulls = rows.where(reduce(lambda a, b: a | b, (F.col(k).isNull() for k in key))).limit(1).count()
    if nulls:
        raise ValueError(f"Initial state has a null in its key {key}")
    if rows.groupBy(*key).count().where("count > 1").limit(1).count():
        raise ValueError(f"Initial state has a key {key} twice")
    return rows
