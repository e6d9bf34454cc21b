"""A stream's checkpoint as tables: its operators, its state variables, their rows."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..options import OptionError, TableOptions

KINDS = {"ValueState": "VALUE", "ListState": "LIST", "MapState": "MAP", "TimerState": "TIMER"}


def state_catalog(spark: SparkSession, checkpoint: str) -> list[dict]:
    """Every state of every operator: operator, name, kind, whether it has a time to live, partitions, batches."""
    found = []
    for r in spark.read.format("state-metadata").load(checkpoint).collect():  # one row per operator and store
        properties = json.loads(r["operatorProperties"]) if r["operatorProperties"] else {}
        variables = properties.get("stateVariables") or []
        common = {"operator_id": r["operatorId"], "operator": r["operatorName"], "partitions": r["numPartitions"], "min_batch": r["minBatchId"], "max_batch": r["maxBatchId"]}
        if not variables:
            found.append(common | {"name": r["stateStoreName"], "kind": "RAW", "ttl": False})
        for v in variables:
            v = json.loads(v) if isinstance(v, str) else v
            name = v["stateName"]
            kind = "TIMER" if name.startswith("$") else KINDS.get(v.get("stateVariableType"), "VALUE")
            found.append(common | {"name": name, "kind": kind, "ttl": bool(v.get("ttlEnabled"))})
    return sorted(found, key=lambda x: (x["operator_id"], x["kind"] == "TIMER", x["name"]))


def pick_state(catalog: list[dict], name: str | None, kind: str | None = None, operator: str | int | None = None) -> dict:
    """The one state that is meant; an error says what there is."""
    if not name:
        raise OptionError("Option 'state.name' is required")
    of_operator = [s for s in catalog if operator is None or str(s["operator_id"]) == str(operator)]
    if not of_operator:
        raise OptionError(f"No operator '{operator}'; there are {sorted({s['operator_id'] for s in catalog})}")
    named = [s for s in of_operator if s["name"] == name and (kind is None or s["kind"] == kind.upper())]
    if not named:
        raise OptionError(f"No state '{name}'{f' of kind {kind}' if kind else ''}; there are {[(s['name'], s['kind']) for s in of_operator]}")
    if len({s["operator_id"] for s in named}) > 1:
        raise OptionError(f"Several operators have a state '{name}'; set 'state.operator-id'")
    return named[0]


def _reader(spark: SparkSession, checkpoint: str, state: dict, batch: int | None):
    reader = spark.read.format("statestore").option("operatorId", state["operator_id"])
    return reader if batch is None else reader.option("batchId", batch)


def read_state(spark: SparkSession, checkpoint: str, name: str, kind: str | None = None, operator: str | int | None = None, batch: int | None = None) -> DataFrame:
    """Typed rows of one state: ``state_key``, then ``value`` | ``value`` per element | ``map_key`` and ``map_value``,
    and ``partition_id``.  Values with a time to live are unwrapped."""
    state = pick_state(state_catalog(spark, checkpoint), name, kind, operator)
    rows = _reader(spark, checkpoint, state, batch).option("stateVarName", name).load(checkpoint)
    plain = lambda c: F.col(f"{c}.value") if state["ttl"] else F.col(c)
    match state["kind"]:
        case "LIST":
            parts = [plain("list_element").alias("value")]
        case "MAP":
            parts = [F.col("user_map_key").alias("map_key"), plain("user_map_value").alias("map_value")]
        case _:
            parts = [plain("value").alias("value")]
    return rows.select(F.col("key").alias("state_key"), *parts, "partition_id")


def read_timers(spark: SparkSession, checkpoint: str, operator: int = 0, batch: int | None = None) -> DataFrame:
    """Registered timers in the order they fire: ``timestamp_ms``, ``state_key``, ``partition_id``."""
    reader = _reader(spark, checkpoint, {"operator_id": operator}, batch).option("readRegisteredTimers", True)
    rows = reader.load(checkpoint)
    return rows.select(F.col("expiration_timestamp_ms").alias("timestamp_ms"), F.col("key").alias("state_key"), "partition_id")


def read_join_side(spark: SparkSession, checkpoint: str, side: str, operator: int = 0, batch: int | None = None) -> DataFrame:
    """Rows that a stream-stream join keeps of its ``left`` or ``right`` input."""
    if side not in ("left", "right"):
        raise OptionError(f"A join has a 'left' and a 'right' side, not '{side}'")
    rows = _reader(spark, checkpoint, {"operator_id": operator}, batch).option("joinSide", side).load(checkpoint)
    return rows.select(F.col("key").alias("state_key"), "value", "partition_id")


def partition_of(key: list[Column], partitions: int) -> Column:
    """The state partition of a whole grouping key."""
    return F.pmod(F.hash(*key), F.lit(partitions)).cast("int")


def state_changes(spark: SparkSession, checkpoint: str, name: str, start: int, end: int | None = None, operator: str | int | None = None) -> DataFrame:
    """What batches ``start`` to ``end`` changed in one state; the query must not run meanwhile, and
    has to have written changelogs (``streaming.state.configure``)."""
    state = pick_state(state_catalog(spark, checkpoint), name, None, operator)
    reader = _reader(spark, checkpoint, state, None).option("stateVarName", name).option("readChangeFeed", True).option("changeStartBatchId", start)
    return (reader if end is None else reader.option("changeEndBatchId", end)).load(checkpoint)


def checked_columns(derived: StructType, declared: StructType, primary_key: list[str] | None = None) -> None:
    """A declaration has to repeat the derived columns in order and type; nullability doesn't count."""
    if primary_key:
        raise OptionError("A state table has no primary key")
    want = [(f.name, f.dataType.simpleString()) for f in derived]
    have = [(f.name, f.dataType.simpleString()) for f in declared]
    if want != have:
        raise OptionError(f"Declared columns {have} differ from the state's {want}")


def state_table(spark: SparkSession, options: TableOptions, declared: StructType | None = None) -> DataFrame:
    """A state as ``options`` name it, with the key's fields as columns before the values."""
    rows = read_state(spark, options.path, options.state_name, options.state_kind, options.state_operator, options.snapshot)
    flat = [F.col(f"state_key.{f.name}").alias(f.name) for f in rows.schema["state_key"].dataType]
    for c in rows.columns[1:-1]:
        kind = rows.schema[c].dataType
        inner = isinstance(kind, StructType) and len(kind) == 1
        flat.append(F.col(f"{c}.{kind.names[0]}").alias(c) if inner else F.col(c))
    out = rows.select(*flat)
    if declared is not None:
        checked_columns(out.schema, declared, list(options.primary_key))
    return out
