"""Keyed state as folds over a frame: what a stream's state would hold after all rows.

Each fold takes the rows' key columns (a namespace is one more of them, nulls
included), a sequence that orders the rows of a key, and gives one row per key or
entry.  Folds that keep only a last or first value are aggregations with map-side
combine.  Ordered folds gather one key's rows in an array, sort it by the sequence
and fold it in the JVM; a key's history then has to fit a task, so use them where
the fold is truly order-sensitive, as a merge of namespaces is.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

Fold = Callable[[Column, Column], Column]


def _kind_of(df: DataFrame, c: Column) -> DataType:
    """Type of a column, with nulls allowed in its fields, as a fold's accumulator needs it."""
    return _nullable(df.select(c.alias("c")).schema["c"].dataType)


def _nullable(kind: DataType) -> DataType:
    if isinstance(kind, StructType):
        return StructType([StructField(f.name, _nullable(f.dataType)) for f in kind])
    return kind


def value_state(df: DataFrame, key: list[str], seq: str, value: Column, default: Column | None = None) -> DataFrame:
    """The last value; updating to null clears, and a cleared value reads as the default or is absent."""
    last = df.groupBy(*key).agg(F.max_by(F.struct(value.alias("v")), F.col(seq)).alias("s"))
    read = last.select(*key, F.col("s.v").alias("value"))
    return read.where(F.col("value").isNotNull()) if default is None else read.withColumn("value", F.coalesce("value", default))


def list_state(df: DataFrame, key: list[str], seq: str, value: Column) -> DataFrame:
    """All values in order of arrival; adding null is an error, no values means absent."""
    checked = F.when(value.isNotNull(), value).otherwise(F.raise_error(F.lit("A list state can't hold null")))
    rows = df.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct(F.col(seq).alias("s"), checked.alias("v")))).alias("l"))
    return rows.select(*key, F.transform("l", lambda x: x["v"]).alias("values"))


def merge_lists(df: DataFrame, key: list[str], namespace: str, sources: list, target: object, values: str = "values") -> DataFrame:
    """Lists of the source namespaces appended to the target's in the given order; the sources go.

    A source named twice, or the target among the sources, counts once, the target first.
    """
    order = list(dict.fromkeys([target, *[s for s in sources if s is not None]]))
    rank = F.array_position(F.array(*map(F.lit, order)), F.col(namespace))
    inside = df.where(F.col(namespace).isin(order))
    merged = inside.groupBy(*key).agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct(rank.alias("r"), F.col(values).alias("v")))), lambda x: x["v"])).alias(values))
    outside = df.where(~F.col(namespace).isin(order) | F.col(namespace).isNull())
    return outside.select(*key, namespace, values).unionByName(merged.withColumn(namespace, F.lit(target)).select(*key, namespace, values))


def map_state(df: DataFrame, key: list[str], seq: str, map_key: str, value: Column, removed: Column | None = None) -> DataFrame:
    """The last value of each map key, one row each; a null value is present, a removed key is absent."""
    gone = removed if removed is not None else F.lit(False)
    checked = F.when(F.col(map_key).isNotNull(), F.col(map_key)).otherwise(F.raise_error(F.lit("A map state's key can't be null")))
    rows = df.select(*key, checked.alias(map_key), F.col(seq).alias("_s"), value.alias("_v"), gone.alias("_gone"))
    last = rows.groupBy(*key, map_key).agg(F.max_by(F.struct("_v", "_gone"), F.col("_s")).alias("l"))
    return last.where(~F.col("l._gone")).select(*key, map_key, F.col("l._v").alias("value"))


def map_entries(states: DataFrame, key: list[str], map_key: str, value: str = "value") -> DataFrame:
    """Map states as one map per key, its entries in key order."""
    entries = F.array_sort(F.collect_list(F.struct(F.col(map_key).alias("key"), F.col(value).alias("value"))))
    return states.groupBy(*key).agg(F.map_from_entries(entries).alias("entries"))


def reducing_state(df: DataFrame, key: list[str], seq: str, value: Column, reduce: Fold) -> DataFrame:
    """``reduce(current, value)`` in order; the first value is stored as it is, adding null clears."""
    rows = df.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct(F.col(seq).alias("s"), value.alias("v")))).alias("l"))
    kind = _kind_of(df, value)
    step = lambda a, x: F.when(x["v"].isNull(), F.lit(None).cast(kind)).when(a.isNull(), x["v"]).otherwise(reduce(a, x["v"]).cast(kind))
    folded = rows.select(*key, F.aggregate("l", F.lit(None).cast(kind), step).alias("value"))
    return folded.where(F.col("value").isNotNull())


def aggregating_state(df: DataFrame, key: list[str], seq: str, value: Column, zero: Column, add: Fold, result: Callable[[Column], Column]) -> DataFrame:
    """The accumulator of ``add`` from ``zero``, and its result; adding null or an add to null clears."""
    rows = df.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct(F.col(seq).alias("s"), value.alias("v")))).alias("l"))
    kind = _kind_of(df, zero)
    step = lambda a, x: F.when(x["v"].isNull(), F.lit(None).cast(kind)).otherwise(add(F.coalesce(a, zero.cast(kind)), x["v"]).cast(kind))
    folded = rows.select(*key, F.aggregate("l", F.lit(None).cast(kind), step).alias("accumulator"))
    return folded.where(F.col("accumulator").isNotNull()).withColumn("result", result(F.col("accumulator")))


def merge_namespaces(df: DataFrame, key: list[str], namespace: str, sources: list, target: object, merge: Fold, value: str = "value") -> DataFrame:
    """Fold the sources' values in the given order, then merge the fold into the target's value.

    Null and repeated sources are ignored, as are absent values.  A target among the sources
    is used up there, once, and not merged with itself again.  A merge to null starts anew
    with the next source; null at the end leaves an untouched target and drops one that was
    among the sources.  Sources go; with nothing contributed, nothing changes.
    """
    order = list(dict.fromkeys(s for s in sources if s is not None))
    kind = df.schema[value].dataType
    rank = F.array_position(F.array(*map(F.lit, order)), F.col(namespace)) if order else F.lit(0)
    inside = df.where(F.col(namespace).isin([*order, target]))
    listed = inside.groupBy(*key).agg(
        F.array_sort(F.collect_list(F.when((rank > 0) & F.col(value).isNotNull(), F.struct(rank.alias("r"), F.col(value).alias("v"))))).alias("l"),
        F.max(F.when(F.col(namespace) == F.lit(target), F.struct(F.col(value).alias("v")))).alias("t"),
    )
    nothing = F.lit(None).cast(kind)
    step = lambda a, x: F.when(a.isNull(), x["v"]).otherwise(merge(a, x["v"]).cast(kind))
    folded = listed.withColumn("f", F.aggregate("l", nothing, step))
    own = F.col("t.v")
    kept = own if target not in order else nothing
    merged = F.when(F.col("f").isNull(), kept).when(kept.isNull(), F.col("f")).otherwise(merge(kept, F.col("f")).cast(kind))
    untouched = F.when(F.size("l") == 0, own).otherwise(merged)
    after = folded.select(*key, F.lit(target).cast(df.schema[namespace].dataType).alias(namespace), untouched.alias(value)).where(F.col(value).isNotNull())
    others = df.where(~F.col(namespace).isin([*order, target]) | F.col(namespace).isNull())
    return others.select(*key, namespace, value).unionByName(after)


def clear_namespace(df: DataFrame, namespace: str, value: object) -> DataFrame:
    """State without one namespace; None is a namespace like any other."""
    return df.where(~F.col(namespace).eqNullSafe(F.lit(value)))


def unexpired(df: DataFrame, written: str, ttl_seconds: float, now: Column) -> DataFrame:
    """Entries not older than the time to live, in whole seconds rounded up, one at least."""
    from math import ceil

    ttl = max(1, ceil(ttl_seconds))
    return df.where(F.col(written) + F.make_dt_interval(secs=F.lit(ttl)) > now)


def fired_timers(timers: DataFrame, key: list[str], at: str, watermark: Column, deleted: DataFrame | None = None) -> DataFrame:
    """Timers up to the watermark in the order they fire; the same timer fires once, a deleted one never."""
    due = timers.select(*key, at).distinct().where(F.col(at) <= watermark)
    if deleted is not None:
        due = due.join(deleted.select(*key, at).distinct(), [*key, at], "left_anti")
    return due.withColumn("nth", F.row_number().over(W.partitionBy(*key).orderBy(at)))


def sessions(df: DataFrame, key: list[str], time: str, gap: str, *aggregates: Column) -> DataFrame:
    """Merged windows: rows of a key not further apart than the gap."""
    merged = df.groupBy(*key, F.session_window(time, gap).alias("w")).agg(*aggregates)
    return merged.select(*key, F.col("w.start").alias("start"), F.col("w.end").alias("end"), *[c for c in merged.columns if c not in (*key, "w")])
