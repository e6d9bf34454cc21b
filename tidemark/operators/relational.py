"""What a host's planner would offer over these tables, as plain frame operations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def keep_first(df: DataFrame, key: list[str], order: str) -> DataFrame:
    """The first row of each key, by an aggregation with map-side combine."""
    rest = [c for c in df.columns if c not in key]
    return df.groupBy(*key).agg(F.min_by(F.struct(*rest), F.col(order)).alias("_r")).select(*key, "_r.*").select(*df.columns)


def keep_last(df: DataFrame, key: list[str], order: str) -> DataFrame:
    rest = [c for c in df.columns if c not in key]
    return df.groupBy(*key).agg(F.max_by(F.struct(*rest), F.col(order)).alias("_r")).select(*key, "_r.*").select(*df.columns)


def top_n(df: DataFrame, key: list[str], order: list[Column], n: int, rank: str = "rn") -> DataFrame:
    """The first ``n`` rows of each key; Spark cuts partitions to n a key before the shuffle."""
    return df.withColumn(rank, F.row_number().over(W.partitionBy(*key).orderBy(*order))).where(F.col(rank) <= n)


def as_of(left: DataFrame, right: DataFrame, key: list[str], time: str, tie: str, columns: dict[str, str]) -> DataFrame:
    """Each left row with the last right row of its key at or before its time.

    Both sides are one union, sorted once per key; no pair is made.  ``columns`` names the right
    columns to take and what to call them; ``tie`` orders right rows of one time.
    """
    taken = F.struct(*[F.col(c).alias(f"_{c}") for c in columns])
    a = left.withColumn("_side", F.lit(1)).withColumn("_r", F.lit(None).cast(right.select(taken.alias("t")).schema["t"].dataType)).withColumn("_tie", F.lit(None).cast(right.schema[tie].dataType))
    b = right.select(*[F.col(c) for c in key], time, F.lit(0).alias("_side"), taken.alias("_r"), F.col(tie).alias("_tie"))
    order = W.partitionBy(*key).orderBy(time, "_side", "_tie").rowsBetween(W.unboundedPreceding, 0)
    joined = a.unionByName(b, allowMissingColumns=True).withColumn("_m", F.last("_r", ignorenulls=True).over(order)).where("_side = 1")
    return joined.select(*left.columns, *[F.col(f"_m._{c}").alias(name) for c, name in columns.items()])


def interval_join(left: DataFrame, right: DataFrame, key: list[str], time: str, before_seconds: int, after_seconds: int, right_time: str) -> DataFrame:
    """Pairs of equal key with the right time from ``before`` seconds before to ``after`` after the left time.

    The right side is dealt into time slots as wide as the interval and the left side looks into
    the few it reaches, so a key with many rows is spread and only near rows are compared.
    """
    width = max(1, before_seconds + after_seconds)
    seconds = lambda c: F.unix_seconds(F.col(c).cast("timestamp"))
    slot = lambda s: F.floor(s / width)
    spans = F.sequence(slot(seconds(time) - before_seconds), slot(seconds(time) + after_seconds))
    a = left.withColumn("_slot", F.explode(spans))
    b = right.withColumn("_slot", slot(seconds(right_time)))
    near = F.expr(f"{right_time} BETWEEN {time} - INTERVAL {before_seconds} SECOND AND {time} + INTERVAL {after_seconds} SECOND")
    return a.join(b, [*key, "_slot"]).where(near).drop("_slot")


def over_running(df: DataFrame, key: list[str], order: list[str], **columns: Column) -> DataFrame:
    """Aggregates from a key's first row to each row."""
    w = W.partitionBy(*key).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    return df.select("*", *[c.over(w).alias(name) for name, c in columns.items()])


def tumbling(df: DataFrame, time: str, size: str, key: list[str], *aggregates: Column) -> DataFrame:
    return df.groupBy(*key, F.window(time, size).alias("w")).agg(*aggregates).withColumn("start", F.col("w.start")).withColumn("end", F.col("w.end")).drop("w")


def sliding(df: DataFrame, time: str, size: str, slide: str, key: list[str], *aggregates: Column) -> DataFrame:
    return df.groupBy(*key, F.window(time, size, slide).alias("w")).agg(*aggregates).withColumn("start", F.col("w.start")).withColumn("end", F.col("w.end")).drop("w")


def window_join(left: DataFrame, right: DataFrame, key: list[str], left_time: str, right_time: str, size: str) -> DataFrame:
    """Rows of equal key in the same tumbling window."""
    a = left.withColumn("_w", F.window(left_time, size)["start"])
    b = right.withColumn("_w", F.window(right_time, size)["start"])
    return a.join(b, [*key, "_w"]).withColumnRenamed("_w", "window_start")
