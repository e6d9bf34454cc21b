"""What the operators of this package share: reading tables, scratch tables, text classes."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import materialise

#: The white space of all contracts here: space and the ASCII controls 09 to 0D.
SPACES = " \t\n\x0b\f\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the test data, through Spark's reader so that any store works."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    """A-Z lower-cased and nothing else; the cheap built-in where the text is all ASCII."""
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def whole(c: str | Column) -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def text_hash(c: Column) -> Column:
    """64 bits that tell apart rows which share an id but not a text."""
    return F.xxhash64(F.lit(11), c)


def small_batches(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches: a worker then holds few texts as Python strings at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


#: Bytes of input for a task, and the fewest tasks, where a step has more partitions than its input needs.
TASK_BYTES, TASKS = 2 << 20, 12


def few_tasks(df: DataFrame, source: DataFrame) -> DataFrame:
    """``df`` in as many tasks, and so files, as the size of ``source`` needs, if it has more.

    A local file that Spark writes starts three processes (``chmod``), each with the writer's memory until it
    runs its program: hundreds of files with a few rows cost more than their rows. The size is the
    plan's estimate; where nothing is known it is huge, and ``df`` stays as it is.
    """
    size = int(str(source._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.coalesce(max(TASKS, min(size // TASK_BYTES, 1 << 30)))


__all__ = ["LOWER", "SPACES", "SPACE_RUN", "UPPER", "WORD", "ascii_lower", "few_tasks", "materialise", "small_batches", "table", "text_hash", "whole"]
