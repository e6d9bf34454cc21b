"""Scans of a table: buckets, key prefixes, key ranges, columns by ordinal, pages."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.typed import parse_value
from ..options import OptionError
from ..sources.table import BUCKET, KeyedTable, bucket_of

DEFAULT_LIMIT, MAX_LIMIT = 100, 1000


def key_prefix(table: KeyedTable, schema, fields: dict[str, str]) -> Column:
    """Exact on all given key fields but the last, a prefix of the last one's text; no gaps, in key order."""
    if unknown := [f for f in fields if f not in table.key]:
        raise OptionError(f"{unknown} are not key columns; they are {table.key}")
    given = [k for k in table.key if k in fields]
    if given != table.key[: len(given)]:
        raise OptionError(f"Key filters have to start at '{table.key[0]}' and leave no gap")
    *exact, last = given
    tests = [F.col(k) == F.lit(parse_value(fields[k], schema[k].dataType)) for k in exact]
    return reduce(lambda a, b: a & b, [*tests, F.col(last).cast("string").startswith(fields[last])])


def whole_key(table: KeyedTable, schema, fields: dict[str, object]) -> Column:
    """Equality on the whole key, with its bucket: only that bucket's files are read."""
    if set(fields) != set(table.key):
        raise OptionError(f"The whole primary key {table.key} is needed")
    typed = {k: F.lit(fields[k]).cast(schema[k].dataType) for k in table.key}
    equal = reduce(lambda a, b: a & b, (F.col(k) == typed[k] for k in table.key))
    return equal & (F.col(BUCKET) == bucket_of([typed[k] for k in table.key], table.buckets))


def key_range(column: str, low: object = None, high: object = None) -> Column:
    """``low <= column < high``; an open end is None.  Sorted files are skipped by their statistics."""
    c = F.col(column)
    parts = ([c >= F.lit(low)] if low is not None else []) + ([c < F.lit(high)] if high is not None else [])
    return reduce(lambda a, b: a & b, parts, F.lit(True))


def upper_bound(prefix: bytes) -> bytes | None:
    """The least byte string above all that start with ``prefix``; None if there is none."""
    trimmed = prefix.rstrip(b"\xff")
    return trimmed[:-1] + bytes([trimmed[-1] + 1]) if trimmed else None


def byte_prefix(column: str, prefix: bytes) -> Column:
    """A binary column's values with a prefix, as a range."""
    return key_range(column, bytearray(prefix), None if (high := upper_bound(prefix)) is None else bytearray(high))


@dataclass(frozen=True)
class Page:
    """Rows in key order within buckets, and where the next page starts: None after the last."""

    rows: DataFrame
    order: list[str]


def scan(
    table: KeyedTable,
    snapshot: int | None = None,
    bucket: int | None = None,
    prefix: dict[str, str] | None = None,
    where: Column | None = None,
    columns: list[int] | None = None,
) -> DataFrame:
    """Rows of a snapshot with ``_bucket``, filtered before anything is cut off.

    ``columns`` are ordinals among the columns that aren't the key; the key stays.
    """
    state = table.log.load(snapshot)
    schema = table.schema(state)
    if bucket is not None and not 0 <= bucket < table.buckets:
        raise OptionError(f"Bucket {bucket} is not within 0 to {table.buckets - 1}")
    if prefix and where is not None:
        raise OptionError("Give a key prefix or a range, not both")
    rows = table.rows_of(state)
    if bucket is not None:
        rows = rows.where(F.col(BUCKET) == bucket)
    if prefix:
        rows = rows.where(key_prefix(table, schema, prefix))
    if where is not None:
        rows = rows.where(where)
    values = [c for c in schema.names if c not in table.key]
    if columns is not None:
        if wrong := [i for i in columns if not 0 <= i < len(values)]:
            raise OptionError(f"No value columns {wrong}; there are {len(values)}")
        values = [values[i] for i in columns]
    return rows.select(BUCKET, *table.key, *values)


def page(table: KeyedTable, limit: int = DEFAULT_LIMIT, start_bucket: int = 0, start_after: dict[str, object] | None = None, prefix: dict[str, str] | None = None, **scan_options) -> DataFrame:
    """One page in the order of bucket and key, and one row more if there is a further page.

    Each page is a top-k over what its keyset bound leaves; nothing is skipped by counting.
    """
    if not 0 < limit <= MAX_LIMIT:
        raise OptionError(f"A limit is from 1 to {MAX_LIMIT}, not {limit}")
    if start_after is not None:
        if set(start_after) != set(table.key):
            raise OptionError(f"'start_after' needs the whole primary key {table.key}")
        if prefix:
            for k, text in list(prefix.items()):
                own = str(start_after[k])
                if not own.startswith(text):
                    raise OptionError("'start_after' lies outside the prefix")
    rows = scan(table, prefix=prefix, **scan_options)
    bound = F.col(BUCKET) >= start_bucket
    if start_after is not None:
        after = F.struct(F.lit(start_bucket).alias(BUCKET), *[F.lit(start_after[k]).cast(rows.schema[k].dataType).alias(k) for k in table.key])
        bound = bound & (F.struct(BUCKET, *table.key) > after)
    return rows.where(bound).orderBy(BUCKET, *table.key).limit(limit + 1)


def read_page(table: KeyedTable, limit: int = DEFAULT_LIMIT, **options) -> tuple[list[dict], dict | None]:
    """The rows of one page, and the options that continue after it, None at the end."""
    found = [r.asDict(recursive=True) for r in page(table, limit, **options).collect()]  # at most MAX_LIMIT + 1
    if len(found) <= limit:
        return found, None
    last = found[limit - 1]
    return found[:limit], {"start_bucket": last[BUCKET], "start_after": {k: last[k] for k in table.key}}
