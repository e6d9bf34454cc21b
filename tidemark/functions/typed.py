"""Logical types, typed values from text, and values for display."""

from __future__ import annotations

import base64
import datetime as dt
import re
from decimal import Decimal, InvalidOperation

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Longs beyond this don't survive a reader that keeps numbers as doubles.
SAFE_LONG = 2**53 - 1
_SIMPLE = {
    "BOOLEAN": T.BooleanType(), "TINYINT": T.ByteType(), "SMALLINT": T.ShortType(), "INT": T.IntegerType(), "INTEGER": T.IntegerType(), "BIGINT": T.LongType(),
    "FLOAT": T.FloatType(), "DOUBLE": T.DoubleType(), "DOUBLE PRECISION": T.DoubleType(), "STRING": T.StringType(), "BYTES": T.BinaryType(), "DATE": T.DateType(),
    "TIMESTAMP": T.TimestampNTZType(), "TIMESTAMP_LTZ": T.TimestampType(),
}
_RANGES = {T.ByteType: 2**7, T.ShortType: 2**15, T.IntegerType: 2**31, T.LongType: 2**63}


class TypeProblem(ValueError):
    """A type is not supported, or a text is not a value of its type."""


def _split(inner: str) -> list[str]:
    """At top-level commas."""
    parts, depth, now = [], 0, ""
    for c in inner:
        depth += (c in "<(") - (c in ">)")
        if c == "," and depth == 0:
            parts, now = [*parts, now], ""
        else:
            now += c
    return [p.strip() for p in [*parts, now] if p.strip()]


def logical_type(text: str) -> T.DataType:
    """The Spark type of a logical type's serialised form; nullability is left out."""
    said = re.sub(r"\s+NOT NULL$", "", text.strip(), flags=re.I)
    upper = said.upper()
    if upper in _SIMPLE:
        return _SIMPLE[upper]
    if m := re.fullmatch(r"(VAR)?CHAR\s*(?:\((\d+)\))?", upper):
        return T.StringType()
    if re.fullmatch(r"(VAR)?BINARY\s*(?:\(\d+\))?", upper):
        return T.BinaryType()
    if m := re.fullmatch(r"DECIMAL\s*(?:\((\d+)\s*(?:,\s*(\d+))?\))?", upper):
        return T.DecimalType(int(m[1] or 10), int(m[2] or 0))
    if re.fullmatch(r"TIMESTAMP\s*\(\d\)( WITHOUT TIME ZONE)?", upper):
        return T.TimestampNTZType()
    if re.fullmatch(r"TIMESTAMP_LTZ\s*\(\d\)|TIMESTAMP\s*\(\d\) WITH LOCAL TIME ZONE", upper):
        return T.TimestampType()
    if m := re.fullmatch(r"TIME\s*(?:\((\d)\))?", upper):
        return T.TimeType(6)
    if upper.startswith("INTERVAL YEAR"):
        return T.YearMonthIntervalType()
    if upper.startswith("INTERVAL DAY"):
        return T.DayTimeIntervalType()
    if m := re.fullmatch(r"(ARRAY|MULTISET|MAP|ROW)\s*[<(](.*)[>)]", said, flags=re.I | re.S):
        parts = _split(m[2])
        match m[1].upper():
            case "ARRAY" if len(parts) == 1:
                return T.ArrayType(logical_type(parts[0]))
            case "MULTISET" if len(parts) == 1:
                return T.MapType(logical_type(parts[0]), T.IntegerType())
            case "MAP" if len(parts) == 2:
                return T.MapType(logical_type(parts[0]), logical_type(parts[1]))
            case "ROW":
                fields = [re.fullmatch(r"`?([^`\s]+)`?\s+(.*)", p, flags=re.S) for p in parts]
                if all(fields):
                    return T.StructType([T.StructField(f[1], logical_type(f[2])) for f in fields])
    raise TypeProblem(f"Unsupported type: {text}")


def parse_value(text: str, kind: T.DataType) -> object:
    """A filter's text as a value of the type; raises TypeProblem where it isn't one."""
    try:
        if isinstance(kind, T.StringType):
            return text
        if isinstance(kind, T.BooleanType):
            return {"true": True, "false": False}[text.lower()]
        if type(kind) in _RANGES:
            number = int(text)
            if not -_RANGES[type(kind)] <= number < _RANGES[type(kind)]:
                raise ValueError(text)
            return number
        if isinstance(kind, T.FloatType | T.DoubleType):
            return float(text)
        if isinstance(kind, T.DecimalType):
            number = Decimal(text)
            scaled = number.quantize(Decimal(1).scaleb(-kind.scale))
            if scaled != number or len(scaled.as_tuple().digits) > kind.precision:
                raise ValueError(text)
            return scaled
        if isinstance(kind, T.BinaryType):
            return bytearray(base64.b64decode(text, validate=True))
        if isinstance(kind, T.DateType):
            return dt.date.fromisoformat(text)
        if isinstance(kind, T.TimestampNTZType):
            return dt.datetime.fromisoformat(text)
        if isinstance(kind, T.TimestampType):
            when = dt.datetime.fromisoformat(text)
            if when.tzinfo is None:
                raise ValueError(text)
            return when
        if isinstance(kind, T.TimeType):
            return dt.time.fromisoformat(text)
    except (KeyError, ValueError, InvalidOperation):
        raise TypeProblem(f"'{text}' is not a value of type {kind.simpleString()}") from None
    raise TypeProblem(f"Type {kind.simpleString()} can't be given as text")


def parse_column(c: Column, kind: T.DataType) -> Column:
    """Texts as values of the type, null where they aren't any; base64 for binary, true or false alone for boolean."""
    if isinstance(kind, T.BinaryType):
        return F.try_to_binary(c, F.lit("base64"))
    if isinstance(kind, T.BooleanType):
        return F.when(F.lower(c) == "true", True).when(F.lower(c) == "false", False)
    return c.try_cast(kind)


def display(c: Column, kind: T.DataType) -> Column:
    """A value as shown: text; longs too large for a double as text too; bytes as base64 and UTF-8."""
    if isinstance(kind, T.BinaryType):
        return F.to_json(F.struct(F.base64(c).alias("b64"), F.try_validate_utf8(c.cast("string")).alias("utf8")))
    if isinstance(kind, T.StructType | T.ArrayType | T.MapType):
        return F.to_json(c)
    return c.cast("string")


def guarded_long(c: Column) -> Column:
    """JSON for a long, or a decimal without a fraction: a number within the safe range, else a string."""
    return F.when(c.between(-SAFE_LONG, SAFE_LONG), c.cast("string")).otherwise(F.concat(F.lit('"'), c.cast("string"), F.lit('"')))
