"""Tables under names of a session, for SQL.

``create_table`` declares a keyed table as one would with ``CREATE TABLE ... WITH
(...)``: columns, primary key and options.  ``insert_into`` runs a query into it, and
``register`` makes a snapshot a temporary view, so joins, filters and aggregates over it
are planned by Catalyst, partition and column pruning included.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StructField, StructType

from ..functions.typed import logical_type
from ..options import OptionError, TableOptions
from ..sources.kind import TABLE, detect_kind
from ..sources.state_table import state_table
from ..sources.table import KeyedTable


def declared_schema(columns: dict[str, str], primary_key: list[str]) -> StructType:
    """Columns by their logical types; the key is there, comparable, and not all there is."""
    schema = StructType([StructField(n, logical_type(t), n not in primary_key) for n, t in columns.items()])
    if missing := [k for k in primary_key if k not in columns]:
        raise OptionError(f"Primary key columns {missing} are not declared")
    if maps := [k for k in primary_key if isinstance(schema[k].dataType, MapType)]:
        raise OptionError(f"Primary key columns {maps} are maps, which have no equality")
    if len(columns) == len(primary_key):
        raise OptionError("A table needs at least one column besides its primary key")
    return schema


class DeclaredTable:
    """A declaration: columns and options, usable for writing and reading."""

    def __init__(self, spark: SparkSession, columns: dict[str, str], **options):
        self.spark, self.options = spark, TableOptions.of(**options)
        self.schema = declared_schema(columns, list(self.options.primary_key))

    def insert_into(self, rows: DataFrame | str, seq: str | None = None, op: str | None = None) -> int:
        """Rows, or a query's, bound to the declared columns by name; the id of the new snapshot.

        Without ``seq`` a key must not come twice, as plain inserts have no order.
        """
        rows = self.spark.sql(rows) if isinstance(rows, str) else rows
        table = KeyedTable.create(self.spark, self.options)
        if missing := [c for c in self.schema.names if c not in rows.columns]:
            raise OptionError(f"The query gives no {missing}")
        bound = [F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema]
        order = F.col(seq) if seq else F.lit(0)
        changes = rows.select(*bound, order.alias("_seq"), *([F.col(op).alias("_kind")] if op else []))
        if not seq and changes.groupBy(*self.options.primary_key).count().where("count > 1").limit(1).count():
            raise OptionError(f"Some key {list(self.options.primary_key)} comes twice and nothing orders its rows; give 'seq'")
        return table.upsert(changes, "_seq", "_kind" if op else None, self.options.parallelism).id

    def rows(self) -> DataFrame:
        """The declared columns of the snapshot that the options name.

        Columns the table doesn't have read as nulls of the declared type; a declared type that
        differs from the stored one is refused.
        """
        kind = detect_kind(self.spark, self.options.path, self.options.kind, bool(self.options.primary_key))
        if kind != TABLE:
            return state_table(self.spark, self.options, self.schema)
        table = KeyedTable.open(self.spark, self.options)
        snapshot = table.log.load(self.options.snapshot)
        stored, read = table.schema(snapshot), table.rows_of(snapshot)
        chosen = []
        for f in self.schema:
            if f.name not in stored.names:
                chosen.append(F.lit(None).cast(f.dataType).alias(f.name))
            elif stored[f.name].dataType.simpleString() != f.dataType.simpleString():
                raise OptionError(f"Column '{f.name}' is declared {f.dataType.simpleString()}, stored {stored[f.name].dataType.simpleString()}")
            else:
                chosen.append(F.col(f.name))
        return read.select(*chosen)

    def register(self, name: str) -> None:
        """A temporary view of the snapshot as it is now."""
        self.rows().createOrReplaceTempView(name)


def create_table(spark: SparkSession, columns: dict[str, str], **options) -> DeclaredTable:
    return DeclaredTable(spark, columns, **options)
