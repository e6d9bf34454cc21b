"""Exactly-once upserts from a stream, and following a table as one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..options import OptionError
from ..sources.fs import Files
from ..sources.table import KeyedTable, snapshot_diff


def upsert_batch(table: KeyedTable, query: str, seq: str | list[str], op: str | None = None) -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch``: commits each batch once.

    The snapshot records the query's last batch, so a batch that is run again after a
    failure, committed already, changes nothing.
    """

    def commit(batch: DataFrame, id: int) -> None:
        table.upsert(batch, seq, op, batch=(query, id))

    return commit


def upsert_stream(stream: DataFrame, table: KeyedTable, query: str, seq: str | list[str], checkpoint: str, op: str | None = None, poll_ms: int | None = None) -> StreamingQuery:
    """Start a stream of changes into a table; bounded (all there is) unless ``poll_ms`` is given."""
    writer = stream.writeStream.foreachBatch(upsert_batch(table, query, seq, op)).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if poll_ms is None else writer.trigger(processingTime=f"{poll_ms} milliseconds")).start()


def follow(table: KeyedTable, sink: Callable[[DataFrame, int], None], checkpoint: str, emit: str = "snapshot", poll_ms: int | None = 3000) -> StreamingQuery:
    """Call ``sink(rows, id)`` with each newer snapshot, starting with the newest there is.

    With ``emit='snapshot'`` rows are the whole snapshot; snapshots between two polls may be
    skipped, and deleted rows just aren't there.  ``emit='changes'`` gives rows with ``_op``
    against the snapshot before, which retention has to have kept; else the whole snapshot as
    ``+I``.  A table without a snapshot is waited for.  ``poll_ms=None`` takes what there is
    and ends.  The id that the sink has seen is kept in the checkpoint's folder ``followed``, so a
    query that is started again goes on from it; after a failure within the sink it comes again.
    """
    if emit not in ("snapshot", "changes"):
        raise OptionError(f"'emit' is 'snapshot' or 'changes', not '{emit}'")
    spark, files = table.spark, table.log.files
    if not files.exists("snapshot"):
        files.write("snapshot/CURRENT", "0", replace=True)
    names = spark.readStream.schema("value string").option("pathGlobFilter", "SNAPSHOT-*.json").text(f"{table.root}/snapshot")
    names = names.selectExpr("cast(regexp_extract(_metadata.file_name, 'SNAPSHOT-([0-9]+)', 1) as bigint) AS id")
    done = Files(spark, checkpoint)
    kept = lambda: [int(n) for n in done.names("followed") if n.isdigit()]

    def newest(batch: DataFrame, _: int) -> None:
        from pyspark.sql import functions as F

        id = batch.agg(F.max("id")).first()[0]
        live = table.log.ids()
        if id is None or not live:
            return
        if id not in live:  # pruned meanwhile: a newer one has taken its place
            id = live[0]
        seen = kept()
        before = max(seen, default=None)
        if before is not None and id <= before:
            return
        if emit == "snapshot":
            sink(table.read(id), id)
        elif before in live:
            sink(snapshot_diff(table, before, id), id)
        else:
            rows = table.read(id)
            sink(rows.select(F.lit("+I").alias("_op"), *rows.columns), id)
        done.write(f"followed/{id}", "", replace=True)
        for old in seen:
            done.delete(f"followed/{old}")

    writer = names.writeStream.foreachBatch(newest).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if poll_ms is None else writer.trigger(processingTime=f"{poll_ms} milliseconds")).start()
