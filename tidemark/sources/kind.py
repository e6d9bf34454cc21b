"""What lies under a path: a keyed table, a streaming checkpoint with state, or neither."""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..options import OptionError
from .fs import Files

TABLE, STATE = "table", "state"


def detect_kind(spark: SparkSession, root: str, asked: str = "auto", sink_shaped: bool = False) -> str:
    """``table`` or ``state``.  An explicit kind must not contradict the layout; where both or neither
    are found, a declaration with a primary key means a table."""
    files = Files(spark, root)
    table = any(n.startswith("SNAPSHOT-") for n in files.names("snapshot"))
    state = files.exists("state") and files.exists("metadata")
    if asked == "sink":
        if state and not table:
            raise OptionError(f"'source.kind' = 'sink', but {root} holds streaming state")
        return TABLE
    if asked == "state":
        if table and not state:
            raise OptionError(f"'source.kind' = 'state', but {root} holds a keyed table")
        return STATE
    if table != state:
        return TABLE if table else STATE
    if sink_shaped:
        return TABLE
    raise OptionError(f"Can't tell what {root} holds; set 'source.kind'")
