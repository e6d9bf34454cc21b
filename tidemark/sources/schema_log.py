"""Schemas of tables and states by content hash, with an event for each change.

``schema/blobs/<sha256>.json`` holds a schema, ``schema/events/SCHEMA-<20 digits>-<sha256>.ref``
says from which snapshot on it holds.  The schema of a snapshot is that of the
greatest event id up to its own.  Names that don't fit are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re

from pyspark.sql.types import StructType

from .fs import Files

_EVENT = re.compile(r"SCHEMA-(\d{20})-([0-9a-f]{64})\.ref")


def digest(schema: StructType) -> str:
    return hashlib.sha256(schema.json().encode()).hexdigest()


class SchemaLog:
    def __init__(self, files: Files):
        self.files = files

    def events(self) -> list[tuple[int, str]]:
        """(id, hash), oldest first."""
        found = (_EVENT.fullmatch(n) for n in self.files.names("schema/events"))
        return sorted((int(m[1]), m[2]) for m in found if m)

    def record(self, id: int, schema: StructType) -> str:
        """Write the blob once, and an event only when the hash changes."""
        sha = digest(schema)
        self._write_once(f"schema/blobs/{sha}.json", schema.json())
        events = self.events()
        if not events or events[-1][1] != sha:
            self._write_once(f"schema/events/SCHEMA-{id:020d}-{sha}.ref", "")
        return sha

    def _write_once(self, name: str, text: str) -> None:
        """The name says all of the content: whoever writes it first writes the same."""
        try:
            self.files.write(name, text)
        except FileExistsError:
            pass

    def blob(self, sha: str) -> StructType:
        text = self.files.read(f"schema/blobs/{sha}.json")
        if hashlib.sha256(text.encode()).hexdigest() != sha:
            raise ValueError(f"Schema {sha} is corrupt")
        return StructType.fromJson(json.loads(text))

    def resolve(self, id: int) -> tuple[str, StructType | None]:
        """('ok' | 'missing' | 'corrupt', schema) for a snapshot."""
        known = [sha for event, sha in self.events() if event <= id]
        if not known:
            return "missing", None
        try:
            return "ok", self.blob(known[-1])
        except Exception:  # unreadable in any way: readers go on with bytes
            return "corrupt", None
