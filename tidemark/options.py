"""Options of tables and scans, checked before anything runs."""

from __future__ import annotations

from dataclasses import dataclass, field

#: Options that tune another engine's memory: accepted, checked and without effect here.
MEMORY_OPTIONS = {"sink.writer-buffer-memory": "256mb", "sink.use-managed-memory-allocator": "false", "source.block-cache-memory": "0"}
_KNOWN = {
    "path", "primary-key", "bucket", "sink.parallelism", "snapshot.retention", "snapshot.grace-ms", "scan.mode", "scan.checkpoint-id", "scan.poll-interval-ms",
    "source.kind", "state.name", "state.kind", "state.operator-id", "all-null-is-delete", *MEMORY_OPTIONS,
}
_UNITS = {"": 1, "b": 1, "kb": 1 << 10, "mb": 1 << 20, "gb": 1 << 30}


class OptionError(ValueError):
    """An option is missing, unknown or out of its range."""


def normalised_path(path: str | None) -> str:
    """A path with a scheme; relative and plain ones are local files."""
    if path is None or not path.strip():
        raise OptionError("Option 'path' must not be blank")
    path = path.strip().rstrip("/")
    if "://" in path or path.startswith("file:"):
        return path
    from os.path import abspath

    return f"file://{abspath(path)}"


def _number(options: dict[str, str], name: str, default: int | None, least: int = 1) -> int | None:
    value = options.get(name)
    if value is None:
        return default
    try:
        number = int(str(value))
    except ValueError:
        raise OptionError(f"Option '{name}' must be a whole number, not '{value}'") from None
    if number < least:
        raise OptionError(f"Option '{name}' must be {'greater than 0' if least == 1 else f'at least {least}'}, not {number}")
    return number


def _size(options: dict[str, str], name: str, least: int) -> int:
    said = str(options.get(name, MEMORY_OPTIONS[name])).strip().lower().replace(" ", "")
    digits = said.rstrip("abcdefghijklmnopqrstuvwxyz")
    if not digits.isdigit() or said[len(digits) :] not in _UNITS:
        raise OptionError(f"Option '{name}' must be a size, not '{said}'")
    size = int(digits) * _UNITS[said[len(digits) :]]
    if size < least:
        raise OptionError(f"Option '{name}' must be {'greater than 0' if least else 'at least 0'}")
    return size


def checkpoint_id(value: str | int | None) -> int | None:
    """None for the latest snapshot, else its positive number."""
    if value is None or str(value).strip().lower() == "latest":
        return None
    text = str(value).strip()
    if not text.isdigit() or int(text) < 1:
        raise OptionError(f"Option 'scan.checkpoint-id' must be 'latest' or a positive number, not '{value}'")
    return int(text)


@dataclass(frozen=True)
class TableOptions:
    """Checked options of one table."""

    path: str
    primary_key: tuple[str, ...] = ()
    bucket: int | None = None
    parallelism: int | None = None
    retention: int = 1
    mode: str = "batch"
    snapshot: int | None = None
    poll_ms: int = 3000
    kind: str = "auto"
    state_name: str | None = None
    state_kind: str | None = None
    state_operator: str | None = None
    all_null_is_delete: bool = False
    grace_ms: int = 600_000  #: how long files of dropped snapshots stay for their readers
    ignored: dict[str, str] = field(default_factory=dict)

    @staticmethod
    def of(**options: str | int | bool) -> TableOptions:
        """From options by their SQL names, with ``_`` for ``-`` and ``__`` for ``.`` if need be."""
        given = {k.replace("__", ".").replace("_", "-") if k not in _KNOWN else k: v for k, v in options.items() if v is not None}
        if unknown := sorted(set(given) - _KNOWN):
            raise OptionError(f"Unknown options: {', '.join(unknown)}")
        mode = str(given.get("scan.mode", "batch")).lower()
        if mode not in ("batch", "streaming"):
            raise OptionError(f"Option 'scan.mode' must be 'batch' or 'streaming', not '{mode}'")
        snapshot = checkpoint_id(given.get("scan.checkpoint-id"))
        if mode == "streaming" and snapshot is not None:
            raise OptionError("Option 'scan.mode' = 'streaming' needs 'scan.checkpoint-id' = 'latest'")
        kind = str(given.get("source.kind", "auto")).lower()
        if kind == "raw":
            raise OptionError("Option 'source.kind' = 'raw' is reserved")
        if kind not in ("auto", "sink", "state"):
            raise OptionError(f"Option 'source.kind' must be 'auto', 'sink' or 'state', not '{kind}'")
        _size(given, "sink.writer-buffer-memory", 1)
        _size(given, "source.block-cache-memory", 0)
        key = given.get("primary-key", ())
        key = tuple(k.strip() for k in key.split(",") if k.strip()) if isinstance(key, str) else tuple(key)
        return TableOptions(
            normalised_path(given.get("path")),
            key,
            _number(given, "bucket", None),
            _number(given, "sink.parallelism", None),
            _number(given, "snapshot.retention", 1),
            mode,
            snapshot,
            _number(given, "scan.poll-interval-ms", 3000),
            kind,
            given.get("state.name"),
            given.get("state.kind"),
            given.get("state.operator-id"),
            str(given.get("all-null-is-delete", "false")).lower() == "true",
            _number(given, "snapshot.grace-ms", 600_000, 0),
            {k: str(given[k]) for k in MEMORY_OPTIONS if k in given},
        )
