"""Rules on a document's own words and lines, and on lines that many documents of a host share.

DataFrame operations only.  One pass over the texts makes a narrow profile per
document: counts and a hash per line.  The cross-document part works on the
profile: the distinct documents that hold a line are counted per host, lines held by more
than ``max_docs`` of them are taken off, and documents with too little left are rejected.
The limit is a number, not a share, so a host's size alone changes nothing.

A line or a host that a third of all rows share is counted by (host, line, document),
which spreads over all tasks, before it is summed with map-side aggregation.

Defined results:

* null or empty text: no words, all counts 0, ``base_failed`` true;
* null host: the same host as the empty string;
* rows that share an id are one document when a line's documents are counted, as are rows
  without an id; their results are told apart by their text; equal rows get equal results;
* a line in exactly ``max_docs`` documents stays; a document left with exactly the fraction
  ``min_left`` of its words stays;
* texts of any length: windows are found by sorting packed (hash, position)
  words; where packing can't tell two windows apart, or positions don't fit, the
  document takes an exact path on full hashes;
* an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE_RUN, SPACES, WORD, ascii_lower, materialise, text_hash, whole

SYMBOLS = r"[#*$%&|<>]"
#: Bits of a packed word that hold a window's position; the others hold the top of its hash.
POSITION_BITS = 24


def _alike(p: Column, k: Column, of: Column, value) -> Column:
    """Whether an element of the sorted array ``of`` equals a neighbour, both seen through ``value``."""
    is_same = lambda j: F.coalesce(value(F.get(of, j)) == value(p), F.lit(False))
    return is_same(k - 1) | is_same(k + 1)


def _repeated_at(packed: Column) -> Column:
    """Positions of windows whose packed word has the same top as another's."""
    low, top = (1 << POSITION_BITS) - 1, lambda p: F.shiftright(p, POSITION_BITS)
    return F.transform(F.filter(packed, lambda p, k: _alike(p, k, packed, top)), lambda p: p.bitwiseAND(F.lit(low)).cast("int"))


def _repeated_exactly(hashes: Column) -> Column:
    """The same from sorted (hash, position) pairs: slower, for any length and any hashes."""
    pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    found = lambda s: F.transform(F.filter(s, lambda p, k: _alike(p, k, s, lambda x: x["h"])), lambda p: p["i"])
    return F.sort_array(F.flatten(F.transform(F.array(pairs), found)))  # the one-element array binds the sorted pairs once


def profile(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """(__id, __host, __text, counts, __lines array<struct<h long, w int>>) of each document."""
    text = docs.select(F.col(id_col).alias("__id"), whole(host_col).alias("__host"), whole(text_col).alias("__t"))
    blank = F.array().cast("array<string>")
    trimmed = F.btrim("__t", F.lit(SPACES))
    lines = F.filter(F.split("__t", "\n"), lambda x: F.char_length(F.btrim(x, F.lit(SPACES))) > 0)
    cut = text.select(
        "__id",
        "__host",
        text_hash(F.col("__t")).alias("__text"),
        F.when(trimmed == "", blank).otherwise(F.split(trimmed, SPACE_RUN)).alias("__words"),
        lines.alias("__full"),
        F.regexp_count("__t", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
    )
    n = F.size("__words")
    window = lambda i: F.xxhash64(F.get("__words", i), F.get("__words", i + 1), F.get("__words", i + 2))
    hashes = F.when(n >= 4, F.transform(F.sequence(F.lit(0), F.greatest(n - 3, F.lit(0))), window)).otherwise(F.array().cast("array<bigint>"))
    counted = cut.select(
        "__id",
        "__host",
        "__text",
        n.cast("long").alias("n_words"),
        F.char_length(F.array_join("__words", "")).cast("long").alias("word_chars"),
        "n_symbols",
        (F.size("__full") - F.size(F.array_distinct("__full"))).cast("long").alias("n_dup_lines"),
        hashes.alias("__h"),
        F.transform("__full", lambda x: F.struct(F.xxhash64(ascii_lower(F.btrim(x, F.lit(SPACES)))).alias("h"), F.regexp_count(x, F.lit(WORD)).alias("w"))).alias("__lines"),
    )
    high = ~((1 << POSITION_BITS) - 1)
    packed = F.sort_array(F.transform("__h", lambda h, i: h.bitwiseAND(F.lit(high)).bitwiseOR(i.cast("long"))))
    found = counted.withColumn("__packed", packed)
    found = found.withColumn("__at", F.sort_array(_repeated_at(F.col("__packed"))))
    own = F.transform("__at", lambda i: F.get("__h", i))
    tops = F.transform("__at", lambda i: F.shiftright(F.get("__h", i), POSITION_BITS))
    beyond = F.size("__h") > (1 << POSITION_BITS)
    clash = (F.size("__at") > 0) & (F.size(F.array_distinct(own)) != F.size(F.array_distinct(tops)))
    found = found.withColumn("__sure", F.when(beyond | clash, _repeated_exactly(F.col("__h"))).otherwise(F.col("__at")))
    steps = F.transform("__sure", lambda i, k: F.least(F.lit(3), F.coalesce(F.get("__sure", k + 1) - i, F.lit(3))))
    repeated = F.aggregate(steps, F.lit(0), lambda a, x: a + x).cast("long")
    return found.select("__id", "__host", "__text", "n_words", "word_chars", "n_symbols", "n_dup_lines", repeated.alias("n_repeat_words"), "__lines")


def frequent_lines(prof: DataFrame, max_docs: int) -> DataFrame:
    """(__host, h) of lines in more than ``max_docs`` distinct documents of a host."""
    held = prof.select("__host", "__id", F.explode(F.array_distinct(F.transform("__lines", lambda x: x["h"]))).alias("h")).distinct()
    return held.groupBy("__host", "h").agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > max_docs).select("__host", "h")


def lines_gone(prof: DataFrame, max_docs: int) -> DataFrame:
    """(__id, __text, __host, __pos, w) of each line that goes: its place among the lines with a word, and its words."""
    every = prof.select("__id", "__text", "__host", F.posexplode("__lines").alias("__pos", "__line"))
    every = every.select("__id", "__text", "__host", "__pos", F.col("__line.h").alias("h"), F.col("__line.w").alias("w"))
    gone = every.join(frequent_lines(prof, max_docs), ["__host", "h"])
    return gone.groupBy("__id", "__text", "__host", "__pos").agg(F.max("w").alias("w"))  # equal rows count once


def judge(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    max_docs: int = 50,
    min_left: float = 0.3,
) -> DataFrame:
    """Counts and verdict of each document.

    A line goes if more than ``max_docs`` distinct documents of the host hold it.  A
    document is depleted, and rejected, if fewer than ``min_left`` of its words are left.
    """
    prof = materialise(profile(docs, id_col, text_col, host_col), "profile")
    gone = lines_gone(prof, max_docs)
    gone = gone.groupBy("__id", "__text", "__host").agg(F.sum("w").alias("__gone"))
    gone = gone.withColumnsRenamed({"__id": "__gid", "__text": "__gtext", "__host": "__ghost"})
    own = prof.drop("__lines")
    same = own["__id"].eqNullSafe(gone["__gid"]) & (own["__text"] == gone["__gtext"]) & (own["__host"] == gone["__ghost"])
    all_ = own.join(gone, same, "left").withColumn("__gone", F.coalesce("__gone", F.lit(0)))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    depleted = F.col("n_words") - F.col("__gone") < min_left * F.col("n_words")
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return all_.select(F.col("__id").alias(id_col), *counts, failed.alias("base_failed"), (~failed & ~depleted).alias("kept"), F.col("__gone").cast("long").alias("n_words_in_frequent_lines"))


def without_frequent_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", max_docs: int = 50, min_left: float = 0.3
) -> DataFrame:
    """The documents that :func:`judge` keeps, without the lines that go; other columns and empty lines stay."""
    prof = materialise(profile(docs, id_col, text_col, host_col), "profile")
    at = lines_gone(prof, max_docs).groupBy("__id", "__text", "__host").agg(F.sum("w").alias("__gone"), F.sort_array(F.collect_list("__pos")).alias("__at"))
    own = prof.select("__id", "__text", "__host", "n_words", "n_repeat_words").distinct()
    at = at.withColumnsRenamed({"__id": "__gid", "__text": "__gtext", "__host": "__ghost"})
    marked = own.join(at, own["__id"].eqNullSafe(at["__gid"]) & (own["__text"] == at["__gtext"]) & (own["__host"] == at["__ghost"]), "left")
    n, gone = F.col("n_words"), F.coalesce("__gone", F.lit(0))
    good = marked.where(~((n < 50) | (100 * F.col("n_repeat_words") > 50 * n)) & ~(n - gone < min_left * n)).select("__id", "__text", "__host", "__at")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(id_col).alias("__rid"), whole(host_col).alias("__rhost"), text_hash(whole(text_col)).alias("__rtext"))
    kept = rows.join(good, F.col("__rid").eqNullSafe(F.col("__id")) & (F.col("__rtext") == F.col("__text")) & (F.col("__rhost") == F.col("__host")))
    # lines with a word are numbered; a run of lines between two that go stays as it is
    lines = kept.select("row", F.coalesce("__at", F.array().cast("array<int>")).alias("__at"), F.split(whole(F.col(f"row.`{text_col}`")), "\n").alias("__lines"))
    full = F.filter(F.transform("__lines", lambda x, k: F.when(F.char_length(F.btrim(x, F.lit(SPACES))) > 0, k)), lambda k: k.isNotNull())
    lines = lines.withColumn("__full", full).withColumn("__out", F.transform("__at", lambda p: F.get("__full", p)))
    ends = F.arrays_zip(F.concat(F.array(F.lit(-1)), "__out").alias("after"), F.concat("__out", F.array(F.size("__lines"))).alias("before"))
    runs = F.transform(ends, lambda e: F.slice("__lines", e["after"] + 2, e["before"] - e["after"] - 1))
    text = F.when(F.size("__at") == 0, F.col(f"row.`{text_col}`")).otherwise(F.array_join(F.flatten(runs), "\n"))
    return lines.select(*[text.alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in docs.columns])
