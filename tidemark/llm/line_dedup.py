"""Line dedup across documents, from DataFrame operations only.

Lines are hashed to 128 bits; only hashes, ids and positions move.  The hashes
are range-partitioned and sorted by document and position within them, a
streaming window takes each key's first occurrence in a document, and the
result is a bitmap of kept lines per document, not text.

A key that a third of all documents hold doesn't meet in one task: partitions
are ranges of (key, block of ids), a block holds at most ``BLOCK`` ids, and what
blocks know of a key (how many documents, which is the largest) is summed with
map-side aggregation.  Documents without an id are dealt to blocks by their text.

A bitmap has 64 lines a word, and only words with a line that goes are in it.  Texts of
documents that lose nothing aren't shuffled: a bitmap of hashes, at most ``MAPS`` rows of 4
KB whatever the input, is broadcast and tells which documents may lose lines.

Defined results:

* null or empty text: one empty line, kept (its key is shorter than any minimum);
* null id: a document like any other, smaller than every integer id; rows with
  null ids are one document for the count;
* rows that share an id are one document for the count of documents and are
  told apart by their text when lines are dropped; equal rows fare equally;
* texts of any length and any number of lines: work and memory grow with both in
  proportion;
* ties do not arise: the keeper is the largest id, all its lines stay;
* an empty table gives an empty table; other columns stay untouched, whatever
  their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import SPACES, ascii_lower, few_tasks, materialise, text_hash, whole

#: Bits of an id within a block: 2^12 ids.
BLOCK_BITS = 12
#: Bitmaps, of 2^15 bits each, that tell which documents may lose lines.
MAPS = 2048


def line_key(line: Column) -> Column:
    """The line without ASCII white space at both ends, A-Z lower-cased."""
    return ascii_lower(F.btrim(line, F.lit(SPACES)))


def occurrences(docs: DataFrame, id_col: str, text_col: str, min_key_chars: int) -> DataFrame:
    """One row per line that can be dropped: (__id, __text, __pos, __h1, __h2)."""
    text = docs.select(F.col(id_col).alias("__id"), whole(text_col).alias("__t"))
    lines = text.select("__id", text_hash(F.col("__t")).alias("__text"), F.split("__t", "\n").alias("__lines"))
    lines = lines.select("__id", "__text", F.posexplode("__lines").alias("__pos", "__line"))
    keys = lines.select("__id", "__text", "__pos", line_key(F.col("__line")).alias("__key"))
    return keys.where(F.char_length("__key") >= min_key_chars).select(
        "__id", "__text", "__pos", F.xxhash64("__key").alias("__h1"), F.xxhash64(F.lit(1), "__key").alias("__h2")
    )


def repeated_keys(occ: DataFrame, min_docs: int) -> DataFrame:
    """Keys held by at least ``min_docs`` documents, with the largest id: (__h1, __h2, __keeper)."""
    group = ["__h1", "__h2", "__block"]
    block = F.coalesce(F.shiftright("__id", BLOCK_BITS), F.pmod("__text", F.lit(1 << BLOCK_BITS)))
    ranged = occ.withColumn("__block", block).repartitionByRange(*group)
    order = W.partitionBy(*group).orderBy(F.col("__id").desc_nulls_last(), F.col("__pos"))
    # streams over the sorted partition: a row is a document's first occurrence if the row before has another id
    first = ranged.select(*group, "__id", (F.row_number().over(order) == 1).alias("__top"), F.lag("__id").over(order).alias("__before"))
    first = first.where(F.col("__top") | ~F.col("__id").eqNullSafe(F.col("__before")))
    blocks = first.groupBy(*group).agg(F.count("__id").alias("__docs"), F.max(F.col("__id").isNull().cast("int")).alias("__null"), F.max("__id").alias("__keeper"))  # no exchange: the ranges hold
    keys = blocks.groupBy("__h1", "__h2").agg((F.sum("__docs") + F.max("__null")).alias("__docs"), F.max("__keeper").alias("__keeper"))
    return keys.where(F.col("__docs") >= min_docs).drop("__docs")


def keep_bitmaps(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_key_chars: int = 20, min_docs: int = 3
) -> DataFrame:
    """Documents that lose lines: (__id, __text, __dropped long, __bitmap array<struct<word int, bits long>>).

    Bit ``i % 64`` of word ``i / 64`` is 1 if line ``i`` goes; words without such a line
    are left out, the others in order.  Documents that keep every line have no row at all.
    """
    occ = materialise(occurrences(docs, id_col, text_col, min_key_chars), "lines")
    keys = materialise(few_tasks(repeated_keys(occ, min_docs), docs), "keys")  # both sides are then plain shuffles, and a hot key can be split
    gone = occ.join(keys, ["__h1", "__h2"]).where(~F.col("__id").eqNullSafe(F.col("__keeper")))
    words = gone.groupBy("__id", "__text", F.shiftright("__pos", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, __pos & 63)")).alias("bits"))
    bitmaps = words.groupBy("__id", "__text").agg(F.sum(F.bit_count("bits")).cast("long").alias("__dropped"), F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("__bitmap"))
    return few_tasks(bitmaps, docs)


def dense(bitmap: Column) -> Column:
    """The words of a bitmap with those left out, up to the last: in proportion to their number."""
    after = F.concat(F.array(F.lit(-1)), F.transform(bitmap, lambda x: x["word"]))  # one longer than the bitmap
    runs = F.filter(F.arrays_zip(after.alias("after"), bitmap.alias("x")), lambda z: z["x"].isNotNull())
    return F.flatten(F.transform(runs, lambda z: F.concat(F.array_repeat(F.lit(0).cast("long"), z["x"]["word"] - z["after"] - 1), F.array(z["x"]["bits"]))))


def _maybe_in(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """``rows`` with ``__maybe``: false only if no row of ``keys`` has their (__rid, __rtext) as (__bid, __btext)."""
    bit = lambda *c: F.pmod(F.xxhash64(F.lit(9), *c), F.lit(MAPS << 15))
    at = keys.select(bit("__bid", "__btext").alias("__at"))
    low = F.col("__at").bitwiseAND(F.lit((1 << 15) - 1))
    maps = at.groupBy(F.shiftright("__at", 15).alias("__map")).agg(F.bitmap_construct_agg(low).alias("__bits"))
    maps = F.broadcast(maps)  # at most MAPS rows of 4 KB: 8 MB
    marked = rows.withColumn("__at", bit("__rid", "__rtext")).withColumn("__map", F.shiftright("__at", 15)).join(maps, "__map", "left")
    byte = F.conv(F.hex(F.substring("__bits", (F.shiftright(low, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    maybe = F.coalesce(F.getbit(byte, low.bitwiseAND(F.lit(7)).cast("int")) == 1, F.lit(False))
    return marked.withColumn("__maybe", maybe).drop("__at", "__map", "__bits")


def with_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each row of ``docs`` as struct ``row``, and struct ``lines``: n_lines, n_dropped and the kept text."""
    marks = materialise(bitmaps.withColumnsRenamed({"__id": "__bid", "__text": "__btext"}), "bitmaps")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(id_col).alias("__rid"), text_hash(whole(text_col)).alias("__rtext"))
    rows = _maybe_in(rows, marks)
    same = F.col("__rid").eqNullSafe(F.col("__bid")) & (F.col("__rtext") == F.col("__btext"))
    joined = few_tasks(rows.where("__maybe").join(marks, same, "left").select("row", "__dropped", "__bitmap"), docs)
    text = whole(F.col(f"row.`{text_col}`"))
    split = joined.select("row", "__dropped", dense(F.col("__bitmap")).alias("__words"), F.split(text, "\n").alias("__lines"))
    bit = lambda i: F.coalesce(F.get(F.col("__words"), F.shiftright(i, 6)), F.lit(0).cast("long"))
    kept = F.filter(F.col("__lines"), lambda line, i: F.getbit(bit(i), i.bitwiseAND(F.lit(63))) == 0)
    kept = F.when(F.col("__words").isNull(), text).otherwise(F.array_join(kept, "\n"))
    none = F.lit(0).cast("long")
    losing = split.select("row", F.struct(F.size("__lines").cast("long").alias("n_lines"), F.coalesce("__dropped", none).alias("n_dropped"), kept.alias("kept")).alias("lines"))
    n_lines = F.char_length(text) - F.char_length(F.replace(text, F.lit("\n"), F.lit(""))) + 1
    whole_ = rows.where("not __maybe").select("row", F.struct(n_lines.cast("long").alias("n_lines"), none.alias("n_dropped"), text.alias("kept")).alias("lines"))
    return losing.unionByName(whole_)


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_key_chars: int = 20, min_docs: int = 3
) -> DataFrame:
    """``docs`` with repeated lines gone from ``text_col``; all other columns as they were."""
    bitmaps = keep_bitmaps(docs, id_col, text_col, min_key_chars, min_docs)
    marked = with_bitmaps(docs, bitmaps, id_col, text_col)
    return marked.select(*[F.col("lines.kept").alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in docs.columns])
