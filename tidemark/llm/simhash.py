"""Near duplicates by SimHash fingerprints, found through a byte-position index.

A fingerprint has 64 bits, or eight positional bytes.  Two that differ in at most
four bits share at least four of the eight, the guaranteed minimum.  Lists of the
index are keyed by three positions and their bytes; the twenty triples in
``TRIPLES`` are such that any four positions contain one of them, so each linked
pair meets in some list.  Within a list, shared positional bytes are tallied for
each pair, pairs with fewer than four are dropped, and only the rest are verified by
counting the differing bits.

Equal fingerprints are one entry of the index, however many texts have them.  A
list of more than ``LIST`` entries is replaced by longer ones: since a linked pair shares a
fourth byte too, its entries go to one list for each of the other five positions.  Of
these, one that still is too long is dealt into blocks, and each pair of blocks is
a list of its own, so no task holds more than two blocks and no pair is missed.
What leaves a list isn't its pairs but one edge per entry to the first of its
component there, which keeps all that is reachable.  Components of the edges are
found by :mod:`components`.

Defined results:

* null or empty text, or one without words: fingerprint zero, linked like any other;
* null id: never the component's id unless all ids of the component are null;
* rows that share an id are fingerprinted by their own texts;
* a bit set in exactly half of the shingles is 0;
* texts of any length: long ones go through in blocks of words that overlap;
* an empty table gives an empty table; other columns stay, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import accumulate, combinations, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType
from xxhash import xxh64_intdigest

from .common import materialise, small_batches, text_hash, whole
from .components import components

SEED, SHINGLE, DISTANCE = 42, 4, 4
#: Positions shared by any two fingerprints that differ in DISTANCE bits; entries of a list before it is split.
SHARED, LIST = 8 - DISTANCE, 2048
#: Words of a text handled at once.
WORDS = 200_000


def _triples() -> list[tuple[int, int, int]]:
    """Fewest triples of eight positions of which any four contain one: three parts in a ring,
    triples within a part and those with two in a part and one in the next."""
    parts = [(0, 1, 2), (3, 4, 5), (6, 7)]
    found = [t for p in parts for t in combinations(p, 3)]
    return found + [(*two, one) for k, p in enumerate(parts) for two in combinations(p, 2) for one in parts[(k + 1) % 3]]


TRIPLES = _triples()


def _counted(hashes: list[int]) -> np.ndarray:
    """How many of the hashes have each of the 64 bits."""
    bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.add.reduce(bits, axis=0, dtype=np.int64)


def shingles(words: list[bytes], size: int = SHINGLE) -> list[int]:
    """Hashes of the shingles of some words."""
    joined = b" ".join(words)
    ends = list(accumulate(map(len, words), lambda a, n: a + n + 1))
    starts = [0, *(e + 1 for e in ends[: len(words) - size])]
    return [xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts, ends[size - 1 :], strict=True)]


def fingerprint(text: str | None) -> int:
    """The SimHash of a whole text, as a signed 64-bit number."""
    data = (text or "").encode("utf-8", "surrogatepass").lower()  # of bytes: A-Z alone
    if len(data) <= 8 * WORDS:
        blocks = iter([data.split()])
    else:
        found = (m.group() for m in re.finditer(rb"[^\x20\x09-\x0D]+", data))
        blocks = iter(lambda: list(islice(found, WORDS)), [])
    total, counts, kept = 0, np.zeros(64, np.int64), []
    for block in blocks:
        words = kept + block
        if len(words) >= SHINGLE:
            hashes = shingles(words)
            total, counts = total + len(hashes), counts + _counted(hashes)
        kept = words[-(SHINGLE - 1) :]
    if not total and kept:
        total, counts = 1, _counted([xxh64_intdigest(b" ".join(kept), SEED)])
    value = int(np.packbits(2 * counts > total, bitorder="little").view("<u8")[0])
    return value - (value >> 63 << 64)


def with_fingerprint(docs: DataFrame, text_col: str = "text", out: str = "__fp") -> DataFrame:
    """``docs`` with the fingerprint of each text."""
    schema = StructType([*docs.schema, StructField(out, LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            found = [fingerprint(t) for t in batch.column(text_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.int64())], schema.names)

    return docs.mapInArrow(run, schema)


def _key(t: int) -> Column:
    """The list of a fingerprint for one triple: the triple's number and its three bytes."""
    key = F.lit(t).cast("long")
    for p in TRIPLES[t]:
        key = F.shiftleft(key, 8).bitwiseOR(F.shiftright("fp", 8 * p).bitwiseAND(F.lit(255)))
    return key


def _tally(octets: np.ndarray, at: np.ndarray, to: np.ndarray) -> np.ndarray:
    """Positional bytes that the entries ``at`` and ``to`` share."""
    return (octets[at] == octets[to]).sum(axis=1)


def _verified(fp: np.ndarray, at: np.ndarray, to: np.ndarray) -> np.ndarray:
    """Whether the entries differ in at most DISTANCE bits."""
    return np.bitwise_count((fp[at] ^ fp[to]).view(np.uint64)) <= DISTANCE


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (list, one, two, block, fp), list by list, to edges within the lists."""

    def edges(lists: np.ndarray, cross: np.ndarray, block: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
        n = len(fp)
        left = np.searchsorted(lists, lists, "right") - np.arange(n)  # entries from here to the end of the list
        root, octets = np.arange(n), fp.view(np.uint8).reshape(-1, 8)
        at, far = np.flatnonzero(left > 1), 1
        while len(at):
            to = at + far
            fits = (_tally(octets, at, to) >= SHARED) & (~cross[at] | (block[at] != block[to])) & (root[at] != root[to])
            one, other = at[fits], to[fits]
            near = _verified(fp, one, other)
            for i, j in zip(one[near].tolist(), other[near].tolist(), strict=True):
                while root[i] != i:
                    i = root[i]
                while root[j] != j:
                    j = root[j]
                root[max(i, j)] = min(i, j)
            while near.any() and not np.array_equal(up := root[root], root):
                root = up
            far += 1
            at = at[left[at] > far]
        moved = np.flatnonzero(root != np.arange(n))
        return pa.RecordBatch.from_arrays([pa.array(fp[moved]), pa.array(fp[root[moved]])], ["a", "b"])

    held: list[np.ndarray] = []
    for batch in batches:
        columns = [batch.column(c).to_numpy() for c in ("list", "one", "two", "block", "fp")]
        held = [np.concatenate(x) for x in zip(held, columns, strict=True)] if held else columns
        same = (held[0] == held[0][-1]) & (held[1] == held[1][-1]) & (held[2] == held[2][-1])
        done = int(np.argmax(same))  # rows are in order, so the last list is the tail
        if done:
            yield edges(*_numbered([x[:done] for x in held]))
            held = [x[done:] for x in held]
    if held:
        yield edges(*_numbered(held))


def _numbered(columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lists as ascending numbers, and whether a list is of two different blocks."""
    key, one, two, block, fp = columns
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (one[1:] != one[:-1]) | (two[1:] != two[:-1])
    return np.cumsum(new), one != two, block, fp


def links(fps: DataFrame) -> DataFrame:
    """Distinct fingerprints (fp) to edges (a, b) that connect all within DISTANCE bits."""
    lists = fps.select("fp", F.explode(F.array(*(_key(t) for t in range(len(TRIPLES))))).alias("list"))
    sizes = materialise(lists.groupBy("list").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "lists")
    shared = lists.join(sizes, "list")
    rest = F.array(*(F.array(*(F.lit(p) for p in range(8) if p not in t)) for t in TRIPLES))
    longer = shared.where(F.col("n") > LIST).select("fp", "list", F.explode(F.element_at(rest, (F.shiftright("list", 24) + 1).cast("int"))).alias("p"))
    longer = longer.select("fp", F.expr(f"((list << 3 | p) << 8 | (shiftright(fp, 8 * p) & 255)) | {1 << 48}L").alias("list"))  # a fourth position and its byte
    more = longer.groupBy("list").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    more = materialise(more.select("list", F.ceil(F.col("n") / LIST).cast("int").alias("blocks")), "lists")
    shared = shared.where(F.col("n") <= LIST).select("list", "fp", F.lit(1).alias("blocks")).unionByName(longer.join(more, "list"))
    shared = shared.withColumn("block", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    pairs = shared.select("list", "fp", "block", other)
    pairs = pairs.select("list", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"), "block", "fp")
    ordered = pairs.repartition("list", "one", "two").sortWithinPartitions("list", "one", "two", "fp")
    return ordered.mapInArrow(_linked, "a long, b long").distinct()


def groups(marked: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Rows with ``__fp`` to (fp, root, component_id): one row per distinct fingerprint."""
    classes = materialise(marked.groupBy(F.col("__fp").alias("fp")).agg(F.min(id_col).alias("low")), "classes")
    stars = components(links(classes.select("fp"))).withColumnRenamed("node", "fp")
    rooted = materialise(classes.join(stars, "fp", "left").select("fp", "low", F.coalesce("root", "fp").alias("root")), "rooted")
    lowest = materialise(rooted.groupBy("root").agg(F.min("low").alias("component_id")), "lowest")
    return materialise(rooted.join(lowest, "root").select("fp", "root", "component_id"), "groups")


def cluster(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp, component_id) of each row; the component's id is its smallest."""
    marked = materialise(with_fingerprint(docs.select(id_col, text_col), text_col).select(id_col, "__fp"), "fingerprints")
    found = groups(marked, id_col)
    return marked.join(found, marked["__fp"] == found["fp"]).select(id_col, "fp", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component: the smallest id, of equal ids the smallest hash of the text."""
    narrow = docs.select(id_col, text_col)
    marked = with_fingerprint(narrow, text_col).select(id_col, "__fp", text_hash(whole(text_col)).alias("__text"))
    marked = materialise(marked, "fingerprints")
    found = groups(marked, id_col)
    rooted = marked.join(found, marked["__fp"] == found["fp"]).select(F.col(id_col).alias("__id"), "__text", "root")
    return one_each(docs, rooted, id_col, text_col)


def one_each(docs: DataFrame, rooted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows (__id, __text, root) of all documents to one row of ``docs`` for each root, by :func:`keep_one`'s order."""
    order = F.struct(F.col("__id").isNull().alias("__null"), F.col("__id").alias("__kid"), F.col("__text").alias("__ktext"))
    kept = rooted.groupBy("root").agg(F.min(order).alias("k")).select("k.__kid", "k.__ktext")
    # plain equality on three columns without nulls: the join and the removal of equal rows share one shuffle of the texts
    key = ["__key", "__null", "__ktext"]
    same = lambda c: [F.coalesce(F.col(c).cast("string"), F.lit("")).alias("__key"), F.col(c).isNull().alias("__null")]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *same(f"`{id_col}`"), text_hash(whole(text_col)).alias("__ktext"))
    return rows.join(kept.select(*same("__kid"), "__ktext"), key).dropDuplicates(key).select("row.*")
