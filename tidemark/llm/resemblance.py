"""Near duplicates at five words and a similarity of 0.8: SimHash fingerprints found through a byte-position index.

The method is that of :mod:`simhash`, at a wider distance.  Two texts with a Jaccard similarity
of 0.8 differ in about 0.15 of a SimHash's bits, ten of 64, and share two or three of its eight
positional bytes.  No number of shared bytes is certain there, so a text has ``FINGERPRINTS`` of
64 bits, each by the same rule (a bit is 1 if set in over half of the hashes of the set's shingles)
from hashes of its own; the first is from the XXH64 itself.  ``LISTED`` of them are indexed, for sets of up to ``SMALL``
shingles, whose few bits turn more easily, all.  A list of the index is keyed by a position and its byte, and
two texts of a list meet if they share another, later byte of the fingerprint.  Those that meet
are linked as candidates if this fingerprint and the next two differ in at most ``NEAR`` of 192 bits.

In a group of candidates the positional bytes that a pair shares are tallied, pairs with fewer than ``MATCHES``
of 128 (``FEW``, if one is small) are dropped, and the rest are verified: at most ``DISTANCE`` of 1,024 bits may differ, and then the
sets are compared in full.  Pairs of at least ``SIMILARITY`` are linked; the groups are the
components of the links.  By design, a pair of similarity 0.8 meets nowhere with a chance of
0.0002, and falls short of ``MATCHES`` with one of 0.0001; at 0.9 either is less than one in a million.

Texts with equal sets are one node.  A list of more than ``LIST`` nodes is replaced by one for
each later position and its byte; of these, one that still is too long is dealt into blocks, and each
pair of blocks is a list of its own.  What leaves a list is one edge per node to the first of its
component there, which keeps all that is reachable; a component of these edges is a group of candidates.
One of more than ``BLOCK`` shingles is dealt into blocks in the same way, so no task holds more
than two blocks and no pair is missed.  Nodes that are linked already aren't compared again.

Defined results:

* null or empty text, or one without words: the empty set, all of them one group;
* fewer than five words: they are the only shingle;
* A-Z are lower-cased; words are separated by ASCII white space;
* texts of any length: long ones go through in blocks of words that overlap;
* null ids, rows that share an id, equal rows and other columns: as in :mod:`simhash`.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType
from xxhash import xxh64_intdigest

from ..scratch import discard
from .common import few_tasks, materialise, small_batches, text_hash, whole
from .components import components
from .simhash import SEED, WORDS, one_each, shingles

SHINGLE = 5
#: The least similarity of a pair, as a fraction; shingles of a block.
SIMILARITY, BLOCK = (4, 5), 250_000
#: SimHashes of a text, of 64 bits each; those that are indexed; shingles of a set for which all are.
FINGERPRINTS, LISTED, SMALL = 16, 8, 32
#: Most bits that differ in the three fingerprints of a list's entry, and in all; least positional bytes shared, and for a small set.
NEAR, DISTANCE, MATCHES, FEW = 48, 250, 17, 10
#: Entries of a list before it is split, and of equal bytes in it before they are compared one by one with the rest.
LIST, RUN = 100_000, 64
STEPS = np.arange(FINGERPRINTS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
#: Bitmaps, of 2**15 bits each, that tell which sets may be candidates.
BITMAPS = 2048


def shingle_set(text: str | None) -> np.ndarray:
    """Ascending hashes of the distinct shingles of a whole text."""
    data = (text or "").encode("utf-8", "surrogatepass").lower()  # of bytes: A-Z alone
    if len(data) <= 8 * WORDS:
        blocks = iter([data.split()])
    else:
        found = (m.group() for m in re.finditer(rb"[^\x20\x09-\x0D]+", data))
        blocks = iter(lambda: list(islice(found, WORDS)), [])
    parts, kept = [np.empty(0, np.uint64)], []
    for block in blocks:
        words = kept + block
        if len(words) >= SHINGLE:
            parts.append(np.unique(np.array(shingles(words, SHINGLE), np.uint64)))
        kept = words[-(SHINGLE - 1) :]
    if len(parts) == 1 and kept:
        parts.append(np.array([xxh64_intdigest(b" ".join(kept), SEED)], np.uint64))
    return parts[1] if len(parts) == 2 else np.unique(np.concatenate(parts))


def mixed(hashes: np.ndarray) -> np.ndarray:
    """A row of FINGERPRINTS hashes for each: itself, then SplitMix64 of it from further and further on."""
    z = hashes[:, None] + STEPS
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    z ^= z >> np.uint64(31)
    z[:, 0] = hashes
    return z


def positional_bytes(hashes: np.ndarray) -> np.ndarray:
    """The SimHashes of a set, eight bytes each; zeros for an empty one."""
    counts = np.zeros(64 * FINGERPRINTS, np.int64)
    for at in range(0, len(hashes), 255):  # as many as a byte can count
        octets = mixed(hashes[at : at + 255]).view(np.uint8)
        counts += np.add.reduce(np.unpackbits(octets, axis=1, bitorder="little"), axis=0, dtype=np.uint8)
    return np.packbits(2 * counts > len(hashes), bitorder="little")


def lists(prints: np.ndarray) -> np.ndarray:
    """A list for each print, fingerprint and position but the last: the position's number and its byte."""
    octets = prints.reshape(len(prints), FINGERPRINTS, 8)[:, :, :7].astype(np.int64)
    return octets | (np.arange(FINGERPRINTS)[:, None] * 8 + np.arange(7)) << 8


def longer(list_: np.ndarray, octet: np.ndarray, b: int) -> np.ndarray:
    """A list's key with a second position ``b`` of the fingerprint and its byte: entries that share it meet."""
    return list_ | (b + 1) << 16 | octet.astype(np.int64) << 20


def list_keys(print_: np.ndarray, listed: int = LISTED) -> np.ndarray:
    """What a print meets others by: a key for each two bytes of an indexed fingerprint."""
    first, octets = lists(print_[None])[0, :listed], print_.reshape(FINGERPRINTS, 8)[:listed]
    return np.concatenate([longer(first[:, a], octets[:, b], b) for a in range(7) for b in range(a + 1, 8)])


def with_sets(docs: DataFrame, text_col: str) -> DataFrame:
    """The columns of ``docs`` but the text, then the node, the fingerprints and the set of each text."""
    rest = [f for f in docs.schema if f.name != text_col]
    made = [StructField("node", LongType()), StructField("print", BinaryType()), StructField("set", BinaryType())]
    schema = StructType([*rest, *made])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            nodes, prints, sets = [], [], []
            for text in batch.column(text_col).to_pylist():
                found = shingle_set(text)
                sets.append(found.tobytes())
                nodes.append(xxh64_intdigest(sets[-1], SEED))
                prints.append(positional_bytes(found).tobytes())
            made = [pa.array(np.array(nodes, np.uint64).view(np.int64)), pa.array(prints, pa.binary()), pa.array(sets, pa.binary())]
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in rest), *made], schema.names)

    return docs.mapInArrow(run, schema)


def similar(sets: list[np.ndarray], prints: np.ndarray) -> np.ndarray:
    """The first of its component for each set, pairs of at least SIMILARITY being linked; ``prints`` has the fingerprints of a set a row."""
    size = np.array([len(s) for s in sets])
    ends = np.cumsum(size)
    starts, root = ends - size, np.arange(len(sets))
    names, ids = np.unique(np.concatenate(sets), return_inverse=True)
    own, words = np.zeros(len(names), bool), prints.view(np.uint64)
    over, under = SIMILARITY
    for i in range(len(sets) - 1):
        rest = np.arange(i + 1, len(sets))
        rest = rest[(root[rest] != root[i]) & (under * np.minimum(size[rest], size[i]) >= over * np.maximum(size[rest], size[i]))]
        least = np.where(np.minimum(size[rest], size[i]) <= SMALL, FEW, MATCHES)
        rest = rest[(prints[rest] == prints[i]).sum(axis=1) >= least]  # the count filter
        rest = rest[np.bitwise_count(words[rest] ^ words[i]).sum(axis=1, dtype=np.int64) <= DISTANCE]
        if not len(rest):
            continue
        own[ids[starts[i] : ends[i]]] = True
        common = np.array([np.count_nonzero(own[ids[starts[k] : ends[k]]]) for k in rest.tolist()])
        own[ids[starts[i] : ends[i]]] = False
        near = rest[under * common >= over * (size[rest] + size[i] - common)]
        if len(near):
            merged = np.union1d(root[near], root[i])
            root[np.isin(root, merged)] = merged[0]
    return root


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (root, one, two, node, print, set), list by list, to edges within the lists."""
    now, nodes, prints, sets = None, [], [], []

    def edges() -> pa.RecordBatch:
        first, at = similar(sets, np.frombuffer(b"".join(prints), np.uint8).reshape(len(prints), -1)), np.array(nodes, np.int64)
        moved = np.flatnonzero(first != np.arange(len(at)))
        return pa.RecordBatch.from_arrays([pa.array(at[moved]), pa.array(at[first[moved]])], ["a", "b"])

    for batch in batches:
        keys = zip(*(batch.column(c).to_pylist() for c in ("root", "one", "two")), strict=True)
        for key, node, print_, found in zip(keys, batch.column("node").to_pylist(), batch.column("print").to_pylist(), batch.column("set"), strict=True):
            if key != now and nodes:
                yield edges()
                nodes, prints, sets = [], [], []
            now = key
            nodes.append(node)
            prints.append(print_)
            sets.append(np.frombuffer(found.as_py(), np.uint64))
    if nodes:
        yield edges()


def _edges(columns: list[np.ndarray]) -> pa.RecordBatch:
    """Whole lists (list, one, two, block, node, w0, w1, w2) to edges from nodes to the first of their component in the list."""
    key, one, two, block, node = columns[:5]
    words, cross, n = np.stack(columns[5:], axis=1).view(np.uint64), one != two, len(node)
    octets = words.view(np.uint8)
    new = np.ones(n, np.int64)
    new[1:] = (key[1:] != key[:-1]) | (one[1:] != one[:-1]) | (two[1:] != two[:-1])
    number, first, only, root = np.cumsum(new), key >> 8 & 7, key >> 16 & 15, np.arange(n)

    def near(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Which of the entries ``j`` are to be linked to those of ``i``, or to the only one."""
        met = np.flatnonzero((root[i] != root[j]) & (~cross[i] | (block[i] != block[j])))
        fits = np.zeros(len(j), bool)
        i = i[met] if len(i) == len(j) else i
        fits[met] = np.bitwise_count(words[i] ^ words[j[met]]).sum(axis=1, dtype=np.int64) <= NEAR
        return fits

    def link(i: int, j: int) -> None:
        while root[i] != i:
            i = root[i]
        while root[j] != j:
            j = root[j]
        root[max(i, j)] = min(i, j)

    def flat() -> None:
        while not np.array_equal(up := root[root], root):
            root[:] = up

    for b in range(1, 8):
        at = np.flatnonzero((first < b) & ((only == 0) | (only == b + 1)))
        shared = number[at] << 8 | octets[at, b]
        order = np.argsort(shared, kind="stable")
        at, shared = at[order], shared[order]
        ends = np.searchsorted(shared, shared, "right")
        starts = np.searchsorted(shared, shared, "left")
        left, long = ends - np.arange(len(at)), ends - starts > RUN
        here, far = np.flatnonzero((left > 1) & ~long), 1
        while len(here):
            i, j = at[here], at[here + far]
            fits = near(i, j)
            for x, y in zip(i[fits].tolist(), j[fits].tolist(), strict=True):
                link(x, y)
            if fits.any():
                flat()
            far += 1
            here = here[left[here] > far]
        for start in np.unique(starts[long]).tolist():
            rest = at[start : ends[start]]
            while len(rest) > 1:  # a component at a time: what is near to one of it joins, and then is asked for itself
                queue, rest = [rest[0]], rest[1:]
                while queue and len(rest):
                    i = queue.pop()
                    joined = root[rest] == root[i]
                    fits = joined | near(np.array([i]), rest)
                    for y in rest[fits & ~joined].tolist():
                        link(i, y)
                    if fits.any():
                        flat()
                        queue += rest[fits].tolist()
                        rest = rest[~fits]
    moved = np.flatnonzero(root != np.arange(n))
    return pa.RecordBatch.from_arrays([pa.array(node[moved]), pa.array(node[root[moved]])], ["a", "b"])


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of lists in order to edges, whole lists at a time."""
    held: list[np.ndarray] = []
    for batch in batches:
        columns = [c.to_numpy() for c in batch.columns]
        held = [np.concatenate(x) for x in zip(held, columns, strict=True)] if held else columns
        done = int(np.argmax((held[0] == held[0][-1]) & (held[1] == held[1][-1]) & (held[2] == held[2][-1])))  # the last list may go on
        if done:
            yield _edges([x[:done] for x in held])
            held = [x[done:] for x in held]
    if held:
        yield _edges(held)


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Rows (node, print, small) to arrays of lists, nodes, their words, and the number of the fingerprint."""
    for batch in small_batches(batches):
        prints = np.frombuffer(b"".join(batch.column("print").to_pylist()), np.uint8).reshape(batch.num_rows, -1)
        small = batch.column("small").to_numpy(zero_copy_only=False)
        row, word, at = np.nonzero(np.broadcast_to(((np.arange(FINGERPRINTS) < LISTED) | small[:, None])[:, :, None], (len(small), FINGERPRINTS, 7)))
        yield lists(prints)[row, word, at], batch.column("node").to_numpy()[row], prints.view(np.int64)[row], word


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for key, node, words, word in _entries(batches):
        three = [words[np.arange(len(word)), (word + k) % FINGERPRINTS] for k in range(3)]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (key, node, *three)], ["list", "node", "w0", "w1", "w2"])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(FINGERPRINTS * 8 * 256, np.int64)
    for key, *_ in _entries(batches):
        total += np.bincount(key, minlength=len(total))
    yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(total)), pa.array(total[total > 0])], ["list", "n"])


def candidates(marked: DataFrame) -> DataFrame:
    """(node, root) of every node near another by a list of the index, through chains."""
    size = F.octet_length("set") / 8
    nodes = marked.where("octet_length(set) > 0").select("node", "print", (size <= SMALL).alias("small"))
    nodes = nodes.groupBy("node").agg(F.first("print").alias("print"), F.first("small").alias("small"))
    nodes = materialise(few_tasks(nodes, marked), "nodes")
    many = nodes.mapInArrow(_counted, "list long, n long").groupBy("list").agg(F.sum("n").alias("n")).where(F.col("n") > LIST)
    many = [r["list"] for r in many.collect()]  # of 32,768 lists that there are
    rows = nodes.mapInArrow(_listed, "list long, node long, w0 long, w1 long, w2 long")
    shared = (rows.where(~F.col("list").isin(many)) if many else rows).withColumn("blocks", F.lit(1))
    if many:
        b = F.explode(F.sequence(F.shiftright("list", 8).bitwiseAND(F.lit(7)) + 1, F.lit(7).cast("long"))).alias("b")
        more = rows.where(F.col("list").isin(many)).select("*", b)
        # by longer(): with the second position and its byte
        more = more.withColumn("list", F.expr("list | shiftleft(b + 1, 16) | shiftleft(shiftright(w0, cast(8 * b as int)) & 255L, 20)")).drop("b")
        sizes = more.groupBy("list").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        sizes = materialise(sizes.select("list", F.ceil(F.col("n") / LIST).cast("int").alias("blocks")), "lists")
        shared = shared.unionByName(more.join(sizes, "list"))
    shared = shared.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    pairs = shared.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    pairs = pairs.select("list", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"), "block", "node", "w0", "w1", "w2")
    ordered = pairs.repartition("list", "one", "two").sortWithinPartitions("list", "one", "two", "node")
    stars = materialise(components(ordered.mapInArrow(_met, "a long, b long").distinct(), marked), "candidates")
    discard(nodes)
    return stars.unionByName(stars.select(F.col("root").alias("node"), "root").distinct())


def possible(marked: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, print, set) of the rows whose node may be in ``nodes``: a bitmap of hashes, so that only few others are shuffled."""
    bit = F.pmod(F.xxhash64("node"), F.lit(BITMAPS << 15))
    maps = nodes.select(F.shiftright(bit, 15).alias("k"), bit.bitwiseAND(F.lit((1 << 15) - 1)).alias("at"))
    maps = maps.groupBy("k").agg(F.bitmap_construct_agg("at").alias("map")).collect()  # at most BITMAPS rows of 4 KB
    held = {r["k"]: bytes(r["map"]) for r in maps}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = batch.column("bit").to_pylist()
            stay = [(m := held.get(b >> 15)) is not None and m[(b >> 3) & 4095] >> (b & 7) & 1 == 1 for b in bits]
            yield batch.filter(pa.array(stay, pa.bool_())).select(["node", "print", "set"])

    return marked.select("node", "print", "set", bit.alias("bit")).mapInArrow(run, "node long, print binary, set binary")


def links(marked: DataFrame) -> DataFrame:
    """Rows (node, print, set) to edges (a, b) that connect all nodes of at least SIMILARITY."""
    size = (F.octet_length("set") / 8).cast("long")
    rooted = materialise(few_tasks(candidates(marked), marked), "rooted")
    found = possible(marked, rooted).groupBy("node").agg(F.first("print").alias("print"), F.first("set").alias("set")).join(rooted, "node")
    found = materialise(few_tasks(found, marked), "compared")
    sizes = found.groupBy("root").agg(F.ceil(F.sum(size) / BLOCK).cast("int").alias("blocks"))
    placed = found.join(materialise(few_tasks(sizes, marked), "sizes"), "root").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    pairs = placed.select("root", "node", "print", "set", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    pairs = pairs.select("root", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"), "node", "print", "set")
    ordered = pairs.repartition("root", "one", "two").sortWithinPartitions("root", "one", "two", "node")
    return ordered.mapInArrow(_verified, "a long, b long").distinct()


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group: the smallest id, of equal ids the smallest hash of the text."""
    narrow = docs.select(F.col(id_col).alias("__id"), text_hash(whole(text_col)).alias("__text"), F.col(text_col).alias("__t"))
    marked = materialise(with_sets(narrow, "__t"), "sets")
    stars = components(links(marked), marked).withColumnRenamed("node", "star").withColumnRenamed("root", "first")
    rooted = marked.select("__id", "__text", "node").join(stars, F.col("node") == F.col("star"), "left")
    rooted = rooted.select("__id", "__text", F.coalesce("first", "node").alias("root"))
    rooted = materialise(few_tasks(rooted, marked), "rooted")
    discard(marked)
    return few_tasks(one_each(docs, rooted, id_col, text_col), docs)
