"""Byte-level BPE encoding and decoding by a table of ranks.

Each piece that the split pattern finds is merged by itself.  A segment tree
over the piece's byte positions keeps, in every node, the smallest ``(rank,
position)`` of the pairs that start below it, so the root is the leftmost pair
of minimum rank.  A merge changes three leaves (the pair's place, its dead
right neighbour and the live left neighbour, whose pair changed), each a point
update along one path: O(log n).  Pieces of like length are merged together, one
lane of numpy arrays each; long ones alone, in plain lists.

Texts are cut into pieces in blocks, so a text of any length takes bounded
memory besides its own; results of pieces are kept up to ``CACHE`` entries.

Defined results:

* null or empty text: no ids, digests of the empty string;
* rows are independent: repeated ids and rows just repeat;
* ties of rank are merged leftmost first, as the tokenizer does; a piece that is
  a token itself is that token;
* an empty table gives an empty table; other columns stay out of the result.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator
from itertools import chain, islice

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from .common import small_batches

#: Pieces whose ids are kept at most; pieces up to LANES bytes are merged in lanes; pieces handled at once.
CACHE, LANES, BLOCK = 500_000, 256, 100_000
NONE = np.iinfo(np.int64).max


class Ranks:
    """A vocabulary of byte strings by rank, which is also their id."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            pairs = [line.split() for line in f if line.strip()]
        self.rank = {base64.b64decode(a): int(b) for a, b in pairs}
        self.token = {b: a for a, b in self.rank.items()}
        self.split = regex.compile(pattern)
        self.byte = np.array([self.rank[bytes([b])] for b in range(256)], np.int64)
        self.pair = {}
        for whole, r in self.rank.items():
            for i in range(1, len(whole)):
                a, b = self.rank.get(whole[:i]), self.rank.get(whole[i:])
                if a is not None and b is not None:
                    self.pair[a << 32 | b] = r
        keys = np.fromiter(self.pair, np.int64, len(self.pair))
        order = np.argsort(keys)
        self.keys, self.values = keys[order], np.fromiter(self.pair.values(), np.int64, len(keys))[order]
        self.said = {r: str(r) for r in self.token}
        self.bytes_of = {str(r): t for r, t in self.token.items()}
        self.cache: dict[str, str] = {}

    def _ranks_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair's merge, NONE where there is none."""
        want = a << 32 | b
        at = np.minimum(np.searchsorted(self.keys, want), len(self.keys) - 1)
        return np.where(self.keys[at] == want, self.values[at], NONE)

    def _merge_lanes(self, words: list[bytes], cap: int) -> list[list[int]]:
        """Ids of each word; all are at most ``cap`` (a power of two) bytes long."""
        n, bits = len(words), cap.bit_length() - 1
        length = np.fromiter(map(len, words), np.int64, n)
        raw = np.zeros((n, cap), np.uint8)
        raw[np.arange(cap) < length[:, None]] = np.frombuffer(b"".join(words), np.uint8)
        ids = np.where(np.arange(cap) < length[:, None], self.byte[raw], -1)
        right = np.tile(np.arange(1, cap + 1), (n, 1))
        left = np.tile(np.arange(-1, cap - 1), (n, 1))
        tree = np.full((n, 2 * cap), NONE, np.int64)
        has = np.arange(1, cap) < length[:, None]
        first = np.full((n, cap - 1), NONE, np.int64)
        first[has] = self._ranks_of(ids[:, :-1][has], ids[:, 1:][has])
        tree[:, cap : 2 * cap - 1] = np.where(first == NONE, NONE, (first << bits) | np.arange(cap - 1))
        for level in range(bits - 1, -1, -1):
            lo = 1 << level
            tree[:, lo : 2 * lo] = np.minimum(tree[:, 2 * lo : 4 * lo : 2], tree[:, 2 * lo + 1 : 4 * lo : 2])
        ids, right, left, flat = ids.ravel(), right.ravel(), left.ravel(), tree.ravel()
        rows = np.arange(n)
        while True:
            root = flat[rows * (2 * cap) + 1]
            open_ = root != NONE
            rows, root = rows[open_], root[open_]
            if not len(rows):
                break
            base, rank, at = rows * cap, root >> bits, root & (cap - 1)
            dead = right[base + at]
            after = right[base + dead]
            before = left[base + at]
            ids[base + at], ids[base + dead], right[base + at] = rank, -1, after
            inner = after < length[rows]
            left[base[inner] + after[inner]] = at[inner]
            leaf_at = np.full(len(rows), NONE, np.int64)
            found = self._ranks_of(rank[inner], ids[base[inner] + after[inner]])
            leaf_at[inner] = np.where(found == NONE, NONE, (found << bits) | at[inner])
            self._update(flat, rows, cap, dead, np.full(len(rows), NONE, np.int64))
            self._update(flat, rows, cap, at, leaf_at)
            has = before >= 0
            if has.any():
                found = self._ranks_of(ids[base[has] + before[has]], rank[has])
                self._update(flat, rows[has], cap, before[has], np.where(found == NONE, NONE, (found << bits) | before[has]))
        alive = ids.reshape(n, cap) >= 0
        ends = np.cumsum(alive.sum(axis=1))
        out = ids[alive.ravel()].tolist()
        return [out[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]

    @staticmethod
    def _update(flat: np.ndarray, rows: np.ndarray, cap: int, leaf: np.ndarray, value: np.ndarray) -> None:
        """Set one leaf of each lane's tree and its path up to the root."""
        base, node = rows * (2 * cap), leaf + cap
        flat[base + node] = value
        while cap > 1:
            value = np.minimum(value, flat[base + (node ^ 1)])
            node = node >> 1
            flat[base + node] = value
            cap >>= 1

    def _merge_long(self, word: bytes) -> list[int]:
        """The same for one word of any length."""
        n, pair = len(word), self.pair
        cap = 1 << (n - 1).bit_length()
        bits, none = cap.bit_length() - 1, int(NONE)
        ids, right, left = [int(self.byte[b]) for b in word], list(range(1, n + 1)), list(range(-1, n - 1))
        tree = [none] * (2 * cap)
        for i in range(n - 1):
            r = pair.get(ids[i] << 32 | ids[i + 1])
            if r is not None:
                tree[cap + i] = r << bits | i
        for i in range(cap - 1, 0, -1):
            tree[i] = min(tree[2 * i], tree[2 * i + 1])

        def update(node: int, value: int) -> None:
            tree[node] = value
            while node > 1:
                value = min(tree[node], tree[node ^ 1])
                node >>= 1
                if tree[node] == value:
                    break
                tree[node] = value

        while (root := tree[1]) != none:
            rank, at = root >> bits, root & (cap - 1)
            dead, before = right[at], left[at]
            after = right[dead]
            ids[at], ids[dead], right[at] = rank, -1, after
            r = None
            if after < n:
                left[after] = at
                r = pair.get(rank << 32 | ids[after])
            update(cap + dead, none)
            update(cap + at, none if r is None else r << bits | at)
            if before >= 0:
                r = pair.get(ids[before] << 32 | rank)
                update(cap + before, none if r is None else r << bits | before)
        return [i for i in ids if i >= 0]

    def merge(self, words: list[bytes]) -> list[list[int]]:
        """Ids of each word."""
        out: list[list[int] | None] = [None] * len(words)
        lanes: dict[int, list[int]] = {}
        for i, w in enumerate(words):
            if (r := self.rank.get(w)) is not None:
                out[i] = [r]
            elif len(w) > LANES:
                out[i] = self._merge_long(w)
            else:
                lanes.setdefault(1 << (len(w) - 1).bit_length(), []).append(i)
        for cap, which in lanes.items():
            step = max(64, (1 << 19) // cap)
            for k in range(0, len(which), step):
                some = which[k : k + step]
                for i, ids in zip(some, self._merge_lanes([words[i] for i in some], cap), strict=True):
                    out[i] = ids
        return out

    def learn(self, pieces: Iterable[str]) -> None:
        """Puts the pieces' ids, as text, into the cache."""
        here = set(pieces)
        listed = list(here.difference(self.cache))
        if len(self.cache) + len(listed) > CACHE:
            self.cache.clear()
            listed = list(here)
        said = self.said
        for piece, ids in zip(listed, self.merge([p.encode() for p in listed]), strict=True):
            self.cache[piece] = " ".join([said[i] for i in ids])

    def encode(self, text: str) -> Iterator[str]:
        """Ids of a text as text, joined by one space, BLOCK pieces at a time."""
        found = (m.group() for m in self.split.finditer(text))
        while block := list(islice(found, BLOCK)):
            self.learn(block)
            yield " ".join(map(self.cache.__getitem__, block))

    def decode(self, ids: str) -> bytes:
        """Bytes of ids given as text, joined by one space."""
        return b"".join(map(self.bytes_of.__getitem__, ids.split(" "))) if ids else b""


_loaded: dict[tuple[str, str], Ranks] = {}


def ranks(path: str, pattern: str) -> Ranks:
    """The vocabulary at ``path``, loaded once per worker."""
    if (path, pattern) not in _loaded:
        _loaded[path, pattern] = Ranks(path, pattern)
    return _loaded[path, pattern]


def _groups(texts: list[str], most: int = 1_000_000) -> Iterator[list[str]]:
    """The texts in order, in lists of about ``most`` characters."""
    group, size = [], 0
    for t in texts:
        group.append(t)
        size += len(t)
        if size >= most:
            yield group
            group, size = [], 0
    if group:
        yield group


def _encoded(vocabulary: Ranks, texts: list[str]) -> Iterator[Iterable[str]]:
    """The id blocks of each text; new pieces of many short texts are merged together."""
    cut = vocabulary.split.findall
    for group in _groups(texts):
        pieces = [cut(t) if len(t) <= 4 * BLOCK else None for t in group]
        vocabulary.learn(chain.from_iterable(p for p in pieces if p))
        done = [None if p is None else (" ".join(map(vocabulary.cache.__getitem__, p)),) for p in pieces]
        for t, ids in zip(group, done, strict=True):
            yield vocabulary.encode(t) if ids is None else ids


def encode(docs: DataFrame, path: str, pattern: str, text_col: str = "text") -> DataFrame:
    """``docs`` with ``token_ids`` array<int>; the other columns stay.  A column of that name is replaced."""
    kept = [c for c in docs.columns if c != "token_ids"]
    schema = StructType([*docs.select(*kept).schema, StructField("token_ids", ArrayType(IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = ranks(path, pattern)
        for batch in small_batches(batches):
            found = _encoded(vocabulary, [t or "" for t in batch.column(text_col).to_pylist()])
            ids = pa.array([np.fromstring(" ".join(b for b in blocks if b), np.int32, sep=" ") for blocks in found], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, ids], [*batch.schema.names, "token_ids"])

    return docs.select(*kept).mapInArrow(run, schema)


def decode(df: DataFrame, path: str, pattern: str, ids_col: str = "token_ids", out: str = "decoded") -> DataFrame:
    """``df`` with the bytes that the ids stand for, as binary; null ids give empty bytes."""

    @F.pandas_udf("binary")
    def run(ids: pd.Series) -> pd.Series:
        vocabulary = ranks(path, pattern)
        return pd.Series([b"" if x is None else b"".join(vocabulary.token[int(i)] for i in x) for x in ids], dtype=object)

    return df.withColumn(out, run(F.col(ids_col)))


def digests(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256): what encoding and decoding the whole text gives, without the ids."""
    added = [StructField("n_tokens", LongType()), StructField("ids_sha256", StringType()), StructField("decoded_sha256", StringType())]
    schema = StructType([*docs.select(id_col).schema, *added])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = ranks(path, pattern)
        for batch in small_batches(batches):
            counts, ids_sha, plain_sha = [], [], []
            for blocks in _encoded(vocabulary, [t or "" for t in batch.column(text_col).to_pylist()]):
                n, said, plain, sep = 0, hashlib.sha256(), hashlib.sha256(), b""
                for ids in blocks:
                    if ids:
                        n += ids.count(" ") + 1
                        said.update(sep + ids.encode())
                        plain.update(vocabulary.decode(ids))
                        sep = b" "
                counts.append(n)
                ids_sha.append(said.hexdigest())
                plain_sha.append(plain.hexdigest())
            columns = [batch.column(id_col), pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(plain_sha, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return docs.select(id_col, text_col).mapInArrow(run, schema)
