"""A byte-level convolutional network in numpy that scores a text's quality.

The whole text's UTF-8 bytes go through it.  First layer: ``FILTERS`` learned
filters over four bytes at every second byte, each a sum of looked-up weights,
rectified.  Their means, and for every lag up to ``LAGS`` the share of bytes equal to the byte that far
before, over chunks of ``CHUNK`` bytes that overlap by half, are a chunk's vector
(of the lags the largest share).  Second layer: ``HIDDEN`` learned filters over
chunk vectors, rectified and max-pooled over all chunks of the text.  A logistic
unit combines the maxima into one probability.

It is fitted on the driver, on a bounded sample: of each class the ``per_class``
labelled documents lowest by a hash of their id, without those longer than
``max_bytes``; examples are weighed so that the classes count as in all labels.
Scoring is one pass over the texts in Arrow batches with no shuffle.

Defined results:

* null or empty text: one empty chunk, the same score for all of them;
* null id: not held out, and never used for fitting; rows that share an id or a text
  get the score of their own text;
* labels without a quality are ignored; of repeated labels the lower quality counts;
  without any label, the score is 0.5;
* zero bytes in a text match no other byte;
* an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .common import small_batches

CHUNK, LAGS, FILTERS, HIDDEN, WIDTH = 64, 24, 8, 16, 4
HALF = CHUNK // 2
#: Bytes of one step of scoring; larger ones leave the cache and take several times as long.
STEP = 1 << 16
#: Scale of the share of repeated bytes beside the means, so that both learn at one pace.
REPEAT = 4.0
#: Weight of a zero byte at a filter's first place: nothing is found where no text is.
_NOTHING = -1e4


@dataclass
class Layout:
    """Texts as one byte array of half chunks, zeros before and after each text."""

    data: np.ndarray  #: bytes
    chunk: np.ndarray  #: first half chunk of every chunk
    owner: np.ndarray  #: text of every chunk; ascending


def lay_out(texts: list[bytes]) -> Layout:
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    halves = np.maximum(2, -(-(sizes + WIDTH - 1) // HALF))
    starts = np.cumsum(halves + 1) - halves  # one half chunk of zeros before each
    data = np.zeros((int(halves.sum()) + len(texts) + 1) * HALF, np.uint8)
    for t, at in zip(texts, (starts * HALF).tolist(), strict=True):
        data[at : at + len(t)] = np.frombuffer(t, np.uint8)
    chunks = halves - 1
    owner = np.repeat(np.arange(len(texts)), chunks)
    first = np.arange(int(chunks.sum())) - np.repeat(np.cumsum(chunks) - chunks, chunks)
    return Layout(data, np.repeat(starts, chunks) + first, owner)


def _repetition(lay: Layout, real: np.ndarray) -> np.ndarray:
    """For every chunk, the most bytes that equal the byte a lag before, of all lags."""
    most = np.zeros(len(lay.chunk), np.uint8)
    same = np.zeros(len(lay.data), bool)
    for lag in range(2, LAGS + 1):
        np.equal(lay.data[lag:], lay.data[:-lag], out=same[lag:])
        same[:lag] = False
        same &= real
        halves = np.bitwise_count(np.packbits(same).view(np.uint32))  # a half chunk is 32 bytes
        np.maximum(most, halves[lay.chunk] + halves[lay.chunk + 1], out=most)
    return most


@dataclass
class Net:
    """Weights of the network."""

    table: np.ndarray  #: WIDTH x 256 x FILTERS
    bias: np.ndarray
    second: np.ndarray  #: (FILTERS + 1) x HIDDEN
    second_bias: np.ndarray
    last: np.ndarray
    last_bias: float

    @staticmethod
    def initial(seed: int = 3) -> Net:
        r = np.random.default_rng(seed)
        table = r.normal(0, 0.3, (WIDTH, 256, FILTERS)).astype(np.float32)
        table[0, 0] = _NOTHING
        second = r.normal(0, 0.5, (FILTERS + 1, HIDDEN)).astype(np.float32)
        return Net(table, np.zeros(FILTERS, np.float32), second, np.zeros(HIDDEN, np.float32), r.normal(0, 0.3, HIDDEN).astype(np.float32), 0.0)

    def pairs(self) -> list[np.ndarray]:
        """The first layer's weights by pairs of bytes, the first byte in the low bits."""
        low, high = np.arange(1 << 16) & 255, np.arange(1 << 16) >> 8
        tables = [self.table[w][low] + self.table[w + 1][high] for w in range(0, WIDTH, 2)]
        tables[0] += self.bias
        return tables

    @staticmethod
    def bytes_layer(data: np.ndarray, pairs: list[np.ndarray]) -> np.ndarray:
        """Rectified filters at every second byte."""
        two = data.view("<u2")
        h = pairs[0].take(two, axis=0)
        for k in range(1, len(pairs)):
            h[:-k] += pairs[k].take(two[k:], axis=0)
        return np.maximum(h, 0, out=h)

    @staticmethod
    def chunk_vectors(lay: Layout, filters: np.ndarray, repeats: np.ndarray, real: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Means over chunks and the number of real bytes of each."""
        sums = np.add.reduce(filters.reshape(-1, HALF // 2, FILTERS), axis=1)
        counts = np.bitwise_count(np.packbits(real).view(np.uint32)).astype(np.float32)
        size = np.maximum(counts[lay.chunk] + counts[lay.chunk + 1], 1)
        means = 2 * (sums[lay.chunk] + sums[lay.chunk + 1]) / size[:, None]
        return np.concatenate([means, (REPEAT * repeats / size)[:, None]], axis=1).astype(np.float32), size

    def pooled(self, vectors: np.ndarray, starts: np.ndarray) -> np.ndarray:
        return np.maximum.reduceat(np.maximum(vectors @ self.second + self.second_bias, 0), starts, axis=0)

    def probability(self, maxima: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(maxima @ self.last + self.last_bias, -30, 30)))

    def score(self, texts: list[bytes]) -> np.ndarray:
        """Probability of good quality of each text.  A text longer than STEP is pooled over overlapping parts."""
        parts, owner = [], []
        for i, t in enumerate(texts):
            step = STEP - CHUNK  # parts overlap by a chunk, so that no chunk is cut
            for at in range(0, max(1, len(t) - CHUNK), step):
                parts.append(t[at : at + STEP])
                owner.append(i)
        maxima = np.zeros((len(texts), HIDDEN), np.float32)
        k, pairs = 0, self.pairs()
        while k < len(parts):
            size, to = 0, k
            while to < len(parts) and (size == 0 or size + len(parts[to]) <= STEP):
                size, to = size + len(parts[to]), to + 1
            lay = lay_out(parts[k:to])
            real = lay.data != 0
            vectors, _ = self.chunk_vectors(lay, self.bytes_layer(lay.data, pairs), _repetition(lay, real), real)
            starts = np.flatnonzero(np.diff(lay.owner, prepend=-1))
            np.maximum.at(maxima, owner[k:to], self.pooled(vectors, starts))
            k = to
        return self.probability(maxima).astype(np.float64)


def fit(texts: list[bytes], labels: np.ndarray, weights: np.ndarray, epochs: int = 20, batch_bytes: int = 60_000, rate: float = 0.02, seed: int = 3) -> Net:
    """Adam on the weighted cross-entropy, gradients by hand; the batches stay, their order changes."""
    net, r = Net.initial(seed), np.random.default_rng(seed)
    batches, some, size = [], [], 0
    for i in r.permutation(len(texts)).tolist():
        some.append(i)
        size += len(texts[i])
        if size >= batch_bytes:
            batches, some, size = [*batches, some], [], 0
    made = []
    for some in [*batches, some] if some else batches:
        lay = lay_out([texts[i] for i in some])
        real = lay.data != 0
        made.append((lay, real, _repetition(lay, real), np.flatnonzero(np.diff(lay.owner, prepend=-1)), labels[some], weights[some]))
    names = ["table", "bias", "second", "second_bias", "last", "last_bias"]
    first = {n: np.zeros_like(getattr(net, n), dtype=np.float64) for n in names}
    second = {n: np.zeros_like(getattr(net, n), dtype=np.float64) for n in names}
    step, mean_weight = 0, float(np.mean(weights))
    for epoch in range(epochs):
        for k in r.permutation(len(made)).tolist():
            lay, real, repeats, starts, y, w = made[k]
            filters = net.bytes_layer(lay.data, net.pairs())
            vectors, count = net.chunk_vectors(lay, filters, repeats, real)
            hidden = vectors @ net.second + net.second_bias
            maxima = np.maximum.reduceat(np.maximum(hidden, 0), starts, axis=0)
            miss = (net.probability(maxima) - y) * w / (mean_weight * len(y))
            grads = {"last": maxima.T @ miss, "last_bias": miss.sum()}
            at_max = (hidden == maxima[lay.owner]) & (hidden > 0)
            ties = np.maximum(np.add.reduceat(at_max, starts, axis=0, dtype=np.float32), 1)
            d_hidden = at_max * (miss[:, None] * net.last / ties)[lay.owner]
            grads["second"], grads["second_bias"] = vectors.T @ d_hidden, d_hidden.sum(axis=0)
            d_sums = 2 * (d_hidden @ net.second.T)[:, :FILTERS] / count[:, None]
            d_half = np.zeros((len(lay.data) // HALF, FILTERS))
            np.add.at(d_half, lay.chunk, d_sums)
            np.add.at(d_half, lay.chunk + 1, d_sums)
            d_place = np.repeat(d_half, HALF // 2, axis=0) * (filters > 0)
            grads["bias"] = d_place.sum(axis=0)
            grads["table"] = np.zeros(net.table.shape)
            for p in range(WIDTH):
                here = lay.data[p::2][: len(d_place) - p // 2]
                for f in range(FILTERS):
                    grads["table"][p, :, f] = np.bincount(here, weights=d_place[: len(here), f], minlength=256)
            step += 1
            pace = rate * (1 - epoch / epochs)
            for n in names:
                g = np.asarray(grads[n], np.float64)
                first[n] = 0.9 * first[n] + 0.1 * g
                second[n] = 0.999 * second[n] + 0.001 * g * g
                change = pace * (first[n] / (1 - 0.9**step)) / (np.sqrt(second[n] / (1 - 0.999**step)) + 1e-8)
                old = getattr(net, n)
                setattr(net, n, float(old - change) if n == "last_bias" else (old - change).astype(np.float32))
            net.table[0, 0] = _NOTHING
    return net


def held_out(id_col: str | Column) -> Column:
    """Whether a document is in the part whose labels are never used."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.coalesce(F.crc32(c.cast("string")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, per_class: int = 600, max_bytes: int = 16_384, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Net | None:
    """Fit on at most ``2 * per_class`` labelled documents of at most ``max_bytes`` bytes each."""
    marks = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(id_col))
    marks = marks.groupBy(F.col(id_col).alias("__id")).agg(F.min(label_col).alias("__y"))
    share = {r["__y"]: r["count"] for r in marks.groupBy("__y").count().collect()}
    if not share:
        return None
    low = F.xxhash64(F.lit(5), "__id")
    chosen = [marks.where(F.col("__y") == y).orderBy(low, "__id").limit(per_class) for y in sorted(share)]
    picked = chosen[0] if len(chosen) == 1 else chosen[0].unionByName(chosen[1])
    rows = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__t")).where(F.octet_length("__t") <= max_bytes)
    rows = rows.join(F.broadcast(picked), "__id")  # at most 2 * per_class rows of two numbers
    sample = rows.dropDuplicates(["__id"]).orderBy(low, "__id").limit(2 * per_class).collect()
    if not sample:
        return None
    y = np.array([r["__y"] for r in sample], np.float64)
    have = {k: max(1, int((y == k).sum())) for k in share}
    weight = np.array([share[int(v)] / have[int(v)] for v in y])
    return fit([r["__t"].encode() for r in sample], y, weight)


def score(docs: DataFrame, net: Net | None, id_col: str = "doc_id", text_col: str = "text", out: str = "score") -> DataFrame:
    """All columns of ``docs`` and ``out``, the probability of good quality."""
    kept = [c for c in docs.columns if c != out]
    schema = StructType([*docs.select(*kept).schema, StructField(out, DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            texts = [(t or "").encode() for t in batch.column(text_col).to_pylist()]
            found = np.full(len(texts), 0.5) if net is None else net.score(texts)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.float64())], schema.names)

    return docs.select(*kept).mapInArrow(run, schema)
