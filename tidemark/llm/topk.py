"""Exact top-k inner products by distributed histogram selection.

Every query meets every candidate, in cells: queries are dealt into blocks and
candidates into groups of bounded size, and a cogroup of a block and a group scores
one cell with a matrix product.  Scores are integers within a bound that the
largest norms give, so ``BINS`` bins a round narrow each query's k-th score down:
a round sums the cells' histograms per query, finds the bin that holds the k-th
score and how many scores lie above, and the next round divides that bin, until a
bin is one score wide.  A last pass sends the scores above it and, of those equal
to it, as many of the smallest ids as are needed; so ties cost no more than k rows
a cell and query.

A cell leaves out bins below its own k-th score: the global one can't be lower.
All cells are alike in size whatever the vectors, equal vectors included, because
rows are dealt by position.

Defined results:

* vectors that are null, or hold null or non-finite components, and null ids take
  no part; an empty vector scores 0 with all;
* vectors of unequal length: the shorter is continued with zeros;
* a query id that several rows share is asked once, with the smallest vector; every
  row is a candidate, but those with the query's own id;
* ties go to the smaller id; equal ids with equal scores take consecutive ranks;
* fewer than k candidates: all of them; an empty table gives an empty table;
* scores have to fit 64 bits; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from math import ceil

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import materialise

#: Candidates of a cell, queries of a cell, queries scored at once within it.
GROUP, BLOCK, SLAB = 4096, 4096, 512
BINS = 256


def quantised(vector: Column, scale: int) -> Column:
    """floor(scale * x) of each component."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))))


def usable(vector: Column) -> Column:
    ok = lambda x: F.coalesce(~F.isnan(x) & (F.abs(x.cast("double")) != float("inf")), F.lit(False))
    return F.coalesce(F.forall(vector, ok), F.lit(False))


def _matrix(vectors: pd.Series, dims: int, exact: bool) -> np.ndarray:
    out = np.zeros((len(vectors), dims), np.float64 if exact else object)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v if exact else [int(x) for x in v]
    return out


def _scores(left: pd.DataFrame, right: pd.DataFrame, exact: bool):
    """(queries of a slab, scores), own ids at the lowest value there is."""
    dims = max(max(map(len, left["v"])), max(map(len, right["v"])), 1)
    c, ids = _matrix(left["v"], dims, exact), left["id"].to_numpy()
    lowest = -np.inf if exact else -(1 << 63)
    for at in range(0, len(right), SLAB):
        some = right.iloc[at : at + SLAB]
        s = _matrix(some["v"], dims, exact) @ c.T
        order = np.argsort(ids, kind="stable")
        want = some["id"].to_numpy()
        lo, hi = np.searchsorted(ids, want, "left", order), np.searchsorted(ids, want, "right", order)
        for i in np.flatnonzero(hi > lo):
            s[i, order[lo[i] : hi[i]]] = lowest
        yield some, s, lowest


def _top_bins(k: int, wide: int, exact: bool):
    """The part of a cell's histogram that can matter: per query, its bins from the top until ``need`` are counted."""

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(left) and len(right):
            for some, s, lowest in _scores(left, right, exact):
                lo, hi, need = (some[c].to_numpy() for c in ("lo", "hi", "need"))
                if s.shape[1] > k:  # lower scores can't be among the k highest
                    own = -np.partition(-s, k - 1, axis=1)[:, k - 1] if exact else np.sort(s, axis=1)[:, -k]
                    floor = np.maximum(lo, own)
                else:
                    floor = lo
                row, col = np.nonzero((s >= floor[:, None]) & (s < hi[:, None]) & (s > lowest))
                if not len(row):
                    continue
                bin_ = ((s[row, col].astype(np.int64) - lo[row]) // wide).astype(np.int64)
                keys, counts = np.unique(np.stack([row, -bin_]), axis=1, return_counts=True)  # by row, bins from the top
                before = np.cumsum(counts) - counts
                start = np.searchsorted(keys[0], keys[0], "left")
                use = before - before[start] < need[keys[0]]
                found.append(pd.DataFrame({"id": some["id"].to_numpy()[keys[0][use]], "bin": -keys[1][use], "n": counts[use]}))
        return pd.concat(found) if found else pd.DataFrame({"id": [], "bin": [], "n": []}).astype("int64")

    return run


def _top_rows(k: int, exact: bool):
    """Scores above a query's k-th, and the smallest ids of those equal to it."""

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(left) and len(right):
            left = left.sort_values("id", kind="stable", ignore_index=True)
            ids = left["id"].to_numpy()
            for some, s, lowest in _scores(left, right, exact):
                kth, need = some["lo"].to_numpy(), some["need"].to_numpy()
                row, col = np.nonzero((s >= kth[:, None]) & (s > lowest))
                value = s[row, col].astype(np.int64)
                tie = value == kth[row]
                nth = np.cumsum(tie) - tie  # ties so far, in order of row and id
                first = np.concatenate([nth, [0]])[np.searchsorted(row, row, "left")]
                use = ~tie | (nth - first < need[row])
                found.append(pd.DataFrame({"query_id": some["id"].to_numpy()[row[use]], "vec_id": ids[col[use]], "score": value[use]}))
        return pd.concat(found) if found else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")

    return run


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, scale: int = 64, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k best of all rows but its own."""
    rows = vectors.where(F.col(id_col).isNotNull() & usable(F.col(vector_col)))
    rows = rows.select(F.col(id_col).cast("long").alias("id"), quantised(F.col(vector_col), scale).alias("v"), is_query.alias("q"))
    rows = materialise(rows, "vectors")
    norm = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    n, n_queries, most, most_query = rows.agg(F.count(F.lit(1)), F.count_if("q"), F.max(norm), F.max(F.when(F.col("q"), norm))).first()
    bound = int((most or 0.0) ** 0.5 * (most_query or 0.0) ** 0.5 * (1 + 1e-9)) + 2
    exact = bound < 1 << 53
    groups, blocks = max(1, ceil(n / GROUP)), max(1, ceil(n_queries / BLOCK))
    dealt = F.pmod(F.monotonically_increasing_id(), F.lit(groups)).cast("int")
    candidates = rows.select("id", "v", dealt.alias("g"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("b")).groupBy("b", "g")
    queries = rows.where("q").groupBy("id").agg(F.min("v").alias("v"))
    queries = materialise(queries.withColumn("b", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")), "queries")

    def cells(state: DataFrame):
        asked = queries.join(state, "id").select("*", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("g"))
        return candidates.cogroup(asked.groupBy("b", "g"))

    long = lambda x: F.lit(x).cast("long")
    state = queries.select("id", long(-bound).alias("lo"), long(bound + 1).alias("hi"), long(k).alias("need"))
    wide = 2 * bound + 1
    while wide > 1:
        wide = ceil(wide / BINS)
        counts = cells(state).applyInPandas(_top_bins(k, wide, exact), "id long, bin long, n long").groupBy("id", "bin").agg(F.sum("n").alias("n"))
        from_top = F.sum("n").over(W.partitionBy("id").orderBy(F.col("bin").desc()))
        reached = counts.withColumn("upto", from_top).join(state, "id").where(F.col("upto") >= F.col("need"))
        hit = reached.groupBy("id").agg(F.max(F.struct("bin", "upto", "n")).alias("h"))  # the highest bin that reaches it
        lo = F.col("lo") + F.col("h.bin") * wide
        narrowed = state.join(hit, "id", "left")
        # fewer than k candidates in all: nothing is reached, and every score is taken
        state = narrowed.select(
            "id",
            F.coalesce(lo, F.lit(-bound - 1)).cast("long").alias("lo"),
            F.coalesce(lo + wide, F.lit(-bound - 1)).cast("long").alias("hi"),
            F.when(F.col("h").isNotNull(), F.col("need") - (F.col("h.upto") - F.col("h.n"))).otherwise(F.lit(0)).cast("long").alias("need"),
        )
        state = materialise(state, "narrowed")
    found = cells(state).applyInPandas(_top_rows(k, exact), "query_id long, vec_id long, score long")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id")))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
