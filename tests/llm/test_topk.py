"""Ranks against brute force, over vectors with ties, odd lengths and missing parts."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import topk


def brute(rows, k):
    usable = [(i, [math.floor(64 * float(np.float32(x))) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    asked = {}
    for i, v in usable:
        if i % 4 == 0:
            asked[i] = min(asked.get(i, v), v)
    out = []
    for q, v in asked.items():
        scores = sorted((-sum(a * b for a, b in zip(v, w, strict=False)), i) for i, w in usable if i != q)
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])]
    return sorted(out)


def vectors():
    r = np.random.default_rng(4)
    rows = [(i, [float(np.float32(x)) for x in r.normal(0, 0.3, 8)]) for i in range(150)]
    rows += [(i, [0.25] * 8) for i in range(150, 230)]  # a large group of equal vectors
    rows += [(8, [0.5] * 8), (8, [0.5] * 8), (301, [0.1]), (304, []), (305, None), (308, [None, 1.0]), (309, [float("nan")]), (312, [float("inf")]), (None, [1.0] * 8)]
    return rows


@pytest.mark.parametrize(("k", "group", "block", "bins"), [(20, 4096, 4096, 256), (5, 16, 7, 3), (300, 50, 20, 16)])
def test_equals_brute_force(spark, monkeypatch, k, group, block, bins):
    monkeypatch.setattr(topk, "GROUP", group)
    monkeypatch.setattr(topk, "BLOCK", block)
    monkeypatch.setattr(topk, "BINS", bins)
    df = spark.createDataFrame([(*r, 1) for r in vectors()], "vec_id long, embedding array<float>, id int")
    got = topk.top_k(df, F.col("vec_id") % 4 == 0, k)
    assert sorted(tuple(r) for r in got.collect()) == brute(vectors(), k)


def test_scores_beyond_double_precision(spark):
    rows = [(0, [1.0e9, 1.0]), (2, [2.0e9, 1.0]), (1, [2.0e9, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = topk.top_k(df, F.col("vec_id") == 0, 2, scale=1).orderBy("rank").collect()
    assert [(r["vec_id"], r["score"]) for r in got] == [(1, 2 * 10**18 + 2), (2, 2 * 10**18 + 1)]


def test_empty(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.top_k(df, F.col("vec_id") % 4 == 0).count() == 0
