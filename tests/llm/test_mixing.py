"""Targets against a plain waterfill, totals against targets, and the defined cases."""

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.llm import mixing, registry


def plain_targets(sizes, weights=(1, 2, 3), most=3):
    """sizes: source -> words; excess goes to the open sources until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [s for s in sizes if s is None]
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    total, done = sum(sizes.values()), {}
    while True:
        rest = total - sum(done.values())
        open_ = [s for s in names if s not in done]
        if not open_:
            return done
        share = {s: rest * weight[s] / sum(weight[x] for x in open_) for s in open_}
        above = [s for s in open_ if share[s] > most * sizes[s]]
        if not above:
            return done | share
        done |= {s: most * sizes[s] for s in above}


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def test_targets_and_totals(spark, sf):
    import pyarrow.parquet as pq

    docs = {d["doc_id"]: d for d in pq.read_table(f"{sf}/documents.parquet").to_pylist()}
    got = registry.op6_mixing(spark, sf).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(docs)
    sizes, taken = defaultdict(int), defaultdict(int)
    for d in docs.values():
        sizes[d["source"]] += words(d["text"])
    want = plain_targets(sizes)
    for r in got:
        source = docs[r["doc_id"]]["source"]
        assert r["size"] == words(docs[r["doc_id"]]["text"])
        assert r["source_size"] == sizes[source]
        assert abs(r["target"] - want[source]) <= 1e-6 * max(1, want[source])
        assert r["taken"] <= 3 * r["size"]
        taken[source] += r["taken"]
    for source, target in want.items():  # by the bound: half of the shortest document left out
        own = [(r["size"], docs[r["doc_id"]]["doc_id"]) for r in got if docs[r["doc_id"]]["source"] == source and r["size"]]
        assert abs(target - taken[source]) <= max(own)[0] / 2 + 1e-6
        assert abs(target - taken[source]) <= 0.2 * target
    assert sorted(map(tuple, got)) == sorted(map(tuple, registry.op6_mixing(spark, sf).collect()))


def plain_mix(rows, u, max_repeats=3):
    """A plain Pareto sampler: rows (id, text, source) and u of (id, text), to copies of (id, text, source)."""
    size = {r: words(r[1]) for r in rows}
    counted, source_size = Counter(rows), defaultdict(int)
    for r, n in counted.items():
        source_size[r[2]] += n * size[r]
    out = {}
    for source, target in plain_targets(source_size).items():
        own = [r for r in counted if r[2] == source]
        expected = lambda c: sum(counted[r] * size[r] * min(max_repeats, c * size[r].bit_length()) for r in own)  # noqa: B023, E731
        low, high = 0.0, float(max_repeats)
        for _ in range(200):
            mid = (low + high) / 2
            low, high = (mid, high) if expected(mid) < target else (low, mid)
        times = {r: min(float(max_repeats), high * size[r].bit_length()) for r in own}
        out |= {r: int(times[r] + 1e-9) if size[r] else 0 for r in own}
        room = target - sum(counted[r] * size[r] * out[r] for r in own)
        part = {r: times[r] - out[r] for r in own if size[r] and times[r] - out[r] > 1e-9}
        odds = {r: u[r[:2]] / (1 - u[r[:2]]) * (1 - p) / p for r, p in part.items()}
        order = sorted(part, key=odds.get)
        unit = {r: counted[r] * size[r] for r in order}
        left = list(order)
        for r in order:  # the lowest ranks that fit
            if unit[r] > room + 1e-6:
                break
            room -= unit[r]
            out[r] += 1
            left.remove(r)
        for r in list(left):  # what remains, to whatever fits
            if unit[r] <= room:
                room -= unit[r]
                out[r] += 1
                left.remove(r)
        short = min(left, key=lambda r: (unit[r], odds[r]), default=None)  # noqa: B023
        assert short is None or unit[short] > room - 1e-6
        if short and unit[short] < 2 * room - 1e-6:
            out[short] += 1
            room -= unit[short]
        shortest = min((unit[r] for r in part if r in left), default=0)
        assert abs(room) <= max(1e-6, shortest / 2 + 1e-6)
    return out


def drawn(spark, df):
    """u of each (id, text)."""
    rows = df.select(F.col("doc_id").alias("__id"), "text", mixing.text_hash(mixing.whole("text")).alias("__text"))
    return {(r[0], r[1]): r[2] for r in rows.select("__id", "text", mixing.random_part(17)).collect()}


def check(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    want = plain_mix(rows, drawn(spark, df))
    got = mixing.mix(df).withColumnsRenamed({"__id": "i", "__source": "s"})
    texts = df.select("doc_id", "text", "source", mixing.text_hash(mixing.whole("text")).alias("h")).distinct()
    named = got.join(texts, got["i"].eqNullSafe(texts["doc_id"]) & got["s"].eqNullSafe(texts["source"]) & (got["__text"] == texts["h"]))
    have = {(r["doc_id"], r["text"], r["source"]): r["__copies"] for r in named.collect()}
    # null and empty text are one document to the operator
    assert {k: n for k, n in have.items() if k[1]} == {k: n for k, n in want.items() if k[1]}
    assert not any(n for k, n in have.items() if not k[1])
    return have


def test_equals_a_plain_pareto_sampler(spark):
    random.seed(21)
    rows = [(i, " ".join("w" * random.randint(1, 3) for _ in range(int(random.paretovariate(0.7)))), random.choice(["a", "b", "b", "b", "c", None])) for i in range(400)]
    rows += [rows[3], rows[3], rows[7], (None, "a null id", "a"), (5, rows[6][1], "c"), (900, None, "a"), (901, "", "b"), (902, "z " * 30_000, "c")]
    have = check(spark, rows)
    assert {0, 1, 3} <= set(have.values())


@pytest.mark.parametrize("k", range(2))
def test_small_sources_with_halving_sizes_keep_the_bound(spark, k):
    random.seed(k)
    check(spark, [(i, "w " * (2 ** random.randint(0, 12) + random.randint(0, 2)), f"s{i % 5}") for i in range(40)])


def test_rounds_of_small_documents_keep_the_bound(spark, monkeypatch):
    """With a large part, what remains is filled in rounds: nothing left out fits, and the miss is bounded."""
    monkeypatch.setattr(mixing, "PART", 4)
    random.seed(5)
    rows = [(i, "w " * (4000 if i % 40 == 0 else random.randint(1, 900 if i % 3 else 9)), f"s{i % 3}") for i in range(400)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    for source in ("s0", "s1", "s2"):
        own = [r for r in got if r["__source"] == source]
        off = own[0]["__target"] - sum(r["__copies"] * r["__words"] for r in own)
        left = [r["__words"] for r in own if r["__copies"] == r["__whole"] and r["__p"] > 1e-9]
        assert abs(off) <= max(1e-6, min(left, default=0) / 2 + 1e-6)
        assert off < 0 or all(x > off for x in left)


def test_long_documents_are_preferred_and_ranks_decide(spark):
    """Inclusion differs by document within a source, and follows the probabilities."""
    rows = [(i, "w " * (3 if i % 2 else 300), "a") for i in range(4000)] + [(10_000 + i, "w " * 300, "b") for i in range(4000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(df).where("__source = 'a'").toPandas()
    for size, some in got.groupby("__words"):
        whole, p = some["__whole"].iloc[0], some["__p"].iloc[0]
        assert abs((some["__copies"] - whole).mean() - p) < 0.04
    assert got[got["__words"] == 300]["__copies"].mean() > 2 * got[got["__words"] == 3]["__copies"].mean()


def test_defined_cases(spark):
    rows = [(1, "a b c", None, 1), (2, None, "x", 2), (3, "", "x", 3), (None, "q w", "y", 4), (5, "one two", "y", 5), (5, "one two", "y", 6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, __rank int")
    got = mixing.mix(df).collect()
    assert len(got) == len(rows)
    assert {r["__source"]: r["__target"] for r in got}["x"] == 0.0
    assert len({r["__copies"] for r in got if r["__id"] == 5}) == 1
    assert mixing.mix(df.limit(0)).count() == 0
