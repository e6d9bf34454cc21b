"""Fingerprints by the book, links and components by brute force, and the defined cases."""

import random
import re
from itertools import combinations

import xxhash

from tidemark.llm import simhash
from tidemark.llm.components import components


def plain(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(nodes, near):
    """Node to the smallest of its component."""
    root = {n: n for n in nodes}

    def top(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in combinations(nodes, 2):
        if near(a, b) and top(a) != top(b):
            root[max(top(a), top(b))] = min(top(a), top(b))
    return {n: top(n) for n in nodes}


def test_any_four_positions_contain_a_triple():
    assert len(simhash.TRIPLES) == 20
    assert all(any(set(t) <= set(four) for t in simhash.TRIPLES) for four in combinations(range(8), 4))


def test_fingerprints(monkeypatch):
    random.seed(3)
    texts = [None, "", " \t", "one", "One two three", "A b c d", "É É x É\x0by z q", "same " * 50]
    texts += [" ".join(random.choice("ab cd ef gh ij É".split()) for _ in range(random.randint(1, 60))) for _ in range(40)]
    assert [simhash.fingerprint(t) % 2**64 for t in texts] == [plain(t) for t in texts]
    monkeypatch.setattr(simhash, "WORDS", 5)
    assert [simhash.fingerprint(t) % 2**64 for t in texts] == [plain(t) for t in texts]


def test_links_connect_exactly_what_is_near(spark, monkeypatch):
    random.seed(9)
    centre, nodes = random.getrandbits(63), set()
    for _ in range(150):  # a dense group, split over many blocks below
        x = centre
        for b in random.sample(range(63), random.randint(0, 6)):
            x ^= 1 << b
        nodes.add(x)
    while len(nodes) < 260:
        base = random.getrandbits(64) - 2**63
        nodes.add(base)
        other = base
        for b in random.sample(range(63), random.choice([1, 3, 4, 5, 6])):
            other ^= 1 << b
        nodes.add(other)
    df = spark.createDataFrame([(n,) for n in nodes], "fp long")
    want = brute_components(sorted(nodes), lambda a, b: bin((a ^ b) % 2**64).count("1") <= 4)
    for size in (2048, 3):
        monkeypatch.setattr(simhash, "LIST", size)
        found = {r["node"]: r["root"] for r in components(simhash.links(df)).collect()}
        assert {n: found.get(n, n) for n in nodes} == want


def test_the_tally_drops_pairs_before_they_are_verified(monkeypatch):
    """Entries of one list share three bytes; only those that share a fourth are verified."""
    import pyarrow as pa

    random.seed(8)
    fp = [random.getrandbits(38) << 24 | 0x010203 for _ in range(400)] + [5 << 40 | 0x010203, 7 << 40 | 0x010203]
    tallied, verified = [], []
    tally, verify = simhash._tally, simhash._verified
    monkeypatch.setattr(simhash, "_tally", lambda o, a, b: tallied.append(len(a)) or tally(o, a, b))
    monkeypatch.setattr(simhash, "_verified", lambda f, a, b: verified.append(len(a)) or verify(f, a, b))
    zero = [0] * len(fp)
    batch = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zero, zero, zero, zero, fp)], ["list", "one", "two", "block", "fp"])
    edges = [e for b in simhash._linked([batch]) for e in b.to_pylist()]
    assert {5 << 40 | 0x010203, 7 << 40 | 0x010203} in [set(e.values()) for e in edges]
    assert sum(tallied) == 402 * 401 // 2 and sum(verified) < 0.05 * sum(tallied)


def test_long_path(spark):
    n = 300
    order = list(range(n))
    random.seed(2)
    random.shuffle(order)
    df = spark.createDataFrame(list(zip(order, order[1:], strict=False)), "a long, b long")
    assert {r["root"] for r in components(df).collect()} == {0}
    assert components(df.limit(0)).count() == 0


def docs(spark):
    base = " ".join(f"w{i}" for i in range(300))
    rows = [(9, base), (4, base), (7, base + " tail"), (5, None), (6, "  "), (None, base), (3, "other words all alone here"), (3, "again something else"), (4, base)]
    return rows, spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, fp string")


def test_cluster(spark):
    rows, df = docs(spark)
    prints = [plain(t) for _, t in rows]
    groups = brute_components(sorted(set(prints)), lambda a, b: bin(a ^ b).count("1") <= 4)
    low = {}
    for (i, _), p in zip(rows, prints, strict=True):
        if i is not None:
            low[groups[p]] = min(low.get(groups[p], i), i)
    want = sorted(repr((i, p, low.get(groups[p]))) for (i, _), p in zip(rows, prints, strict=True))
    got = simhash.cluster(df).collect()
    assert sorted(repr((r["doc_id"], r["fp"] % 2**64, r["component_id"])) for r in got) == want
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    assert len(kept.collect()) == len({groups[p] for p in prints})
    assert simhash.cluster(df.limit(0)).count() == 0 and simhash.keep_one(df.limit(0)).count() == 0


def test_query(spark, sf):
    import pyarrow.parquet as pq

    from tidemark.llm import registry

    table = pq.read_table(f"{sf}/documents.parquet", columns=["doc_id", "text"]).to_pydict()
    prints = dict(zip(table["doc_id"], map(plain, table["text"]), strict=True))
    by_print = brute_components(sorted(set(prints.values())), lambda a, b: bin(a ^ b).count("1") <= 4)
    low = {}
    for i, p in prints.items():
        low[by_print[p]] = min(low.get(by_print[p], i), i)
    got = registry.op4_simhash(spark, sf).collect()
    assert sorted(map(tuple, got)) == sorted((i, f"{p:016x}", low[by_print[p]]) for i, p in prints.items())
