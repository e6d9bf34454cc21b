"""Sets by the book, groups by brute force on texts with planted near copies, and the defined cases."""

import random

import numpy as np

from tests.llm.test_simhash import brute_components
from tidemark.llm import resemblance


def plain_set(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").split()
    return {" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def near(a, b):
    return a == b or 5 * len(a & b) >= 4 * len(a | b)


def planted():
    random.seed(4)
    rows, word = [], lambda: f"w{random.randrange(3000)}"
    for g in range(25):
        base = [word() for _ in range(random.choice([8, 60, 200, 400]))]
        for _ in range(4):
            text = list(base)
            for _ in range(random.randint(0, max(1, len(text) // 25))):
                text[random.randrange(len(text))] = word()
            rows.append((len(rows) * 7 % 101, " ".join(text).upper() if g % 2 else " ".join(text)))
    return rows + [(900, None), (901, " \t"), (902, "One two"), (903, "one  TWO"), (None, rows[0][1])]


def test_one_of_each_group_of_near_copies(spark, monkeypatch):
    rows = planted()
    sets = [plain_set(t) for _, t in rows]
    group = brute_components(range(len(rows)), lambda i, j: near(sets[i], sets[j]))
    low = {}
    for k, (i, _) in enumerate(rows):
        low[group[k]] = min(low.get(group[k], 10**9), 10**9 if i is None else i)
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, node string")
    for block in (resemblance.BLOCK, 300):  # the latter deals groups into blocks
        monkeypatch.setattr(resemblance, "BLOCK", block)
        got = resemblance.keep_one(df)
        assert got.columns == df.columns
        assert sorted(r["doc_id"] for r in got.collect()) == sorted(low.values())
    assert resemblance.keep_one(df.limit(0)).count() == 0


def test_the_pipeline_stage_drops_near_copies_that_four_bits_miss(spark):
    import corpus_pipeline
    from tidemark.llm import simhash

    random.seed(12)
    base = [f"w{random.randrange(5000)}" for _ in range(200)]
    other = [*base[:50], "changed", *base[51:120], "again", *base[121:]]
    assert near(plain_set(" ".join(base)), plain_set(" ".join(other)))
    assert bin((simhash.fingerprint(" ".join(base)) ^ simhash.fingerprint(" ".join(other))) % 2**64).count("1") > 4
    df = spark.createDataFrame([(2, " ".join(base)), (1, " ".join(other)), (3, "alone")], "doc_id long, text string")
    assert sorted(r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, df, "").collect()) == [1, 3]


def test_long_texts_go_in_blocks(monkeypatch):
    text = " ".join(str(i % 37) for i in range(500))
    whole = resemblance.shingle_set(text)
    monkeypatch.setattr(resemblance, "WORDS", 9)
    assert np.array_equal(resemblance.shingle_set(text), whole) and len(whole) == len(plain_set(text))


def test_the_count_filter_keeps_what_is_near_and_drops_the_rest():
    """Recall of the index and the filter on 2,000 pairs of similarity 0.8 to 0.83, and of pairs at 0.5 how many are verified."""
    r = np.random.default_rng(6)
    met = filtered = far = 0
    for _ in range(2000):
        n = int(r.integers(60, 400))
        common = r.integers(0, 2**63, n).astype(np.uint64)
        k = n // 8  # n / (n + 2k) = 0.8
        a, b = (np.unique(np.concatenate([common, r.integers(0, 2**63, k).astype(np.uint64)])) for _ in range(2))
        x, y = resemblance.positional_bytes(a), resemblance.positional_bytes(b)
        met += bool(set(resemblance.list_keys(x)) & set(resemblance.list_keys(y)))
        filtered += int((x == y).sum()) >= resemblance.MATCHES
        c = np.unique(np.concatenate([common[: 3 * n // 4], r.integers(0, 2**63, n // 2).astype(np.uint64)]))
        far += int((x == resemblance.positional_bytes(c)).sum()) >= resemblance.MATCHES
    assert met >= 1998 and filtered >= 1999 and far <= 20


def test_fingerprints_are_simhashes_of_the_set():
    """A bit is 1 if set in over half of the shingles' hashes; the first fingerprint is from op4's own hashes."""
    from xxhash import xxh64_intdigest

    for n in (1, 4, 7, 300, 1000):
        text = " ".join(f"w{i % 600}" for i in range(n + 4))
        hashes = [xxh64_intdigest(s, 42) for s in plain_set(text)]
        got = resemblance.positional_bytes(resemblance.shingle_set(text)).view("<u8").tolist()
        assert got[0] == sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
        others = resemblance.mixed(np.array(hashes, np.uint64)).T.tolist()
        assert got == [sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs)) for hs in others]
        assert len(set(got)) == len(got) == resemblance.FINGERPRINTS


def listed(sets, blocks=1):
    """The entries of all lists of some sets, in order; a set's number is its node."""
    prints = np.stack([resemblance.positional_bytes(s) for s in sets])
    words, first, rows = prints.view(np.int64), resemblance.lists(prints), []
    for node in range(len(sets)):
        for k in range(resemblance.FINGERPRINTS if len(sets[node]) <= resemblance.SMALL else resemblance.LISTED):
            three = [int(words[node, (k + d) % resemblance.FINGERPRINTS]) for d in range(3)]
            for key in first[node, k].tolist():
                rows += [(key, min(node % blocks, other), max(node % blocks, other), node % blocks, node, *three) for other in range(blocks)]
    return [np.array(c, np.int64) for c in zip(*sorted(rows), strict=True)]


def test_pairs_at_the_least_similarity_meet_in_the_index_whatever_their_size():
    """Planted pairs of 4 to 400 shingles through lists, entries and filters, in one index."""
    r, sets = np.random.default_rng(8), []
    for common, one, other in [(4, 0, 1), (5, 0, 1), (8, 0, 2), (12, 1, 2), (20, 2, 3), (28, 3, 4), (40, 5, 5), (80, 0, 20), (160, 20, 20), (320, 40, 40)] * 40:
        x = r.integers(0, 2**64, common + one + other, np.uint64)
        sets += [np.unique(x[: common + one]), np.unique(np.concatenate([x[:common], x[common + one :]]))]
    found = resemblance._edges(listed(sets))
    assert {(a, b) for a, b in zip(found["a"].to_pylist(), found["b"].to_pylist(), strict=True) if a // 2 == b // 2} >= {(k + 1, k) for k in range(0, len(sets), 2)}
    for k in range(0, len(sets), 2):
        assert len(set(resemblance.similar(sets[k : k + 2], np.stack([resemblance.positional_bytes(s) for s in sets[k : k + 2]])).tolist())) == 1


def test_lists_by_runs_and_blocks_give_the_same_groups(monkeypatch):
    """Near copies of a few texts, so that lists are hot: compared in steps, one by one, and in pairs of blocks."""
    r, sets = np.random.default_rng(9), []
    for _ in range(3):
        base = r.integers(0, 2**64, 200, np.uint64)
        for k in range(30):
            own = base.copy()
            own[r.integers(0, 200, k % 25)] = r.integers(0, 2**64, k % 25, np.uint64)
            sets.append(np.unique(own))
    keys = [set(resemblance.list_keys(resemblance.positional_bytes(s)).tolist()) for s in sets]
    prints = np.stack([resemblance.positional_bytes(s) for s in sets]).view(np.uint64)

    def met(i, j):
        for k in range(resemblance.LISTED):
            three = [(k + d) % resemblance.FINGERPRINTS for d in range(3)]
            if {x >> 11 & 15 for x in keys[i] & keys[j]} >= {k} and np.bitwise_count(prints[i, three] ^ prints[j, three]).sum() <= resemblance.NEAR:
                return True
        return False

    want = brute_components(range(len(sets)), met)
    for run, blocks in ((64, 1), (2, 1), (64, 4), (2, 4)):
        monkeypatch.setattr(resemblance, "RUN", run)
        found = resemblance._edges(listed(sets, blocks))
        pairs = set(zip(found["a"].to_pylist(), found["b"].to_pylist(), strict=True))
        assert brute_components(range(len(sets)), lambda i, j: (max(i, j), min(i, j)) in pairs) == want  # noqa: B023


def test_hot_lists_are_split_by_a_second_byte_and_into_blocks(spark, monkeypatch):
    rows = planted()
    sets = [plain_set(t) for _, t in rows]
    group = brute_components(range(len(rows)), lambda i, j: near(sets[i], sets[j]))
    low = {}
    for k, (i, _) in enumerate(rows):
        low[group[k]] = min(low.get(group[k], 10**9), 10**9 if i is None else i)
    monkeypatch.setattr(resemblance, "LIST", 2)
    got = resemblance.keep_one(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(r["doc_id"] for r in got.collect()) == sorted(low.values())


def test_many_partitions_make_few_files(spark, monkeypatch, tmp_path):
    """Tasks follow the input, not the number of partitions: each file that is written starts processes."""
    import pathlib

    from tidemark.llm import components, mixing

    files, write = {}, resemblance.materialise

    def counted(df, label):
        made = write(df, label)
        files[label] = max(files.get(label, 0), len(list(pathlib.Path(made._scratch_path.removeprefix("file://")).glob("*.parquet"))))
        return made

    monkeypatch.setattr(resemblance, "materialise", counted)
    monkeypatch.setattr(components, "materialise", counted)
    rows = planted()
    spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, source string").coalesce(3).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    want = sorted(map(repr, resemblance.keep_one(docs).collect()))
    held = {"spark.sql.shuffle.partitions": "61", "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in held}
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        files.clear()
        resemblance.keep_one(docs).write.parquet(str(tmp_path / "kept"))
        mixing.mixed_rows(docs).write.parquet(str(tmp_path / "mixed"))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    files |= {d: len(list((tmp_path / d).glob("*.parquet"))) for d in ("kept", "mixed")}
    assert {"nodes", "edges", "compared", "kept", "mixed"} <= set(files) and max(files.values()) <= 12, files
    assert sorted(map(repr, spark.read.parquet(str(tmp_path / "kept")).collect())) == want
