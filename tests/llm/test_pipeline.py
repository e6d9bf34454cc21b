"""Every stage against plain code on what its predecessor kept."""

import hashlib
import re
from collections import Counter, defaultdict

import pytest

import corpus_pipeline as pipeline
from tests.llm.test_simhash import brute_components, plain

SF = "/root/testdata/sf0.01"
SPACES = " \t\n\x0b\x0c\r"


@pytest.fixture(scope="module")
def kept(spark):
    """Rows after each stage."""
    from tidemark.llm.common import materialise, table

    docs, out = table(spark, SF, "documents"), []
    out.append(docs.collect())
    for _, stage in pipeline.STAGES:
        docs = materialise(stage(spark, docs, SF), "test")
        out.append(docs.collect())
    return out


def test_order_and_columns(kept):
    assert [n for n, _ in pipeline.STAGES] == ["quality classifier", "line dedup", "near duplicates", "mixing", "byte-level BPE"]
    assert all(set(rows[0].asDict()) == set(kept[0][0].asDict()) for rows in kept[:5])


def test_quality_rejects_bad_and_keeps_good(spark, kept):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    ids = {r["doc_id"] for r in kept[1]}
    assert {r["doc_id"]: r["text"] for r in kept[1]}.items() <= {r["doc_id"]: r["text"] for r in kept[0]}.items()
    good, bad = [i for i, q in labels.items() if q], [i for i, q in labels.items() if not q]
    assert sum(i in ids for i in good) >= 0.99 * len(good)
    assert sum(i in ids for i in bad) <= 0.05 * len(bad)


def test_lines(kept):
    key = lambda line: "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(SPACES))
    holders = defaultdict(set)
    for r in kept[1]:
        for line in r["text"].split("\n"):
            holders[key(line)].add(r["doc_id"])
    want = {}
    for r in kept[1]:
        stay = [x for x in r["text"].split("\n") if len(key(x)) < 20 or len(holders[key(x)]) < 3 or max(holders[key(x)]) == r["doc_id"]]
        want[r["doc_id"]] = "\n".join(stay)
    assert {r["doc_id"]: r["text"] for r in kept[2]} == want
    assert all(r["n_chars"] == len(r["text"]) for r in kept[2])
    assert len(kept[2]) == len(kept[1])


def test_near_duplicates(kept):
    """Five words and a similarity of 0.8, by brute force over all pairs; the one with the smallest id of each group stays."""
    from tests.llm.test_resemblance import near, plain_set

    sets = {r["doc_id"]: plain_set(r["text"]) for r in kept[2]}
    group = brute_components(sorted(sets), lambda a, b: near(sets[a], sets[b]))
    assert sorted(r["doc_id"] for r in kept[3]) == sorted(set(group.values()))


def test_four_bits_of_a_fingerprint(spark, kept):
    """op4's own rule on the same documents, through its own operator."""
    from tidemark.llm import simhash

    prints = {r["doc_id"]: plain(r["text"]) for r in kept[2]}
    group = brute_components(sorted(set(prints.values())), lambda a, b: bin(a ^ b).count("1") <= 4)
    low = {}
    for i, p in prints.items():
        low[group[p]] = min(low.get(group[p], i), i)
    docs = spark.createDataFrame([(r["doc_id"], r["text"]) for r in kept[2]], "doc_id long, text string")
    assert sorted(r["doc_id"] for r in simhash.keep_one(docs).collect()) == sorted(low.values())


def test_mixing(kept):
    copies = Counter(r["doc_id"] for r in kept[4])
    size = {r["doc_id"]: len(re.findall(r"[^\x20\x09-\x0D]+", r["text"])) for r in kept[3]}
    assert set(copies) <= set(size) and max(copies.values()) <= 3
    source = {r["doc_id"]: r["source"] for r in kept[3]}
    total, taken = Counter(), Counter()
    for i, n in size.items():
        total[source[i]] += n
        taken[source[i]] += n * copies[i]
    from tests.llm.test_mixing import plain_targets

    for s, target in plain_targets(total).items():
        assert abs(taken[s] - target) <= 0.05 * target


def test_encoding(kept):
    texts = Counter((r["doc_id"], hashlib.sha256(r["text"].encode()).hexdigest()) for r in kept[4])
    assert Counter((r["doc_id"], r["decoded_sha256"]) for r in kept[5]) == texts


def test_run_equals_its_stages(spark, kept):
    assert sorted(map(tuple, pipeline.run(spark, SF).collect())) == sorted(map(tuple, kept[5]))


def odd(spark, rows):
    fields = "doc_id long, text string, lang string, source string, n_chars long, `__text` int, `__fp` string, score double"
    return spark.createDataFrame(rows, fields)


ODD = [
    (None, None, None, None, None, None, None, None),
    (1, None, "en", "a", 0, 1, "x", 0.5),
    (2, "", None, None, None, 1, "x", None),
    (3, "some words of a plain text, no more than that.", "en", "a", 1, 1, "x", None),
    (3, "some words of a plain text, no more than that.", "en", "a", 1, 1, "x", None),
    (3, "the same id and another text, quite another text", "en", None, 1, 1, "x", None),
    (4, "long " * 60_000, "en", "b", 1, 1, "x", None),
    (5, "z" * 50_000, "en", "b", 1, 1, "x", None),
    (6, "a shared line of this length\n" * 3, "en", "b", 1, 1, "x", None),
    (7, "a shared line of this length", "en", "b", 1, 1, "x", None),
    (8, "A SHARED line of this length\n", "en", "b", 1, 1, "x", None),
]


@pytest.mark.parametrize("k", range(5))
def test_stages_stand_odd_rows(spark, k):
    """Nulls anywhere, empty and very long texts, repeated rows, extra columns with names used inside."""
    name, stage = pipeline.STAGES[k]
    df = odd(spark, ODD)
    got = stage(spark, df, SF)
    rows = got.collect()
    if k < 4:
        assert got.columns == df.columns
        own = {(r[0], r[2], r[3], r[5], r[6], r[7]) for r in ODD}
        assert {(r["doc_id"], r["lang"], r["source"], r["__text"], r["__fp"], r["score"]) for r in rows} <= own
    if k in (1, 4):
        assert len(rows) == len(ODD)
    if k == 1:
        assert sorted((r["doc_id"], r["text"]) for r in rows if r["doc_id"] in (6, 7, 8)) == [(6, ""), (7, ""), (8, "A SHARED line of this length\n")]
    if k == 2:
        assert len(rows) == len({(r["text"] or "").strip() for r in rows})
    assert stage(spark, df.limit(0), SF).count() == 0
