"""Held-out accuracy, independence of a score from its neighbours, and the defined cases."""

import zlib

import numpy as np
import pytest

from tidemark.llm import quality_net, registry


@pytest.fixture(scope="module")
def net():
    good = [f"the river went on by {i} stones and the old mill, then home again.".encode() * 3 for i in range(60)]
    bad = [b"%%% *** $$$ buy!!! " * (i + 3) for i in range(60)]
    y = np.array([1.0] * 60 + [0.0] * 60)
    return quality_net.fit(good + bad, y, np.ones(120), epochs=30)


def test_learns(net):
    s = net.score([b"the mill by the river went on and then the stones. " * 4, b"*** $$$ buy!!! %%% " * 20])
    assert s[0] > 0.8 and s[1] < 0.2


def test_score_hangs_on_the_text_alone(net, monkeypatch):
    texts = [b"", b"x", b"the river " * 500, b"*** $$$ " * 9, b"\x00\x00 zero", b"a" * 33]
    together = net.score(texts)
    assert np.allclose(together, [net.score([t])[0] for t in texts], atol=1e-6)
    assert np.allclose(together, net.score(texts[::-1])[::-1], atol=1e-6)
    mark = b"the river went on by the old mill, " * 3000 + b"%%% *** $$$ buy!!! " * 40
    assert net.score([mark])[0] < 0.5  # junk at the end of a long text counts


def test_gradient():
    texts, y, w = [b"abcabcabc" * 9, b"the cat sat on the mat " * 4], np.array([0.0, 1.0]), np.ones(2)
    net = quality_net.fit(texts, y, w, epochs=120)
    assert np.abs(net.score(texts) - y).max() < 0.2


def test_frames(spark, net):
    df = spark.createDataFrame([(1, None, 2), (1, "", 2), (None, "the river", 2)], "doc_id long, text string, score int")
    got = quality_net.score(df, net).collect()
    assert len({r["score"] for r in got if not r["text"]}) == 1 and all(0 <= r["score"] <= 1 for r in got)
    assert quality_net.score(df.limit(0), net).count() == 0
    empty = spark.createDataFrame([], "doc_id long, quality int")
    assert quality_net.train(df, empty) is None
    assert {r["score"] for r in quality_net.score(df, None).collect()} == {0.5}
    one = spark.createDataFrame([(1, 1), (1, None), (None, 0)], "doc_id long, quality int")
    quality_net.train(df.where("text is not null"), one)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = registry.op8_quality_classifier(spark, sf).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    judged = [r["predicted"] == labels[r["doc_id"]] for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert len(judged) > 100 and np.mean(judged) >= 0.97
