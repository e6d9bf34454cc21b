"""Ids against the public library, round trips, and the defined cases."""

import base64
import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from tidemark.llm import byte_bpe, registry

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts():
    random.seed(5)
    odd = ["", "a" * 5000, "ab" * 700 + "  " * 50 + "x", "日本語テキスト" * 90, "!!!???..." * 99, "\n\n  \t x'S 's't're '  re", "<|endoftext|>", "🙂‍↔️ é"]
    return odd + ["".join(random.choice("abcdeé 日\n'1!") for _ in range(random.randint(1, 900))) for _ in range(60)]


def test_ids_equal_the_library(library):
    vocabulary = byte_bpe.ranks(PATH, PATTERN)
    for text, blocks in zip(texts(), byte_bpe._encoded(vocabulary, texts()), strict=True):
        ids = " ".join(b for b in blocks if b)
        assert ids == " ".join(map(str, library.encode_ordinary(text)))
        assert vocabulary.decode(ids) == text.encode()


def test_lanes_and_the_long_way_agree():
    vocabulary = byte_bpe.ranks(PATH, PATTERN)
    words = ["".join(random.choice("thaeiondr") for _ in range(n)).encode() for n in range(2, 200)]
    assert [vocabulary._merge_long(w) for w in words] == [vocabulary._merge_lanes([w], 1 << (len(w) - 1).bit_length())[0] for w in words]


def test_long_texts_go_in_blocks(library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "BLOCK", 7)
    monkeypatch.setattr(byte_bpe, "CACHE", 9)
    vocabulary = byte_bpe.ranks(PATH, PATTERN)
    text = "the quick brown fox, twice over " * 40
    (blocks,) = byte_bpe._encoded(vocabulary, [text])
    assert " ".join(blocks) == " ".join(map(str, library.encode_ordinary(text)))


def test_frames(spark, library):
    rows = [(1, None, 7), (2, "", 7), (3, "hello world", 7), (3, "hello world", 7), (None, "x y", 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    ids = byte_bpe.encode(df, PATH, PATTERN)
    assert ids.columns == ["doc_id", "text", "n_tokens", "token_ids"]
    back = byte_bpe.decode(ids, PATH, PATTERN).collect()
    assert sorted(bytes(r["decoded"]) for r in back) == sorted((t or "").encode() for _, t, _ in rows)
    got = byte_bpe.digests(df, PATH, PATTERN).collect()
    assert sorted((r["doc_id"] or 0, r["n_tokens"]) for r in got) == sorted((i or 0, len(library.encode_ordinary(t or ""))) for i, t, _ in rows)
    assert byte_bpe.digests(df.limit(0), PATH, PATTERN).count() == 0


def test_query(spark, sf, library):
    import pyarrow.parquet as pq

    docs = {d["doc_id"]: d["text"] for d in pq.read_table(f"{sf}/documents.parquet", columns=["doc_id", "text"]).to_pylist()}
    got = registry.op10_byte_bpe(spark, sf).collect()
    assert len(got) == len(docs)
    for r in got:
        ids = library.encode_ordinary(docs[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(docs[r["doc_id"]].encode()).hexdigest()
