"""Counts against the public library, with small chunks and tables too, and the defined cases."""

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidemark.llm import registry, token_counts

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module", autouse=True)
def one_counter():
    """Compiling the library's classes takes seconds; the tests' own counters share them."""
    token_counts.counter(PATH)
    known = token_counts._loaded[PATH].classes
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(token_counts, "_classes", lambda: known)
        yield


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def texts():
    random.seed(7)
    odd = [
        "", "   \n", "a" * 5000, "ab" * 900 + "  " * 50 + "x", "日本語テキスト" * 80, "!!!???..." * 50, "1234567890" * 30,
        "\n\n  \t x'S 's't're ''s 're'd'm '' 'r e!'s 'l 'll'v'ves  re", "ΣΑΣ ΟΔΟΣ İstanbul ǅ ẞ", "é 가 ﬁ é",
        "a<|startoftext|>b <|endoftext|><|endoftext|>c <|STARTOFTEXT|> it's",
    ]
    return odd + ["".join(random.choice("abcdeé 日\n'1!Σ́stl") for _ in range(random.randint(1, 600))) for _ in range(120)]


def want(library, listed):
    return [len(e.ids) for e in library.encode_batch(listed, add_special_tokens=False)]


def test_counts_equal_the_library(library):
    assert token_counts.counter(PATH).count(texts()).tolist() == want(library, texts())


@pytest.mark.parametrize(("chunk", "states", "slice_"), [(3, 50, 1 << 20), (1, 10**6, 97), (16, 300, 40)])
def test_chunks_tables_and_slices_change_nothing(library, monkeypatch, chunk, states, slice_):
    monkeypatch.setattr(token_counts, "CHUNK", chunk)
    monkeypatch.setattr(token_counts, "STATES", states)
    monkeypatch.setattr(token_counts, "SLICE", slice_)
    listed = texts()[:40]
    assert token_counts.Counter(PATH).count(listed).tolist() == want(library, listed)


@pytest.mark.parametrize("sep", ["\x1c", "\x1d", "\x1e", "\x1f", "\x85", "\xa0", "\u2028", "\u200b", " "])
def test_long_texts_are_cut_where_the_library_sees_white_space(library, monkeypatch, sep):
    """Python's white space holds U+001C to U+001F, the library's doesn't."""
    monkeypatch.setattr(token_counts, "SLICE", 40)
    listed = ["!!" + sep + "!!" * k + " ab" + sep * 2 + "c's" for k in range(60)]
    listed += ["".join(listed), sep.join(listed)]
    assert token_counts.Counter(PATH).count(listed).tolist() == want(library, listed)


def test_a_text_beyond_two_slices(library):
    text = "ab " * (token_counts.SLICE // 3) + "x" + "!!\x1c!!" + " cd" * (token_counts.SLICE // 2)
    assert len(text) > 2 * token_counts.SLICE
    assert token_counts.counter(PATH).count([text]).tolist() == want(library, [text])


@pytest.mark.parametrize("word", ["a" * 100_000, "abc" * 30_000, "theinging" * 9_000, "".join(random.Random(4).choice("etaoins") for _ in range(20_000))])
def test_long_words_by_composed_maps(library, monkeypatch, word):
    """The heads' maps close after few walks and are composed by doubling: no walk per chunk."""
    counter, walks = token_counts.counter(PATH), []
    walk = counter.transducer._walk
    monkeypatch.setattr(counter.transducer, "_walk", lambda *a: walks.append(1) or walk(*a))
    assert counter.count([word, f"x {word}y z"]).tolist() == want(library, [word, f"x {word}y z"])
    assert len(walks) <= 40 < len(word) // token_counts.CHUNK


def test_composition_equals_one_long_walk(monkeypatch):
    """The same stream in chunks of every size, in small tables too."""
    monkeypatch.setattr(token_counts, "STATES", 30)
    counter = token_counts.Counter(PATH)
    text = "".join(random.Random(8).choice("etaoins" * 9 + " ") for _ in range(3000))
    counts = set()
    for chunk in (1, 2, 5, 17, 128, 5000):
        monkeypatch.setattr(token_counts, "CHUNK", chunk)
        counts.add(int(counter.count([text])[0]))
    assert len(counts) == 1


def test_frame(spark, library):
    rows = [(1, None, 5), (2, "", 5), (3, "héllo wörld", 5), (3, "héllo wörld", 5), (None, "x " * 3000, 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    got = token_counts.count_tokens(df, PATH).collect()
    expected = [(i or 0, len((t or "").encode()), n, n > 2048) for (i, t, _), n in zip(rows, want(library, [t or "" for _, t, _ in rows]), strict=True)]
    assert sorted((r["doc_id"] or 0, r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in got) == sorted(expected)
    assert token_counts.count_tokens(df.limit(0), PATH).count() == 0


def test_query(spark, sf, library):
    import pyarrow.parquet as pq

    docs = pq.read_table(f"{sf}/documents.parquet", columns=["doc_id", "text"]).to_pydict()
    expected = dict(zip(docs["doc_id"], want(library, docs["text"]), strict=True))
    assert {r["doc_id"]: r["n_tokens"] for r in registry.op1_token_counts(spark, sf).collect()} == expected
