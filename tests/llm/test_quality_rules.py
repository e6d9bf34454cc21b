"""Counts and verdicts against plain code, the exact path, and the defined cases."""

import re
import random
from collections import Counter, defaultdict

import pytest

from tidemark.llm import quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SPACES = " \t\n\x0b\x0c\r"


def counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def norm(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(SPACES))


def frequent(rows, max_docs):
    """(host, line) of lines in more than max_docs distinct documents."""
    holders = defaultdict(set)
    for i, t, host in rows:
        for line in (t or "").split("\n"):
            if WORD.search(line):
                holders[host or "", norm(line)].add(i)
    return {k for k, ids in holders.items() if len(ids) > max_docs}


def verdicts(rows, max_docs, min_left=0.3):
    limit = frequent(rows, max_docs)
    out = []
    for i, t, host in rows:
        n, chars, symbols, dup, repeat = counts(t)
        failed = n < 50 or 100 * repeat > 50 * n
        gone = sum(len(WORD.findall(x)) for x in (t or "").split("\n") if WORD.search(x) and (host or "", norm(x)) in limit)
        out.append((i, n, chars, symbols, dup, repeat, failed, not failed and not n - gone < min_left * n, gone))
    return out


def rows():
    random.seed(6)
    words = "alpha beta gamma delta epsilon zeta ÉTÉ été # a|b <x> 100% \x0b".split(" ")
    made = []
    for i in range(120):
        lines = [" ".join(random.choice(words) for _ in range(random.randint(0, 12))) for _ in range(random.randint(1, 12))]
        if i % 3 == 0:
            lines += ["Subscribe to our newsletter and follow us on every channel there is " * 5, "ALL rights reserved"]
        if i % 5 == 0:
            lines += lines[:2]
        made.append((i, "\n".join(lines), f"host{i % 2}"))
    made += [(None, None, None), (201, "", ""), (202, "  \n\t", None), (3, made[3][1], "host1"), (3, "another text " * 40, "host1"), (204, "word " * 3000, "host0"), (205, "a b c a b", "h"), (206, "a a a a", "h"), (207, "x y", "h")]
    return made


@pytest.mark.parametrize(("bits", "max_docs"), [(24, 5), (60, 5), (2, 0), (24, 50)])
def test_equals_plain_code(spark, monkeypatch, bits, max_docs):
    """With few bits for positions, or few for hashes, the exact path is taken."""
    monkeypatch.setattr(quality_rules, "POSITION_BITS", bits)
    made = rows()
    df = spark.createDataFrame([(*r, 7) for r in made], "doc_id long, text string, source string, n_words int")
    got = quality_rules.judge(df, max_docs=max_docs).collect()
    want = verdicts(made, max_docs)
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    limit = frequent(made, max_docs)
    stay = lambda t, host: "\n".join(x for x in (t or "").split("\n") if not (WORD.search(x) and (host or "", norm(x)) in limit))
    texts = quality_rules.without_frequent_lines(df, max_docs=max_docs)
    assert texts.columns == df.columns
    expected = [(i, stay(t, host), host) for (i, t, host), v in zip(made, want, strict=True) if v[-2]]
    assert sorted(repr((r["doc_id"], r["text"], r["source"])) for r in texts.collect()) == sorted(map(repr, expected))


def test_template_documents_go_whatever_the_size_of_their_host(spark):
    """60 documents of one template, some of them exact copies, in a small host and in a hot one."""
    template = "".join(f"This page{k} is{k} made{k} from{k} a{k} template{k} and{k} says{k} the{k} same{k} as{k} all{k} others{k} do{k}\n" for k in range(4))
    own = lambda k: " ".join(f"word{k}x{i}" for i in range(80))
    rows = [(k, template + f"own line number {k % 40}", "small") for k in range(60)] + [(100, own(100), "small")]
    rows += [(1000 + k, template + f"own line number {k % 40}", "hot") for k in range(60)] + [(2000 + k, own(k), "hot") for k in range(3000)]
    rows += [(9000 + k, template + f"own line number {k % 40}", "few") for k in range(50)]
    got = {r["doc_id"]: r["kept"] for r in quality_rules.judge(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert not any(got[k] or got[1000 + k] for k in range(60))
    assert got[100] and all(got[2000 + k] for k in range(3000)) and all(got[9000 + k] for k in range(50))


def test_very_long_texts(spark):
    """400,000 words in 50,000 lines."""
    text = "\n".join(" ".join(f"w{i * 8 + j}" for j in range(8)) for i in range(50_000))
    got = quality_rules.judge(spark.createDataFrame([(1, text, "h"), (2, text + "\n" + text, "h")], "doc_id long, text string, source string")).collect()
    assert sorted((r["doc_id"], r["n_words"], r["n_dup_lines"], r["n_repeat_words"]) for r in got) == [(1, 400_000, 0, 0), (2, 800_000, 50_000, 800_000)]


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string, source string")
    assert quality_rules.judge(df).count() == 0
