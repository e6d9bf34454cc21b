"""Personal data in texts, from DataFrame operations only.

Four base kinds come from fixed patterns.  Beside them, a wide net catches
candidates: long runs of key characters (kind ``secret``), phone numbers without a
country code (``phone``), numbers in the form of a national id (``id``) and long plain
numbers (``account``); most of what it catches is harmless, long words and counts.
Five labelers vote on each candidate or abstain: the shape of the match (regex), words
close before it (gazetteer), the characters around it (context), its mix of digits and
letters, and how evenly it uses its characters.  Expectation-maximisation over the counts
of vote patterns estimates how reliable each labeler is, how many candidates are
personal data, and how likely each pattern is; a logistic
span classifier over kind, votes, length and digit share is then trained on those
likelihoods and decides.  Counts of patterns are at most ``3 ** 5`` votes times the
kinds and a few buckets, whatever the input, so the driver gathers them; the texts of all
documents count.

Every pattern is possessive and anchored where a run starts, so a match costs
time in proportion to its length, on any text; ``\\G`` keeps matches that start
where the last one ended.  Offsets are sums over the pieces between matches, in
a window over one document's matches of one kind; only numbers, the match and a few
characters around it move.

Defined results:

* null or empty text: no spans, the digest of the empty string;
* rows that share an id are told apart by their text; equal rows get equal results;
* offsets are code points, ends are exclusive; spans at the same start are in
  the order of ``KINDS``; base spans may overlap, added ones overlap no base span;
* of added spans that overlap each other, all stay;
* texts of any length are searched whole;
* a likelihood of exactly one half counts as personal data;
* an empty table, or one without candidates, adds no spans and fits no model;
* other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from itertools import product

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import materialise, text_hash, whole

KINDS = ["email", "ip", "card", "phone", "secret", "id", "account"]

_LOCAL = r"[A-Za-z0-9._%+-]"
_KEY = r"[A-Za-z0-9_+/-]"
BASE = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9]){11,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
CANDIDATES = {
    "phone": r"(?<![0-9A-Za-z+])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9A-Za-z])",
    "secret": rf"(?<!{_KEY}){_KEY}{{16,}}+",
    "id": r"(?<![0-9A-Za-z+.-])[0-9]{3}[\x20-][0-9]{2}[\x20-][0-9]{4}(?![0-9A-Za-z-])",
    "account": r"(?<![0-9A-Za-z+.,:/_-])[0-9]{9,15}+(?![0-9A-Za-z]|[.,:/_-][0-9A-Za-z])",
}
#: Words that speak for or against personal data close before a candidate.
FOR_WORDS = r"(?i)\b(password|passwd|pwd|secret|token|key|apikey|auth|bearer|login|tel|phone|call|fax|mobile|contact|ssn|passport|account|konto|compte|cuenta|iban|id)\b"
AGAINST_WORDS = r"(?i)\b(version|license|isbn|issn|doi|page|chapter|commit|build|checksum|sha256|md5|order|total|copyright|population)\b"
CONTEXT = 24

LABELERS = ["shape", "gazetteer", "context", "mixture", "evenness"]


def _matches(text: Column, kind: str, pattern: str, base: bool, gate: Column) -> Column:
    """All matches of one pattern, each with what stands before and after, as one struct."""
    none = F.array().cast("array<string>")
    pieces = F.when(gate, F.split(text, pattern, -1)).otherwise(none)
    near = F.transform(pieces, lambda p: F.struct(F.char_length(p).alias("n"), F.right(p, F.lit(CONTEXT)).alias("tail"), F.left(p, F.lit(1)).alias("head")))
    found = F.when(gate, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(none)
    return F.struct(F.lit(kind).alias("kind"), F.lit(base).alias("base"), near.alias("near"), found.alias("found"))


def _valid(kind: Column, s: Column) -> Column:
    part = lambda p: F.ltrim(p, F.lit("0"))
    ip = F.forall(F.split(s, r"\."), lambda p: (F.char_length(part(p)) <= 3) & (F.coalesce(part(p).try_cast("int"), F.lit(0)) <= 255))
    digits = F.regexp_replace(s, "[^0-9]", "")
    card = F.char_length(digits).between(12, 19) & F.call_function("luhn_check", digits)
    return (
        F.when(kind == "ip", ip).when(kind == "card", card).when(kind == "phone", F.char_length(digits).between(9, 15)).otherwise(F.lit(True))
    )


def _votes(kind: Column, s: Column, before: Column, after: Column) -> dict[str, Column]:
    """1 for, 0 against, -1 abstains."""
    n = F.char_length(s)
    digits = F.regexp_count(s, F.lit("[0-9]"))
    switches = F.regexp_count(s, F.lit("[0-9](?=[A-Za-z])|[A-Za-z](?=[0-9])"))
    different = F.length(F.regexp_replace(F.lower(s), r"(.)(?=.*\1)", ""))  # of a match up to 64 characters
    known = s.rlike(r"^(?:AKIA[0-9A-Z]{16}|[0-9a-f]{18,128}|[0-9A-F]{18,128}|[A-Z]{2}[0-9]{2}[0-9A-Z]{11,30}|(?:sk|pk|rk|ghp|gho|xoxb|xoxp)[_-][A-Za-z0-9_-]+)$") & s.rlike("[0-9]")
    wordy = s.rlike(r"^[A-Za-z]+(?:[-_/+][A-Za-z]+)*[0-9]{0,4}$") | s.rlike(r"^[0-9]+(?:[-/][0-9]+)*$")
    round_ = s.rlike(r"^0|000$|^(?:19|20)[0-9]{2}(?:0[1-9]|1[0-2])")  # long numbers that start as a date or end round
    shape = F.when(kind == "secret", F.when(known, 1).when(wordy, 0).otherwise(-1)).when(kind == "phone", F.when(s.rlike(r"^\([0-9]{3}\)|-"), 1).otherwise(-1))
    shape = shape.when(kind == "id", F.when(s.rlike("^(?:000|666|9[0-9]{2})|^...-00|0000$"), 0).when(s.rlike("-.*-"), 1).otherwise(-1)).otherwise(F.when(round_, 0).otherwise(-1))
    mixture = F.when((switches >= 2) & (digits * 20 >= n), 1).when(digits == 0, 0).otherwise(-1)
    even = F.when(n > 64, -1).when(different * 5 < n, 0).when((different >= 10) & (kind == "secret"), F.when(digits > 0, 1).otherwise(-1)).otherwise(-1)
    return {
        "shape": shape,
        "gazetteer": F.when(before.rlike(FOR_WORDS), 1).when(before.rlike(AGAINST_WORDS), 0).otherwise(-1),
        "context": F.when(before.rlike(r"""[=:]\s*["']?$"""), 1).when(before.rlike(r"[#/.@]$") | after.rlike(r"^[/=@]"), 0).when(before.rlike(r"[\w,]\s$") & after.rlike(r"^[\s,.]?$"), 0).otherwise(-1),
        "mixture": F.when(kind == "secret", mixture).otherwise(F.lit(-1)),
        "evenness": even,
    }


def candidates(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Base spans and candidates: (__id, __text, kind, base, start, end, votes, size, digits)."""
    rows = docs.select(F.col(id_col).alias("__id"), whole(text_col).alias("__t"))
    rows = rows.select("__id", text_hash(F.col("__t")).alias("__text"), "__t", F.col("__t").rlike("[0-9]").alias("__digit"))
    t, digit = F.col("__t"), F.col("__digit")
    gates = {"email": F.contains(t, F.lit("@")), "phone": digit & F.contains(t, F.lit("+"))}
    nets = [_matches(t, k, p, True, gates.get(k, digit)) for k, p in BASE.items()]
    nets += [_matches(t, k, p, False, F.lit(True) if k == "secret" else digit) for k, p in CANDIDATES.items()]  # a secret may have no digit
    kinds = rows.select("__id", "__text", F.explode(F.array(*nets)).alias("m")).where(F.size("m.found") > 0)
    kinds = kinds.select("__id", "__text", "m.kind", "m.base", "m.near", "m.found").dropDuplicates(["__id", "__text", "kind", "base"])
    following = F.slice("near", F.lit(2), F.size("found"))
    each = kinds.select("__id", "__text", "kind", "base", F.posexplode(F.arrays_zip(F.col("found").alias("s"), F.col("near").alias("was"), following.alias("next"))).alias("k", "m"))
    each = each.where(F.col("m.s").isNotNull())  # there is one piece more than matches
    each = each.select("__id", "__text", "kind", "base", "k", F.col("m.s").alias("s"), F.col("m.was.n").alias("gap"), F.col("m.was.tail").alias("tail"), F.col("m.next.head").alias("head"))
    so_far = W.partitionBy("__id", "__text", "kind", "base").orderBy("k")
    ends = each.withColumn("end", F.sum(F.col("gap") + F.char_length("s")).over(so_far)).withColumn("start", F.col("end") - F.char_length("s"))
    s, kind = F.col("s"), F.col("kind")
    lettered = F.when(kind == "secret", s.rlike("[A-Za-z]")).otherwise(F.lit(True))
    good = ends.where(F.when(F.col("base"), _valid(kind, s)).otherwise(lettered))
    votes = {name: F.when(F.col("base"), F.lit(-1)).otherwise(v).cast("int").alias(name) for name, v in _votes(kind, s, F.col("tail"), F.coalesce("head", F.lit(""))).items()}
    n = F.char_length(s)
    size = F.when(n < 20, 0).when(n < 32, 1).when(n < 64, 2).otherwise(3)
    share = F.floor(4 * F.regexp_count(s, F.lit("[0-9]")) / n).cast("int")
    spans = good.select("__id", "__text", "kind", "base", "start", "end", *votes.values(), size.alias("size"), F.least(share, F.lit(3)).alias("digits"))
    by_doc = W.partitionBy("__id", "__text").orderBy("start")
    before = F.max(F.when(F.col("base"), F.col("end"))).over(by_doc.rangeBetween(W.unboundedPreceding, 0))
    after = F.min(F.when(F.col("base"), F.col("start"))).over(by_doc.rangeBetween(0, W.unboundedFollowing))
    spans = spans.withColumn("__before", before).withColumn("__after", after)
    clear = (F.coalesce("__before", F.lit(0)) <= F.col("start")) & F.coalesce(F.col("__after") >= F.col("end"), F.lit(True))
    return spans.where(F.col("base") | clear).drop("__before", "__after")


@dataclass
class SpanModel:
    """What EM and the classifier learnt; plain numbers."""

    prior: float
    reliability: dict[str, tuple[float, float]]  #: labeler -> (votes 1 | personal, votes 1 | not), among its votes
    weights: dict[str, float]

    def score(self) -> Column:
        """The classifier's log-odds over the columns of :func:`candidates`."""
        total = F.lit(self.weights["bias"])
        for kind in CANDIDATES:
            total = total + F.when(F.col("kind") == kind, self.weights[f"kind={kind}"]).otherwise(0.0)
        for name in LABELERS:
            total = total + F.when(F.col(name) == 1, self.weights[f"{name}=1"]).when(F.col(name) == 0, self.weights[f"{name}=0"]).otherwise(0.0)
        for name in ("size", "digits"):
            for level in range(4):
                total = total + F.when(F.col(name) == level, self.weights[f"{name}={level}"]).otherwise(0.0)
        return total


def _posterior(pattern: tuple[int, ...], prior: float, rel: list[tuple[float, float]]) -> float:
    yes, no = math.log(prior), math.log(1 - prior)
    for v, (a, b) in zip(pattern, rel, strict=True):
        if v >= 0:
            yes += math.log(a if v else 1 - a)
            no += math.log(b if v else 1 - b)
    return 1 / (1 + math.exp(min(700.0, no - yes)))


def expectation_maximisation(patterns: list[tuple[tuple[int, ...], float]], rounds: int = 200, strength: float = 2.0) -> tuple[float, list[tuple[float, float]]]:
    """Prior and reliabilities from (votes, count) pairs.

    ``strength`` pseudo-votes pull each reliability towards 0.8 and 0.2, which names
    the two classes and holds where few candidates exist.  The prior stays at or below
    one half, so a candidate nothing speaks for isn't personal data however many others
    are.
    """
    n_labelers = len(patterns[0][0])
    prior, rel = 0.5, [(0.8, 0.2)] * n_labelers
    total = sum(n for _, n in patterns)
    for _ in range(rounds):
        post = [_posterior(p, prior, rel) for p, _ in patterns]
        prior = min(0.5, (sum(q * n for q, (_, n) in zip(post, patterns, strict=True)) + 1) / (total + 2))
        new = []
        for j in range(n_labelers):
            hit, all_, hit_no, all_no = strength * 0.8, strength, strength * 0.2, strength
            for q, (p, n) in zip(post, patterns, strict=True):
                if p[j] >= 0:
                    hit, all_ = hit + q * n * p[j], all_ + q * n
                    hit_no, all_no = hit_no + (1 - q) * n * p[j], all_no + (1 - q) * n
            new.append((min(0.999, max(0.001, hit / all_)), min(0.999, max(0.001, hit_no / all_no))))
        rel = new
    return prior, rel


def fit_counts(counts: list[tuple[str, tuple[int, ...], int, int, float]], steps: int = 400) -> SpanModel:
    """EM over (kind, votes, size, digits, count) rows, then the classifier on EM's likelihoods.

    The classifier also sees every possible pattern at a small weight, so that it
    follows EM on patterns that the input lacks.
    """
    by_votes: dict[tuple[int, ...], float] = {}
    for _, p, _, _, n in counts:
        by_votes[p] = by_votes.get(p, 0) + n
    prior, rel = expectation_maximisation(sorted(by_votes.items()))
    said = lambda p: [f"{name}={v}" for name, v in zip(LABELERS, p, strict=True) if v >= 0] + ["bias"]
    rows = [([*said(p), f"kind={kind}", f"size={size}", f"digits={digits}"], n, _posterior(p, prior, rel)) for kind, p, size, digits, n in counts]
    every = list(product((-1, 0, 1), repeat=len(LABELERS)))
    share = 0.2 * sum(n for _, n, _ in rows) / len(every)
    rows += [(said(p), share, _posterior(p, prior, rel)) for p in every]
    names = ["bias", *(f"{x}={v}" for x in LABELERS for v in (0, 1)), *(f"kind={k}" for k in CANDIDATES), *(f"{x}={v}" for x in ("size", "digits") for v in range(4))]
    index = {k: i for i, k in enumerate(names)}
    x = np.zeros((len(rows), len(names)))
    for i, (feats, _, _) in enumerate(rows):
        x[i, [index[f] for f in feats]] = 1
    # the two classes weigh the same, so that the many harmless candidates don't drown the others
    want, n = np.array([q for *_, q in rows]), np.array([n for _, n, _ in rows], float)
    n = n * (want / max(1e-9, (n * want).sum()) + (1 - want) / max(1e-9, (n * (1 - want)).sum()))
    weights = np.zeros(len(names))
    for _ in range(steps):  # full-batch gradient steps on the cross-entropy with soft labels
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -700, 700)))
        weights -= 2.0 * (x.T @ (n / n.sum() * (p - want)) + 1e-3 * weights)
    return SpanModel(prior, dict(zip(LABELERS, rel, strict=True)), dict(zip(names, weights.tolist(), strict=True)))


def fit(spans: DataFrame) -> SpanModel | None:
    """The model for the candidates among ``spans``; None if there are none."""
    keys = ["kind", *LABELERS, "size", "digits"]
    counts = spans.where(~F.col("base")).groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).orderBy(*keys).collect()  # at most 3^5 * 64 rows
    return fit_counts([(r["kind"], tuple(r[k] for k in LABELERS), r["size"], r["digits"], r["n"]) for r in counts]) if counts else None


def find_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Spans of personal data: (__id, __text, kind, start, end, base); ``base`` tells the fixed patterns' spans."""
    spans = materialise(candidates(docs, id_col, text_col), "spans")
    model = fit(spans)
    keep = F.col("base") if model is None else F.col("base") | (model.score() >= 0)
    return spans.where(keep).select("__id", "__text", "kind", "start", "end", "base")


def span_lists(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document with ``spans``, an array<struct<start, rank, kind, end, base>> in order of start and kind."""
    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).cast("int")
    one = F.struct("start", rank.alias("rank"), "kind", "end", "base")
    lists = find_spans(docs, id_col, text_col).groupBy("__id", "__text").agg(F.sort_array(F.collect_list(one)).alias("spans"))
    lists = lists.withColumnsRenamed({"__id": "__sid", "__text": "__stext"})
    own = docs.select(F.col(id_col), text_hash(whole(text_col)).alias("__text"))
    joined = own.join(lists, own[id_col].eqNullSafe(lists["__sid"]) & (own["__text"] == lists["__stext"]), "left")
    return joined.select(id_col, F.coalesce("spans", F.array().cast(lists.schema["spans"].dataType)).alias("spans"))
