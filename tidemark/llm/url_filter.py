"""A URL filter: rules first, gradient-boosted trees on lexical features for the rest.

Rules are ``host/path`` strings with a verdict; the longest that fits wins.  URLs
that a rule decides are the labelled ones.  From all of them come the suffix
statistics: how many URLs of each group in ``GROUPS``, the host's last label, its last two,
the whole host, the path's first segment and the two together, are allowed.  They are
counted in ``BUCKETS`` hashed buckets for each of ``FOLDS`` folds, so what reaches the driver
and the tasks is bounded; a group seen nowhere has the value ``UNSEEN``.

From a bounded sample, the ``max_train`` lowest by a hash of URL and id (only a little more
than that many are ever sent to the driver), a histogram gradient-boosted forest is fitted
on the driver with numpy.  An example's own fold is left out of its statistics, so that its
label isn't among its features, and of one example in ``HIDE`` all statistics of the host
are hidden, so that the forest learns what to say of hosts it has never seen.  Scoring is
one pass over the URLs in Arrow batches; only id and URL are read, nothing is shuffled.

Defined results:

* null URL, or one without ``://``: host and path are empty, no rule fits, the
  forest judges the text there is;
* a score of exactly one half is allowed;
* no labelled URL at all: every URL without a rule is allowed; only one class: that one;
* rows are independent: repeated ids, URLs and rows just repeat, and null ids stay;
* URLs of any length are judged whole; only those up to ``MAX_URL`` characters are in
  the sample;
* an empty table gives an empty table; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .common import ascii_lower

#: The rules of the contract; fixed values.
RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]
#: Buckets of all groups, folds of the statistics, the value of a group never seen, one in so many examples hides its host's.
BUCKETS, FOLDS, UNSEEN, HIDE, MAX_URL = 4096, 4, -1.0, 5, 4096
GROUPS = ["label", "domain", "host", "segment", "label_segment"]
#: Those of the host, which a new one lacks.
OF_HOST = [GROUPS.index(g) for g in ("label", "domain", "host", "label_segment")]
LEXICAL = ["length", "host_length", "path_length", "depth", "digit_ratio", "entropy", "parameters", "hyphens", "host_labels", "first_length", "second_length", "second_start", "last_digits"]
FEATURES = [*LEXICAL, *(f"{g}_{x}" for g in GROUPS for x in ("rate", "weight"))]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host with A-Z lower-cased, and path; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.lit(2**31 - 1))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    return ascii_lower(F.regexp_extract(rest, "^[^/?#]*", 0)), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def matching_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; nulls where none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for said, text in sorted(rules, key=lambda r: len(r[1])):  # later ones, the longer, come first
        name, _, start = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + start)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, said).otherwise(verdict)
    return rule, verdict


def buckets(host: Column, path: Column) -> Column:
    """The bucket of each of GROUPS."""
    label, segment = F.substring_index(host, ".", -1), F.get(F.split(path, "/"), F.lit(1))
    values = [label, F.substring_index(host, ".", -2), host, segment, F.concat(label, F.lit("/"), segment)]
    return F.array(*(F.pmod(F.xxhash64(F.lit(k), F.coalesce(v, F.lit(""))), F.lit(BUCKETS)).cast("int") for k, v in enumerate(values)))


def fold(url: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit(3), url), F.lit(FOLDS)).cast("int")


def lexical(urls: list[str], hosts: list[str], paths: list[str]) -> np.ndarray:
    """One row of LEXICAL for each URL."""
    out = np.zeros((len(urls), len(LEXICAL)))
    for i, (url, host, path) in enumerate(zip(urls, hosts, paths, strict=True)):
        data = np.frombuffer(url.encode("utf-8", "surrogatepass"), np.uint8)
        counts = np.bincount(data, minlength=1)
        share = counts[counts > 0] / max(1, len(data))
        digits = int(((data >= 48) & (data <= 57)).sum())
        query = url.partition("?")[2].partition("#")[0]
        parameters = query.count("&") + 1 if query else 0
        _, first, second, *_ = [*path.split("/", 3), "", "", ""]
        named = [x for x in path.split("/") if x]
        last = named[-1] if named else ""
        out[i] = (
            len(url), len(host), len(path), len(named), digits / max(1, len(data)), -(share * np.log2(share)).sum(), parameters, url.count("-"), host.count(".") + bool(host),
            len(first), len(second), ord(second[0]) if second else 0, sum(c.isdigit() for c in last),
        )
    return out


class Statistics:
    """Allowed and all labelled URLs of each bucket, by fold."""

    def __init__(self, counts: np.ndarray):
        self.counts = counts  #: FOLDS x len(GROUPS) x BUCKETS x (all, allowed)
        self.whole = self._features(counts.sum(axis=0))
        self.without = [self._features(counts.sum(axis=0) - counts[f]) for f in range(FOLDS)]

    @staticmethod
    def _features(counts: np.ndarray) -> np.ndarray:
        """Rate and weight of each bucket: len(GROUPS) x BUCKETS x 2."""
        n, k = counts[..., 0].astype(float), counts[..., 1]
        prior = k[0].sum() / max(1.0, n[0].sum())
        return np.stack([np.where(n > 0, (k + 5 * prior) / (n + 5), UNSEEN), np.log1p(n)], axis=-1)

    def of(self, buckets: np.ndarray, folds: np.ndarray | None = None, hidden: np.ndarray | None = None) -> np.ndarray:
        """A row of rates and weights for each row of buckets, without its fold if ``folds`` are given."""
        at = np.arange(len(GROUPS))
        found = self.whole[at, buckets] if folds is None else np.stack(self.without)[folds[:, None], at, buckets]
        if hidden is not None:
            found[np.ix_(np.flatnonzero(hidden), OF_HOST)] = (UNSEEN, 0.0)
        return found.reshape(len(buckets), -1)


@dataclass
class Forest:
    """Trees as arrays: at a node, ``feature`` below ``cut`` goes left; ``value`` is a leaf's log-odds."""

    base: float
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]]  #: feature (-1: leaf), cut, value; children of i are 2i+1, 2i+2

    def odds(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, cut, value in self.trees:
            node = np.zeros(len(x), np.int64)
            while True:
                f = feature[node]
                inner = f >= 0
                if not inner.any():
                    break
                left = x[rows, np.maximum(f, 0)] < cut[node]
                node = np.where(inner, 2 * node + np.where(left, 1, 2), node)
            total += value[node]
        return total


def fit(x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 4, bins: int = 32, rate: float = 0.2, leaf: int = 5, ridge: float = 1.0) -> Forest:
    """Second-order boosting of the logistic loss over quantile histograms."""
    base = float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)))
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(e, c, side="right") for e, c in zip(edges, x.T, strict=True)], axis=1)
    odds, made = np.full(len(y), base), []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-odds))
        slope, curve = p - y, p * (1 - p)
        size = 2 ** (depth + 1) - 1
        feature, cut, value = np.full(size, -1), np.zeros(size), np.zeros(size)
        node = np.zeros(len(y), np.int64)
        for i in range(size):
            here = np.flatnonzero(node == i)
            if not len(here):
                continue
            g, h = slope[here].sum(), curve[here].sum()
            value[i] = -rate * g / (h + ridge)
            best = (1e-6, -1, 0)
            if i < 2**depth - 1 and len(here) >= 2 * leaf:
                for f, e in enumerate(edges):
                    if not len(e):
                        continue
                    b = binned[here, f]
                    gs = np.cumsum(np.bincount(b, slope[here], len(e) + 1))[:-1]
                    hs = np.cumsum(np.bincount(b, curve[here], len(e) + 1))[:-1]
                    ns = np.cumsum(np.bincount(b, minlength=len(e) + 1))[:-1]
                    gain = gs**2 / (hs + ridge) + (g - gs) ** 2 / (h - hs + ridge) - g**2 / (h + ridge)
                    gain[(ns < leaf) | (len(here) - ns < leaf)] = 0
                    k = int(gain.argmax())
                    if gain[k] > best[0]:
                        best = (gain[k], f, k)
            if best[1] >= 0:
                feature[i], cut[i] = best[1], edges[best[1]][best[2]]
                node[here] = np.where(binned[here, best[1]] <= best[2], 2 * i + 1, 2 * i + 2)
        made.append((feature, cut, value))
        odds += value[node]
    return Forest(base, made)


@dataclass
class Model:
    statistics: Statistics
    forest: Forest

    def score(self, urls: list[str], hosts: list[str], paths: list[str], buckets: np.ndarray) -> np.ndarray:
        """Probability of allow."""
        x = np.concatenate([lexical(urls, hosts, paths), self.statistics.of(buckets)], axis=1)
        return 1 / (1 + np.exp(-self.forest.odds(x)))


def _parts(pages: DataFrame, id_col: str, url_col: str, rules: list[tuple[str, str]]) -> DataFrame:
    rows = pages.select(F.col(id_col).alias("__id"), F.coalesce(F.col(url_col), F.lit("")).alias("__url"))
    host, path = host_and_path(F.col("__url"))
    rows = rows.select("__id", "__url", host.alias("__host"), path.alias("__path"))
    rule, verdict = matching_rule(F.col("__host"), F.col("__path"), rules)
    return rows.select("*", rule.alias("__rule"), verdict.alias("__said"), buckets(F.col("__host"), F.col("__path")).alias("__buckets"))


def train(parts: DataFrame, max_train: int = 20_000) -> Model | None:
    """Fit on the URLs that a rule decides: statistics of all, trees on ``max_train`` of them."""
    labelled = parts.where(F.col("__said").isNotNull())
    good = (F.col("__said") == "allow").cast("int")
    each = labelled.select(fold(F.col("__url")).alias("f"), good.alias("y"), F.posexplode("__buckets").alias("g", "b"))
    sums = each.groupBy("f", "g", "b").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("k")).collect()  # at most FOLDS * len(GROUPS) * BUCKETS rows
    if not sums:
        return None
    counts = np.zeros((FOLDS, len(GROUPS), BUCKETS, 2), np.int64)
    for r in sums:
        counts[r["f"], r["g"], r["b"]] = r["n"], r["k"]
    statistics, (n, k) = Statistics(counts), counts[:, 0].sum(axis=(0, 1)).tolist()
    short = labelled.where(F.char_length("__url") <= MAX_URL)
    short = short.select("__url", "__host", "__path", "__buckets", fold(F.col("__url")).alias("f"), good.alias("y"), F.xxhash64("__url", "__id").alias("o"))
    # of a uniform hash so low a part that it holds hardly more rows than are wanted: only these go to the driver
    part = min(1.0, (1.2 * max_train + 200) / n)
    low = short.where(F.shiftrightunsigned("o", 34) < int(part * (1 << 30)))
    sample = sorted(low.orderBy(F.shiftrightunsigned("o", 34), "o", "__url").limit(max_train).collect(), key=lambda r: (r["o"], r["__url"]))
    if not sample:
        return Model(statistics, Forest(float(np.log((k + 1e-9) / (n - k + 1e-9))), []))
    hidden = np.array([r["o"] % HIDE == 0 for r in sample])
    known = statistics.of(np.array([r["__buckets"] for r in sample]), np.array([r["f"] for r in sample]), hidden)
    x = np.concatenate([lexical(*([r[c] for r in sample] for c in ("__url", "__host", "__path"))), known], axis=1)
    return Model(statistics, fit(x, np.array([r["y"] for r in sample], float)))


def judge(pages: DataFrame, rules: list[tuple[str, str]] = RULES, max_train: int = 20_000, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(id, host, path, rule, verdict, score) of each page; ``score`` is the forest's probability of allow."""
    parts = _parts(pages, id_col, url_col, rules)
    model = train(parts, max_train)
    schema = StructType([*parts.drop("__buckets").schema, StructField("score", DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if model is None:
                score = np.ones(batch.num_rows)
            else:
                cols = [batch.column(c).to_pylist() for c in ("__url", "__host", "__path")]
                score = model.score(*cols, batch.column("__buckets").flatten().to_numpy().reshape(-1, len(GROUPS)))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in schema.names[:-1]), pa.array(score)], schema.names)

    scored = parts.mapInArrow(run, schema)
    verdict = F.coalesce("__said", F.when(F.col("score") >= 0.5, "allow").otherwise("block"))
    return scored.select(F.col("__id").alias(id_col), F.col("__host").alias("host"), F.col("__path").alias("path"), F.col("__rule").alias("rule"), verdict.alias("verdict"), "score")
