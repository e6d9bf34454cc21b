"""Mixing sources to target weights by Pareto order sampling.

Sources in code point order, null last, weigh 1, 2, 3, 1, 2, 3, ...; targets
share a given part of all words by weight, none above ``max_repeats`` times its
source's size, what is cut off being shared again by weight.

Documents of a source don't all count alike: a document's measure is the bit length of
its number of words (1 for one word, 10 for 600, 15 for 20,000), so that long ones, which
say more, are preferred.  It is expected ``c`` times its measure, at most
``max_repeats`` times, with the ``c`` that makes the expected words of the source its
target.  The whole part of that is certain, the rest is its inclusion probability ``p``.
Pareto order sampling ranks the documents of a source by random odds divided by inclusion
odds, ``u / (1 - u) * (1 - p) / p``, with a random ``u`` that hangs on the id and the text
alone, and takes the lowest ranks up to a fixed size.  The size is fixed in words, the
unit of the targets: ranks are taken as long as their words fit.

What then remains is offered, in the same order, to each document that still fits.  In
the end every document left out has more words than remain; the shortest
of these is taken too if that brings the total nearer.  Hence the words taken miss the
target by at most half of the shortest document left out (or by nothing but rounding, if
none is).  Equal rows are one document here, with the words of all.

No source is sorted or gathered.  The rank at which a source is full is found
by refining histograms of words over ranks, 8,192 bins a source and round, so a
source with a third of all rows costs a sum with map-side aggregation.

Defined results:

* null or empty text: size 0, taken 0;
* null source: a source of its own, the last one; an all-empty source has target 0;
* rows that share an id get a ``u`` each from their texts; equal rows share one
  ``u`` and are taken or left together;
* texts of any length are counted whole; a document longer than what remains is left out;
* ties of rank are taken or left together; ties of length go to the lower rank;
* an empty table gives an empty table; other columns stay, whatever their names.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import WORD, few_tasks, materialise, text_hash, whole

#: Bits of a rank that one round of the histogram tells apart, that all rounds do, and bits of a rank in all.
ROUND_BITS, CUT_BITS, RANK_BITS = 13, 26, 39
#: Documents of at most this part of what remains of a source are offered it before the others; parts a source's are dealt into.
PART, SALTS = 8192, 256


def measure(words: Column) -> Column:
    """The bit length of a number of words: 0 for none."""
    return F.when(words > 0, F.length(F.bin(words))).otherwise(0).cast("int")


def targets(sizes: DataFrame, weights: tuple[int, ...], total_share: float, max_repeats: float) -> DataFrame:
    """(__source, __words, ...) to the same and (__target).

    One row per source.  Only single sums come to the driver; each pass closes the
    sources that would be above their limit and shares the rest anew, which is Newton's
    method on a concave function, from below: its passes are few, however many sources.
    """
    ranged = sizes.repartitionByRange(F.col("__source").asc_nulls_last()).withColumn("__part", F.spark_partition_id())
    ranged = materialise(ranged, "sources")
    before, so_far = [], 0
    for part, n in sorted(ranged.groupBy("__part").count().collect()):  # as many rows as partitions
        before, so_far = [*before, F.lit(part), F.lit(so_far)], so_far + n
    offset = F.element_at(F.create_map(*before), F.col("__part")) if before else F.lit(0)
    at = offset + F.row_number().over(W.partitionBy("__part").orderBy(F.col("__source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (at % len(weights) + 1).cast("int"))
    placed = materialise(ranged.withColumn("__weight", weight).withColumn("__limit", max_repeats * F.col("__words")).drop("__part"), "sources")
    total = placed.agg(F.sum("__words")).first()[0] or 0
    level, closed = 0.0, -1
    while True:  # ends: the closed sources only grow, and one pass without a new one is the last
        full = F.col("__limit") <= level * F.col("__weight")
        row = placed.agg(F.sum(F.when(full, F.col("__limit")).otherwise(0.0)), F.sum(F.when(~full, F.col("__weight")).otherwise(0.0)), F.count(F.when(full, 1))).first()
        if not row[1] or (row[2] == closed):
            break
        closed, level = row[2], max(level, (total_share * total - row[0]) / row[1])
    return placed.withColumn("__target", F.least(F.col("__limit"), level * F.col("__weight"))).drop("__limit", "__weight")


def expectation(classes: Column, target: Column, max_repeats: float) -> Column:
    """``c``, from a source's array of (measure, words), the highest measure first.

    The expected words ``sum(words * least(max_repeats, c * measure))`` are its target;
    measures are closed at ``max_repeats`` from the highest down as long as it takes.
    """
    open_ = F.aggregate(classes, F.lit(0.0), lambda a, x: a + x["m"] * x["w"])
    zero = F.struct(F.lit(0.0).alias("closed"), open_.alias("open"), F.lit(None).cast("double").alias("c"))

    def step(a: Column, x: Column) -> Column:
        c = (target - a["closed"]) / a["open"]
        more = F.struct((a["closed"] + max_repeats * x["w"]).alias("closed"), (a["open"] - x["m"] * x["w"]).alias("open"), F.lit(None).cast("double").alias("c"))
        return F.when(a["c"].isNotNull(), a).when(c * x["m"] <= max_repeats, F.struct(a["closed"], a["open"], c.alias("c"))).otherwise(more)

    return F.coalesce(F.aggregate(classes, zero, step)["c"], F.lit(float(max_repeats)))  # all closed: measures are 1 at least


def plan_of(rows: DataFrame, weights: tuple[int, ...], total_share: float, max_repeats: int) -> DataFrame:
    """(__source, __source_words, __target, __c) of rows (__source, __words)."""
    classes = rows.groupBy("__source", measure(F.col("__words")).alias("m")).agg(F.sum("__words").alias("w"))
    listed = F.sort_array(F.collect_list(F.when(F.col("m") > 0, F.struct("m", F.col("w").cast("double").alias("w")))), asc=False)  # at most 64
    sizes = classes.groupBy("__source").agg(F.sum("w").alias("__words"), listed.alias("__classes"))
    plan = targets(sizes, weights, total_share, max_repeats)
    c = F.when(F.col("__words") > 0, expectation(F.col("__classes"), F.col("__target"), max_repeats)).otherwise(F.lit(0.0))
    return materialise(plan.select("__source", F.col("__words").alias("__source_words"), "__target", c.alias("__c")), "plan")


def random_part(seed: int) -> Column:
    """``u`` of a row (__id, __text): above 0 and below 1."""
    return (F.shiftrightunsigned(F.xxhash64(F.lit(seed), "__id", "__text"), 12) + 0.5) / float(1 << 52)


def _full_at(offers: DataFrame, left: DataFrame) -> DataFrame:
    """For each source the rank up to which offered words fit into what is left: (__s, __room, __cut).

    Ranks below the cut are taken and leave ``__room`` words, fewer than the next bin has.
    Rounds go from the top bits of the rank down: in each, the bins of the source's open
    interval are summed in order, and the first bin that doesn't fit is opened.
    """
    state = left.select(F.col("__source").alias("__s"), F.col("__left").alias("__room"), F.lit(0).cast("long").alias("__cut"))
    for done in range(ROUND_BITS, CUT_BITS + 1, ROUND_BITS):
        shift = RANK_BITS - done
        same = offers["__source"].eqNullSafe(state["__s"]) & (F.shiftright("__rank", shift + ROUND_BITS) == F.shiftright("__cut", shift + ROUND_BITS))
        bins = offers.join(state, same).groupBy("__source", F.shiftright("__rank", shift).alias("__bin")).agg(F.sum("__words").alias("__words"))
        listed = bins.groupBy("__source").agg(F.sort_array(F.collect_list(F.struct("__bin", "__words"))).alias("__bins"))  # at most 2^ROUND_BITS
        joined = state.join(listed, state["__s"].eqNullSafe(listed["__source"]), "left").select("__s", "__room", "__cut", "__bins")
        zero = F.struct(F.col("__room").alias("room"), F.lit(None).cast("long").alias("at"))
        step = lambda a, b: F.when(a["at"].isNotNull(), a).when(b["__words"] <= a["room"], F.struct((a["room"] - b["__words"]).alias("room"), a["at"].alias("at"))).otherwise(F.struct(a["room"].alias("room"), b["__bin"].alias("at")))
        found = F.aggregate(F.coalesce("__bins", F.array().cast(listed.schema["__bins"].dataType)), zero, step)
        end = F.shiftleft(F.shiftright("__cut", shift + ROUND_BITS) + 1, shift + ROUND_BITS)  # the whole interval fits
        found = joined.select("__s", "__cut", found.alias("f"))
        state = found.select("__s", F.col("f.room").alias("__room"), F.coalesce(F.shiftleft(F.col("f.at"), shift), end).alias("__cut"))
        state = materialise(state, "cuts")
    return state


def greedy(room: float, words: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Which documents of one source fit into ``room``, in the order of ranks; then the shortest of each measure, from long to short; then one more if that is nearer."""
    order = np.lexsort((words, rank)).tolist()
    long_first = sorted(range(len(words)), key=lambda i: (-int(words[i]).bit_length(), int(words[i]), int(rank[i])))
    took = np.zeros(len(words), bool)
    for i in order + long_first:
        if not took[i] and words[i] <= room:
            took[i], room = True, room - words[i]
    short = min(np.flatnonzero(~took).tolist(), key=lambda i: (words[i], rank[i]), default=None)
    if short is not None and words[short] < 2 * room:
        took[short] = True
    return took


def _greedy(some: pd.DataFrame) -> pd.DataFrame:
    return some[greedy(some["__room"].iloc[0], some["__words"].to_numpy(), some["__rank"].to_numpy())][["__source", "__rank", "__most"]]


def _top_up(offers: DataFrame, cuts: DataFrame) -> DataFrame:
    """What remains of each source goes to these of the documents left out: (__source, __rank, __most).

    Those of a source and rank with fewer words than ``__most``.  Documents of up to a
    ``PART`` of the room come first, as long as there are any: what they leave is less than
    that part and a document, or they all fit.  Of those above, ``PART`` at most can fit; so
    of each measure the ``2 * PART + 1`` lowest ranks, which would overfill the room twice, and
    the two shortest are enough, a bounded number of rows a source.
    """
    rest = offers.join(cuts, offers["__source"].eqNullSafe(cuts["__s"])).where((F.col("__rank") >= F.col("__cut")) & (F.col("__words") < 2 * F.col("__room")))
    units = rest.groupBy("__source", "__rank", (2 * F.col("__room")).alias("__most")).agg(F.sum("__words").alias("__words"))
    rooms, chosen, before = cuts.select("__s", "__room"), [], None
    while True:
        near = units.join(rooms, units["__source"].eqNullSafe(rooms["__s"])).where(F.col("__words") < 2 * F.col("__room"))
        near = materialise(near.select("__source", "__rank", "__most", "__words", "__room"), "near")
        offered = near.where(PART * F.col("__words") <= F.col("__room"))
        if offered.isEmpty() or (now := rooms.agg(F.sum("__room")).first()[0]) == before:
            break
        before = now
        cuts = _full_at(offered.drop("__room", "__most"), rooms.select(F.col("__s").alias("__source"), F.col("__room").alias("__left")))
        after = cuts.select(F.col("__s").alias("__as"), "__cut")
        marked = near.join(after, near["__source"].eqNullSafe(after["__as"]))
        took = (PART * F.col("__words") <= F.col("__room")) & (F.col("__rank") < F.col("__cut"))
        chosen.append(marked.where(took).select("__source", "__rank", "__most"))
        units, rooms = marked.where(~took).select("__source", "__rank", "__most", "__words"), cuts.select("__s", "__room")
    last = near.withColumn("__m", measure(F.col("__words"))).withColumn("__salt", F.pmod(F.xxhash64("__rank"), F.lit(SALTS)))
    for of in (W.partitionBy("__source", "__m", "__salt"), W.partitionBy("__source", "__m")):  # a hot source is cut down in parts first
        low, short = F.row_number().over(of.orderBy("__rank", "__words")), F.row_number().over(of.orderBy("__words", "__rank"))
        last = last.withColumns({"__low": low, "__short": short}).where((F.col("__low") <= 2 * PART + 1) | (F.col("__short") <= 2))
    chosen.append(last.groupBy("__source").applyInPandas(_greedy, near.select("__source", "__rank", "__most").schema))
    return reduce(DataFrame.unionByName, chosen)


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = (1, 2, 3),
    total_share: float = 1.0,
    max_repeats: int = 3,
    seed: int = 17,
) -> DataFrame:
    """How often each document is taken: (__id, __text, __words, __source, __source_words, __target, __whole, __p, __copies int).

    One row per row of ``docs``; ``__whole`` copies are certain, one more has the
    inclusion probability ``__p``.
    """
    rows = docs.select(F.col(id_col).alias("__id"), F.col(source_col).alias("__source"), whole(text_col).alias("__t"))
    rows = materialise(rows.select("__id", "__source", text_hash(F.col("__t")).alias("__text"), F.regexp_count("__t", F.lit(WORD)).cast("long").alias("__words")), "sizes")
    plan = plan_of(rows, weights, total_share, max_repeats).withColumnRenamed("__source", "__ps")
    times = F.least(F.lit(float(max_repeats)), F.col("__c") * measure(F.col("__words")))
    odds = F.col("__u") / (1 - F.col("__u")) * (1 - F.col("__p")) / F.col("__p")
    rank = F.least(F.floor(odds / (1 + odds) * float(1 << RANK_BITS)).cast("long"), F.lit((1 << RANK_BITS) - 1))  # in the order of the odds
    expected = rows.join(plan, rows["__source"].eqNullSafe(plan["__ps"])).drop("__ps").withColumn("__times", times)
    expected = expected.withColumn("__whole", F.floor("__times").cast("int")).withColumn("__p", F.col("__times") - F.col("__whole")).withColumn("__u", random_part(seed))
    expected = materialise(expected.withColumn("__rank", F.when(F.col("__p") > 0, rank)).drop("__u", "__c", "__times"), "expected")
    certain = expected.groupBy("__source", "__target").agg(F.sum(F.col("__whole") * F.col("__words")).alias("__w"))
    left = certain.select("__source", F.greatest(F.lit(0.0), F.col("__target") - F.col("__w")).alias("__left"))
    offers = expected.where("__rank IS NOT NULL AND __words > 0").select("__id", "__text", "__source", "__words", "__rank")
    cuts = _full_at(offers, left)
    top = materialise(_top_up(offers, cuts), "top").withColumnsRenamed({"__rank": "__trank", "__source": "__ts"})
    cuts = cuts.select(F.col("__s").alias("__cs"), "__cut")
    all_ = expected.join(cuts, expected["__source"].eqNullSafe(cuts["__cs"]))
    same = (all_["__rank"] == top["__trank"]) & all_["__source"].eqNullSafe(top["__ts"])
    extra = ((F.col("__rank") < F.col("__cut")) | F.coalesce(F.col("__words") < F.col("__most"), F.lit(False))).cast("int")
    extra = F.coalesce(extra, F.lit(0))  # no rank: nothing is offered
    copies = F.when(F.col("__words") > 0, F.col("__whole") + extra).otherwise(F.lit(0))
    return all_.join(top, same, "left").select("__id", "__text", "__words", "__source", "__source_words", "__target", "__whole", "__p", copies.cast("int").alias("__copies"))


def mixed_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The rows of ``docs``, each as often as :func:`mix` takes it, or not at all."""
    taken = mix(docs, id_col, text_col, source_col, **options).where("__copies > 0").select("__id", "__text", "__source", "__copies").distinct()
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(id_col).alias("__rid"), F.col(source_col).alias("__rs"), text_hash(whole(text_col)).alias("__rtext"))
    same = F.col("__rid").eqNullSafe(F.col("__id")) & (F.col("__rtext") == F.col("__text")) & F.col("__rs").eqNullSafe(F.col("__source"))
    return few_tasks(rows.join(taken, same).select("row", F.explode(F.sequence(F.lit(1), F.col("__copies")))).select("row.*"), docs)
