"""Connected components of a graph of 64-bit nodes, by alternating large and small stars.

Every round links neighbours to the smallest node known around them; a path of n
nodes is a star after O(log n) rounds.  All steps are aggregations and joins; a
node with very many neighbours costs a partial aggregation and a join whose sides
are both plain shuffles, so that its partition can be split.  A round works in tasks of
about ``ROWS`` edges, and in ``TASKS`` of them at least: few edges aren't spread over as many
tasks and files as the texts need.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import discard
from .common import few_tasks, materialise


#: Edges of a task, and the fewest tasks of a round.
ROWS, TASKS = 200_000, 12


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("b", "a").bitwiseAND(F.lit((1 << 31) - 1)))).first())


def components(edges: DataFrame, source: DataFrame | None = None) -> DataFrame:
    """Edges (a, b) to (node, root) of every node but the roots; a root is its component's smallest node.

    If given, the size of ``source``, what the edges were found in, limits the tasks that write them.
    """
    plain = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    plain = materialise(plain if source is None else few_tasks(plain, source), "edges")
    last = None
    while (now := _mark(plain)) != last:
        last, tasks = now, max(TASKS, now[0] // ROWS)
        both = plain.unionByName(plain.select(F.col("b").alias("a"), F.col("a").alias("b")))
        around = materialise(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m")).coalesce(tasks), "least")
        large = both.join(around, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        large = materialise(large.coalesce(tasks), "large")
        below = materialise(large.groupBy("a").agg(F.min("b").alias("m")).coalesce(tasks), "least")
        small = large.join(below, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = materialise(small.unionByName(below.select("a", F.col("m").alias("b"))).distinct().coalesce(tasks), "small")
        discard(plain, around, large, below)  # a round needs only what the one before has written
        plain = small
    return plain.select(F.col("a").alias("node"), F.col("b").alias("root"))
