"""Connected components of a graph held in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.scratch import Scratch

EDGES = 200_000


def components(links: DataFrame) -> DataFrame:
    """(node, part) for every node of links (a, b): `part` is the smallest node of its component.

    Alternating steps: every node hands its larger neighbours, then its smaller ones, to the smallest one it knows, until all
    point at the smallest of their component. Rounds grow with the logarithm of the component's size; each is grouped sums and a join.
    """
    scratch = Scratch(links.sparkSession)

    # one file for so many edges, so that small graphs do not pay for wide shuffles
    def lay(rows: DataFrame, about: int) -> tuple[DataFrame, tuple]:
        rows = scratch.lay(rows.coalesce(about // EDGES + 1), "edges")
        return rows, tuple(rows.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())

    plain = links.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges, state = lay(plain.distinct(), links.count())
    before = None
    while state != before and state[0]:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a")
        kept = small.select("a", F.col("m").alias("b"))
        moved = small.filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        before = state
        edges, state = lay(kept.union(moved).distinct(), before[0])
        scratch.clear(keep=1)
    return edges.select(F.col("a").alias("node"), F.col("b").alias("part")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("part")).distinct()
    )
