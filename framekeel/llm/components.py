"""Connected components of an edge table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.lookups import per_key
from .common import staged


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node sends its larger neighbours to the least node it knows."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = per_key(both, ["a"], F.min("b").alias("low"))
    met = both.where("b > a").join(least, "a")
    return met.select(F.col("b").alias("a"), F.least("a", "low").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node sends itself and its smaller neighbours to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = per_key(down, ["a"], F.min("b").alias("low"))
    met = down.join(least, "a").where("b > low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return met.unionByName(least.select("a", F.col("low").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component``, its least node, of every node of ``edges`` (a, b) but the least ones themselves.

    No neighbourhood is gathered: each round takes minima by key and joins them back. Rounds grow with the
    logarithm of the longest path; a graph of stars takes two. Repeated edges and loops do no harm.
    """
    edges = staged(edges.where("a <> b").select("a", "b").distinct(), "edges")
    mark = None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == mark or not state[0]:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
        mark = state
        edges = staged(_small_star(_large_star(edges)), "edges")
