"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shared import materialize

MAX_ROUNDS = 50


def _star(pairs: DataFrame, large: bool) -> DataFrame:
    """Hangs each node's neighbours (large: those above it; small: those below it and itself) on the least of them."""
    if large:
        both = pairs.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(pairs.select(F.col("b").alias("u"), F.col("a").alias("v")))
    else:
        both = pairs.select(F.col("a").alias("u"), F.col("b").alias("v"))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    near = both.join(least.withColumn("m", F.least("u", "m")), "u")
    if large:
        return near.filter(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b"))
    hung = near.filter(F.col("v") != F.col("m")).select(F.col("v").alias("a"), F.col("m").alias("b"))
    return hung.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct()


def roots(pairs: DataFrame) -> DataFrame:
    """``node``, ``root`` (least node reachable) for every node of ``pairs`` (``a``, ``b``) but the roots themselves.

    Each round is written to the shared folder; the rounds needed grow with the logarithm of the longest
    path. Hubs are reduced by map-side minima, and their joins can be split.
    """
    pairs = materialize(pairs.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "star")
    before = None
    for _ in range(MAX_ROUNDS):
        state = tuple(pairs.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b"))).first())
        if state == before or state[0] == 0:
            return pairs.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = state
        pairs = materialize(_star(_star(pairs, large=True), large=False), "star")
    raise RuntimeError("the components did not settle")
