"""Connected components by alternating large and small stars, on written edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from planpulse.llm.common import to_scratch


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``edges(u, v)`` of any comparable type -> ``(u, v)`` with v the least node that u
    reaches; least nodes themselves have no row.  Null ends and self links are ignored.

    A large star links each node's larger neighbours to its least one, a small star its
    smaller ones; after a number of rounds logarithmic in the longest path, only stars are
    left.  Each half round pre-aggregates the minimum per node before its shuffle, joins it
    to the written edges (so a hub's rows can be split), and writes the result.
    """
    e = to_scratch(edges.filter(F.col("u") != F.col("v")).select("u", "v").distinct(), "edges")
    before = None
    turn = 0
    while (now := _state(e)) != before and now[0]:
        before = now
        both = e.union(e.select("v", "u"))
        least = to_scratch(both.groupBy("u").agg(F.min("v").alias("m")), f"least{turn}")
        large = both.join(least, "u").filter(F.col("v") > F.col("u")) \
                    .select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()
        large = to_scratch(large, f"large{turn}")
        least = to_scratch(large.groupBy("u").agg(F.min("v").alias("m")), f"small-least{turn}")
        small = large.join(least, "u").filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v")) \
                     .union(least.select("u", F.col("m").alias("v"))).distinct()
        e = to_scratch(small, f"small{turn}")
        turn += 1
    return e
