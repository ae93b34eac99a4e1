"""Connected components of a link table, by large-star / small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def components(links: DataFrame) -> DataFrame:
    """``links(a, b)`` of long ids -> (node, root), root the smallest id of the
    node's component.  Alternating star rounds shrink every component to a star
    in a logarithmic number of rounds; each round is two groupings whose
    minima are partly built before the shuffle, and is checkpointed in the
    shared folder; they end when the edges (their number and two 64-bit sums of
    hashes) stay the same.  Nodes without links do not appear."""
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = edges.checkpoint()
    state = None
    while True:
        # large star: larger neighbours of a node move to its smallest neighbour (or itself)
        both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(
            F.col("u").alias("n"), F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, F.col("u") == F.col("n")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        # small star: a node and its smaller neighbours move to the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("n"), "m")
        moved = large.join(least, F.col("u") == F.col("n"))
        edges = (moved.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
                 .unionAll(least.select(F.col("n").alias("u"), F.col("m").alias("v"))).distinct().checkpoint())
        now = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("s"), F.bit_xor(F.xxhash64("v", "u")).alias("t")).first()
        if state == now:
            break
        state = now
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(roots)
