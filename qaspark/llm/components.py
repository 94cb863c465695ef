"""Connected components of a graph of links, by alternating stars; every round is written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qaspark.session import Rounds, few_files


def sized(df: DataFrame, rows: int, most: int = 500_000) -> DataFrame:
    """``df`` marked for broadcast if its counted ``rows`` (of a few numbers each) are at most ``most``; else as it is."""
    return F.broadcast(df) if rows <= most else df


def components(links: DataFrame, rows: int | None = None) -> DataFrame:
    """``node, component`` (the smallest node reachable) for every end of the undirected ``links`` (``a``, ``b``).

    Each round ties every node to the smallest of its larger star, then of its smaller star; it ends when a
    round changes nothing, after a number of rounds that grows with the logarithm of the longest chain. ``rows`` is the most
    rows that ``links`` can have, if known; no round has more than the one before.
    """
    marks = {"rows": F.count(F.lit(1)), "mark": F.bit_xor(F.xxhash64("u", "v"))}
    edges = links.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    rounds = Rounds("links")
    edges, before = rounds.write(edges if rows is None else few_files(edges, rows), **marks)
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v")).union(low).distinct()
        edges, after = rounds.write(few_files(small, before["rows"]), **marks)
        if after == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        before = after
