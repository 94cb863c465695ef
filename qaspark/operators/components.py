"""Connected components per group, by hooking and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qaspark.session import Rounds


def connected(edges: DataFrame, keys: list[str]) -> DataFrame:
    """``(keys…, node, root)`` for every end of the undirected ``edges(keys…, a, b)``; ``root`` is one of the component's nodes.

    In a round every node hooks onto its smallest smaller neighbour, the chains are cut short by jumping, and each tree
    becomes one node. Only nodes smaller than all their neighbours remain, at most half of those that still have an edge, so the
    rounds are at most the logarithm of the largest component. Every step writes to the shared folder.
    """
    rounds, tops, names = Rounds("links"), Rounds("tops"), Rounds("names")
    links = edges.select(*keys, F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where(F.col("a") < F.col("b")).distinct()
    links, seen = rounds.write(links, rows=F.count(F.lit(1)))
    nodes = links.select(*keys, F.explode(F.array("a", "b")).alias("node")).distinct()
    names_now, _ = names.write(nodes.withColumn("root", F.col("node")))
    while seen["rows"]:
        up = links.groupBy(*keys, F.col("b").alias("node")).agg(F.min("a").alias("up"))
        up, _ = tops.write(up)
        moved = True
        while moved:
            above = up.select(*keys, F.col("node").alias("up"), F.col("up").alias("_top"))
            jumped = up.join(above, [*keys, "up"], "left").select(*keys, "node", F.coalesce("_top", "up").alias("up"), F.col("_top").isNotNull().alias("_moved"))
            up, step = tops.write(jumped, moved=F.count_if("_moved"))
            up, moved = up.drop("_moved"), step["moved"] > 0
        hooked = up.select(*keys, F.col("node").alias("_from"), F.col("up").alias("_to"))

        def renamed(table: DataFrame, column: str, hooked: DataFrame = hooked) -> DataFrame:
            matched = hooked.withColumnRenamed("_from", column)
            return table.join(matched, [*keys, column], "left").withColumn(column, F.coalesce("_to", column)).drop("_to")

        names_now, _ = names.write(renamed(names_now, "root").select(*keys, "node", "root"))
        both = renamed(renamed(links, "a"), "b")
        links, seen = rounds.write(
            both.select(*keys, F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where(F.col("a") < F.col("b")).distinct(), rows=F.count(F.lit(1))
        )
    return names_now
