"""Communities by modularity (the Louvain method) as rounds of joins, and modularity itself.

All nodes look for a better community at once. In the first rounds a half chosen by hash moves, which is fast.
After that a node moves only if no other move touches the community it leaves or the one it joins; such moves add
up to a true gain, so modularity rises with every round until nobody wants to move. Then the communities become
the nodes of the next level, until a level merges nothing. No number of rounds or levels is fixed. All languages go
through together.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from qaspark.operators.graph import both_directions, edge_ends
from qaspark.session import Rounds, measured_write, write_through

_TOLERANCE = 1e-9
#: Rounds in which a half of all nodes may move; what comes after them ends by itself.
_FREE_ROUNDS = 8
_KEY = ["language", "node"]


def modularity(edges: DataFrame, labels: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Modularity per language of ``labels(language, id, community)``; ``by`` adds keys of ``labels``."""
    keys = ["language", *(by or [])]
    ends = labels.select(*keys, "id", "community")
    source = ends.withColumnsRenamed({"id": "source", "community": "_a"})
    target = ends.withColumnsRenamed({"id": "target", "community": "_b"})
    joined = edges.join(source, ["language", "source"]).join(target, [*keys, "target"])
    sides = joined.select(
        *keys, "weight", (F.col("_a") == F.col("_b")).alias("inside"), F.explode(F.array("_a", "_b")).alias("community")
    )
    per_community = sides.groupBy(*keys, "community").agg(
        F.sum("weight").cast("double").alias("degree"), F.sum(F.when(F.col("inside"), F.col("weight")).otherwise(0)).cast("double").alias("inner")
    )
    return (
        per_community.groupBy(*keys)
        .agg(
            F.sum("degree").alias("_2m"),
            F.sum("inner").alias("_inner"),
            F.sum(F.col("degree") * F.col("degree")).alias("_squares"),
        )
        .select(*keys, (F.col("_inner") / F.col("_2m") - F.col("_squares") / (F.col("_2m") * F.col("_2m"))).alias("modularity"))
    )


def _turn() -> Column:
    """Half of the nodes by hash in even rounds, the other half in the odd round after it.

    The round is a column, so that the rounds share their compiled code.
    """
    return F.pmod(F.xxhash64("language", "node", F.floor(F.col("round") / 2)), F.lit(2)) == F.col("round") % 2


def _clear_of_others(best: DataFrame) -> DataFrame:
    """Of the nodes that want to move, those that come first in hash order in both communities they touch."""
    claim = F.struct(F.xxhash64("language", "node", "round").alias("h"), F.col("node").alias("n"))
    claims = best.where("wants").select("language", F.explode(F.array("own", "best.c")).alias("c"), claim.alias("claim"))
    first = claims.groupBy("language", "c").agg(F.min_by("claim.n", "claim").alias("first"))
    left = first.select("language", F.col("c").alias("own"), F.col("first").alias("_left"))
    joined = first.select("language", F.col("c").alias("_to"), F.col("first").alias("_joined"))
    marked = best.withColumn("_to", F.col("best.c")).join(left, ["language", "own"], "left").join(joined, ["language", "_to"], "left")
    turn = (F.col("_left") == F.col("node")) & (F.col("_joined") == F.col("node"))
    return marked.withColumn("turn", F.coalesce(turn, F.lit(False))).drop("_left", "_joined", "_to")


def _local_moves(links: DataFrame, level: int) -> DataFrame:
    """``(language, node, c)`` after moving nodes between communities until none wants to.

    ``links(language, node, other, weight)`` holds every link from both ends; a link to
    itself holds twice the weight inside the node.
    """
    strength = links.groupBy(*_KEY).agg(F.sum("weight").alias("k"))
    total = strength.groupBy("language").agg(F.sum("k").alias("two_m"))
    rounds = Rounds("communities")
    state, _ = rounds.write(
        strength.join(total, "language").select(*_KEY, F.col("node").alias("c"), "k", "two_m", F.lit(level * 100).alias("round"))
    )
    outward = links.where(F.col("node") != F.col("other"))
    number = 0
    while True:
        communities = state.groupBy("language", "c").agg(F.sum("k").alias("tot"), F.count(F.lit(1)).alias("size"))
        there = state.select("language", F.col("node").alias("other"), "c")
        seen_links = outward.join(there, ["language", "other"]).select(*_KEY, "c", "weight")
        # A row of weight 0 makes sure that every node also weighs its own community.
        own_rows = state.select(*_KEY, "c", F.lit(0.0).alias("weight"))
        inward = seen_links.unionByName(own_rows).groupBy(*_KEY, "c").agg(F.sum("weight").alias("k_in"))
        own = state.withColumnRenamed("c", "own")
        options = inward.join(own, _KEY).join(communities, ["language", "c"])
        is_own = F.col("c") == F.col("own")
        gain = F.round(F.col("k_in") - F.col("k") * (F.col("tot") - F.when(is_own, F.col("k")).otherwise(0.0)) / F.col("two_m"), 9)
        options = options.select(*_KEY, "c", "own", "k", "two_m", "round", "size", is_own.alias("is_own"), gain.alias("gain"))
        best = options.groupBy(*_KEY).agg(
            F.first("own").alias("own"),
            F.first("k").alias("k"),
            F.first("two_m").alias("two_m"),
            F.first("round").alias("round"),
            F.max(F.when(F.col("is_own"), F.col("gain"))).alias("own_gain"),
            F.max(F.when(F.col("is_own"), F.col("size"))).alias("own_size"),
            F.min_by(F.struct("c", "gain", "size"), F.struct(-F.col("gain"), F.col("c"))).alias("best"),
        )
        # Two nodes on their own would only swap: the one with the greater id moves.
        swap = (F.col("own_size") == 1) & (F.col("best.size") == 1) & (F.col("best.c") > F.col("own"))
        wants = (F.col("best.gain") > F.col("own_gain") + F.lit(_TOLERANCE)) & ~swap
        best = best.withColumn("wants", wants)
        best = best.withColumn("turn", _turn()) if number < _FREE_ROUNDS else _clear_of_others(best)
        moved = F.when(F.col("wants") & F.col("turn"), F.col("best.c")).otherwise(F.col("own"))
        step = best.select(*_KEY, moved.alias("c"), "k", "two_m", (F.col("round") + 1).alias("round"), "wants")
        state, seen = rounds.write(step, wanting=F.count_if("wants"))
        state = state.drop("wants")
        number += 1
        if not seen["wanting"]:
            break
    return state.select(*_KEY, "c")


def communities(edges: DataFrame, method: str = "louvain") -> DataFrame:
    """``(language, id, community)``, numbered from 0 by size, then by smallest member.

    ``method="none"`` puts every node into community 0.
    """
    nodes = write_through(edge_ends(edges), "ends")
    if method == "none":
        return nodes.withColumn("community", F.lit(0))
    if method != "louvain":
        raise ValueError(f"unknown method {method}")

    links = both_directions(edges).select("language", F.col("id").alias("node"), "other", F.col("weight").cast("double").alias("weight"))
    links = write_through(links, "links")
    members = nodes.select("language", "id", F.col("id").alias("node"))
    levels = [members.select("language", "id", F.col("node").alias("community"), F.lit(0).alias("level"))]
    level = 0
    while True:
        level += 1
        found = write_through(_local_moves(links, level), "level")
        members, seen = measured_write(
            members.join(found, _KEY).select("language", "id", F.col("c").alias("node"), (F.col("node") != F.col("c")).alias("merged")),
            "members",
            merged=F.count_if("merged"),
        )
        members = members.drop("merged")
        if not seen["merged"]:
            break
        levels.append(members.select("language", "id", F.col("node").alias("community"), F.lit(level).alias("level")))
        target = found.withColumnsRenamed({"node": "other", "c": "_to"})
        links = write_through(
            links.join(found, _KEY).join(target, ["language", "other"])
            .groupBy("language", F.col("c").alias("node"), F.col("_to").alias("other"))
            .agg(F.sum("weight").alias("weight")),
            "links",
        )
    labels = reduce(DataFrame.unionByName, levels)
    # Each language keeps the level that is best for it.
    quality = modularity(edges, labels, by=["level"])
    best = quality.groupBy("language").agg(F.max_by("level", F.struct(F.round("modularity", 9), -F.col("level"))).alias("level"))
    chosen = labels.join(best, ["language", "level"]).select("language", "id", "community")
    return renumber(chosen)


def renumber(labels: DataFrame) -> DataFrame:
    """Communities as 0, 1, ... by size, largest first; one row per community is ranked."""
    sizes = labels.groupBy("language", "community").agg(F.count(F.lit(1)).alias("_n"), F.min("id").alias("_first"))
    order = Window.partitionBy("language").orderBy(F.desc("_n"), "_first")
    numbers = sizes.select("language", "community", (F.row_number().over(order) - 1).cast("int").alias("_number"))
    return labels.join(numbers, ["language", "community"]).select("language", "id", F.col("_number").alias("community"))
