"""Betweenness centrality by rounds of joins.

Every table is keyed by (language, source of the paths, node). Sources go in batches: what a batch adds is summed
into one row per node and its tables are deleted before the next batch starts, so the state is a batch times the nodes (and
its arrows a batch times the edges) however large the graph is. Each round is one job that writes its result to the checkpoint folder.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qaspark.functions.numbers import round_even
from qaspark.operators.graph import both_directions, edge_ends
from qaspark.operators.ranking import top_per_group
from qaspark.session import Rounds, Scratch, write_through

_STATE = ["language", "s", "id"]
#: Links times sources that a batch may hold; at most so many rows lie in each table of a batch.
STATE_ROWS = 100_000_000


def _distances(links: DataFrame, sources: DataFrame, scratch: Scratch) -> DataFrame:
    """Shortest distance from every source: relax the nodes that changed until none does."""
    known = sources.select(
        "language", F.col("id").alias("s"), "id", F.lit(0).cast("double").alias("d"), F.lit(True).alias("changed")
    )
    rounds = Rounds("distances")
    known, _ = rounds.write(known)
    while True:
        moved = known.where("changed").join(links, ["language", "id"])
        reached = moved.select(
            "language", "s", F.col("other").alias("id"), (F.col("d") + F.col("weight")).alias("d"), F.lit(None).cast("double").alias("old")
        )
        merged = known.select(*_STATE, "d", F.col("d").alias("old")).unionByName(reached)
        best = merged.groupBy(*_STATE).agg(F.min("d").alias("d"), F.min("old").alias("old"))
        best = best.select(*_STATE, "d", (F.col("old").isNull() | (F.col("d") < F.col("old"))).alias("changed"))
        known, seen = rounds.write(best, changed=F.count_if("changed"))
        if not seen["changed"]:
            scratch.paths.append(rounds.last)
            return known.select(*_STATE, "d")


def _spread(start: DataFrame, arrows: DataFrame, name: str, scratch: Scratch) -> DataFrame:
    """Sum over all walks along ``arrows(language, s, id, next, factor)`` that begin in ``start``.

    The arrows have no cycle, so the walk dies out; one round per hop.
    """
    parts = []
    step = start
    while True:
        step, seen = scratch.write(step, name, rows=F.count(F.lit(1)))
        if not seen["rows"]:
            break
        parts.append(step)
        onward = step.join(arrows, _STATE).select("language", "s", F.col("next").alias("id"), (F.col("x") * F.col("factor")).alias("x"))
        step = onward.groupBy(*_STATE).agg(F.sum("x").alias("x"))
    total = reduce(DataFrame.unionByName, parts) if parts else step
    return total.groupBy(*_STATE).agg(F.sum("x").alias("x"))


def _shares(links: DataFrame, sources: DataFrame, scratch: Scratch) -> DataFrame:
    """``(language, s, id, x)``: how much of the paths from source ``s`` to all others runs through ``id``."""
    distance = _distances(links, sources, scratch)
    far = distance.select("language", "s", F.col("id").alias("other"), F.col("d").alias("far"))
    tight = (
        distance.join(links, ["language", "id"])
        .join(far, ["language", "s", "other"])
        .where(F.col("d") + F.col("weight") == F.col("far"))
        .select(*_STATE, F.col("other").alias("next"))
    )
    tight, _ = scratch.write(tight, "tight")

    start = distance.where(F.col("s") == F.col("id")).select(*_STATE, F.lit(1.0).alias("x"))
    paths, _ = scratch.write(_spread(start, tight.withColumn("factor", F.lit(1.0)), "paths", scratch), "paths")

    # Back along the arrows: a node gets its share of what the next one is worth.
    here = paths.withColumnRenamed("x", "n_here")
    there = paths.select("language", "s", F.col("id").alias("next"), F.col("x").alias("n_next"))
    back = (
        tight.join(here, _STATE)
        .join(there, ["language", "s", "next"])
        .select("language", "s", F.col("next").alias("id"), F.col("id").alias("next"), (F.col("n_here") / F.col("n_next")).alias("factor"))
    )
    back, _ = scratch.write(back, "back")
    direct = back.groupBy("language", "s", F.col("next").alias("id")).agg(F.sum("factor").alias("x"))
    return _spread(direct, back, "shares", scratch).where(F.col("s") != F.col("id"))


def betweenness_centrality(
    edges: DataFrame, weighted: bool = True, max_pivots: int | None = None, digits: int | None = 4, state_rows: int = STATE_ROWS
) -> DataFrame:
    """Share of shortest paths through each node; the weight is read as a distance.

    Exact unless the caller names ``max_pivots``: then the paths of a language with more nodes start at that
    many of them, in hash order, and the sums are scaled up. Sources are dealt by hash to as many batches as it takes
    to keep sources times links (all languages together) near ``state_rows``; a batch may hold a few more by chance.
    """
    weight = F.col("weight").cast("double") if weighted else F.lit(1.0)
    links = both_directions(edges).where(F.col("id") != F.col("other")).withColumn("weight", weight)
    links = write_through(links, "links")
    nodes = write_through(edge_ends(edges), "ends")
    sources = nodes if max_pivots is None else top_per_group(nodes, ["language"], [F.xxhash64("id"), F.col("id")], max_pivots, salt_on=["id"])
    per_language = sources.groupBy("language").agg(F.count(F.lit(1)).cast("double").alias("n"))
    width = links.groupBy("language").agg(F.count(F.lit(1)).cast("double").alias("m"))
    state = per_language.join(width, "language").agg(F.sum(F.col("n") * F.col("m")).alias("rows")).first()["rows"]
    batches = max(1, math.ceil((state or 0) / state_rows))
    if batches > 1:
        sources = write_through(sources, "sources")

    totals = Rounds("betweenness")
    summed = None
    for number in range(batches):
        with Scratch(edges.sparkSession) as scratch:
            # Modulo after a second hash: the pivots were chosen by the first.
            mine = sources if batches == 1 else sources.where(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(batches)) == number)
            share = _shares(links, mine, scratch).select("language", "id", "x")
            if summed is not None:
                share = share.unionByName(summed)
            summed, _ = totals.write(share.groupBy("language", "id").agg(F.sum("x").alias("x")))
    summed = summed.withColumnRenamed("x", "_sum")

    sizes = nodes.groupBy("language").agg(F.count(F.lit(1)).cast("double").alias("_n"))
    scale = F.when(F.col("_n") > 2, 1 / ((F.col("_n") - 1) * (F.col("_n") - 2))).otherwise(0.0)
    if max_pivots is not None:
        scale = scale * F.greatest(F.col("_n") / F.lit(float(max_pivots)), F.lit(1.0))
    value = F.coalesce("_sum", F.lit(0.0)) * scale
    joined = nodes.join(sizes, "language").join(summed, ["language", "id"], "left")
    value = value if digits is None else round_even(value, digits)
    return joined.select("language", "id", value.alias("betweenness_centrality"))
