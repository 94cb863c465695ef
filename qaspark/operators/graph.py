"""Meso level: tag co-occurrence graph, degree, neighbours, trimming.

A graph is two tables: ``nodes(language, id, frequency)`` and
``edges(language, source, target, weight)`` with ``source < target``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qaspark.fixed_values import HUB_TAGS, MIN_EDGE_WEIGHT, NETWORK_TOP_N, SITE_TOP_N
from qaspark.functions.numbers import ratio, round_even
from qaspark.operators.ranking import top_per_group
from qaspark.schemas import require_columns
from qaspark.session import write_through


def tag_frequency(df: DataFrame) -> DataFrame:
    """How often each tag occurs per language; a tag repeated in a row counts again."""
    require_columns(df, "language", "tags")
    return (
        df.select("language", F.explode("tags").alias("tag"))
        .where(F.col("language").isNotNull())
        .groupBy("language", "tag")
        .agg(F.count(F.lit(1)).alias("frequency"))
    )


def top_tags(frequency: DataFrame, n: int = NETWORK_TOP_N) -> DataFrame:
    return top_per_group(frequency, ["language"], [F.desc("frequency"), F.col("tag")], n, salt_on=["tag"])


def top_cotags(df: DataFrame, n: int = 10, exclude: list[str] = HUB_TAGS) -> DataFrame:
    """The most frequent tags per language without the hub tags, ranked."""
    others = tag_frequency(df).where(~F.col("tag").isin(*exclude))
    return top_per_group(others, ["language"], [F.desc("frequency"), F.col("tag")], n, rank="rank")


def tag_pairs(df: DataFrame, distinct_tags: bool = False) -> DataFrame:
    """Number of rows in which two tags stand together.

    Pairs are formed inside the row, without a self join; a tag repeated in a row also pairs
    with itself unless ``distinct_tags`` is set.
    """
    tags = F.sort_array(F.array_distinct("tags") if distinct_tags else F.col("tags"))
    sorted_rows = df.where(F.size("tags") > 1).select("language", tags.alias("_t"))
    heads = sorted_rows.select("language", "_t", F.posexplode("_t").alias("_i", "source"))
    pairs = heads.select(
        "language", "source", F.explode(F.slice("_t", F.col("_i") + 2, F.size("_t"))).alias("target")
    )
    return pairs.groupBy("language", "source", "target").agg(F.count(F.lit(1)).alias("weight"))


def cooccurrence_graph(
    df: DataFrame, min_weight: int = MIN_EDGE_WEIGHT, top_n: int = NETWORK_TOP_N, distinct_tags: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Nodes and edges among the ``top_n`` tags of each language.

    Only tags that were kept form pairs, so a row gives at most top_n * (top_n - 1) / 2.
    Edges lighter than ``min_weight`` and nodes left without an edge are removed.
    """
    # One row per language with at most top_n names: stored, so that its size is known when
    # Spark picks the join.
    kept = write_through(top_tags(tag_frequency(df), top_n), "top-tags")
    lists = kept.groupBy("language").agg(F.collect_list("tag").alias("_top"))
    lists = write_through(lists, "top-tag-lists")
    rows = df.select("language", "tags").join(lists, "language")
    rows = rows.select("language", F.filter("tags", lambda t: F.array_contains("_top", t)).alias("tags"))
    edges = write_through(tag_pairs(rows, distinct_tags).where(F.col("weight") >= min_weight), "edges")
    nodes = kept.select("language", F.col("tag").alias("id"), "frequency")
    return nodes.join(edge_ends(edges), ["language", "id"], "left_semi"), edges


def both_directions(edges: DataFrame) -> DataFrame:
    """Every edge seen from each of its ends: ``(language, id, other, weight)``."""
    forward = edges.select("language", F.col("source").alias("id"), F.col("target").alias("other"), "weight")
    backward = edges.select("language", F.col("target").alias("id"), F.col("source").alias("other"), "weight")
    return forward.unionByName(backward)


def edge_ends(edges: DataFrame) -> DataFrame:
    ends = F.explode(F.array("source", "target"))
    return edges.select("language", ends.alias("id")).distinct()


def neighbors(edges: DataFrame, node: str | None = None) -> DataFrame:
    """``(language, id, neighbor)``, for one node or for all."""
    found = both_directions(edges).select("language", "id", F.col("other").alias("neighbor")).distinct()
    return found if node is None else found.where(F.col("id") == node)


def degree_centrality(edges: DataFrame) -> DataFrame:
    """Neighbours over possible neighbours, rounded to 4; nodes without edges do not count.

    A self edge counts twice, the usual rule for degrees.
    """
    ends = edges.select("language", F.explode(F.array("source", "target")).alias("id"))
    degree = ends.groupBy("language", "id").agg(F.count(F.lit(1)).alias("degree"))
    sizes = degree.groupBy("language").agg(F.count(F.lit(1)).alias("_n"))
    share = F.when(F.col("_n") <= 1, F.lit(1.0)).otherwise(ratio(F.col("degree"), F.col("_n") - 1))
    return degree.join(sizes, "language").select(
        "language", "id", "degree", round_even(share, 4).alias("degree_centrality")
    )


def network_nodes(nodes: DataFrame, communities: DataFrame, degree: DataFrame, betweenness: DataFrame) -> DataFrame:
    """One row per node with community and centrality; 0 where a table lacks the node."""
    key = ["language", "id"]
    joined = (
        nodes.join(communities.select(*key, "community"), key, "left")
        .join(degree.select(*key, "degree_centrality"), key, "left")
        .join(betweenness.select(*key, "betweenness_centrality"), key, "left")
    )
    return joined.select(
        *key,
        F.coalesce("frequency", F.lit(0)).alias("frequency"),
        F.coalesce("community", F.lit(0)).alias("community"),
        F.coalesce("degree_centrality", F.lit(0.0)).alias("degree_centrality"),
        F.coalesce("betweenness_centrality", F.lit(0.0)).alias("betweenness_centrality"),
    )


def network_centrality(nodes: DataFrame) -> DataFrame:
    """The stored table of node metrics."""
    return nodes.withColumnRenamed("id", "tag")


def top_nodes(nodes: DataFrame, metric: str = "betweenness_centrality", n: int = 20) -> DataFrame:
    return top_per_group(nodes, ["language"], [F.desc(metric), F.col("id")], n, rank="rank", salt_on=["id"])


def trim_network(
    nodes: DataFrame,
    edges: DataFrame,
    n: int = SITE_TOP_N,
    metric: str = "betweenness_centrality",
    keep: list[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The ``n`` best nodes by ``metric`` and the edges among them; ``keep`` names fixed members."""
    order = [F.desc(metric), F.col("id")]
    if keep:
        order = [F.col("id").isin(*keep).desc(), *order]
    chosen = top_per_group(nodes, ["language"], order, n, salt_on=["id"])
    return chosen, inner_edges(chosen, edges)


def inner_edges(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Edges whose two ends are both among the nodes."""
    names = nodes.select("language", "id")
    first = edges.join(names.withColumnRenamed("id", "source"), ["language", "source"], "left_semi")
    return first.join(names.withColumnRenamed("id", "target"), ["language", "target"], "left_semi")


def network_summary(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Nodes, edges and communities per language."""
    left = nodes.groupBy("language").agg(
        F.count(F.lit(1)).alias("nodes"), F.count_distinct("community").alias("communities")
    )
    right = edges.groupBy("language").agg(F.count(F.lit(1)).alias("edges"))
    return left.join(right, "language", "left").select(
        "language", "nodes", F.coalesce("edges", F.lit(0)).alias("edges"), "communities"
    )


def community_profile(nodes: DataFrame, n: int = 5) -> DataFrame:
    """Size of each community and its ``n`` most frequent members, as ``tag(frequency)``."""
    sizes = nodes.groupBy("language", "community").agg(F.count(F.lit(1)).alias("size"))
    best = top_per_group(nodes, ["language", "community"], [F.desc("frequency"), F.col("id")], n, rank="rank")
    member = F.concat("id", F.lit("("), F.col("frequency").cast("string"), F.lit(")"))
    listed = best.groupBy("language", "community").agg(
        F.sort_array(F.collect_list(F.struct("rank", member.alias("m")))).alias("_l")
    )
    members = F.array_join(F.transform("_l", lambda s: s["m"]), ", ")
    return sizes.join(listed, ["language", "community"]).select(
        "language", "community", "size", members.alias("members")
    )
