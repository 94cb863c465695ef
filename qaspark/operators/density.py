"""Density clusters: hierarchy over the mutual-reachability tree, most stable cut, noise as -1.

After Campello, Moulavi and Sander (2013) and McInnes and Healy (2017). Copies of a vector
are one point with a count, so a large group of copies costs one row.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from qaspark.operators.components import connected
from qaspark.operators.neighbors import core_distances, lay_out, nearest_neighbors, spanning_tree
from qaspark.session import measured_write, write_through

MIN_CLUSTER_SIZE = 25
MIN_SAMPLES = 3
#: So many neighbours of a point are listed. With more than core distances need, few points have to look for their component's next edge among all others.
LISTED = 16

# A task of the hierarchy holds at most this many edges.
EDGES_PER_STEP = 500_000
_SHORTEST = 1e-12

_STATE = "size bigint, cluster string, gathered double, below double"
_MERGED = f"language string, kind string, comp bigint, root bigint, {_STATE}, parent string, wins boolean"


def distinct_points(vectors: DataFrame) -> DataFrame:
    """``(language, pid, vector, mult)``: one point per different vector, named by its smallest id."""
    return vectors.groupBy("language", "vector").agg(
        F.min(F.col("doc_id").cast("long")).alias("pid"), F.count(F.lit(1)).alias("mult")
    ).select("language", "pid", F.col("vector").cast("array<double>").alias("vector"), "mult")


def _merge_step(min_cluster_size: int, step: str, most: int):
    """Join components along edges in order of length; edges carry the state of their ends."""

    def merge(edges: pd.DataFrame) -> pd.DataFrame:
        if len(edges) > most:
            raise ValueError(f"{len(edges)} edges in one task, at most {most} are meant to meet")
        edges = edges.sort_values(["w", "a", "b"])
        group = edges["root"].iloc[0]
        language = edges["language"].iloc[0]
        up: dict[int, int] = {}
        size: dict[int, int] = {}
        cluster: dict[int, str | None] = {}
        gathered: dict[int, float] = {}
        below: dict[int, float] = {}
        loose: dict[int, list[int]] = {}
        fell: dict[int, str] = {}
        done: list[tuple] = []

        def enter(comp, n, name, sum_, under):
            if comp not in up:
                up[comp], size[comp] = comp, n
                cluster[comp] = name if isinstance(name, str) else None
                gathered[comp], below[comp] = sum_, under
                loose[comp] = [] if cluster[comp] else [comp]

        def find(comp):
            root = comp
            while up[root] != root:
                root = up[root]
            while up[comp] != root:
                up[comp], comp = root, up[comp]
            return root

        born = 0
        columns = ["w", "ca", "size_a", "cluster_a", "gathered_a", "below_a", "cb", "size_b", "cluster_b", "gathered_b", "below_b"]
        for w, ca, na, ka, ga, ba, cb, nb, kb, gb, bb in edges[columns].itertuples(index=False):
            enter(ca, na, ka, ga, ba)
            enter(cb, nb, kb, gb, bb)
            x, y = find(ca), find(cb)
            if size[x] < size[y]:
                x, y = y, x
            density = 1.0 / max(w, _SHORTEST)
            if cluster[x] and cluster[y]:
                # Two clusters meet: both end here and a wider one begins.
                born += 1
                name, under = f"{step}.{group}.{born}", 0.0
                for part in (x, y):
                    stability = gathered[part] - size[part] * density
                    wins = stability >= below[part]
                    under += stability if wins else below[part]
                    done.append((cluster[part], name, wins))
                gathered[x] = (size[x] + size[y]) * density
                below[x], cluster[x] = under, name
            elif cluster[x] or cluster[y]:
                # Points too few for a cluster leave the other one here.
                big, small = (x, y) if cluster[x] else (y, x)
                for comp in loose[small]:
                    fell[comp] = cluster[big]
                gathered[x] = gathered[big] + size[small] * density
                below[x], cluster[x], loose[x] = below[big], cluster[big], []
            else:
                loose[x] = loose[x] + loose[y]
                if size[x] + size[y] >= min_cluster_size:
                    born += 1
                    cluster[x], below[x] = f"{step}.{group}.{born}", 0.0
                    gathered[x] = (size[x] + size[y]) * density
                    for comp in loose[x]:
                        fell[comp] = cluster[x]
                    loose[x] = []
            size[x] += size[y]
            up[y] = x
            loose.pop(y)

        rows = []
        for comp in up:
            root = find(comp)
            state = (size[root], cluster[root], gathered[root], below[root]) if comp == root else (None, None, None, None)
            rows.append((language, "comp", comp, root, state[0], fell.get(comp), state[2], state[3], state[1], comp == root))
        rows += [(language, "cluster", None, None, None, name, None, None, parent, wins) for name, parent, wins in done]
        names = ["language", "kind", "comp", "root", "size", "cluster", "gathered", "below", "parent", "wins"]
        return pd.DataFrame(rows, columns=names).astype({"comp": "Int64", "root": "Int64", "size": "Int64"})

    return merge


def _in_order(edges: DataFrame, keys: list[str]) -> DataFrame:
    """``edges`` with ``rank``, their place from 0 among those of equal ``keys`` in order of length and ends.

    One sort by ranges spreads a group over many tasks; a row's place is its place in its range plus what the ranges before
    hold, one row per range and group.
    """
    order = [*keys, "w", "a", "b"]
    sorted_ = edges.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    sorted_ = write_through(sorted_, "sorted").withColumn("_range", F.shiftright("_at", 33))
    parts = sorted_.groupBy(*keys, "_range").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    before = F.sum("_n").over(Window.partitionBy(*keys).orderBy("_range")) - F.col("_n")
    parts = parts.select(*keys, "_range", (before - F.col("_first")).alias("_shift"))
    return sorted_.join(parts, [*keys, "_range"]).withColumn("rank", F.col("_at") + F.col("_shift")).drop("_at", "_range", "_shift")


def _in_bands(tree: DataFrame, per_step: int) -> tuple[DataFrame, int]:
    """The tree's edges with the ``band`` they are handled in, and the number of bands.

    The first band is the shorter half of a language's edges, the next half of the rest, and so on until what is left fits one step.
    Short edges join few points each, so most of a language is handled side by side before its components grow large.
    Equal lengths are told apart by their ends.
    """
    counts = tree.groupBy("language").agg(F.count(F.lit(1)).alias("_all"))
    largest = counts.agg(F.max("_all")).first()[0] or 0
    if largest <= per_step:
        return tree.withColumn("band", F.lit(0)), 1
    last = F.ceil(F.log2(F.col("_all") / per_step))
    halves = F.floor(F.log2(F.col("_all") / (F.col("_all") - F.col("rank"))))
    ranked = _in_order(tree, ["language"]).join(counts, "language")
    band = F.when(F.col("_all") <= per_step, 0).otherwise(F.least(halves, last)).cast("int").alias("band")
    return ranked.select("language", "a", "b", "w", band), math.ceil(math.log2(largest / per_step)) + 1


def _in_groups(edges: DataFrame, per_step: int) -> tuple[DataFrame, int]:
    """The edges of a band with the ``root`` of their component and the ``step`` they are merged in, and the number of steps.

    A component with more than ``per_step`` edges takes its edges in several steps, in order; all others end in the first.
    """
    most = edges.groupBy("language").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    if most <= per_step:  # a language's edges in this band fit one step, whatever their components are
        return edges.withColumns({"root": F.lit(0).cast("long"), "step": F.lit(0)}), 1
    roots = connected(edges.select("language", F.col("ca").alias("a"), F.col("cb").alias("b")), ["language"])
    rooted = write_through(edges.join(roots.withColumnRenamed("node", "ca"), ["language", "ca"]), "rooted")
    sizes = rooted.groupBy("language", "root").agg(F.count(F.lit(1)).alias("_size"))
    large, seen = measured_write(sizes.where(F.col("_size") > per_step), "large", most=F.coalesce(F.max("_size"), F.lit(0)))
    if not seen["most"]:
        return rooted.withColumn("step", F.lit(0)), 1
    crowded = _in_order(rooted.join(large.drop("_size"), ["language", "root"], "left_semi"), ["language", "root"])
    stepped = crowded.withColumn("step", F.floor(F.col("rank") / per_step).cast("int")).drop("rank")
    rest = rooted.join(large, ["language", "root"], "left_anti").withColumn("step", F.lit(0))
    return write_through(stepped.unionByName(rest), "stepped"), math.ceil(seen["most"] / per_step)


def _moved(table: DataFrame, column: str, moves: DataFrame) -> DataFrame:
    """``table`` with components renamed by ``moves(language, comp, root, …)``."""
    to = moves.select("language", F.col("comp").alias(column), F.col("root").alias("_to"))
    return table.join(to, ["language", column], "left").withColumn(column, F.coalesce("_to", column)).drop("_to")


def condense(points: DataFrame, cores: DataFrame, tree: DataFrame, min_cluster_size: int, per_step: int = EDGES_PER_STEP) -> tuple[DataFrame, DataFrame]:
    """``(members, clusters)``: the cluster each point falls out of, and all clusters with parents.

    ``members(language, pid, mult, cluster)`` has null for points that never were in a cluster;
    ``clusters(language, cluster, parent, wins)`` has null parents for the widest ones, which are
    never chosen.

    The tree is handled in bands of edge length. The edges of a band fall into components that know nothing of each other: each is
    merged in a task of its own, and then is one node for the bands that follow. No task ever holds more than ``per_step`` edges, also when all
    lengths are equal.
    """
    density = 1.0 / F.greatest("core", F.lit(_SHORTEST))
    crowd = F.col("mult") >= min_cluster_size
    own = F.when(crowd, F.concat(F.lit("p."), F.col("pid").cast("string")))
    # Many copies of one vector are a cluster by themselves.
    members = points.select("language", "pid", "mult").join(cores.select("language", "pid", "core"), ["language", "pid"])
    members = members.select("language", "pid", "mult", F.col("pid").alias("comp"), own.alias("cluster"), "core")
    states = members.select(
        "language", "comp", F.col("mult").alias("size"), "cluster",
        F.when(crowd, F.col("mult") * density).otherwise(0.0).alias("gathered"), F.lit(0.0).alias("below"),
    )
    members = write_through(members.drop("core"), "members")
    states = write_through(states, "states")
    finished: list[DataFrame] = []
    banded, bands = _in_bands(tree, per_step)
    rest = banded.select("language", "a", "b", "w", "band", F.col("a").alias("ca"), F.col("b").alias("cb"))
    if bands > 1:
        rest = write_through(rest, "edges")
    for band in range(bands):
        grouped, steps = _in_groups(rest.where(F.col("band") == band).drop("band"), per_step)
        ends = grouped.select("language", F.explode(F.array("ca", "cb")).alias("comp")).distinct()
        # What a node of this band has become: its component, and the cluster it fell out of on the way.
        became: DataFrame | None = None
        near = states.join(ends, ["language", "comp"], "left_semi")
        far = states.join(ends, ["language", "comp"], "left_anti")
        for step in range(steps):
            edges = grouped.where(F.col("step") == step)
            for end in ("a", "b"):
                renamed = [F.col(c).alias(f"{c}_{end}") for c in ("size", "cluster", "gathered", "below")]
                edges = edges.join(near.select("language", F.col("comp").alias("c" + end), *renamed), ["language", "c" + end])
            merge = _merge_step(min_cluster_size, f"{band}.{step}", per_step)
            merged = write_through(edges.groupBy("language", "root").applyInPandas(merge, _MERGED), "merged")
            finished.append(merged.where(F.col("kind") == "cluster").select("language", "cluster", "parent", "wins"))
            moves = merged.where(F.col("kind") == "comp").select("language", "comp", "root", F.col("cluster").alias("fell"))
            roots = merged.where((F.col("kind") == "comp") & F.col("wins")).select("language", "comp", "size", F.col("parent").alias("cluster"), "gathered", "below")
            near = near.join(moves, ["language", "comp"], "left_anti").unionByName(roots)
            if became is None:
                became = moves
            else:
                later = moves.select("language", F.col("comp").alias("root"), F.col("root").alias("_to"), F.col("fell").alias("_fell"))
                became = became.join(later, ["language", "root"], "left").select(
                    "language", "comp", F.coalesce("_to", "root").alias("root"), F.coalesce("fell", "_fell").alias("fell")
                ).unionByName(moves.join(became, ["language", "comp"], "left_anti"))
            if steps > 1:
                near, became = write_through(near, "near"), write_through(became, "became")
                grouped = write_through(_moved(_moved(grouped.where(F.col("step") > step), "ca", moves), "cb", moves), "stepped")
        members = write_through(
            members.join(became, ["language", "comp"], "left").select(
                "language", "pid", "mult", F.coalesce("root", "comp").alias("comp"), F.coalesce("cluster", "fell").alias("cluster")
            ),
            "members",
        )
        states = write_through(far.unionByName(near), "states")
        if band + 1 < bands:
            rest = write_through(_moved(_moved(rest.where(F.col("band") > band), "ca", became), "cb", became), "edges")
    widest = states.where(F.col("cluster").isNotNull()).select(
        "language", "cluster", F.lit(None).cast("string").alias("parent"), F.lit(False).alias("wins")
    )
    for part in finished:
        widest = widest.unionByName(part)
    return members, write_through(widest, "clusters")


def _chosen_clusters(clusters: DataFrame) -> DataFrame:
    """``(language, cluster, chosen)``: the widest winner at or above each cluster, or null."""
    step = clusters.select(
        "language", "cluster", F.col("parent").alias("up"), F.when(F.col("wins"), F.col("cluster")).alias("chosen")
    )
    while True:
        above = step.select("language", F.col("cluster").alias("up"), F.col("up").alias("_up"), F.col("chosen").alias("_chosen"))
        step, seen = measured_write(
            step.join(above, ["language", "up"], "left").select(
                "language", "cluster", F.col("_up").alias("up"), F.coalesce("_chosen", "chosen").alias("chosen")
            ),
            "chosen",
            open=F.count_if(F.col("up").isNotNull()),
        )
        if not seen["open"]:
            return step.select("language", "cluster", "chosen")


def density_clusters(
    vectors: DataFrame,
    min_cluster_size: int = MIN_CLUSTER_SIZE,
    min_samples: int = MIN_SAMPLES,
    method: str = "density",
) -> DataFrame:
    """``(language, doc_id, cluster_id)`` of ``vectors(language, doc_id, vector)``; -1 is noise.

    Clusters are numbered from 0 by size, largest first, then by smallest id.
    ``method="none"`` puts everything into cluster 0. ``doc_id`` has to be an integer.
    """
    if method == "none":
        return vectors.select("language", "doc_id", F.lit(0).alias("cluster_id"))
    if method != "density":
        raise ValueError(f"unknown method {method}")
    vectors = vectors.select("language", "doc_id", F.col("vector").cast("array<double>").alias("vector"))
    points = write_through(distinct_points(vectors), "points")
    layout = lay_out(points)
    listed = max(min_samples, LISTED)
    near = nearest_neighbors(layout, listed)
    cores = write_through(core_distances(points, near, min_samples, listed), "cores")
    labels = label_points(points, cores, spanning_tree(layout, near, cores), min_cluster_size)
    labelled = write_through(points.join(labels, ["language", "pid"]).select("language", "vector", "cluster_id"), "labelled")
    return vectors.join(labelled, ["language", "vector"]).select("language", "doc_id", "cluster_id")


def label_points(
    points: DataFrame, cores: DataFrame, tree: DataFrame, min_cluster_size: int, per_step: int = EDGES_PER_STEP
) -> DataFrame:
    """``(language, pid, cluster_id)`` from the spanning tree of the points."""
    members, clusters = condense(points, cores, tree, min_cluster_size, per_step)
    chosen = members.join(_chosen_clusters(clusters), ["language", "cluster"], "left").select("language", "pid", "mult", "chosen")
    sizes = chosen.where(F.col("chosen").isNotNull()).groupBy("language", "chosen").agg(
        F.sum("mult").alias("_n"), F.min("pid").alias("_first")
    )
    # One row per cluster is ranked.
    order = Window.partitionBy("language").orderBy(F.desc("_n"), "_first")
    numbers = sizes.select("language", "chosen", (F.row_number().over(order) - 1).cast("int").alias("_number"))
    return chosen.join(numbers, ["language", "chosen"], "left").select(
        "language", "pid", F.coalesce("_number", F.lit(-1)).alias("cluster_id")
    )
