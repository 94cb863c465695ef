"""Exact nearest neighbours and minimum spanning trees of vectors, per language.

Points are laid out in blocks of bounded size around pivots (and around pivots of a crowded pivot's own), each block
sorted into leaves of near points. A block meets another only if the distance of their centres, less both radii, leaves room for something better
than what is known. Blocks stand on shelves of bounded size; a task takes the blocks of two shelves that have to meet, so vectors travel once
per shelf they are wanted with, not once per pair of blocks. Inside a meeting the same bound decides between leaves. The bounds come from the
triangle inequality, so nothing is left out. One matrix product with a proven error tells which pairs of points may be near enough; only
their distances are computed by plain differences, and only winners leave a task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qaspark.operators.ranking import top_per_group
from qaspark.session import broadcast_if_small, measured_write, write_through

BLOCK = 2048
LEAF = 64
#: A shelf has about this many points at most, and a language about eight shelves at least: that many squared are the tasks of a search.
SHELF = 65_536
_LEAST_SHELVES = 8
MAX_PIVOTS = 1024
_ROWS = 512
_LEAVES_AT_ONCE = 16
_LEAVES_ASKING = 4
_SLACK = 1e-9
_ID = ["language", "pid"]


@dataclass
class Layout:
    """Points in blocks; what sits on the driver is one entry per pivot and one per shelf."""

    points: DataFrame  # language, pid, mult, block, pos
    blocks: DataFrame  # language, block, cell, shelf, pids, mults, vectors (leaf after leaf, one list), centre, radius
    pivots: dict[str, np.ndarray]
    centres: dict[str, np.ndarray]  # of the shelves
    radius: dict[str, np.ndarray]  # of the shelves
    several: bool  # whether any language has more than one block


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances by plain differences: exact for near points, same both ways."""
    total = np.zeros((len(a), len(b)))
    for j in range(a.shape[1]):
        step = a[:, j, None] - b[None, :, j]
        total += step * step
    return np.sqrt(total)


def _error(width: int, *squares: np.ndarray) -> np.ndarray:
    """No squared distance out of norms and a matrix product is wrong by more than this (36 times the rounding of its terms)."""
    return 4e-15 * (width + 8) * sum(squares[1:], squares[0])


def _apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """At least this far are rows of ``a`` from rows of ``b``; short of the distance by rounding only."""
    x, y = (a * a).sum(axis=1), (b * b).sum(axis=1)
    if not (np.isfinite(x).all() and np.isfinite(y).all()):
        return _distances(a, b)
    square = x[:, None] + y[None, :] - 2.0 * (a @ b.T)
    return np.sqrt(np.maximum(square - _error(a.shape[1], x[:, None], y[None, :]), 0.0))


def _paired(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distance of each row of ``a`` from the same row of ``b``, bit for bit what ``_distances`` gives."""
    total = np.zeros(len(a))
    for j in range(a.shape[1]):
        step = a[:, j] - b[:, j]
        total += step * step
    return np.sqrt(total)


def _nearest_pivot(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.concatenate([_distances(vectors[at : at + _ROWS], pivots).argmin(axis=1) for at in range(0, len(vectors), _ROWS)])


def leaf_order(vectors: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """Places in an order whose runs of ``leaf`` are near each other: halves along the widest side, again and again."""
    out, stack = [], [np.arange(len(vectors))]
    while stack:
        some = stack.pop()
        if len(some) <= leaf:
            out.append(some)
            continue
        side = np.ptp(vectors[some], axis=0).argmax()
        some = some[np.argsort(vectors[some, side], kind="stable")]
        half = leaf * (-(-len(some) // leaf) // 2)
        stack += [some[half:], some[:half]]
    return np.concatenate(out)


def _shelves(pivots: np.ndarray, counts: np.ndarray, most: int) -> list[tuple[int, int]]:
    """The first shelf of each pivot's cell and how many shelves the cell has: near cells share one of about ``most`` points."""
    out = [(0, 1)] * len(pivots)
    shelf, held = 0, 0
    for cell in leaf_order(pivots, 1).tolist():
        n = int(counts[cell])
        if held and held + n > most:
            shelf, held = shelf + 1, 0
        out[cell] = shelf, max(1, math.ceil(n / most))
        shelf, held = shelf + out[cell][1] - 1, held + n if n <= most else most
    return out


def lay_out(points: DataFrame, block: int = BLOCK) -> Layout:
    """Place ``points(language, pid, vector, mult)`` in blocks of about ``block`` points at most."""
    sizes = {r["language"]: r["n"] for r in points.groupBy("language").agg(F.count(F.lit(1)).alias("n")).collect()}
    wanted = {k: 1 if n <= block else min(MAX_PIVOTS, math.ceil(2 * n / block)) for k, n in sizes.items()}
    ranked = top_per_group(
        points.select("language", "pid", "vector"), ["language"], [F.xxhash64("pid"), F.col("pid")], MAX_PIVOTS, rank="r", salt_on=["pid"]
    )
    drawn: dict[str, list] = {}
    for r in ranked.where(F.col("r") <= max(wanted.values(), default=1)).collect():  # at most MAX_PIVOTS per language
        if r["r"] <= wanted[r["language"]]:
            drawn.setdefault(r["language"], []).append(r["vector"])
    pivots = {k: np.asarray(v, dtype=float) for k, v in drawn.items()}
    shared = points.sparkSession.sparkContext.broadcast(pivots)

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for language, part in batch.groupby("language", sort=False):
                cell = _nearest_pivot(np.stack(part["vector"].to_numpy()), shared.value[language])
                yield part.assign(cell=cell.astype("int32"))

    placed = points.select("language", "pid", "vector", "mult").mapInPandas(assign, "language string, pid long, vector array<double>, mult long, cell int")
    placed = write_through(placed, "placed")
    counted = {k: np.zeros(len(v), np.int64) for k, v in pivots.items()}
    crowded = []
    for r in placed.groupBy("language", "cell").agg(F.count(F.lit(1)).alias("n")).collect():  # one row per pivot
        counted[r["language"]][r["cell"]] = r["n"]
        if r["n"] > block:
            crowded.append((r["language"], r["cell"], r["n"]))
    placed = placed.withColumn("sub", F.lit(0))
    if crowded:
        placed = write_through(_split_crowded(placed, crowded, block), "split")
    counts = placed.groupBy("language", "cell", "sub").agg(F.ceil(F.count(F.lit(1)) / block).alias("_chunks"))
    counts, seen = measured_write(counts.where(F.col("_chunks") > 1), "chunks", rows=F.count(F.lit(1)))
    chunk = F.pmod(F.xxhash64("pid"), F.coalesce("_chunks", F.lit(1)))
    number = F.shiftleft(F.col("cell").cast("long"), 42) + F.shiftleft(F.col("sub").cast("long"), 32) + chunk
    numbered = placed.join(broadcast_if_small(counts, seen["rows"]), ["language", "cell", "sub"], "left").withColumn("block", number)

    shelf_of = {k: _shelves(v, counted[k], min(SHELF, max(block, math.ceil(sizes[k] / _LEAST_SHELVES)))) for k, v in pivots.items()}
    shelves = points.sparkSession.sparkContext.broadcast(shelf_of)

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("pid")
        vectors = np.stack(rows["vector"].to_numpy())
        order = leaf_order(vectors)
        vectors = vectors[order]
        centre = vectors.mean(axis=0)
        first = rows.iloc[0]
        lowest, many = shelves.value[first["language"]][first["cell"]]
        shelf = lowest + ((int(first["block"]) * 0x9E3779B97F4A7C15 >> 32) & 0xFFFFFFFF) % many
        packed = (first["language"], first["block"], first["cell"], shelf, rows["pid"].to_numpy()[order], rows["mult"].to_numpy()[order], vectors.ravel(), centre, _distances(vectors, centre[None]).max())
        return pd.DataFrame([packed], columns=["language", "block", "cell", "shelf", "pids", "mults", "vectors", "centre", "radius"])

    fields = "language string, block long, cell int, shelf int, pids array<long>, mults array<long>, vectors array<double>, centre array<double>, radius double"
    blocks, packed = measured_write(numbered.drop("sub", "_chunks").groupBy("language", "block").applyInPandas(pack, fields), "blocks", n=F.count(F.lit(1)))
    centres, radius = _spheres(blocks, shelf_of)
    each = blocks.select("language", "block", F.posexplode(F.arrays_zip("pids", "mults")).alias("pos", "_p"))
    return Layout(write_through(each.select("language", F.col("_p.pids").alias("pid"), F.col("_p.mults").alias("mult"), "block", "pos"), "points"), blocks, pivots, centres, radius, packed["n"] > len(sizes))


def _spheres(blocks: DataFrame, shelf_of: dict[str, list[tuple[int, int]]]) -> tuple[dict[str, np.ndarray], dict[str, np.ndarray]]:
    """Centre and radius of the points of every shelf; a shelf without blocks is infinitely far from all."""

    def sphere(rows: pd.DataFrame) -> pd.DataFrame:
        at = np.stack(rows["centre"].to_numpy())
        centre = at.mean(axis=0)
        reach = (_distances(at, centre[None])[:, 0] + rows["radius"].to_numpy()).max()
        return pd.DataFrame({"language": [rows["language"].iloc[0]], "shelf": rows["shelf"].iloc[:1].to_numpy(), "centre": [centre], "radius": [reach]})

    found = blocks.select("language", "shelf", "centre", "radius").groupBy("language", "shelf").applyInPandas(sphere, "language string, shelf int, centre array<double>, radius double")
    centres: dict[str, np.ndarray] = {}
    radius = {k: np.full(max(lowest + many for lowest, many in v), -np.inf) for k, v in shelf_of.items()}
    for r in found.collect():  # one row per shelf
        at = centres.setdefault(r["language"], np.zeros((len(radius[r["language"]]), len(r["centre"]))))
        at[r["shelf"]], radius[r["language"]][r["shelf"]] = r["centre"], r["radius"]
    return centres, radius


def _split_crowded(placed: DataFrame, crowded: list[tuple[str, int, int]], block: int) -> DataFrame:
    """Cells with more than a block's points are divided around pivots drawn from their own points."""
    spark = placed.sparkSession
    rows = [(k, c, math.ceil(n / block), min(MAX_PIVOTS, math.ceil(2 * n / block))) for k, c, n in crowded]
    table = F.broadcast(spark.createDataFrame(rows, "language string, cell int, _packs int, _wanted int"))  # at most one row per pivot
    many = placed.drop("sub").join(table, ["language", "cell"])
    drawn = top_per_group(many.select("language", "cell", "pid", "vector", "_wanted"), ["language", "cell"], [F.xxhash64("pid", F.lit(3)), F.col("pid")], MAX_PIVOTS, rank="_r", salt_on=["pid"])
    drawn = drawn.where(F.col("_r") <= F.col("_wanted")).groupBy("language", "cell").agg(F.sort_array(F.collect_list(F.struct("_r", "vector")))["vector"].alias("pivots"))
    salt = F.pmod(F.xxhash64("pid", F.lit(5)), F.col("_packs")).alias("_pack")
    packs = many.groupBy("language", "cell", salt).agg(F.collect_list(F.struct("pid", "vector", "mult")).alias("points"))

    def divide(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples(index=False):
                vectors = np.array([p["vector"] for p in r.points], dtype=float)
                sub = _nearest_pivot(vectors, np.array([list(p) for p in r.pivots], dtype=float))
                yield pd.DataFrame(
                    {"language": r.language, "pid": [p["pid"] for p in r.points], "vector": list(vectors), "mult": [p["mult"] for p in r.points], "cell": r.cell, "sub": sub.astype("int32")}
                )

    divided = packs.join(drawn, ["language", "cell"]).select("language", "cell", "points", "pivots").mapInPandas(divide, "language string, pid long, vector array<double>, mult long, cell int, sub int")
    return placed.join(table, ["language", "cell"], "left_anti").unionByName(divided)


def _marks(rows: DataFrame, *columns: str) -> DataFrame:
    """One row per block with its points' ``columns`` as lists, in the block's order."""
    listed = rows.groupBy("language", "block").agg(F.sort_array(F.collect_list(F.struct("pos", *columns))).alias("_l"))
    return listed.select("language", "block", *[F.col(f"_l.{c}").alias(c) for c in columns])


# What planning knows of a block: where it is, how far its points may ask, their least core distance, and its component if it has only one.
_SUMMARY = ["block", "centre", "radius", "bound", "low_core", "held_core", "uniform"]


def _pairs(layout: Layout, summary: DataFrame, mode: str) -> DataFrame:
    """``(language, asks, holds)``: the blocks that have to meet.

    ``mode`` is "within" (all within the asking block's bound), "others" (the same without the block itself) or "closest" (the closest block that is not all
    of the asking block's one component; only for blocks that have a bound). Shelves are compared first, by their centres and radii; blocks of the remaining
    pairs of shelves by their own. "gap" gives ``(language, asks, room)`` instead: how far at least the closest other block is.
    """
    spark = summary.sparkSession
    shared = spark.sparkContext.broadcast((layout.centres, layout.radius))
    located = layout.blocks.select("language", "block", "shelf", "centre", "radius").join(summary, ["language", "block"])
    shelves = located.groupBy("language", "shelf").agg(*[F.collect_list(F.coalesce(c, F.lit(-1))).alias(c) if c == "uniform" else F.collect_list(c).alias(c) for c in _SUMMARY], F.max("bound").alias("reach"))
    shelves = write_through(shelves, "shelves")

    def near(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        centres, radius = shared.value
        for batch in batches:
            for language, shelf, reach in zip(batch["language"], batch["shelf"], batch["reach"]):
                room = _apart(centres[language][shelf][None], centres[language])[0] - radius[language] - radius[language][shelf] - _SLACK
                other = np.flatnonzero(room <= reach) if mode not in ("closest", "gap") else np.arange(len(room))
                yield pd.DataFrame({"language": language, "shelf": shelf, "other": other.astype("int32")})

    asking = shelves.where(F.col("reach") >= 0)
    shelf_pairs = asking.select("language", "shelf", "reach").mapInPandas(near, "language string, shelf int, other int")
    left = shelves.select("language", "shelf", *[F.col(c).alias(f"a_{c}") for c in _SUMMARY])
    right = shelves.select("language", F.col("shelf").alias("other"), *[F.col(c).alias(f"h_{c}") for c in _SUMMARY])

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples(index=False):
                asks, holds = np.asarray(r.a_block), np.asarray(r.h_block)
                room = _apart(np.stack(r.a_centre), np.stack(r.h_centre)) - np.asarray(r.a_radius)[:, None] - np.asarray(r.h_radius)[None, :] - _SLACK
                room = np.maximum(room, 0.0)
                ours, theirs = np.asarray(r.a_uniform), np.asarray(r.h_uniform)
                closed = (ours[:, None] == theirs[None, :]) & (ours[:, None] >= 0)
                bound = np.asarray(r.a_bound)[:, None]
                if mode in ("others", "gap"):
                    closed |= asks[:, None] == holds[None, :]
                if mode == "gap":
                    room[closed] = np.inf
                    row = np.flatnonzero(np.isfinite(room.min(axis=1)))
                    column = room[row].argmin(axis=1)
                elif mode == "closest":
                    room[(asks[:, None] == holds[None, :]) & (ours[:, None] < 0)] = -1.0
                    room[closed | (bound < 0)] = np.inf
                    row = np.flatnonzero(np.isfinite(room.min(axis=1)))
                    column = room[row].argmin(axis=1)
                else:
                    room = np.maximum(room, np.maximum(np.asarray(r.a_low_core)[:, None], np.asarray(r.h_held_core)[None, :]))
                    row, column = np.nonzero((room <= bound) & ~closed)
                yield pd.DataFrame({"language": r.language, "asks": asks[row], "holds": holds[column], "room": room[row, column]})

    joined = shelf_pairs.join(left, ["language", "shelf"]).join(right, ["language", "other"])
    pairs = joined.mapInPandas(compare, "language string, asks long, holds long, room double")
    if mode == "gap":
        return pairs.groupBy("language", "asks").agg(F.min("room").alias("room"))
    if mode == "closest":
        pairs = pairs.groupBy("language", "asks").agg(F.min(F.struct("room", "holds"))["holds"].alias("holds"))
    return pairs.select("language", "asks", "holds")


def _meetings(layout: Layout, pairs: DataFrame, asking: DataFrame, holding: DataFrame, search, fields: str, own: bool = True) -> DataFrame:
    """``search(asking blocks, holding blocks)`` of every two shelves with blocks that have to meet; ``others`` of an asking block names whom it has to.

    Without ``own`` blocks of one shelf do not meet.
    """
    shelf = layout.blocks.select("language", "block", "shelf")
    placed = pairs.join(shelf.toDF("language", "asks", "q_shelf"), ["language", "asks"]).join(shelf.toDF("language", "holds", "o_shelf"), ["language", "holds"])
    if not own:
        placed = placed.where(F.col("q_shelf") != F.col("o_shelf"))
    keys = ["language", "q_shelf", "o_shelf"]
    asked = placed.groupBy(*keys, F.col("asks").alias("block")).agg(F.collect_list("holds").alias("others")).join(asking, ["language", "block"])
    held = placed.select(*keys, F.col("holds").alias("block")).distinct().join(holding, ["language", "block"])
    held = held.toDF(*held.columns)  # both come from the same pairs: named anew, so that Spark tells them apart
    return asked.groupBy(*keys).cogroup(held.groupBy(*keys)).applyInPandas(search, fields)


class _Leaves:
    """Vectors of blocks and the centre and radius of each of their leaves."""

    def __init__(self, flat, sizes):
        sizes = np.asarray(sizes, np.int64)
        self.n = int(sizes.sum())
        self.vectors = np.concatenate([np.asarray(f, dtype=float) for f in flat]).reshape(self.n, -1)
        starts = np.cumsum(sizes) - sizes
        self.edges = np.concatenate([at + np.arange(0, n, LEAF) for at, n in zip(starts, sizes)])
        self.ends = np.append(self.edges[1:], self.n)
        self.block = np.repeat(np.arange(len(sizes)), -(-sizes // LEAF))
        counts = self.ends - self.edges
        self.centres = np.add.reduceat(self.vectors, self.edges, axis=0) / counts[:, None]
        off = np.sqrt(((self.vectors - np.repeat(self.centres, counts, axis=0)) ** 2).sum(axis=1))
        self.radii = np.maximum.reduceat(off, self.edges)
        self.squares = (self.vectors * self.vectors).sum(axis=1)
        self.finite = bool(np.isfinite(self.squares).all())
        self.largest = self.squares.max()
        self.lifted = np.concatenate((self.vectors, self.squares[:, None]), axis=1)

    def groups(self, block: int) -> Iterator[tuple[np.ndarray, slice]]:
        """The leaves of a block, a few neighbours at a time, and where their points are."""
        leaves = np.flatnonzero(self.block == block)
        for at in range(0, len(leaves), _LEAVES_ASKING):
            some = leaves[at : at + _LEAVES_ASKING]
            yield some, slice(int(self.edges[some[0]]), int(self.ends[some[-1]]))

    def rooms(self, leaves: np.ndarray, other: _Leaves, there: np.ndarray) -> np.ndarray:
        """At least this far is any point of some leaves here from those of each leaf there."""
        rooms = _apart(self.centres[leaves], other.centres[there]) - self.radii[leaves, None] - other.radii[None, there] - _SLACK
        return np.maximum(rooms, 0.0).min(axis=0)

    def places(self, leaves: np.ndarray) -> np.ndarray:
        return np.concatenate([np.arange(self.edges[i], self.ends[i]) for i in leaves])


def _squares(q: _Leaves, asks: np.ndarray, o: _Leaves, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared distances less the square of the asking point, and by how much they may be wrong; unknown (-inf) where numbers overflow."""
    slack = _error(q.vectors.shape[1], q.squares[asks], o.largest)
    if not (q.finite and o.finite):
        return np.full((len(asks), len(places)), -np.inf), np.zeros(len(asks))
    left = np.concatenate((-2.0 * q.vectors[asks], np.ones((len(asks), 1))), axis=1)
    return left @ o.lifted[places].T, slack


def _true_cells(cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of the cells that are true, as ``nonzero`` gives them: few are, and a flat array is searched faster."""
    return np.divmod(np.flatnonzero(cells), cells.shape[1])


def _keep_best(best: np.ndarray, who: np.ndarray, row: np.ndarray, d: np.ndarray, place: np.ndarray, ids: np.ndarray) -> None:
    """Take what was found into the lists of the ``k`` nearest, ties by id."""
    k = best.shape[1]
    touched = np.unique(row)
    row = np.concatenate((np.repeat(touched, k), row))
    d, place = np.concatenate((best[touched].ravel(), d)), np.concatenate((who[touched].ravel(), place))
    order = np.lexsort((np.where(place < 0, np.iinfo(np.int64).max, ids[place]), d, row))
    row, d, place = row[order], d[order], place[order]
    first = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))
    rank = np.arange(len(row)) - np.repeat(first, np.diff(np.append(first, len(row))))
    keep = rank < k
    best[row[keep], rank[keep]], who[row[keep], rank[keep]] = d[keep], place[keep]


def _nearest_in(q: _Leaves, block: int, q_ids: np.ndarray, bound: np.ndarray, o: _Leaves, o_ids: np.ndarray, k: int, there: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(place of the asking point, place of the found one, distance): the ``k`` nearest in the leaves ``there`` within each point's bound, ties by id."""
    for leaves, part in q.groups(block):
        asks, limit = np.arange(part.start, part.stop), bound[part].copy()
        best, who = np.full((len(asks), k), np.inf), np.full((len(asks), k), -1)
        rooms = q.rooms(leaves, o, there)
        order = np.argsort(rooms, kind="stable")
        for at in range(0, len(order), _LEAVES_AT_ONCE):
            some = order[at : at + _LEAVES_AT_ONCE]
            some = some[rooms[some] <= limit.max()]
            if not len(some):
                break
            places = o.places(there[some])
            square, slack = _squares(q, asks, o, places)
            most = limit * limit - q.squares[asks] + slack
            free = np.flatnonzero(np.isinf(limit))
            if len(free) and len(places) > k + 1:
                # The point itself may be among them: one more than k are surely as near as this.
                kth = np.partition(square[free], k, axis=1)[:, k]
                most[free] = np.where(np.isfinite(kth), kth + 2 * slack[free], np.inf)
            row, column = _true_cells(square <= np.where(np.isnan(most), np.inf, most)[:, None])
            other = q_ids[asks[row]] != o_ids[places[column]]
            row, place = row[other], places[column[other]]
            d = _paired(q.vectors[asks[row]], o.vectors[place])
            near = np.isfinite(d) & (d <= limit[row])
            if near.any():
                _keep_best(best, who, row[near], d[near], place[near], o_ids)
                limit = np.minimum(limit, best[:, -1])
        row, column = np.nonzero(np.isfinite(best))
        yield asks[row], who[row, column], best[row, column]


def _search(k: int):
    """Nearest neighbours of asking blocks among holding ones; without the latter, of the blocks of one shelf among themselves."""

    def search(asked: pd.DataFrame, held: pd.DataFrame | None = None) -> pd.DataFrame:
        own = held is None
        held = asked if own else held
        out = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0), np.empty(0, np.int64))]
        if len(asked) and len(held):
            q = _Leaves(asked["vectors"], asked["pids"].str.len())
            ids = np.concatenate(asked["pids"].to_numpy())
            o = q if own else _Leaves(held["vectors"], held["pids"].str.len())
            o_ids, mults = np.concatenate(held["pids"].to_numpy()), np.concatenate(held["mults"].to_numpy())
            bound = np.full(len(ids), np.inf) if own else np.concatenate(asked["bound"].to_numpy()).astype(float)
            at = {b: i for i, b in enumerate(held["block"].tolist())}
            for block in range(len(asked)):
                there = np.arange(len(o.edges)) if own else np.flatnonzero(np.isin(o.block, [at[b] for b in asked["others"].iloc[block]]))
                for who, found, d in _nearest_in(q, block, ids, bound, o, o_ids, k, there):
                    out.append((ids[who], o_ids[found], d, mults[found]))
        pid, nbr, d, mult = (np.concatenate(x) for x in zip(*out))
        language = asked["language"].iloc[0] if len(asked) else None
        return pd.DataFrame({"language": language, "pid": pid, "nbr": nbr, "d": d, "nbr_mult": mult})

    return search


_FOUND = "language string, pid long, nbr long, d double, nbr_mult long"


def nearest_neighbors(layout: Layout, k: int) -> DataFrame:
    """``(language, pid, nbr, d, nbr_mult)``: the exact ``k`` nearest other points."""
    order = [F.col("d"), F.col("nbr")]
    packed = layout.blocks.select("language", "block", "pids", "mults", "vectors")
    alone = _search(k)
    shelves = layout.blocks.select("language", "shelf", "block", "pids", "mults", "vectors").groupBy("language", "shelf")
    first = write_through(shelves.applyInPandas(lambda rows: alone(rows), _FOUND), "near")
    if not layout.several:
        return first
    bound = first.groupBy(*_ID).agg(F.when(F.count(F.lit(1)) == k, F.max("d")).alias("bound"))
    asking = layout.points.join(bound, _ID, "left").withColumn("bound", F.coalesce("bound", F.lit(float("inf"))))
    asking = write_through(asking, "asking")
    nothing = {"low_core": F.lit(0.0), "held_core": F.lit(0.0), "uniform": F.lit(None).cast("long")}
    summary = asking.groupBy("language", "block").agg(F.max("bound").alias("bound")).withColumns(nothing)
    pairs = write_through(_pairs(layout, summary, "others"), "pairs")
    queries = packed.drop("mults").join(_marks(asking, "bound"), ["language", "block"])
    pair = _search(k)
    second = _meetings(layout, pairs, queries, packed, lambda asked, held: pair(asked, held), _FOUND, own=False)
    return write_through(top_per_group(first.unionByName(second), _ID, order, k), "neighbors")


def core_distances(points: DataFrame, neighbors: DataFrame, min_samples: int, listed: int | None = None) -> DataFrame:
    """``(language, pid, core, reach)``: distance to the ``min_samples``-th other point, where
    copies of a point count; ``reach`` is the distance to the last of ``listed`` (``min_samples``, if not given) neighbours."""
    lists = neighbors.groupBy(*_ID).agg(F.sort_array(F.collect_list(F.struct("d", "nbr", "nbr_mult"))).alias("_n"))
    joined = points.select(*_ID, "mult").join(lists, _ID, "left")
    # Few neighbours are listed; walk along them until enough points are met.
    walk = F.aggregate(
        F.coalesce("_n", F.array().cast("array<struct<d:double,nbr:bigint,nbr_mult:bigint>>")),
        F.struct((F.col("mult") - 1).alias("met"), F.lit(0.0).alias("core")),
        lambda s, x: F.struct(
            (s["met"] + x["nbr_mult"]).alias("met"),
            F.when(s["met"] >= min_samples, s["core"]).otherwise(x["d"]).alias("core"),
        ),
    )
    complete = F.size("_n") == (listed or min_samples)
    return joined.select(
        *_ID, walk["core"].alias("core"),
        F.when(complete, F.element_at("_n", -1)["d"]).otherwise(F.lit(float("inf"))).alias("reach"),
    )


def _lightest_in(q: _Leaves, block: int, o: _Leaves, mine: dict[str, np.ndarray], theirs: dict[str, np.ndarray], limit: np.ndarray, there: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """(asking point, other point, weight) of edges that may be their component's lightest; ``limit``, by component, is brought down on the way."""
    low = np.minimum.reduceat(theirs["core"], o.edges)[there]
    ends = np.minimum.reduceat(theirs["comp"], o.edges)[there], np.maximum.reduceat(theirs["comp"], o.edges)[there]
    for leaves, part in q.groups(block):
        asks = np.arange(part.start, part.stop)[mine["reach"][part] <= limit[mine["code"][part]]]
        if not len(asks):
            continue
        comp, code, core = mine["comp"][asks], mine["code"][asks], mine["core"][asks]
        weight = np.maximum(np.maximum(q.rooms(leaves, o, there), low), core.min())
        alone = (ends[0] == comp[0]) & (ends[1] == comp[0]) if (comp == comp[0]).all() else np.zeros(len(low), bool)
        order = np.argsort(weight, kind="stable")
        order = order[~alone[order]]
        for at in range(0, len(order), _LEAVES_AT_ONCE):
            some = order[at : at + _LEAVES_AT_ONCE]
            some = some[weight[some] <= limit[code].max()]
            if not len(some):
                break
            places = o.places(there[some])
            places = places[theirs["core"][places] <= limit[code].max()]
            if not len(places):
                continue
            square, slack = _squares(q, asks, o, places)
            most = limit[code] ** 2 - q.squares[asks] + slack
            free = np.isinf(limit[code])
            if free.any():
                # Nothing is known of these: as near as the lightest here, other components only.
                heavy = np.maximum(square[free] + q.squares[asks[free], None], np.maximum(core[free, None], theirs["core"][places][None, :]) ** 2)
                heavy[comp[free, None] == theirs["comp"][places][None, :]] = np.inf
                most[free] = heavy.min(axis=1) - q.squares[asks[free]] + 3 * slack[free]
            near = square <= np.where(np.isnan(most), np.inf, most)[:, None]
            if near.sum() > 8 * len(asks):
                near &= comp[:, None] != theirs["comp"][places][None, :]
            row, column = _true_cells(near)
            place = places[column]
            other = (comp[row] != theirs["comp"][place]) & (theirs["core"][place] <= limit[code[row]])
            row, place = row[other], place[other]
            w = np.maximum(_paired(q.vectors[asks[row]], o.vectors[place]), np.maximum(core[row], theirs["core"][place]))
            np.minimum.at(limit, code[row], np.where(np.isnan(w), np.inf, w))
            good = np.isfinite(w) & (w <= limit[code[row]])
            yield asks[row[good]], place[good], w[good]


def _edge_search(asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
    """Per component of the asking blocks, the lightest edge to another component among the holding ones."""
    out = [(np.empty(0, np.int64),) * 3 + (np.empty(0),)]
    if len(asked) and len(held):
        flat = lambda rows, *columns: {c: np.concatenate(rows[c].to_numpy()) for c in columns}
        mine, theirs = flat(asked, "pids", "core", "comp", "reach", "bound"), flat(held, "pids", "core", "comp")
        names, mine["code"] = np.unique(mine["comp"], return_inverse=True)
        limit = np.full(len(names), -np.inf)
        np.maximum.at(limit, mine["code"], mine["bound"].astype(float))
        q, o = _Leaves(asked["vectors"], asked["pids"].str.len()), _Leaves(held["vectors"], held["pids"].str.len())
        at = {b: i for i, b in enumerate(held["block"].tolist())}
        for block in range(len(asked)):
            there = np.flatnonzero(np.isin(o.block, [at[b] for b in asked["others"].iloc[block]]))
            for x, y, w in _lightest_in(q, block, o, mine, theirs, limit, there):
                a, b = mine["pids"][x], theirs["pids"][y]
                out.append((mine["comp"][x], np.minimum(a, b), np.maximum(a, b), w))
    comp, a, b, w = (np.concatenate(x) for x in zip(*out))
    order = np.lexsort((b, a, w, comp))
    order = order[np.concatenate(([True], comp[order][1:] != comp[order][:-1]))[: len(order)]]
    language = asked["language"].iloc[0] if len(asked) else None
    return pd.DataFrame({"language": language, "comp": comp[order], "w": w[order], "a": a[order], "b": b[order]})


_EDGES = "language string, comp long, w double, a long, b long"


def _lightest(edges: DataFrame) -> DataFrame:
    best = edges.groupBy("language", "comp").agg(F.min(F.struct("w", "a", "b")).alias("_e"))
    return best.select("language", "comp", "_e.w", "_e.a", "_e.b")


def _join_components(state: DataFrame, chosen: DataFrame) -> DataFrame:
    """New component of every point after all components follow their chosen edge."""
    comp_of = state.select("language", "pid", "comp")
    ends = chosen.join(comp_of.withColumnsRenamed({"pid": "a", "comp": "_ca"}), ["language", "a"])
    ends = ends.join(comp_of.withColumnsRenamed({"pid": "b", "comp": "_cb"}), ["language", "b"])
    other = F.when(F.col("_ca") == F.col("comp"), F.col("_cb")).otherwise(F.col("_ca"))
    parent = write_through(ends.select("language", "comp", other.alias("up")), "parents")
    back = parent.select("language", F.col("comp").alias("up"), F.col("up").alias("_back"))
    # Two that chose each other: the smaller one is the root.
    mutual = (F.col("_back") == F.col("comp")) & (F.col("comp") < F.col("up"))
    step = parent.join(back, ["language", "up"], "left").select(
        "language", "comp", F.when(mutual, F.col("comp")).otherwise(F.col("up")).alias("up")
    )
    while True:
        above = step.select("language", F.col("comp").alias("up"), F.col("up").alias("_top"))
        jumped = step.join(above, ["language", "up"], "left").select(
            "language", "comp", F.coalesce("_top", "up").alias("up"), (F.coalesce("_top", "up") != F.col("up")).alias("moved")
        )
        step, seen = measured_write(jumped, "parents", moved=F.count_if("moved"))
        step = step.drop("moved")
        if not seen["moved"]:
            break
    renamed = state.join(step, ["language", "comp"], "left")
    return write_through(renamed.withColumn("comp", F.coalesce("up", "comp")).drop("up").select(*state.columns), "components")


def _grown(w: np.ndarray, ids: np.ndarray, gap: float) -> tuple[np.ndarray, list[tuple[float, int, int]]]:
    """Components (named by their smallest id) and edges after joining while a component's lightest edge is shorter than ``gap``."""
    comp, edges = ids.copy(), []
    w = w.copy()
    np.fill_diagonal(w, np.inf)
    while True:
        best = w.min(axis=1)
        names, code = np.unique(comp, return_inverse=True)
        if len(names) == 1:
            return comp, edges
        limit = np.full(len(names), np.inf)
        np.minimum.at(limit, code, best)
        rows = np.flatnonzero((best == limit[code]) & (best < gap))
        if not len(rows):
            return comp, edges
        at, column = np.nonzero(w[rows] == best[rows, None])
        x, y = ids[rows[at]], ids[column]
        found = pd.DataFrame({"comp": comp[rows[at]], "to": comp[column], "w": best[rows[at]], "a": np.minimum(x, y), "b": np.maximum(x, y)})
        found = found.sort_values(["comp", "w", "a", "b"]).drop_duplicates("comp")
        edges += list(found[["w", "a", "b"]].drop_duplicates().itertuples(index=False, name=None))
        up = {n: n for n in names.tolist()}
        for mine, to in zip(found["comp"].tolist(), found["to"].tolist()):
            while up[mine] != mine:
                mine = up[mine]
            while up[to] != to:
                to = up[to]
            up[max(mine, to)] = min(mine, to)
        for n in names.tolist():  # smaller names come first and are final
            up[n] = up[up[n]]
        comp = np.array([up[n] for n in names.tolist()])[code]
        w[comp[:, None] == comp[None, :]] = np.inf


def _inner_trees(layout: Layout, cores: DataFrame) -> DataFrame:
    """``(language, pid, comp, a, b, w)``: for each point the component it has, and for each edge that is certain, inside its block.

    The lightest edge of a component inside a block is its lightest at all if no other block is as near; a block with a language to itself is done here.
    """
    points = layout.points.join(cores.select(*_ID, "core"), _ID)
    blocks = layout.blocks.select("language", "block", "pids", "vectors").join(_marks(points, "core"), ["language", "block"])
    if layout.several:
        plain = {"bound": F.lit(0.0), "low_core": F.lit(0.0), "held_core": F.lit(0.0), "uniform": F.lit(None).cast("long")}
        gaps = _pairs(layout, layout.blocks.select("language", "block").withColumns(plain), "gap").withColumnRenamed("asks", "block")
        blocks = blocks.join(gaps, ["language", "block"], "left").withColumn("gap", F.coalesce("room", F.lit(float("inf")))).drop("room")
    else:
        blocks = blocks.withColumn("gap", F.lit(float("inf")))

    def grow(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples(index=False):
                ids, core = np.asarray(r.pids), np.asarray(r.core)
                if r.gap <= 0:  # another block may be as near as anything
                    yield pd.DataFrame({"language": r.language, "pid": ids, "comp": ids, "a": None, "b": None, "w": None}).astype({"a": "Int64", "b": "Int64", "w": float})
                    continue
                vectors = np.asarray(r.vectors, dtype=float).reshape(len(ids), -1)
                comp, edges = _grown(np.maximum(_distances(vectors, vectors), np.maximum(core[:, None], core[None, :])), ids, r.gap)
                yield pd.DataFrame({"language": r.language, "pid": ids, "comp": comp, "a": None, "b": None, "w": None}).astype({"a": "Int64", "b": "Int64", "w": float})
                if edges:
                    w, a, b = zip(*edges)
                    yield pd.DataFrame({"language": r.language, "pid": None, "comp": None, "a": a, "b": b, "w": w}).astype({"pid": "Int64", "comp": "Int64"})

    return write_through(blocks.mapInPandas(grow, "language string, pid long, comp long, a long, b long, w double"), "inner")


def spanning_tree(layout: Layout, neighbors: DataFrame, cores: DataFrame) -> DataFrame:
    """Minimum spanning tree under mutual reachability: ``(language, a, b, w)``.

    Trees inside blocks come first. Then each round joins every component along its lightest outgoing edge, with ties broken by the
    ends, so the rounds are at most the logarithm of the number of points. Edges between listed
    neighbours are tried first; they bound the search among the others.
    """
    inner = _inner_trees(layout, cores)
    tree = inner.where(F.col("a").isNotNull()).select("language", "a", "b", "w")
    if not layout.several:
        return tree
    grown = inner.where(F.col("a").isNull()).select(*_ID, "comp")
    state = write_through(layout.points.join(cores, _ID).join(grown, _ID).select("language", "pid", "block", "pos", "core", "reach", "comp"), "components")
    listed = neighbors.join(cores.select(*_ID, "core"), _ID).join(
        cores.select("language", F.col("pid").alias("nbr"), F.col("core").alias("_other")), ["language", "nbr"]
    )
    weight = F.greatest("core", "_other", "d")
    listed = write_through(listed.select("language", "pid", "nbr", weight.alias("w")), "listed")
    vectors = layout.blocks.select("language", "block", "pids", "vectors")
    infinite = F.lit(float("inf"))
    parts: list[DataFrame] = []
    while True:
        ends = state.groupBy("language").agg((F.min("comp") < F.max("comp")).alias("_open"))
        open_ = [r["language"] for r in ends.where("_open").collect()]
        if not open_:
            break
        state = state.where(F.col("language").isin(open_))
        comp_of = state.select("language", "pid", "comp")
        known = listed.join(comp_of, _ID).join(
            comp_of.withColumnsRenamed({"pid": "nbr", "comp": "_c"}), ["language", "nbr"]
        ).where(F.col("comp") != F.col("_c"))
        a, b = F.least("pid", "nbr").alias("a"), F.greatest("pid", "nbr").alias("b")
        # A listed edge serves both of its ends.
        both = F.explode(F.array("comp", "_c")).alias("comp")
        best = write_through(_lightest(known.select("language", both, "w", a, b)), "best")

        def bounded(best: DataFrame, state: DataFrame = state) -> tuple[DataFrame, DataFrame]:
            """The points with the bound of their component (null: none known), and what planning needs of the blocks."""
            points = write_through(state.join(best.select("language", "comp", F.col("w").alias("bound")), ["language", "comp"], "left"), "asking")
            # Whoever is not listed is at least `reach` away; incomplete lists (reach = inf) hold everyone.
            asks = F.col("bound").isNotNull() & (F.col("reach") <= F.col("bound"))
            one = F.when(F.min("comp") == F.max("comp"), F.min("comp")).alias("uniform")
            planned = points.groupBy("language", "block").agg(
                F.coalesce(F.max(F.when(asks, F.col("bound"))), F.lit(-1.0)).alias("bound"),
                F.coalesce(F.min(F.when(asks, F.col("core"))), infinite).alias("low_core"),
                F.min("core").alias("held_core"),
                one,
                F.count_if(F.col("bound").isNull()).alias("blind"),
            )
            return points, planned

        points, planned = bounded(best)
        if points.where(F.col("bound").isNull()).limit(1).count():
            # Components without a listed edge: the closest block that is not all their own holds one. A mixed block does itself.
            blind = planned.withColumn("bound", F.when(F.col("blind") > 0, 0.0).otherwise(-1.0))
            closest = _pairs(layout, blind.drop("blind"), "closest")
            probing = points.withColumn("bound", F.when(F.col("bound").isNull(), infinite).otherwise(-1.0)).withColumn("reach", F.lit(0.0))
            marked = vectors.join(_marks(probing, "core", "comp", "reach", "bound"), ["language", "block"])
            probed = _lightest(_meetings(layout, closest, marked, marked.drop("reach", "bound"), _edge_search, _EDGES))
            best = write_through(best.unionByName(probed), "best")
            points, planned = bounded(best)
        pairs = write_through(_pairs(layout, planned.drop("blind"), "within"), "pairs")
        marked = write_through(vectors.join(_marks(points, "core", "comp", "reach", "bound"), ["language", "block"]), "packs")
        found = _meetings(layout, pairs, marked, marked.drop("reach", "bound"), _edge_search, _EDGES)
        chosen = write_through(_lightest(best.unionByName(found)), "chosen")
        parts.append(chosen.select("language", "a", "b", "w").distinct())
        state = _join_components(state, chosen)
    return write_through(reduce(DataFrame.unionByName, parts, tree), "tree")
