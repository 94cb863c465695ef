"""Approximate nearest neighbours by collision-counting hashing, largest inner product first.

Vectors are lifted to one length (one more component), queries are scaled to that length, so the largest inner
product is the smallest distance. Each of ``projections`` random lines keeps the block's projections as one
sorted array. A query opens a window around its own projection on every line, of the width at which a vector as near as its k-th
best so far collides on ``collisions`` of the lines with the certainty ``certainty``. A vector that lies in the windows of that
many lines is verified with its exact inner product. The search begins with narrow windows; each widening (virtual
rehashing: the arrays stay, the windows grow) goes as far as the k-th best still demands, and ends when it demands no more.
A k-th best known from another block sets the first demand, so most windows open once.
"""

from __future__ import annotations

from statistics import NormalDist

import numpy as np
from pyspark.sql import Column, DataFrame

from qaspark.llm.vector_blocks import ROWS_PER_BLOCK, best_of, clean_vectors, dump, load, search

#: These give a recall of about 0.96 on unit vectors of 64 components without any structure, the hardest case.
PROJECTIONS = 128
COLLISIONS = 0.95
CERTAINTY = 0.92
#: The first windows are this much narrower than what a sample of the block demands.
NARROW = 0.85
SAMPLE = 1024
#: Windows that hold fewer than k collisions grow by this.
WIDER = 1.25


def window_of(distance: float, projections: int, needed: int, certainty: float) -> float:
    """Half the width at which a vector at ``distance`` collides on ``needed`` of the lines with ``certainty``.

    On one line the two projections differ by a normal number of deviation ``distance``.
    """
    low, high = 0.0, 1.0
    z = NormalDist().inv_cdf(certainty)
    for _ in range(50):
        p = (low + high) / 2
        reached = projections * p - z * np.sqrt(projections * p * (1 - p)) >= needed - 0.5
        low, high = (low, p) if reached else (p, high)
    return distance * NormalDist().inv_cdf(min(0.5 + high / 2, 1 - 1e-12))


def nearest(
    df: DataFrame,
    is_query: Column,
    k: int = 20,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    projections: int = PROJECTIONS,
    collisions: float = COLLISIONS,
    certainty: float = CERTAINTY,
    rows_per_block: int = ROWS_PER_BLOCK,
) -> DataFrame:
    """``query_id, rank, vec_id, score`` for every row that ``is_query`` (a condition on the column ``id``) holds for.

    Candidates are all other rows of the same length. Vectors that are null, empty, zero, or hold a null or non-finite component take no
    part. Ties go to the smaller id; a repeated id counts once, with its smallest vector. Other columns are left out.
    ``score`` is the inner product in double precision. With fewer than k candidates all are returned.
    """
    vectors = clean_vectors(df, id_col, vector_col, allow_zero=False)
    needed = int(np.ceil(collisions * projections))
    unit = window_of(1.0, projections, needed, certainty)

    def lines(width: int) -> np.ndarray:
        return np.random.Generator(np.random.PCG64(7)).standard_normal((width, projections))

    def build(ids: np.ndarray, matrix: np.ndarray) -> bytes:
        squares = np.einsum("ij,ij->i", matrix, matrix)
        longest = np.sqrt(squares.max())
        lifted = np.column_stack((matrix, np.sqrt(np.maximum(longest**2 - squares, 0))))
        placed = (lifted @ lines(lifted.shape[1])).T / longest
        order = np.argsort(placed, axis=1, kind="stable").astype(np.int32)
        return dump(ids=ids, matrix=matrix, order=order, sorted=np.take_along_axis(placed, order, axis=1), longest=np.array([longest]))

    def find(blob, query_ids: np.ndarray, queries: np.ndarray, k: int, floors: np.ndarray):
        index = load(blob)
        ids, matrix, order, placed = index["ids"], index["matrix"], index["order"], index["sorted"]
        longest, n = float(index["longest"][0]), len(ids)
        norms = np.sqrt(np.einsum("ij,ij->i", queries, queries))
        centres = (queries / norms[:, None]) @ lines(queries.shape[1] + 1)[:-1]

        def demanded(score: np.ndarray, q: np.ndarray) -> np.ndarray:
            """The window in which vectors with at least this score are found."""
            return unit * np.sqrt(np.maximum(2 - 2 * score / (norms[q] * longest), 0))

        # The k-th best so far: that of other blocks, or of a sample of this one.
        bound = floors.copy()
        free = np.flatnonzero(~np.isfinite(bound))
        if len(free) and n > k:
            sample = np.where(ids[:SAMPLE][None, :] == query_ids[free, None], -np.inf, queries[free] @ matrix[:SAMPLE].T)
            if sample.shape[1] > k:
                bound[free] = np.partition(sample, sample.shape[1] - k, axis=1)[:, sample.shape[1] - k]
        radius = np.full(len(queries), np.inf)
        some = np.flatnonzero(np.isfinite(bound))
        radius[some] = demanded(bound[some], some)
        radius[free] *= NARROW
        missed: list = [None] * len(queries)
        low, high = np.zeros((len(queries), projections), np.int64), np.full((len(queries), projections), n)
        who, found, scores = [], [], []
        active = np.arange(len(queries))
        while len(active):
            # The windows of all open queries on one line are two binary searches in its sorted array.
            new_low = np.stack([np.searchsorted(line, c - radius[active], "left") for line, c in zip(placed, centres[active].T)], axis=1)
            new_high = np.stack([np.searchsorted(line, c + radius[active], "right") for line, c in zip(placed, centres[active].T)], axis=1)
            open_ = []
            for i, q in enumerate(active):
                # Wide windows leave little outside, so what is counted is what does not collide.
                if missed[q] is None:
                    outside = [order[j, : new_low[i, j]] for j in range(projections)] + [order[j, new_high[i, j] :] for j in range(projections)]
                    missed[q] = np.bincount(np.concatenate(outside), minlength=n)
                else:
                    grown = [order[j, new_low[i, j] : low[q, j]] for j in range(projections)] + [order[j, high[q, j] : new_high[i, j]] for j in range(projections)]
                    missed[q] -= np.bincount(np.concatenate(grown), minlength=n)
                chosen = np.flatnonzero(missed[q] <= projections - needed)
                chosen = chosen[ids[chosen] != query_ids[q]]
                near = matrix[chosen] @ queries[q]
                top = best_of(ids[chosen], near, k)
                everything = not new_low[i].any() and (new_high[i] == n).all()
                if not everything:
                    if len(top) >= k:
                        bound[q] = max(bound[q], near[top[-1]])
                    elif not np.isfinite(floors[q]):
                        # Nothing else holds k vectors for this query, so this block has to.
                        radius[q] *= WIDER
                        open_.append(q)
                        continue
                    wanted = float(demanded(bound[q : q + 1], np.array([q]))[0]) if np.isfinite(bound[q]) else np.inf
                    if wanted > radius[q]:
                        radius[q] = wanted
                        open_.append(q)
                        continue
                top = chosen[top]
                who.append(np.full(len(top), q))
                found.append(ids[top])
                scores.append((matrix[top] * queries[q]).sum(axis=1))
                missed[q] = None
            low[active], high[active] = new_low, new_high
            active = np.array(open_, np.int64)
        return np.concatenate(who), np.concatenate(found), np.concatenate(scores)

    return search(vectors, is_query, k, build, find, "double", rows_per_block, queries_per_group=256)


def exact_nearest(matrix: np.ndarray, ids: np.ndarray, query: np.ndarray, query_id: int, k: int) -> np.ndarray:
    """Ids of the k best by brute force, for measuring recall."""
    keep = np.flatnonzero(ids != query_id)
    return ids[keep][best_of(ids[keep], matrix[keep] @ query, k)]
