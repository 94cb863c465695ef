"""Exact top-k by inner product of whole numbers, over an impact-ordered index, score at a time.

Every component of a vector is a posting of its dimension with the component's magnitude as impact. A block's index
keeps the postings of each dimension in order of impact, cut into segments of quantised impact. What a segment can add to a
query's score is at most its impact times the query's component. Each query takes the segments of all dimensions in descending order of
that product; the segments that a whole group of queries takes up to a point are worked off together, as one product of the
group's taken components and the block's segments. After that a vector's score lies within what the untaken
segments can still add or take. Processing stops only on proof: when few vectors can still be among the k best, given
the k-th score found so far here or in another block. These are scored exactly, in whole numbers.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame

from qaspark.llm.vector_blocks import ROWS_PER_BLOCK, best_of, clean_vectors, dump, load, search

#: Segments per dimension.
LEVELS = 4
#: The first stretch ends when untaken segments can add at most this share of the k-th score; each further one at this share of that.
SHARE = 0.6
#: Rescoring starts when at most this share of a block's vectors can still be members.
FEW = 0.1
#: Without a k-th score to begin with, this many vectors are scored.
SAMPLE = 512


def build_index(ids: np.ndarray, matrix: np.ndarray) -> bytes:
    """Postings by dimension and descending impact, and for each segment where it begins and the most it holds."""
    n, width = matrix.shape
    size = np.abs(matrix)
    order = np.argsort(-size, axis=0, kind="stable").T.astype(np.int32)
    # Quantised impacts: equal shares of all postings of the block, by magnitude.
    cuts = np.quantile(size, [1 - (i + 1) / LEVELS for i in range(LEVELS - 1)])
    starts, most = np.zeros((width, LEVELS + 1), np.int64), np.zeros((width, LEVELS), np.int64)
    for d in range(width):
        values = size[order[d], d]
        starts[d, 1:-1] = np.searchsorted(-values, -cuts, "right")
        starts[d, -1] = n
        held = starts[d, 1:] > starts[d, :-1]
        most[d, held] = values[starts[d, :-1][held]]
    return dump(ids=ids, matrix=matrix, postings=order, starts=starts, most=most)


class Block:
    """A block's index, ready for groups of queries."""

    def __init__(self, index: dict[str, np.ndarray]):
        self.ids, self.matrix, self.most = index["ids"], index["matrix"], index["most"]
        self.n, self.width = self.matrix.shape
        self.largest = int(self.most.max()) if self.most.size else 0
        self._index, self._taken = index, {}

    def segments(self, kind: type) -> np.ndarray:
        """One column per segment with the components of its postings, for products with many queries."""
        if kind not in self._taken:
            out = np.zeros((self.n, self.width * LEVELS), kind)
            for d in range(self.width):
                starts, order = self._index["starts"][d], self._index["postings"][d]
                for level in range(LEVELS):
                    some = order[starts[level] : starts[level + 1]]
                    out[some, d * LEVELS + level] = self.matrix[some, d]
            self._taken[kind] = out
        return self._taken[kind]

    def exact(self, places: np.ndarray, query: np.ndarray) -> np.ndarray:
        """Inner products in whole numbers of any size; an error if one is not a 64-bit number."""
        if self.width * self.largest * int(np.abs(query).max()) < 2**63:
            return self.matrix[places] @ query
        scores = self.matrix[places].astype(object) @ query.astype(object)
        if any(abs(x) >= 2**63 for x in scores):
            raise OverflowError("an inner product does not fit a 64-bit whole number")
        return scores.astype(np.int64)


def top_members(block: Block, queries: np.ndarray, query_ids: np.ndarray, k: int, floors: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each query the places and scores of its best ``k`` in the block that are not below its floor."""
    n, width = block.n, block.width
    size = np.abs(queries)
    # Products and sums are exact in these kinds of numbers, or the slack covers what rounding can do.
    reach = width * block.largest * float(size.max() if size.size else 0)
    kind = np.float32 if reach < 2**24 else np.float64
    slack = 0.0 if reach < 2**53 else reach * 1e-12
    segments = block.segments(kind)
    impact = (size[:, :, None] * block.most.astype(np.float64)[None]).reshape(len(queries), -1)
    drop = (impact.reshape(len(queries), width, LEVELS) - np.pad(impact.reshape(len(queries), width, LEVELS), ((0, 0), (0, 0), (0, 1)))[:, :, 1:]).reshape(impact.shape)
    order = np.argsort(-impact, axis=1, kind="stable")
    # What is still to come after each segment, in the order of taking them.
    whole = impact.reshape(len(queries), width, LEVELS)[:, :, :1].sum(axis=1)
    coming = whole - np.cumsum(np.take_along_axis(drop, order, axis=1), axis=1)
    rank = np.argsort(order, axis=1, kind="stable")
    spread = np.repeat(queries, LEVELS, axis=1).astype(kind)
    # A floor of more than 53 bits may have been rounded up.
    sure = np.where(np.abs(floors) < 2**53, floors, np.nextafter(floors, -np.inf))
    for i in np.flatnonzero(~np.isfinite(sure)):
        sample = np.flatnonzero(block.ids[: SAMPLE + 1] != query_ids[i])
        if len(sample) >= k:
            scores = block.exact(sample, queries[i])
            sure[i] = float(np.partition(scores, len(scores) - k)[len(scores) - k]) - slack
    out: list = [None] * len(queries)
    open_, share = np.arange(len(queries)), SHARE
    while len(open_):
        limit = share * np.maximum(sure[open_], 0.0)
        taken = (coming[open_] > limit[:, None]).sum(axis=1) + 1  # up to the first segment after which little enough is to come
        rest = np.maximum(np.take_along_axis(coming[open_], np.minimum(taken, impact.shape[1])[:, None] - 1, axis=1)[:, 0], 0.0) + slack
        total = (spread[open_] * (rank[open_] < taken[:, None])) @ segments.T
        still = []
        for row, i in enumerate(open_):
            others = np.flatnonzero((total[row] >= sure[i] - rest[row]) & (block.ids != query_ids[i]))
            if len(others) > FEW * n and rest[row] > slack:
                # The k-th exact score among the vectors ahead so far: no member of the result is below it.
                ahead = others[np.argpartition(-total[row, others], min(2 * k, len(others) - 1))[: 2 * k]]
                scores = np.sort(block.exact(ahead, queries[i]))
                if len(scores) >= k:
                    sure[i] = max(sure[i], float(scores[-k]) - slack)
                    others = others[total[row, others] >= sure[i] - rest[row]]
                if len(others) > FEW * n:
                    still.append(i)
                    continue
            scores = block.exact(others, queries[i])
            top = best_of(block.ids[others], scores, k)
            out[i] = (others[top], scores[top])
        open_, share = np.array(still, np.int64), share * SHARE if share > 0.01 else 0.0
    return out


def top_k(
    df: DataFrame,
    is_query: Column,
    k: int = 20,
    scale: float = 64.0,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    rows_per_block: int = ROWS_PER_BLOCK,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the exact k best of all other rows by inner product of floor(scale * x).

    ``is_query`` is a condition on the column ``id``. Vectors that are null, empty or hold a null or non-finite component
    take no part; zero vectors do. Vectors are compared with those of their own length. Ties go to the smaller id; a repeated id counts
    once, with its smallest vector. With fewer than k candidates all are returned. Other columns are left out. Scores are exact
    whole numbers; one that does not fit 64 bits, or a component that does not, is an error.
    """
    vectors = clean_vectors(df, id_col, vector_col, allow_zero=True)

    def whole(matrix: np.ndarray) -> np.ndarray:
        scaled = np.floor(matrix * scale)
        if len(scaled) and np.abs(scaled).max() >= 2**63:
            raise OverflowError("a scaled component does not fit a 64-bit whole number")
        return scaled.astype(np.int64)

    def find(blob, query_ids: np.ndarray, queries: np.ndarray, k: int, floors: np.ndarray):
        block = Block(load(blob))
        who, found, scores = [], [], []
        for q, (top, score) in enumerate(top_members(block, whole(queries), query_ids, k, floors)):
            who.append(np.full(len(top), q))
            found.append(block.ids[top])
            scores.append(score)
        return np.concatenate(who), np.concatenate(found), np.concatenate(scores)

    return search(vectors, is_query, k, lambda ids, matrix: build_index(ids, whole(matrix)), find, "long", rows_per_block)
