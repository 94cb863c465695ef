"""Ranked lexical search by NRA: sequential reads of impact-sorted lists, score intervals per document.

The documents are read once into blocks: for each document of a block its number of terms, and postings of the terms that the
items ask for. Numbers of all documents (how many, all their terms, documents per term) come from the same job. Then each
block sorts every list by impact, and for each item its lists are read from the top, a stretch at a time. What has been read
of a document is the lower end of its score; what the unread rests of its unseen lists can add at most leads to the upper end. Reading
goes on until the best k are known, all ties with the k-th are settled and each of their scores is one number. No list is
accessed by document. Blocks of one task share what they have found: the k-th best score so far ends later blocks early.

Only the terms of a slice of items, at most ``slice_terms`` pairs of item and term (or one item), are sent to tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from qaspark.session import measured_write, write_through

K, B = 10, 75
SLICE_TERMS = 500_000
BLOCK_DOCS, BLOCK_BYTES = 1 << 13, 1 << 25
#: The first stretch of every list; each further one is this many times as long.
STRETCH, GROWTH = 64, 4
RESULT = "item_id long, rank int, doc_id long, score long"
_SEPARATORS = [*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]
_TABLE = bytearray(range(256))
for _c in range(0x41, 0x5B):
    _TABLE[_c] += 32
for _c in _SEPARATORS:
    _TABLE[_c] = 0x20
_TABLE = bytes(_TABLE)


def terms_of(text: bytes | None) -> list[bytes]:
    """The terms of a UTF-8 text in order: runs of ASCII letters and digits and all characters beyond ASCII, A-Z lower-cased."""
    return (text or b"").translate(_TABLE).split()


def _squeeze(a: np.ndarray, kind: str) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(a.astype(kind).tobytes())


def _spread(blob, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), kind)


def item_terms(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``item_id, term (binary), times``: rows of one item_id are one item, null is one too."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, terms = [], []
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.large_binary()).to_pylist()):
                found = terms_of(t)
                ids += [i] * len(found)
                terms += found
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(terms, pa.binary())], names=["item_id", "term"])

    rows = items.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(cut, "item_id long, term binary").groupBy("item_id", "term").agg(F.count(F.lit(1)).alias("times"))


def read_block(ids: list[int | None], found: list[np.ndarray], lengths: list[int], n_terms: int) -> dict:
    """One block: documents with at least one term, and the postings of asked terms as sorted runs."""
    place = np.repeat(np.arange(len(found)), [len(x) for x in found])
    term = np.concatenate(found) if found else np.empty(0, np.int64)
    keys, tf = np.unique(term.astype(np.int64) << 32 | place, return_counts=True)
    return {
        "docs": _squeeze(np.array([i is not None for i in ids], np.int64), "<i1"),
        "ids": _squeeze(np.array([i or 0 for i in ids], np.int64), "<i8"),
        "lengths": _squeeze(np.array(lengths, np.int64), "<i8"),
        "terms": _squeeze(keys >> 32, "<i4"),
        "places": _squeeze(keys & 0xFFFFFFFF, "<i4"),
        "tf": _squeeze(tf, "<i8"),
        "n_docs": int(np.count_nonzero(np.array(lengths, np.int64) > 0)),
        "n_terms": int(sum(lengths)),
    }


_BLOCK = "block long, docs binary, ids binary, lengths binary, terms binary, places binary, tf binary, n_docs long, n_terms long"
_BLOCK_SCHEMA = pa.schema(
    [("block", pa.int64())] + [(n, pa.binary()) for n in ("docs", "ids", "lengths", "terms", "places", "tf")] + [("n_docs", pa.int64()), ("n_terms", pa.int64())]
)


class Lists:
    """The impact-sorted lists of a block, by number of the term."""

    def __init__(self, row: dict, weights: np.ndarray, n_docs: int, n_terms: int, b: int):
        self.known = _spread(row["docs"], "<i1").astype(bool)
        self.ids = _spread(row["ids"], "<i8")
        lengths = _spread(row["lengths"], "<i8")
        terms, places, tf = _spread(row["terms"], "<i4"), _spread(row["places"], "<i4"), _spread(row["tf"], "<i8")
        # b * n * N is taken in Python's numbers where 64 bits would not do.
        longest = int(lengths.max()) if len(lengths) else 0
        wide = b * longest * max(n_docs, 1) >= 2**63
        part = np.array([b * int(x) * n_docs // n_terms for x in lengths], np.int64) if wide else b * lengths * n_docs // max(n_terms, 1)
        m = 100 - b + part
        impact = weights[terms] * (1_000_000_000 * tf // (1000 * tf + 8 * m[places])) if len(terms) else np.empty(0, np.int64)
        order = np.lexsort((-impact, terms))
        self.places, self.impact, terms = places[order], impact[order], terms[order]
        edge = np.flatnonzero(np.diff(terms, prepend=-1))
        self.run = {int(t): (int(a), int(z)) for t, a, z in zip(terms[edge], edge, np.append(edge[1:], len(terms)))}


def best_by_intervals(lists: Lists, query: list[tuple[int, int]], k: int, floor: int = 1) -> tuple[np.ndarray, np.ndarray, int]:
    """Places and exact scores of the documents of a block that can be among an item's best ``k`` with a score of at least ``floor``.

    ``query`` holds (term, times). All documents that tie with the k-th are returned. The third value counts the entries read.
    """
    runs = [(*lists.run[t], times) for t, times in query if t in lists.run]
    none = np.empty(0, np.int64)
    if not runs:
        return none, none, 0
    begin, end = np.array([r[0] for r in runs]), np.array([r[1] for r in runs])
    times = np.array([r[2] for r in runs], np.int64)
    n, stretch, entries = len(lists.ids), STRETCH, 0
    lower = np.zeros(n, np.int64)
    seen = np.zeros((len(runs), n), bool)
    at = begin.copy()
    while True:
        # The most that the unread rest of each list can add.
        coming = np.where(at < end, lists.impact[np.minimum(at, end - 1)], 0) * times
        kth = floor
        if n >= k:
            kth = max(floor, int(np.partition(lower, n - k)[n - k]))
        some = np.flatnonzero(lower + coming.sum() >= kth)
        upper = lower[some] + coming.sum() - coming @ seen[:, some]
        ahead = upper >= kth
        some, upper = some[ahead], upper[ahead]
        # Members are settled once every interval that reaches the k-th score is a single number.
        if np.array_equal(upper, lower[some]):
            return some, upper, entries
        for i in np.flatnonzero(at < end):
            to = min(int(at[i]) + stretch, int(end[i]))
            places = lists.places[at[i] : to]
            lower[places] += lists.impact[at[i] : to] * times[i]
            seen[i, places] = True
            entries += to - int(at[i])
            at[i] = to
        stretch *= GROWTH


def rank_documents(
    docs: DataFrame, items: DataFrame, k: int = K, b: int = B, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", slice_terms: int = SLICE_TERMS
) -> DataFrame:
    """``item_id, rank, doc_id, score``: for each item its ``k`` best documents with a score above 0, ties by smaller doc_id.

    Null texts have no terms; a document without terms counts nowhere. Every row of ``docs`` is a document, so repeated
    ids are ranked one by one (a null id comes first among ties); rows with one item_id are one item. Items without a match have no row. Other
    columns are left out. Runs jobs when called.
    """
    asked, seen = measured_write(item_terms(items, item_col, item_text), "item_terms", rows=F.count(F.lit(1)))
    spark = docs.sparkSession
    if not seen["rows"]:
        return spark.createDataFrame([], RESULT)
    slices = -(-seen["rows"] // slice_terms)
    parts = [_rank_slice(docs, asked.where(F.pmod(F.xxhash64("item_id"), F.lit(slices)) == s), k, b, id_col, text_col) for s in range(slices)]
    found = parts[0]
    for p in parts[1:]:
        found = found.unionByName(p)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_first(), "spot")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")


def _rank_slice(docs: DataFrame, asked: DataFrame, k: int, b: int, id_col: str, text_col: str) -> DataFrame:
    spark = docs.sparkSession
    rows = asked.collect()  # bounded by the size of a slice
    numbers = {t: i for i, t in enumerate(sorted({bytes(r["term"]) for r in rows}))}
    queries: dict[int | None, list[tuple[int, int]]] = {}
    for r in rows:
        queries.setdefault(r["item_id"], []).append((numbers[bytes(r["term"])], r["times"]))
    shared = spark.sparkContext.broadcast(numbers)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get, n = shared.value.get, len(shared.value)
        number, ids, found, lengths, size = TaskContext.get().partitionId() << 32, [], [], [], 0

        def finish() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([{"block": number, **read_block(ids, found, lengths, n)}], schema=_BLOCK_SCHEMA)

        for batch in batches:
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.large_binary())):
                t = t.as_py() or b""
                terms = terms_of(t)
                codes = np.fromiter(map(get, terms, repeat(-1)), np.int32, len(terms))
                ids.append(i)
                found.append(codes[codes >= 0])
                lengths.append(len(terms))
                size += len(t)
                if size >= BLOCK_BYTES or len(ids) >= BLOCK_DOCS:
                    yield finish()
                    number, ids, found, lengths, size = number + 1, [], [], [], 0
        if ids:
            yield finish()

    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    count = lambda name: F.coalesce(F.sum(name), F.lit(0))
    blocks, total = measured_write(texts.mapInArrow(read, _BLOCK), "ranked_blocks", docs=count("n_docs"), terms=count("n_terms"))
    n_docs, n_terms = total["docs"], total["terms"]

    def holding(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(len(shared.value), np.int64)
        for batch in batches:
            for blob in batch.column(0):
                sums += np.bincount(_spread(blob.as_buffer(), "<i4"), minlength=len(sums))
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums[at])], names=["term", "df"])

    held = blocks.select("terms").mapInArrow(holding, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect()
    weights = np.zeros(len(numbers), np.int64)
    for r in held:
        weights[r["term"]] = int(np.floor(1000 * np.log((2 * n_docs + 2) / (2 * r["df"] + 1))))
    meet = spark.sparkContext.broadcast((weights, queries))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, queries = meet.value
        best: dict[int | None, list[tuple]] = {}
        for batch in batches:
            for row in batch.to_pylist():
                lists = Lists(row, weights, n_docs, n_terms, b)
                for item, query in queries.items():
                    mine = best.get(item, [])
                    floor = -mine[k - 1][0] if len(mine) >= k else 1
                    places, scores, _ = best_by_intervals(lists, query, k, max(floor, 1))
                    if len(places):
                        new = [(-int(s), bool(lists.known[p]), int(lists.ids[p]), row["block"], int(p)) for p, s in zip(places, scores)]
                        best[item] = sorted(mine + new)[:k]
        out = [(item, i if known else None, -s, block << 20 | place) for item, found in best.items() for s, known, i, block, place in found]
        columns = zip(*out) if out else ([], [], [], [])
        yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns], names=["item_id", "doc_id", "score", "spot"])

    needed = [n for n in blocks.columns if n not in ("n_docs", "n_terms")]
    return write_through(blocks.select(*needed).mapInArrow(search, "item_id long, doc_id long, score long, spot long"), "ranked")
