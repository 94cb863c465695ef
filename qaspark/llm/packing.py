"""Packing token sequences by lexical retrieval: a window is filled with the seed's BM25 neighbours.

Documents are encoded once and dealt to shards by a MinHash of their id pairs, so documents that share text
mostly share a shard. A shard holds a bounded number of documents and its own inverted index over token ids;
inverse document frequencies and the mean length come from all documents (one number per vocabulary entry).
In a shard, the next unused document is the seed; the index ranks all unused documents that score for any of the seed's
terms, and the window is filled in that order; the last one is cut to fit and its rest waits for a later window. Only when
none scores do the next unused documents follow in shard order.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qaspark.llm.tokens import encoder, forget
from qaspark.llm.words import blocks, mix
from qaspark.session import measured_write

WINDOW = 2048
SHARD_DOCS, SHARD_TOKENS = 2048, 1 << 20
K1, B = 1.2, 0.75
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
_SCHEMA = pa.schema([(x.split()[0], pa.int64()) for x in PIECES.split(", ")])


class Shard:
    """The inverted index of some documents over their token ids."""

    def __init__(self, docs: list[np.ndarray], idf: np.ndarray, mean_length: float):
        n = len(docs)
        lengths = np.fromiter(map(len, docs), np.int64, n)
        ids = np.concatenate(docs)
        # Stable sorts of small numbers: by id, documents stay in order; then the postings by document, ids stay in order.
        order = np.argsort(ids, kind="stable")
        term, doc = ids[order].astype(np.int64), np.repeat(np.arange(n, dtype=np.uint16 if n <= 1 << 16 else np.int64), lengths)[order]
        edge = np.flatnonzero(np.concatenate(([True], (term[1:] != term[:-1]) | (doc[1:] != doc[:-1]))))
        tf = np.diff(np.append(edge, len(term)))
        term, doc = term[edge], doc[edge]
        weight = idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * lengths[doc] / mean_length))
        forward = np.argsort(doc, kind="stable")
        self.n, self.terms_of, self.term = n, np.searchsorted(doc[forward], np.arange(n + 1)), term[forward]
        self.posting_doc, self.posting_weight = doc.astype(np.int64), weight
        self.distinct, self.posting = np.unique(term, return_index=True)
        self.posting, self.indexed = np.append(self.posting, len(term)), n

    def neighbours(self, seed: int, unused: np.ndarray) -> np.ndarray:
        """All unused documents with a BM25 score for the terms of the seed, best first."""
        self._shrink(unused)
        a, b = self.terms_of[seed], self.terms_of[seed + 1]
        at = np.searchsorted(self.distinct, self.term[a:b])
        begin, n = self.posting[at], self.posting[at + 1] - self.posting[at]
        place = np.repeat(begin - np.cumsum(n) + n, n) + np.arange(n.sum())
        scores = np.bincount(self.posting_doc[place], weights=self.posting_weight[place], minlength=self.n)
        scores[~unused] = 0
        best = np.flatnonzero(scores > 0)
        return best[np.argsort(-scores[best], kind="stable")]

    def _shrink(self, unused: np.ndarray) -> None:
        """Once a quarter of the indexed documents are used up, their postings are taken out."""
        left = int(np.count_nonzero(unused))
        if 4 * left > 3 * self.indexed:
            return
        self.indexed = left
        keep = unused[self.posting_doc]
        self.posting_doc, self.posting_weight = self.posting_doc[keep], self.posting_weight[keep]
        self.posting = np.concatenate(([0], np.cumsum(keep)))[self.posting]


def pack_shard(docs: list[np.ndarray], idf: np.ndarray, mean_length: float, window: int = WINDOW) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) of all documents of a shard."""
    shard = Shard(docs, idf, mean_length)
    total = np.fromiter(map(len, docs), np.int64, len(docs))
    placed = np.zeros(len(docs), np.int64)
    unused = total > 0
    pieces, sequence, filled, pointer = [], 0, 0, 0

    def put(d: int, n: int) -> None:
        nonlocal filled
        pieces.append((d, int(placed[d]), int(n), sequence, filled))
        placed[d] += n
        filled += n
        unused[d] = placed[d] < total[d]

    while True:
        while pointer < len(docs) and not unused[pointer]:
            pointer += 1
        if pointer == len(docs):
            return pieces
        seed = pointer
        filled = 0
        put(seed, min(window, total[seed] - placed[seed]))
        if filled < window:
            for d in shard.neighbours(seed, unused):
                put(d, min(window - filled, total[d] - placed[d]))
                if filled == window:
                    break
            while filled < window:
                # Nothing that scores is left: the next unused documents follow.
                while pointer < len(docs) and not unused[pointer]:
                    pointer += 1
                if pointer == len(docs):
                    break
                put(pointer, min(window - filled, total[pointer] - placed[pointer]))
        sequence += 1


def pack(docs: DataFrame, tokenizer: str, end_id: int, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    Each whole text is encoded and ends with ``end_id``; null texts are empty. Each id of each row of ``docs`` lies in
    exactly one piece; sequences are at most ``window`` long, and only the last one of a task's shard can be shorter. Rows that
    repeat an id are packed one by one. An empty table gives an empty result. Other columns are left out.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = encoder(tokenizer)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in blocks([len(t or "") for t in texts], 1 << 21):
                flat, counts = known.encode(texts[a:b])
                n = counts + 1
                ends = np.cumsum(n)
                ids = np.full(int(ends[-1]), end_id, np.uint32)
                inside = np.ones(len(ids), bool)
                inside[ends - 1] = False
                ids[inside] = flat
                # The smallest hash among a document's pairs of neighbouring ids; none reaches into the next document.
                pairs = np.full(len(ids), np.iinfo(np.uint64).max, np.uint64)
                pairs[:-1] = mix(ids[:-1].astype(np.uint64) << np.uint64(32) | ids[1:])
                pairs[ends - 1] = np.iinfo(np.uint64).max
                near = (np.minimum.reduceat(pairs, ends - n) >> np.uint64(1)).astype(np.int64)
                width = 2 if known.vocabulary <= 1 << 16 else 4
                short = ids.astype(f"<u{width}")
                edges = pa.array(np.append(0, width * ends), pa.int32())
                blobs = pa.BinaryArray.from_buffers(pa.binary(), len(n), [None, edges.buffers()[1], pa.py_buffer(short.tobytes())])
                # How many documents hold each id goes along with the first of them, for all of these.
                held = np.zeros(int(short.max()) + 1, np.int64)
                latest, places = np.zeros(len(held), np.int32), np.arange(int(n.max()), dtype=np.int32)
                for x, y in zip((ends - n).tolist(), ends.tolist()):
                    # Each id counts where it stands last.
                    one, place = short[x:y], places[: y - x]
                    latest[one] = place
                    held[one[latest[one] == place]] += 1
                at = np.flatnonzero(held)
                holds = pa.array([np.concatenate((at, held[at])).astype("<i8").tobytes(), *[None] * (len(n) - 1)], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(n), pa.array(near), blobs, holds], names=["id", "n", "near", "ids", "holds"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    encoded, seen = measured_write(rows.mapInArrow(encode, "id long, n long, near long, ids binary, holds binary"), "encoded", rows=F.count(F.lit(1)), tokens=F.sum("n"))
    if not seen["rows"]:
        return docs.sparkSession.createDataFrame([], PIECES)

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(1, np.int64)
        for batch in batches:
            for blob in batch.column(0):
                at, held = np.frombuffer(blob.as_buffer(), "<i8").reshape(2, -1)
                if at[-1] >= len(sums):
                    sums = np.concatenate((sums, np.zeros(int(at[-1]) + 1 - len(sums), np.int64)))
                sums[at] += held
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(sums[at], pa.int64())], names=["id", "df"])

    # At most one row per vocabulary entry comes back.
    holding = encoded.select("holds").where(F.col("holds").isNotNull())
    known = holding.mapInArrow(frequencies, "id long, df long").groupBy("id").agg(F.sum("df").alias("df")).toPandas()
    df = np.zeros(int(known["id"].max()) + 1)
    df[known["id"].to_numpy()] = known["df"]
    model = docs.sparkSession.sparkContext.broadcast((np.log1p((seen["rows"] - df + 0.5) / (df + 0.5)), seen["tokens"] / seen["rows"]))

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        idf, mean_length = model.value
        sequence = TaskContext.get().partitionId() << 40
        ids: list[int | None] = []
        texts: list[np.ndarray] = []
        tokens = 0

        def finish() -> pa.RecordBatch:
            nonlocal ids, texts, tokens, sequence
            out = []
            for d, start, length, number, offset in pack_shard(texts, idf, mean_length, window):
                piece = texts[d][start : start + length].astype("<u4").tobytes()
                out.append((ids[d], start, length, zlib.crc32(piece), len(texts[d]), sequence + number, offset))
            sequence = out[-1][5] + 1
            ids, texts, tokens = [], [], 0
            return pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in zip(*out)], schema=_SCHEMA)

        for batch in batches:
            for i, n, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                blob = blob.as_buffer()
                ids.append(i)
                texts.append(np.frombuffer(blob, f"<u{blob.size // n}"))
                tokens += n
                if len(texts) == SHARD_DOCS or tokens >= SHARD_TOKENS:
                    yield finish()
        if texts:
            yield finish()

    parts = -(-seen["tokens"] // (4 * SHARD_TOKENS))
    dealt = encoded.repartitionByRange(parts, "near", "id", "n").sortWithinPartitions("near", "id", "n", "ids")
    return dealt.select("id", "n", "ids").mapInArrow(fill, PIECES)
