"""Questions that every batch of documents puts to the whole corpus, and the answers it gets back.

Documents are packed into batches of a few megabytes, written once. A batch sends the distinct 64-bit keys of its
documents, with a number each, to buckets of the key range; a bucket sees the keys of all batches, answers
each batch in the order of its keys, and the answers meet their batch again. A key that stands on a third of
all rows is still one key per batch. Only keys travel, never one row per word; a bucket and a batch have a bounded size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qaspark.session import measured_write

BATCH_BYTES = 4 << 20
KEYS_PER_BUCKET = 1 << 20
QUESTION = "bucket int, batch long, keys binary, numbers binary"
ANSWER = "batch long, bucket int, answer binary"


def pack_batches(docs: DataFrame, id_col: str, text_col: str, id_type: str = "long", limit: int = BATCH_BYTES) -> tuple[DataFrame, int]:
    """``batch, blob`` rows of about ``limit`` bytes of whole texts, written to the shared folder, and the bytes of all texts."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, ids, texts, size = TaskContext.get().partitionId() << 32, [], [], 0

        def finish() -> pa.RecordBatch:
            table = pa.record_batch({"id": pa.array(ids, pa.string() if id_type == "string" else pa.int64()), "text": pa.array(texts, pa.large_binary())})
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, table.schema) as out:
                out.write_batch(table)
            blob = zstandard.ZstdCompressor(level=3).compress(sink.getvalue())
            return pa.RecordBatch.from_arrays([pa.array([number]), pa.array([size]), pa.array([blob], pa.binary())], names=["batch", "bytes", "blob"])

        for batch in batches:
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.large_binary()).to_pylist()):
                ids.append(i)
                texts.append(t)
                size += len(t or b"") + 16
                if size >= limit:
                    yield finish()
                    number, ids, texts, size = number + 1, [], [], 0
        if ids:
            yield finish()

    rows = docs.select(F.col(id_col).cast(id_type).alias("id"), F.col(text_col).cast("string").alias("text"))
    packed, seen = measured_write(rows.mapInArrow(pack, "batch long, bytes long, blob binary"), "batches", bytes=F.coalesce(F.sum("bytes"), F.lit(0)))
    return packed.select("batch", "blob"), seen["bytes"]


def unpack(blob) -> tuple[list[int | None], list[bytes | None]]:
    batch = next(iter(pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(blob))))
    return batch.column(0).to_pylist(), batch.column(1).to_pylist()


def bucket_bits(n_keys: int) -> int:
    return max(2, int(np.ceil(np.log2(max(1, n_keys / KEYS_PER_BUCKET)))))


def question(batch: int, keys: np.ndarray, numbers: np.ndarray, bits: int) -> Iterator[dict]:
    """Rows that ask about sorted distinct ``keys``, one per bucket in use."""
    cuts = np.searchsorted(keys, np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits))
    for bucket, (a, b) in enumerate(zip(np.append(0, cuts), np.append(cuts, len(keys)))):
        if b > a:
            yield {"bucket": bucket, "batch": batch, "keys": keys[a:b].tobytes(), "numbers": squeeze(numbers[a:b])}


def squeeze(numbers: np.ndarray) -> bytes:
    """Whole numbers as compressed bytes, low bytes of all first."""
    wide = np.ascontiguousarray(numbers, "<i8").view(np.uint8).reshape(-1, 8).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(wide).tobytes())


def spread(blob) -> np.ndarray:
    wide = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(wide.T).view("<i8").ravel()


_QUESTION = pa.schema([("bucket", pa.int32()), ("batch", pa.int64()), ("keys", pa.binary()), ("numbers", pa.binary())])


def question_batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=_QUESTION)


def merged(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All keys of a bucket in sorted order: (places that sort them, begins of equal keys, run of each place, numbers)."""
    keys = np.concatenate([np.frombuffer(k.as_buffer(), np.uint64) for k in table.column("keys")])
    numbers = np.concatenate([spread(x.as_buffer()) for x in table.column("numbers")])
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    begins = np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1])))
    run = np.empty(len(keys), np.int64)
    run[order] = np.repeat(np.arange(len(begins)), np.diff(np.append(begins, len(keys))))
    return order, begins, run, numbers


def answers(questions: DataFrame, decide: Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], np.ndarray], encode: Callable[[np.ndarray], bytes]) -> DataFrame:
    """``decide`` gives one answer per key of a bucket (arguments as from ``merged``); each batch gets those of its own keys."""

    def reply(table: pa.Table) -> pa.Table:
        found = decide(*merged(table))
        ends = np.cumsum([len(k.as_buffer()) // 8 for k in table.column("keys")])
        parts = [encode(x) for x in np.split(found, ends[:-1])]
        return pa.table({"batch": table.column("batch"), "bucket": table.column("bucket").cast(pa.int32()), "answer": pa.array(parts, pa.binary())})

    return questions.groupBy("bucket").applyInArrow(reply, ANSWER)


def answered(packed: DataFrame, replies: DataFrame, work: Callable[[int, list, list, dict[str, list[bytes]]], pa.Table], schema: str) -> DataFrame:
    """Each batch with its answers (``kind, batch, bucket, answer``): ``work(batch, ids, texts, {kind: answers in key order})``."""

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = sorted(zip(right.column("kind").to_pylist(), right.column("bucket").to_pylist(), right.column("answer").to_pylist()))
        kinds: dict[str, list[bytes]] = {}
        for kind, _, answer in rows:
            kinds.setdefault(kind, []).append(answer)
        ids, texts = unpack(left.column("blob")[0].as_buffer())
        return work(left.column("batch")[0].as_py(), ids, texts, kinds)

    return packed.groupBy("batch").cogroup(replies.select("kind", "batch", "bucket", "answer").groupBy("batch")).applyInArrow(meet, schema)


def bits_of(parts: list[bytes], lengths: list[int]) -> np.ndarray:
    """Packed booleans of several answers, ``lengths`` many each."""
    return np.concatenate([np.unpackbits(np.frombuffer(p, np.uint8), count=n) for p, n in zip(parts, lengths)]).astype(bool) if parts else np.empty(0, bool)


def lengths_of(keys: np.ndarray, bits: int) -> list[int]:
    """How many of the sorted ``keys`` lie in each bucket in use."""
    cuts = np.searchsorted(keys, np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits))
    n = np.diff(np.concatenate(([0], cuts, [len(keys)])))
    return n[n > 0].tolist()
