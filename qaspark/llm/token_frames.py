"""Token ids in files of independent zstandard frames with a trailing seek table.

A file holds one frame per document (its ids as little-endian unsigned integers), then a skippable frame with the
documents' ids and the width of an id, then the seek table in the public seekable layout: for each frame its
compressed size, its size and a checksum (the low half of XXH64 of its content), then the number of frames, a flag
byte and a magic number. A reader fetches the tail, and then only the frames of the documents it wants.

Files are written by tasks under names of their own, so a repeated task never touches another's file; the table of
files, written by Spark after them, names the ones that count.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from qaspark.llm.tokens import encoder
from qaspark.llm.words import blocks
from qaspark.session import checkpoint_folder, write_through

INDEX_MAGIC = 0x184D2A50
TABLE_MAGIC = 0x184D2A5E
END_MAGIC = 0x8F92EAB1
FILE_BYTES = 128 << 20
_NO_ID = -(2**63)


def open_folder(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a shared folder given as URI or local path."""
    if uri.startswith("file:") or "://" not in uri:
        return pafs.LocalFileSystem(), urlparse(uri).path
    return pafs.FileSystem.from_uri(uri)


class FrameWriter:
    """Writes one file; ``close`` adds the index and the seek table."""

    def __init__(self, out, width: int = 4, level: int = 3):
        self.out, self.width = out, width
        self.compress = zstandard.ZstdCompressor(level=level, write_content_size=True).compress
        self.entries: list[bytes] = []
        self.ids: list[int] = []
        self.bytes = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        content = ids.astype(f"<u{self.width}").tobytes()
        frame = self.compress(content)
        self.out.write(frame)
        self.bytes += len(frame)
        self.entries.append(struct.pack("<III", len(frame), len(content), xxhash.xxh64_intdigest(content) & 0xFFFFFFFF))
        self.ids.append(_NO_ID if doc_id is None else doc_id)

    def close(self) -> None:
        index = struct.pack("<B", self.width) + np.array(self.ids, "<i8").tobytes()
        self.out.write(struct.pack("<II", INDEX_MAGIC, len(index)) + index)
        self.entries.append(struct.pack("<III", len(index) + 8, 0, xxhash.xxh64_intdigest(b"") & 0xFFFFFFFF))
        table = b"".join(self.entries) + struct.pack("<IBI", len(self.entries), 0x80, END_MAGIC)
        self.out.write(struct.pack("<II", TABLE_MAGIC, len(table)) + table)
        self.out.close()


class FrameReader:
    """Random access to one file; ``source`` supports seek, read and size."""

    def __init__(self, source):
        self.source = source
        size = source.size()
        n, flags, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != END_MAGIC or not flags & 0x80:
            raise ValueError("no seek table with checksums at the end of the file")
        start = size - 9 - 12 * n
        self.table = np.frombuffer(self._at(start, 12 * n), "<u4").reshape(n, 3).astype(np.int64)
        self.begin = np.concatenate(([0], np.cumsum(self.table[:, 0])))
        index = self._at(int(self.begin[n - 1]) + 8, int(self.table[n - 1, 0]) - 8)
        self.width = index[0]
        self.ids = np.frombuffer(index, "<i8", offset=1)

    def _at(self, place: int, n: int) -> bytes:
        self.source.seek(place)
        return self.source.read(n)

    def frame(self, i: int) -> np.ndarray:
        """The ids of the i-th document, checked."""
        return self._content(i, self._at(int(self.begin[i]), int(self.table[i, 0])))

    def _content(self, i: int, frame: bytes) -> np.ndarray:
        content = zstandard.ZstdDecompressor().decompress(frame, max_output_size=int(self.table[i, 1]))
        if len(content) != self.table[i, 1] or xxhash.xxh64_intdigest(content) & 0xFFFFFFFF != self.table[i, 2]:
            raise ValueError(f"frame {i} is damaged")
        return np.frombuffer(content, f"<u{self.width}").astype(np.uint32)

    def documents(self, wanted: Iterable[int] | None = None) -> Iterator[tuple[int | None, np.ndarray]]:
        """(doc_id, ids) of the wanted documents, or of all; other frames are not read."""
        for i in range(len(self.ids)) if wanted is None else np.flatnonzero(np.isin(self.ids, list(wanted))):
            doc = int(self.ids[i])
            yield (None if doc == _NO_ID else doc), self.frame(int(i))


def write_tokens(docs: DataFrame, tokenizer: str, end_id: int, folder: str | None = None, id_col: str = "doc_id", text_col: str = "text", level: int = 3) -> DataFrame:
    """Encode every whole text, append ``end_id`` and write the ids in ascending order of the documents' ids.

    Returns the table of files, ``file, part, number, first_id, last_id, n_docs, n_tokens``, in (part, number) order. Null texts
    are empty; a null id comes first; rows with one id are written one by one in order of their text. An
    empty table writes no file. Other columns are not written. ``folder`` must be shared by all executors.
    """
    target = (folder or checkpoint_folder(docs.sparkSession)).rstrip("/") + f"/tokens-{uuid.uuid4().hex}"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = open_folder(target)
        files.create_dir(path, recursive=True)
        known = encoder(tokenizer)
        width = 2 if max(known.vocabulary, end_id + 1) <= 1 << 16 else 4
        part = TaskContext.get().partitionId()
        writer, rows, tokens = None, [], 0

        def finish():
            nonlocal writer, tokens
            writer.close()
            ids = [i for i in (writer.ids[0], writer.ids[-1])]
            rows.append((name, part, len(rows), *[None if i == _NO_ID else i for i in ids], len(writer.ids), tokens))
            writer, tokens = None, 0

        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in blocks([len(t or "") for t in texts], 1 << 21):
                flat, counts = known.encode(texts[a:b])
                for doc, piece in zip(ids[a:b], np.split(flat, np.cumsum(counts)[:-1])):
                    if writer is None:
                        name = f"{target}/{part:06d}-{len(rows):04d}-{uuid.uuid4().hex}.tok.zst"
                        writer = FrameWriter(files.open_output_stream(open_folder(name)[1], compression=None), width, level)
                    writer.add(doc, np.append(piece, np.uint32(end_id)))
                    tokens += len(piece) + 1
                    if writer.bytes >= FILE_BYTES:
                        finish()
        if writer is not None:
            finish()
        yield pa.RecordBatch.from_pylist([dict(zip(_FILES.names, r)) for r in rows], schema=_FILES)

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    ordered = rows.repartitionByRange("id").sortWithinPartitions("id", "text")
    return write_through(ordered.mapInArrow(write, "file string, part int, number int, first_id long, last_id long, n_docs long, n_tokens long"), "token-files")


_FILES = pa.schema([("file", pa.string()), ("part", pa.int32()), ("number", pa.int32()), ("first_id", pa.int64()), ("last_id", pa.int64()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())])


def read_tokens(files: DataFrame, wanted: list[int] | None = None) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32, ids`` of the wanted documents, or of all, decoded from the files.

    ``start`` counts the ids of all documents before it, over all files. A short list ``wanted`` selects files by their
    first and last id and frames by the files' own index; nothing else is decompressed.
    """
    order = Window.orderBy("part", "number")  # one row per file
    placed = files.withColumn("before", F.sum("n_tokens").over(order) - F.col("n_tokens")).withColumn("place", F.row_number().over(order))
    if wanted is not None:
        low, high = F.coalesce("first_id", F.lit(_NO_ID)), F.coalesce("last_id", F.lit(_NO_ID))
        asked = F.array(*[F.lit(w).cast("long") for w in wanted]).cast("array<long>")
        placed = placed.where(F.exists(asked, lambda w: w.between(low, high)))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, before in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                files, path = open_folder(name)
                with files.open_input_file(path) as source:
                    reader = FrameReader(source)
                    sizes = reader.table[: len(reader.ids), 1] // reader.width
                    starts = before + np.cumsum(sizes) - sizes
                    chosen = np.arange(len(sizes)) if wanted is None else np.flatnonzero(np.isin(reader.ids, wanted))
                    for a, b in blocks([int(sizes[i]) for i in chosen], 1 << 20):
                        some = chosen[a:b]
                        ids = [reader.frame(int(i)) for i in some]
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array([None if reader.ids[i] == _NO_ID else int(reader.ids[i]) for i in some], pa.int64()),
                                pa.array(starts[some], pa.int64()),
                                pa.array([len(x) for x in ids], pa.int64()),
                                pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in ids], pa.int64()),
                                pa.array([x.astype("<u4").tobytes() for x in ids], pa.binary()),
                            ],
                            names=["doc_id", "start", "n_tokens", "ids_crc32", "ids"],
                        )

    n = max(1, min(placed.count(), 100_000))
    return placed.repartition(n, "place").select("file", "before").mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long, ids binary")
