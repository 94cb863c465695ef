"""Substring dedup by repeated-phrase automata: passages that an earlier document holds are cut out.

A window is a run of ``n`` words. Three steps, each over whole texts:

1. Every window names an anchor, the smallest hash among its shorter word runs; equal windows name equal
   anchors. The corpus answers which anchors stand in two documents or more.
2. Only windows with such an anchor ask again, by their own hash: does a smaller document hold the window?
   This confirms the passages that recur.
3. The confirmed windows of each block of documents are compiled into Aho-Corasick automata over word numbers, a bounded
   number of patterns each, and the documents are streamed through them to find every occurrence, word for word.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qaspark.llm import batches as B
from qaspark.llm.words import Words, grams_of
from qaspark.session import write_through

N = 13
#: Words in an automaton's block of documents; a longer document is a block of its own.
BLOCK_WORDS = 60_000
RESULT = "doc_id long, n_words long, n_removed long, text string"
_ALWAYS = -(2**63)


class _Windows:
    """Windows of the documents of a batch: place of the first word, document, anchor and own hash."""

    def __init__(self, ids: list[int | None], texts: list[bytes | None], n: int):
        self.words = Words([None if i is None else t for i, t in zip(ids, texts)])
        hashes, offsets = self.words.hashes(), self.words.offsets
        short = n // 2 + 2 if n > 3 else n
        self.own, self.at = grams_of(hashes, offsets, n)
        inner, where = grams_of(hashes, offsets, short)
        line = np.full(len(hashes) + n, np.iinfo(np.uint64).max, np.uint64)
        line[where] = inner
        anchor = line[self.at].copy()
        for k in range(1, n - short + 1):
            np.minimum(anchor, line[self.at + k], out=anchor)
        self.anchor = anchor
        number = np.array([_ALWAYS if i is None else i for i in ids], np.int64)
        self.doc = np.repeat(number, self.words.n_words)[self.at]


def _least(keys: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct keys, the smallest document of each, and whether it stands in another one too."""
    order = np.argsort(keys, kind="stable")
    keys, docs = keys[order], docs[order]
    begin = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.empty(0, np.int64)
    if not len(keys):
        return keys, docs, np.empty(0, bool)
    low, high = np.minimum.reduceat(docs, begin), np.maximum.reduceat(docs, begin)
    return keys[begin], low, low != high


def _anchors(w: _Windows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    new = np.concatenate(([True], (w.anchor[1:] != w.anchor[:-1]) | (w.doc[1:] != w.doc[:-1]))) if len(w.anchor) else np.empty(0, bool)
    return _least(w.anchor[new], w.doc[new])


def _candidates(w: _Windows, kinds: dict[str, list[bytes]], bits: int) -> np.ndarray:
    """Which windows have an anchor that recurs."""
    keys = _anchors(w)[0]
    recurs = B.bits_of(kinds.get("anchor", []), B.lengths_of(keys, bits))
    return recurs[np.searchsorted(keys, w.anchor)] if len(keys) else np.empty(0, bool)


def _locate(words: np.ndarray, offsets: np.ndarray, docs: list[int | None], at: np.ndarray, keys: np.ndarray, floors: list[int], n: int) -> np.ndarray:
    """Mark the words to remove: every occurrence of a window in a document above its floor.

    ``at`` are the places of the confirmed windows, ``keys`` their numbers, ``floors`` the floor of each number.
    """
    gone = np.zeros(len(words), bool)
    if not len(at):
        return gone
    hit = np.searchsorted(at, offsets)
    busy = np.flatnonzero(hit[1:] > hit[:-1])
    numbers = words.tolist()
    begin = 0
    while begin < len(busy):
        end, size = begin, 0
        while end < len(busy) and (end == begin or size + offsets[busy[end] + 1] - offsets[busy[end]] <= BLOCK_WORDS):
            size += offsets[busy[end] + 1] - offsets[busy[end]]
            end += 1
        automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
        mine = slice(hit[busy[begin]], hit[busy[end - 1] + 1])
        _, first = np.unique(keys[mine], return_index=True)
        for place, key in zip(at[mine][first].tolist(), keys[mine][first].tolist()):
            automaton.add_word(tuple(numbers[place : place + n]), key)
        automaton.make_automaton()
        for d in busy[begin:end]:
            a, b = int(offsets[d]), int(offsets[d + 1])
            for last, key in automaton.iter(tuple(numbers[a:b])):
                if docs[d] > floors[key]:
                    gone[a + last - n + 1 : a + last + 1] = True
        begin = end
    return gone


def remove_passages(docs: DataFrame, n: int = N, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, n_removed, text`` for every row; ``text`` is the words that stay, joined by one blank.

    A word goes if a window of ``n`` words of its document covers it whose words also stand, as a window, in a document
    with a smaller id. Windows are judged on the input. Null and blank texts have no words. Rows that share an id are
    one document in this respect: none of them is smaller. A row with a null id stays whole and takes no part.
    Other columns are left out; an empty table gives an empty result.
    """
    packed, size = B.pack_batches(docs, id_col, text_col)
    bits = B.bucket_bits(size // 20)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                keys, _, several = _anchors(_Windows(*B.unpack(blob.as_buffer()), n))
                yield B.question_batch(list(B.question(number, keys, several.astype(np.int64), bits)))

    def recurring(order, begins, run, numbers) -> np.ndarray:
        batches_with = np.diff(np.append(begins, len(order)))
        return ((batches_with > 1) | (np.add.reduceat(numbers[order], begins) > 0))[run]

    def pack(x: np.ndarray) -> bytes:
        return np.packbits(x).tobytes()

    anchors = B.answers(packed.mapInArrow(ask, B.QUESTION), recurring, pack).withColumn("kind", F.lit("anchor"))
    anchors = write_through(anchors, "anchor-answers")

    def ask_again(number, ids, texts, kinds) -> pa.Table:
        w = _Windows(ids, texts, n)
        some = _candidates(w, kinds, bits)
        keys, low, _ = _least(w.own[some], w.doc[some])
        return pa.Table.from_batches([B.question_batch(list(B.question(number, keys, low, bits)))])

    def smaller(order, begins, run, numbers) -> np.ndarray:
        return np.minimum.reduceat(numbers[order], begins)[run] < numbers

    asked = B.answered(packed, anchors, ask_again, B.QUESTION)
    windows = B.answers(asked, smaller, pack).withColumn("kind", F.lit("window"))

    def cut(number, ids, texts, kinds) -> pa.Table:
        w = _Windows(ids, texts, n)
        some = np.flatnonzero(_candidates(w, kinds, bits))
        keys, low, several = _least(w.own[some], w.doc[some])
        elsewhere = B.bits_of(kinds.get("window", []), B.lengths_of(keys, bits))
        place = np.searchsorted(keys, w.own[some])
        floors = np.where(elsewhere, _ALWAYS, low).tolist()
        used = (elsewhere | several)[place] if len(keys) else np.empty(0, bool)
        hashes = np.unique(w.words.hashes(), return_inverse=True)[1] if used.any() else np.empty(0, np.int64)
        gone = _locate(hashes, w.words.offsets, ids, w.at[some][used], place[used], floors, n)
        out = []
        for k, (doc, text) in enumerate(zip(ids, texts)):
            words = (text or b"").split()
            a, b = w.words.offsets[k], w.words.offsets[k + 1]
            mask = gone[a:b] if len(gone) and doc is not None else np.empty(0, bool)
            removed = int(mask.sum())
            kept = [x for x, g in zip(words, mask.tolist()) if not g] if removed else words
            out.append((doc, len(words), removed, b" ".join(kept).decode()))
        return pa.table([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int64(), pa.string()))], names=["doc_id", "n_words", "n_removed", "text"])

    return B.answered(packed, anchors.unionByName(windows), cut, RESULT)
