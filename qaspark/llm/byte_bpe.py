"""Byte-level BPE by prefix dynamic programming: every prefix of a piece has one valid last token.

An encoding is the one that merging by rank gives if and only if each of its neighbouring pairs is. So the last
token of a prefix is the only token that ends there and may follow the last token of the prefix it leaves. One pass over the
bytes stores that token for every prefix. A piece that grows keeps its table and continues it; after an edit the table
is computed again only until it agrees with the old one for as many bytes as the longest token has. Of many pieces in
sorted order each continues the table of the one before from where they differ.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator
from itertools import chain, islice

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: What a worker remembers of pieces (characters at most 64 each) and of token pairs before it starts anew.
MOST_PIECES = 1_000_000
MOST_PAIRS = 2_000_000
_LONGEST_KNOWN = 64
_PIECES_AT_ONCE = 1 << 16
#: Characters of texts whose new pieces are learned together, and the most bytes of a piece whose table holds the ids of every prefix.
_BLOCK_CHARS = 1 << 20
_SHORT = 32
RESULT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
_SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])
_vocabularies: dict[str, Vocabulary] = {}
_encoders: dict[tuple[str, str], ByteEncoder] = {}


def read_ranks(path: str) -> dict[bytes, int]:
    """The ranks of a file with one base64 token and its rank a line."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


def vocabulary(path: str) -> Vocabulary:
    """The worker's vocabulary of a rank file."""
    if path not in _vocabularies:
        _vocabularies[path] = Vocabulary(read_ranks(path))
    return _vocabularies[path]


def byte_encoder(path: str, pattern: str) -> ByteEncoder:
    """The worker's encoder, which remembers pieces from one task to the next."""
    if (path, pattern) not in _encoders:
        _encoders[path, pattern] = ByteEncoder(vocabulary(path), pattern)
    return _encoders[path, pattern]


def merge_by_rank(ranks: dict[bytes, int], piece: bytes, below: int | None = None) -> list[bytes]:
    """The plain definition: join the neighbours of least rank (under ``below``), the leftmost first, until none can be joined."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        found = [(r, i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if (r := ranks.get(a + b)) is not None and (below is None or r < below)]
        if not found:
            break
        i = min(found)[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return parts


class Vocabulary:
    """Tokens by rank, what each was last merged from, and an automaton that finds the tokens ending at a byte.

    Ranks must be in merge order, as training gives them: a token that can be merged at all is merged from tokens of smaller rank.
    Others are refused. A token that no two tokens make up is kept for pieces equal to it.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of: dict[int, bytes] = {rank: token for token, rank in ranks.items()}
        self.longest = max(map(len, ranks), default=1)
        self._halves: dict[int, tuple[int, int]] = {}
        self._follows: dict[int, bool] = {}
        self._coded = {rank: rank.to_bytes(4, "little") for rank in self.bytes_of}
        # The same tokens read backwards: the node after each node and byte, and the token that ends at each node.
        self._back: dict[int, int] = {}
        self._token_at = [-1]
        self._automaton = ahocorasick.Automaton()
        for token, rank in ranks.items():
            if len(token) > 1:
                halves = merge_by_rank(ranks, token, below=rank)
                if len(halves) != 2:
                    if any(token[:i] in ranks and token[i:] in ranks for i in range(1, len(token))):
                        raise ValueError(f"the token of rank {rank} is not merged from tokens of smaller rank")
                    continue
                self._halves[rank] = (ranks[halves[0]], ranks[halves[1]])
            self._add_backwards(token, rank)
            self._automaton.add_word(token.decode("latin-1"), (len(token), rank))
        self._automaton.make_automaton()
        self._all_bytes = all(bytes([i]) in ranks for i in range(256))

    def _add_backwards(self, token: bytes, rank: int) -> None:
        node = 0
        for byte in reversed(token):
            node = self._back.setdefault(node << 8 | byte, len(self._token_at))
            if node == len(self._token_at):
                self._token_at.append(-1)
        self._token_at[node] = rank

    def follows(self, left: int, right: int) -> bool:
        """Whether merging the bytes of both tokens gives just these two.

        Both are taken apart, the later merge first. Between two steps the halves at the border stood side by side; were
        their joint token of a smaller rank than the next merge, that merge would have come first.
        """
        key = left << 32 | right
        known = self._follows.get(key)
        if known is None:
            if len(self._follows) >= MOST_PAIRS:
                self._follows.clear()
            known = self._follows[key] = self._stay_apart(left, right)
        return known

    def _stay_apart(self, left: int, right: int) -> bool:
        ranks, bytes_of, halves = self.ranks, self.bytes_of, self._halves
        # Merges of one rank run from left to right: at equal rank the left token's merge is before the border's, the right one's after.
        before = (len(bytes_of) + max(left, right) + 1, 0)
        while True:
            joint = ranks.get(bytes_of[left] + bytes_of[right])
            if joint is not None and (joint, 1) < before:
                return False
            a, b = halves.get(left), halves.get(right)
            if a is None and b is None:
                return True
            if b is None or (a is not None and (left, 0) > (right, 2)):
                before, left = (left, 0), a[1]
            else:
                before, right = (right, 2), b[0]

    def extend(self, piece: bytes, last: array, stop=None) -> None:
        """Continue ``last`` (for every prefix but the empty one its last token) to all of ``piece``, or until ``stop(last)``."""
        begin = len(last)
        left = max(0, begin - self.longest + 1)
        follows, end_now, found = self.follows, begin, False
        for at, (size, token) in self._automaton.iter(piece[left:].decode("latin-1")):
            end = left + at + 1
            if end <= begin or (end == end_now and found):
                continue
            if end != end_now:
                if stop is not None and stop(last):
                    return
                end_now, found = end, False
            start = end - size
            if start >= 0 and (start == 0 or follows(last[start - 1], token)):
                last.append(token)
                found = True

    def read_back(self, piece: bytes, last: array) -> list[int]:
        """The tokens of ``piece`` from its table."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        out, end = [], len(piece)
        while end:
            token = last[end - 1]
            out.append(token)
            end -= len(self.bytes_of[token])
        return out[::-1]

    def encode_piece(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        last = array("I")
        self.extend(piece, last)
        return self.read_back(piece, last)

    def encode_pieces(self, pieces: list[bytes]) -> Iterator[bytes]:
        """The ids of each piece as little-endian unsigned 32-bit numbers; sorted pieces share the tables of their common beginnings."""
        ranks, coded, back, token_at, follows, pairs = self.ranks, self._coded, self._back, self._token_at, self.follows, self._follows
        # Beside the last token of every prefix its ids, as pieces are short.
        before, last, ids = b"", [], [b""]
        for piece in pieces:
            whole = ranks.get(piece)
            if whole is not None:
                yield coded[whole]
                continue
            if len(piece) > _SHORT or not self._all_bytes:
                yield np.array(self.encode_piece(piece), "<u4").tobytes()
                continue
            same = 0
            for a, b in zip(before, piece):
                if a != b:
                    break
                same += 1
            before = piece
            del last[same:], ids[same + 1 :]
            for end in range(same, len(piece)):
                node, ending = 0, []
                for start in range(end, -1, -1):
                    node = back.get(node << 8 | piece[start])
                    if node is None:
                        break
                    token = token_at[node]
                    if token >= 0:
                        ending.append((start, token))
                for start, token in reversed(ending):
                    if not start:
                        break
                    left = last[start - 1]
                    fits = pairs.get(left << 32 | token)
                    if fits or (fits is None and follows(left, token)):
                        break
                last.append(token)
                ids.append(ids[start] + coded[token])
            yield ids[-1]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


class OpenPiece:
    """A piece whose table stays: appends and edits compute only what changes."""

    def __init__(self, vocabulary: Vocabulary, piece: bytes = b""):
        self.vocabulary, self.piece, self.last, self.computed = vocabulary, b"", array("I"), 0
        self.append(piece)

    def append(self, more: bytes) -> None:
        self.piece += more
        self.vocabulary.extend(self.piece, self.last)
        self.computed += len(more)

    def replace(self, start: int, end: int, new: bytes) -> None:
        """Put ``new`` in the place of the bytes from ``start`` to ``end``."""
        old, shift = self.last, len(new) - (end - start)
        self.piece = self.piece[:start] + new + self.piece[end:]
        self.last = old[:start]
        edge, span = start + len(new), self.vocabulary.longest
        agree = 0

        def settled(last: array) -> bool:
            # Once every prefix a token can reach back to ends as it did, all later ones do.
            nonlocal agree
            if len(last) <= edge:
                return False
            agree = agree + 1 if last[-1] == old[len(last) - 1 - shift] else 0
            return agree >= span

        self.vocabulary.extend(self.piece, self.last, settled)
        self.computed += len(self.last) - start
        self.last.extend(old[len(self.last) - shift :])

    def ids(self) -> list[int]:
        return self.vocabulary.read_back(self.piece, self.last)


class ByteEncoder:
    """Whole texts to ids: each match of a pattern by itself, known pieces from memory."""

    def __init__(self, vocabulary: Vocabulary, pattern: str):
        self.vocabulary, self.pattern = vocabulary, regex.compile(pattern)
        self._known: dict[str, bytes] = {}

    def _ids(self, piece: str) -> bytes:
        return np.array(self.vocabulary.encode_piece(piece.encode("utf-8")), "<u4").tobytes()

    def _learn(self, pieces: set[str]) -> None:
        if len(self._known) + len(pieces) > MOST_PIECES:
            self._known = {}
        names = sorted(pieces)
        self._known.update(zip(names, self.vocabulary.encode_pieces([p.encode("utf-8") for p in names])))

    def learn(self, texts: list[str]) -> list[list[str]]:
        """Learn the new pieces of several texts together; returns the pieces of each."""
        cut = [self.pattern.findall(t) for t in texts]
        new = self._new(cut)
        if len(self._known) + len(new) > MOST_PIECES:
            self._known = {}
            new = self._new(cut)
        self._learn(new)
        return cut

    def _new(self, cut: list[list[str]]) -> set[str]:
        known = self._known
        return {p for pieces in cut for p in pieces if p not in known and len(p) <= _LONGEST_KNOWN}

    def stream(self, text: str) -> Iterator[bytes]:
        """The ids as little-endian unsigned 32-bit numbers, a bounded number of pieces at a time."""
        if len(text) <= 4 * _PIECES_AT_ONCE:
            yield self._encode(self.pattern.findall(text))
        else:
            found = (m.group() for m in self.pattern.finditer(text))
            while some := list(islice(found, _PIECES_AT_ONCE)):
                yield self._encode(some)

    def streams(self, texts: list[str]) -> Iterator[Iterator[bytes]]:
        """``stream`` of each text; the new pieces of all but long texts are learned together."""
        cut = iter(self.learn([t for t in texts if len(t) <= 4 * _PIECES_AT_ONCE]))
        for text in texts:
            yield self.stream(text) if len(text) > 4 * _PIECES_AT_ONCE else iter((self._encode(next(cut)),))

    def _encode(self, pieces: list[str]) -> bytes:
        try:
            return b"".join(map(self._known.__getitem__, pieces))
        except KeyError:
            self._learn(self._new([pieces]))
            return b"".join(self._known[p] if p in self._known else self._ids(p) for p in pieces)

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(b"".join(self.stream(text)), "<u4").tolist()


class OpenText:
    """A text with its pieces: an edit splits and encodes anew only around itself.

    The pattern may look ahead by at most two characters past a match, and never back (true of ``PATTERN``).
    """

    def __init__(self, encoder: ByteEncoder, text: str = ""):
        self.encoder, self.text, self.ends, self.parts, self.encoded = encoder, "", [], [], 0
        self.replace(0, 0, text)

    def append(self, more: str) -> None:
        self.replace(len(self.text), len(self.text), more)

    def replace(self, start: int, end: int, new: str) -> None:
        """Put ``new`` in the place of the characters from ``start`` to ``end``."""
        self.text = self.text[:start] + new + self.text[end:]
        shift = len(new) - (end - start)
        ends = np.array(self.ends, np.int64)
        kept = int(np.searchsorted(ends, start - 2, "right"))
        place = self.ends[kept - 1] if kept else 0
        later = {e + shift: i for i, e in enumerate(self.ends) if e >= end}
        new_ends, new_parts, rest = [], [], len(self.ends)
        for m in self.encoder.pattern.finditer(self.text, place):
            new_ends.append(m.end())
            new_parts.append(self.encoder.vocabulary.encode_piece(m.group().encode("utf-8")))
            if m.end() >= start + len(new) and m.end() in later:
                rest = later[m.end()] + 1
                break
        self.encoded += len(new_parts)
        self.ends = self.ends[:kept] + new_ends + [e + shift for e in self.ends[rest:]]
        self.parts = self.parts[:kept] + new_parts + self.parts[rest:]

    def ids(self) -> list[int]:
        return list(chain.from_iterable(self.parts))


def _blocks(column: pa.Array) -> Iterator[list[str]]:
    """The texts in runs of about ``_BLOCK_CHARS``; null is empty."""
    some, chars = [], 0
    for text in column:
        some.append(text.as_py() or "")
        chars += len(some[-1])
        if chars >= _BLOCK_CHARS:
            yield some
            some, chars = [], 0
    if some:
        yield some


def encode_texts(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: every whole text encoded, and the hash of what its ids decode to.

    One row per input row, repeated and null ids included; a null text is empty; other columns are left out. ``path`` is a rank
    file that every executor can read. Rows stay where they are; a worker holds one batch, its vocabulary and at most
    ``MOST_PIECES`` known pieces, which it keeps for its next task.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = byte_encoder(path, pattern)
        decode = encoder.vocabulary.decode
        for batch in batches:
            counts, hashes, decoded = [], [], []
            for some in _blocks(batch.column(1)):
                for stream in encoder.streams(some):
                    n, ids_hash, bytes_hash = 0, hashlib.sha256(), hashlib.sha256()
                    for ids in stream:
                        n += len(ids) // 4
                        ids_hash.update(ids)
                        bytes_hash.update(decode(np.frombuffer(ids, "<u4").tolist()))
                    counts.append(n)
                    hashes.append(ids_hash.hexdigest())
                    decoded.append(bytes_hash.hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(hashes), pa.array(decoded)], schema=_SCHEMA)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(work, RESULT)
