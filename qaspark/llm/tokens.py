"""Whole texts to token ids with a public tokenizer file, each distinct word encoded once per worker.

Both kinds of tokenizers known here cut a text at every single blank between two other characters before they
look for vocabulary entries, so the ids of a text are the ids of its blank-separated pieces in a row. Inside a piece of
plain letters, digits and marks they also cut wherever one of these kinds ends: such runs are found, told apart and
looked up in numpy for many texts at once. A worker remembers the ids of the runs and pieces it has met, up to a fixed
memory, the rarest going first; the tokenizers library encodes the new ones.
Texts with other white space around a blank, where that would not hold, are encoded as a whole.
"""

from __future__ import annotations

import gc
import json
import os
from itertools import chain, repeat

import numpy as np

from qaspark.llm.words import mix

MOST_PIECES = 1_000_000
MOST_CHARS = 24_000_000
_BLOCK_CHARS = 1 << 21
_TOGETHER = 2000
_MARK = "\x01"
_RUNS_AT_ONCE = 1000
#: Kinds of bytes: between texts, blank, line end, letter, digit, mark, and what only the library cuts up.
_EDGE, _BLANK, _LINE, _LETTER, _DIGIT, _OTHER, _ODD = range(7)
#: A run of up to so many bytes is its own key, as two numbers.
_KEY_BYTES = 16
_KEY_MASKS = np.array([(1 << 8 * min(k, 8)) - 1 for k in range(_KEY_BYTES + 1)], np.uint64)
_WORDS_AND_MARKS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_encoders: dict[str, Encoder] = {}


def forget() -> None:
    """Free what this worker remembers, before work of another kind."""
    _encoders.clear()


def encoder(path: str) -> Encoder:
    """The worker's encoder of a tokenizer file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


class Encoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            config = json.load(f)
        self.mode = _mode(config)
        self.vocabulary = self.tokenizer.get_vocab_size(with_added_tokens=True)
        # How to tell pieces apart in the ids of many pieces at once: by ids that begin with a blank, or by a mark between them.
        self._begins = np.zeros(self.vocabulary, bool)
        if self.mode == "kept":
            blank = self.tokenizer.id_to_token(self.tokenizer.encode(" ", add_special_tokens=False).ids[0])
            self._begins[[i for token, i in self.tokenizer.get_vocab(with_added_tokens=False).items() if token.startswith(blank)]] = True
        elif self.mode == "dropped":
            mark = self.tokenizer.encode(_MARK, add_special_tokens=False).ids
            self._begins[mark] = len(mark) == 1
        self._runs = _run_model(config, self.mode)
        self._kinds = _kinds(self.mode, self._runs is not None)
        self._clear()

    def _clear(self) -> None:
        self._known: tuple[dict[str, int], dict[str, int]] = ({}, {})
        self._run_keys, self._run_numbers = np.empty(0, np.uint64), np.empty(0, np.int64)
        self._starts, self._lengths, self._ids = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int32), np.zeros(1 << 18, np.uint32)
        self._odd, self._uses = np.zeros(1 << 16, bool), np.zeros(1 << 16, np.int64)
        self._low, self._high = np.zeros(1 << 16, np.uint64), np.zeros(1 << 16, np.uint64)
        self._pieces = self._end = self._chars = 0

    def _shrink(self) -> None:
        """Forget the pieces used least, so that at most half of the room is taken."""
        uses = self._uses[: self._pieces]
        least = 2
        while np.count_nonzero(uses >= least) > MOST_PIECES // 2:
            least *= 2
        kept = np.flatnonzero(uses >= least)
        known = [{p: i for p, i in d.items() if uses[i] >= least and len(p) <= 64} for d in self._known]
        often = uses[self._run_numbers] >= least
        run_keys, run_numbers = self._run_keys[often], self._run_numbers[often]
        lengths = self._lengths[kept].astype(np.int64)
        ahead = np.cumsum(lengths) - lengths
        ids = self._ids[np.repeat(self._starts[kept] - ahead, lengths) + np.arange(lengths.sum())]
        odd, low, high = self._odd[kept], self._low[kept], self._high[kept]
        place = np.zeros(len(uses), np.int64)
        place[kept] = np.arange(len(kept))
        self._clear()
        self._add_ids(ids, lengths)
        self._odd[: len(kept)], self._low[: len(kept)], self._high[: len(kept)] = odd, low, high
        self._known = tuple({p: int(place[i]) for p, i in d.items()} for d in known)
        self._run_keys, self._run_numbers = run_keys, place[run_numbers]
        self._chars = sum(len(p) for d in self._known for p in d)

    def _add(self, encodings: list[list[int]], odd: list[bool]) -> int:
        """Append entries and return the number of the first."""
        lengths = np.fromiter(map(len, encodings), np.int64, len(encodings))
        first = self._add_ids(np.fromiter(chain.from_iterable(encodings), np.uint32, lengths.sum()), lengths)
        self._odd[first : first + len(odd)] = odd
        return first

    def _add_ids(self, ids: np.ndarray, lengths: np.ndarray) -> int:
        first, n, total = self._pieces, len(lengths), len(ids)
        while first + n > len(self._starts):
            grown = (np.concatenate((a, np.zeros_like(a))) for a in (self._starts, self._lengths, self._odd, self._uses, self._low, self._high))
            self._starts, self._lengths, self._odd, self._uses, self._low, self._high = grown
        while self._end + total > len(self._ids):
            self._ids = np.concatenate((self._ids, np.zeros_like(self._ids)))
        self._lengths[first : first + n] = lengths
        self._starts[first : first + n] = self._end + np.cumsum(lengths) - lengths
        self._ids[self._end : self._end + total] = ids
        self._odd[first : first + n] = False
        self._uses[first : first + n] = 0
        self._pieces, self._end = first + n, self._end + total
        return first

    def _learn(self, pieces: list[str], place: int) -> None:
        plain = [p for p in pieces if p and not p[0].isspace() and not p[-1].isspace() and "<|" not in p and _MARK not in p] if place else []
        for a in range(0, len(plain), _TOGETHER):
            self._learn_together(plain[a : a + _TOGETHER])
        known = self._known[place]
        rest = [p for p in pieces if p not in known]
        if rest:
            glue = " " if place and self.mode == "kept" else ""
            found = self.tokenizer.encode_batch_fast([glue + p for p in rest], add_special_tokens=False)
            odd = [self.mode == "kept" and (not p or p[0].isspace() or p[-1].isspace()) for p in rest]
            first = self._add([e.ids for e in found], odd)
            known.update(zip(rest, range(first, first + len(rest))))
        self._chars += sum(map(len, pieces))

    def _learn_together(self, pieces: list[str]) -> None:
        """One call for many pieces; their ids are told apart afterwards. Does nothing if that does not come out even."""
        text = " " + " ".join(pieces) if self.mode == "kept" else f"{_MARK} " + f" {_MARK} ".join(pieces)
        ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
        begins = self._begins[ids]
        at = np.flatnonzero(begins)
        if len(at) != len(pieces) or at[0] != 0:
            return
        lengths = np.diff(np.append(at, len(ids)))
        if self.mode == "dropped":
            ids, lengths = ids[~begins], lengths - 1
        first = self._add_ids(ids, lengths)
        self._known[1].update(zip(pieces, range(first, first + len(pieces))))

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids (uint32) one text after another, and the number of ids of each text."""
        # Nothing made here refers to itself; looking for that after every few new lists takes a tenth of the time.
        watching = gc.isenabled()
        gc.disable()
        try:
            return self._encode(texts)
        finally:
            if watching:
                gc.enable()

    def _encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        parts, i = [], 0
        counts = np.zeros(len(texts), np.int64)
        while i < len(texts):
            j, chars = i, 0
            while j < len(texts) and (j == i or chars + len(texts[j] or "") <= _BLOCK_CHARS):
                chars += len(texts[j] or "")
                j += 1
            ids, counts[i:j] = self._block([t or "" for t in texts[i:j]])
            parts.append(ids)
            i = j
        return (np.concatenate(parts) if parts else np.empty(0, np.uint32)), counts

    def _block(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if self.mode == "whole":
            found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
            counts = np.fromiter(map(len, found), np.int64, len(found))
            return np.fromiter(chain.from_iterable(found), np.uint32, counts.sum()), counts
        if self._pieces > MOST_PIECES or self._chars > MOST_CHARS:
            self._shrink()
        raw = [t.encode() for t in texts]
        edges = np.cumsum(np.fromiter(map(len, raw), np.int64, len(raw)) + 1)
        buffer = np.frombuffer(b"".join([b"\0", b"\0".join(raw), bytes(_KEY_BYTES + 8)]), np.uint8)
        edges = np.concatenate(([0], edges))
        plain, kind = self._kinds_of(buffer[: edges[-1] + 1], edges)
        starts, ends = self._cut(kind)
        codes = self._numbers(buffer, plain, kind, starts, ends)
        begin = np.searchsorted(starts, edges)
        if self.mode == "kept":
            codes, begin = self._whole(texts, kind, edges, codes, begin)
        used = np.bincount(codes)
        self._uses[: len(used)] += used
        lengths = self._lengths[codes].astype(np.int64)
        total = np.concatenate(([0], np.cumsum(lengths)))
        ids = self._ids[np.repeat(self._starts[codes] - total[:-1], lengths) + np.arange(total[-1])]
        return ids, np.diff(total[begin])

    def _kinds_of(self, buffer: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes as the vocabulary knows them and the kind of each; pieces with an odd byte are odd as a whole."""
        kind = self._kinds[buffer]
        high = np.flatnonzero(buffer >= 0x80)
        lead = high[buffer[high] == 0xC3]
        sign = lead[(buffer[lead + 1] == 0x97) | (buffer[lead + 1] == 0xB7)]  # the signs of multiplication and division
        kind[sign] = kind[sign + 1] = _ODD
        bar = np.flatnonzero(buffer == 0x7C)
        kind[bar[buffer[bar - 1] == 0x3C]] = _ODD  # where an added token may begin
        kind[edges] = _EDGE
        plain = buffer
        if self.mode == "dropped":
            plain = _LOWER[buffer]
            capital = lead[(buffer[lead + 1] >= 0x80) & (buffer[lead + 1] <= 0x9E)] + 1
            plain[capital] += 0x20
        else:
            # One line end, or two before something else, stand for themselves beside letters, digits and marks.
            line = np.flatnonzero(kind == _LINE)
            before, after = kind[line - 1], kind[line + 1]
            calm_before, calm_after = (((x >= _LETTER) & (x <= _OTHER)) | (x == _EDGE) for x in (before, after))
            alone = calm_before & calm_after
            first = calm_before & (after == _LINE)
            second = (before == _LINE) & calm_after & (after != _EDGE) & (buffer[line + 1] != 0x3C)
            pair = np.flatnonzero(first[:-1] & second[1:] & (line[1:] == line[:-1] + 1)) if len(line) else line
            alone[pair] = True
            alone[pair + 1] = True
            kind[line[~alone]] = _ODD
        odd = np.flatnonzero(kind == _ODD)
        if len(odd):
            between = np.flatnonzero(kind <= _LINE)
            piece = np.unique(np.searchsorted(between, odd))
            step = np.zeros(len(kind), np.int8)
            step[between[piece - 1] + 1] += 1
            step[between[piece]] -= 1
            kind[np.cumsum(step, dtype=np.int8) > 0] = _ODD
        return plain, kind

    def _cut(self, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where runs and odd pieces start and end; if blanks are kept, the one before belongs to them."""
        new = np.empty(len(kind), bool)
        new[0] = True
        np.not_equal(kind[1:], kind[:-1], out=new[1:])
        if self.mode == "dropped":
            new |= kind == _DIGIT
            at = np.flatnonzero(new)
            inside = kind[at[:-1]] >= _LETTER
        else:
            new[1:] &= kind[:-1] != _BLANK
            new |= kind <= _LINE
            at = np.flatnonzero(new)
            inside = kind[at[:-1]] != _EDGE
        return at[:-1][inside], at[1:][inside]

    def _numbers(self, buffer: np.ndarray, plain: np.ndarray, kind: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The number of the entry of each run or piece, after learning the new ones."""
        size = ends - starts
        easy = (kind[ends - 1] != _ODD) & (size <= _KEY_BYTES)
        codes = np.full(len(starts), -1, np.int64)
        at = np.flatnonzero(easy)
        low, high = _keys(plain, starts[at], size[at])
        key = low ^ mix(high)
        order = np.argsort(key)
        is_first = np.ones(len(key), bool)
        is_first[1:] = key[order[1:]] != key[order[:-1]]
        first = order[is_first]
        keys = key[first]
        local = np.empty(len(key), np.int64)
        local[order] = np.cumsum(is_first) - 1
        into = np.searchsorted(self._run_keys, keys)
        is_new = np.ones(len(keys), bool)
        inside = into < len(self._run_keys)
        is_new[inside] = self._run_keys[into[inside]] != keys[inside]
        numbers = np.empty(len(keys), np.int64)
        numbers[~is_new] = self._run_numbers[into[~is_new]]
        new = first[is_new]
        if len(new):
            numbers[is_new] = number = self._learn_runs(plain, starts[at[new]], size[at[new]])
            self._low[number], self._high[number] = low[new], high[new]
            self._run_keys = np.insert(self._run_keys, into[is_new], keys[is_new])
            self._run_numbers = np.insert(self._run_numbers, into[is_new], number)
        found = numbers[local]
        # A key of 64 bits may stand for two runs; the second of them is looked up as a piece.
        same = (self._low[found] == low) & (self._high[found] == high)
        codes[at] = np.where(same, found, -1)
        rest = np.flatnonzero(codes < 0)
        if len(rest):
            blank = buffer[starts[rest]] == 0x20
            for place, mine in ((0, rest[~blank]), (1, rest[blank])) if self.mode == "kept" else ((1, rest),):
                if len(mine):
                    begin = starts[mine] + (buffer[starts[mine]] == 0x20)
                    # Runs and pieces hold no blank: their bytes with blanks between them, taken apart again.
                    at, stop = _flat(begin, ends[mine] - begin + 1)
                    some = buffer[at]
                    some[stop - 1] = 0x20
                    codes[mine] = self._codes(some[:-1].tobytes().decode().split(" "), place)
        return codes

    def _learn_runs(self, plain: np.ndarray, starts: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Encode runs, many in one call with a mark after each, and return their numbers."""
        model, symbols, last_symbols, mark, mark_id = self._runs
        numbers = []
        for a in range(0, len(starts), _RUNS_AT_ONCE):
            s, n = starts[a : a + _RUNS_AT_ONCE], size[a : a + _RUNS_AT_ONCE]
            at, stop = _flat(s, n + 1)
            points = symbols[plain[at]]
            points[stop - 2] = last_symbols[plain[s + n - 1]]
            points[stop - 1] = mark
            ids = np.array(model.encode_batch_fast([points.tobytes().decode("utf-32-le")], add_special_tokens=False)[0].ids, np.uint32)
            is_mark = ids == mark_id
            lengths = np.diff(np.flatnonzero(is_mark), prepend=-1) - 1
            first = self._add_ids(ids[~is_mark], lengths)
            numbers.append(np.arange(first, first + len(s)))
        self._chars += int(size.sum())
        return np.concatenate(numbers)

    def _codes(self, pieces: list[str], place: int) -> np.ndarray:
        """The number of each piece, after learning the new ones."""
        known = self._known[place]
        codes = np.fromiter(map(known.get, pieces, repeat(-1)), np.int64, len(pieces))
        missing = np.flatnonzero(codes < 0).tolist()
        if missing:
            self._learn(list({pieces[i] for i in missing}), place)
            codes[missing] = [known[pieces[i]] for i in missing]
        return codes

    def _whole(self, texts: list[str], kind: np.ndarray, edges: np.ndarray, codes: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Texts with white space beside a blank stand as one entry each, only for this block."""
        blank = np.flatnonzero(kind == _BLANK)
        beside = blank[(kind[blank - 1] <= _LINE) | (kind[blank + 1] <= _LINE)]
        text = np.concatenate((np.searchsorted(edges, beside) - 1, np.searchsorted(begin, np.flatnonzero(self._odd[codes]), "right") - 1))
        if not len(text):
            return codes, begin
        at = np.unique(text)
        end, kept = self._end, self._pieces
        found = self.tokenizer.encode_batch_fast([texts[k] for k in at], add_special_tokens=False)
        number = self._add([e.ids for e in found], [False] * len(at))
        n_codes = np.diff(begin)
        odd = np.zeros(len(texts), bool)
        odd[at] = True
        drop = np.repeat(odd, n_codes)
        drop[begin[at]] = False
        codes[begin[at]] = np.arange(number, number + len(at))
        self._end, self._pieces = end, kept
        return codes[~drop], np.concatenate(([0], np.cumsum(np.where(odd, 1, n_codes))))


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _kinds(mode: str, runs: bool) -> np.ndarray:
    """The kind of each byte of UTF-8; without ``runs`` all but blanks and line ends is odd."""
    kind = np.full(256, _ODD, np.uint8)
    kind[0x20] = _BLANK
    kind[0x0A] = _BLANK if mode == "dropped" else _LINE
    if runs:
        kind[0x21:0x7F] = _OTHER
        kind[0x27] = _ODD
        kind[0x30:0x3A] = _DIGIT
        kind[0x41:0x5B] = kind[0x61:0x7B] = _LETTER
        # Letters of U+00C0 to U+00FF, and to U+017F where nothing is lower-cased.
        kind[0x80:0xC0] = kind[0xC3] = _LETTER
        if mode == "kept":
            kind[0xC4:0xC6] = _LETTER
    return kind


def _flat(starts: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places of all bytes of some runs in a row, and where each run ends in that row."""
    stop = np.cumsum(size)
    return np.repeat(starts - stop + size, size) + np.arange(stop[-1]), stop


def _keys(data: np.ndarray, starts: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of each run as two numbers, filled up with zeros (no run holds one)."""
    fill = np.concatenate((data, np.zeros(-len(data) % 8 + 3 * 8, np.uint8))).view("<u8")
    word, shift = starts >> 3, ((starts & 7) << 3).astype(np.uint64)
    rest = np.uint64(63) - shift
    one = np.uint64(1)
    a, b = fill[word], fill[word + 1]
    low = ((a >> shift) | ((b << one) << rest)) & _KEY_MASKS[np.minimum(size, 8)]
    high = np.zeros(len(starts), np.uint64)
    long = np.flatnonzero(size > 8)
    if len(long):
        b, c = b[long], fill[word[long] + 2]
        high[long] = ((b >> shift[long]) | ((c << one) << rest[long])) & _KEY_MASKS[size[long] - 8]
    return low, high


def _run_model(config: dict, mode: str):
    """The library's merges over bytes alone, to encode runs of one kind many at a time; None if the file asks for more.

    Returns the model, the symbol of each byte, that of a run's last byte, and a symbol that nothing merges with and its id. An
    end-of-word suffix becomes another symbol for the last byte, so that runs can follow each other.
    """
    from tokenizers import Tokenizer
    from tokenizers.models import BPE

    model = config.get("model") or {}
    suffix = model.get("end_of_word_suffix") or ""
    more = ("dropout", "unk_token", "continuing_subword_prefix", "fuse_unk", "byte_fallback", "ignore_merges")
    if mode == "whole" or model.get("type", "BPE") != "BPE" or any(model.get(k) for k in more) or (mode == "kept" and suffix):
        return None
    if not all(x["content"].startswith("<|") for x in config.get("added_tokens") or []):
        return None
    if mode == "dropped":
        steps = config["pre_tokenizer"]["pretokenizers"]
        names = [x["type"] for x in (config.get("normalizer") or {}).get("normalizers", [])]
        if steps[0]["pattern"].get("Regex") != _WORDS_AND_MARKS or steps[1].get("type") != "ByteLevel" or "NFC" not in names or "Lowercase" not in names:
            return None
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    symbols = np.zeros(256, np.uint32)
    symbols[shown] = shown
    hidden = [b for b in range(256) if b not in set(shown)]
    symbols[hidden] = np.arange(256, 256 + len(hidden))
    final = 0xF0000 if suffix else 0

    def renamed(token: str) -> str:
        base = token.removesuffix(suffix)
        return base[:-1] + chr(final + ord(base[-1])) if suffix and base and base != token else token

    vocab = {renamed(t): i for t, i in model["vocab"].items()}
    merges = [tuple(map(renamed, m if isinstance(m, list) else m.split(" "))) for m in model["merges"]]
    merged = {c for m in merges for c in m}
    marks = [chr(c) for c in symbols[:0x20].tolist() if chr(c) in vocab and not any(chr(c) in t for t in merged)]
    alphabet = {chr(c) for c in symbols.tolist()} | {chr(final + c) for c in symbols.tolist()}
    if not marks or len(vocab) < len(model["vocab"]) or not alphabet <= vocab.keys() or any(a + b not in vocab for a, b in merges):
        return None
    return Tokenizer(BPE(vocab=vocab, merges=merges, cache_capacity=0)), symbols, symbols + np.uint32(final), ord(marks[0]), vocab[marks[0]]


def _mode(config: dict) -> str:
    """``kept``: a blank belongs to the piece after it; ``dropped``: blanks separate only; ``whole``: not known to be either."""
    pre = config.get("pre_tokenizer") or {}
    if pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") and not config.get("normalizer"):
        return "kept"
    steps = pre.get("pretokenizers", [])
    if len(steps) == 2 and steps[0].get("type") == "Split" and steps[0].get("behavior") == "Removed" and steps[0].get("invert"):
        pattern = steps[0]["pattern"].get("Regex", "")
        # The pattern must name no white space but to exclude it.
        bare = pattern.replace("[^\\s\\p{L}\\p{N}]+", "")
        known = (config.get("normalizer") or {}).get("normalizers", [])
        names = {x["type"] for x in known} <= {"NFC", "Replace", "Lowercase"} and all(x.get("pattern") == {"Regex": "\\s+"} for x in known if x["type"] == "Replace")
        if names and "\\s" not in bare and " " not in bare and not steps[1].get("use_regex") and not steps[1].get("add_prefix_space"):
            return "dropped"
    return "whole"
