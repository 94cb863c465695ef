"""Repair of conversation structure: the lightest derivation of a legal order of roles, by Knuth's agenda.

An item (row, state) stands for everything from that row to the end, read from a state of the legal order
``(s?(ua)+)?``. A deduction puts one edit before an item that is already final. Its weight (cost, audit) is a superior function
of the item's: the cost never falls, and what is put in front keeps the order of audits. Items leave the agenda by
(cost, rows read, audit), so each is final when it first leaves, and the work ends when the goal, (first row, start),
does. Two audits of equal cost and rows differ in the first letter or in the items behind it, whose
order of leaving is known: no audit is spelled out before the goal is final.

Conversations up to ``LONG_ROWS`` rows meet in a stream of rows sorted by conversation. Longer ones are never held by a task:
their rows are range-partitioned into segments, one byte a row (no more than the audit itself has) goes to the agenda, which runs
block after block from the end, and only the final hash, which has no parallel form, reads the segments one after another.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from heapq import heappop, heappush

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qaspark.session import broadcast_if_small, measured_write, write_through

KEEP, REROLE, DELETE, INSERT, CUT = 0, 3, 4, 3, 3
LONG_ROWS, LONG_CHARS = 10_000, 1 << 25
BLOCK_ROWS = 4096
SEGMENT_ROWS, SEGMENT_CHARS = 20_000, 1 << 23
_WHITE = " \t\n\x0b\x0c\r"
# States of the legal order: nothing yet, after the system row, after a user row, after an assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)
#: A role's initial takes a state to another.
_STEPS = {START: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}
_FINAL = (START, ASSISTANT)
_NAMES = {"u": "user", "a": "assistant"}
# For a later state the (earlier state, initial) pairs that lead to it.
_BEFORE = {q: [(p, initial) for p, steps in _STEPS.items() for initial, to in steps.items() if to == q] for q in range(4)}
_CLASSES = "sua."
FINE, CUT_OFF, GONE = range(3)

RESULT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_NUMBERS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
_SCHEMA = pa.schema([(n, pa.int64()) for n in _NUMBERS] + [("audit", pa.string()), ("repaired_sha256", pa.string())])
_known: dict[bytes, tuple[int, str]] = {}


def code(initial: str, fault: int) -> int:
    """One byte for what the agenda has to know of a row: its initial's class and whether it is fine, cut off or has to go."""
    return 3 * (_CLASSES.find(initial) if initial in ("s", "u", "a") else 3) + fault


def _agenda(codes: bytes, seeds: list[tuple[int, int]], to_goal: bool) -> tuple[list[tuple[int, int]], list[bytearray], list[bytearray]]:
    """Items of one block from its end to its front.

    ``seeds`` are (cost, state) of the items behind the block, in the order of their audits among equal costs. Returned are the same for its
    front (only the start state with ``to_goal``), and for each state the letter and the next state of every place.
    """
    n = len(codes)
    letters, nexts = [bytearray(n + 1) for _ in range(4)], [bytearray(n + 1) for _ in range(4)]
    heap: list[tuple] = []
    # Weight: cost, rows read, letter, number of the item behind; then the item and its next state.
    for number, (cost, state) in enumerate(seeds):
        heappush(heap, (cost, 0, 0, number, state, state))
    final = [[False] * (n + 1) for _ in range(4)]
    front: list[tuple[int, int]] = []
    left = len(seeds)
    while heap:
        cost, read, letter, _, state, after = heappop(heap)
        if final[state][read]:
            continue
        final[state][read] = True
        letters[state][read], nexts[state][read] = letter, after
        left += 1
        if read == n and (state == START or not to_goal):
            front.append((cost, state))
            if to_goal:
                break
        for earlier, _initial in _BEFORE[state]:
            if _initial != "s" and not final[earlier][read]:
                heappush(heap, (cost + INSERT, read, 73, left, earlier, state))
        if read == n:
            continue
        kind, fault = divmod(codes[n - 1 - read], 3)
        if not final[state][read + 1]:
            heappush(heap, (cost + DELETE, read + 1, 68, left, state, state))
        if fault != GONE:
            extra = CUT if fault == CUT_OFF else 0
            for earlier, initial in _BEFORE[state]:
                if initial == _CLASSES[kind]:
                    heappush(heap, (cost + KEEP + extra, read + 1, 75, left, earlier, state))
                if initial != "s":
                    heappush(heap, (cost + REROLE + extra, read + 1, 82, left, earlier, state))
    return front, letters, nexts


def repair(codes: bytes, block_rows: int = BLOCK_ROWS) -> tuple[int, str]:
    """Least cost and, among the cheapest, the ASCII-least audit for rows given by their ``code``."""
    seeds, blocks = [(0, q) for q in _FINAL], []
    edges = list(range(0, len(codes), block_rows)) or [0]
    # Axioms of the end have the empty audit; their insertions are deduced with the last block.
    for begin in reversed(edges):
        seeds, letters, nexts = _agenda(codes[begin : begin + block_rows], seeds, to_goal=begin == 0)
        blocks.append((letters, nexts))
    audit, state = [], START
    for letters, nexts in reversed(blocks):
        read = len(letters[0]) - 1
        while letters[state][read]:
            letter = letters[state][read]
            audit.append(letter)
            state, read = nexts[state][read], read - (letter != 73)
    return seeds[0][0], bytes(audit).decode()


def _repair_known(codes: bytes) -> tuple[int, str]:
    """``repair``, remembering short conversations of this worker."""
    if len(codes) > 16:
        return repair(codes)
    if codes not in _known:
        if len(_known) >= 100_000:
            _known.clear()
        _known[codes] = repair(codes)
    return _known[codes]


def legal_steps(audit: str, initials: str, state: int = START) -> tuple[list[str | None], int]:
    """For each edit the initial of the row it leaves (None for a deletion), and the state behind the last one."""
    out: list[str | None] = []
    place = 0
    for edit in audit:
        if edit == "D":
            out.append(None)
        else:
            initial = initials[place] if edit == "K" else "u" if state != USER else "a"
            out.append(initial)
            state = _STEPS[state][initial]
        place += edit != "I"
    return out, state


def repaired_lines(audit: str, roles: list[str], texts: list[str], state: int = START) -> tuple[list[str], int]:
    """The lines ``role:text`` that ``audit`` makes of some rows read from ``state``, and the state behind them."""
    steps, state = legal_steps(audit, "".join(r[:1] or "." for r in roles), state)
    lines, place = [], 0
    for edit, initial in zip(audit, steps):
        if edit == "K":
            lines.append(f"{roles[place]}:{texts[place]}")
        elif edit == "R":
            lines.append(f"{_NAMES[initial]}:{texts[place]}")
        elif edit == "I":
            lines.append(f"{_NAMES[initial]}:")
        place += edit != "I"
    return lines, state


def illegal_pairs(initials: str) -> int:
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))


def damage(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, copies``: the rows after the stated faults, ``copies`` 0 for a dropped and 2 for a repeated row."""
    written = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(written("conv_id"), F.lit(":"), written("turn"))) % 20
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), written("role").alias("role"), written("text").alias("text"), kind.alias("kind")
    )
    return rows.select(
        "conv_id",
        "turn",
        F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("kind") == 0, 0).when(F.col("kind") == 3, 2).otherwise(1).alias("copies"),
    )


def _faults(rows: DataFrame) -> DataFrame:
    """``blank`` and ``truncated`` of each row by itself; a dropped row's text is not carried further."""
    bare = F.rtrim(F.col("text"), F.lit(_WHITE))
    return rows.select(
        "conv_id", "turn", "role", F.when(F.col("copies") > 0, F.col("text")).alias("text"), "copies", (bare == "").alias("blank"), (~F.substring(bare, -1, 1).isin(".", "!", "?")).alias("truncated")
    )


def _line_of(conv_id: int | None, turns: list[int | None], roles: list[str], texts: list[str], blank: list[bool], truncated: list[bool]) -> tuple:
    """The result row of a whole conversation, its rows in order."""
    seen: set[tuple[str, str]] = set()
    codes = bytearray()
    n_blank = n_duplicate = n_truncated = 0
    for role, text, is_blank, is_cut in zip(roles, texts, blank, truncated):
        again = (role, text) in seen
        seen.add((role, text))
        fault = GONE if is_blank or again else CUT_OFF if is_cut else FINE
        n_blank, n_duplicate, n_truncated = n_blank + is_blank, n_duplicate + (again and not is_blank), n_truncated + (fault == CUT_OFF)
        codes.append(code(role[:1], fault))
    cost, audit = _repair_known(bytes(codes))
    lines, _ = repaired_lines(audit, roles, texts)
    known = [t for t in turns if t is not None]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return conv_id, gaps, n_blank, n_duplicate, n_truncated, illegal_pairs("".join(r[:1] or "." for r in roles)), cost, audit, digest


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Conversations out of rows sorted by conversation, one held at a time."""
    out: list[tuple] = []
    current: list[list] = [[] for _ in range(5)]
    conv, open_ = None, False

    def columns() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out), _SCHEMA.types)], schema=_SCHEMA)

    for batch in batches:
        for conv_id, turn, role, text, copies, is_blank, is_cut in zip(*(c.to_pylist() for c in batch.columns)):
            if open_ and conv_id != conv:
                out.append(_line_of(conv, *current))
                current = [[] for _ in range(5)]
            conv, open_ = conv_id, True
            for _ in range(copies):
                for column, value in zip(current, (turn, role, text, is_blank, is_cut)):
                    column.append(value)
        if out:
            yield columns()
            out.clear()
    if open_:
        out.append(_line_of(conv, *current))
        yield columns()


def repair_conversations(conversations: DataFrame, long_rows: int = LONG_ROWS, long_chars: int = LONG_CHARS, damaged: bool = False) -> DataFrame:
    """One row per ``conv_id`` (null is one of them) of what ails a conversation and how it is repaired at least cost.

    ``conversations`` holds conv_id, turn, role, text; other columns are left out. It is damaged as ``damage`` states first, unless it
    already has the columns of ``damage`` (``damaged``). Null roles and texts are one space. Rows go by turn, null turns first, equal
    turns by role and text; repeated rows count each. A conversation without rows has zeros, an empty audit and the hash of
    the empty string. Runs jobs when called: the sizes of conversations are counted first.
    """
    rows = _faults(conversations if damaged else damage(conversations))
    sizes = rows.groupBy("conv_id").agg(F.sum("copies").alias("n"), F.coalesce(F.sum(F.length("text") * F.col("copies")), F.lit(0)).alias("chars"))
    long, seen = measured_write(sizes.where((F.col("n") > long_rows) | (F.col("chars") > long_chars)).select("conv_id"), "long", rows=F.count(F.lit(1)))
    if not seen["rows"]:
        return _short(rows)
    few = broadcast_if_small(long.withColumnRenamed("conv_id", "long_id"), seen["rows"])
    same = F.col("conv_id").eqNullSafe(F.col("long_id"))
    return _short(rows.join(few, same, "left_anti")).unionByName(_long(rows.join(few, same, "left_semi")))


def _short(rows: DataFrame) -> DataFrame:
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "text"]
    return rows.repartition("conv_id").sortWithinPartitions(*order).mapInArrow(_stream, RESULT)


# --- conversations too long for a task

_SEGMENT = "conv_id long, segment long, codes binary, blank long, duplicate long, truncated long, illegal long, first string, last string, roles array<string>, texts array<string>"
_SEGMENT_SCHEMA = pa.schema(
    [("conv_id", pa.int64()), ("segment", pa.int64()), ("codes", pa.binary())]
    + [(n, pa.int64()) for n in ("blank", "duplicate", "truncated", "illegal")]
    + [("first", pa.string()), ("last", pa.string()), ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string()))]
)


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order to segments of one conversation, each bounded in rows and characters."""
    number = TaskContext.get().partitionId() << 40
    conv, codes, counts, roles, texts, chars = None, bytearray(), [0, 0, 0], [], [], 0

    def finish() -> pa.RecordBatch:
        initials = "".join(r[:1] or "." for r in roles)
        row = dict(zip(_SEGMENT_SCHEMA.names, [conv, number, bytes(codes), *counts, illegal_pairs(initials), initials[:1], initials[-1:], roles, texts]))
        return pa.RecordBatch.from_pylist([row], schema=_SEGMENT_SCHEMA)

    for batch in batches:
        for conv_id, role, text, copies, is_blank, is_cut, again in zip(*(c.to_pylist() for c in batch.columns)):
            for copy in range(copies):
                if roles and (conv_id != conv or len(roles) >= SEGMENT_ROWS or chars >= SEGMENT_CHARS):
                    yield finish()
                    number, codes, counts, roles, texts, chars = number + 1, bytearray(), [0, 0, 0], [], [], 0
                conv = conv_id
                repeated = (again or copy > 0) and not is_blank
                fault = GONE if is_blank or repeated else CUT_OFF if is_cut else FINE
                counts[0], counts[1], counts[2] = counts[0] + is_blank, counts[1] + repeated, counts[2] + (fault == CUT_OFF)
                codes.append(code(role[:1], fault))
                roles.append(role)
                texts.append(text)
                chars += len(text)
    if roles:
        yield finish()


def _solve(table: pa.Table) -> pa.Table:
    """The audit of one conversation from the bytes of its segments, cut up again by segment."""
    rows = sorted(table.to_pylist(), key=lambda r: r["segment"])
    codes = b"".join(r["codes"] for r in rows)
    cost, audit = repair(codes)
    edges = [sum(r[n] for r in rows) for n in ("blank", "duplicate", "truncated", "illegal")]
    edges[3] += sum(a["last"] + b["first"] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    out, at, state = [], 0, START
    for i, r in enumerate(rows):
        left, begin = len(r["codes"]), at
        while at < len(audit) and (left or i == len(rows) - 1):
            left -= audit[at] != "I"
            at += 1
        edits = audit[begin:at]
        out.append({"conv_id": r["conv_id"], "segment": r["segment"], "edits": edits, "state": state, "cost": cost, **dict(zip(("blank", "duplicate", "truncated", "illegal"), edges))})
        _, state = legal_steps(edits, "".join(_CLASSES[c // 3] for c in r["codes"]), state)
    return pa.Table.from_pylist(out, schema=_EDITS_SCHEMA)


_EDITS = "conv_id long, segment long, edits string, state int, cost long, blank long, duplicate long, truncated long, illegal long"
_EDITS_SCHEMA = pa.schema([("conv_id", pa.int64()), ("segment", pa.int64()), ("edits", pa.string()), ("state", pa.int32())] + [(n, pa.int64()) for n in ("cost", "blank", "duplicate", "truncated", "illegal")])


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each segment adds to the repaired conversation; null if no line is left of it."""
    for batch in batches:
        for conv_id, segment, roles, texts, edits, state in zip(*(c.to_pylist() for c in batch.columns)):
            lines, _ = repaired_lines(edits, roles, texts, state)
            chunk = "\n".join(lines).encode() if lines else None
            yield pa.RecordBatch.from_arrays([pa.array([conv_id], pa.int64()), pa.array([segment], pa.int64()), pa.array([edits]), pa.array([chunk], pa.binary())], names=["conv_id", "segment", "edits", "chunk"])


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One hash and audit per conversation out of its chunks in order."""
    conv, open_, begun, digest, audit = None, False, False, hashlib.sha256(), []

    def finish() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([conv], pa.int64()), pa.array(["".join(audit)]), pa.array([digest.hexdigest()])], names=["conv_id", "audit", "repaired_sha256"])

    for batch in batches:
        for conv_id, _, edits, chunk in zip(*(c.to_pylist() for c in batch.columns)):
            if open_ and conv_id != conv:
                yield finish()
                begun, digest, audit = False, hashlib.sha256(), []
            conv, open_ = conv_id, True
            audit.append(edits)
            if chunk is not None:
                digest.update(b"\n" + chunk if begun else chunk)
                begun = True
    if open_:
        yield finish()


def _long(rows: DataFrame) -> DataFrame:
    """As ``_short`` for conversations of any length."""
    met = rows.where(F.col("copies") > 0)
    # Equal rows are one row with a count: however often a line is repeated, it is one row here.
    one = met.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").cast("long").alias("copies"), F.first("blank").alias("blank"), F.first("truncated").alias("truncated"))
    one = one.withColumn("same", F.sha2(F.concat_ws("\x00", F.length("role").cast("string"), "role", "text"), 256))
    one = write_through(one, "distinct_rows")
    turn = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    first = one.groupBy("conv_id", "same").agg(F.min(turn).alias("earliest")).withColumnsRenamed({"conv_id": "c", "same": "s"})
    matched: Column = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("same") == F.col("s"))
    marked = one.join(first, matched).withColumn("again", ~F.col("earliest").eqNullSafe(turn))
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "text"]
    sorted_ = marked.repartitionByRange(*order).sortWithinPartitions(*order)
    cut = write_through(sorted_.select("conv_id", "role", "text", "copies", "blank", "truncated", "again").mapInArrow(_segments, _SEGMENT), "segments")
    edits = write_through(cut.drop("roles", "texts").groupBy("conv_id").applyInArrow(_solve, _EDITS), "edits")
    by = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("segment") == F.col("s"))
    asked = edits.select(F.col("conv_id").alias("c"), F.col("segment").alias("s"), "edits", "state")
    chunks = cut.select("conv_id", "segment", "roles", "texts").join(asked, by).select("conv_id", "segment", "roles", "texts", "edits", "state")
    hashes = chunks.mapInArrow(_chunks, "conv_id long, segment long, edits string, chunk binary").repartition("conv_id").sortWithinPartitions("conv_id", "segment").mapInArrow(_hashed, "conv_id long, audit string, repaired_sha256 string")
    numbers = edits.groupBy("conv_id").agg(*[F.max(n).alias(n) for n in ("blank", "duplicate", "truncated", "illegal", "cost")])
    # Distinct turns in two steps, so that no task holds the turns of a conversation.
    turns = met.groupBy("conv_id", "turn").agg(F.lit(1).alias("one")).groupBy("conv_id").agg((F.max("turn") - F.min("turn") + 1 - F.count("turn")).alias("gaps"))
    left, right = numbers.alias("n"), turns.withColumnRenamed("conv_id", "t")
    joined = left.join(right, F.col("conv_id").eqNullSafe(F.col("t"))).drop("t").join(hashes.withColumnRenamed("conv_id", "h"), F.col("conv_id").eqNullSafe(F.col("h")))
    return joined.select("conv_id", F.coalesce("gaps", F.lit(0)).cast("long").alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
