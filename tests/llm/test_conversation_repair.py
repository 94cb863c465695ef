"""Conversation repair against the plain rules: every way of editing, audits spelled out."""

import collections
import functools
import hashlib
import random
import re
import zlib

import pytest

from qaspark.llm import queries
from qaspark.llm.conversation_repair import repair, repair_conversations

SMALL = "/root/testdata/sf0.001"
GRAMMAR = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
WHITE = " \t\n\x0b\x0c\r"


def cheapest(rows):
    """(cost, audit, lines) of rows (role, text, fault) by trying every edit; three insertions in a row are never needed."""

    @functools.cache
    def best(i, state, inserted):
        found = [(0, "", ())] if i == len(rows) and state in ("", "a") else []

        def put(cost, letter, line, rest):
            if rest is not None:
                found.append((cost + rest[0], letter + rest[1], (() if line is None else (line,)) + rest[2]))

        if inserted < 3:
            for x in set(GRAMMAR[state]) & {"u", "a"}:
                put(3, "I", {"u": "user:", "a": "assistant:"}[x], best(i, GRAMMAR[state][x], inserted + 1))
        if i < len(rows):
            role, text, fault = rows[i]
            put(4, "D", None, best(i + 1, state, 0))
            if fault not in ("blank", "duplicate"):
                extra = 3 if fault == "truncated" else 0
                if role[:1] in GRAMMAR[state]:
                    put(extra, "K", f"{role}:{text}", best(i + 1, GRAMMAR[state][role[:1]], 0))
                for x in set(GRAMMAR[state]) & {"u", "a"}:
                    put(3 + extra, "R", f"{ {'u': 'user', 'a': 'assistant'}[x] }:{text}", best(i + 1, GRAMMAR[state][x], 0))
        return min(found) if found else None

    return best(0, "", 0)


def plain(rows):
    """The contract over (conv_id, turn, role, text) rows."""
    conversations = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        mine = conversations[conv]
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        mine += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    out = {}
    for conv, mine in conversations.items():
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        judged, seen, counts = [], set(), collections.Counter()
        for _, role, text in mine:
            bare = text.strip(WHITE)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
            seen.add((role, text))
            counts[fault] += 1
            judged.append((role, text, fault))
        turns = [t for t, _, _ in mine if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(mine, mine[1:]))
        cost, audit, lines = cheapest(tuple(judged))
        out[conv] = (gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def result(df):
    rows = df.collect()
    found = {r["conv_id"]: tuple(r)[1:] for r in rows}
    assert len(found) == len(rows)
    return found


def awkward(seed, n_conversations=60):
    rng = random.Random(seed)
    rows = []
    for conv in range(n_conversations):
        for turn in range(rng.randint(1, 12)):
            role = rng.choice(["user", "assistant"] if rng.random() < 0.6 else ["system", "tool", "", None, "s", "ulla", "User", " "])
            text = rng.choice(["Fine.", "Cut", "", None, " \t\r\n", "What?  ", "A.\n", "Hm!x", "...", "é。", "\x1c", "Fine."])
            rows += [(None if conv == 7 else conv, rng.choice([turn, turn, turn, None, 3, 10**9]), role, text)] * rng.choice([1, 1, 1, 1, 2])
    return rows


def table(spark, rows):
    return spark.createDataFrame([(*r, 5, "x") for r in rows], "conv_id long, turn long, role string, text string, cost int, audit string")


@pytest.mark.parametrize("seed", range(3))
def test_rows_with_every_fault(spark, seed):
    rows = awkward(seed)
    assert result(repair_conversations(table(spark, rows))) == plain(rows)


def test_long_conversations_in_segments_equal_the_short_way(spark, monkeypatch):
    from qaspark.llm import conversation_repair

    rows = awkward(9, 25) + [(500, i % 50, "user", "Again and again.") for i in range(300)] + [(501, 0, "user", "Same.")] * 200
    want = plain([r for r in rows if r[0] not in (500, 501)])
    df = table(spark, rows)
    short = result(repair_conversations(df))
    monkeypatch.setattr(conversation_repair, "SEGMENT_ROWS", 3)
    assert result(repair_conversations(df, long_rows=4)) == short
    assert result(repair_conversations(df, long_chars=20)) == short
    assert {c: short[c] for c in want} == want


def test_blocks_of_the_agenda_give_the_same_audit():
    rng = random.Random(4)
    for _ in range(1500):
        codes = bytes(rng.randrange(12) if rng.random() < 0.5 else rng.choice([0, 3, 6]) for _ in range(rng.randint(0, 9)))
        rows = tuple(("sua."[c // 3], "", ["", "truncated", "blank"][c % 3]) for c in codes)
        assert repair(codes) == repair(codes, 2) == repair(codes, 3) == cheapest(rows)[:2]
    codes = bytes(rng.randrange(12) for _ in range(20_000))
    assert repair(codes) == repair(codes, 333)


def test_nothing_left(spark):
    gone = next(t for t in range(1000) if zlib.crc32(f"1:{t}".encode()) % 20 == 0)
    found = result(repair_conversations(table(spark, [(1, gone, "user", "Hello.")])))
    assert found == {1: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    assert repair_conversations(table(spark, []).where("false")).collect() == []


def test_registered_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert result(queries.op12_conversation_repair(spark, SMALL)) == plain(rows)
