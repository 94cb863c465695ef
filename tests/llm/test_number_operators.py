"""Vector searches, token files, packing, mixing and class-based scores against plain versions, with awkward rows."""

import collections
import io
import math
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from qaspark import session
from qaspark.llm import class_model, collision_search, impact_search, mixing, packing, token_frames
from qaspark.llm.tokens import Encoder
from tests.llm.test_text_operators import lowered, prose, table, words

SMALL = "/root/testdata/sf0.001"
GPT = public_tokenizers.path("byte_bpe_50k.json")
CLIP = public_tokenizers.path("word_bpe_49k.json")
AWKWARD = [
    "", None, " ", "   ", "a  b", "  x", "a ", "a\n b \nc", "x   y", "<|endoftext|> a<|endoftext|>b  <|endoftext|>", "don't we'LL\tx\x1c y", "\x1c a",
    "café é ́ x́ É", "İSTANBUL ΣΑΣ ΑΣ b", "a b c", "１２3 ½ ² x²", "🙂 🙂🙂 a🙂", "\r\n \r\n", "l1 a\nl2\nl3 b.", "\n", "a\n\nb c", "a\n b\nc", "x \x85 y", "日本 語",
]


# --- vector searches


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1.0, "r", "b") for i, v in rows], "vec_id long, embedding array<float>, score double, rank string, id string")


def awkward_vectors(seed=1, n=300, width=8):
    rng = np.random.default_rng(seed)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(rng.standard_normal((n, width)).astype(np.float32))]
    rows += [(1000 + i, rows[20][1]) for i in range(60)]  # one very common vector
    rows += [(2000, None), (2020, []), (2040, [1.0, None] + [0.0] * (width - 2)), (2060, [float("nan")] * width), (2080, [float("inf")] + [0.0] * (width - 1))]
    rows += [(2100, [0.0] * width), (2120, [1.0] * (width - 1)), (40, rows[40][1]), (None, rows[0][1])]
    return rows


def plain_top(rows, scale, allow_zero, k=20):
    fine = {}
    for i, v in rows:
        if i is not None and v and len(v) == 8 and all(x is not None and math.isfinite(x) for x in v) and (allow_zero or any(v)):
            fine[i] = np.floor(np.array(np.float32(v), np.float64) * scale) if scale else np.array(np.float32(v), np.float64)
    out = {}
    for q in (i for i in fine if i % 20 == 0):
        scores = sorted(((-float(fine[q] @ fine[c]), c) for c in fine if c != q))[:k]
        out[q] = [(r + 1, c, -s) for r, (s, c) in enumerate(scores)]
    return out


def results(df):
    out = collections.defaultdict(list)
    for r in df.collect():
        out[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    return {q: sorted(x) for q, x in out.items()}


def test_impact_search_is_exact_in_one_and_in_many_blocks(spark):
    rows = awkward_vectors()
    want = plain_top(rows, 64, True)
    for per_block in (10_000, 40):
        assert results(impact_search.top_k(vectors(spark, rows), F.col("id") % 20 == 0, rows_per_block=per_block)) == want


def test_impact_search_stops_early_and_stays_exact():
    rng = np.random.default_rng(2)
    matrix = rng.zipf(1.6, (4000, 16)).clip(max=200) * rng.choice([-1, 1], (4000, 16))
    ids = np.arange(4000) * 3
    block = impact_search.Block(impact_search.load(impact_search.build_index(ids, matrix)))
    asked = np.arange(0, 200, 20)
    for floor in (-np.inf, 500.0, 1e9):
        found = impact_search.top_members(block, matrix[asked], ids[asked], 20, np.full(len(asked), floor))
        for q, (top, score) in zip(asked, found):
            exact = matrix @ matrix[q]
            others = np.flatnonzero(ids != ids[q])
            want = others[np.lexsort((ids[others], -exact[others]))[:20]]
            want = want[exact[want] >= floor]
            # What is below the floor may come along, behind all that is not.
            assert (top[: len(want)] == want).all() and (score == exact[top]).all()


def test_searches_keep_vectors_of_every_length(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.standard_normal(4 if i < 60 else 6)]) for i in range(110)] + [(200, [1.0, 1.0, 1.0])]
    for search, scale in ((impact_search.top_k, 64), (collision_search.nearest, None)):
        got = results(search(vectors(spark, rows), F.col("id") % 20 == 0, rows_per_block=25))
        assert set(got) == {0, 20, 40, 60, 80, 100} and all(len(x) == 20 for x in got.values())
        same = lambda i: {r[0] for r in rows if len(r[1]) == (4 if i < 60 else 6)}
        assert all({c for _, c, _ in x} <= same(q) - {q} for q, x in got.items())
        hits = 0
        for q, x in got.items():
            lifted = {i: np.floor(np.array(np.float32(v), float) * scale) if scale else np.array(np.float32(v), float) for i, v in rows}
            want = sorted((-float(lifted[q] @ lifted[c]), c) for c in same(q) - {q})[:20]
            hits += len({c for _, c in want} & {c for _, c, _ in x})
        assert hits == 120 if scale else hits >= 108


def test_impact_search_is_exact_beyond_doubles_and_refuses_what_does_not_fit(spark):
    def table_of(*components):
        return spark.createDataFrame([(20 * i, [float(x) for x in c]) for i, c in enumerate(components)], "vec_id long, embedding array<double>")

    wide = [(2.0**22, 1 / 64, 2.0**22), (2.0**22, 3 / 64, 0.0), (2.0**22, 5 / 64, 2.0**22), (2.0**22, 4 / 64, 2.0**22)]
    got = results(impact_search.top_k(table_of(*wide), F.col("id") == 0))[0]
    whole = [[int(x * 64) for x in c] for c in wide]
    want = sorted((-sum(a * b for a, b in zip(whole[0], c)), 20 * i) for i, c in enumerate(whole) if i)
    assert [(c, s) for _, c, s in got] == [(c, -s) for s, c in want]
    with pytest.raises(Exception, match="64-bit"):
        impact_search.top_k(table_of((2.0**40, 1.0), (2.0**40, 2.0)), F.col("id") == 0).collect()


def test_collision_search_recall_scores_and_awkward_rows(spark):
    rows = awkward_vectors(3)
    want, found = plain_top(rows, None, False), results(collision_search.nearest(vectors(spark, rows), F.col("id") % 20 == 0))
    assert found.keys() == want.keys()
    hits = sum(len({c for _, c, _ in found[q]} & {c for _, c, _ in want[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))
    exact = {(q, c): s for q in want for _, c, s in plain_top(rows, None, False, 10_000)[q]}
    for q, got in found.items():
        assert [r for r, _, _ in got] == list(range(1, len(got) + 1)) and len(got) == 20
        assert all(abs(s - exact[q, c]) < 1e-12 for _, c, s in got)
        assert [(-s, c) for _, c, s in got] == sorted((-s, c) for _, c, s in got)


def test_collision_search_recall_on_the_given_embeddings(spark):
    t = pq.read_table(f"{SMALL}/embeddings.parquet")
    ids, matrix = t["vec_id"].to_numpy(), np.array(t["embedding"].to_pylist(), np.float32).astype(np.float64)
    found = results(collision_search.nearest(spark.read.parquet(f"{SMALL}/embeddings.parquet"), F.col("id") % 20 == 0))
    hits = [len({c for _, c, _ in found[q]} & set(collision_search.exact_nearest(matrix, ids, matrix[ids == q][0], q, 20).tolist())) for q in found]
    assert len(found) == sum(ids % 20 == 0) and sum(hits) >= 0.9 * 20 * len(found)


@pytest.mark.parametrize("search", [impact_search.top_k, collision_search.nearest])
def test_searches_of_few_or_no_rows(spark, search):
    few = vectors(spark, [(0, [1.0, 2.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0])])
    assert [c for _, c, _ in results(search(few, F.col("id") % 20 == 0))[0]] == [2, 1]
    assert search(vectors(spark, []), F.col("id") % 20 == 0).count() == 0
    assert search(vectors(spark, [(1, [1.0]), (2, None)]), F.col("id") % 20 == 0).count() == 0
    assert search(vectors(spark, [(0, [1.0])]), F.col("id") % 20 == 0).count() == 0


# --- tokens


@pytest.mark.parametrize("path", [GPT, CLIP])
def test_encoder_gives_the_ids_of_the_library(path, monkeypatch):
    rng = random.Random(1)
    alphabet = [" ", " ", "a", "B", "é", "\n", "\t", "1", "'s", ".", "<|endoftext|>", "́", "\x1c", "日", "🙂", " ", "  "]
    texts = AWKWARD + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(14))) for _ in range(1500)]
    texts += pq.read_table(f"{SMALL}/documents.parquet")["text"].to_pylist()[:40]
    plain, known = Tokenizer.from_file(path), Encoder(path)
    assert known.mode != "whole"
    want = [plain.encode(t or "", add_special_tokens=False).ids for t in texts]
    for _ in range(2):
        ids, counts = known.encode(texts)
        assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == want
        monkeypatch.setattr("qaspark.llm.tokens.MOST_PIECES", 10)  # the second time round the memory is full
    assert known.encode([])[0].tolist() == []


@pytest.mark.parametrize("path", [GPT, CLIP])
def test_encoder_cuts_pieces_into_runs_as_the_library_does(path, monkeypatch):
    rng = random.Random(2)
    alphabet = [*" " * 12, *"aBzéÉßñœİŸ×÷ſ'_-.,!|<>\"", "\n", "\n\n", "\n\n\n", "\r\n", "12", "7", "'s", "l'", "<|", "|>", "<|endoftext|>", "\0", "\x01", "é", "…", "Δ", "я", "longwordoverany", "!!!!!!!!!"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(30))) for _ in range(6000)]
    texts += ["", "\n", "\n\n", "a\n", "a\n\n", "\n\na", "a\n\n<|endoftext|>", "<|endoftext|>\n\na", " a", "a ", None, "a" * 15, "é" * 8, "a" * 17, " " + "é" * 8]
    plain, known = Tokenizer.from_file(path), Encoder(path)
    want = [plain.encode(t or "", add_special_tokens=False).ids for t in texts]
    for _ in range(2):
        ids, counts = known.encode(texts)
        assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == want
        # The second time the memory is full, and other runs have the same key.
        monkeypatch.setattr("qaspark.llm.tokens.MOST_PIECES", 10)
        monkeypatch.setattr("qaspark.llm.tokens.mix", lambda x: x * np.uint64(0))
    assert known.encode(["", None])[1].tolist() == [0, 0]


@pytest.mark.parametrize("path", [GPT, CLIP])
def test_encoder_takes_plain_words_and_marks_past_the_slow_cutting(path):
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefghijßéüñ") for _ in range(rng.randrange(2, 7))) for _ in range(3000)]
    marks = ["", ",", ".", "...", "!?", "\n", ".\n", "\n\n", "12"]
    text = " ".join(w.title() + rng.choice(marks) + rng.choice("xyz") for w in words)
    known = Encoder(path)
    want = known.tokenizer.encode(text, add_special_tokens=False).ids
    known.tokenizer = None
    assert known.encode([text])[0].tolist() == want
    assert len(known._run_keys) < len({w.title() for w in words}) * 1.5  # a word is known once, not with every mark


class Source(io.BytesIO):
    reads = 0

    def size(self):
        return len(self.getvalue())

    def read(self, n):
        self.reads += n
        return super().read(n)


def test_frames_hold_a_seek_table_and_are_read_one_by_one():
    class Kept(io.BytesIO):
        def close(self):
            self.content = self.getvalue()

    out = Kept()
    writer = token_frames.FrameWriter(out, width=2)
    rng = np.random.default_rng(3)
    docs = {i * 7: rng.integers(0, 60_000, rng.integers(1, 5000)).astype(np.uint32) for i in range(50)}
    docs[400] = np.empty(0, np.uint32)
    for i, ids in docs.items():
        writer.add(i, ids)
    writer.close()
    data = out.content
    # The whole file is one valid zstandard stream: its frames one after another, the rest skippable.
    import zstandard

    stream = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read()
    assert stream == b"".join(x.astype("<u2").tobytes() for x in docs.values())
    source = Source(data)
    reader = token_frames.FrameReader(source)
    before = source.reads
    assert [(i, x.tolist()) for i, x in reader.documents([21, 400, 5])] == [(21, docs[21].tolist()), (400, [])]
    assert source.reads - before == reader.table[3, 0] + reader.table[50, 0]
    assert [(i, x.tolist()) for i, x in reader.documents()] == [(i, x.tolist()) for i, x in docs.items()]
    # A frame whose content is another document's fails its checksum.
    reader.table[3, 2] ^= 1
    with pytest.raises(ValueError, match="damaged"):
        reader.frame(3)
    with pytest.raises(ValueError, match="seek table"):
        token_frames.FrameReader(Source(data[:-1]))


def test_token_files_round_trip(spark):
    rows = [(i * 3, t, "en", "s") for i, t in enumerate(AWKWARD)] + [(7, "x y", "en", "s"), (7, "x y", "en", "s"), (None, "nobody", "en", "s"), (10**12, "long word " * 30_000, "en", "s")]
    files = token_frames.write_tokens(table(spark, rows).repartition(3), CLIP, end_id=2)
    plain = Tokenizer.from_file(CLIP)
    want, start = [], 0
    for i, t in sorted(((i, t) for i, t, *_ in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = np.array(plain.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        want.append((i, start, len(ids), zlib.crc32(ids.tobytes()), ids.tobytes()))
        start += len(ids)
    got = [tuple(r) for r in token_frames.read_tokens(files).orderBy("start").collect()]
    assert [(*r[:4], bytes(r[4])) for r in got] == want
    some = [tuple(r)[:3] for r in token_frames.read_tokens(files, wanted=[7, 10**12, 5]).orderBy("start").collect()]
    assert some == [w[:3] for w in want if w[0] in (7, 10**12)]
    empty = token_frames.write_tokens(table(spark, []), CLIP, end_id=2)
    assert token_frames.read_tokens(empty).count() == 0


def test_token_files_hold_words_with_every_mark_and_line_end(spark, tmp_path):
    rng = random.Random(8)
    words = [prose(rng, 1).title() for _ in range(40)] + ["Straße", "ÉTÉ", "don't", "naïve", "İç", "日本", "x" * 20]
    texts = ["".join(rng.choice(words) + rng.choice(["", ".", ",", "!?", "3", "\n", ".\n\n"]) + " " for _ in range(rng.randrange(60))) for _ in range(80)]
    files = token_frames.write_tokens(table(spark, [(i, t, "en", "s") for i, t in enumerate(texts)]), CLIP, end_id=2, folder=str(tmp_path))
    plain = Tokenizer.from_file(CLIP)
    got = {r["doc_id"]: np.frombuffer(r["ids"], "<u4").tolist() for r in token_frames.read_tokens(files).collect()}
    assert got == {i: plain.encode(t, add_special_tokens=False).ids + [2] for i, t in enumerate(texts)}


# --- packing


def check_packing(pieces, rows, window):
    plain = Tokenizer.from_file(GPT)
    whole = collections.Counter()
    for i, t, *_ in rows:
        whole[i, tuple(plain.encode(t or "", add_special_tokens=False).ids + [1])] += 1
    by_sequence = collections.defaultdict(list)
    for p in pieces:
        by_sequence[p["sequence_id"]].append(p)
    for members in by_sequence.values():
        members.sort(key=lambda p: p["offset"])
        assert [p["offset"] for p in members] == np.cumsum([0] + [p["length"] for p in members])[:-1].tolist()
        assert sum(p["length"] for p in members) <= window and min(p["length"] for p in members) > 0
    # Every id of every row in exactly one piece, with the right content.
    for i in {i for i, _ in whole}:
        mine = sorted((p["start"], p["length"], p["ids_crc32"]) for p in pieces if p["doc_id"] == i)
        want = collections.Counter()
        texts = [t for (d, t), n in whole.items() if d == i for _ in range(n)]
        assert sum(length for _, length, _ in mine) == sum(map(len, texts))
        if len(texts) == 1:
            place = 0
            for start, length, crc in mine:
                assert start == place and crc == zlib.crc32(np.array(texts[0][start : start + length], "<u4").tobytes())
                place += length
    return 1 - sum(p["length"] for p in pieces) / (window * max(1, len(by_sequence)))


def test_packing_covers_every_id_once_with_little_padding(spark):
    rng = random.Random(5)
    rows = [(i, prose(rng, rng.randrange(0, 400)), "en", "s") for i in range(150)]
    rows += [(1000, None, "en", "s"), (1001, "", "en", "s"), (1002, "many words here " * 3000, "en", "s"), (1003, rows[3][1], "en", "s"), (1003, rows[3][1], "en", "s"), (None, "no id", "en", "s")]
    pieces = packing.pack(table(spark, rows), GPT, end_id=1).collect()
    assert check_packing(pieces, rows, 2048) < 0.05
    assert packing.pack(table(spark, []), GPT, end_id=1).count() == 0
    assert [p["length"] for p in packing.pack(table(spark, [(1, None, "en", "s")]), GPT, end_id=1).collect()] == [1]


def test_packing_fills_a_window_with_lexical_neighbours():
    rng = np.random.default_rng(6)
    docs = [rng.integers(500 * (i % 4), 500 * (i % 4) + 400, 100).astype(np.uint32) for i in range(80)]
    frequency = np.bincount(np.concatenate([np.unique(d) for d in docs]), minlength=2000)
    idf = np.log1p((80 - frequency + 0.5) / (frequency + 0.5))
    shard = packing.Shard(docs, idf, 100.0)
    tf = [collections.Counter(d.tolist()) for d in docs]
    unused = np.ones(80, bool)
    unused[[0, 4]] = False
    found = shard.neighbours(0, unused)
    assert len(found) >= 14 and {int(d) % 4 for d in found} == {0} and not {0, 4} & set(found.tolist())
    weight = lambda d, t: idf[t] * tf[d][t] * 2.2 / (tf[d][t] + 1.2)  # noqa: E731  all are of mean length
    terms = sorted(tf[0], key=lambda t: -weight(0, t))
    # Which of equally heavy terms are asked is open; with distinct weights the order is BM25's.
    if weight(0, terms[15]) > weight(0, terms[16]) + 1e-9:
        scores = {d: sum(weight(d, t) for t in terms[:16] if t in tf[d]) for d in range(8, 80, 4)}
        assert [int(d) for d in found] == sorted((d for d in scores if scores[d] > 0), key=lambda d: (-scores[d], d))
    by_sequence = collections.defaultdict(set)
    for d, _, _, sequence, _ in packing.pack_shard(docs, idf, 100.0, window=500):
        by_sequence[sequence].add(d % 4)
    assert len(by_sequence) == 16 and sum(len(x) == 1 for x in by_sequence.values()) >= 12


def test_packing_retrieves_until_the_window_is_full_and_by_all_terms():
    rng = np.random.default_rng(12)
    # Short documents of two vocabularies by turns: a window takes a hundred of one of them.
    docs = [np.append(rng.integers(500 * (i % 2), 500 * (i % 2) + 50, 9), 500 * (i % 2) + 60).astype(np.uint32) for i in range(400)]
    idf = np.ones(2000)
    by_sequence = collections.defaultdict(set)
    for d, _, _, sequence, _ in packing.pack_shard(docs, idf, 10.0, window=1000):
        by_sequence[sequence].add(d % 2)
    assert len(by_sequence) == 4 and all(len(x) == 1 for x in by_sequence.values())
    # A neighbour that shares only the lightest of many terms of the seed is found, after the heavier ones.
    seed, light, heavy, other = np.arange(100), np.arange(95, 120), np.arange(25), np.arange(200, 300)
    shard = packing.Shard([x.astype(np.uint32) for x in (seed, light, heavy, other)], np.where(np.arange(2000) < 95, 2.0, 1.0), 50.0)
    assert shard.neighbours(0, np.array([False, True, True, True])).tolist() == [2, 1]
    assert shard.neighbours(0, np.array([False, True, False, True])).tolist() == [1]


# --- mixing


def plain_targets(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    """Shares by weight; what is above a limit is shared again among the others until nothing is."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[k % 3] for k, s in enumerate(order)}
    fixed, total = {}, share * sum(sizes.values())
    while True:
        free = [s for s in order if s not in fixed]
        left = total - sum(fixed.values())
        now = {s: left * w[s] / sum(w[x] for x in free) for s in free}
        above = [s for s in free if now[s] > most * sizes[s] + 1e-9]
        if not above:
            return {**fixed, **now}
        fixed.update({s: most * sizes[s] for s in above})


def test_mixing_meets_budgets_and_limits(spark):
    rng = random.Random(7)
    rows = [(i, prose(rng, rng.randrange(0, 60)), "en", rng.choice(["a", "a", "a", "a", "b", "c", "Z", "é", None])) for i in range(400)]
    rows += [(900, None, "en", "empty"), (901, " \n ", "en", "empty"), (902, "\tone  two\x0b", "en", "b"), (None, "no id", "en", "c"), (5, rows[5][1], "en", rows[5][3]), (5, rows[5][1], "en", rows[5][3])]
    found = mixing.mix(table(spark, rows), rows_per_stretch=10).collect()
    assert len(found) == len(rows)
    sizes = collections.Counter()
    for _, t, _, s in rows:
        sizes[s] += len(words(t))
    want = plain_targets(sizes)
    taken = collections.Counter()
    for r in found:
        assert r["source_size"] == sizes[r["source"]] and abs(r["target"] - want[r["source"]]) < 1e-6
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
    assert all(abs(taken[s] - want[s]) <= 0.5 + 1e-6 for s in sizes)
    assert {r["doc_id"]: r["size"] for r in found if r["doc_id"] in (900, 901, 902)} == {900: 0, 901: 0, 902: 2}
    again = mixing.mix(table(spark, rows).repartition(5), rows_per_stretch=10_000).collect()
    assert sorted(map(str, again)) == sorted(map(str, found))
    assert mixing.mix(table(spark, [])).count() == 0


def test_mixing_plan_is_native(spark):
    plan = mixing.mix(table(spark, [(1, "a b", "en", "s")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


# --- class-based scores


def test_class_model_base_is_exact_and_classes_help_on_held_out_texts(spark):
    rng = random.Random(8)
    kinds = {0: [f"a{i}ung" for i in range(90)], 1: [f"b{i}tion" for i in range(90)]}
    rows = [(i, " ".join(rng.choice(kinds[(i + k // 5) % 2]) for k in range(rng.randrange(20, 60))), "en", "s") for i in range(150)]
    rows += [(1000, None, "en", "s"), (1001, "", "en", "s"), (1002, "Never SEEN wörds", "en", "s"), (1003, "a1ung " * 60_000, "en", "s"), (7, rows[7][1], "en", "s"), (None, "b1tion B2TION", "en", "s")]
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1
    found = class_model.score_texts(table(spark, rows).repartition(3), held, top_words=60, classes=8).collect()
    assert len(found) == len(rows)
    test = {i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1 for i, *_ in rows}
    tokens = [(i, words(lowered(t)) + [None]) for i, t, *_ in rows]
    count = collections.Counter(w for i, line in tokens if not test[i] for w in line)
    n, v = sum(count.values()), len(count)
    want = sorted(((i, test[i], len(line), sum(count[w] > 0 for w in line), n, sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in line)) for i, line in tokens), key=str)
    got = sorted(((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in found), key=str)
    for a, b in zip(got, want):
        assert a[:5] == b[:5] and abs(a[5] - b[5]) < 1e-6 * abs(b[5])
    out = [r for r in found if r["held_out"] and r["n_tokens"] > 10]
    assert out and sum(r["score"] for r in out) > sum(r["base_score"] for r in out)
    assert all(r["score"] < 0 and abs(r["perplexity"] - 10 ** (-r["score"] / r["n_tokens"])) < 1e-6 * r["perplexity"] for r in found)
    assert class_model.score_texts(table(spark, []), held).count() == 0


def test_rare_words_of_like_ending_get_classes_of_their_own(spark):
    rng = random.Random(11)
    kinds = [[f"p{i}one" for i in range(90)], [f"q{i}one" for i in range(90)]]
    rows = [(i, " ".join(rng.choice(kinds[k % 2]) for k in range(2 * rng.randrange(15, 40))), "en", "s") for i in range(150)]
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1
    found = [r for r in class_model.score_texts(table(spark, rows).repartition(3), held, top_words=8, classes=8).collect() if r["held_out"]]
    # Knowing which of two kinds of 90 words comes next is worth log10(2) a word.
    assert sum(r["score"] - r["base_score"] for r in found) > 0.25 * sum(r["n_tokens"] for r in found)


def test_class_model_keeps_no_keys_or_lines_once_they_are_read(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "checkpoint_folder", lambda _: str(tmp_path))
    rng = random.Random(12)
    rows = [(i, " ".join(f"w{rng.randrange(5000)}" for _ in range(300)), "en", "s") for i in range(300)]
    found = class_model.score_texts(table(spark, rows).repartition(3), F.lit(False), top_words=8, classes=8)
    left = {p.name.rsplit("-", 1)[0]: sum(f.stat().st_size for f in p.rglob("*.parquet")) for p in (tmp_path / "qaspark").iterdir()}
    assert set(left) == {"batches", "word-numbers", "class-tally"}
    # Three batches ask for nearly all of 5,000 words: 8 bytes each once, not for every batch.
    assert left["word-numbers"] < 2 * 8 * 5000
    assert found.count() == len(rows) and all(r["n_known"] == r["n_tokens"] for r in found.collect())


def test_exchange_finds_planted_classes_and_never_loses_likelihood():
    rng = np.random.default_rng(9)
    group = np.arange(40) % 4
    pairs = np.where((group[:, None] + 1) % 4 == group[None, :], rng.integers(20, 60, (40, 40)), rng.integers(0, 3, (40, 40)))
    pairs = np.pad(pairs, ((0, 1), (0, 1)))
    of = class_model.exchange(pairs, classes=5)
    assert all(len(set(of[:40][group == g])) == 1 for g in range(4)) and len(set(of[:40])) == 4 and of[40] == 4
