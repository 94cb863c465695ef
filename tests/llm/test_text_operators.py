"""Language ID, line dedup, near-duplicates and passages against plain versions, with awkward rows."""

import collections
import functools
import math
import os
import random
import re
import unittest.mock
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from qaspark import session
from qaspark.llm import components, language_id, line_dedup, memory, minhash, passages, queries
from qaspark.llm.words import Words

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, score double, kept string, id string, n string, _id string, key string, n_removed string"


def table(spark, rows):
    """``rows`` of (doc_id, text, lang, source), with columns whose names clash with those of the operators."""
    return spark.createDataFrame([(*r, 0.5, "x", "i", "n", "u", "k", "r") for r in rows], DOCS)


def words(text):
    return WORD.findall(text or "")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def test_words_hashes_depend_on_the_word_only():
    a, b = Words([b"one  two\tone", None, b"", b" \n "]), Words([b"x" * 3_000_000 + b" two", b"one"])
    assert a.n_words.tolist() == [3, 0, 0, 0] and [a.word(i) for i in range(3)] == [b"one", b"two", b"one"]
    assert a.hashes()[0] == a.hashes()[2] == b.hashes()[2] and a.hashes()[1] == b.hashes()[1]
    assert len(set(Words([b"a", b"b", b"ab", b"ba", "é".encode(), b"\x0b"]).hashes().tolist())) == 5
    found, at = Words([b"a b c d", b"a b c"]).grams(3)
    assert at.tolist() == [0, 1, 4] and found[0] == found[2] != found[1]


# --- language identification


def labelled(n=60):
    rng = random.Random(1)
    letters = {"aa": "abcde ", "bb": "vwxyz ", "cc": "abxyé "}
    return [(i, "".join(rng.choice(letters[lang]) for _ in range(80)), lang, "s") for i in range(n) for lang in [sorted(letters)[i % 3]]]


def test_language_held_out_accuracy_and_awkward_rows(spark):
    rows = labelled()
    model = language_id.train(table(spark, rows[:45] + [(900, None, "aa", "s"), (901, "abc", None, "s"), (902, "123", "zz", "s")]))
    assert model["languages"] == ["aa", "bb", "cc"]
    long = rows[45][1] * 20_000
    asked = rows[45:] + [(1, None, "aa", "s"), (2, "", "aa", "s"), (3, "12 .,! \n", "aa", "s"), (None, long, "aa", "s"), (5, rows[46][1], "bb", "s"), (5, rows[46][1], "bb", "s")]
    found = language_id.identify(table(spark, asked), model).select("doc_id", "lang_pred", "score", "kept", "lang").collect()
    assert len(found) == len(asked)
    for row, (i, text, lang, _) in zip(sorted(found, key=str), sorted(asked, key=lambda r: str(r[0]))):
        assert 0 <= row["score"] <= 1 and row["kept"] == "x"
    right = [r for r in found if r["doc_id"] is not None and r["doc_id"] >= 45]
    assert all(r["lang_pred"] == r["lang"] for r in right)
    assert [r["lang_pred"] for r in found if r["doc_id"] in (1, 2, 3)] == ["und"] * 3
    assert [r["lang_pred"] for r in found if r["doc_id"] is None] == [rows[45][2]]


def buckets(blocks, n_texts):
    out = [collections.Counter() for _ in range(n_texts)]
    for bucket, owner in blocks:
        for k in range(n_texts):
            out[k].update(bucket[owner == k].tolist())
    return out


@pytest.mark.parametrize("size", [1, 2, 3, 7, 20, 1000])
def test_language_features_do_not_depend_on_the_cut(size):
    rng = random.Random(2)
    texts = ["".join(rng.choice("abÉΣσİß .,1\n\0\u4e2d") for _ in range(rng.randrange(60))) for _ in range(30)] + [None, "", "   ", "a" * 50, " " * 50 + "ab", "ab" + "." * 50 + "c"]
    whole = buckets([language_id.features(texts)], len(texts))
    assert buckets(language_id.feature_blocks(texts, block_chars=size), len(texts)) == whole
    assert whole == [buckets([language_id.features([t])], 1)[0] for t in texts]


def grams(text):
    """Plain n-grams of one to three characters that hold a letter."""
    line = " " + "".join(c if c.isalpha() else " " for c in (text or "").lower()) + " "
    line = re.sub(" +", " ", line)
    return [g for n in (1, 2, 3) for g in (line[i : i + n] for i in range(len(line) - n + 1)) if g != " "]


@functools.cache
def bucket_of(gram):
    h = 0
    for n, c in enumerate(gram, 1):
        h = ((h ^ ord(c)) * 0x9E3779B1 + n) % 2**32
    return ((h ^ (h >> 15)) * 0x85EBCA6B % 2**32) >> (32 - language_id.BITS)


def plain_bayes(learned, asked):
    """``(language, posterior)`` of each text by multinomial naive Bayes over the buckets, smoothed by a half."""
    counts = collections.defaultdict(collections.Counter)
    for text, lang in learned:
        if text is not None and lang is not None:
            counts[lang].update(bucket_of(g) for g in grams(text))
    counts = {lang: c for lang, c in sorted(counts.items()) if c}
    size = 2**language_id.BITS
    total = {lang: sum(c.values()) + size / 2 for lang, c in counts.items()}
    out = []
    for text in asked:
        seen = collections.Counter(bucket_of(g) for g in grams(text))
        sums = {lang: sum(n * round(math.log((c[b] + 0.5) / total[lang]) * 65536) for b, n in seen.items()) / 65536 for lang, c in counts.items()}
        best = max(sums, key=sums.get) if seen else "und"
        out.append((best, 1 / sum(math.exp(x - sums[best]) for x in sums.values()) if seen else 0.0))
    return out


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test tables")
def test_language_query_equals_plain_bayes(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    one = docs.where("text is not null and lang is not null").orderBy("doc_id").first()
    long = one.text[:3000] * (1_300_000 // len(one.text[:3000]) + 1)
    last = docs.agg(F.max("doc_id")).first()[0]
    extra = [(last + 1 + i, long, one.lang, one.source, len(long)) for i in range(2)] + [(last + 3, None, None, None, 0), (last + 4, " 1 ", "en", None, 3), (last + 5, "x", None, None, 1)]
    docs.unionByName(spark.createDataFrame(extra, docs.schema)).write.parquet(f"{tmp_path}/documents.parquet")
    rows = spark.read.parquet(f"{tmp_path}/documents.parquet").collect()
    held = [zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in rows]
    found = {r.doc_id: r for r in queries.op2_language_id(spark, str(tmp_path)).collect()}
    assert len(found) == len(rows) and 0 < sum(held) < len(rows)
    expected = plain_bayes([(r.text, r.lang) for r, h in zip(rows, held) if not h], [r.text for r in rows])
    for row, h, (lang, score) in zip(rows, held, expected):
        got = found[row.doc_id]
        assert (got.held_out, got.lang_pred) == (h, lang) and got.score == pytest.approx(score, abs=1e-9)


@pytest.mark.parametrize("bound", [1, 7, 20])
def test_language_learns_from_as_many_rows_as_the_bound_says(spark, bound):
    # Every row has a letter of its own: the counts of single letters tell which rows were learned.
    rows = [(i, chr(0x4E00 + i), lang, "s") for i in range(30) for lang in ("aa", "bb")] + [(None, chr(0x5E00), "aa", "s")] * 2
    model = language_id.train(table(spark, rows), rows_per_language=bound)
    least = model["weights"].min(axis=1, keepdims=True)
    learned = [sum(w[bucket_of(chr(0x4E00 + i))] > low[0] for i in range(30)) + (w[bucket_of(chr(0x5E00))] > low[0]) for w, low in zip(model["weights"], least)]
    assert learned == [bound, bound]


def test_language_model_learns_from_every_labelled_row(spark):
    rows = [(i, f"{chr(0x4E00 + i)} word", "aa", "s") for i in range(4500)] + [(5000, "other", "bb", "s")]
    every = language_id.train(table(spark, rows))
    named = language_id.train(table(spark, rows), rows_per_language=4501)
    fewer = language_id.train(table(spark, rows), rows_per_language=4000)
    assert (every["weights"] == named["weights"]).all()
    assert (every["weights"] != fewer["weights"]).any()


def test_language_without_labels_or_rows(spark):
    nothing = language_id.train(table(spark, [(1, "abc", None, "s")]))
    assert [r["lang_pred"] for r in language_id.identify(table(spark, [(1, "abc", "aa", "s")]), nothing).collect()] == ["und"]
    assert language_id.identify(table(spark, []), nothing).count() == 0


# --- line dedup


def plain_line_dedup(rows, min_sites):
    sites = collections.defaultdict(set)
    bare = lambda x: x.strip(" \t\x0b\x0c\r")
    for _, text, _, source in rows:
        for line in (text or "").split("\n"):
            if bare(line) and source is not None:
                sites[bare(line)].add(source)
    out = []
    for i, text, _, _ in rows:
        parts = (text or "").split("\n")
        hit = [len(sites.get(bare(x), ())) >= min_sites for x in parts]
        cut = any(hit) and any(bare(x) and not h for x, h in zip(parts, hit))
        out.append((i, "\n".join(x for x, h in zip(parts, hit) if not h) if cut else text, sum(hit) if cut else 0))
    return sorted(out, key=str)


def test_line_dedup_equals_plain_counts(spark):
    rng = random.Random(2)
    common = [f"boilerplate {k}" for k in range(8)]
    rows = []
    for i in range(220):
        lines = [prose(rng, 6) for _ in range(rng.randrange(1, 5))] + rng.sample(common[: 1 + i % 8], rng.randrange(0, 2))
        rng.shuffle(lines)
        rows.append((i, "\n".join(lines), "en", f"s{rng.randrange(14)}"))
    # One line on a third of all rows, but of a single site; copies of a page on all sites; awkward rows.
    rows += [(1000 + i, f"hot line\n{prose(rng, 9)}", "en", "s1") for i in range(100)]
    rows += [(2000 + i, "a page\ncopied all over", "en", f"s{i}") for i in range(14)]
    # Nearly all boilerplate, with a word of its own: cut all the same.
    rows += [(2500, "\n".join([*common, "own", *common]), "en", "s2"), (2501, "a page\n\n \ncopied all over", "en", "s3")]
    rows += [(3000, None, "en", "s0"), (3001, "", "en", "s1"), (3002, " \n\t\n", "en", "s2"), (None, "boilerplate 0 \n" + prose(rng, 30), "en", None)]
    rows += [(5, rows[5][1], "en", rows[5][3])]
    df = table(spark, rows)
    found = line_dedup.remove_boilerplate(df, min_sites=6)
    assert found.columns == [*[c for c in df.columns if c != "n_removed"], "n_removed"]
    assert sorted(((r["doc_id"], r["text"], r["n_removed"]) for r in found.collect()), key=str) == plain_line_dedup(rows, 6)
    assert line_dedup.remove_boilerplate(table(spark, [])).count() == 0


# --- near-duplicates


def plain_components(rows, n, percent):
    sets = {}
    for i, text, *_ in rows:
        w = words(lowered(text))
        sets[i] = {tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))} if w else set()
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for x in range(len(ids)):
        for y in range(x):
            a, b = sets[ids[x]], sets[ids[y]]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                p, q = find(ids[x]), find(ids[y])
                parent[max(p, q)] = min(p, q)
    return {i: (len(sets[i]), find(i)) for i in ids}


def near_copies(seed=3):
    rng = random.Random(seed)
    rows, i = [], 0
    for group in range(12):
        base = prose(rng, rng.choice([3, 9, 40, 150, 300]), 5000).split()
        for _ in range(rng.randrange(2, 9)):
            copy = list(base)
            for _ in range(rng.randrange(0, 1 + len(copy) // 30)):
                copy[rng.randrange(len(copy))] = f"e{rng.randrange(9999)}"
            rows.append((i, " ".join(copy), "en", "s"))
            i += 1
    # A star: every copy is near its base, many copies are not near each other.
    base = prose(rng, 200, 9000).split()
    for k in range(25):
        copy = list(base)
        for p in range(4):
            copy[(k * 8 + p * 41) % 200] = f"star{k}-{p}"
        rows.append((i, " ".join(copy), "en", "s"))
        i += 1
    rows.append((i, " ".join(base), "en", "s"))
    rng.shuffle(rows)
    return rows


def test_near_duplicates_equal_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK_DOCS", 4)
    rows = near_copies() + [(500, None, "en", "s"), (501, "", "en", "s"), (502, " \n", "en", "s"), (503, "One Two", "en", "s"), (504, "one\ttwo", "en", "s"), (505, "two one", "en", "s")]
    want = plain_components(rows, 4, 80)
    assert len({c for _, c in want.values()}) < len(rows) - 30
    found = minhash.near_duplicates(table(spark, rows), n=4).collect()
    assert len(found) == len(rows)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found)


def test_near_duplicates_with_repeated_and_null_ids(spark):
    text = prose(random.Random(4), 50)
    rows = [(7, text, "en", "s"), (7, text, "en", "s"), (3, text, "en", "s"), (None, text, "en", "s"), (9, "other words", "en", "s")]
    found = sorted(((r["doc_id"], r["component_id"], r["kept"]) for r in minhash.near_duplicates(table(spark, rows)).collect()), key=str)
    assert found == sorted([(7, 3, False), (7, 3, False), (3, 3, True), (None, None, True), (9, 9, True)], key=str)
    assert minhash.near_duplicates(table(spark, [])).count() == 0
    alone = minhash.near_duplicates(table(spark, [(1, "a b c", "en", "s"), (2, None, "en", "s")])).collect()
    assert sorted((r["doc_id"], r["component_id"]) for r in alone) == [(1, 1), (2, 2)]


def test_signature_borrows_the_same_value_for_equal_sets_and_estimates_similarity():
    rng = np.random.default_rng(5)
    a = np.sort(rng.integers(0, 2**63, 40, dtype=np.uint64) * np.uint64(2))
    b = np.sort(np.concatenate((a[:36], rng.integers(0, 2**63, 4, dtype=np.uint64))))
    assert (minhash.signature(a, 448) == minhash.signature(a.copy(), 448)).all()
    assert abs((minhash.signature(a, 448) == minhash.signature(b, 448)).mean() - 36 / 44) < 0.12
    assert len(set(minhash.signature(a[:1], 448).tolist())) == 1


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(70)] + [(200, 300), (5, 5)], "a long, b long")
    found = {r["node"]: r["component"] for r in components.components(links).collect()}
    assert found == {**{i: 0 for i in range(71)}, 200: 200, 300: 200}
    # The most rows that the links can have only deals them to fewer files.
    assert found == {r["node"]: r["component"] for r in components.components(links, 72).collect()}


def test_batches_are_taken_in_small_slices(monkeypatch):
    given = []
    monkeypatch.setattr(memory, "give_back", lambda: given.append(1))
    texts = ["a" * 40, None, "", "é" * 30, "b" * 500, "c"]
    batch = pa.record_batch({"id": pa.array(range(6)), "text": pa.array(texts, pa.string())})
    parts = list(memory.slices(iter([batch, batch.slice(0, 0), batch.slice(3)]), 1, 100))
    assert [p.column(1).to_pylist() for p in parts] == [texts[:4], texts[4:5], texts[5:], texts[3:4], texts[4:5], texts[5:]]
    assert [i for p in parts for i in p.column(0).to_pylist()] == [0, 1, 2, 3, 4, 5, 3, 4, 5] and len(given) == 3
    # No slice of what both operators read holds more than the bound unless it is one text.
    big = pa.record_batch({"id": pa.array(range(3000)), "text": pa.array(["word " * 200] * 3000)})
    for operator in (minhash._sketches, minhash._sets_of):
        seen = []
        monkeypatch.setattr(minhash, "shingle_sets", lambda t, n: seen.append(sum(map(len, t))) or [np.arange(9, dtype=np.uint64)] * len(t))
        docs = unittest.mock.MagicMock()
        docs.select.return_value.mapInArrow = lambda run, schema: sum(b.num_rows for b in run(iter([big])))
        monkeypatch.setattr(minhash, "F", unittest.mock.MagicMock())
        assert operator(docs, "id", "text", 5, *([64, 7] if operator is minhash._sketches else [])) == 3000
        assert max(seen) <= memory.SLICE_BYTES


def test_small_tables_are_written_in_few_files(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(session, "checkpoint_folder", lambda _: str(tmp_path))
    settings = {"spark.sql.shuffle.partitions": "12", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    rows = near_copies()
    sites = [(i, f"footer {i % 40}\nown {i}", "en", f"s{i}") for i in range(600)]
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in minhash.near_duplicates(table(spark, rows), n=4).collect()}
        removed = {r["n_removed"] for r in line_dedup.remove_boilerplate(table(spark, sites)).collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert found == plain_components(rows, 4, 80) and removed == {1}
    files = collections.defaultdict(list)
    for folder in (tmp_path / "qaspark").iterdir():
        files[folder.name.rsplit("-", 1)[0]].append(len(list(folder.glob("part-*"))))
    # All but the last search for components know how many links they start from.
    assert all(files[name] and set(files[name]) == {1} for name in ("classes", "buckets", "members", "wanted", "confirmed", "rest", "links", "boilerplate")), files


# --- passages


def plain_passages(rows, n):
    first = {}
    for i, text, *_ in rows:
        w = words(text)
        if i is not None:
            for k in range(len(w) - n + 1):
                key = tuple(w[k : k + n])
                first[key] = min(first.get(key, i), i)
    out = []
    for i, text, *_ in rows:
        w = words(text)
        gone = [False] * len(w)
        for k in range(len(w) - n + 1) if i is not None else ():
            if first[tuple(w[k : k + n])] < i:
                gone[k : k + n] = [True] * n
        out.append((i, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return sorted(out, key=str)


@pytest.mark.parametrize("n", [13, 3])
def test_passages_equal_plain_removal(spark, n, monkeypatch):
    monkeypatch.setattr(passages, "BLOCK_WORDS", 100)
    rng = random.Random(6)
    shared = [prose(rng, k, 9000) for k in (12, 13, 14, 60, 200)]
    rows = []
    for i in range(90):
        parts = [prose(rng, rng.randrange(0, 40), 9000), rng.choice([*shared, ""]), prose(rng, rng.randrange(0, 9), 9000), rng.choice([*shared, ""])]
        rows.append((i, rng.choice([" ", "\n", " \t "]).join(parts), "en", "s"))
    rows += [(200 + i, rows[i][1], "en", "s") for i in range(12)]
    rows += [(300, None, "en", "s"), (301, "", "en", "s"), (302, " \n", "en", "s"), (None, shared[3], "en", "s"), (303, shared[4], "en", "s"), (303, shared[4], "en", "s"), (-1, "a " * 40, "en", "s"), (304, "Überall é " * 20, "en", "s")]
    rng.shuffle(rows)
    found = passages.remove_passages(table(spark, rows).repartition(3), n=n).collect()
    assert sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["text"]) for r in found), key=str) == plain_passages(rows, n)


def test_passages_of_nothing(spark):
    assert passages.remove_passages(table(spark, [])).count() == 0
    assert [r["n_removed"] for r in passages.remove_passages(table(spark, [(1, None, "en", "s")])).collect()] == [0]
