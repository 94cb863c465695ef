"""Ranked search against a plain scoring of every document."""

import collections
import math
import random
import re

import duckdb
import numpy as np
import pytest

from qaspark.llm import queries, ranked_search
from qaspark.llm.oracle import ORACLE
from qaspark.llm.ranked_search import Lists, best_by_intervals, rank_documents, read_block, terms_of

SMALL = "/root/testdata/sf0.001"


def plain_terms(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lowered)


def plain(docs, items, k=10):
    counted = [(i, collections.Counter(plain_terms(t))) for i, t in docs]
    n_docs, total = sum(1 for _, c in counted if c), sum(sum(c.values()) for _, c in counted)
    df = collections.Counter(t for _, c in counted for t in c)
    asked = collections.defaultdict(collections.Counter)
    for i, t in items:
        asked[i].update(plain_terms(t))
    out = []
    for item, query in asked.items():
        scores = []
        for i, c in counted:
            m = 100 - 75 + 75 * sum(c.values()) * n_docs // total if total else 0
            s = sum(
                times * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m)) for t, times in query.items() if t in c
            )
            if s > 0:
                scores.append((-s, i is not None, i or 0))
        out += [(item, r + 1, i if known else None, -s) for r, (s, known, i) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))


def test_terms():
    text = "It's A-B\x00c é日本·x１2 ZÉ_q\x7f9"
    assert [t.decode() for t in terms_of(text.encode())] == plain_terms(text)


def awkward(seed):
    rng = random.Random(seed)
    words = ["the", "of", "a", *(f"w{i}" for i in range(40)), "É", "é", "日本", "Ab", "aB"]
    prose = lambda n: " ".join(rng.choice(words[: rng.choice([3, 10, 50])]) for _ in range(rng.randint(0, n)))
    docs = [(i, prose(30)) for i in range(200)] + [(900, None), (901, ""), (902, "--- ..."), (None, "w1 w2 w3"), (903, "the " * 20_000)]
    docs += [(1000 + i, docs[5][1]) for i in range(40)] + [(7, docs[7][1])]
    items = [(i, prose(12)) for i in range(30)] + [(50, None), (51, "nowhere"), (None, "w1 w1 the"), (52, docs[5][1] or "w5"), (3, "w9 w9 the"), (53, "the")]
    return docs, items


@pytest.mark.parametrize("seed", range(2))
@pytest.mark.parametrize("slice_terms", [500_000, 20])
def test_awkward_rows(spark, monkeypatch, seed, slice_terms):
    monkeypatch.setattr(ranked_search, "BLOCK_DOCS", 20)
    monkeypatch.setattr(ranked_search, "STRETCH", 2)
    docs, items = awkward(seed)
    left = spark.createDataFrame([(i, t, 1, "t") for i, t in docs], "doc_id long, text string, rank int, term string").repartition(3)
    right = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id int")
    assert result(rank_documents(left, right, slice_terms=slice_terms)) == plain(docs, items)
    assert rank_documents(left.where("false"), right).collect() == [] and rank_documents(left, right.where("false")).collect() == []


def test_reading_ends_early_when_a_block_cannot_reach_the_best():
    rng = np.random.default_rng(1)
    found = [np.unique(rng.integers(0, 30, 6)) for _ in range(4000)]
    lists = Lists(read_block(list(range(4000)), found, [len(x) for x in found], 30), np.arange(100, 130), 4000, 24_000, 75)
    query = [(t, 1) for t in range(8)]
    everything = sum(b - a for a, b in (lists.run[t] for t, _ in query))
    places, scores, read = best_by_intervals(lists, query, 10)
    exact = np.zeros(4000, np.int64)
    for t, times in query:
        a, b = lists.run[t]
        exact[lists.places[a:b]] += lists.impact[a:b] * times
    assert set(places) == set(np.flatnonzero(exact >= np.sort(exact)[-10])) and np.array_equal(scores, exact[places])
    assert read <= everything
    top = int(np.sort(exact)[-1])
    assert best_by_intervals(lists, query, 10, 8 * top)[2] == 0
    high = best_by_intervals(lists, query, 10, top)
    assert set(high[0]) == set(np.flatnonzero(exact == top)) and high[2] <= read


def test_registered_query_and_sql(spark):
    docs = [tuple(r) for r in queries.documents(spark, SMALL).select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    found = result(queries.op13_ranked_search(spark, SMALL))
    assert found == plain(docs, items)
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    assert sorted(con.execute(ORACLE["op13_ranked_search"]).fetchall()) == found
