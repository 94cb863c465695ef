"""The corpus pipeline, stage by stage, against plain versions; the registered queries against their SQL."""

import collections
import hashlib
import os

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from checks import compare
from qaspark.llm.queries import ORACLE, QUERIES
from tests.llm.test_number_operators import check_packing, plain_targets
from tests.llm.test_text_operators import plain_components, plain_line_dedup, prose, words

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, copies string, kept string, _id string"


def plain_copies(rows):
    """How often mixing takes each document: whole epochs, and once more if at least half lies before the cut."""
    sizes = {s: sum(len(words(t)) for _, t, _, x in rows if x == s) for s in {r[3] for r in rows}}
    target, out = plain_targets(sizes), collections.Counter()
    for source, total in sizes.items():
        budget = int(target[source] + 0.5)
        mine = sorted((hashlib.md5(f"mix:{'' if i is None else i}".encode()).hexdigest(), i, len(words(t))) for i, t, _, s in rows if s == source)
        passes, place = (budget // total if total else 0), 0
        for _, i, n in mine:
            taken = n * passes + min(max(budget - passes * total - place, 0), n)
            place += n
            out[i] += int(taken / n + 0.5) if n else 1
    return +out


def columns(df):
    return [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in df.collect()]


def check_stages(spark, df, tmp_path):
    docs, seen = df, {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = f"{tmp_path}/{k}-{name}"
        before = columns(docs)
        stage(spark, docs, FOLDER).write.parquet(path)
        docs = spark.read.parquet(path)
        if name != "packing":
            assert docs.columns == corpus_pipeline.COLUMNS
            after = seen[name] = columns(docs)
        if name == "language_id":
            assert {i for i, *_ in before} - {i for i, *_ in after} == {i for i, t, *_ in before if not any(c.isalpha() for c in t or "")}
        elif name == "line_dedup":
            assert sorted((r[:2] for r in after), key=str) == sorted(((i, t) for i, t, _ in plain_line_dedup(before, 10)), key=str)
        elif name == "near_dedup":
            # Rows that share an id or have none are judged in the operator's own tests.
            root = plain_components([r for r in before if r[0] is not None], 5, 80)
            assert sorted(after, key=str) == sorted((r for r in before if r[0] is None or root[r[0]][1] == r[0]), key=str)
        elif name == "mixing":
            assert collections.Counter(i for i, *_ in after) == plain_copies(before)
        else:
            assert check_packing(docs.collect(), before, 2048) < 0.2
    return seen


def test_pipeline_on_the_given_documents(spark, tmp_path):
    seen = check_stages(spark, spark.read.parquet(f"{FOLDER}/documents.parquet"), tmp_path)
    n = {k: len(v) for k, v in seen.items()}
    assert n["language_id"] == 200 and n["near_dedup"] < n["line_dedup"]


def test_pipeline_on_awkward_documents(spark, tmp_path):
    import random

    rng = random.Random(12)
    rows = [(i, prose(rng, rng.randrange(1, 90)).replace("w", "ab"), ["en", "de"][i % 2], ["a", "b", None][i % 3]) for i in range(40)]
    rows += [(100, None, "en", "a"), (101, "", "en", "a"), (102, " \n", None, None), (103, "12 34 !", "en", "b"), (104, rows[3][1], "en", "b"), (105, "abc " * 30_000, None, "c")]
    df = spark.createDataFrame([(*r, len(r[1] or ""), "c", "k", "u") for r in rows], SCHEMA)
    check_stages(spark, df, tmp_path)
    empty = df.where("false")
    for name, stage in corpus_pipeline.STAGES:
        found = stage(spark, empty, FOLDER)
        assert found.count() == 0
        if name != "packing":
            assert found.columns == corpus_pipeline.COLUMNS


def test_language_stage_drops_gibberish_and_unlearned_languages(spark):
    import random

    rng = random.Random(13)
    vocabulary = {"en": "the river runs under old stone bridges while farmers carry their bread home before winter comes".split()}
    vocabulary["de"] = "der fluss zieht unter alten steinernen brücken und bauern tragen ihr brot nach hause bevor es schneit".split()
    text = lambda lang, n: " ".join(rng.choice(vocabulary[lang]) for _ in range(n))
    rows = [(i, text(["en", "de"][i % 2], rng.randrange(3, 120)), ["en", "de"][i % 2], "a") for i in range(600)]
    rows += [(1000, "".join(rng.choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ+/") for _ in range(400)), None, "a")]
    rows += [(1001, "Η γλώσσα αυτή δεν διδάχθηκε ποτέ και δεν μοιάζει με καμία άλλη από αυτές", None, "a"), (1002, "Příliš žluťoučký kůň úpěl ďábelské ódy a nikdo mu neřekl kudy vede cesta domů", None, "a")]
    rows += [(1003, "the old river", None, "a"), (1004, "brot nach hause", None, "a"), (1005, "stone bridges", None, "a")]
    df = spark.createDataFrame([(*r, len(r[1]), "c", "k", "u") for r in rows], SCHEMA)
    kept = {r["doc_id"]: r["lang"] for r in corpus_pipeline.identify_language(spark, df, FOLDER).collect()}
    assert {i for i, *_ in rows} - set(kept) == {1000, 1001, 1002}
    assert [kept[i] for i in (1003, 1004, 1005)] == ["en", "de", "en"]


def test_registry():
    names = set(entry.queries())
    assert {q.split("_")[0] for q in QUERIES} == {f"op{k}" for k in range(1, 14)} and {*QUERIES, "pipeline"} <= names
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "near_dedup", "mixing", "packing"]


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_agrees_with_its_sql(spark, name, monkeypatch):
    monkeypatch.setattr(compare, "ORACLE", ORACLE)
    df = QUERIES[name](spark, FOLDER)
    assert compare.difference(df, compare.connect(FOLDER), name) is None
    assert "CartesianProduct" not in df._jdf.queryExecution().executedPlan().toString()
