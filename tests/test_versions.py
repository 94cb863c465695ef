from datetime import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from qaspark.sources import responses, versions


def now():
    return F.lit("2024-01-31 00:00:00").cast("timestamp")


def numbers(spark, *xs):
    return spark.createDataFrame([("go" if x % 2 else "c", x) for x in xs], "language string, n long")


def found(spark, root, version=None):
    return sorted(r.n for r in versions.read_version(spark, root, version).collect())


def test_a_table_is_rewritten_from_itself(spark, tmp_path):
    root = str(tmp_path / "t")
    versions.replace_table(numbers(spark, 1, 2, 3), root)
    held = versions.read_version(spark, root)
    versions.replace_table(held.withColumn("n", F.col("n") * 10), root)
    versions.replace_table(versions.read_version(spark, root).where("n > 10"), root)
    assert found(spark, root) == [20, 30] and found(spark, root, 2) == [10, 20, 30]
    assert sorted(r.n for r in held.collect()) == [1, 2, 3]
    assert versions.forget_versions(spark, root, keep=1) == 2
    assert versions.versions(spark, root) == [3] and found(spark, root) == [20, 30]
    assert len(list((tmp_path / "t").glob("data-*"))) == 1
    with pytest.raises(FileNotFoundError):
        versions.read_version(spark, root, 1)


def test_a_failed_write_leaves_the_old_version(spark, tmp_path):
    root = str(tmp_path / "t")
    versions.replace_table(numbers(spark, 1, 2), root)
    broken = versions.read_version(spark, root).withColumn("n", F.when(F.col("n") == 2, F.raise_error(F.lit("broken"))).otherwise(F.col("n")).cast("long"))
    with pytest.raises(PySparkException):
        versions.replace_table(broken, root)
    assert versions.versions(spark, root) == [1] and found(spark, root) == [1, 2]
    assert len(list((tmp_path / "t").glob("data-*"))) == 1


def test_of_two_writers_one_succeeds(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "t")
    versions.replace_table(numbers(spark, 1), root)
    before = versions.versions(spark, root)
    versions.replace_table(numbers(spark, 2), root)
    real, calls = versions.versions, []

    def late(*args):
        calls.append(1)
        return before if len(calls) == 1 else real(*args)

    monkeypatch.setattr(versions, "versions", late)
    with pytest.raises(versions.Conflict):
        versions.replace_table(numbers(spark, 3), root)
    monkeypatch.undo()
    assert found(spark, root) == [2] and len(list((tmp_path / "t").glob("_draft*"))) == 0


def test_the_gate_refuses(spark, tmp_path):
    root = str(tmp_path / "t")
    assert versions.replace_table(numbers(spark, 1, 2, 3), root, "language", {"go": 2, "c": 1}) == {"go": 2, "c": 1}
    with pytest.raises(versions.Refused, match="java"):
        versions.replace_table(numbers(spark, 5, 7), root, "language", {"go": 1, "java": 1})
    with pytest.raises(versions.Refused, match="'go': 1"):
        versions.replace_table(numbers(spark, 5), root, "language", {"go": 2})
    assert found(spark, root) == [1, 2, 3] and len(list((tmp_path / "t").glob("data-*"))) == 1


def log(spark, *rows):
    return spark.createDataFrame([(k, v, datetime(2024, 1, d)) for k, v, d in rows], "key string, value string, created_at timestamp")


def test_upsert_rewrites_only_what_it_touches(spark, tmp_path):
    root = str(tmp_path / "t")
    first = log(spark, *[(f"k{i}", "old", 20) for i in range(40)], ("gone", "x", 2), (None, "null", 20))
    assert len(versions.upsert(first, root, now(), ttl_days=15, buckets=8)) == 8
    files = versions._manifest(spark, root)["parts"]
    late, new = ("k1", "late", 19), ("k2", "new", 25)
    touched = versions.upsert(log(spark, late, new, ("k2", "older", 24)), root, now(), ttl_days=15, buckets=99)
    after = versions._manifest(spark, root)["parts"]
    assert 1 <= len(touched) <= 2 and {p for p in after if after[p] != files[p]} == {str(b) for b in touched}
    got = {r.key: r.value for r in versions.read_current(spark, root, now(), ttl_days=15).collect()}
    assert got == {**{f"k{i}": "old" for i in range(40)}, "k2": "new", None: "null"}
    versions.upsert(log(spark, late, new), root, now(), ttl_days=15)
    assert {r.key: r.value for r in versions.read_current(spark, root, now(), ttl_days=15).collect()} == got
    versions.forget_versions(spark, root, keep=1)
    assert {r.key: r.value for r in versions.read_version(spark, root).collect()} == got
    with pytest.raises(ValueError, match="table"):
        versions.upsert(numbers(spark, 1), root, now(), ["language"])


def test_upsert_drops_what_is_too_old_and_takes_empty_batches(spark, tmp_path):
    root = str(tmp_path / "t")
    assert versions.upsert(log(spark), root, now()) == []
    assert versions.read_current(spark, root, now()).count() == 0
    versions.upsert(log(spark, ("a", "x", 2)), root, now(), ttl_days=5)
    assert versions.read_version(spark, root).count() == 0
    versions.upsert(log(spark, ("a", "x", 2)), root, now(), ttl_days=None)
    assert versions.read_version(spark, root).count() == 1 and versions.read_current(spark, root, now(), ttl_days=5).count() == 0


def test_page_chains(spark):
    def page(tag, number, more=True, items=1, quota=5):
        return (tag, 0, 9, number, [(i,) for i in range(items)], more, quota)

    rows = [
        *[page("whole", i, i < 3) for i in (1, 2, 3)],
        page("gap", 2), page("gap", 4, quota=1), page("gap", 4), page("gap", 6, False),
        page("open", 1), page("open", 2, items=0),
        page("beyond", 1), page("beyond", 2, None), page("beyond", 3), page("beyond", 3), page("beyond", 5, False),
        page(None, 1, False), page("none", None), page("none", 0),
    ]
    pages = spark.createDataFrame(rows, "tag string, fromdate long, todate long, page long, items array<struct<id: long>>, has_more boolean, quota_remaining long")
    got = {r.tag: tuple(r)[3:] for r in responses.page_chains(pages).collect()}
    assert got == {
        "whole": (3, 0, 3, 0, None, 0, 3, 5, True),
        "gap": (3, 1, 6, 3, 1, 0, 4, 1, False),
        "open": (2, 0, None, 0, None, 0, 1, 5, False),
        "beyond": (4, 1, 2, 0, None, 2, 5, 5, True),
        None: (1, 0, 1, 0, None, 0, 1, 5, True),
    }
    assert responses.page_chains(pages.limit(0)).count() == 0
