import numpy as np
import pytest
from pyspark.sql import functions as F

from qaspark.operators import profile
from qaspark.operators.quantiles import exact_quantiles

WANTED = {"q0": ("x", 0.0), "q25": ("x", 0.25), "med": ("x", 0.5), "q90": ("x", 0.9), "q1": ("x", 1.0), "y_med": ("y", 0.5)}


def shapes():
    rng = np.random.default_rng(5)
    return {
        "normal": rng.normal(size=3001) * 100,
        "tails": np.exp(rng.normal(size=2000) * 12),
        "ties": rng.integers(0, 4, 5000).astype(float),
        "one": np.array([7.25]),
        "two": np.array([-1.0, 2.0]),
        "same": np.full(500, 3.5),
        "signs": np.concatenate([-np.exp(rng.normal(size=400) * 5), np.exp(rng.normal(size=401) * 5), [0.0, -0.0]]),
        "tiny": rng.uniform(0, 1e-9, 1500),
    }


def test_against_numpy(spark):
    data = shapes()
    rows = [(k, float(v), float(-v)) for k, values in data.items() for v in values] + [("normal", None, None), ("gone", None, None), (None, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "k string, x double, y double").repartition(7)
    got = {r.k: r for r in exact_quantiles(df, ["k"], WANTED).collect()}
    assert set(got) == set(data)
    for k, values in data.items():
        for name, (column, p) in WANTED.items():
            source = values if column == "x" else -values
            expected = np.median(source) if p == 0.5 else np.quantile(source, p)
            assert got[k][name] == pytest.approx(expected, rel=1e-12, abs=1e-300), (k, name)


def test_median_is_the_mean_of_the_middle(spark):
    df = spark.createDataFrame([("a", 0.1), ("a", 0.2)], "k string, x double")
    assert exact_quantiles(df, ["k"], {"m": ("x", 0.5)}).first().m == (0.1 + 0.2) / 2


def test_crowded_brackets_are_narrowed_and_lost_ranks_found(spark, monkeypatch):
    from qaspark.operators import quantiles

    data = {"a": np.random.default_rng(6).normal(size=30_000), "b": np.full(4000, 2.0), "c": np.arange(9000.0)}
    df = spark.createDataFrame([(k, float(v)) for k, values in data.items() for v in values], "k string, x double").repartition(3)

    def check():
        for r in exact_quantiles(df, ["k"], {"q": ("x", 0.3), "m": ("x", 0.5)}).collect():
            assert (r.q, r.m) == pytest.approx((np.quantile(data[r.k], 0.3), np.median(data[r.k])), rel=1e-12)

    monkeypatch.setattr(quantiles, "MOST_INSIDE", 50)
    check()
    monkeypatch.setattr(quantiles, "MOST_INSIDE", 10**9)
    monkeypatch.setattr(quantiles, "SLACK", 1e-7)
    check()


def test_one_group_holding_most_rows_stays_spread(spark):
    """No stage sorts a whole group: the windows are over buckets or over one bucket's values."""
    df = spark.range(40000).selectExpr("if(id % 3 < 2, 'hot', cast(id % 50 as string)) AS k", "cast(id * 7919 % 40009 as double) AS x")
    got = {r.k: r.m for r in exact_quantiles(df, ["k"], {"m": ("x", 0.5)}).collect()}
    expected = {r.k: r.m for r in df.groupBy("k").agg(F.median("x").alias("m")).collect()}
    assert got == expected


def test_describe_and_nulls(spark):
    df = spark.createDataFrame([(1.0, "a"), (2.0, None), (4.0, None), (None, "b")], "x double, s string")
    r = profile.describe(df, ["x"]).first()
    assert (r["count"], r.mean, r.min, r.q25, r.q50, r.q75, r.max) == (3, 2.3, 1.0, 1.5, 2.0, 3.0, 4.0)
    assert {(r.column, r.type, r.nulls) for r in profile.null_profile(df).collect()} == {("x", "double", 1), ("s", "string", 2)}


def test_pivot_keeps_absent_cells_null(spark):
    df = spark.createDataFrame([(2020, "go"), (2020, "go"), (2021, "java")], "year int, language string")
    rows = {r.year: (r.go, r.java) for r in profile.count_pivot(df, ["go", "java"]).collect()}
    assert rows == {2020: (2, None), 2021: (None, 1)}


def test_box_whiskers(spark):
    values = [1.0, 2.0, 3.0, 4.0, 5.0, 19.0, 500.0, -50.0]
    df = spark.createDataFrame([("go", v) for v in values], "language string, score double")
    r = profile.box_stats(df).first()
    clipped = np.clip(values, -5, 20)
    q1, q3 = np.quantile(clipped, [0.25, 0.75])
    inside = [v for v in clipped if q1 - 1.5 * (q3 - q1) <= v <= q3 + 1.5 * (q3 - q1)]
    assert (r.q1, r.q3, r.whisker_low, r.whisker_high, r.outliers) == (q1, q3, min(inside), max(inside), len(values) - len(inside))


def test_cluster_quality_and_required_languages(spark):
    df = spark.createDataFrame([("go", -1), ("go", 0), ("go", 0), ("go", 1), ("java", -1)], "language string, cluster_id int")
    rows = {r.language: (r.n_clusters, r.noise_ratio) for r in profile.cluster_quality(df).collect()}
    assert rows == {"go": (2, 0.25), "java": (0, 1.0)}
    counts = {r.language: r.n_rows for r in profile.require_languages(df, ["go", "python"]).collect()}
    assert counts == {"go": 4, "python": 0}
