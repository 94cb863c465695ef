import json

import pytest
from pyspark.sql import functions as F

from qaspark.functions.numbers import round_half_up
from qaspark.operators import patterns, payload

ASSIGNED = "language string, doc_id long, cluster_id int"
WEIGHTS = "language string, doc_id long, term string, weight double"


def test_labels_use_the_mean_and_skip_language_names(spark):
    assigned = spark.createDataFrame(
        [("python", 1, 0), ("python", 2, 0), ("python", 3, -1), ("python", 4, 7), ("rust", 5, 0)], ASSIGNED
    )
    weights = spark.createDataFrame(
        [("python", 1, "python", 0.9), ("python", 1, "python numpy", 0.8), ("python", 1, "py python", 0.8), ("python", 1, "x", 0.7),
         ("python", 1, "numpy", 0.5), ("python", 2, "numpy", 0.1), ("python", 2, "numpy python", 0.4), ("python", 2, "axis", 0.4),
         ("python", 3, "noise", 0.9), ("rust", 5, "python", 0.5)],
        WEIGHTS,
    )
    rows = {(r.language, r.cluster_id): r.label for r in patterns.cluster_labels(assigned, weights).collect()}
    assert rows["python", 0] == "numpy / axis / numpy python"
    assert rows["python", -1] == "（ノイズ）"
    assert rows["python", 7] == "cluster_7"
    assert rows["rust", 0] == "python"
    two = {(r.language, r.cluster_id): r.label for r in patterns.cluster_labels(assigned, weights, n=1).collect()}
    assert two["python", 0] == "numpy"


@pytest.fixture(scope="module")
def questions(spark):
    rows = [("go", 0, i, f"t{i}", i % 5, 10 * i, i % 2 == 0) for i in range(10)]
    rows += [("go", 1, 100 + i, "u", None, 7, True) for i in range(4)] + [("go", -1, 200 + i, "n", 9, 9, False) for i in range(30)]
    rows += [("go", 2, 300 + i, "big", 1, 1, False) for i in range(25)]
    return spark.createDataFrame(
        rows, "language string, cluster_id int, question_id long, title string, score long, view_count long, is_answered boolean"
    )


def test_patterns_leave_out_noise_and_oversized(spark, questions):
    labels = spark.createDataFrame([("go", 0, "chan / select")], "language string, cluster_id int, label string")
    best = patterns.top_patterns(questions, labels, max_cluster_size=20).orderBy("rank").collect()
    assert [(r.cluster_id, r.label, r["size"], r.median_score, r.median_views, r.answer_rate) for r in best] == [
        (0, "chan / select", 10, 2.0, 45.0, 0.5), (1, "cluster_1", 4, None, 7.0, 1.0)]
    plain = questions.select("language", "cluster_id", "question_id")
    first = patterns.top_patterns(plain, labels, 1).first()
    assert (first.cluster_id, first.median_score, first.median_views, first.answer_rate) == (2, 0.0, 0.0, 0.0)
    assert patterns.top_patterns(questions.where("cluster_id = -1"), labels).count() == 0


def test_representatives(spark, questions):
    best = patterns.representatives(questions, 3).where("cluster_id = 0").orderBy("rank").collect()
    assert [r.question_id for r in best] == [4, 9, 3]
    by_id = patterns.representatives(questions.drop("score"), 2).where("cluster_id = 0").orderBy("rank").collect()
    assert [r.question_id for r in by_id] == [0, 1]


def test_pattern_documents(spark, questions):
    labels = spark.createDataFrame([], "language string, cluster_id int, label string")
    best = patterns.top_patterns(questions, labels, max_cluster_size=20)
    row = payload.patterns_payload(best, patterns.representatives(questions)).first()
    assert [p.cluster_id for p in row.patterns] == [0, 1]
    assert [e.question_id for e in row.patterns[0].examples] == [4, 9, 3]
    assert row.patterns[0].examples[0].title == "t4"
    summary = patterns.pattern_summary(best).first()
    assert (summary.largest, summary.largest_size, summary.hardest, summary.hardest_rate) == ("cluster_0", 10, "cluster_0", 0.5)


def test_trend_documents_keep_gaps(spark):
    trends = spark.createDataFrame(
        [("go", 2020, 1.0, 10.4, 0.5, None, None), ("go", 2022, 2.0, 20.5, 0.25, 8.0, None), ("java", 2021, 3.0, 1.0, 1.0, None, None)],
        "language string, year int, median_score double, median_views double, answer_rate double, usage_pct double, want_pct double",
    )
    tags = spark.createDataFrame([("go", 5, "go")], "name string, count long, language string")
    langs = spark.createDataFrame([("go", "Go", "#00ADD8"), ("java", None, None), ("c", "C", None)], "language string, display_name string, color string")
    rows = {r.language: json.loads(r.doc) for r in payload.trends_payload(trends, tags, langs).select("language", F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("doc")).collect()}
    go = rows["go"]
    assert go["years"] == [2020, 2021, 2022] and go["survey_years"] == [2022]
    assert go["yearly"] == {"median_score": [1.0, None, 2.0], "median_views": [10.0, None, 20.0], "answer_rate": [0.5, None, 0.25]}
    assert go["survey"] == {"usage_pct": [8.0], "want_pct": [None]}
    assert go["total_questions"] == 5
    assert rows["java"]["display_name"] == "java" and rows["java"]["color"] == "#888888" and rows["java"]["total_questions"] == 0
    assert rows["java"]["yearly"]["median_score"] == [None, 3.0, None]
    survey = trends.where("usage_pct IS NOT NULL")
    older = {r.language: r for r in payload.survey_payload(survey, tags, langs).collect()}
    assert older["go"].usage_pct == [8.0] and older["go"].want_pct == [None] and older["java"].usage_pct == []


@pytest.mark.parametrize(
    "raw, label",
    [("django / models", "Django"), ("go_gorm / x", "GORM (ORM)"), ("web_scraping / y", "Web Scraping"), ("Node.js", "Node.Js"),
     ("asp.net core / z", "Asp.Net Core")],
)
def test_clean_label(spark, raw, label):
    assert spark.createDataFrame([(raw,)], "x string").select(payload.clean_label("x")).first()[0] == label


def test_display_columns(spark):
    df = spark.createDataFrame(
        [("go", i, f"c{i} / x", 100 - i, 0.8 if i != 3 else 0.125, i) for i in range(1, 18)],
        "language string, cluster_id int, label string, size long, answer_rate double, rank int",
    )
    rows = payload.display_columns(df).collect()
    assert [r["rank"] for r in rows] == list(range(15, 0, -1))
    third = [r for r in rows if r["rank"] == 3][0]
    assert third.shade == pytest.approx(0.45 + 0.875 * 0.55) and third.answer_pct == 13 and third.color == "#00ADD8ed"
    rates = spark.createDataFrame([(0.125,), (None,)], "answer_rate double")
    assert [r.answer_pct for r in payload.rate_percentages(rates).collect()] == [13, None]


def test_display_scales(spark):
    nodes = spark.createDataFrame([("g", "a", 100), ("g", "b", 1), ("g", "c", 25)], "language string, id string, frequency long")
    radius = {r.id: r.radius for r in payload.node_radius(nodes).collect()}
    assert radius == pytest.approx({"a": 30.0, "b": 5.0, "c": 5 + 4 / 9 * 25})
    edges = spark.createDataFrame([("g", "a", "b", 11), ("g", "a", "c", 1), ("g", "b", "c", 50)], "language string, source string, target string, weight long")
    links = {r.weight: (r.width, r.length) for r in payload.link_scales(edges).collect()}
    assert links[1] == pytest.approx((0.5, 88.5)) and links[50] == pytest.approx((4.0, 55.0)) and links[11][1] == 73.5


def test_community_names(spark):
    df = spark.createDataFrame([("go", 1), ("go", 9), ("rust", 0), ("java", -1)], "language string, community int")
    got = [r[0] for r in df.select(payload.community_name("language", "community")).collect()]
    assert got == ["HTTP/ネット", "コミュニティ 9", "コミュニティ 0", "コミュニティ -1"]
