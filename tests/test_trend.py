import pytest

from qaspark.operators import trend


def test_survey_matches_whole_names_only(spark):
    df = spark.createDataFrame(
        [(2024, "Java;Go", "Go"), (2024, "JavaScript", None), (2024, None, "Java;Go"), (2024, " Java", "Go")],
        "year int, have string, want string",
    )
    rows = {r.language: r for r in trend.survey_trend(df).collect()}
    assert rows["java"].respondents == 3
    assert rows["java"].usage_pct == 33.33 and rows["java"].want_pct == 33.33 and rows["java"].aspiration == 1.0
    assert rows["go"].want_pct == 100.0 and rows["go"].aspiration == 3.0
    assert rows["python"].usage_pct == 0.0 and rows["python"].want_pct == 0.0 and rows["python"].aspiration is None


def test_survey_without_wishes_or_respondents(spark):
    df = spark.createDataFrame([(2023, "Go", None), (2022, None, None)], "year int, have string, want string")
    rows = {(r.year, r.language): r for r in trend.survey_trend(df, {"go": "Go"}).collect()}
    assert rows[2023, "go"].usage_pct == 100.0
    assert rows[2023, "go"].want_pct is None and rows[2023, "go"].aspiration is None
    assert rows[2022, "go"].usage_pct is None and rows[2022, "go"].respondents == 0


def test_yearly_counts_and_merge(spark):
    q = spark.createDataFrame(
        [(1, "go", 2020, 1, 10, True), (2, "go", 2020, 4, 20, False), (3, "go", 2020, None, 60, True),
         (None, "go", 2020, 2, 5, None), (5, "java", 2021, 3, 7, False), (6, None, 2021, 1, 1, True)],
        "question_id long, language string, year int, score long, view_count long, is_answered boolean",
    )
    yearly = trend.yearly_counts(q)
    rows = {r.language: r for r in yearly.collect()}
    assert set(rows) == {"go", "java"}
    assert (rows["go"].sample_count, rows["go"].median_score, rows["go"].median_views, rows["go"].answer_rate) == (3, 2.0, 15.0, 0.67)
    survey = spark.createDataFrame([(2020, "go", 12.5)], "year int, language string, usage_pct double")
    merged = {r.language: r.usage_pct for r in trend.merge_survey(yearly, survey).collect()}
    assert merged == {"go": 12.5, "java": None}
    means = {r.language: r.mean_median_score for r in trend.mean_of_yearly(yearly).collect()}
    assert means == {"go": 2.0, "java": 3.0}


def test_total_questions_defaults_to_zero(spark):
    tags = spark.createDataFrame([("go", 70, "python"), ("go", 50, "go"), ("x", 3, "go")], "name string, count long, language string")
    langs = spark.createDataFrame([("go",), ("java",)], "language string")
    rows = {r.language: r.total_questions for r in trend.total_questions(tags, langs).collect()}
    assert rows == {"go": 50, "java": 0}


def test_missing_columns_are_named(spark):
    with pytest.raises(ValueError, match="view_count"):
        trend.yearly_counts(spark.createDataFrame([(1,)], "question_id long"))
