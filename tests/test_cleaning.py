from datetime import datetime

from qaspark.operators import cleaning

RAW = "question_id long, title string, tags string, creation_date long, language string"


def test_clean_questions(spark):
    df = spark.createDataFrame(
        [
            (1, " a &amp;lt; b ", "['x', 'y']", 1704067200, "java"),
            (1, "same id", "['x']", 1704067100, "python"),
            (2, None, "[]", 1, "java"),
            (3, " \n ", "[]", 1, "java"),
            (4, "&quot;q&quot;", None, 5, "go"),
            (4, "older", "['z']", 4, "go"),
        ],
        RAW,
    )
    cleaned = cleaning.clean_questions(df, ["python", "javascript", "java", "go"])
    rows = {r.question_id: r for r in cleaned.collect()}
    assert set(rows) == {1, 4}
    assert rows[1].title == "same id" and rows[1].language == "python" and rows[1].tags == ["x"]
    assert rows[4].title == "older"
    assert rows[1].creation_date == datetime(2023, 12, 31, 23, 58, 20)
    report = cleaning.cleaning_report(df, cleaned).first()
    assert (report.n_before, report.n_after, report.n_dropped) == (6, 2, 4)


def test_lists_and_timestamps_pass_through(spark):
    df = spark.createDataFrame(
        [(1, "t", ["a"], datetime(2024, 1, 1), "go"), (2, "t", None, datetime(2024, 1, 1), "go")],
        "question_id long, title string, tags array<string>, creation_date timestamp, language string",
    )
    rows = {r.question_id: r for r in cleaning.clean_questions(df).collect()}
    assert rows[1].tags == ["a"] and rows[2].tags == []
    assert rows[1].creation_date == datetime(2024, 1, 1)


def test_other_tag_types_give_empty_lists(spark):
    df = spark.createDataFrame([(1, 5)], "question_id long, tags int")
    assert cleaning.tags_to_list(df).first().tags == []


def test_tagged_between_includes_both_ends(spark):
    df = spark.createDataFrame(
        [(i, ["go"], datetime(2024, 1, i)) for i in range(1, 6)], "question_id long, tags array<string>, creation_date timestamp"
    )
    found = cleaning.tagged_between(df, "go", "2024-01-02 00:00:00", "2024-01-04 00:00:00").collect()
    assert [r.question_id for r in found] == [2, 3, 4]


def test_sample_per_year_takes_the_oldest(spark):
    df = spark.createDataFrame(
        [("go", 2020, i, datetime(2020, 1, 1 + i % 9)) for i in range(30)],
        "language string, year int, question_id long, creation_date timestamp",
    )
    found = cleaning.sample_per_year(df, 5).collect()
    assert sorted(r.question_id for r in found) == [0, 1, 9, 18, 27]


def test_large_samples_go_through_salted_ranks(spark):
    df = spark.range(5000).selectExpr(
        "'go' AS language", "2020 AS year", "id AS question_id", "timestamp_seconds(5000 - id) AS creation_date"
    )
    found = cleaning.sample_per_year(df, 1500)
    ids = sorted(r.question_id for r in found.collect())
    assert ids == list(range(3500, 5000))
