import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from qaspark.operators import cleaning
from qaspark.plans.everything import run_all
from qaspark.session import checkpoint_folder, write_through
from qaspark.sources import responses, survey, tables


def put_survey(root, year, name, text):
    folder = root / str(year)
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(text, encoding="utf-8")


HEADER = "ResponseId,Comment,LanguageHaveWorkedWith,LanguageWantToWorkWith\n"


def test_survey_files(spark, tmp_path):
    put_survey(tmp_path, 2022, "survey_results_public.csv", HEADER + '1,"two\nlines, ""quoted""",Go;Java,\n2,x,,Go\n')
    put_survey(tmp_path, 2023, "results.csv", "ResponseId,LanguageHaveWorkedWith\n1,Go\n")
    put_survey(tmp_path, 2023, "survey_results_public.csv", HEADER + "1,x,Java,Java\n")
    put_survey(tmp_path, 2024, "results.csv", "ResponseId,Other\n1,Go\n")
    rows = survey.read_survey(spark, str(tmp_path), [2021, 2022, 2023, 2024]).orderBy("year", "have").collect()
    assert [tuple(r) for r in rows] == [(2022, None, "Go"), (2022, "Go;Java", None), (2023, "Go", None)]
    with pytest.raises(FileNotFoundError, match="2021"):
        survey.read_survey_year(spark, str(tmp_path), 2021)
    assert survey.read_survey(spark, str(tmp_path), [2021]).count() == 0


def page(ids, **extra):
    items = [
        {"question_id": i, "title": f"t{i}", "tags": ["go"], "creation_date": 1704067200 + i, "score": 1, "view_count": 2,
         "answer_count": 0, "is_answered": True, **extra} for i in ids
    ]
    return json.dumps({"items": items, "has_more": True, "quota_remaining": 9})


def test_landed_pages(spark, tmp_path):
    folder = tmp_path / "language=go"
    folder.mkdir()
    (folder / "1.json").write_text(page([1, 2], body="<p>x</p>") + "\n" + page([3], body="y"))
    (folder / "2.json").write_text('{"items": [], "has_more": false}')
    plain = responses.read_pages(spark, str(tmp_path))
    assert sorted(r.question_id for r in plain.collect()) == [1, 2, 3] and "body" not in plain.columns
    full = responses.read_questions(spark, str(tmp_path), with_body=True).orderBy("question_id").first()
    assert (full.body, full.language, full.year, full.creation_date) == ("<p>x</p>", "go", 2024, datetime(2024, 1, 1, 0, 0, 1))


def test_request_key_ignores_order(spark):
    df = spark.createDataFrame([("go", 1, None)], "tag string, page int, body string")
    one = {"tag": F.col("tag"), "page": F.col("page"), "body": F.col("body")}
    other = dict(reversed(one.items()))
    row = df.select(responses.request_key(one).alias("a"), responses.request_key(other).alias("b")).first()
    assert row.a == row.b and len(row.a) == 64
    changed = {**one, "page": F.col("page") + 1}
    assert df.select(responses.request_key(changed)).first()[0] != row.a


def test_latest_response_within_ttl(spark):
    rows = [("a", "old", datetime(2024, 1, 1)), ("a", "new", datetime(2024, 1, 20)), ("b", "stale", datetime(2023, 12, 1)), ("c", "edge", datetime(2024, 1, 1))]
    log = spark.createDataFrame(rows, "key string, value string, created_at timestamp")
    now = F.lit("2024-01-31 00:00:00").cast("timestamp")
    found = responses.latest_within_ttl(log, now).collect()
    assert {(r.key, r.value) for r in found} == {("a", "new"), ("c", "edge")}


def test_language_dimension(spark, tmp_path):
    pytest.importorskip("yaml")
    path = tmp_path / "languages.yml"
    path.write_text("languages:\n  go:\n    tag: go\n    display_name: Go\n    color: '#00ADD8'\n    related_tags: [gin]\n  c:\n    tag: c\n")
    rows = {r.language: r for r in tables.read_languages(spark, str(path)).collect()}
    assert rows["go"].related_tags == ["gin"] and rows["c"].display_name == "c" and rows["c"].color is None
    default = tables.languages_table(spark)
    assert [r.language for r in default.collect()] == ["python", "javascript", "java", "go"]
    assert tables.expand_tags(default).count() == 44


def test_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("go", 1, [1.0, None])], "language string, n long, xs array<double>")
    tables.write_table(df, f"{tmp_path}/t")
    assert (tmp_path / "t" / "language=go").exists()
    assert tables.read_table(spark, f"{tmp_path}/t").first().asDict() == {"language": "go", "n": 1, "xs": [1.0, None]}
    tables.write_documents(df.withColumn("gone", F.lit(None).cast("string")), f"{tmp_path}/j")
    text = "".join(f.read_text() for f in (tmp_path / "j").glob("part-*"))
    assert json.loads(text) == {"language": "go", "n": 1, "xs": [1.0, None], "gone": None}


def test_stored_tables_live_in_the_named_folder(spark, tmp_path):
    before = spark.conf.get("spark.checkpoint.dir", None)
    folder = checkpoint_folder(spark)
    assert before is None or folder == before
    stored = write_through(spark.range(5).toDF("n"), "numbers")
    assert all(f"{folder}/qaspark/numbers-" in f for f in stored.inputFiles())
    assert stored.count() == 5


def test_all_levels_end_to_end(spark, tmp_path):
    topics = {"web": "django template view request form", "data": "pandas frame column merge index", "net": "socket server thread timeout packet"}
    tags = {"web": ["django", "html"], "data": ["pandas", "numpy"], "net": ["sockets", "async-io"]}
    rows = []
    for lang in ("python", "go"):
        for i in range(90):
            topic = list(topics)[i % 3]
            words = topics[topic].split()
            title = f"{words[i // 3 % 5]} {words[i // 5 % 5]} {words[i // 7 % 5]} &amp; {words[i // 2 % 5]}"
            rows.append((i if lang == "python" else 1000 + i, title, [lang, *tags[topic]], datetime(2020 + i % 3, 1, 1 + i % 27), i % 4, 10 * i, i % 3 > 0, lang, 2020 + i % 3))
    questions = spark.createDataFrame(
        rows, "question_id long, title string, tags array<string>, creation_date timestamp, score long, view_count long, is_answered boolean, language string, year int"
    )
    survey_df = spark.createDataFrame([(2022, "Python;Go", "Go"), (2022, "Python", None)], "year int, have string, want string")
    tag_df = spark.createDataFrame([("python", 9, "python")], "name string, count long, language string")
    out = str(tmp_path / "out")
    counts = run_all(
        spark, questions, tag_df, survey_df, out, micro={"min_cluster_size": 8, "n_components": 6, "max_cluster_size": None}
    )
    found = {(r.table, r.language): r.n_rows for r in counts.collect()}
    assert found["questions", "go"] == 90 and found["clusters", "python"] == 90 and found["questions", "java"] == 0
    assert found["trends", "go"] == 3 and found["network_centrality", "go"] == 7 and found["pitfalls", "go"] >= 2
    network = {r.language: r for r in spark.read.json(f"{out}/documents/networks").collect()}
    assert {n.id for n in network["go"].nodes} == {"go", "django", "html", "pandas", "numpy", "sockets", "async-io"}
    hub = max(network["go"].nodes, key=lambda n: n.betweenness_centrality)
    assert hub.id == "go"
    patterns = {r.language: r.patterns for r in spark.read.json(f"{out}/documents/pitfalls").collect()}
    assert all(len(p.examples) == 3 for p in patterns["go"])
    trends = {r.language: r for r in spark.read.json(f"{out}/documents/trends").collect()}
    assert trends["python"].survey.usage_pct == [100.0] and trends["python"].total_questions == 9
