"""Export reading, flattening, time and users."""

import json

import pytest
from pyspark.sql import functions as F

from threadloom.functions.text import contains_any, extract_tag, has_content, relation_name, strip
from threadloom.functions.times import week_id
from threadloom.operators import messages as M
from threadloom.plans.etl import run_etl
from threadloom.sources.exports import read_export, read_users_csv
from threadloom.sources.layers import export_csv, read_layer

EXPORT = {"chats": {"list": [
    {"id": 1, "name": "Club", "messages": [
        {"id": 1, "type": "message", "date": "2023-12-31T10:00:00", "from": "Ann", "from_id": "user1",
         "text": "hello", "reactions": [{"type": "emoji", "count": 9, "emoji": "👍"},
                                        {"type": "custom", "count": 10, "recent": [{"from": "x"}]}]},
        {"id": 2, "type": "message", "date": "2023-12-31T10:05:00", "from": "Bob", "from_id": "user2",
         "text": ["see ", {"type": "link", "text": "this"}], "reply_to_message_id": 1},
        {"id": 3, "type": "service", "date": "bad", "from": None, "from_id": "user3", "text": "joined"},
        {"id": 4, "type": "message", "date": "2024-01-01T00:00:00", "from": "Ann", "text": ""},
        {"id": 5, "type": "message", "date": "2024-01-01T00:00:00", "from": "Ann", "text": None},
        {"id": 6, "type": "message", "date": "2024-01-01T00:00:00", "from": "Ann B", "from_id": "user1",
         "text": []},
    ]},
    {"id": 2, "name": "Empty", "messages": []},
    {"id": 3, "name": "Other", "messages": [{"id": 1, "text": "x", "date": "2024-01-02T00:00:00"}]},
]}}


@pytest.fixture()
def export_path(tmp_path):
    path = tmp_path / "result.json"
    path.write_text(json.dumps(EXPORT, indent=1, ensure_ascii=False))
    return str(path)


def test_bronze_to_silver(spark, export_path):
    bronze = M.bronze_messages(read_export(spark, export_path), ["Club", "Empty", "Absent"])
    rows = {r["message_id"]: r for r in M.enrich_time(M.flatten_messages(bronze)).collect()}
    assert sorted(rows) == [1, 2, 3, 6]
    assert rows[1]["id"] == "1_1" and rows[1]["sender"] == "Ann"
    assert rows[6]["text"] == "[]" and json.loads(rows[2]["text"])[0] == "see "
    assert json.loads(rows[1]["reactions"])[0] == {"type": "emoji", "count": "9", "emoji": "👍"}
    assert rows[1]["week_id"] == "2023-01" and rows[6]["week_id"] == "2024-01"
    assert rows[3]["date_timestamp"] is None and rows[3]["week_id"] is None
    requested = spark.createDataFrame([("Club",), ("Empty",), ("Absent",)], "n string")
    assert {r[0] for r in M.missing_chats(requested, bronze).collect()} == {"Empty", "Absent"}
    assert tuple(M.ingest_report(bronze).first()) == (4, 0, 1)


def test_chat_selection(spark, export_path):
    export = read_export(spark, export_path)
    assert M.bronze_messages(export).select("chat_name").distinct().count() == 2
    assert M.bronze_messages(export, []).count() == 5
    names = spark.createDataFrame([("Other",)], "n string")
    assert M.bronze_messages(export, names).count() == 1
    many = [f"n{i}" for i in range(1500)] + ["Club"]
    assert M.bronze_messages(export, many).count() == 4


def test_reports_and_users(spark, export_path):
    silver = M.enrich_time(M.flatten_messages(M.bronze_messages(read_export(spark, export_path))))
    report = M.date_quality_report(silver).first()
    assert (report["row_count"], report["failed_count"], report["status"]) == (5, 1, "WARNING")
    assert report["failed_percent"] == 20.0
    empty = M.date_quality_report(silver.filter("false")).first()
    assert (empty["row_count"], empty["failed_percent"], empty["status"]) == (0, 0.0, "OK")
    users = {tuple(r) for r in M.distinct_users(silver).collect()}
    assert users == {("user1", "Ann"), ("user1", "Ann B"), ("user2", "Bob")}
    docs = {r["telegram_id"]: r["display_name"] for r in M.user_documents(silver).collect()}
    assert docs == {"user1": "Ann", "user2": "Bob", "user3": None}


def test_week_ids(spark):
    days = {"2022-12-31": "2022-53", "2023-12-31": "2023-01", "2024-01-01": "2024-01",
            "2024-12-29": "2024-01", "2024-12-28": "2024-52"}
    df = spark.createDataFrame([(d,) for d in days], "d string")
    got = {r[0]: r[1] for r in df.select("d", week_id(F.to_timestamp("d"))).collect()}
    assert got == days


def test_required_columns(spark):
    with pytest.raises(ValueError, match="nope"):
        M.require_columns(spark.range(1), ["id", "nope"])


def test_etl(spark, export_path, tmp_path):
    out = str(tmp_path / "out")
    result = run_etl(spark, export_path, ["Club"], out)
    assert {tuple(r) for r in result.counts.collect()} == {("users", 3), ("threads", 1), ("messages", 4)}
    thread = read_layer(spark, out, "threads").first()
    assert thread["transcript"].splitlines()[3].endswith("Ann: hello {rxn: custom10 👍9}")
    assert result.date_quality.first()["failed_count"] == 1
    # Nothing found: the old layers stay.
    again = run_etl(spark, export_path, ["Absent"], out)
    assert {r["row_count"] for r in again.counts.collect()} == {0}
    assert read_layer(spark, out, "messages").count() == 4


def test_unreadable_documents_are_in_the_report(spark, tmp_path):
    good = json.dumps(EXPORT, ensure_ascii=False)
    (tmp_path / "a.json").write_text(good + "\n{broken\n" + good[:50] + "\n")
    result = run_etl(spark, str(tmp_path / "a.json"), None, str(tmp_path / "out"), multiline=False)
    assert {r.measure: r.value for r in result.report.collect()}["unreadable_documents"] == 2
    assert {r["layer"]: r["row_count"] for r in result.counts.collect()}["messages"] == 5
    nothing = run_etl(spark, str(tmp_path / "a.json"), ["Absent"], str(tmp_path / "none"), multiline=False)
    assert [tuple(r) for r in nothing.report.collect()] == [("unreadable_documents", 2)]


def test_users_csv(spark, tmp_path):
    rows = [("user1", 'Quote "Q", comma'), ("user2", "Éloïse")]
    path = str(tmp_path / "users")
    export_csv(spark.createDataFrame(rows, "telegram_id string, display_name string"),
               ["telegram_id", "display_name"], path)
    assert {tuple(r) for r in read_users_csv(spark, path).collect()} == set(rows)


TAGS = [
    ("<t>x</t>", "x"), ("```xml\n<t> y </t>\n```", "y"), ("<t>a\nb</t><t>c</t>", "a\nb"),
    ("<t></t>", ""), ("z" * 51, "z" * 51), ("  " + "z" * 50 + " ", ""), ("", ""), (None, ""),
]


def test_extract_tag(spark):
    df = spark.createDataFrame([(i, a) for i, (a, _) in enumerate(TAGS)], "i int, a string")
    got = [r[0] for r in df.orderBy("i").select(extract_tag(F.col("a"), "t")).collect()]
    assert got == [e for _, e in TAGS]


def test_text_helpers(spark):
    texts = ["  a b\t", "\x1fa ", "  ", "　", "a"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i")
    t = F.col("t")
    assert [r[0] for r in df.select(strip(t)).collect()] == [x.strip() for x in texts]
    assert [r[0] for r in df.select(has_content(t)).collect()] == [bool(x.strip()) for x in texts]
    names = spark.createDataFrame([("allié-avec x_1",)], "p string")
    assert names.select(relation_name(F.col("p"))).first()[0] == "ALLI__AVEC_X_1"
    assert df.filter(contains_any(t, ["A b", "zz"])).count() == 1
