"""Matching, outreach and edge readers on rows that hit their rules."""

from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from tidemark.functions import text
from tidemark.operators import joins, matching, outreach
from tidemark.sources import io


def one(spark, expression, *values):
    df = spark.createDataFrame([values], ", ".join(f"c{i} string" for i in range(len(values))))
    return df.select(expression(*(F.col(f"c{i}") for i in range(len(values)))).alias("y")).first().y


@pytest.mark.parametrize(("a", "b"), [("Acme Realty", "acme realty"), ("Acme", "Amce Inc"), ("", "x"), (None, "x"), ("Ñandú", "nandu")])
def test_similarity(spark, a, b):
    want = SequenceMatcher(None, a.lower(), b.lower()).ratio() if a and b else 0.0
    assert one(spark, matching.similarity, a, b) == pytest.approx(want)


@pytest.mark.parametrize(("name", "want"), [("Lee, Ann", "ann lee"), ("Ann Lee, MBA", "ann lee"), ("Dr. José  Pérez Jr.", "dr jose perez"), ("Lee, Ann, PhD", "lee ann"), (None, ""), ("  ", "")])
def test_matching_name(spark, name, want):
    assert one(spark, lambda c: matching.matching_name(c, ["mba", "phd", "jr", "cpa"]), name) == want


@pytest.mark.parametrize(("domain", "want"), [("cbre.com", "CBRE"), ("mail.acme.com", "Acme"), ("acme.co.uk", "Acme"), ("sub.acme.org", "Sub Acme")])
def test_company_of_domain(spark, domain, want):
    assert one(spark, matching.company_of_domain, domain) == want


def test_literals_and_headers(spark):
    assert one(spark, text.literal_object, "{'a': None, 'b': True}") == '{"a": null, "b": true}'
    assert one(spark, text.literal_object, '{"a": null}') == '{"a": null}' and one(spark, text.literal_object, "__import__('os')") == "{}" and one(spark, text.literal_object, None) == "{}"
    assert one(spark, matching.mime_header, "=?utf-8?q?Jos=C3=A9?=") == "José" and one(spark, matching.mime_header, None) is None
    assert one(spark, matching.addresses, 'Ann <A@x.example>, "B, C" <b@y.example>') == ["a@x.example", "b@y.example"]


def test_introductions(spark):
    assert one(spark, matching.introduced, "I'd like to introduce you to Ann Lee.") and not one(spark, matching.introduced, "hello")
    assert one(spark, matching.introduced_name, "Let me introduce Ann Lee to you") == "Ann Lee" and one(spark, matching.introduced_name, None) is None


def test_best_place_and_profile(spark):
    base = spark.createDataFrame([(1, "Acme Realty", "https://acme.example"), (2, "Other", None)], "k long, name string, site string")
    found = spark.createDataFrame([(1, 0, "Acme Realty Inc", "http://www.acme.example/x", 0), (1, 1, "Acme Realty", None, 5), (2, 0, "zzz", None, 9)], "k long, pos int, their_name string, their_site string, reviews int")
    got = joins.best_match(base, found, "k", matching.place_confidence(F.col("name"), F.col("site"), F.col("their_name"), F.col("their_site"), F.col("reviews")), 0.5)
    assert {(r.k, r.pos) for r in got.collect()} == {(1, 0), (2, None)}
    pages = spark.createDataFrame([("https://linkedin.com/in/annlee?x", "Ann Lee - Acme", "Ann Lee works at Acme Homes"), ("https://linkedin.com/company/in/ann", "Ann", "")], "u string, t string, x string")
    scores = [r[0] for r in pages.select(matching.profile_score(F.lit("Ann Lee"), F.lit("Acme Homes"), F.col("u"), F.col("t"), F.col("x"))).collect()]
    assert scores == [30 + 30 + 15 + 15 + 40 + 25, None]


def test_rendering(spark):
    df = spark.createDataFrame([("Hi {{ name }}, {{offer}} {{x}}", {"name": "A$1\\", "offer": "50%"})], "t string, v map<string,string>")
    row = df.select(outreach.render(F.col("t"), F.col("v")).alias("y")).first()
    assert row.y == "Hi A$1\\, 50% {{x}}"
    assert one(spark, outreach.leftover_marks, row.y) == ["x"]


def test_json_answers(spark):
    read = lambda t: one(spark, lambda c: outreach.json_answer(c, "industry string", "industry", ["tech", "law"], "other"), t)
    assert read('x ```json\n{"industry": "Tech"}\n``` y') == "tech" and read('so {"industry": "law"}') == "law" and read('{"industry": "??"}') == "other" and read("no") == "other"


def test_readers(spark, tmp_path):
    (tmp_path / "a.csv").write_text('name,n\n"x, ""y""",1\nz,\n')
    (tmp_path / "b.csv").write_text("name,n\nw,3\n")
    assert [tuple(r) for r in io.load(spark, str(tmp_path / "a.csv")).collect()] == [('x, "y"', "1"), ("z", None)]
    many = io.load_many(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv"), str(tmp_path / "b.csv")], "name string, n int")
    assert sorted((r.name, r.source_file) for r in many.collect() if r.n == 3) == [("w", "b.csv")]
    with pytest.raises(ValueError, match="no reader"):
        io.load(spark, "x.xyz")
    df = spark.createDataFrame([("7", "n/a", "k")], "A string, ` b ` string, c string")
    assert io.has_columns(df, ["a", "B"]) and not io.has_columns(df, ["d"])
    assert tuple(io.mapped(df, {"A": "count", " b ": "likes", "c": None}, {"count": ("int", 0), "likes": ("int", 5), "name": ("string", "")}).first()) == (7, 5, "")
    keep, bad = io.split_rejects(df, F.col("A") == "7")
    assert keep.count() == 0 and bad.count() == 1
    io.save_csv(spark.createDataFrame([(1, ["a", "b"])], "k int, l array<string>"), str(tmp_path / "out"))
    assert io.load(spark, str(tmp_path / "out"), kind="csv").first().l == '["a","b"]'


def test_templates(spark, tmp_path):
    (tmp_path / "t.md").write_text('---\nid: one\nname: "First"\n# note\nempty: null\n---\nSubject: Hello {{x}}\n\nBody\nline\n')
    row = io.templates(spark, str(tmp_path / "t.md")).first()
    assert row.meta == {"id": "one", "name": "First", "empty": None} and row.subject == "Hello {{x}}" and row.body == "Body\nline"
