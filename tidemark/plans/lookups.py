"""Queries of readers, cells, names, mails, profiles and places."""

from __future__ import annotations

from difflib import SequenceMatcher

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import graph as G
from ..operators import joins as J
from ..operators import master as MM
from ..operators import matching as M
from ..operators import outreach as O
from ..operators import records as R
from ..sources import io
from ..sources.shared import folder as _folder
from .proxies import _pick, _sql_pick, leads, read

NATIONS = [f"NATION_{k}" for k in range(25)]
NAMES = ["Lee, Ann", "Ann Lee, MBA", "Dr. José  Pérez Jr.", "Lee, Ann, PhD", None, "  "]
MATCHING = ["ann lee", "ann lee", "dr jose perez", "lee ann", "", ""]
CELLS = ["{'a': None, 'b': True}", '{"a": null}', "__import__('os')", None, """{'body': {'text': "it's None, \\"x\\""}, 't': ('a', 2,), 'n': [None, False]}""", r"{'k': 'O\'Brien \\ \x41 \n'}", "{'open': [1, 2}"]
AS_JSON = ['{"a": null, "b": true}', '{"a": null}', "{}", "{}", """{"body": {"text": "it's None, \\"x\\""}, "t": ["a", 2], "n": [null, false]}""", r"""{"k": "O'Brien \\ \u0041 \n"}""", "{}"]
HEADERS = ["=?utf-8?q?Jos=C3=A9?= <J@x.example>", 'Ann <A@x.example>, "B, C" <b@y.example>', None]
DECODED, SENDERS = ["José <J@x.example>", 'Ann <A@x.example>, "B, C" <b@y.example>', None], ["j@x.example", "a@x.example,b@y.example", ""]
ANSWERS = ['x ```json\n{"industry": "Tech"}\n``` y', 'so {"industry": "law"}', '{"industry": "??"}', "no", None]
LETTERS = ["I'd like to introduce you to Ann Lee.", "Let me introduce Bob to you", "hello", "Looping in Cyd Ray Moss", None]
PROFILES = ["https://linkedin.com/in/annlee?x", "https://linkedin.com/company/in/ann", "https://x.example/in/bob"]


def cell_names(spark, d):
    k = F.col("c_custkey")
    return read(spark, d, "customer").select(k, M.matching_name(_pick(NAMES, k % 6), ["mba", "phd", "jr", "cpa"]).alias("name"), T.invalid_company(_pick(["Acme", "--", "x", None], k % 4)).alias("invalid"))


def cell_similarity(spark, d):
    n = read(spark, d, "nation")
    return n.select("n_nationkey", F.round(M.similarity("n_name", F.lit("united nations")), 4).alias("similarity"))


def cell_literals(spark, d):
    k = F.col("c_custkey")
    return read(spark, d, "customer").select(k, T.literal_object(_pick(CELLS, k % len(CELLS))).alias("json"))


def mail_headers(spark, d):
    k = F.col("c_custkey")
    header = _pick(HEADERS, k % 3)
    return read(spark, d, "customer").select(k, M.mime_header(header).alias("header"), F.array_join(M.addresses(header), ",").alias("senders"))


def mail_introductions(spark, d):
    k = F.col("c_custkey")
    return read(spark, d, "customer").select(k, M.introduced(_pick(LETTERS, k % 5)).alias("introduced"), M.introduced_name(_pick(LETTERS, k % 5)).alias("name"))


def mail_bodies(spark, d):
    k = F.col("c_custkey")
    part = lambda mime, text: F.struct(F.lit(mime).alias("mime"), F.base64(text.cast("binary")).alias("data"))
    page = part("text/html", F.concat(F.lit("<style>x</style><p>page"), k, F.lit("</p>")))
    parts = F.when(k % 3 == 0, F.array(page, part("text/plain", F.concat(F.lit("plain"), k)))).when(k % 3 == 1, F.array(page)).otherwise(F.array().cast("array<struct<mime: string, data: string>>"))
    return read(spark, d, "customer").select(k, R.mail_body(parts).alias("body"))


def mail_rendered(spark, d):
    k = F.col("c_custkey")
    body = O.render(F.lit("Hi {{ name }}, {{offer}} {{x}}"), F.create_map(F.lit("name"), F.concat(F.lit("A$"), k), F.lit("offer"), F.when(k % 2 == 0, "50%")))
    return read(spark, d, "customer").select(k, body.alias("body"), F.array_join(O.leftover_marks(body), ",").alias("left"))


def answer_fields(spark, d):
    k = F.col("c_custkey")
    return read(spark, d, "customer").select(k, O.json_answer(_pick(ANSWERS, k % 5), "industry string", "industry", ["tech", "law"], "other").alias("industry"))


def profile_scores(spark, d):
    k = F.col("c_custkey")
    return read(spark, d, "customer").select(k, M.profile_score(F.lit("Ann Lee"), F.lit("Acme Homes"), _pick(PROFILES, k % 3), F.lit("Ann Lee - Acme"), _pick(["Ann Lee works at Acme Homes", "ann of acme"], k % 2)).cast("long").alias("score"))


def profile_rows(spark, d):
    k = F.col("c_custkey")
    mine = read(spark, d, "customer").select(k, F.concat(F.lit("https://www.linkedin.com/in/P"), k, F.lit("/")).alias("url"))
    found = read(spark, d, "customer").filter(k % 2 == 0).select(F.concat(F.lit("http://linkedin.com/in/p"), k, F.lit("?trk=x")).alias("url"), (k % 7).alias("seen"))
    return R.by_profile(mine, found).select("c_custkey", "seen")


def people_places(spark, d):
    k = F.col("c_custkey")
    persons = read(spark, d, "customer").select(F.concat(F.lit("e"), k).alias("email"), F.lit(None).cast("string").alias("city"), F.when(k % 2 == 0, "own").alias("state"), F.lit(None).cast("string").alias("country"))
    works = read(spark, d, "customer").filter(k % 3 > 0).select(F.concat(F.lit("e"), k).alias("email"), F.concat(F.lit("d"), k % 10).alias("domain"))
    places = spark.createDataFrame([(f"d{i}", f"city{i}", f"state{i}", f"country{i % 2}") for i in range(8)], "domain string, city string, state string, country string")
    return R.with_location(persons, works, places)


def people_unlinked(spark, d):
    k = F.col("c_custkey")
    persons = read(spark, d, "customer").select(F.concat(F.lit("e"), k, F.when(k % 5 > 0, "@x.example").otherwise("")).alias("email"))
    return R.unlinked(persons, read(spark, d, "customer").filter(k % 3 == 0).select(F.concat(F.lit("e"), k, F.lit("@x.example")).alias("email")))


def people_identity(spark, d):
    """Names of one real person, of two of whom one has the company, and of two of whom both or none have it."""
    k = F.col("c_custkey")
    real = read(spark, d, "customer").select(F.concat(F.lit("r"), k).alias("node"), F.concat(F.lit("n"), F.floor(k / 2)).alias("name"), F.concat(F.lit("Co"), k % 3, F.lit(" Inc")).alias("company"))
    synthetic = read(spark, d, "customer").filter(k % 4 < 2).select(F.concat(F.lit("s"), k).alias("node"), F.concat(F.lit("n"), F.floor(k / 2)).alias("name"), F.concat(F.lit("co"), (k + 1) % 3).alias("company"))
    return G.identity(synthetic, real)


def listing_rows(spark, d):
    k = F.col("c_custkey")
    person = lambda i: F.struct(F.concat(F.lit(f"agent{i}-"), k).alias("name"), F.concat(F.lit("a"), k, F.lit(f"@x{i}.example")).alias("email"))
    raw = read(spark, d, "customer").select(
        k.alias("id"), F.struct((k % 90).cast("string").alias("number"), F.when(k % 3 > 0, F.concat(F.lit("Street "), k)).otherwise(" ").alias("street"), F.lit(None).cast("string").alias("unit"), F.concat(F.lit("city"), k % 9).alias("city")).alias("address"),
        F.array(F.when(k % 2 == 0, k * 1000), k * 10).alias("prices"), F.when(k % 4 == 0, F.array(person(1), person(2))).when(k % 4 == 1, F.array(person(1))).otherwise(F.array().cast("array<struct<name: string, email: string>>")).alias("agents"))
    return R.listings(raw)


def run_estimate(spark, d):
    modules = spark.createDataFrame([("site", 0.01, 0.8, True), ("mail", 0.002, 1.3, True), ("off", 9.0, 9.0, False)], "name string, unit_cost double, seconds double, enabled boolean")
    return R.estimate(modules, read(spark, d, "customer").count())


def table_lookup(spark, d):
    return J.lookup(read(spark, d, "customer").select("c_custkey", F.col("c_nationkey").alias("n_nationkey")), read(spark, d, "nation").select("n_nationkey", "n_name"), "n_nationkey")


def table_sample(spark, d):
    """How many rows a sample has, and whether it is the same again."""
    c = read(spark, d, "customer").select("c_custkey")
    one, two = MM.audit_sample(c, "c_custkey", 50), MM.audit_sample(c.repartition(3), "c_custkey", 50)
    return one.join(two, "c_custkey").agg(F.count(F.lit(1)).alias("same"))


def table_files(spark, d):
    """Leads as csv files: written, read again by ending and by list with their file, rejects apart, target fields mapped."""
    folder = _folder(spark, "leads")
    rows = leads(spark, d).select("ord", "page_name", "primary_email", F.when(F.col("ord") % 3 == 0, "n/a").otherwise(F.col("ad_count")).alias("ads"), F.array("website_url").alias("sites"))
    io.save_csv(rows, f"{folder}/a")
    io.save_csv(rows.filter("ord % 2 = 0"), f"{folder}/b")
    one = io.load(spark, f"{folder}/a", kind="csv")
    kept, bad = io.split_rejects(one, F.col("primary_email").isNull())
    both = io.load_many(spark, [f"{folder}/a", f"{folder}/b", f"{folder}/a"], "ord string, page_name string, primary_email string, ads string, sites string")
    named = io.mapped(kept, {"ord": "id", "ads": "ad_count", "page_name": "name", "sites": "gone"}, {"id": ("long", -1), "ad_count": ("int", 0), "name": ("string", ""), "likes": ("int", 7)})
    by_file = both.select("ord", "source_file").distinct().groupBy("ord").agg(F.count(F.lit(1)).alias("n")).agg(F.sum("n")).first()[0]
    return named.select("id", "ad_count", "name", "likes").unionByName(bad.agg(F.lit(-1).cast("long").alias("id"), F.count(F.lit(1)).cast("int").alias("ad_count"), F.lit("rejects").alias("name"), F.lit(int(by_file)).alias("likes")))


def table_templates(spark, d):
    """Templates written as text and read with their block of fields, subject and body."""
    folder = _folder(spark, "templates")
    text = F.concat(F.lit('---\nid: t'), F.col("n_nationkey"), F.lit('\nname: "First"\n# note\nempty: null\n---\nSubject: Hello '), F.col("n_name"), F.lit("\n\nBody\nline\n"))
    read(spark, d, "nation").select("n_nationkey", text.alias("value")).write.partitionBy("n_nationkey").text(folder)  # a file each
    t = io.templates(spark, folder).filter("body <> ''")
    return t.select(F.col("meta")["id"].alias("id"), F.col("meta")["name"].alias("name"), F.col("meta")["empty"].alias("empty"), "subject", "body")


def table_published(spark, d):
    """Four runs, of which the third dies before its end and the fourth is published under a smaller id; two are kept."""
    path, c = _folder(spark, "runs"), read(spark, d, "customer").select("c_custkey", "c_nationkey")
    io.publish(c.filter("c_custkey % 3 = 0"), path, "r1", keep=2)
    io.publish(c.filter("c_custkey % 3 = 1"), path, "r5", keep=2)
    c.filter("c_custkey % 7 = 0").write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{path}/run_id=r9")
    io.publish(c.filter("c_custkey % 3 = 2"), path, "r3", keep=2)
    return io.latest_version(spark, path).withColumn("runs", F.lit(",".join(io.finished_runs(spark, path))))


def table_newest(spark, d):
    return io.newest(read(spark, d, "customer").select(F.concat(F.lit("run"), F.lpad(F.col("c_custkey"), 9, "0")).alias("run_id")), 5)


QUERIES = {f.__name__: f for f in (
    cell_names, cell_similarity, cell_literals, mail_headers, mail_introductions, mail_bodies, mail_rendered, answer_fields, profile_scores, profile_rows, people_places, people_unlinked, people_identity, listing_rows, run_estimate, table_lookup, table_sample, table_files, table_templates, table_newest, table_published)}
_K = "SELECT c_custkey AS k FROM customer"
_LIKE = " ".join(f"WHEN '{n}' THEN {round(SequenceMatcher(None, n.lower(), 'united nations').ratio(), 4)}" for n in NATIONS)
SQL = {
    "cell_names": f"SELECT k AS c_custkey, {_sql_pick(MATCHING, 'k % 6')} AS name, k % 4 > 0 AS invalid FROM ({_K})",
    "cell_similarity": f"SELECT n_nationkey, CAST(CASE n_name {_LIKE} END AS DOUBLE) AS similarity FROM nation",
    "cell_literals": f"SELECT k AS c_custkey, {_sql_pick(AS_JSON, f'k % {len(AS_JSON)}')} AS json FROM ({_K})",
    "mail_headers": f"SELECT k AS c_custkey, {_sql_pick(DECODED, 'k % 3')} AS header, {_sql_pick(SENDERS, 'k % 3')} AS senders FROM ({_K})",
    "mail_introductions": f"SELECT k AS c_custkey, k % 5 IN (0, 1, 3) AS introduced, {_sql_pick(['Ann Lee', 'Bob', None, 'Cyd Ray Moss', None], 'k % 5')} AS name FROM ({_K})",
    "mail_bodies": f"SELECT k AS c_custkey, CASE k % 3 WHEN 0 THEN 'plain' || k WHEN 1 THEN 'page' || k ELSE '' END AS body FROM ({_K})",
    "mail_rendered": f"SELECT k AS c_custkey, 'Hi A$' || k || ', ' || CASE WHEN k % 2 = 0 THEN '50%' ELSE '' END || ' {{{{x}}}}' AS body, 'x' AS \"left\" FROM ({_K})",
    "answer_fields": f"SELECT k AS c_custkey, {_sql_pick(['tech', 'law', 'other', 'other', 'other'], 'k % 5')} AS industry FROM ({_K})",
    "profile_scores": f"SELECT k AS c_custkey, CASE k % 3 WHEN 0 THEN CASE WHEN k % 2 = 0 THEN 155 ELSE 125 END WHEN 2 THEN CASE WHEN k % 2 = 0 THEN 95 ELSE 65 END END AS score FROM ({_K})",
    "profile_rows": f"SELECT k AS c_custkey, CASE WHEN k % 2 = 0 THEN k % 7 END AS seen FROM ({_K})",
    "people_places": f"SELECT 'e' || k AS email, CASE WHEN p THEN 'city' || (k % 10) END AS city, CASE WHEN k % 2 = 0 THEN 'own' WHEN p THEN 'state' || (k % 10) END AS state, CASE WHEN p THEN 'country' || (k % 10 % 2) END AS country FROM (SELECT k, k % 3 > 0 AND k % 10 < 8 AS p FROM ({_K}))",
    "people_unlinked": f"SELECT 'e' || k || '@x.example' AS email FROM ({_K}) WHERE k % 5 > 0 AND k % 3 > 0",
    "people_identity": f"""WITH r AS (SELECT 'r' || k AS match, k // 2 AS name, 'co' || (k % 3) AS c FROM ({_K})), m AS (SELECT 's' || s.k AS node, match, c = 'co' || ((s.k + 1) % 3) AS same FROM ({_K}) s JOIN r ON name = s.k // 2 WHERE s.k % 4 < 2)
  SELECT node, match, CASE WHEN n = 1 THEN 1 ELSE 2 END AS tier FROM (SELECT *, count(*) OVER (PARTITION BY node) AS n, count(*) FILTER (same) OVER (PARTITION BY node) AS y FROM m) WHERE n = 1 OR same AND y = 1""",
    "listing_rows": f"SELECT k AS id, (k % 90) || CASE WHEN k % 3 > 0 THEN ' Street ' || k ELSE '' END AS street, 'city' || (k % 9) AS city, CASE WHEN k % 2 = 0 THEN k * 1000 ELSE k * 10 END AS price, CASE WHEN k % 4 < 2 THEN 'agent1-' || k END AS agent, CASE WHEN k % 4 < 2 THEN 'a' || k || '@x1.example' END AS agent_email, CASE WHEN k % 4 = 0 THEN 'agent2-' || k END AS second_agent FROM ({_K})",
    "run_estimate": "SELECT round(CAST(0.012 AS DOUBLE) * n, 4) AS cost, round(CAST(2.1 AS DOUBLE) * n / 60 / 1.5, 2) AS minutes, 2 AS modules FROM (SELECT count(*) AS n FROM customer)",
    "table_lookup": "SELECT c_custkey, c_nationkey AS n_nationkey, n_name FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey",
    "table_sample": "SELECT 50 AS same",
    "table_files": f"SELECT k AS id, CASE WHEN k % 3 = 0 THEN 0 ELSE k % 6 END AS ad_count, 'Lead ' || (k % 700) AS name, 7 AS likes FROM ({_K}) WHERE k % 3 > 0 UNION ALL SELECT -1, count(*) FILTER (k % 3 = 0), 'rejects', count(*) + count(*) FILTER (k % 2 = 0) FROM ({_K})",
    "table_templates": "SELECT 't' || n_nationkey AS id, 'First' AS name, NULL AS empty, 'Hello ' || n_name AS subject, 'Body' || chr(10) || 'line' AS body FROM nation",
    "table_published": "SELECT c_custkey, c_nationkey, 'r3,r5' AS runs FROM customer WHERE c_custkey % 3 = 2",
    "table_newest": f"SELECT 'run' || lpad(CAST(k AS VARCHAR), 9, '0') AS run_id FROM ({_K}) ORDER BY 1 DESC LIMIT 5",
}
