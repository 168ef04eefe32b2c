"""Queries of keyed tables and links."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import graph as G
from ..operators import records as R
from .proxies import MAILS_SQL, _pick, _sql_pick, leads, mails, read, sales

MAILBOXES = ["a@acme.example", "b@gmail.com", "c@mail.acme.example", None, "d@lake.example"]


def record_ignore(spark, d):
    s = sales(spark, d).select("mls_number", "ord", "agent_id")
    table = s.filter("ord % 7 = 0").groupBy("mls_number").agg(F.min("agent_id").alias("agent_id"))
    return R.insert_or_ignore(table, s.withColumn("ord", F.col("ord") * 1000 + F.col("agent_id")), ["mls_number"], "ord")


def record_replace(spark, d):
    s = sales(spark, d).select("mls_number", "ord", "agent_id")
    return R.insert_or_replace(s.filter("ord % 2 = 0"), s.filter("ord % 2 = 1 and agent_id < 50"), "mls_number", "ord")


def record_unseen(spark, d):
    return R.unseen(leads(spark, d).select("ord", "page_name"), leads(spark, d).filter("ord % 5 = 0"), "page_name")


def record_people(spark, d):
    k = F.col("c_custkey")
    base = read(spark, d, "customer").select(F.concat(F.lit("e"), k).alias("email"), F.when(k % 2 == 0, F.concat(F.lit("n"), k)).alias("name"), F.when(k % 3 == 0, "old").alias("company"))
    new = read(spark, d, "customer").filter(k % 5 < 2).select(F.concat(F.lit("e"), k + 100).alias("email"), F.lit("new").alias("name"), F.when(k % 5 == 0, "newco").alias("company"))
    return R.people(base, new, keep=("name",))


def record_companies(spark, d):
    p = read(spark, d, "customer").select("c_custkey", _pick(MAILBOXES, F.col("c_custkey") % 5).alias("email"))
    return R.companies_by_domain(p.select("email"), ["gmail.com"]).groupBy("domain").agg(F.count(F.lit(1)).alias("n"))


def record_websites(spark, d):
    k = F.col("c_custkey")
    w = R.website_of_mail(_pick(MAILBOXES, k % 5), F.when(k % 7 == 0, "https://own.example"), ["gmail.com"])
    return read(spark, d, "customer").select(k, w["website"].alias("website"), w["reason"].alias("reason"))


def record_introductions(spark, d):
    return R.introduction_edges(G.introductions(mails(spark, d)))


def record_handles(spark, d):
    k = F.col("c_custkey")
    rows = read(spark, d, "customer").select(k, F.array(F.concat(F.lit(" @H"), k % 300), F.concat(F.lit("@g"), k % 200)).alias("handles"), k.alias("o"))
    return R.handles_once(rows, "c_custkey", "handles", spark.createDataFrame([("@h7",), ("@g9",)], "handle string"), "o")


def record_topics(spark, d):
    k = F.col("c_custkey")
    return R.topics(read(spark, d, "customer").select((k % 100).alias("email"), F.array(F.concat(F.lit(" Topic"), k % 7), F.lit(""), F.lit("AI")).alias("topics")))


_S = "s AS (SELECT 'mls' || (l_orderkey % 500) AS mls_number, l_orderkey * 10 + l_linenumber AS ord, l_suppkey AS agent_id FROM lineitem)"
QUERIES = {f.__name__: f for f in (record_ignore, record_replace, record_unseen, record_people, record_companies, record_websites, record_introductions, record_handles, record_topics)}
SQL = {
    "record_ignore": f"WITH {_S}, t AS (SELECT mls_number, min(agent_id) AS agent_id FROM s WHERE ord % 7 = 0 GROUP BY 1) SELECT * FROM t UNION ALL SELECT mls_number, arg_min(agent_id, ord * 1000 + agent_id) FROM s WHERE mls_number NOT IN (SELECT mls_number FROM t) GROUP BY 1",
    "record_replace": f"WITH {_S} SELECT mls_number, ord, agent_id FROM (SELECT *, ord % 2 AS n FROM s WHERE ord % 2 = 0 OR agent_id < 50) QUALIFY row_number() OVER (PARTITION BY mls_number ORDER BY n DESC, ord DESC, agent_id DESC) = 1",
    "record_unseen": "WITH l AS (SELECT c_custkey AS ord, 'Lead ' || (c_custkey % 700) AS page_name FROM customer) SELECT * FROM l WHERE page_name NOT IN (SELECT page_name FROM l WHERE ord % 5 = 0)",
    "record_people": "WITH o AS (SELECT 'e' || c_custkey AS email, CASE WHEN c_custkey % 2 = 0 THEN 'n' || c_custkey END AS name, CASE WHEN c_custkey % 3 = 0 THEN 'old' END AS company FROM customer), n AS (SELECT 'e' || (c_custkey + 100) AS email, 'new' AS name, CASE WHEN c_custkey % 5 = 0 THEN 'newco' END AS company FROM customer WHERE c_custkey % 5 < 2) SELECT coalesce(o.email, n.email) AS email, coalesce(o.name, n.name) AS name, coalesce(n.company, o.company) AS company FROM o FULL JOIN n ON o.email = n.email",
    "record_companies": f"SELECT split_part(email, '@', 2) AS domain, count(*) AS n FROM (SELECT {_sql_pick(MAILBOXES, 'c_custkey % 5')} AS email FROM customer) WHERE email IS NOT NULL AND email NOT LIKE '%gmail.com' GROUP BY 1",
    "record_websites": f"SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN 'https://own.example' ELSE {_sql_pick(['https://acme.example', None, 'https://mail.acme.example', None, 'https://lake.example'], 'c_custkey % 5')} END AS website, CASE WHEN c_custkey % 7 = 0 THEN 'present' ELSE {_sql_pick(['from_email', 'personal_domain', 'from_email', 'no_email', 'from_email'], 'c_custkey % 5')} END AS reason FROM customer",
    "record_introductions": f"""WITH {MAILS_SQL}, p AS (SELECT message_id, sender, sent, cc1 AS cc, unnest("to") AS "to" FROM (SELECT *, unnest(cc) AS cc1 FROM mails)), i AS (SELECT *, row_number() OVER (PARTITION BY least(cc, "to"), greatest(cc, "to") ORDER BY sent, message_id, cc) AS r FROM p WHERE cc <> "to") SELECT cc AS src, "to" AS dst, max(sent) AS date, arg_min(sender, (sent, message_id)) AS via FROM i WHERE r = 1 GROUP BY 1, 2""",
    "record_handles": "SELECT min(k) AS c_custkey, handle FROM (SELECT c_custkey AS k, '@h' || (c_custkey % 300) AS handle FROM customer UNION ALL SELECT c_custkey, '@g' || (c_custkey % 200) FROM customer) WHERE handle NOT IN ('@h7', '@g9') GROUP BY 2",
    "record_topics": "SELECT DISTINCT c_custkey % 100 AS email, 'topic' || (c_custkey % 7) AS topic FROM customer UNION SELECT DISTINCT c_custkey % 100, 'ai' FROM customer",
}
