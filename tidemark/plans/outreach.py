"""Draft, sending, enrichment and export queries over customers as leads."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import outreach as O
from ..sources import io
from .proxies import LEADS_SQL, leads, read


def _drafts(spark, d):
    k = F.col("c_custkey")
    name = F.when(k % 5 == 0, "None").when(k % 5 == 1, None).otherwise(F.concat(F.lit("Ann Lee"), k))
    body = F.concat(F.lit("Hi "), F.when(k % 3 == 0, "None").otherwise("Ann"), F.lit(",\nline one\n"), F.when(k % 4 == 0, "see {{ offer }} now\n").otherwise(""), F.lit("bye"))
    return read(spark, d, "customer").select(k.alias("draft_id"), name.alias("contact_name"), F.when(k % 2 == 0, "info@x.example").otherwise(F.concat(F.lit("bob.ray"), k, F.lit("@x.example"))).alias("primary_email"), body.alias("email_body"))


def draft_checks(spark, d):
    return O.checked(_drafts(spark, d))


def draft_issues(spark, d):
    return O.issues(O.checked(_drafts(spark, d)))


def draft_fixes(spark, d):
    return O.fixed(_drafts(spark, d)).select("draft_id", "contact_name", "email_body", F.array_join("changes", ",").alias("changes"))


def send_scores(spark, d):
    k = F.col("c_custkey")
    status = F.element_at(F.array(*map(F.lit, ["OK", "CATCH_ALL", "UNKNOWN", "INVALID", "error"])), (k % 5 + 1).cast("int"))
    s = O.send_score(status, k % 101, k % 3 == 0, k % 4 == 0)
    return read(spark, d, "customer").select("c_custkey", s.alias("score"), O.recommendation(s).alias("recommendation"))


def send_eligibility(spark, d):
    k = F.col("ord")
    rows = leads(spark, d).select("ord", F.coalesce("primary_email", F.lit("no address")).alias("email"), F.when(k % 11 == 0, "2024-01-01").alias("sent_at"), (k % 100).alias("score"))
    return O.eligible(rows, spark.createDataFrame([(f"E{i}@x.example",) for i in range(0, 500, 7)], "email string")).select("ord", "send_status")


def staged_enrichment(spark, d):
    s = F.col("s_suppkey")
    status = F.element_at(F.array(*map(F.lit, ["valid", "accept_all", "unknown", "invalid"])), (s % 4 + 1).cast("int"))
    provider = lambda lo, n: read(spark, d, "supplier").filter(s % 3 == lo).select((s % n).alias("domain"), F.concat(F.lit(f"p{lo}-"), s).alias("email"), status.alias("status"), (s % 97).alias("confidence"))
    base = read(spark, d, "nation").select(F.col("n_nationkey").cast("long").alias("domain"))
    return O.staged(base, [("hunter", provider(0, 20), 0.01), ("apollo", provider(1, 23), 0.02), ("exa", provider(2, 25), 0.03)], "domain")


def extraction_budget(spark, d):
    rows = read(spark, d, "customer").select("c_custkey", (F.col("c_custkey") % 7 / 4).alias("cost"))
    return O.within_budget(rows, "cost", 100.0, ["c_custkey"]).select("c_custkey", "spent_before")


def crm_export(spark, d):
    k = F.col("ord")
    df = leads(spark, d).withColumns({"contact_name": F.when(k % 3 == 0, "nan").otherwise(F.concat(F.lit("Ann Lee "), k)), "email_verified": F.when(k % 4 == 0, "valid").when(k % 4 == 1, "invalid")})
    return io.crm_contacts(df).select("email", "firstname", "lastname", "company", "jobtitle", "website", "phone", "instagram_handles", "fb_ad_count", "email_verified")


def message_export(spark, d):
    df = leads(spark, d).withColumn("contact_name", F.when(F.col("ord") % 3 == 0, "none").otherwise("Ann"))
    return io.message_contacts(df, spark.createDataFrame([("e4@x.example",), ("555-010-0007",), ("E8@X.example",)], "value string"))


def resumed_send(spark, d):
    log = leads(spark, d).filter("ord % 2 = 0").select("page_name", F.when(F.col("ord") % 4 == 0, "sent").otherwise("failed").alias("status"))
    return io.not_done(leads(spark, d).select("ord", "page_name"), log, "page_name")


def scrape_history(spark, d):
    e = read(spark, d, "events")
    old = e.filter("event_id % 2 = 0").groupBy("user_id").agg(F.min("ts").alias("first_seen"), F.max("ts").alias("last_seen"), F.count(F.lit(1)).alias("times"))
    return O.upsert(old, e.filter("event_id % 2 = 1").select("user_id", F.col("ts").alias("seen")), "user_id")


def bounce_mails(spark, d):
    k = F.col("o_orderkey")
    return read(spark, d, "orders").select(k, O.bounce(F.when(k % 3 == 0, "Mailer-Daemon@x.example").otherwise("ann@x.example"), F.when(k % 4 == 0, "Automatic reply: hi").when(k % 4 == 1, "Undeliverable: hi").otherwise("hi")).alias("bounce"))


_L = f"WITH {LEADS_SQL}"
_D = """WITH d AS (SELECT c_custkey AS k, CASE c_custkey % 5 WHEN 0 THEN 'None' WHEN 1 THEN NULL ELSE 'Ann Lee' || c_custkey END AS name, c_custkey % 2 = 0 AS info, CASE WHEN c_custkey % 3 = 0 THEN 'None' ELSE 'Ann' END AS greeted, c_custkey % 4 = 0 AS mark FROM customer),
f AS (SELECT k AS draft_id, 'contact_name' AS "check", 'critical' AS severity, coalesce(name, '') AS detail FROM d WHERE k % 5 < 2 UNION ALL SELECT k, 'template_vars', 'critical', 'offer' FROM d WHERE mark UNION ALL SELECT k, 'greeting', 'critical', greeted FROM d WHERE greeted = 'None'
  UNION ALL SELECT k, 'greeting', 'warning', greeted FROM d WHERE (k % 5 = 0 AND greeted <> 'None') OR (k % 5 > 1 AND greeted = 'None') UNION ALL SELECT k, 'email_name', 'info', 'info' FROM d WHERE info)"""
_POINTS = "CASE c_custkey % 5 WHEN 0 THEN 50 WHEN 1 THEN 20 WHEN 2 THEN 10 WHEN 3 THEN 0 ELSE 5 END"
_SCORE = f"CASE WHEN c_custkey % 5 = 3 THEN 0 ELSE least(100, CAST(trunc({_POINTS} + c_custkey % 101 * CAST(0.2 AS DOUBLE) + CASE WHEN c_custkey % 3 = 0 THEN 0 ELSE 15 END + CASE WHEN c_custkey % 4 = 0 THEN 5 ELSE 15 END) AS INT)) END"


def _provider(lo: int, n: int) -> str:
    return f"(SELECT s_suppkey % {n} AS domain, 'p{lo}-' || s_suppkey AS email, (['valid', 'accept_all', 'unknown', 'invalid'])[1 + s_suppkey % 4] AS status, s_suppkey % 97 AS confidence FROM supplier WHERE s_suppkey % 3 = {lo} QUALIFY row_number() OVER (PARTITION BY s_suppkey % {n} ORDER BY s_suppkey % 4, s_suppkey % 97 DESC, 'p{lo}-' || s_suppkey) = 1)"


QUERIES = {f.__name__: f for f in (draft_checks, draft_issues, draft_fixes, send_scores, send_eligibility, staged_enrichment, extraction_budget, crm_export, message_export, resumed_send, scrape_history, bounce_mails)}
SQL = {
    "draft_checks": f"{_D} SELECT * FROM f",
    "draft_issues": f'{_D} SELECT severity, "check", count(*) AS n, count(DISTINCT draft_id) AS drafts FROM f GROUP BY 1, 2',
    "draft_fixes": f"""{_D}, g AS (SELECT *, k % 5 < 2 AS bad, CASE WHEN k % 5 >= 2 THEN name WHEN info THEN '' ELSE 'Bob Ray' END AS n2 FROM d) SELECT k AS draft_id, n2 AS contact_name, 'Hi ' || CASE WHEN NOT bad THEN greeted WHEN n2 = '' THEN 'there' ELSE 'Bob' END || ',' || chr(10) || 'line one' || chr(10) || 'bye' AS email_body,
  concat_ws(',', CASE WHEN bad THEN 'contact_name' END, CASE WHEN bad THEN 'greeting' END, CASE WHEN mark THEN 'template_vars' END) AS changes FROM g""",
    "send_scores": f"SELECT c_custkey, score, CASE WHEN score >= 70 THEN 'send' WHEN score >= 50 THEN 'review' WHEN score >= 30 THEN 'risky' ELSE 'reject' END AS recommendation FROM (SELECT c_custkey, {_SCORE} AS score FROM customer)",
    "send_eligibility": f"{_L} SELECT ord, CASE WHEN ord % 11 = 0 THEN 'already_sent' WHEN primary_email IS NULL THEN 'invalid_email' WHEN ord % 500 % 7 = 0 THEN 'suppressed' WHEN ord % 100 < 50 THEN 'low_score' ELSE 'ready' END AS send_status FROM leads",
    "staged_enrichment": f"""WITH x AS (SELECT CAST(n_nationkey AS BIGINT) AS domain, h, a, e FROM nation LEFT JOIN {_provider(0, 20)} h ON h.domain = n_nationkey LEFT JOIN {_provider(1, 23)} a ON a.domain = n_nationkey LEFT JOIN {_provider(2, 25)} e ON e.domain = n_nationkey),
  y AS (SELECT domain, 0 AS i, 'hunter' AS stage, h.email AS email, h.status AS status, h.confidence AS confidence FROM x UNION ALL SELECT domain, 1, 'apollo', a.email, a.status, a.confidence FROM x UNION ALL SELECT domain, 2, 'exa', e.email, e.status, e.confidence FROM x),
  b AS (SELECT * FROM y WHERE email IS NOT NULL QUALIFY row_number() OVER (PARTITION BY domain ORDER BY CASE WHEN status = 'valid' THEN i ELSE 9 END, confidence DESC, i) = 1)
  SELECT x.domain, b.email, b.stage, b.status, b.confidence, CAST(CASE WHEN h.status IS NOT DISTINCT FROM 'valid' THEN 0.01 WHEN a.status IS NOT DISTINCT FROM 'valid' THEN 0.03 ELSE 0.06 END AS DOUBLE) AS cost FROM x LEFT JOIN b ON b.domain = x.domain""",
    "extraction_budget": "SELECT * FROM (SELECT c_custkey, coalesce(sum(c_custkey % 7 / 4) OVER (ORDER BY c_custkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS spent_before FROM customer) WHERE spent_before < 100",
    "crm_export": f"{_L} SELECT primary_email AS email, CASE WHEN ord % 3 = 0 THEN '' ELSE 'Ann' END AS firstname, CASE WHEN ord % 3 = 0 THEN '' ELSE 'Lee ' || ord END AS lastname, page_name AS company, coalesce(contact_position, '') AS jobtitle, coalesce(website_url, '') AS website, CASE WHEN phones IS NULL THEN '' ELSE '+1 (555) 010-' || right(phones, 4) END AS phone, CASE WHEN instagram_handles = '[]' THEN '' ELSE instagram_handles END AS instagram_handles, ad_count AS fb_ad_count, CASE ord % 4 WHEN 0 THEN 'true' WHEN 1 THEN 'false' ELSE '' END AS email_verified FROM leads WHERE primary_email IS NOT NULL",
    "message_export": f"{_L} SELECT page_name, CASE WHEN ord % 3 = 0 THEN '' ELSE 'Ann' END AS name, phones AS phone, ord % 3 > 0 AS named FROM leads WHERE phones IS NOT NULL AND coalesce(primary_email, '') NOT IN ('e4@x.example', 'e8@x.example') AND phones <> '555-010-0007'",
    "resumed_send": f"{_L} SELECT ord, page_name FROM leads WHERE page_name NOT IN (SELECT page_name FROM leads WHERE ord % 4 = 0)",
    "scrape_history": "SELECT user_id, min(ts) AS first_seen, max(ts) AS last_seen, count(*) AS times FROM events GROUP BY 1",
    "bounce_mails": "SELECT o_orderkey, o_orderkey % 4 <> 0 AND (o_orderkey % 3 = 0 OR o_orderkey % 4 = 1) AS bounce FROM orders",
}
