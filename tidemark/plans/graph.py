"""Contact-graph queries over mails made of orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import days_between
from ..operators import graph as G
from .proxies import AS_OF, MAILS_SQL, mails

ME = "p1@d1.example"
MINE = [ME]


def _targets(spark, d):
    return spark.createDataFrame([(f"p{k}@d{k % 9}.example",) for k in range(0, 60, 3)] + [("nobody@d4.example",), ("nobody@void.example",)], "target string")


def graph_knows(spark, d):
    return G.knows(mails(spark, d))


def graph_together(spark, d):
    return G.together(mails(spark, d))


def graph_pair_log(spark, d):
    return G.together(mails(spark, d), with_sender=True)


def graph_contact_stats(spark, d):
    return G.contact_stats(mails(spark, d), MINE)


def graph_replies(spark, d):
    return G.replies(mails(spark, d), MINE)


def graph_bidirectional(spark, d):
    return G.bidirectional(G.knows(mails(spark, d)).select("src", "dst", "n"))


def graph_strengths(spark, d):
    k = G.bidirectional(G.knows(mails(spark, d)))
    days = days_between(F.lit(AS_OF).cast("timestamp"), F.col("last"))
    return k.select("src", "dst", G.strength_v0(F.col("n"), days).alias("v0"), G.strength_pairs(F.col("n"), days, days_between(F.col("last"), F.col("first"))).alias("pairs"), G.strength_v1(F.col("n"), days, F.col("bidirectional")).alias("v1"))


def graph_scored_contacts(spark, d):
    return G.scored_contacts(mails(spark, d), MINE, AS_OF).select("contact", "sent", "received", "replies", F.round("reply_rate", 4).alias("reply_rate"), "days", "strength")


def graph_introductions(spark, d):
    return G.introductions(mails(spark, d))


def graph_one_hop(spark, d):
    return G.one_hop(G.knows(mails(spark, d)), ME, _targets(spark, d)).select("target", "connector", "n", "reach")


def graph_best_paths(spark, d):
    m = mails(spark, d)
    return G.best_paths(G.knows(m), G.together(m), ME, _targets(spark, d), AS_OF)


def graph_tiers(spark, d):
    stats = G.contact_stats(mails(spark, d), MINE).join(G.replies(mails(spark, d), MINE), "contact", "left").na.fill({"replies": 0})
    return G.tiers(stats, ["d3.example"], ["p10@"], ["@d2", "@d5"])


def graph_latest_mails(spark, d):
    return G.latest_mails(mails(spark, d)).withColumn("place", F.col("place").cast("long"))


def graph_merge_people(spark, d):
    same = spark.createDataFrame([("p10@d1.example", "p1@d1.example"), ("p12@d3.example", "p3@d3.example")], "old string, new string")
    return G.merge_people(G.knows(mails(spark, d)), same)


_M = f"WITH {MAILS_SQL}"
_K = f"""{_M}, knows AS (SELECT src, dst, count(*) AS n, min(sent) AS first, max(sent) AS last, arg_max(subject, (sent, message_id)) AS last_subject FROM (SELECT sender AS src, unnest(list_distinct(list_concat("to", cc))) AS dst, sent, message_id, subject FROM mails) WHERE src <> dst GROUP BY 1, 2)"""
_DAYS = f"CAST(floor((epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(last)) / 86400000000) AS BIGINT)"
_SPAN = "CAST(floor((epoch_us(last) - epoch_us(first)) / 86400000000) AS BIGINT)"
_FRESH = "CASE WHEN days <= 30 THEN 3 WHEN days <= 90 THEN 2 WHEN days <= 180 THEN 1 ELSE 0 END"
_V0 = f"CASE WHEN n = 0 THEN 0 ELSE least(10, CASE WHEN n <= 5 THEN least(2, n) WHEN n <= 20 THEN 3 + (n - 5) // 8 WHEN n <= 50 THEN 5 + (n - 20) // 15 ELSE 7 END + {_FRESH}) END"


def _pairs(people: str) -> str:
    return f"""{_M}, p AS (SELECT unnest(ps) AS a, ps, sent FROM (SELECT list_distinct({people}) AS ps, sent FROM mails)), q AS (SELECT a, unnest(ps) AS b, sent FROM p) SELECT a, b, count(*) AS n, min(sent) AS first, max(sent) AS last FROM q WHERE a < b GROUP BY 1, 2"""


_STATS = f"""stats AS (SELECT contact, sum(s) AS sent, sum(r) AS received, sum(CASE WHEN s = 1 THEN k ELSE 0 END) AS recipients_sent, sum(CASE WHEN r = 1 THEN k ELSE 0 END) AS recipients_received, min(sent) AS first, max(sent) AS last FROM (
  SELECT unnest("to") AS contact, 1 AS s, 0 AS r, len("to") + len(cc) AS k, sent FROM mails WHERE sender = '{ME}' UNION ALL SELECT sender, 0, 1, len("to") + len(cc), sent FROM mails WHERE sender <> '{ME}' AND list_contains("to", '{ME}')) WHERE contact <> '{ME}' GROUP BY 1),
replied AS (SELECT r.sender AS contact, count(*) AS replies FROM mails r WHERE r.sender <> '{ME}' AND EXISTS (SELECT 1 FROM mails o WHERE o.sender = '{ME}' AND o.message_id = r.in_reply_to AND o.sent < r.sent) GROUP BY 1)"""
_TARGETS = "targets AS (SELECT 'p' || k || '@d' || (k % 9) || '.example' AS target FROM range(0, 60, 3) t(k) UNION ALL SELECT 'nobody@d4.example' UNION ALL SELECT 'nobody@void.example')"
_CC = """cc AS (SELECT a, b, count(*) AS n FROM (SELECT a, unnest(ps) AS b FROM (SELECT unnest(ps) AS a, ps FROM (SELECT list_distinct(list_concat("to", cc)) AS ps FROM mails))) WHERE a < b GROUP BY 1, 2)"""
_HOP = f"SELECT f.dst AS target, 'one_hop' AS path_type, m.dst AS connector, m.n, f.n AS reach FROM knows m JOIN knows f ON f.src = m.dst JOIN targets t ON t.target = f.dst WHERE m.src = '{ME}' AND m.dst <> '{ME}' AND m.dst <> f.dst AND f.dst <> '{ME}'"
_PATHS = f"""found AS (SELECT dst AS target, 'direct' AS path_type, NULL AS connector, n, 0 AS reach, 1 AS o FROM knows JOIN targets ON dst = target WHERE src = '{ME}' UNION ALL SELECT *, 2 FROM ({_HOP})
  UNION ALL SELECT target, 'company_connection', dst, n, 0, 3 FROM knows JOIN targets ON split_part(dst, '@', 2) = split_part(target, '@', 2) WHERE src = '{ME}' AND dst <> target
  UNION ALL SELECT c.b, 'cc_together', k.dst, k.n, c.n, 4 FROM knows k JOIN (SELECT a, b, n FROM cc UNION ALL SELECT b, a, n FROM cc) c ON c.a = k.dst JOIN targets ON target = c.b WHERE k.src = '{ME}' AND k.dst <> '{ME}' AND k.dst <> c.b AND c.b <> '{ME}'),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY target ORDER BY o, n DESC, reach DESC, connector) AS r FROM found) WHERE r = 1),
own AS (SELECT dst, {_V0} AS s FROM (SELECT *, {_DAYS} AS days FROM knows WHERE src = '{ME}'))"""

QUERIES = {f.__name__: f for f in (graph_knows, graph_together, graph_pair_log, graph_contact_stats, graph_replies, graph_bidirectional, graph_strengths, graph_scored_contacts, graph_introductions, graph_one_hop, graph_best_paths, graph_tiers, graph_latest_mails, graph_merge_people)}
SQL = {
    "graph_knows": f"{_K} SELECT * FROM knows",
    "graph_together": _pairs('list_concat("to", cc)'),
    "graph_pair_log": _pairs('list_concat("to", cc, [sender])'),
    "graph_contact_stats": f"{_M}, {_STATS} SELECT * FROM stats",
    "graph_replies": f"{_M}, {_STATS} SELECT * FROM replied",
    "graph_bidirectional": f"{_K} SELECT a.src, a.dst, a.n, EXISTS (SELECT 1 FROM knows b WHERE b.src = a.dst AND b.dst = a.src) AS bidirectional FROM knows a",
    "graph_strengths": f"{_K} SELECT src, dst, {_V0} AS v0, greatest(1, least(10, CASE WHEN n <= 5 THEN 1 WHEN n <= 15 THEN 2 WHEN n <= 30 THEN 3 ELSE 4 END + CASE WHEN days <= 7 THEN 4 WHEN days <= 30 THEN 3 WHEN days <= 90 THEN 2 WHEN days <= 180 THEN 1 ELSE 0 END + CASE WHEN span >= 365 THEN 2 WHEN span >= 180 THEN 1 ELSE 0 END)) AS pairs, CAST(trunc(least(n * 5, 40) + greatest(0, 30 - days / 30) + CASE WHEN bi THEN 30 ELSE 0 END) AS INT) AS v1 FROM (SELECT *, {_DAYS} AS days, {_SPAN} AS span, EXISTS (SELECT 1 FROM knows b WHERE b.src = a.dst AND b.dst = a.src) AS bi FROM knows a)",
    "graph_scored_contacts": f"""{_M}, {_STATS}, x AS (SELECT contact, sent, received, coalesce(replies, 0) AS replies, CASE WHEN sent > 0 THEN least(1.0, coalesce(replies, 0) / sent) ELSE 0 END AS rate, {_DAYS} AS days, CASE WHEN sent > 0 THEN recipients_sent / sent ELSE 0 END AS avs, CASE WHEN received > 0 THEN recipients_received / received ELSE 0 END AS avr FROM stats LEFT JOIN replied USING (contact))
  SELECT contact, sent, received, replies, round(rate, 4) AS reply_rate, days, greatest(0, least(100, CAST(trunc((least(35, 5 + 10 * log10(sent + received + 1)) + 25 * exp(-days / 365) + CASE WHEN sent > 0 AND received > 0 THEN 25 * least(sent, received) / greatest(sent, received) ELSE 5 END + 15 * rate)
  * CASE WHEN (avs + avr) / 2 > 20 THEN 0.5 WHEN (avs + avr) / 2 > 10 THEN 0.7 WHEN (avs + avr) / 2 > 5 THEN 0.85 ELSE 1 END * CASE WHEN received >= 3 AND sent >= 2 AND rate = 0 THEN 0.7 WHEN received >= 5 AND sent = 0 THEN 0.5 ELSE 1 END) AS INT))) AS strength FROM x""",
    "graph_introductions": f"""{_M}, p AS (SELECT message_id, sender, sent, cc1 AS cc, unnest("to") AS "to" FROM (SELECT *, unnest(cc) AS cc1 FROM mails)) SELECT message_id, sender AS introducer, cc AS introduced, "to" AS introduced_to, sent FROM (SELECT *, row_number() OVER (PARTITION BY least(cc, "to"), greatest(cc, "to") ORDER BY sent, message_id, cc) AS r FROM p WHERE cc <> "to") WHERE r = 1""",
    "graph_one_hop": f"{_K}, {_TARGETS} SELECT target, connector, n, reach FROM ({_HOP})",
    "graph_best_paths": f"{_K}, {_TARGETS}, {_CC}, {_PATHS} SELECT t.target, coalesce(path_type, 'cold') AS path_type, connector, n, reach, CASE path_type WHEN 'direct' THEN least(50, n) * 2 WHEN 'one_hop' THEN CAST(trunc(coalesce(s, 0) * 10 * 0.6) AS INT) WHEN 'company_connection' THEN CAST(trunc(coalesce(s, 0) * 10 * 0.4) AS INT) WHEN 'cc_together' THEN CAST(trunc(coalesce(s, 0) * 10 * 0.3) AS INT) ELSE 0 END AS path_strength FROM targets t LEFT JOIN best USING (target) LEFT JOIN own ON own.dst = best.connector",
    "graph_tiers": f"{_M}, {_STATS} SELECT * FROM (SELECT contact, CASE WHEN regexp_matches(contact, '@d2|@d5') AND coalesce(replies, 0) > 0 THEN 1 WHEN sent + received >= 3 THEN 2 WHEN coalesce(replies, 0) > 0 THEN 3 END AS tier, sent + received AS total FROM stats LEFT JOIN replied USING (contact) WHERE split_part(contact, '@', 2) <> 'd3.example' AND NOT contains(contact, 'p10@')) WHERE tier IS NOT NULL",
    "graph_latest_mails": f"""{_M} SELECT contact, message_id, place FROM (SELECT contact, message_id, row_number() OVER (PARTITION BY contact ORDER BY sent DESC, message_id) AS place FROM (SELECT unnest(list_distinct(list_concat([sender], "to"))) AS contact, message_id, sent FROM mails)) WHERE place <= 3""",
    "graph_merge_people": f"{_K}, moved AS (SELECT CASE src WHEN 'p10@d1.example' THEN 'p1@d1.example' WHEN 'p12@d3.example' THEN 'p3@d3.example' ELSE src END AS src, CASE dst WHEN 'p10@d1.example' THEN 'p1@d1.example' WHEN 'p12@d3.example' THEN 'p3@d3.example' ELSE dst END AS dst, n, first, last FROM knows) SELECT src, dst, sum(n) AS n, min(first) AS first, max(last) AS last FROM moved WHERE src <> dst GROUP BY 1, 2",
}
