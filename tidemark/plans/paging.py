"""Sources that answer in pages, and mailboxes that grow."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources import paged
from ..sources.shared import folder
from ..streaming import jobs
from .proxies import MAILS_SQL, mails, read

SINCE, UNTIL = "1995-06-01 00:00:00", "1997-03-01 00:00:00"
OWNERS = [3, 7, 11]


def _deals(spark, d):
    o = read(spark, d, "orders")
    return o.select(F.col("o_orderkey").alias("id"), (F.col("o_custkey") % 20).alias("owner"), F.col("o_totalprice").alias("amount"), F.col("o_orderdate").cast("timestamp").alias("closed"), F.concat(F.lit('said "'), F.col("o_orderstatus"), F.lit('", ñ')).alias("reason"))


def paged_deals(spark, d):
    """Deals of some owners within a time, from pages of a hundred."""
    path, deals = folder(spark, "deals"), _deals(spark, d)
    paged.land_pages(deals, path, "owner", "closed", "id")
    return paged.pages(spark, path, deals.schema, "owner", "closed", OWNERS, SINCE, UNTIL)


def paged_listings(spark, d):
    """All listings of all cities, from pages."""
    path = folder(spark, "listings")
    rows = read(spark, d, "lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), F.concat(F.lit("city"), F.col("l_suppkey") % 7).alias("city"), F.col("l_shipdate").cast("timestamp").alias("listed"), F.col("l_extendedprice").alias("price"))
    paged.land_pages(rows, path, "city", "listed", "id", rows=500)
    return paged.pages(spark, path, rows.schema, "city", "listed")


def stream_mailboxes(spark, d):
    """Messages land in five accounts' mailboxes in two rounds, half of the first once more in the second; edges come from a stream with an offset for each account."""
    landing, out, marks = (folder(spark, n) for n in ("mailboxes", "edges", "marks"))
    m = mails(spark, d).select("message_id", "sender", "to", "cc", "sent", "subject", F.concat(F.lit("box"), F.pmod(F.xxhash64("sender"), F.lit(5))).alias("account"))
    half = F.crc32("message_id") % 4
    for k, part in enumerate((half < 2, half > 0)):
        paged.land_messages(m.filter(part), landing, "account", k)
        jobs.build_edges(paged.mailbox(spark, landing, m.schema), out, marks)
    return jobs.edges(spark, out)


def stream_warm_up_times(spark, d):
    """Events in three landings by time; phases with their times, and retries that come due as time goes on."""
    landing, out, marks = (folder(spark, n) for n in ("landing", "prospects", "marks"))
    kinds = {"click": "advance", "view": "like", "signup": "comment", "error": "error", "purchase": "follow"}
    kind = F.coalesce(*(F.when(F.col("event_type") == a, F.lit(b)) for a, b in kinds.items()), F.lit("none"))
    e = read(spark, d, "events").select(F.concat(F.lit("@u"), F.col("user_id") % 300).alias("handle"), kind.alias("kind"), F.concat(F.lit("post"), F.col("event_id") % 40).alias("post"), F.col("ts").cast("timestamp").alias("ts"))
    a, b = e.agg(F.percentile_approx("ts", [0.33, 0.66])).first()[0]
    for part in (F.col("ts") < F.lit(a), (F.col("ts") >= F.lit(a)) & (F.col("ts") < F.lit(b)), F.col("ts") >= F.lit(b)):
        e.filter(part).write.mode("append").parquet(landing)
        jobs.keep_updates(jobs.warm_up_with_times(jobs.landed(spark, landing, e.schema)), out, marks)
    return jobs.last_updates(spark, out, ["handle"], "retries", "errors", "likes", "comments", "phase")


QUERIES = {f.__name__: f for f in (paged_deals, paged_listings, stream_mailboxes, stream_warm_up_times)}
SQL = {
    "paged_deals": f"SELECT o_orderkey AS id, o_custkey % 20 AS owner, o_totalprice AS amount, CAST(o_orderdate AS TIMESTAMP) AS closed, 'said \"' || o_orderstatus || '\", ñ' AS reason FROM orders WHERE o_custkey % 20 IN (3, 7, 11) AND o_orderdate >= TIMESTAMP '{SINCE}' AND o_orderdate < TIMESTAMP '{UNTIL}'",
    "paged_listings": "SELECT l_orderkey * 10 + l_linenumber AS id, 'city' || (l_suppkey % 7) AS city, CAST(l_shipdate AS TIMESTAMP) AS listed, l_extendedprice AS price FROM lineitem",
    "stream_mailboxes": f"""WITH {MAILS_SQL} SELECT src, dst, count(*) AS n, min(sent) AS first, max(sent) AS last FROM (SELECT sender AS src, unnest(list_distinct(list_concat("to", cc))) AS dst, sent FROM mails) WHERE src <> dst GROUP BY 1, 2""",
    "stream_warm_up_times": """WITH e AS (SELECT '@u' || (user_id % 300) AS handle, event_type AS t, event_id % 40 AS post, ts FROM events), m AS (SELECT max(ts) - INTERVAL 1 HOUR AS mark FROM e)
  SELECT handle, CASE WHEN count(*) FILTER (t = 'click') > 0 THEN 'in_progress' ELSE 'pending' END AS status, CAST(least(7, count(*) FILTER (t = 'click')) AS INT) AS phase, min(ts) FILTER (t = 'click') AS started, max(ts) FILTER (t = 'click') AS moved, min(ts) FILTER (t = 'purchase') AS followed,
  count(DISTINCT post) FILTER (t = 'view') AS likes, count(DISTINCT post) FILTER (t = 'signup') AS comments, CAST(count(*) FILTER (t = 'error') AS INT) AS errors, CAST(count(DISTINCT epoch_ms(ts)) FILTER (t = 'error' AND ts + INTERVAL 2 HOUR <= (SELECT mark FROM m)) AS INT) AS retries FROM e GROUP BY 1""",
}
