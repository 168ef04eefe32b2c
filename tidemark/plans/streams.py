"""Queries of incremental jobs. Each runs its stream over what has landed to its end and returns the table it leaves."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources.shared import folder as _folder
from ..streaming import jobs
from .proxies import MAILS_SQL, mails, read


def _events(spark, d):
    kind = F.when(F.col("event_type") == "click", "advance").when(F.col("event_type") == "view", "like").when(F.col("event_type") == "signup", "comment").when(F.col("event_type") == "error", "error").otherwise("none")
    return read(spark, d, "events").select(F.concat(F.lit("@u"), F.col("user_id") % 300).alias("handle"), kind.alias("kind"), F.concat(F.lit("post"), F.col("event_id") % 40).alias("post"), F.col("event_id").alias("ord"), "ts", "user_id", "event_type")


def stream_edges(spark, d):
    """Mails land in two parts; the job runs after each, and once more when nothing is new."""
    landing, out, marks = (_folder(spark, n) for n in ("landing", "edges", "marks"))
    m = mails(spark, d)
    for half in (0, 1):
        m.filter(F.crc32("message_id") % 2 == half).write.mode("append").parquet(landing)
        jobs.build_edges(jobs.landed(spark, landing, m.schema), out, marks)
    jobs.build_edges(jobs.landed(spark, landing, m.schema), out, marks)
    return jobs.edges(spark, out)


def stream_watermarks(spark, d):
    e = _events(spark, d)
    marks = jobs.watermarks(e.filter(F.col("ord") % 3 > 0), "user_id", "ts")
    return jobs.new_since(e, marks, "user_id", "ts").select("ord", "user_id")


def _land(spark, rows, parts, job):
    """Lands the parts of rows one after another, in the order of time, and runs the job after each."""
    landing = _folder(spark, "landing")
    for part in parts:
        rows.filter(part).write.mode("append").parquet(landing)
        job(jobs.landed(spark, landing, rows.schema))


def stream_windows(spark, d):
    """Windows over two landings with a watermark; the second goes on with the first's open windows."""
    out, marks = _folder(spark, "windows"), _folder(spark, "marks")
    e = _events(spark, d).select(F.col("ts").cast("timestamp").alias("ts"), "event_type")
    middle = e.agg(F.percentile_approx("ts", 0.5)).first()[0]
    _land(spark, e, (F.col("ts") < F.lit(middle), F.col("ts") >= F.lit(middle)), lambda s: jobs.keep_updates(jobs.windowed_counts(s, "ts", "event_type", "1 hour", "2 hours"), out, marks))
    return jobs.last_updates(spark, out, ["start", "event_type"])


def stream_warm_up(spark, d):
    """Events in three landings; the state of each prospect is kept between them, and a post that comes again doesn't count again."""
    out, marks = _folder(spark, "prospects"), _folder(spark, "marks")
    e = _events(spark, d).select("handle", "kind", "post", "ord")
    _land(spark, e, [F.col("ord") % 3 == k for k in range(3)], lambda s: jobs.keep_updates(jobs.warm_up(s), out, marks))
    return jobs.last_updates(spark, out, ["handle"])


def stream_quotas(spark, d):
    kinds = F.when(F.col("event_type") == "click", "follow").when(F.col("event_type") == "view", "like").otherwise("comment")
    e = read(spark, d, "events").select("event_id", F.to_date("ts").alias("day"), kinds.alias("kind"))
    return jobs.within_quotas(e, "day", "kind", "event_id").select("event_id", "kind")


_KIND = "count(*) FILTER (event_type = '{}')"
_POSTS = "count(DISTINCT event_id % 40) FILTER (event_type = '{}')"
QUERIES = {f.__name__: f for f in (stream_edges, stream_watermarks, stream_windows, stream_warm_up, stream_quotas)}
SQL = {
    "stream_edges": f"""WITH {MAILS_SQL} SELECT src, dst, count(*) AS n, min(sent) AS first, max(sent) AS last FROM (SELECT sender AS src, unnest(list_distinct(list_concat("to", cc))) AS dst, sent FROM mails) WHERE src <> dst GROUP BY 1, 2""",
    "stream_watermarks": "WITH m AS (SELECT user_id, max(ts) AS last_sync FROM events WHERE event_id % 3 > 0 GROUP BY 1) SELECT event_id AS ord, e.user_id FROM events e LEFT JOIN m USING (user_id) WHERE last_sync IS NULL OR ts > last_sync",
    "stream_windows": "SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2",
    "stream_warm_up": f"SELECT '@u' || (user_id % 300) AS handle, CASE WHEN {_KIND.format('click')} > 0 THEN 'in_progress' ELSE 'pending' END AS status, least(7, {_KIND.format('click')}) AS phase, {_POSTS.format('view')} AS likes, {_POSTS.format('signup')} AS comments, {_KIND.format('error')} AS errors FROM events GROUP BY 1",
    "stream_quotas": "SELECT event_id, kind FROM (SELECT *, row_number() OVER (PARTITION BY CAST(ts AS DATE), kind ORDER BY event_id) AS r FROM (SELECT event_id, ts, CASE event_type WHEN 'click' THEN 'follow' WHEN 'view' THEN 'like' ELSE 'comment' END AS kind FROM events)) WHERE r <= CASE kind WHEN 'follow' THEN 25 WHEN 'like' THEN 75 ELSE 12 END",
}
