"""Deal queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import funnel as O
from .proxies import AS_OF, DEALS_SQL, deals, read

DAYS = 365
HYGIENE = [("Duplicado", ["duplica", "ya tiene"]), ("Enero", ["enero", "retomar"]), ("Presupuesto", ["presupuesto", "budget"])]
WORDS = {"zoho": "Zoho", "excel": "Excel", "tipo de cambio": "Cambio", "enero": "Enero"}


def _lost(spark, d):
    return deals(spark, d).filter("status = 'lost'")


def _owners(spark, d):
    return deals(spark, d).select("owner").distinct().union(spark.createDataFrame([("nobody",)], "owner string"))


def _rounded(df, *columns, places=2):
    return df.withColumns({c: F.round(c, places) for c in columns})


def funnel_loss_reasons(spark, d):
    return _rounded(O.loss_reasons(_lost(spark, d)), "pct")


def funnel_profiles(spark, d):
    return _rounded(O.profiles(_lost(spark, d)), "pct", "avg_amount")


def funnel_by_owner(spark, d):
    return _rounded(O.by_owner(_lost(spark, d), _owners(spark, d)), "total_amount", "noshow_rate")


def funnel_owner_quality(spark, d):
    return _rounded(O.owner_quality(_lost(spark, d)), "quality")


def funnel_efficiency(spark, d):
    return _rounded(O.efficiency(_lost(spark, d), _owners(spark, d)), "total_amount", "avg_deal").withColumn("efficiency_rank", F.col("efficiency_rank").cast("long"))


def funnel_revenue_by_reason(spark, d):
    return _rounded(O.revenue_by(_lost(spark, d)), "revenue", "count_pct", "revenue_pct", "avg_deal")


def funnel_pareto(spark, d):
    return _rounded(O.pareto(O.revenue_by(_lost(spark, d))), "revenue", "revenue_pct", "cumulative_pct")


def funnel_size_segments(spark, d):
    return _rounded(O.size_segments(_lost(spark, d)), "revenue", "pct")


def funnel_text_buckets(spark, d):
    return _rounded(O.first_bucket(_lost(spark, d), "details", HYGIENE, "Otro"), "revenue", "pct")


def funnel_mentions(spark, d):
    return _rounded(O.mentions(_lost(spark, d), "details", WORDS), "revenue")


def funnel_first_keyword(spark, d):
    return O.first_keyword(_lost(spark, d), "details", ["bolivia", "cambio", "presupuesto", "enero"]).select("id", "keyword")


def funnel_by_source(spark, d):
    return _rounded(O.by_source(_lost(spark, d)), "revenue", "count_pct", "revenue_pct", "avg_deal")


def funnel_source_by_owner(spark, d):
    return _rounded(O.source_by_owner(deals(spark, d)), "pct")


PERFORMANCE = ["owner", "total", "won", "lost", "open", "revenue_won", "revenue_lost", "avg_days_won", "avg_days_lost", "demo_total", "demo_won", "noshow", "hygiene", "prev_total", "prev_won", "prev_lost", "win_rate", "prev_win_rate", "demo_win_rate", "quality_score", "avg_deal_won"]


def funnel_owner_performance(spark, d):
    df = O.owner_performance(deals(spark, d), AS_OF, DAYS)
    return df.select(*(F.round(c, 2).alias(c) if t == "double" else F.col(c) for c, t in df.select(*PERFORMANCE).dtypes))


def funnel_periods(spark, d):
    return O.in_period(deals(spark, d), "created", AS_OF, DAYS).groupBy("period", "status").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("amount"), 2).alias("amount"))


def funnel_top_deals(spark, d):
    return _rounded(O.top_deals(deals(spark, d), "won", 10), "amount")


def funnel_activity(spark, d):
    kinds = F.when(F.col("event_type") == "click", "call").when(F.col("event_type") == "view", "meeting").when(F.col("event_type") == "signup", "email")
    engagements = read(spark, d, "events").select(F.concat(F.lit("owner"), F.col("user_id") % 12).alias("owner"), kinds.alias("type"))
    return _rounded(O.activity(engagements, O.owner_performance(deals(spark, d), AS_OF, DAYS)), "per_deal")


def funnel_parse(spark, d):
    raw = read(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.when(F.col("o_orderkey") % 7 == 0, "n/a").otherwise((F.col("o_orderkey") % 900).cast("string")).alias("amount"), (F.col("o_custkey") % 12).cast("string").alias("owner_id"), F.col("o_orderstatus").alias("stage"))
    owners = spark.createDataFrame([(str(i), f"Owner {i}") for i in range(10)], "owner_id string, owner_name string")
    return O.parse(raw, owners, ["P"], ["F"]).select("id", "amount", "owner", "status")


_L = f"WITH {DEALS_SQL}, lost AS (SELECT * FROM deals WHERE status = 'lost')"
_BUCKET = "CASE WHEN contains(d, 'duplica') OR contains(d, 'ya tiene') THEN 'Duplicado' WHEN contains(d, 'enero') OR contains(d, 'retomar') THEN 'Enero' WHEN contains(d, 'presupuesto') OR contains(d, 'budget') THEN 'Presupuesto' ELSE 'Otro' END"
_NOW = f"created >= TIMESTAMP '{AS_OF}' - INTERVAL {DAYS} DAY"
_OLD = f"created >= TIMESTAMP '{AS_OF}' - INTERVAL {2 * DAYS} DAY"
_TOOK = "CAST(floor((epoch_us(closed) - epoch_us(created)) / 86400000000) AS BIGINT)"
_REVENUE = "SELECT {k} AS {n}, count(*) AS n, round(sum(amount), 2) AS revenue, round(count(*) * 100.0 / sum(count(*)) OVER (), 2) AS count_pct, round(sum(amount) * 100 / sum(sum(amount)) OVER (), 2) AS revenue_pct, round(sum(amount) / count(*), 2) AS avg_deal FROM lost GROUP BY 1"
_PERF = f"""SELECT owner, count(*) FILTER (now) AS total, count(*) FILTER (now AND status = 'won') AS won, count(*) FILTER (now AND status = 'lost') AS lost, count(*) FILTER (now AND status = 'open') AS open, coalesce(sum(amount) FILTER (now AND status = 'won'), 0) AS revenue_won,
  coalesce(sum(amount) FILTER (now AND status = 'lost'), 0) AS revenue_lost, coalesce(avg({_TOOK}) FILTER (now AND status = 'won'), 0) AS avg_days_won, coalesce(avg({_TOOK}) FILTER (now AND status = 'lost'), 0) AS avg_days_lost, count(*) FILTER (now AND demo) AS demo_total, count(*) FILTER (now AND demo AND status = 'won') AS demo_won,
  count(*) FILTER (now AND contains(reason, 'no_asistio')) AS noshow, count(*) FILTER (now AND contains(reason, 'higiene')) AS hygiene, count(*) FILTER (NOT now) AS prev_total, count(*) FILTER (NOT now AND status = 'won') AS prev_won, count(*) FILTER (NOT now AND status = 'lost') AS prev_lost FROM (SELECT *, {_NOW} AS now FROM deals WHERE {_OLD}) GROUP BY 1"""

QUERIES = {f.__name__: f for f in (funnel_loss_reasons, funnel_profiles, funnel_by_owner, funnel_owner_quality, funnel_efficiency, funnel_revenue_by_reason, funnel_pareto, funnel_size_segments, funnel_text_buckets, funnel_mentions, funnel_first_keyword, funnel_by_source, funnel_source_by_owner, funnel_owner_performance, funnel_periods, funnel_top_deals, funnel_activity, funnel_parse)}
SQL = {
    "funnel_loss_reasons": f"{_L} SELECT reason, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 2) AS pct FROM lost WHERE reason IS NOT NULL GROUP BY 1",
    "funnel_profiles": f"{_L} SELECT * FROM (SELECT coalesce(lower(profile), '') AS profile, count(*) AS n, round(avg(amount), 2) AS avg_amount, round(count(*) * 100.0 / sum(count(*)) OVER (), 2) AS pct FROM lost GROUP BY 1) WHERE profile <> ''",
    "funnel_by_owner": f"{_L}, o AS (SELECT DISTINCT owner FROM deals UNION ALL SELECT 'nobody') SELECT o.owner, count(id) AS n, round(coalesce(sum(amount), 0), 2) AS total_amount, count(*) FILTER (contains(reason, 'no_asistio')) AS noshow, round(CASE WHEN count(id) > 0 THEN count(*) FILTER (contains(reason, 'no_asistio')) * 100.0 / count(id) ELSE 0 END, 2) AS noshow_rate FROM o LEFT JOIN lost USING (owner) GROUP BY 1",
    "funnel_owner_quality": f"{_L} SELECT owner, count(*) AS total, count(*) FILTER (contains(reason, 'higiene')) AS hygiene, count(*) FILTER (contains(reason, 'no_asistio')) AS noshow, round(100 - (count(*) FILTER (contains(reason, 'higiene')) + count(*) FILTER (contains(reason, 'no_asistio'))) * 100.0 / count(*), 2) AS quality FROM lost GROUP BY 1",
    "funnel_efficiency": f"{_L}, o AS (SELECT DISTINCT owner FROM deals UNION ALL SELECT 'nobody') SELECT o.owner, count(id) AS n, round(coalesce(sum(amount), 0), 2) AS total_amount, round(coalesce(sum(amount) / count(id), 0), 2) AS avg_deal, row_number() OVER (ORDER BY coalesce(sum(amount) / count(id), 0) DESC, o.owner) AS efficiency_rank FROM o LEFT JOIN lost USING (owner) GROUP BY 1",
    "funnel_revenue_by_reason": f"{_L} " + _REVENUE.format(k="coalesce(reason, 'unknown')", n="reason"),
    "funnel_pareto": f"{_L}, r AS (SELECT coalesce(reason, 'unknown') AS reason, sum(amount) AS revenue FROM lost GROUP BY 1) SELECT reason, round(revenue, 2) AS revenue, round(revenue * 100 / sum(revenue) OVER (), 2) AS revenue_pct, round(sum(revenue) OVER (ORDER BY revenue DESC, reason) * 100 / sum(revenue) OVER (), 2) AS cumulative_pct FROM r",
    "funnel_size_segments": f"{_L}, s AS (SELECT unnest(['Small', 'Medium', 'Enterprise']) AS segment) SELECT s.segment, count(id) AS n, round(coalesce(sum(amount), 0), 2) AS revenue, round(count(id) * 100.0 / sum(count(id)) OVER (), 2) AS pct FROM s LEFT JOIN lost ON s.segment = CASE WHEN amount <= 500 THEN 'Small' WHEN amount <= 2000 THEN 'Medium' ELSE 'Enterprise' END GROUP BY 1",
    "funnel_text_buckets": f"{_L} SELECT {_BUCKET} AS bucket, count(*) AS n, round(sum(amount), 2) AS revenue, round(count(*) * 100.0 / sum(count(*)) OVER (), 2) AS pct FROM (SELECT *, lower(coalesce(details, '')) AS d FROM lost) GROUP BY 1",
    "funnel_mentions": f"{_L}, w AS (SELECT unnest(['zoho', 'excel', 'tipo de cambio', 'enero']) AS w, unnest(['Zoho', 'Excel', 'Cambio', 'Enero']) AS label) SELECT label, count(*) AS mentions, round(sum(amount), 2) AS revenue FROM lost JOIN w ON contains(lower(details), w) GROUP BY 1",
    "funnel_first_keyword": f"{_L} SELECT * FROM (SELECT id, CASE WHEN contains(details, 'cambio') THEN 'cambio' WHEN contains(details, 'presupuesto') THEN 'presupuesto' WHEN contains(details, 'enero') THEN 'enero' END AS keyword FROM lost) WHERE keyword IS NOT NULL",
    "funnel_by_source": f"{_L}, top AS (SELECT source, array_to_string(list(r || ':' || c ORDER BY p), ',') AS top_reasons FROM (SELECT coalesce(source, 'Unknown') AS source, coalesce(reason, 'N/A') AS r, count(*) AS c, row_number() OVER (PARTITION BY coalesce(source, 'Unknown') ORDER BY count(*) DESC, coalesce(reason, 'N/A')) AS p FROM lost GROUP BY 1, 2) WHERE p <= 3 GROUP BY 1), s AS (" + _REVENUE.format(k="coalesce(source, 'Unknown')", n="source") + ") SELECT s.*, top_reasons FROM s LEFT JOIN top USING (source)",
    "funnel_source_by_owner": f"WITH {DEALS_SQL} SELECT owner, coalesce(source, 'Unknown') AS source, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (PARTITION BY owner), 2) AS pct FROM deals GROUP BY 1, 2",
    "funnel_owner_performance": f"WITH {DEALS_SQL}, p AS ({_PERF}) SELECT owner, total, won, lost, open, round(revenue_won, 2) AS revenue_won, round(revenue_lost, 2) AS revenue_lost, round(avg_days_won, 2) AS avg_days_won, round(avg_days_lost, 2) AS avg_days_lost, demo_total, demo_won, noshow, hygiene, prev_total, prev_won, prev_lost, round(CASE WHEN won + lost > 0 THEN won * 100.0 / (won + lost) ELSE 0 END, 2) AS win_rate, round(CASE WHEN prev_won + prev_lost > 0 THEN prev_won * 100.0 / (prev_won + prev_lost) ELSE 0 END, 2) AS prev_win_rate, round(CASE WHEN demo_total > 0 THEN demo_won * 100.0 / demo_total ELSE 0 END, 2) AS demo_win_rate, round(100 - CASE WHEN lost > 0 THEN noshow * 100.0 / lost ELSE 0 END - CASE WHEN lost > 0 THEN hygiene * 100.0 / lost ELSE 0 END, 2) AS quality_score, round(CASE WHEN won > 0 THEN revenue_won / won ELSE 0 END, 2) AS avg_deal_won FROM p",
    "funnel_periods": f"WITH {DEALS_SQL} SELECT CASE WHEN {_NOW} THEN 'current' ELSE 'previous' END AS period, status, count(*) AS n, round(sum(amount), 2) AS amount FROM deals WHERE {_OLD} GROUP BY 1, 2",
    "funnel_top_deals": f"WITH {DEALS_SQL} SELECT id, owner, round(amount, 2) AS amount, coalesce({_TOOK}, 0) AS days_to_close FROM deals WHERE status = 'won' AND amount > 0 ORDER BY deals.amount DESC, id LIMIT 10",
    "funnel_activity": f"WITH {DEALS_SQL}, p AS ({_PERF}), e AS (SELECT 'owner' || (user_id % 12) AS owner, count(*) FILTER (event_type = 'click') AS calls, count(*) FILTER (event_type = 'view') AS meetings, count(*) FILTER (event_type = 'signup') AS emails FROM events GROUP BY 1) SELECT owner, coalesce(calls, 0) AS calls, coalesce(meetings, 0) AS meetings, coalesce(emails, 0) AS emails, coalesce(calls + meetings + emails, 0) AS activity, round(CASE WHEN total > 0 THEN coalesce(calls + meetings + emails, 0) / total ELSE 0 END, 2) AS per_deal FROM p LEFT JOIN e USING (owner)",
    "funnel_parse": "SELECT o_orderkey AS id, CASE WHEN o_orderkey % 7 = 0 THEN 0.0 ELSE CAST(o_orderkey % 900 AS DOUBLE) END AS amount, CASE WHEN o_custkey % 12 < 10 THEN 'Owner ' || (o_custkey % 12) ELSE CAST(o_custkey % 12 AS VARCHAR) END AS owner, CASE o_orderstatus WHEN 'P' THEN 'won' WHEN 'F' THEN 'lost' ELSE 'open' END AS status FROM orders",
}
