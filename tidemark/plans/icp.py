"""Advertiser queries, from ads to the leaderboard."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import patterns as P
from ..operators import ads as A
from ..sources.shared import stored
from .proxies import ADS_SQL, AS_OF, read
from .proxies import ads as raw_ads


def _ads(spark, d):
    return A.normalize(raw_ads(spark, d), AS_OF)


def _pages(spark, d):
    return A.pages(_ads(spark, d), AS_OF, extended=True)


def _gated(spark, d):
    """Pages that are gated by whole texts of all their ads."""
    return A.gate(A.pages(_ads(spark, d), AS_OF, extended=True, whole=True))


def _scored(spark, d, whole=False):
    """Scored pages, by the beginning of their texts, or whole, by whole texts of all their ads."""
    return A.clusters(A.scores(_gated(spark, d) if whole else A.gate(_pages(spark, d))))


def _ranked(spark, d, whole=False):
    """Scores are computed once and kept, so that ranks, medians and names read columns of a table."""
    scores = [c for c in ("total_score", "money_score", "urgency_score", "fit_score", "share_message", "share_call", "share_form", "share_web")]
    kept = stored(_scored(spark, d, whole).select("page_id", "page_name", "behavioral_cluster", "gate_passed", *scores), "scores")
    return A.ranked(kept.filter("gate_passed"))


def icp_ads(spark, d):
    return _ads(spark, d).select("ad_id", "page_id", "destination", "cta", "domain", "days_live", "active", "has_video", "has_carousel", "platform_count")


def icp_snapshots(spark, d):
    """Scraped ads whose snapshots are JSON, a Python literal or broken, with columns beside them."""
    k = F.col("o_orderkey")
    json_cell = F.concat(F.lit('{"cta_type": "CALL_NOW", "link_url": "https://www.s'), k % 9, F.lit('.example/apply", "title": "t", "body": {"text": "'), F.when(k % 8 == 0, F.lit("")).otherwise(F.lit("said")), F.lit('", "markup": {"__html": "<b>"}}, "images": ["a"], "cards": ["x", "y"], "page_like_count": '), k % 50, F.lit("}"))
    literal = F.concat(F.lit("{'body': 'plain', 'videos': ['v'], 'link_description': None, 'page_like_count': 0, 'cta_text': 'c"), k % 3, F.lit("'}"))
    raw = read(spark, d, "orders").select(
        k.alias("ad_id"), F.col("o_custkey").alias("page_id"), F.lit("P").alias("page_name"), F.lit("").alias("page_category"), F.lit("LEARN_MORE").alias("cta_type"), F.lit("https://out.example/").alias("link_url"), F.lit("['FACEBOOK', 'INSTAGRAM']").alias("publisher_platform"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("start_date"), F.lit(None).cast("string").alias("end_date"), (k % 2 == 0).alias("is_active"), (k % 7).alias("page_like_count"), F.lit(1).alias("collation_id"), F.when(k % 4 == 0, json_cell).when(k % 4 == 1, literal).when(k % 4 == 2, "{broken").alias("snapshot"))
    out = A.normalize(A.from_snapshots(raw), AS_OF)
    return out.select("ad_id", "destination", "cta", "domain", "days_live", "text", "title", "has_image", "has_video", "has_carousel", "platform_count", "likes")


PAGE_COLUMNS = ["page_id", "page_name", "total_ads", "active_ads", "distinct_collations", "new_ads_30d", "always_on_share", "share_message", "share_call", "share_form", "share_web", "page_like_count", "dominant_cta", "dominant_dest", "distinct_ctas", "platform_count", "ad_texts_combined"]


def icp_pages(spark, d):
    return _pages(spark, d).select(*PAGE_COLUMNS, F.array_join("domains", ",").alias("domains"))


def icp_gate(spark, d):
    return _gated(spark, d).select("page_id", "gate_reason", "gate_passed", "price_count", "has_followup", "has_consult", "has_qualification", "regulated_name")


def icp_gate_frequencies(spark, d):
    return A.frequencies(_gated(spark, d), "gate_reason")


SCORES = ["money_ad_volume", "money_always_on", "money_velocity", "money_scale", "urgency_direct", "urgency_form", "urgency_immediacy", "urgency_qualification", "exp_questions", "exp_qualification", "exp_consult", "exp_followup", "exp_multistep", "exp_complexity", "imp_conv_entry", "imp_generic_cta", "imp_service_breadth", "imp_advisor", "imp_regulated"]


def icp_scores(spark, d):
    return _scored(spark, d, whole=True).select("page_id", *(F.col(c).cast("long").alias(c) for c in SCORES), "total_score")


def icp_clusters(spark, d):
    return _scored(spark, d).select("page_id", "behavioral_cluster", "multi_funnel", "junk_risk")


def icp_ranked(spark, d):
    return _ranked(spark, d).select("page_id", "total_score", F.col("rank").cast("long").alias("rank"))


def icp_leaderboard(spark, d):
    return A.leaderboard(_ranked(spark, d)).withColumn("rank", F.col("rank").cast("long"))


def icp_percentiles(spark, d):
    return A.percentiles(_scored(spark, d), ["total_score", "money_score", "urgency_score", "fit_score"])


def icp_histogram(spark, d):
    return A.histogram(_scored(spark, d), "money_score")


def icp_top_per_cluster(spark, d):
    return A.top_per_group(_ranked(spark, d, whole=True), "behavioral_cluster", [F.col("rank")], 5).select("behavioral_cluster", "page_id", F.col("position").cast("long").alias("position"))


def icp_platform_shares(spark, d):
    return A.platform_shares(_ads(spark, d)).select("page_id", "platform_count", F.explode("platform_shares").alias("platform", "share"))


def _any(text: str, patterns: list[str]) -> str:
    return f"regexp_matches({text}, '" + "|".join(f"(?:{p})" for p in patterns).replace("'", "''") + "', 'i')"


def _count(text: str, patterns: list[str]) -> str:
    return "(" + " + ".join(f"CAST(regexp_matches({text}, '" + p.replace("'", "''") + "', 'i') AS INT)" for p in patterns) + ")"


def _in(values: list[str]) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


_FIRST_TEXTS = "SELECT page_id, array_to_string(list(text ORDER BY ad_id), ' | ') AS ad_texts_combined FROM (SELECT page_id, ad_id, text, row_number() OVER (PARTITION BY page_id ORDER BY ad_id) AS n, row_number() OVER (PARTITION BY page_id, text <> '' ORDER BY ad_id) AS m FROM ads) WHERE n <= 20 AND text <> '' GROUP BY 1"
_ALL_TEXTS = "SELECT page_id, array_to_string(list(text ORDER BY ad_id), ' | ') AS ad_texts_combined FROM ads WHERE text <> '' GROUP BY 1"


def _pages_sql(texts: str, combined: str) -> str:
    return f"""{ADS_SQL},
texts AS ({texts}),
doms AS (SELECT page_id, array_to_string(list_slice(list(domain ORDER BY ad_id), 1, 5), ',') AS domains FROM (SELECT page_id, domain, min(ad_id) AS ad_id FROM ads WHERE domain IS NOT NULL GROUP BY 1, 2) GROUP BY 1),
ctas AS (SELECT page_id, cta AS dominant_cta FROM (SELECT page_id, cta, row_number() OVER (PARTITION BY page_id ORDER BY count(*) DESC, cta) AS r FROM ads GROUP BY 1, 2) WHERE r = 1),
dests AS (SELECT page_id, destination AS dominant_dest FROM (SELECT page_id, destination, row_number() OVER (PARTITION BY page_id ORDER BY count(*) DESC, destination) AS r FROM ads GROUP BY 1, 2) WHERE r = 1),
plats AS (SELECT page_id, count(DISTINCT p) AS platform_count FROM (SELECT page_id, unnest(platforms) AS p FROM ads) GROUP BY 1),
pages AS (SELECT page_id, arg_min(page_name, ad_id) AS page_name, arg_min(page_category, ad_id) AS page_category, count(*) AS total_ads, count(*) FILTER (active) AS active_ads, count(DISTINCT collation_id) AS distinct_collations,
  count(*) FILTER (start >= TIMESTAMP '{AS_OF}' - INTERVAL 30 DAY) AS new_ads_30d, round(count(*) FILTER (days_live >= 21) / count(*), 4) AS always_on_share,
  round(count(*) FILTER (destination = 'MESSAGE') / count(*), 4) AS share_message, round(count(*) FILTER (destination = 'CALL') / count(*), 4) AS share_call, round(count(*) FILTER (destination = 'FORM') / count(*), 4) AS share_form, round(count(*) FILTER (destination = 'WEB') / count(*), 4) AS share_web,
  max(likes) AS page_like_count, count(DISTINCT cta) AS distinct_ctas, array_to_string(list_sort(list(DISTINCT link_url) FILTER (link_url IS NOT NULL)), ' | ') AS link_urls FROM ads GROUP BY 1),
agg AS (SELECT pages.*, coalesce({combined}, '') AS ad_texts_combined, coalesce(domains, '') AS domains, dominant_cta, dominant_dest, platform_count FROM pages LEFT JOIN texts USING (page_id) LEFT JOIN doms USING (page_id) LEFT JOIN ctas USING (page_id) LEFT JOIN dests USING (page_id) LEFT JOIN plats USING (page_id)),
sig AS (SELECT *, strip_accents(lower(ad_texts_combined)) AS t, lower(ad_texts_combined) AS low FROM agg),
sig2 AS (SELECT *, {_any("t", P.FOLLOW_UP)} AS has_followup, {_any("t", P.CONSULT)} AS has_consult, {_any("t", P.QUALIFICATION)} AS has_qualification, {_count("t", P.PRICES)} AS price_count, dominant_cta IN {_in(P.SHOP_CTAS)} AS shop_cta, dominant_cta IN {_in(P.LEAD_CTAS)} AS lead_cta,
  regexp_matches(link_urls, 'myshopify\\.com|/products/') AS shop_url, {_any("strip_accents(lower(page_name))", P.REGULATED_NAMES)} AS regulated_name FROM sig),
gated AS (SELECT *, CASE WHEN (shop_cta AND NOT has_consult AND (shop_url OR price_count >= 3)) OR (price_count >= 3 AND share_message = 0 AND share_call = 0 AND NOT has_consult) THEN 'TRANSACTIONAL_DROP'
  WHEN dominant_dest = 'MESSAGE' OR share_message >= 0.1 THEN 'MESSAGE' WHEN dominant_dest = 'CALL' OR share_call >= 0.1 THEN 'CALL' WHEN (share_form >= 0.2 AND has_followup) OR share_form >= 0.4 THEN 'FORM'
  WHEN dominant_dest = 'WEB' AND lead_cta AND has_consult AND NOT shop_url AND (has_followup OR has_qualification) THEN 'WEB_CONSULT' WHEN regulated_name AND NOT shop_cta AND price_count < 3 THEN 'RESCUED' ELSE 'NO_SIGNAL_DROP' END AS gate_reason FROM sig2),
parts AS (SELECT *, CASE WHEN active_ads > 0 THEN least(15, CAST(trunc(log2(least(active_ads, 100) + 1) * 2.25) AS INT)) ELSE 0 END AS money_ad_volume, least(15, CAST(trunc(always_on_share * 15) AS INT)) AS money_always_on,
  CASE WHEN new_ads_30d > 0 THEN least(10, CAST(trunc(log2(new_ads_30d + 1) * 2) AS INT)) ELSE 0 END AS money_velocity, CASE WHEN page_like_count > 0 THEN least(10, CAST(trunc(log10(page_like_count + 1) * 2) AS INT)) ELSE 0 END AS money_scale,
  least(25, CAST(trunc((share_message * 1.5 + share_call) * 25) AS INT)) AS urgency_direct, least(10, CAST(trunc(share_form * 10) AS INT)) AS urgency_form, least(10, 2 * {_count("low", P.IMMEDIACY)}) AS urgency_immediacy, least(5, 2 * {_count("low", P.URGENT_QUALIFICATION)}) AS urgency_qualification,
  CASE WHEN len(regexp_replace(low, '[^?]', '', 'g')) >= 3 THEN 2 WHEN contains(low, '?') THEN 1 ELSE 0 END AS exp_questions, least(10, 2 * {_count("t", P.FIT_QUALIFICATION)}) AS exp_qualification, least(6, 2 * {_count("t", P.BOOKING)}) AS exp_consult,
  least(4, 2 * {_count("t", P.FIT_FOLLOW_UP)}) AS exp_followup, least(4, 2 * {_count("t", P.MULTI_STEP)}) AS exp_multistep, CASE WHEN distinct_ctas > 2 THEN 2 ELSE 0 END + CASE WHEN share_message + share_call > 0 AND share_form > 0 THEN 2 ELSE 0 END AS exp_complexity,
  CASE WHEN dominant_dest IN ('MESSAGE', 'CALL') AND price_count = 0 THEN 6 ELSE 0 END AS imp_conv_entry, CASE WHEN dominant_cta IN {_in(P.GENERIC_CTAS)} AND NOT has_qualification THEN 4 ELSE 0 END AS imp_generic_cta,
  least(4, 2 * {_count("t", P.SERVICE_BREADTH)}) AS imp_service_breadth, CASE WHEN {_any("t", P.ADVISOR)} THEN 4 ELSE 0 END AS imp_advisor, CASE WHEN lower(page_category) IN {_in(P.REGULATED_CATEGORIES)} OR {_any("t", P.REGULATED_DOMAIN)} THEN 2 ELSE 0 END AS imp_regulated FROM gated),
sums AS (SELECT *, least(50, money_ad_volume + money_always_on + money_velocity + money_scale) AS money_score, least(50, urgency_direct + urgency_form + urgency_immediacy + urgency_qualification) AS urgency_score,
  least(50, least(30, exp_questions + exp_qualification + exp_consult + exp_followup + exp_multistep + exp_complexity) + least(20, imp_conv_entry + imp_generic_cta + imp_service_breadth + imp_advisor + imp_regulated)) AS fit_score FROM parts),
scored AS (SELECT *, round((CAST(0.45 AS DOUBLE) * money_score + CAST(0.35 AS DOUBLE) * urgency_score + CAST(0.2 AS DOUBLE) * fit_score) / 50 * 100, 1) AS total_score, gate_reason NOT IN ('TRANSACTIONAL_DROP', 'NO_SIGNAL_DROP') AS gate_passed,
  CASE WHEN dominant_dest = 'MESSAGE' OR share_message >= 0.2 THEN 'message_first' WHEN dominant_dest = 'CALL' OR share_call >= 0.2 THEN 'call_first' WHEN share_form >= 0.2 AND (has_followup OR share_form >= 0.3) THEN 'form_first'
  WHEN dominant_dest = 'WEB' AND lead_cta AND has_consult AND NOT shop_url AND (has_followup OR has_qualification) THEN 'web_consult' ELSE 'uncategorized' END AS behavioral_cluster,
  len(list_distinct(list_transform(list_filter(list_transform(regexp_split_to_array(ad_texts_combined, '\\s*\\|\\s*|\\n+'), lambda x: trim(x)), lambda x: length(x) > 20), lambda x: substr(x, 1, 200)))) >= 5 OR CAST(share_message > 0.05 AS INT) + CAST(share_call > 0.05 AS INT) + CAST(share_form > 0.05 AS INT) >= 2 AS multi_funnel,
  (shop_cta AND contains(domains, 'myshopify.com')) OR {_count("t", P.CONTENT)} >= 3 AS junk_risk FROM sums),
ranked AS (SELECT *, row_number() OVER (ORDER BY total_score DESC, page_id) AS rank FROM scored WHERE gate_passed)"""


def _sql(select: str) -> str:
    return f"WITH {_pages_sql(_FIRST_TEXTS, 'substr(ad_texts_combined, 1, 5000)')}\n{select}"


def _whole_sql(select: str) -> str:
    """With whole texts of all ads of a page."""
    return f"WITH {_pages_sql(_ALL_TEXTS, 'ad_texts_combined')}\n{select}"


_MARKS = ", ".join(f"round(quantile_cont(v, {q}), 1) AS {n}" for n, q in (("min", 0), ("p25", 0.25), ("p50", 0.5), ("p75", 0.75), ("p90", 0.9), ("max", 1)))

QUERIES = {f.__name__: f for f in (icp_ads, icp_snapshots, icp_pages, icp_gate, icp_gate_frequencies, icp_scores, icp_clusters, icp_ranked, icp_leaderboard, icp_percentiles, icp_histogram, icp_top_per_cluster, icp_platform_shares)}
SQL = {
    "icp_snapshots": f"""SELECT o_orderkey AS ad_id, CASE WHEN m = 0 THEN 'CALL' ELSE 'WEB' END AS destination, CASE WHEN m = 0 THEN 'CALL_NOW' ELSE 'LEARN_MORE' END AS cta, CASE WHEN m = 0 THEN 's' || (o_orderkey % 9) || '.example' ELSE 'out.example' END AS domain,
  CAST(floor((epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP))) / 86400000000) AS BIGINT) AS days_live, CASE m WHEN 0 THEN CASE WHEN o_orderkey % 8 = 0 THEN '<b>' ELSE 'said' END WHEN 1 THEN 'plain' ELSE '' END AS text, CASE WHEN m = 0 THEN 't' ELSE '' END AS title,
  m = 0 AS has_image, m = 1 AS has_video, m = 0 AS has_carousel, 2 AS platform_count, CASE WHEN m = 0 AND o_orderkey % 50 > 0 THEN o_orderkey % 50 ELSE o_orderkey % 7 END AS likes FROM (SELECT *, o_orderkey % 4 AS m FROM orders)""",
    "icp_ads": f"WITH {ADS_SQL} SELECT ad_id, page_id, destination, cta, domain, days_live, active, has_video, has_carousel, len(platforms) AS platform_count FROM ads",
    "icp_pages": _sql("SELECT " + ", ".join(PAGE_COLUMNS) + ", domains FROM agg"),
    "icp_gate": _whole_sql("SELECT page_id, gate_reason, gate_reason NOT IN ('TRANSACTIONAL_DROP', 'NO_SIGNAL_DROP') AS gate_passed, price_count, has_followup, has_consult, has_qualification, regulated_name FROM gated"),
    "icp_gate_frequencies": _whole_sql("SELECT gate_reason, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 1) AS pct FROM gated GROUP BY 1"),
    "icp_scores": _whole_sql("SELECT page_id, " + ", ".join(SCORES) + ", total_score FROM scored"),
    "icp_clusters": _sql("SELECT page_id, behavioral_cluster, multi_funnel, junk_risk FROM scored"),
    "icp_ranked": _sql("SELECT page_id, total_score, rank FROM ranked"),
    "icp_leaderboard": _sql("""SELECT *, row_number() OVER (ORDER BY median_total_score DESC, icp_cluster) AS rank FROM (SELECT behavioral_cluster AS icp_cluster, count(*) AS total_advertisers, round(median(total_score), 1) AS median_total_score, round(median(money_score), 1) AS median_money,
  round(median(urgency_score), 1) AS median_urgency, round(median(fit_score), 1) AS median_fit, round(avg(share_message), 3) AS avg_message_share, round(avg(share_call), 3) AS avg_call_share, round(avg(share_form), 3) AS avg_form_share, round(avg(share_web), 3) AS avg_web_share,
  array_to_string(list_slice(list(substr(page_name, 1, 30) ORDER BY rank), 1, 5), ', ') AS top_advertisers FROM ranked GROUP BY 1)"""),
    "icp_percentiles": _sql("SELECT metric, " + _MARKS + " FROM (SELECT 'total_score' AS metric, CAST(total_score AS DOUBLE) AS v FROM scored UNION ALL SELECT 'money_score', money_score FROM scored UNION ALL SELECT 'urgency_score', urgency_score FROM scored UNION ALL SELECT 'fit_score', fit_score FROM scored) GROUP BY 1"),
    "icp_histogram": _sql("SELECT CASE b WHEN 1 THEN '[' ELSE '(' END || ((b - 1) * 10) || '-' || CASE b WHEN 5 THEN '' ELSE CAST(b * 10 AS VARCHAR) END || ']' AS bin, count(*) AS n FROM (SELECT CAST(least(greatest(ceil(money_score / 10), 1), 5) AS INT) AS b FROM scored) GROUP BY 1"),
    "icp_top_per_cluster": _whole_sql("SELECT * FROM (SELECT behavioral_cluster, page_id, row_number() OVER (PARTITION BY behavioral_cluster ORDER BY rank) AS position FROM ranked) WHERE position <= 5"),
    "icp_platform_shares": f"WITH {ADS_SQL}, m AS (SELECT page_id, unnest(platforms) AS platform FROM ads) SELECT page_id, count(*) OVER (PARTITION BY page_id) AS platform_count, platform, round(count(*) / sum(count(*)) OVER (PARTITION BY page_id), 4) AS share FROM m GROUP BY page_id, platform",
}
