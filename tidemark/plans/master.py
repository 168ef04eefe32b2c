"""Master-table, lead-score and agent queries."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import joins as J
from ..operators import master as M
from .proxies import LEADS_SQL, SALES_SQL, leads, read, sales

COLUMNS = ["ord", "page_name", "primary_email", "website_url", "phones"]


def master_deduplicate(spark, d):
    return M.deduplicate(leads(spark, d).select(*COLUMNS), "ord")


def master_merge(spark, d):
    s = F.col("s_suppkey")
    other = read(spark, d, "supplier").select((s + 10_000_000).alias("ord"), F.concat(F.lit("Lead "), s % 900).alias("page_name"), F.concat(F.lit("e"), s % 500, F.lit("@x.example")).alias("primary_email"), F.lit(None).cast("string").alias("website_url"), F.lit("s").alias("origin"))
    return M.merge(leads(spark, d).select(*COLUMNS), other, "ord")


def master_update(spark, d):
    k = F.col("ord")
    new = leads(spark, d).filter(k % 2 == 0).select("page_name", F.when(k % 4 == 0, " ").otherwise(F.concat(F.lit("new"), k)).alias("phones"), F.concat(F.lit("c"), k).alias("city"), k)
    first = leads(spark, d).filter(k < 700).select("page_name", "phones", "primary_email")
    return J.update(first, new, "page_name", "ord")


def master_fill(spark, d):
    other = leads(spark, d).filter(F.col("ord") >= 700).select("page_name", "primary_email", "phones", "ord")
    return J.fill(leads(spark, d).filter(F.col("ord") < 700).select("page_name", "primary_email", "phones"), other, "page_name", ["primary_email", "phones"], "ord")


def master_suppress(spark, d):
    return J.suppress(leads(spark, d).select("ord", "primary_email"), "primary_email", spark.createDataFrame([("E1@x.example",), ("e7@X.example",), (None,)], "email string"))


def master_within(spark, d):
    return J.within(sales(spark, d), M.agents(sales(spark, d)).filter("sales >= 600"), "agent_id").groupBy("agent_id").agg(F.count(F.lit(1)).alias("n"))


def master_waterfall(spark, d):
    ids = leads(spark, d).select(F.col("primary_email"), F.concat(F.lit("sub"), F.min("ord").over(Window.partitionBy("primary_email"))).alias("subscriber")).filter("primary_email is not null").distinct()
    names = leads(spark, d).groupBy("page_name").agg(F.concat(F.lit("name"), F.min("ord")).alias("subscriber"))
    return J.waterfall(leads(spark, d).select("ord", "primary_email", "page_name"), [("email", ids, "primary_email"), ("name", names, "page_name")], "subscriber").select("ord", "subscriber", "lookup_method")


def master_best_match(spark, d):
    cand = read(spark, d, "supplier").select((F.col("s_suppkey") % 50).alias("k"), F.col("s_suppkey").alias("pos"), F.col("s_acctbal").alias("bal"))
    base = read(spark, d, "nation").select(F.col("n_nationkey").cast("long").alias("k"))
    return J.best_match(base, cand, "k", F.col("bal") / 100, 1.0).select("k", "pos", F.round("match_score", 4).alias("match_score"))


def master_lead_score(spark, d):
    return M.lead_score(leads(spark, d)).select("ord", F.col("lead_score").cast("long").alias("lead_score"), "lead_tier", "score_breakdown")


def master_tier_summary(spark, d):
    return M.tier_summary(M.lead_score(leads(spark, d)))


def master_agents(spark, d):
    a = M.agents(sales(spark, d))
    return a.select(*(F.round(c, 2).alias(c) if t == "double" else F.col(c) for c, t in a.dtypes))


def master_top_agents(spark, d):
    return M.agents(sales(spark, d)).filter("sales >= 620").select("agent_id", "sales", F.round("volume", 2).alias("volume")).orderBy(F.desc("volume"), "agent_id")


def master_keep_first(spark, d):
    return M.keep_first(sales(spark, d), ["mls_number"], "ord").select("mls_number", "ord")


def _candidates(spark, d):
    s = F.col("s_suppkey")
    return read(spark, d, "supplier").select(
        s.alias("agent_id"), (s % 4).alias("mutual_count"), F.when(s % 3 == 0, "li").otherwise("nan").alias("linkedin_profile"), F.when(s % 2 == 0, "a@x.example").alias("email"), F.when(s % 5 == 0, "@a").alias("instagram_handle"),
        (s % 7 == 0).alias("has_meta_ads"), F.when(s % 6 == 0, "True").alias("has_marketing_pixel"), (s * 1_000_000).cast("double").alias("sold_volume"), (s % 8 == 0).alias("has_idx"))


def master_entry_path(spark, d):
    return M.entry_path(_candidates(spark, d)).select("agent_id", "entry_score", "path_type", "path_details")


def master_coverage(spark, d):
    return M.coverage(leads(spark, d), ["primary_email", "website_url", "phones", "instagram_handles", "gmaps_rating"])


def master_field_changes(spark, d):
    k = F.col("ord")
    before = leads(spark, d).select("ord", F.when(k % 2 == 0, F.col("phones")).alias("phones"), "primary_email")
    return M.field_changes(before, leads(spark, d), "ord", ["phones", "primary_email"])


def master_merge_duplicates(spark, d):
    df = leads(spark, d).select("page_name", F.col("ad_count").cast("long").alias("ad_count"), F.array("contact_position").alias("roles"), "has_crm", "primary_email", "ord").withColumn("roles", F.array_compact("roles"))
    return M.merge_duplicates(df, "page_name", ["ad_count"], ["roles"], ["has_crm"], ["primary_email"], "ord").withColumn("roles", F.array_join("roles", ","))


_L = f"WITH {LEADS_SQL}"
_NORM = "regexp_replace(regexp_replace(regexp_replace(lower(website_url), '^https?://', ''), '^www\\.', ''), '/+$', '')"


def _dedup(source: str, columns: str, rich: str) -> str:
    return f"""r0 AS (SELECT *, {rich} AS rich FROM {source}), r1 AS (SELECT * FROM r0 QUALIFY row_number() OVER (PARTITION BY page_name ORDER BY rich DESC, ord) = 1),
r2 AS (SELECT * FROM r1 QUALIFY row_number() OVER (PARTITION BY CASE WHEN coalesce(primary_email, '') <> '' THEN 'k' || primary_email ELSE 'o' || ord END ORDER BY rich DESC, ord) = 1),
r3 AS (SELECT * FROM r2 QUALIFY row_number() OVER (PARTITION BY CASE WHEN coalesce(website_url, '') <> '' THEN 'k' || {_NORM} ELSE 'o' || ord END ORDER BY rich DESC, ord) = 1) SELECT {columns} FROM r3"""


def _rich(columns: list[str]) -> str:
    return " + ".join(f"CAST({c} IS NOT NULL AS INT)" for c in columns)


_SIGNS = [
    ("active_fb_ads", 3, "ad_count > 0"), ("multiple_creatives", 2, "ad_count >= 3"), ("reviews_30+", 2, "gmaps_review_count >= 30"), ("reviews_100+", 1, "gmaps_review_count >= 100"), ("has_crm", 2, "has_crm"), ("has_pixel", 1, "has_marketing_pixel"),
    ("has_scheduling", 1, "has_scheduling_tool"), ("has_chat", 1, "has_chat_widget"), ("decision_maker", 2, "contact_position IN ('Owner', 'Managing Broker')"), ("email+phone", 2, "primary_email IS NOT NULL AND phones IS NOT NULL"), ("email_only", 1, "primary_email IS NOT NULL AND phones IS NULL"), ("has_instagram", 1, "instagram_handles <> '[]'"), ("good_rating", 1, "gmaps_rating >= 4.0"),
]
_SCORED = f"{_L}, scored AS (SELECT *, CASE WHEN lead_score >= 12 THEN 'HOT' WHEN lead_score >= 8 THEN 'WARM' WHEN lead_score >= 5 THEN 'COOL' ELSE 'COLD' END AS lead_tier FROM (SELECT ord, " + " + ".join(f"CASE WHEN {c} THEN {p} ELSE 0 END" for _, p, c in _SIGNS) + " AS lead_score, coalesce(nullif(concat_ws('|', " + ", ".join(f"CASE WHEN {c} THEN '{n}:+{p}' END" for n, p, c in _SIGNS) + "), ''), 'no_signals') AS score_breakdown FROM leads))"
_AGENTS = f"WITH {SALES_SQL}, agents AS (SELECT agent_id, arg_min(name, ord) FILTER (name IS NOT NULL) AS name, arg_min(email, ord) FILTER (email IS NOT NULL) AS email, count(*) AS sales, round(sum(price), 2) AS volume, round(avg(price), 2) AS avg_price, round(median(price), 2) AS median_price, round(max(price), 2) AS max_price, round(min(price), 2) AS min_price, count(DISTINCT city) AS cities FROM sales GROUP BY 1)"
_HAS = {"primary_email": "primary_email IS NOT NULL", "website_url": "website_url IS NOT NULL", "phones": "phones IS NOT NULL", "instagram_handles": "instagram_handles <> '[]'", "gmaps_rating": "ord % 8 <> 0"}
_COVER = " UNION ALL ".join(f"SELECT '{c}' AS field, count(*) FILTER ({h}) AS filled, round(count(*) FILTER ({h}) * 100.0 / count(*), 1) AS pct FROM leads" for c, h in _HAS.items())

QUERIES = {f.__name__: f for f in (master_deduplicate, master_merge, master_update, master_fill, master_suppress, master_within, master_waterfall, master_best_match, master_lead_score, master_tier_summary, master_agents, master_top_agents, master_keep_first, master_entry_path, master_coverage, master_field_changes, master_merge_duplicates)}
SQL = {
    "master_deduplicate": f"{_L}, " + _dedup("leads", ", ".join(COLUMNS), _rich(COLUMNS)),
    "master_merge": f"{_L}, both_ AS (SELECT {', '.join(COLUMNS)}, NULL AS origin FROM leads UNION ALL SELECT s_suppkey + 10000000, 'Lead ' || (s_suppkey % 900), 'e' || (s_suppkey % 500) || '@x.example', NULL, NULL, 's' FROM supplier), " + _dedup("both_", ", ".join([*COLUMNS, "origin"]), _rich([*COLUMNS, "origin"])),
    "master_update": f"{_L}, n AS (SELECT page_name, nullif(CASE WHEN ord % 4 = 0 THEN '' ELSE 'new' || ord END, '') AS p, 'c' || ord AS city FROM leads WHERE ord % 2 = 0 QUALIFY row_number() OVER (PARTITION BY page_name ORDER BY ord DESC) = 1) SELECT l.page_name, coalesce(p, phones) AS phones, primary_email, city FROM leads l LEFT JOIN n USING (page_name) WHERE l.ord < 700",
    "master_fill": f"{_L}, n AS (SELECT page_name, primary_email AS e, phones AS p FROM leads WHERE ord >= 700 QUALIFY row_number() OVER (PARTITION BY page_name ORDER BY ord DESC) = 1) SELECT page_name, coalesce(primary_email, e) AS primary_email, coalesce(phones, p) AS phones FROM leads LEFT JOIN n USING (page_name) WHERE ord < 700",
    "master_suppress": f"{_L} SELECT ord, primary_email FROM leads WHERE primary_email IS NULL OR primary_email NOT IN ('e1@x.example', 'e7@x.example')",
    "master_within": f"WITH {SALES_SQL} SELECT agent_id, count(*) AS n FROM sales GROUP BY 1 HAVING count(*) >= 600",
    "master_waterfall": f"{_L} SELECT ord, coalesce(CASE WHEN primary_email IS NOT NULL THEN 'sub' || min(ord) OVER (PARTITION BY primary_email) END, 'name' || min(ord) OVER (PARTITION BY page_name)) AS subscriber, CASE WHEN primary_email IS NOT NULL THEN 'email' ELSE 'name' END AS lookup_method FROM leads",
    "master_best_match": "SELECT n_nationkey AS k, pos, round(match_score, 4) AS match_score FROM nation LEFT JOIN (SELECT s_suppkey % 50 AS k, s_suppkey AS pos, s_acctbal / 100 AS match_score FROM supplier WHERE s_acctbal / 100 >= 1 QUALIFY row_number() OVER (PARTITION BY s_suppkey % 50 ORDER BY s_acctbal DESC, s_suppkey) = 1) c ON c.k = n_nationkey",
    "master_lead_score": f"{_SCORED} SELECT ord, lead_score, lead_tier, score_breakdown FROM scored",
    "master_tier_summary": f"{_SCORED} SELECT lead_tier, count(*) AS n, round(avg(lead_score), 2) AS avg_score, min(lead_score) AS min_score, max(lead_score) AS max_score FROM scored GROUP BY 1",
    "master_agents": f"{_AGENTS} SELECT * FROM agents",
    "master_top_agents": f"{_AGENTS} SELECT agent_id, sales, volume FROM agents WHERE sales >= 620",
    "master_keep_first": f"WITH {SALES_SQL} SELECT mls_number, min(ord) AS ord FROM sales GROUP BY 1",
    "master_entry_path": """WITH c AS (SELECT s_suppkey AS s, s_suppkey % 4 AS m, s_suppkey % 3 = 0 AS li, s_suppkey % 2 = 0 AS em, s_suppkey % 5 = 0 AS ig, s_suppkey % 7 = 0 AS ads, s_suppkey % 6 = 0 AS px, s_suppkey > 50 AS big, s_suppkey % 8 = 0 AS idx FROM supplier)
  SELECT s AS agent_id, CASE WHEN m > 0 THEN 40 + 5 * least(m, 5) ELSE 0 END + 15 * CAST(li AS INT) + 10 * CAST(em AS INT) + 10 * CAST(ads AS INT) + 5 * CAST(px AS INT) + 8 * CAST(ig AS INT) + 5 * CAST(big AS INT) + 2 * CAST(idx AS INT) AS entry_score,
  CASE WHEN m > 0 THEN 'warm_intro' WHEN li THEN 'linkedin' WHEN ig THEN 'instagram' WHEN em THEN 'email' WHEN ads THEN 'facebook' ELSE 'research' END AS path_type,
  coalesce(nullif(concat_ws(', ', CASE WHEN m > 0 THEN m || ' mutual(s)' END, CASE WHEN li THEN 'LinkedIn' END, CASE WHEN em THEN 'email' END, CASE WHEN ads THEN 'Meta ads' END, CASE WHEN px THEN 'tracking pixel' END, CASE WHEN ig THEN 'Instagram' END, CASE WHEN big THEN 'high volume' END), ''), 'limited data') AS path_details FROM c""",
    "master_coverage": f"{_L} SELECT *, CASE WHEN pct < 30 THEN 'LOW' ELSE 'OK' END AS status FROM ({_COVER})",
    "master_field_changes": f"{_L} SELECT 'phones' AS field, count(phones) AS found, count(phones) FILTER (ord % 2 = 0) AS preserved, count(phones) FILTER (ord % 2 = 1) AS added FROM leads UNION ALL SELECT 'primary_email', count(primary_email), count(primary_email), 0 FROM leads",
    "master_merge_duplicates": f"{_L} SELECT page_name, sum(ad_count) AS ad_count, coalesce(array_to_string(list_sort(list(DISTINCT contact_position) FILTER (contact_position IS NOT NULL)), ','), '') AS roles, bool_or(has_crm) AS has_crm, arg_min(primary_email, ord) FILTER (primary_email IS NOT NULL) AS primary_email FROM leads GROUP BY 1",
}
