"""The test tables as ads, deals, mails, sales and leads; each with the SQL that makes the same rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = "1998-09-01 00:00:00"
CTAS = ["SEND_MESSAGE", "CALL_NOW", "APPLY_NOW", "SHOP_NOW", "LEARN_MORE", "CONTACT_US", "NO_BUTTON"]
URLS = ["https://www.acme.example/contact-us", "http://m.me/acme", "tel:+15550100", "https://shop.myshopify.com/products/1", "https://acme.example/about", None]
TEXTS = [
    "Book a free consultation today with our team", "Do you qualify? Apply now and we will contact you", "Agenda tu cita hoy, te contactamos", "50% off, free shipping, buy now with promo code",
    "We help with insurance and tax. Speak with an advisor", "Answer a few questions to get started", "New episode: watch the series, a viral drama story", "Evaluación gratis: llámanos ahora",
    "Shop now $20 limited stock, sale ends soon", "Wide range of roofing services, tailored to your needs", "",
]
NAMES = ["Acme Realty", "Blue Lake Shop", "Casa Novela", "Delta Roofing", "Echo Media"]
REASONS = ["no_asistio_al_demo", "precio_alto", "eligio_competidor", "higiene_de_lead", "mal_timing", None]
DETAILS = ["usa Zoho y Excel", "lead duplicado, ya tiene cuenta", "retomar en enero", "sin presupuesto, tipo de cambio", None]
SOURCES = ["ORGANIC_SEARCH", "PAID_SOCIAL", "REFERRALS", None]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _pick(values: list, at: Column) -> Column:
    return F.get(F.array(*(F.lit(v).cast("string") for v in values)), at.cast("int"))


def _sql_pick(values: list, at: str) -> str:
    return "([" + ", ".join("NULL" if v is None else "'" + v.replace("'", "''") + "'" for v in values) + f"])[1 + {at}]"


def ads(spark, sf_dir) -> DataFrame:
    k, p = F.col("o_orderkey"), F.col("o_custkey")
    return read(spark, sf_dir, "orders").select(
        k.alias("ad_id"), p.alias("page_id"), F.concat(_pick(NAMES, p % 5), F.lit(" "), p).alias("page_name"), F.when(p % 4 == 0, "Real Estate").alias("page_category"),
        _pick(CTAS, (p + k % 2) % 7).alias("cta"), _pick(URLS, (p + k % 3) % 6).alias("link_url"), F.when(k % 5 == 0, F.array(F.lit("MESSENGER"))).when(k % 2 == 0, F.array(F.lit("FACEBOOK"), F.lit("INSTAGRAM"))).otherwise(F.array(F.lit("FACEBOOK"))).alias("platforms"),
        F.col("o_orderdate").alias("start"), F.when(k % 3 == 0, F.col("o_orderdate") + F.expr("INTERVAL 20 DAYS")).alias("end"), (F.col("o_orderstatus") != "F").alias("active"),
        _pick(TEXTS, (p * 3 + k % 4) % 11).alias("text"), F.lit("").alias("title"), F.lit(None).cast("string").alias("description"),
        (k % 2).alias("images"), (k % 3 % 2).alias("videos"), (k % 4).alias("cards"), (p * 37 % 20000).alias("likes"), (k % 6).alias("collation_id"),
    )


ADS_SQL = f"""raw AS (SELECT o_orderkey AS ad_id, o_custkey AS page_id, {_sql_pick(NAMES, "o_custkey % 5")} || ' ' || o_custkey AS page_name, CASE WHEN o_custkey % 4 = 0 THEN 'Real Estate' ELSE '' END AS page_category,
  {_sql_pick(CTAS, "(o_custkey + o_orderkey % 2) % 7")} AS cta, {_sql_pick(URLS, "(o_custkey + o_orderkey % 3) % 6")} AS link_url,
  CASE WHEN o_orderkey % 5 = 0 THEN ['MESSENGER'] WHEN o_orderkey % 2 = 0 THEN ['FACEBOOK', 'INSTAGRAM'] ELSE ['FACEBOOK'] END AS platforms,
  o_orderdate AS start, CASE WHEN o_orderkey % 3 = 0 THEN o_orderdate + INTERVAL 20 DAY END AS stop, o_orderstatus <> 'F' AS active,
  {_sql_pick(TEXTS, "(o_custkey * 3 + o_orderkey % 4) % 11")} AS text, o_orderkey % 3 % 2 > 0 AS has_video, o_orderkey % 4 > 1 AS has_carousel, o_custkey * 37 % 20000 AS likes, o_orderkey % 6 AS collation_id FROM orders),
ads AS (SELECT *, CASE WHEN cta IN ('MESSAGE_PAGE', 'SEND_MESSAGE', 'WHATSAPP_MESSAGE', 'CONTACT_US') OR regexp_matches(coalesce(link_url, ''), 'm\\.me/|messenger\\.com|wa\\.me/') OR platforms = ['MESSENGER'] THEN 'MESSAGE'
  WHEN cta IN ('CALL_NOW', 'CALL') OR starts_with(coalesce(link_url, ''), 'tel:') THEN 'CALL'
  WHEN cta IN ('APPLY_NOW', 'SIGN_UP', 'GET_QUOTE', 'BOOK_NOW') OR regexp_matches(coalesce(link_url, ''), '/contact[-_]?us|/apply|/book|/schedule') THEN 'FORM' ELSE 'WEB' END AS destination,
  nullif(regexp_extract(lower(coalesce(link_url, '')), '^(?:[a-z][a-z0-9+.-]*://)?(?:www\\.)?([^/?#]*)', 1), '') AS domain,
  CAST(floor((epoch_us(coalesce(stop, TIMESTAMP '{AS_OF}')) - epoch_us(start)) / 86400000000) AS BIGINT) AS days_live FROM raw)"""


def deals(spark, sf_dir) -> DataFrame:
    k = F.col("o_orderkey")
    return read(spark, sf_dir, "orders").select(
        k.alias("id"), F.concat(F.lit("deal "), k).alias("name"), F.when(k % 17 == 0, 0.0).otherwise(F.col("o_totalprice") / 100).alias("amount"), F.col("o_orderdate").alias("created"),
        F.when(F.col("o_orderstatus") != "O", F.timestamp_seconds(F.unix_timestamp("o_orderdate") + (k % 90) * 86400)).alias("closed"), F.concat(F.lit("owner"), F.col("o_custkey") % 12).alias("owner"),
        F.when(F.col("o_orderstatus") == "F", "lost").when(F.col("o_orderstatus") == "P", "won").otherwise("open").alias("status"), _pick(REASONS, k % 6).alias("reason"),
        _pick(DETAILS, k % 5).alias("details"), F.when(k % 3 == 0, "Inmobiliaria").when(k % 3 == 1, "realtor").alias("profile"), _pick(SOURCES, k % 4).alias("source"), (k % 3 == 0).alias("demo"),
    )


DEALS_SQL = f"""deals AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 17 = 0 THEN 0.0 ELSE o_totalprice / 100 END AS amount, o_orderdate AS created,
  CASE WHEN o_orderstatus <> 'O' THEN o_orderdate + (o_orderkey % 90) * INTERVAL 1 DAY END AS closed, 'owner' || (o_custkey % 12) AS owner,
  CASE o_orderstatus WHEN 'F' THEN 'lost' WHEN 'P' THEN 'won' ELSE 'open' END AS status, {_sql_pick(REASONS, "o_orderkey % 6")} AS reason, {_sql_pick(DETAILS, "o_orderkey % 5")} AS details,
  CASE o_orderkey % 3 WHEN 0 THEN 'Inmobiliaria' WHEN 1 THEN 'realtor' END AS profile, {_sql_pick(SOURCES, "o_orderkey % 4")} AS source, o_orderkey % 3 = 0 AS demo FROM orders)"""


def _person(k: Column) -> Column:
    return F.concat(F.lit("p"), k, F.lit("@d"), k % 9, F.lit(".example"))


def mails(spark, sf_dir) -> DataFrame:
    lines = read(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.array_sort(F.collect_set(F.when(F.col("l_linenumber") <= 2, _person(F.col("l_suppkey") % 60)))).alias("to"), F.array_sort(F.collect_set(F.when(F.col("l_linenumber") > 2, _person(F.col("l_suppkey") % 60)))).alias("cc"))
    k = F.col("o_orderkey")
    o = read(spark, sf_dir, "orders").select(k, F.concat(F.lit("m"), k).alias("message_id"), _person(F.col("o_custkey") % 40).alias("sender"), F.col("o_orderdate").alias("sent"), F.concat(F.lit("subject "), k % 5).alias("subject"), F.when(k % 2 == 0, F.concat(F.lit("m"), k - 1)).alias("in_reply_to"))
    return o.join(lines, o.o_orderkey == lines.l_orderkey).select("message_id", "sender", "to", "cc", "sent", "subject", "in_reply_to")


MAILS_SQL = """lines AS (SELECT l_orderkey, list_sort(list(DISTINCT 'p' || (l_suppkey % 60) || '@d' || (l_suppkey % 60 % 9) || '.example') FILTER (l_linenumber <= 2)) AS "to",
  list_sort(list(DISTINCT 'p' || (l_suppkey % 60) || '@d' || (l_suppkey % 60 % 9) || '.example') FILTER (l_linenumber > 2)) AS cc FROM lineitem GROUP BY 1),
mails AS (SELECT 'm' || o_orderkey AS message_id, 'p' || (o_custkey % 40) || '@d' || (o_custkey % 40 % 9) || '.example' AS sender, coalesce("to", []) AS "to", coalesce(cc, []) AS cc, o_orderdate AS sent,
  'subject ' || (o_orderkey % 5) AS subject, CASE WHEN o_orderkey % 2 = 0 THEN 'm' || (o_orderkey - 1) END AS in_reply_to FROM orders JOIN lines ON o_orderkey = l_orderkey)"""


def sales(spark, sf_dir) -> DataFrame:
    n, s = F.col("l_linenumber"), F.col("l_suppkey")
    return read(spark, sf_dir, "lineitem").select(
        s.alias("agent_id"), F.when(n > 1, F.concat(F.lit("agent"), s % 50)).alias("name"), F.when(n > 2, F.concat(F.lit("a"), s, F.lit("@x.example"))).alias("email"), F.col("l_extendedprice").alias("price"),
        F.concat(F.lit("city"), F.col("l_partkey") % 20).alias("city"), (F.col("l_orderkey") * 10 + n).alias("ord"), F.concat(F.lit("mls"), F.col("l_orderkey") % 500).alias("mls_number"))


SALES_SQL = """sales AS (SELECT l_suppkey AS agent_id, CASE WHEN l_linenumber > 1 THEN 'agent' || (l_suppkey % 50) END AS name, CASE WHEN l_linenumber > 2 THEN 'a' || l_suppkey || '@x.example' END AS email, l_extendedprice AS price,
  'city' || (l_partkey % 20) AS city, l_orderkey * 10 + l_linenumber AS ord, 'mls' || (l_orderkey % 500) AS mls_number FROM lineitem)"""


def leads(spark, sf_dir) -> DataFrame:
    k = F.col("c_custkey")
    return read(spark, sf_dir, "customer").select(
        k.alias("ord"), F.concat(F.lit("Lead "), k % 700).alias("page_name"), F.when(k % 3 > 0, F.concat(F.lit("e"), k % 500, F.lit("@x.example"))).alias("primary_email"),
        F.when(k % 4 > 0, F.concat(F.lit("https://www.site"), k % 400, F.lit(".example/"))).alias("website_url"), F.when(k % 5 > 1, F.concat(F.lit("555-010-"), F.lpad((k % 10000).cast("string"), 4, "0"))).alias("phones"), (k % 6).cast("string").alias("ad_count"),
        (k * 7 % 150).cast("string").alias("gmaps_review_count"), (k % 2 == 0).alias("has_crm"), (k % 3 == 0).alias("has_marketing_pixel"), (k % 5 == 0).alias("has_scheduling_tool"), (k % 7 == 0).alias("has_chat_widget"),
        _pick(["Owner", "Sales Agent", "Managing Broker", None], k % 4).alias("contact_position"), F.when(k % 6 == 0, "@lead").otherwise("[]").alias("instagram_handles"), F.when(k % 8 == 0, "n/a").otherwise((F.lit(3.0) + (k % 20) / 10).cast("string")).alias("gmaps_rating"))


LEADS_SQL = f"""leads AS (SELECT c_custkey AS ord, 'Lead ' || (c_custkey % 700) AS page_name, CASE WHEN c_custkey % 3 > 0 THEN 'e' || (c_custkey % 500) || '@x.example' END AS primary_email,
  CASE WHEN c_custkey % 4 > 0 THEN 'https://www.site' || (c_custkey % 400) || '.example/' END AS website_url, CASE WHEN c_custkey % 5 > 1 THEN '555-010-' || lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0') END AS phones, c_custkey % 6 AS ad_count,
  c_custkey * 7 % 150 AS gmaps_review_count, c_custkey % 2 = 0 AS has_crm, c_custkey % 3 = 0 AS has_marketing_pixel, c_custkey % 5 = 0 AS has_scheduling_tool, c_custkey % 7 = 0 AS has_chat_widget,
  {_sql_pick(["Owner", "Sales Agent", "Managing Broker", None], "c_custkey % 4")} AS contact_position, CASE WHEN c_custkey % 6 = 0 THEN '@lead' ELSE '[]' END AS instagram_handles, CASE WHEN c_custkey % 8 = 0 THEN 0 ELSE 3.0 + (c_custkey % 20) / 10 END AS gmaps_rating FROM customer)"""
