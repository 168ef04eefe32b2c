"""Queries of names, sites and places."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import matching as M
from .proxies import _pick, _sql_pick, read

COMPANIES = ["Acme Miami LLC", "Bogotá Homes", "Peru Trade Co", "Plain Inc", "Ciudad de México SA", "Cali Group Corp"]
ADDRESSES = ["a@x.com.co", "b@y.edu", "c@z.com", "d@w.co.uk", "none", "e@v.mx", "f@u.uk"]
SITES = ["https://www.acme.example/a", "http://acmerealty.example", "https://lake.example", "https://x-realty-acme.example/y", "https://the-acme.example"]
AGENTS = ["Ann Lee Smith", "Bob", "Cyd Ray"]


def match_countries(spark, d):
    return read(spark, d, "customer").select("c_custkey", M.country_of_email(_pick(ADDRESSES, F.col("c_custkey") % 7)).alias("country"))


def match_places(spark, d):
    p = M.place_of_company(_pick(COMPANIES, F.col("c_custkey") % 6))
    return read(spark, d, "customer").select("c_custkey", p["city"].alias("city"), p["state"].alias("state"), p["country"].alias("country"), M.company_key(_pick(COMPANIES, F.col("c_custkey") % 6)).alias("company_key"))


def match_candidates(spark, d):
    k = F.col("c_custkey")
    return read(spark, d, "customer").select(k, F.array_join(M.email_candidates(F.lit("Ann"), F.when(k % 2 == 0, "Lee"), F.lit("x.example")), ",").alias("emails"), F.array_join(M.handle_candidates(F.when(k % 3 == 0, "Ann").otherwise("Ann M Lee")), ",").alias("handles"))


def match_websites(spark, d):
    k = F.col("c_custkey")
    return read(spark, d, "customer").select(k, F.round(M.website_confidence(F.lit("Acme Realty"), _pick(SITES, k % 5)), 4).alias("confidence"))


def match_ad_presence(spark, d):
    agents = spark.createDataFrame(list(enumerate(AGENTS)), "agent_id long, name string")
    pages = read(spark, d, "customer").select((F.col("c_custkey") % 2).alias("agent_id"), F.when(F.col("c_custkey") == 2, "Ann Lee Homes").when(F.col("c_custkey") == 3, "Bob's").when(F.col("c_custkey") == 5, "bobcat").otherwise("Ann").alias("page_name"))
    return M.ad_presence(agents, pages)


_CONF = "round((list_value(CAST(0.9 + 0.08 * 4 / 10 AS DOUBLE), 0.99, 0.3, 0.8, 0.65))[1 + c_custkey % 5], 4)"
QUERIES = {f.__name__: f for f in (match_countries, match_places, match_candidates, match_websites, match_ad_presence)}
SQL = {
    "match_countries": f"SELECT c_custkey, {_sql_pick(['Colombia', 'United States', None, 'United Kingdom', None, 'Mexico', 'United Kingdom'], 'c_custkey % 7')} AS country FROM customer",
    "match_places": "SELECT c_custkey, " + ", ".join(f"{_sql_pick(v, 'c_custkey % 6')} AS {c}" for c, v in {"city": ["Miami", "Bogotá", None, None, "Mexico City", "Cali"], "state": ["Florida"] + [None] * 5, "country": ["United States", "Colombia", "Peru", None, "Mexico", "Colombia"], "company_key": ["acme miami", "bogotá homes", "peru trade", "plain", "ciudad de méxico sa", "cali group"]}.items()) + " FROM customer",
    "match_candidates": "SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'ann.lee@x.example,alee@x.example,annl@x.example,ann_lee@x.example,annlee@x.example' ELSE 'ann@x.example,info@x.example,contact@x.example' END AS emails, CASE WHEN c_custkey % 3 = 0 THEN '' ELSE '@annlee,@ann.lee,@ann_lee,@annleerealtor,@annlee_realtor,@annleerealestate,@theannlee,@leeann,@lee_realestate' END AS handles FROM customer",
    "match_websites": f"SELECT c_custkey, {_CONF} AS confidence FROM customer",
    "match_ad_presence": "SELECT 0 AS agent_id, 1 AS pages, 'medium' AS confidence UNION ALL SELECT 1, 2, 'high' UNION ALL SELECT 2, 0, 'low'",
}
