"""Matching names, sites and profiles; places and introductions in text. Python only for the sequence ratio and for mail headers."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from ..functions.text import fold, url_domain

# Countries by domain ending, places by pattern, acronyms, phrases of introductions, name suffixes.
COUNTRY_BY_ENDING = {"co": "Colombia", "com.co": "Colombia", "edu.co": "Colombia", "gov.co": "Colombia", "mx": "Mexico", "com.mx": "Mexico", "br": "Brazil", "com.br": "Brazil", "pe": "Peru", "com.pe": "Peru", "cl": "Chile", "ar": "Argentina", "com.ar": "Argentina", "es": "Spain", "uk": "United Kingdom", "co.uk": "United Kingdom", "edu": "United States", "gov": "United States"}
CITIES = [
    ("medell[ií]n", "Medellín", "Antioquia", "Colombia"), ("bogot[áa]", "Bogotá", None, "Colombia"), ("miami", "Miami", "Florida", "United States"), ("new york|nyc", "New York", "New York", "United States"), ("lima", "Lima", None, "Peru"),
    ("mexico city|ciudad de m[ée]xico|cdmx", "Mexico City", None, "Mexico"), ("santiago", "Santiago", None, "Chile"), ("s[ãa]o paulo", "São Paulo", None, "Brazil"), ("buenos aires", "Buenos Aires", None, "Argentina"), ("cartagena", "Cartagena", None, "Colombia"), ("barranquilla", "Barranquilla", None, "Colombia"), (r"\bcali\b", "Cali", None, "Colombia"),
]
COUNTRIES = [(r"colombia\b", "Colombia"), (r"\bm[ée]xico\b", "Mexico"), (r"\bbrasil\b|\bbrazil\b", "Brazil"), (r"\bper[úu]\b", "Peru"), (r"\bchile\b", "Chile"), (r"\bargentina\b", "Argentina")]
ACRONYMS = ["ibm", "cbre", "jll", "pwc", "ey", "kpmg", "hsbc", "ups", "dhl", "bmw", "sap", "hbo", "cnn", "bbc", "nbc", "abc", "espn", "mit", "ucla", "usc", "nyu", "kkr", "bcg"]
INTRODUCTIONS = ["i'd like to introduce you to", "i want to introduce", "connecting you with", "you should meet", "i think you two should connect", "meet my friend", "putting you in touch with", "looping in", "adding .* to this thread", "let me introduce", "pleased to introduce", "introducing you to", "forwarding this intro", "passing along this introduction", "fwd:.*intro", "re:.*introduction"]
COMPANY_SUFFIXES = [" inc", " inc.", " llc", " ltd", " corp", " corporation", " co", " co."]


@pandas_udf(T.DoubleType())
def similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    """Twice the matching characters over all, by longest common blocks, in lower case; 0 with a missing name."""
    from difflib import SequenceMatcher

    return pd.Series([SequenceMatcher(None, x.lower(), y.lower()).ratio() if x and y else 0.0 for x, y in zip(a, b)])


@pandas_udf(T.StringType())
def mime_header(cells: pd.Series) -> pd.Series:
    """A mail header with its encoded words decoded."""
    from email.header import decode_header, make_header

    def one(x):
        try:
            return None if x is None else str(make_header(decode_header(x)))
        except (LookupError, ValueError, UnicodeDecodeError):
            return x

    return cells.map(one)


def addresses(header: Column) -> Column:
    """Addresses of a From or To header in lower case, in order."""
    return F.transform(F.regexp_extract_all(F.coalesce(header, F.lit("")), F.lit(r"[A-Za-z0-9._%+'-]+@[A-Za-z0-9.-]+"), F.lit(0)), lambda x: F.lower(x))


def compact(c: Column) -> Column:
    return F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "[^a-z0-9]", "")


def website_confidence(name: Column, url: Column) -> Column:
    """How likely a site is a company's, by its name and the site's: from 0.3 to 0.99."""
    label = F.split(F.regexp_replace(F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://([^/?#]*)", 1), r"www\.", ""), r"\.")[0]
    n, s = compact(name), compact(label)
    ratio = F.length(s) / F.greatest(F.length(n), F.lit(1))
    words = F.split(F.regexp_replace(F.lower(name), r"[^\w\s]", ""), r"\s+")
    shared = F.size(F.filter(F.array_intersect(words, F.split(label, r"[\W_]+")), lambda w: w != ""))
    return (
        F.when(n == s, 0.99).when(n.startswith(s), 0.90 + 0.08 * ratio).when(s.startswith(F.substring(n, 1, 5)), 0.85).when(F.contains(n, s), 0.7 + 0.2 * ratio).when(F.contains(s, n), 0.9)
        .when(shared > 0, F.least(F.lit(0.8), 0.5 + shared * 0.15)).otherwise(0.3)
    )


def place_confidence(name: Column, website: Column, their_name: Column, their_site: Column, reviews: Column) -> Column:
    """0 to 1 for a place found for a company: by names, sites, and whether it has reviews."""
    sim, a, b = similarity(name, their_name), url_domain(website), url_domain(their_site)
    by_name = F.when(sim >= 0.9, 0.5).when(sim >= 0.7, 0.35).when(sim >= 0.5, 0.2).otherwise(0.0)
    by_site = F.when(a == b, 0.4).when(F.contains(a, b) | F.contains(b, a), 0.25).otherwise(0.0)
    return F.least(F.lit(1.0), by_name + by_site + F.when(F.coalesce(reviews, F.lit(0)) > 0, 0.1).otherwise(0.0))


def profile_score(name: Column, company: Column, url: Column, title: Column, text: Column) -> Column:
    """Points for a profile page found for a person; null for pages that are none."""
    parts = F.split(F.lower(F.trim(name)), r"\s+")
    first, last = parts[0], F.when(F.size(parts) > 1, F.element_at(parts, -1))
    slug, t = F.regexp_extract(F.lower(url), r"/in/([^/?]+)", 1), F.lower(F.coalesce(text, F.lit("")))
    has = lambda where, what: F.coalesce(F.contains(where, what) & (what != ""), F.lit(False))
    heading = F.trim(F.split(F.lower(F.coalesce(title, F.lit(""))), "-")[0])
    c = F.lower(F.trim(F.coalesce(company, F.lit(""))))
    by_company = F.when((F.length(c) > 2) & F.contains(t, c), 25).when(F.exists(F.filter(F.split(c, r"\s+"), lambda w: F.length(w) > 3), lambda w: F.contains(t, w)), 10).otherwise(0)
    points = [(has(slug, first), 30), (has(slug, last), 30), (has(t, first), 15), (has(t, last), 15)]
    score = sum((F.when(k, v).otherwise(0) for k, v in points), F.lit(0)) + F.when(heading != "", (similarity(name, heading) * 40).cast("int")).otherwise(0) + by_company
    return F.when(F.contains(url, F.lit("/in/")) & ~F.contains(url, F.lit("/company/")), score)


def ad_presence(agents: DataFrame, pages: DataFrame) -> DataFrame:
    """agent_id, pages, confidence: pages (agent_id, page_name) that share two parts of an agent's name, or its only one."""
    parts = F.filter(F.split(F.lower(F.trim("name")), r"\s+"), lambda p: F.length(p) > 2)
    met = agents.select("agent_id", parts.alias("parts")).join(pages, "agent_id", "left")
    n = F.size(F.filter("parts", lambda p: F.contains(F.lower(F.coalesce("page_name", F.lit(""))), p)))
    counts = met.groupBy("agent_id").agg(F.count_if((F.size("parts") > 0) & (n >= F.least(F.lit(2), F.size("parts")))).alias("pages"))
    return counts.withColumn("confidence", F.when(F.col("pages") >= 2, "high").when(F.col("pages") == 1, "medium").otherwise("low"))


def matching_name(name: Column, suffixes: list[str]) -> Column:
    """A name's form for comparison: no accents, `Last, First` turned round, suffixes dropped, spaces squeezed."""
    n = fold(name)
    two = F.transform(F.split(n, ","), lambda p: F.trim(p))
    head = F.split(F.get(two, F.lit(1)), r"\s+")[0]
    turned = F.when((F.size(two) == 2) & (head != "") & ~head.isin(suffixes), F.concat_ws(" ", F.get(two, F.lit(1)), F.get(two, F.lit(0)))).when(F.size(two) == 2, F.array_join(two, " ")).otherwise(n)
    words = F.transform(F.split(F.trim(turned), r"\s+"), lambda w: F.regexp_replace(w, r"[.,]+$", ""))
    return F.array_join(F.filter(words, lambda w: (w != "") & ~w.isin(suffixes)), " ")


def company_of_domain(domain: Column) -> Column:
    """A company's name from its domain: without ending and mail hosts; known acronyms in capitals."""
    n = F.regexp_replace(F.regexp_replace(F.lower(domain), r"\.[^.]*$", ""), r"^(?:(?:mail|email|smtp|mx|www)\.)+", "")
    parts = F.split(n, r"\.")
    n = F.when(F.size(parts) > 1, F.when(F.element_at(parts, -1).isin("co", "com", "net", "org", "edu"), parts[0]).otherwise(F.array_join(parts, " "))).otherwise(n)
    return F.when(n.isin(ACRONYMS), F.upper(n)).otherwise(F.initcap(n))


def company_key(name: Column) -> Column:
    """A company's name without its legal form, in lower case."""
    n = F.lower(F.trim(F.coalesce(name, F.lit(""))))
    for s in COMPANY_SUFFIXES:
        n = F.regexp_replace(n, s.replace(".", r"\.") + "$", "")
    return F.trim(n)


def country_of_email(email: Column) -> Column:
    """Country by an address's ending of two parts, else of one; null for general endings."""
    parts = F.split(F.lower(F.when(F.contains(email, F.lit("@")), F.substring_index(email, "@", -1))), r"\.")
    find = lambda key: F.coalesce(*(F.when(key == k, F.lit(v)) for k, v in COUNTRY_BY_ENDING.items()))
    two = F.array_join(F.slice(parts, F.greatest(F.size(parts) - 1, F.lit(1)), 2), ".")
    return F.coalesce(F.when(F.size(parts) > 2, find(two)), F.when(F.size(parts) > 1, find(F.element_at(parts, -1))))


def place_of_company(name: Column) -> Column:
    """city, state, country in a company's name: the first city that matches, else the first country; null without one."""
    n = F.lower(F.coalesce(name, F.lit("")))
    make = lambda city, state, country: F.struct(F.lit(city).cast("string").alias("city"), F.lit(state).cast("string").alias("state"), F.lit(country).alias("country"))
    return F.coalesce(*(F.when(n.rlike(f"(?u){p}"), make(*place)) for p, *place in CITIES), *(F.when(n.rlike(p), make(None, None, c)) for p, c in COUNTRIES))


def introduced(text: Column) -> Column:
    """Whether a text introduces someone."""
    return F.coalesce(text, F.lit("")).rlike("(?i)" + "|".join(INTRODUCTIONS))


def introduced_name(text: Column) -> Column:
    """The capitalised name after a phrase of introduction."""
    found = F.regexp_extract(F.coalesce(text, F.lit("")), r"(?:[Ii]ntroduc(?:e|ing)(?: you to| my friend| my colleague)?|[Cc]onnecting you with|[Yy]ou should meet|[Ll]ooping in|[Aa]dding|[Mm]eet my friend|[Pp]utting you in touch with)\s+([A-Z][a-z]+(?:\s+[A-Z][a-z]+)*)", 1)
    return F.nullif(found, F.lit(""))


def email_candidates(first: Column, last: Column, domain: Column, k: int = 5) -> Column:
    """The k likeliest addresses of a person at a domain, in order."""
    f, z = F.lower(F.trim(first)), F.lower(F.trim(F.coalesce(last, F.lit(""))))
    own = F.array(F.concat(f, F.lit("."), z), F.concat(F.substring(f, 1, 1), z), F.concat(f, F.substring(z, 1, 1)), F.concat(f, F.lit("_"), z), F.concat(f, z))
    boxes = F.concat(F.when(z != "", own).otherwise(F.array().cast("array<string>")), F.array(f, F.lit("info"), F.lit("contact")))
    return F.when((F.coalesce(f, F.lit("")) != "") & domain.isNotNull(), F.slice(F.transform(boxes, lambda b: F.concat(b, F.lit("@"), domain)), 1, k))


def handle_candidates(name: Column) -> Column:
    """Likely handles of a person, in order; none without two parts."""
    parts = F.filter(F.split(F.lower(F.trim(name)), r"\s+"), lambda p: F.length(p) > 1)
    f, z = parts[0], F.element_at(parts, -1)
    shapes = [(f, z), (f, ".", z), (f, "_", z), (f, z, "realtor"), (f, z, "_realtor"), (f, z, "realestate"), ("the", f, z), (z, f), (z, "_realestate")]
    return F.when(F.size(parts) >= 2, F.array(*(F.concat(F.lit("@"), *(F.lit(x) if isinstance(x, str) else x for x in s)) for s in shapes))).otherwise(F.array().cast("array<string>"))
