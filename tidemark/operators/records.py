"""Keyed tables that grow: insert or ignore, insert or replace, upserts, links between people and companies, nested listings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import email_domain, normal_url
from .joins import latest, small
from .master import keep_first


def insert_or_ignore(table: DataFrame, new: DataFrame, keys: list[str], order: str) -> DataFrame:
    """table and those rows of new whose keys it lacks, the first of each by order."""
    fresh = keep_first(new, keys, order).drop(order).join(table.select(*keys), keys, "left_anti")
    return table.unionByName(fresh.select(*table.columns))


def insert_or_replace(table: DataFrame, new: DataFrame, key: str, order: str) -> DataFrame:
    """The last row of each key of both, new ones after old ones."""
    both = table.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
    rest = [F.desc(c) for c in table.columns if c not in (key, order)]
    last = F.row_number().over(Window.partitionBy(key).orderBy(F.desc("_new"), F.desc(order), *rest))
    return both.withColumn("_r", last).filter("_r = 1").drop("_r", "_new")


def unseen(rows: DataFrame, history: DataFrame, key: str, force: bool = False) -> DataFrame:
    """rows whose key a history lacks; all of them where they are wanted again."""
    return rows if force else rows.join(history.select(key).distinct(), key, "left_anti")


def people(old: DataFrame, new: DataFrame, key: str = "email", keep: tuple[str, ...] = ()) -> DataFrame:
    """People of both by key: a new cell takes the old one's place if it isn't null; cells of `keep` only where the old is null."""
    cells = [c for c in old.columns if c != key]
    met = old.join(new.select(key, *(F.col(c).alias(f"_{c}") for c in cells)), key, "full")
    return met.select(key, *((F.coalesce(c, f"_{c}") if c in keep else F.coalesce(f"_{c}", c)).alias(c) for c in cells))


def unlinked(persons: DataFrame, edges: DataFrame) -> DataFrame:
    """Persons with an address and no edge to a company."""
    return persons.filter(F.contains("email", F.lit("@"))).join(edges.select("email").distinct(), "email", "left_anti")


def companies_by_domain(persons: DataFrame, skipped: list[str]) -> DataFrame:
    """email, domain, confidence of persons whose domain, and its last two labels, aren't skipped."""
    d = email_domain(F.col("email"))
    two = F.substring_index(d, ".", -2)
    return persons.select("email", d.alias("domain")).filter(F.col("domain").isNotNull() & ~F.col("domain").isin(skipped) & ~two.isin(skipped)).withColumn("confidence", F.lit(0.6))


def topics(extractions: DataFrame) -> DataFrame:
    """email, topic: distinct, trimmed and in lower case, of extractions (email, topics array)."""
    rows = extractions.select("email", F.explode("topics").alias("t")).select("email", F.lower(F.trim("t")).alias("topic"))
    return rows.filter("topic <> ''").distinct()


def introduction_edges(introductions: DataFrame) -> DataFrame:
    """src, dst, date (the latest), via and context (of the first) of introductions."""
    return introductions.groupBy(F.col("introduced").alias("src"), F.col("introduced_to").alias("dst")).agg(F.max("sent").alias("date"), F.min_by("introducer", F.struct("sent", "message_id")).alias("via"))


def with_location(persons: DataFrame, works_at: DataFrame, places: DataFrame) -> DataFrame:
    """persons with city, state and country of their company's domain; a state or country that they have stays."""
    at = works_at.join(small(places), "domain").select("email", F.col("city").alias("_c"), F.col("state").alias("_s"), F.col("country").alias("_k"))
    met = persons.join(keep_first(at, ["email"], "_c"), "email", "left")
    return met.select("email", F.coalesce("_c", "city").alias("city"), F.coalesce("state", "_s").alias("state"), F.coalesce("country", "_k").alias("country"))


def by_profile(df: DataFrame, found: DataFrame) -> DataFrame:
    """df with the row of found of the same profile address, whatever its scheme and ending; an equi-join on normal addresses."""
    key = F.regexp_replace(normal_url(F.col("url")), r"\?.*$", "")
    right = latest(found.withColumn("_k", key).withColumn("_o", F.col("url")), "_k", "_o").drop("url", "_o")
    return df.withColumn("_k", key).join(right, "_k", "left").drop("_k")


def website_of_mail(email: Column, website: Column, personal: list[str]) -> Column:
    """website, reason: the site that is there, else that of the mail's domain unless it is a personal one."""
    d, w = email_domain(email), F.nullif(F.trim(website), F.lit(""))
    site = F.when(w.isNotNull(), w).when(d.isNotNull() & ~d.isin(personal), F.concat(F.lit("https://"), d))
    reason = F.when(w.isNotNull(), "present").when(d.isNull(), "no_email").when(d.isin(personal), "personal_domain").otherwise("from_email")
    return F.struct(site.alias("website"), reason.alias("reason"))


def handles_once(rows: DataFrame, key: str, handles: str, excluded: DataFrame, order: str) -> DataFrame:
    """key, handle: each handle with the first row that has it, without excluded ones (handle)."""
    each = rows.select(key, order, F.explode(handles).alias("h")).select(key, order, F.lower(F.trim("h")).alias("handle")).filter("handle <> ''")
    return keep_first(each.join(small(excluded), "handle", "left_anti"), ["handle"], order).select(key, "handle")


def listings(raw: DataFrame) -> DataFrame:
    """Flat listings of nested ones (id, address struct, prices array, agents array of struct): the first price there is, the first two agents."""
    a = F.col("address")
    street = F.concat_ws(" ", *(F.nullif(F.trim(a[c]), F.lit("")) for c in ("number", "street", "unit")))
    agent = lambda i, c: F.get("agents", F.lit(i))[c]
    return raw.select("id", street.alias("street"), a["city"].alias("city"), F.get(F.filter("prices", lambda p: p.isNotNull()), F.lit(0)).alias("price"), agent(0, "name").alias("agent"), agent(0, "email").alias("agent_email"), agent(1, "name").alias("second_agent"))


def mail_body(parts: Column, most: int = 5000) -> Column:
    """Text of a mail's parts (mime, data in base64): the plain one, else the page without tags."""
    text = lambda mime: F.get(F.transform(F.filter(parts, lambda p: p["mime"] == mime), lambda p: F.decode(F.unbase64(F.translate(p["data"], "-_", "+/")), "UTF-8")), F.lit(0))
    bare = F.trim(F.regexp_replace(F.regexp_replace(text("text/html"), r"(?is)<(script|style)\b.*?</\1>|<[^>]*>", " "), r"\s+", " "))
    return F.substring(F.coalesce(F.nullif(text("text/plain"), F.lit("")), bare, F.lit("")), 1, most)


def estimate(modules: DataFrame, rows: int, parallel: float = 1.5) -> DataFrame:
    """cost and minutes of enabled modules (name, unit_cost, seconds, enabled) over rows, with what runs side by side."""
    on = modules.filter("enabled")
    return on.agg(F.round(F.sum(F.col("unit_cost") * rows), 4).alias("cost"), F.round(F.sum(F.col("seconds") * rows) / 60 / parallel, 2).alias("minutes"), F.count(F.lit(1)).alias("modules"))
