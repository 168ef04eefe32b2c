"""Drafts, templates, sending decisions and staged enrichment: the decisions alone, nothing is sent."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import valid_email

# Names that aren't one, and mailboxes that aren't a person's.
INVALID_NAMES = ["none", "none none", "nan", "n/a", "null", "undefined", "unknown", "meet our team", "social media", "featured video", "your information", "contact", "info", "support", "team", "admin", "owner", "manager", "contact us", "get in touch", "learn more", "click here"]
GENERIC_MAILBOXES = ["info", "contact", "support", "sales", "hello", "hi", "team", "admin", "office", "general", "mail", "enquiries", "inquiries", "help", "service", "services", "marketing", "press", "media", "careers", "jobs", "hr", "billing", "accounts", "orders", "orderdesk"]
STATUS_POINTS = {"OK": 50, "CATCH_ALL": 20, "UNKNOWN": 10, "error": 5, "INVALID": 0}


def render(template: Column, variables: Column) -> Column:
    """A template with its {{ name }} marks replaced from a map; marks without a value stay."""
    return F.aggregate(F.map_entries(variables), template, lambda acc, v: F.regexp_replace(acc, F.concat(F.lit(r"\{\{\s*"), v["key"], F.lit(r"\s*\}\}")), F.regexp_replace(F.coalesce(v["value"], F.lit("")), r"([\\$])", r"\\$1")))


def leftover_marks(body: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.coalesce(body, F.lit("")), F.lit(r"\{\{\s*([A-Za-z_][A-Za-z0-9_]*)\s*\}\}"), F.lit(1)))


def name_from_email(email: Column) -> Column:
    """First Last of a mailbox of two or more parts of letters; null for generic mailboxes and single parts."""
    box = F.lower(F.substring_index(email, "@", 1))
    parts = F.filter(F.split(F.regexp_replace(box, "[0-9]", ""), r"[._-]+"), lambda p: F.length(p) > 1)
    return F.when(~box.isin(GENERIC_MAILBOXES) & (F.size(parts) >= 2), F.initcap(F.array_join(parts, " ")))


def checked(drafts: DataFrame) -> DataFrame:
    """draft_id, check, severity, detail of what is wrong with drafts (draft_id, contact_name, primary_email, email_body): a row a fault."""
    name, body, box = F.coalesce(F.col("contact_name"), F.lit("")), F.coalesce("email_body", F.lit("")), F.lower(F.substring_index("primary_email", "@", 1))
    greeted = F.regexp_extract(body, r"(?im)^(?:hi|hello|dear|hey)\s+([^,\n]+),", 1)
    first = F.lower(F.split(F.trim(name), r"\s+")[0])
    fault = lambda cond, check, severity, detail: F.when(cond, F.struct(F.lit(check).alias("check"), F.lit(severity).alias("severity"), detail.alias("detail")))
    faults = F.array(
        fault((F.trim(name) == "") | F.lower(F.trim(name)).isin(INVALID_NAMES), "contact_name", "critical", name),
        fault(F.size(leftover_marks(body)) > 0, "template_vars", "critical", F.array_join(leftover_marks(body), ",")),
        fault(F.lower(greeted).isin(INVALID_NAMES), "greeting", "critical", greeted),
        fault((greeted != "") & (first != "") & ~F.contains(F.lower(greeted), first), "greeting", "warning", greeted),
        fault(box.isin(GENERIC_MAILBOXES), "email_name", "info", box),
    )
    return drafts.select("draft_id", F.explode(F.array_compact(faults)).alias("x")).select("draft_id", "x.*")


def issues(faults: DataFrame) -> DataFrame:
    """severity, check, n, drafts."""
    return faults.groupBy("severity", "check").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("draft_id").alias("drafts"))


def fixed(drafts: DataFrame) -> DataFrame:
    """drafts with names from addresses where they lack one, greetings to match, lines with leftover marks dropped, and changes."""
    bad = F.lower(F.trim(F.coalesce("contact_name", F.lit("")))).isin(["", *INVALID_NAMES])
    name = F.when(bad, F.coalesce(name_from_email(F.col("primary_email")), F.lit(""))).otherwise(F.col("contact_name"))
    hello = F.when(name == "", F.lit("Hi there,")).otherwise(F.concat(F.lit("Hi "), F.split(name, r"\s+")[0], F.lit(",")))
    greeted = F.when(bad, F.regexp_replace(F.col("email_body"), F.lit(r"(?im)\A(?:hi|hello|dear|hey)\s+[^,\n]+,"), hello)).otherwise(F.col("email_body"))
    lines = F.filter(F.split(greeted, "\n"), lambda x: ~x.rlike(r"\{\{.*?\}\}"))
    body = F.regexp_replace(F.array_join(lines, "\n"), r"\n{3,}", "\n\n")
    changes = F.array_compact(F.array(F.when(bad, F.lit("contact_name")), F.when(bad & (greeted != F.col("email_body")), F.lit("greeting")), F.when(body != greeted, F.lit("template_vars"))))
    return drafts.select(*[c for c in drafts.columns if c not in ("contact_name", "email_body")], name.alias("contact_name"), body.alias("email_body"), changes.alias("changes"))


def send_score(status: Column, confidence: Column, generic: Column, catch_all: Column) -> Column:
    """0 to 100: how sure an address is; an invalid one is 0."""
    points = F.coalesce(*(F.when(status == k, v) for k, v in STATUS_POINTS.items()), F.lit(0))
    score = points + (F.coalesce(confidence, F.lit(0)) * 0.2) + F.when(generic, 0).otherwise(15) + F.when(catch_all, 5).otherwise(15)
    return F.when(status == "INVALID", F.lit(0)).otherwise(F.least(F.lit(100), score.cast("int")))


def recommendation(score: Column) -> Column:
    return F.when(score >= 70, "send").when(score >= 50, "review").when(score >= 30, "risky").otherwise("reject")


def eligible(rows: DataFrame, blocked: DataFrame, least: int = 50) -> DataFrame:
    """rows with send_status: already_sent, invalid_email, suppressed, low_score or ready; the first that holds."""
    stop = blocked.select(F.lower(F.trim(F.col(blocked.columns[0]))).alias("_b")).filter("_b is not null").distinct().withColumn("_stop", F.lit(True))
    met = rows.join(stop, F.lower(F.trim("email")) == F.col("_b"), "left")
    status = F.when(F.col("sent_at").isNotNull(), "already_sent").when(~valid_email(F.col("email")), "invalid_email").when(F.col("_stop"), "suppressed").when(F.col("score") < least, "low_score").otherwise("ready")
    return met.withColumn("send_status", status).drop("_b", "_stop")


def bounce(sender: Column, subject: Column) -> Column:
    """Whether a mail is a bounce: automatic replies aren't, delivery systems and failure notices are."""
    s, t = F.lower(F.coalesce(sender, F.lit(""))), F.lower(F.coalesce(subject, F.lit("")))
    return F.when(t.rlike("out of office|automatic reply|vacation"), False).otherwise(s.rlike("mailer-daemon|postmaster|mail delivery") | t.rlike("undeliver|delivery status|delivery failure|returned mail"))


def staged(contacts: DataFrame, stages: list[tuple[str, DataFrame, float]], key: str = "domain") -> DataFrame:
    """contacts with email, stage, status, confidence and cost from ordered providers (name, table (key, email, status, confidence), unit cost).

    In a provider the best status counts, then confidence; the first provider with a valid address ends the search, else
    the most confident address is taken. Cost adds up over the providers asked.
    """
    rank = F.when(F.col("status") == "valid", 0).when(F.col("status") == "accept_all", 1).when(F.col("status") == "unknown", 2).otherwise(3)
    out, asked, found = contacts, F.lit(True), []
    cost = F.lit(0.0)
    for i, (name, table, unit) in enumerate(stages):
        best = table.withColumn("_r", F.row_number().over(Window.partitionBy(key).orderBy(rank, F.desc("confidence"), "email"))).filter("_r = 1")
        out = out.join(best.select(F.col(key), F.struct(F.lit(i).alias("i"), F.lit(name).alias("stage"), "email", "status", "confidence").alias(f"_{i}")), key, "left")
        cost = cost + F.when(asked, F.lit(unit)).otherwise(F.lit(0.0))
        asked = asked & ~F.coalesce(F.col(f"_{i}.status") == "valid", F.lit(False))
        found.append(F.col(f"_{i}"))
    valid = F.coalesce(*(F.when(x["status"] == "valid", x) for x in found))
    sure = F.get(F.array_sort(F.array_compact(F.array(*found)), lambda a, b: F.when(a["confidence"] != b["confidence"], F.when(a["confidence"] > b["confidence"], F.lit(-1)).otherwise(F.lit(1))).otherwise(a["i"] - b["i"])), F.lit(0))
    got = F.coalesce(valid, sure)
    return out.select(*contacts.columns, got["email"].alias("email"), got["stage"].alias("stage"), got["status"].alias("status"), got["confidence"].alias("confidence"), F.round(cost, 4).alias("cost"))


def within_budget(rows: DataFrame, cost: str, budget: float, order: list[str], ranges: int = 256) -> DataFrame:
    """rows in order until their cost so far reaches the budget, with what was spent before each; the first column of the order is a number or a time.

    Rows fall into ranges by that column; sums of ranges tell what is spent before each, and only within a range are
    rows added up one by one. Ranges that begin beyond the budget are left out before that.
    """
    at = F.col(order[0]).cast("double")
    bounds = F.percentile_approx(at, [i / ranges for i in range(1, ranges)], 10_000)
    cuts = rows.agg(F.coalesce(F.array_distinct(bounds), F.array().cast("array<double>")).alias("_cuts"))
    placed = rows.crossJoin(F.broadcast(cuts)).withColumn("_range", F.when(at.isNull(), -1).otherwise(F.size(F.filter("_cuts", lambda c: c <= at)))).drop("_cuts")  # a row of cuts
    sums = placed.groupBy("_range").agg(F.sum(cost).alias("_sum"))
    upto = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    begins = sums.select("_range", F.coalesce(F.sum("_sum").over(upto(Window.orderBy("_range"))), F.lit(0.0)).alias("_begin"))
    kept = placed.join(F.broadcast(begins.filter(F.col("_begin") < budget)), "_range")
    spent = F.col("_begin") + F.coalesce(F.sum(cost).over(upto(Window.partitionBy("_range").orderBy(*order))), F.lit(0.0))
    return kept.withColumn("spent_before", spent).filter(F.col("spent_before") < budget).drop("_range", "_begin")


def json_answer(text: Column, schema: str, field: str, allowed: list[str], default: str) -> Column:
    """A field of a model's answer: the fenced JSON block, else the first braces; values outside `allowed` become the default."""
    fenced = F.nullif(F.regexp_extract(text, r"(?s)```(?:json)?\s*(\{.*?\})\s*```", 1), F.lit(""))
    plain = F.nullif(F.regexp_extract(text, r"(?s)(\{.*\})", 1), F.lit(""))
    value = F.lower(F.trim(F.from_json(F.coalesce(fenced, plain), schema)[field]))
    return F.when(value.isin(allowed), value).otherwise(default)


def upsert(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """old and new (key, seen) as key, first_seen, last_seen, times: a history of what has been seen."""
    both = old.select(key, "first_seen", "last_seen", "times").unionByName(new.groupBy(key).agg(F.min("seen").alias("first_seen"), F.max("seen").alias("last_seen"), F.count(F.lit(1)).alias("times")))
    return both.groupBy(key).agg(F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"), F.sum("times").alias("times"))
