"""Deals: losses, owners, periods. deals has id, name, amount, created, closed, owner, status, reason, details, profile, source, demo."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import days_between, percent
from .joins import small


def _over_all(c: str) -> Column:
    return F.sum(c).over(Window.partitionBy())


def parse(raw: DataFrame, owners: DataFrame, won: list[str], lost: list[str]) -> DataFrame:
    """deals of raw text rows (amount, owner_id, stage ...): amounts that aren't numbers are 0, unknown owners keep their id."""
    status = F.when(F.col("stage").isin(won), "won").when(F.col("stage").isin(lost), "lost").otherwise("open")
    named = raw.join(small(owners), "owner_id", "left")
    return named.withColumns({"amount": F.coalesce(F.col("amount").try_cast("double"), F.lit(0.0)), "owner": F.coalesce("owner_name", "owner_id"), "status": status}).drop("owner_name")


def in_period(deals: DataFrame, column: str, as_of: str, days: int) -> DataFrame:
    """deals with period: current from as_of - days on, previous the days before; earlier ones go."""
    now = F.lit(as_of).cast("timestamp")
    cut, before = now - F.expr(f"INTERVAL {days} DAYS"), now - F.expr(f"INTERVAL {2 * days} DAYS")
    return deals.withColumn("period", F.when(F.col(column) >= cut, "current").when(F.col(column) >= before, "previous")).filter("period is not null")


def loss_reasons(deals: DataFrame) -> DataFrame:
    """reason, n, pct of those that have a reason."""
    counts = deals.filter(F.coalesce("reason", F.lit("")) != "").groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("pct", percent(F.col("n"), _over_all("n")))


def profiles(deals: DataFrame) -> DataFrame:
    """profile in lower case, n, pct of all deals, avg_amount."""
    p = F.lower(F.coalesce("profile", F.lit("")))
    counts = deals.groupBy(p.alias("profile")).agg(F.count(F.lit(1)).alias("n"), F.avg("amount").alias("avg_amount"))
    return counts.withColumn("pct", percent(F.col("n"), _over_all("n"))).filter("profile <> ''")


def revenue_by(deals: DataFrame, key: str = "reason") -> DataFrame:
    """key (missing is unknown), n, count_pct, revenue, revenue_pct, avg_deal."""
    k = F.when(F.coalesce(F.col(key), F.lit("")) == "", "unknown").otherwise(F.col(key))
    sums = deals.groupBy(k.alias(key)).agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("revenue"))
    return sums.withColumns({"count_pct": percent(F.col("n"), _over_all("n")), "revenue_pct": percent(F.col("revenue"), _over_all("revenue")), "avg_deal": F.col("revenue") / F.col("n")})


def pareto(revenue: DataFrame, key: str = "reason") -> DataFrame:
    """revenue_by's rows with cumulative_pct by falling revenue; none if all revenue is 0. A row a key meets in one task."""
    falling = Window.orderBy(F.desc("revenue"), key).rowsBetween(Window.unboundedPreceding, 0)
    total = _over_all("revenue")
    return revenue.withColumns({"cumulative_pct": F.sum("revenue").over(falling) / total * 100, "_t": total}).filter("_t > 0").select(key, "revenue", "revenue_pct", "cumulative_pct")


def by_owner(deals: DataFrame, owners: DataFrame) -> DataFrame:
    """owner, n, total_amount, noshow, noshow_rate for every owner of owners(owner), those without deals too."""
    sums = deals.groupBy("owner").agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("total_amount"), F.count_if(F.lower("reason").contains("no_asistio")).alias("noshow"))
    out = owners.select("owner").join(sums, "owner", "left").na.fill({"n": 0, "total_amount": 0.0, "noshow": 0})
    return out.withColumn("noshow_rate", percent(F.col("noshow"), F.col("n")))


def owner_quality(deals: DataFrame) -> DataFrame:
    """owner, total, hygiene, noshow and quality: 100 less the share of both kinds; owners without deals don't appear."""
    out = deals.groupBy("owner").agg(F.count(F.lit(1)).alias("total"), F.count_if(F.lower("reason").contains("higiene")).alias("hygiene"), F.count_if(F.lower("reason").contains("no_asistio")).alias("noshow"))
    return out.withColumn("quality", 100 - (F.col("hygiene") + F.col("noshow")) / F.col("total") * 100)


def efficiency(deals: DataFrame, owners: DataFrame) -> DataFrame:
    """by_owner with avg_deal and its rank."""
    df = by_owner(deals, owners).withColumn("avg_deal", F.when(F.col("n") > 0, F.col("total_amount") / F.col("n")).otherwise(F.lit(0.0)))
    return df.withColumn("efficiency_rank", F.row_number().over(Window.orderBy(F.desc("avg_deal"), "owner"))).select("owner", "n", "total_amount", "avg_deal", "efficiency_rank")


def size_segments(deals: DataFrame) -> DataFrame:
    """segment, n, pct, revenue of all three segments; half-open ranges, so no amount falls between two."""
    s = F.when(F.col("amount") <= 500, "Small").when(F.col("amount") <= 2000, "Medium").otherwise("Enterprise")
    sums = deals.filter("amount >= 0").groupBy(s.alias("segment")).agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("revenue"))
    names = deals.sparkSession.createDataFrame([("Small",), ("Medium",), ("Enterprise",)], "segment string")
    out = names.join(sums, "segment", "left").na.fill({"n": 0, "revenue": 0.0})
    return out.withColumn("pct", percent(F.col("n"), _over_all("n")))


def first_bucket(deals: DataFrame, text: str, buckets: list[tuple[str, list[str]]], other: str) -> DataFrame:
    """bucket, n, pct, revenue: the first bucket any of whose words is in the text."""
    t, b = F.lower(F.coalesce(F.col(text), F.lit(""))), None
    for name, words in buckets:
        hit = F.lit(False)
        for w in words:
            hit = hit | F.contains(t, F.lit(w))
        b = F.when(hit, name) if b is None else b.when(hit, name)
    sums = deals.groupBy(b.otherwise(other).alias("bucket")).agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("revenue"))
    return sums.withColumn("pct", percent(F.col("n"), _over_all("n")))


def mentions(deals: DataFrame, text: str, words: dict[str, str], k: int = 10) -> DataFrame:
    """label, mentions, revenue of the k labels most mentioned: a deal counts for each word that its text has."""
    t = F.lower(F.coalesce(F.col(text), F.lit("")))
    hits = F.array_compact(F.array(*(F.when(F.contains(t, F.lit(w)), F.lit(label)) for w, label in words.items())))
    sums = deals.select("amount", F.explode(hits).alias("label")).groupBy("label").agg(F.count(F.lit(1)).alias("mentions"), F.sum("amount").alias("revenue"))
    return sums.orderBy(F.desc("mentions"), "label").limit(k)


def first_keyword(deals: DataFrame, text: str, words: list[str]) -> DataFrame:
    """deals whose text has one of the words, with the first of them in the list's order."""
    t = F.lower(F.coalesce(F.col(text), F.lit("")))
    return deals.withColumn("keyword", F.coalesce(*(F.when(F.contains(t, F.lit(w)), F.lit(w)) for w in words))).filter("keyword is not null")


def by_source(deals: DataFrame, k: int = 3) -> DataFrame:
    """source, n, count_pct, revenue, revenue_pct, avg_deal, top_reasons (k, with counts)."""
    d = deals.withColumn("source", F.coalesce("source", F.lit("Unknown")))
    reasons = d.groupBy("source", F.coalesce("reason", F.lit("N/A")).alias("r")).agg(F.count(F.lit(1)).alias("c"))
    place = F.row_number().over(Window.partitionBy("source").orderBy(F.desc("c"), "r"))
    top = reasons.withColumn("p", place).filter(F.col("p") <= k).groupBy("source").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("p", "r", "c"))), lambda x: F.concat(x["r"], F.lit(":"), x["c"])), ",").alias("top_reasons"))
    return revenue_by(d, "source").join(top, "source", "left")


def source_by_owner(deals: DataFrame) -> DataFrame:
    """owner, source, n, pct within the owner."""
    counts = deals.groupBy("owner", F.coalesce("source", F.lit("Unknown")).alias("source")).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("pct", percent(F.col("n"), F.sum("n").over(Window.partitionBy("owner"))))


def owner_performance(deals: DataFrame, as_of: str, days: int) -> DataFrame:
    """Volumes, win rates, revenue, days to close, demo funnel and quality by owner, with the period before; one aggregation."""
    d = in_period(deals, "created", as_of, days)
    now, lost, won = F.col("period") == "current", F.col("status") == "lost", F.col("status") == "won"
    n = lambda cond: F.count_if(F.coalesce(now & cond, F.lit(False)))
    taken = days_between(F.col("closed"), F.col("created"))
    before = lambda cond: F.count_if(F.coalesce(~now & cond, F.lit(False)))
    out = d.groupBy("owner").agg(
        n(F.lit(True)).alias("total"), n(won).alias("won"), n(lost).alias("lost"), n(F.col("status") == "open").alias("open"),
        F.coalesce(F.sum(F.when(now & won, F.col("amount"))), F.lit(0.0)).alias("revenue_won"), F.coalesce(F.sum(F.when(now & lost, F.col("amount"))), F.lit(0.0)).alias("revenue_lost"),
        F.coalesce(F.avg(F.when(now & won, taken)), F.lit(0.0)).alias("avg_days_won"), F.coalesce(F.avg(F.when(now & lost, taken)), F.lit(0.0)).alias("avg_days_lost"),
        n(F.col("demo")).alias("demo_total"), n(F.col("demo") & won).alias("demo_won"), n(F.lower("reason").contains("no_asistio")).alias("noshow"), n(F.lower("reason").contains("higiene")).alias("hygiene"),
        before(F.lit(True)).alias("prev_total"), before(won).alias("prev_won"), before(lost).alias("prev_lost"),
    )
    c = F.col
    return out.withColumns({
        "win_rate": percent(c("won"), c("won") + c("lost")), "prev_win_rate": percent(c("prev_won"), c("prev_won") + c("prev_lost")),
        "demo_win_rate": percent(c("demo_won"), c("demo_total")), "quality_score": 100 - percent(c("noshow"), c("lost")) - percent(c("hygiene"), c("lost")),
        "avg_deal_won": F.when(c("won") > 0, c("revenue_won") / c("won")).otherwise(F.lit(0.0)),
    })


def activity(engagements: DataFrame, performance: DataFrame) -> DataFrame:
    """owner, calls, meetings, emails, activity, per_deal."""
    kinds = engagements.groupBy("owner").agg(*(F.count_if(F.col("type") == k).alias(k + "s") for k in ("call", "meeting", "email")))
    out = performance.select("owner", "total").join(kinds, "owner", "left").na.fill(0, ["calls", "meetings", "emails"])
    out = out.withColumn("activity", F.col("calls") + F.col("meetings") + F.col("emails"))
    return out.withColumn("per_deal", F.when(F.col("total") > 0, F.col("activity") / F.col("total")).otherwise(F.lit(0.0))).drop("total")


def top_deals(deals: DataFrame, status: str, k: int) -> DataFrame:
    """The k largest deals of a status: a report, so k rows."""
    took = F.coalesce(days_between(F.col("closed"), F.col("created")), F.lit(0))
    return deals.filter((F.col("status") == status) & (F.col("amount") > 0)).orderBy(F.desc("amount"), "id").limit(k).select("id", "owner", "amount", took.alias("days_to_close"))
