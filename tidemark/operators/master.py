"""The master table: richness de-duplication, merging, lead scores, agents, quality metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions.text import contains_any, normal_url, null_if_sentinel


def richness(df: DataFrame) -> Column:
    """Cells of a row that hold something."""
    return sum((F.col(c).isNotNull().cast("int") for c in df.columns), F.lit(0))


def deduplicate(df: DataFrame, order: str, keys: tuple[str, ...] = ("page_name", "primary_email", "website_url")) -> DataFrame:
    """The richest row of each name, then of each address, then of each URL; blank addresses and URLs all stay.

    Each step sees only the survivors of the one before. Blank keys are told apart by `order`, so they fall into no
    common group.
    """
    out = df.withColumn("_rich", richness(df))
    for i, key in enumerate(keys):
        k = normal_url(F.col(key)) if key == "website_url" else F.col(key)
        k = k if i == 0 else F.when(F.coalesce(k, F.lit("")) != "", F.concat(F.lit("k"), k)).otherwise(F.concat(F.lit("o"), F.col(order).cast("string")))
        first = F.row_number().over(Window.partitionBy("_key").orderBy(F.desc("_rich"), order))
        out = out.withColumn("_key", k).withColumn("_r", first).filter("_r = 1").drop("_key", "_r")
    return out.drop("_rich")


def merge(master: DataFrame, incoming: DataFrame, order: str) -> DataFrame:
    """Both by name, absent columns as null, then de-duplicated."""
    return deduplicate(master.unionByName(incoming, allowMissingColumns=True), order)


def keep_first(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(order))).filter("_r = 1").drop("_r")


def merge_duplicates(df: DataFrame, key: str, sums: list[str], lists: list[str], flags: list[str], firsts: list[str], order: str) -> DataFrame:
    """A row a key: sums added, lists united in order, flags or-ed, other columns by their first filled cell."""
    return df.groupBy(key).agg(
        *(F.sum(c).alias(c) for c in sums), *(F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c) for c in lists),
        *(F.bool_or(c).alias(c) for c in flags), *(F.min_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in firsts),
    )


def lead_score(df: DataFrame) -> DataFrame:
    """df with lead_score, lead_tier and score_breakdown."""
    c = F.col
    n = lambda x: F.coalesce(c(x).try_cast("int"), F.lit(0))
    filled = lambda x: F.coalesce(null_if_sentinel(c(x)), F.lit("")) != ""
    flag = lambda x: F.coalesce(c(x), F.lit(False))
    email, phone = filled("primary_email"), filled("phones")
    signs = [
        ("active_fb_ads", 3, n("ad_count") > 0), ("multiple_creatives", 2, n("ad_count") >= 3), ("reviews_30+", 2, n("gmaps_review_count") >= 30), ("reviews_100+", 1, n("gmaps_review_count") >= 100),
        ("has_crm", 2, flag("has_crm")), ("has_pixel", 1, flag("has_marketing_pixel")), ("has_scheduling", 1, flag("has_scheduling_tool")), ("has_chat", 1, flag("has_chat_widget")),
        ("decision_maker", 2, contains_any(F.lower(F.coalesce("contact_position", F.lit(""))), P.DECISION_MAKERS)), ("email+phone", 2, email & phone), ("email_only", 1, email & ~phone),
        ("has_instagram", 1, filled("instagram_handles")), ("good_rating", 1, F.coalesce(c("gmaps_rating").try_cast("double"), F.lit(0.0)) >= 4.0),
    ]
    score = sum((F.when(hit, points).otherwise(0) for _, points, hit in signs), F.lit(0))
    told = F.array_join(F.array_compact(F.array(*(F.when(hit, F.lit(f"{name}:+{points}")) for name, points, hit in signs))), "|")
    df = df.withColumns({"lead_score": score, "score_breakdown": F.when(told == "", "no_signals").otherwise(told)})
    return df.withColumn("lead_tier", F.when(c("lead_score") >= 12, "HOT").when(c("lead_score") >= 8, "WARM").when(c("lead_score") >= 5, "COOL").otherwise("COLD"))


def tier_summary(df: DataFrame) -> DataFrame:
    """lead_tier, n, avg, least and most of scores."""
    s = F.col("lead_score")
    return df.groupBy("lead_tier").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(s), 2).alias("avg_score"), F.min(s).alias("min_score"), F.max(s).alias("max_score"))


def agents(sales: DataFrame) -> DataFrame:
    """agent_id, first filled contact cells, sales, volume, mean, median, largest and smallest price, cities: of sales (agent_id, name, email, price, city, ord)."""
    first = lambda c: F.min_by(c, F.when(F.col(c).isNotNull(), F.col("ord"))).alias(c)
    p = F.col("price")
    return sales.filter("agent_id is not null").groupBy("agent_id").agg(
        first("name"), first("email"), F.count(F.lit(1)).alias("sales"), F.sum(p).alias("volume"), F.avg(p).alias("avg_price"), F.median(p).alias("median_price"),
        F.max(p).alias("max_price"), F.min(p).alias("min_price"), F.count_distinct("city").alias("cities"),
    )


def entry_path(df: DataFrame) -> DataFrame:
    """df with entry_score, recommended path type and details."""
    c = F.col
    filled = lambda x: F.coalesce(null_if_sentinel(c(x)), F.lit("")) != ""
    yes = lambda x: F.lower(F.coalesce(c(x).cast("string"), F.lit(""))) == "true"
    mutual = F.coalesce(c("mutual_count"), F.lit(0))
    linkedin, email, insta, ads = filled("linkedin_profile"), F.coalesce(F.contains(c("email"), F.lit("@")), F.lit(False)), filled("instagram_handle"), yes("has_meta_ads")
    pixel, big, idx = yes("has_marketing_pixel"), F.coalesce(c("sold_volume") > 50_000_000, F.lit(False)), yes("has_idx")
    points = [(linkedin, 15), (email, 10), (ads, 10), (pixel, 5), (insta, 8), (big, 5), (idx, 2)]
    score = F.when(mutual > 0, 40 + 5 * F.least(mutual, F.lit(5))).otherwise(0) + sum((F.when(k, v).otherwise(0) for k, v in points), F.lit(0))
    kind = F.when(mutual > 0, "warm_intro").when(linkedin, "linkedin").when(insta, "instagram").when(email, "email").when(ads, "facebook").otherwise("research")
    told = [(mutual > 0, F.concat(mutual.cast("string"), F.lit(" mutual(s)"))), (linkedin, F.lit("LinkedIn")), (email, F.lit("email")), (ads, F.lit("Meta ads")), (pixel, F.lit("tracking pixel")), (insta, F.lit("Instagram")), (big, F.lit("high volume"))]
    details = F.array_join(F.array_compact(F.array(*(F.when(k, v) for k, v in told))), ", ")
    return df.withColumns({"entry_score": score.cast("int"), "path_type": kind, "path_details": F.when(details == "", "limited data").otherwise(details)})


def coverage(df: DataFrame, columns: list[str]) -> DataFrame:
    """field, filled, pct, status (LOW below 30): one pass over all columns."""
    one = df.agg(F.count(F.lit(1)).alias("_n"), *(F.count_if(F.coalesce(null_if_sentinel(F.col(c).cast("string")), F.lit("")) != "").alias(c) for c in columns))
    rows = one.select("_n", F.explode(F.array(*(F.struct(F.lit(c).alias("field"), F.col(c).alias("filled")) for c in columns))).alias("x")).select("x.field", "x.filled", "_n")
    pct = F.when(F.col("_n") > 0, F.round(F.col("filled") * 100.0 / F.col("_n"), 1)).otherwise(F.lit(0.0))
    return rows.select("field", "filled", pct.alias("pct"), F.when(pct < 30, "LOW").otherwise("OK").alias("status"))


def field_changes(before: DataFrame, after: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """field, found, preserved, added: cells of after by what before had under the same key."""
    b = before.select(key, *(F.col(c).alias(f"_{c}") for c in columns))
    met = after.select(key, *columns).join(b, key, "left")
    has = lambda c: F.coalesce(null_if_sentinel(F.col(c).cast("string")), F.lit("")) != ""
    one = met.agg(*(F.struct(F.lit(c).alias("field"), F.count_if(has(c)).alias("found"), F.count_if(has(c) & has(f"_{c}")).alias("preserved"), F.count_if(has(c) & ~has(f"_{c}")).alias("added")).alias(c) for c in columns))
    return one.select(F.explode(F.array(*columns)).alias("x")).select("x.*")


def audit_sample(df: DataFrame, key: str, n: int, seed: int = 5) -> DataFrame:
    """n rows at random, the same ones for the same seed: a sampling operator."""
    return df.orderBy(F.xxhash64(F.lit(seed), key), key).limit(n)
