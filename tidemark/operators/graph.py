"""The contact graph of a mail log: edges, strengths, introductions, paths. Set at a time: joins for all people at once.

mails has message_id, sender, to (array), cc (array), sent (timestamp), subject and in_reply_to.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import days_between
from .components import moved_edges


def knows(mails: DataFrame) -> DataFrame:
    """src, dst, n, first, last, last_subject: from senders to each of their recipients but themselves."""
    to = F.explode(F.array_distinct(F.array_union("to", F.coalesce("cc", F.array().cast("array<string>")))))
    rows = mails.select(F.col("sender").alias("src"), to.alias("dst"), "sent", "message_id", "subject").filter("src <> dst")
    return rows.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"), F.min("sent").alias("first"), F.max("sent").alias("last"), F.max_by("subject", F.struct("sent", "message_id")).alias("last_subject"))


def _pairs(people: Column) -> Column:
    """Unordered pairs of an array of distinct people, within a row."""
    p = F.array_sort(people)
    return F.flatten(F.transform(p, lambda a, i: F.transform(F.slice(p, i + 2, F.greatest(F.size(p) - i - 1, F.lit(0))), lambda b: F.struct(a.alias("a"), b.alias("b")))))


def together(mails: DataFrame, with_sender: bool = False) -> DataFrame:
    """a, b, n, first, last of unordered pairs of people on one mail, with its sender or without."""
    people = F.array_union("to", F.coalesce("cc", F.array().cast("array<string>")))
    people = F.array_union(people, F.array("sender")) if with_sender else F.array_distinct(people)
    rows = mails.select(F.explode(_pairs(people)).alias("p"), "sent").select("p.a", "p.b", "sent")
    return rows.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"), F.min("sent").alias("first"), F.max("sent").alias("last"))


def contact_stats(mails: DataFrame, mine: list[str]) -> DataFrame:
    """contact, sent, received, recipients of either kind, replies, first, last: mail from and to my addresses."""
    own = F.col("sender").isin(mine)
    size = F.size("to") + F.size(F.coalesce("cc", F.array().cast("array<string>")))
    out = mails.filter(own).select(F.explode(F.array_distinct("to")).alias("contact"), F.lit(1).alias("s"), F.lit(0).alias("r"), size.alias("k"), "sent")
    got = mails.filter(~own & F.exists("to", lambda t: t.isin(mine))).select(F.col("sender").alias("contact"), F.lit(0).alias("s"), F.lit(1).alias("r"), size.alias("k"), "sent")
    both = out.union(got).filter(~F.col("contact").isin(mine))
    return both.groupBy("contact").agg(
        F.sum("s").alias("sent"), F.sum("r").alias("received"), F.sum(F.when(F.col("s") == 1, F.col("k")).otherwise(0)).alias("recipients_sent"),
        F.sum(F.when(F.col("r") == 1, F.col("k")).otherwise(0)).alias("recipients_received"), F.min("sent").alias("first"), F.max("sent").alias("last"),
    )


def replies(mails: DataFrame, mine: list[str]) -> DataFrame:
    """contact, replies: mail that answers one of my messages, sent before it."""
    own = mails.filter(F.col("sender").isin(mine)).select(F.col("message_id").alias("_m"), F.col("sent").alias("_s"))
    got = mails.filter(~F.col("sender").isin(mine) & F.col("in_reply_to").isNotNull())
    met = got.join(own, (F.col("in_reply_to") == F.col("_m")) & (F.col("_s") < F.col("sent")), "left_semi")
    return met.groupBy(F.col("sender").alias("contact")).agg(F.count(F.lit(1)).alias("replies"))


def bidirectional(edges: DataFrame) -> DataFrame:
    """edges (src, dst ...) with bidirectional: whether the reverse edge exists."""
    back = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), F.lit(True).alias("bidirectional")).distinct()
    return edges.join(back, ["src", "dst"], "left").na.fill({"bidirectional": False})


def strength_v0(n: Column, days: Column) -> Column:
    """1 to 10 of a number of mails and the days since the last; 0 without any."""
    base = F.when(n <= 5, F.least(F.lit(2), n)).when(n <= 20, 3 + F.floor((n - 5) / 8)).when(n <= 50, 5 + F.floor((n - 20) / 15)).otherwise(7)
    fresh = F.when(days <= 30, 3).when(days <= 90, 2).when(days <= 180, 1).otherwise(0)
    return F.when(n == 0, 0).otherwise(F.least(F.lit(10), base + fresh)).cast("int")


def strength_pairs(n: Column, days: Column, span: Column) -> Column:
    """1 to 10 of a number of mails, the days since the last, and those from the first to the last."""
    often = F.when(n <= 5, 1).when(n <= 15, 2).when(n <= 30, 3).otherwise(4)
    fresh = F.when(days <= 7, 4).when(days <= 30, 3).when(days <= 90, 2).when(days <= 180, 1).otherwise(0)
    return F.greatest(F.lit(1), F.least(F.lit(10), often + fresh + F.when(span >= 365, 2).when(span >= 180, 1).otherwise(0))).cast("int")


def strength_v1(n: Column, days: Column, both: Column) -> Column:
    """0 to 100: mails up to 40, freshness up to 30, both ways 30; no date counts as a year."""
    d = F.coalesce(days, F.lit(365))
    return (F.least(n * 5, F.lit(40)) + F.greatest(F.lit(0.0), 30 - d / 30) + F.when(both, 30).otherwise(0)).cast("int")


def strength_v2(sent: Column, received: Column, avg_sent: Column, avg_received: Column, days: Column, reply_rate: Column) -> Column:
    """0 to 100: volume, recency, balance, replies; less for wide circles and for newsletters."""
    total = sent + received
    volume = F.when(total > 0, F.least(F.lit(35.0), 5 + 10 * F.log10(total + 1))).otherwise(0.0)
    recency = F.coalesce(25 * F.exp(-days / 365), F.lit(0.0))
    balance = F.when((sent > 0) & (received > 0), 25 * F.least(sent, received) / F.greatest(sent, received)).when(total > 0, 5.0).otherwise(0.0)
    circle = (avg_sent + avg_received) / 2
    group = F.when(circle > 20, 0.5).when(circle > 10, 0.7).when(circle > 5, 0.85).otherwise(1.0)
    news = F.when((received >= 3) & (sent >= 2) & (reply_rate == 0), 0.7).when((received >= 5) & (sent == 0), 0.5).otherwise(1.0)
    return F.greatest(F.lit(0), F.least(F.lit(100), ((volume + recency + balance + 15 * reply_rate) * group * news).cast("int")))


def scored_contacts(mails: DataFrame, mine: list[str], as_of: str) -> DataFrame:
    """contact_stats with replies, reply_rate, days and strength (v2)."""
    df = contact_stats(mails, mine).join(replies(mails, mine), "contact", "left").na.fill({"replies": 0})
    c = F.col
    mean = lambda a, b: F.when(c(b) > 0, c(a) / c(b)).otherwise(F.lit(0.0))
    df = df.withColumns({"reply_rate": F.least(F.lit(1.0), mean("replies", "sent")), "days": days_between(F.lit(as_of).cast("timestamp"), c("last"))})
    return df.withColumn("strength", strength_v2(c("sent"), c("received"), mean("recipients_sent", "sent"), mean("recipients_received", "received"), c("days"), c("reply_rate")))


def introductions(mails: DataFrame) -> DataFrame:
    """message_id, introducer, introduced, introduced_to, sent: a pair of a cc and a to address that no earlier mail has."""
    pair = F.explode(F.flatten(F.transform(F.coalesce("cc", F.array().cast("array<string>")), lambda c: F.transform("to", lambda t: F.struct(c.alias("cc"), t.alias("to"))))))
    rows = mails.select("message_id", "sender", "sent", pair.alias("p")).select("message_id", "sender", "sent", "p.cc", "p.to").filter("cc <> to")
    order = F.row_number().over(Window.partitionBy(F.least("cc", "to"), F.greatest("cc", "to")).orderBy("sent", "message_id", "cc"))
    return rows.withColumn("_r", order).filter("_r = 1").select("message_id", F.col("sender").alias("introducer"), F.col("cc").alias("introduced"), F.col("to").alias("introduced_to"), "sent")


def direct(edges: DataFrame, me: str, targets: DataFrame) -> DataFrame:
    """target, path_type, connector, mails, reach: edges from me to targets(target)."""
    met = edges.filter(F.col("src") == me).join(targets, F.col("dst") == F.col("target"))
    return met.select("target", F.lit("direct").alias("path_type"), F.lit(None).cast("string").alias("connector"), "n", F.lit(0).cast("long").alias("reach"))


def one_hop(edges: DataFrame, me: str, targets: DataFrame) -> DataFrame:
    """me to a connector to a target: all of them, with the mails to the connector (n) and on to the target (reach)."""
    near = edges.filter((F.col("src") == me) & (F.col("dst") != me)).select(F.col("dst").alias("connector"), "n")
    far = edges.select(F.col("src").alias("connector"), F.col("dst").alias("target"), F.col("n").alias("reach")).join(targets, "target")
    met = near.join(far, "connector").filter((F.col("connector") != F.col("target")) & (F.col("target") != me))
    return met.select("target", F.lit("one_hop").alias("path_type"), "connector", "n", "reach")


def by_company(edges: DataFrame, me: str, targets: DataFrame) -> DataFrame:
    """The person I mail most at a target's domain, other than the target.

    Two of a domain are enough for that, so a domain that thousands share meets its targets with two rows.
    """
    domain = lambda c: F.substring_index(c, "@", -1)
    near = edges.filter(F.col("src") == me).select(F.col("dst").alias("connector"), "n", domain("dst").alias("_d"))
    near = near.withColumn("_r", F.row_number().over(Window.partitionBy("_d").orderBy(F.desc("n"), "connector"))).filter("_r <= 2")
    met = targets.withColumn("_d", domain("target")).join(near, "_d").filter(F.col("connector") != F.col("target"))
    return met.select("target", F.lit("company_connection").alias("path_type"), "connector", "n", F.lit(0).cast("long").alias("reach"))


def by_cc(edges: DataFrame, cc: DataFrame, me: str, targets: DataFrame) -> DataFrame:
    """A person I know who stood on mails together with a target."""
    near = edges.filter((F.col("src") == me) & (F.col("dst") != me)).select(F.col("dst").alias("connector"), "n")
    both = cc.select(F.col("a").alias("connector"), F.col("b").alias("target"), F.col("n").alias("reach")).union(cc.select("b", "a", "n"))
    met = near.join(both.join(targets, "target"), "connector").filter((F.col("connector") != F.col("target")) & (F.col("target") != me))
    return met.select("target", F.lit("cc_together").alias("path_type"), "connector", "n", "reach")


def path_strength(kind: Column, n: Column, connector_strength: Column) -> Column:
    """0 to 100 of a path's kind, my mails to a target I know, or my strength with the connector."""
    part = F.when(kind == "one_hop", 0.6).when(kind == "company_connection", 0.4).when(kind == "cc_together", 0.3).otherwise(0.0)
    return F.when(kind == "direct", F.least(F.lit(50), n) * 2).otherwise((connector_strength * 10 * part).cast("int")).cast("int")


def best_paths(edges: DataFrame, cc: DataFrame, me: str, targets: DataFrame, as_of: str, order: tuple[str, ...] = ("direct", "one_hop", "company_connection", "cc_together")) -> DataFrame:
    """target, path_type, connector, n, reach, path_strength: the first kind of path in order that exists, else cold; a row a target."""
    found = direct(edges, me, targets).union(one_hop(edges, me, targets)).union(by_company(edges, me, targets)).union(by_cc(edges, cc, me, targets))
    rank = F.array_position(F.array(*map(F.lit, order)), F.col("path_type"))
    first = F.row_number().over(Window.partitionBy("target").orderBy(rank, F.desc("n"), F.desc("reach"), "connector"))
    best = found.withColumn("_r", first).filter("_r = 1").drop("_r")
    own = edges.filter(F.col("src") == me).select(F.col("dst").alias("connector"), strength_v0(F.col("n"), days_between(F.lit(as_of).cast("timestamp"), F.col("last"))).alias("_s"))
    out = targets.select("target").distinct().join(best, "target", "left").join(own, "connector", "left").na.fill({"path_type": "cold"})
    return out.select("target", "path_type", "connector", "n", "reach", F.coalesce(path_strength(F.col("path_type"), F.col("n"), F.coalesce("_s", F.lit(0))), F.lit(0)).alias("path_strength"))


def tiers(stats: DataFrame, internal: list[str], automated: list[str], target_words: list[str]) -> DataFrame:
    """contact, tier, total of contacts worth work: tier 1 targets that replied, 2 with three mails or more, 3 that replied."""
    domain = F.substring_index("contact", "@", -1)
    replied, total = F.col("replies") > 0, F.col("sent") + F.col("received")
    is_target = F.lower("contact").rlike("|".join(target_words))
    tier = F.when(is_target & replied, 1).when(total >= 3, 2).when(replied, 3)
    kept = stats.filter(~domain.isin(internal) & ~F.lower("contact").rlike("|".join(automated)) & F.contains("contact", F.lit("@")))
    return kept.select("contact", tier.alias("tier"), total.alias("total")).filter("tier is not null")


def latest_mails(mails: DataFrame, k: int = 3) -> DataFrame:
    """contact, message_id, place: the k latest mails from or to each contact."""
    rows = mails.select(F.explode(F.array_distinct(F.array_union(F.array("sender"), F.col("to")))).alias("contact"), "message_id", "sent")
    return rows.withColumn("place", F.row_number().over(Window.partitionBy("contact").orderBy(F.desc("sent"), "message_id"))).filter(F.col("place") <= k).select("contact", "message_id", "place")


def merge_people(edges: DataFrame, same: DataFrame) -> DataFrame:
    """edges after people of same(old, new) became one, chains followed: both ends renamed, loops dropped, parallel edges summed."""
    return moved_edges(edges, same).groupBy("src", "dst").agg(F.sum("n").alias("n"), F.min("first").alias("first"), F.max("last").alias("last"))


def _grams(c: Column, most: int) -> Column:
    """All substrings of 1 to `most` characters."""
    return F.array_distinct(F.flatten(F.transform(F.sequence(F.lit(1), F.length(c)), lambda i: F.transform(F.sequence(F.lit(1), F.least(F.lit(most), F.length(c) - i + 1)), lambda n: F.substr(c, i, n)))))


def _only(df: DataFrame) -> DataFrame:
    """node, match of nodes with one match alone; repeated pairs are one."""
    return df.groupBy("node").agg(F.min("match").alias("match"), F.max("match").alias("_last")).filter(F.col("match") == F.col("_last")).select("node", "match")


def identity(synthetic: DataFrame, real: DataFrame, block: int = 5) -> DataFrame:
    """node, match, tier of people without an address: tier 1 where one real person has the name, tier 2 where of several one works where they do.

    Both sides have node, name and company; a real person has a row for each company. Names are compared in normal form;
    a company is the same if it contains the other's in lower case. Names are counted before anything is joined: those of
    one real person meet it alone; for the others, people meet on the name and the beginning of the one's company, which the
    other's has somewhere, so that a name of thousands on both sides makes no pairs of different companies.
    """
    names = real.filter("name IS NOT NULL AND trim(name) <> ''").groupBy("name").agg(F.min("node").alias("match"), F.max("node").alias("_last"))
    alone = F.col("match") == F.col("_last")
    first = synthetic.select("node", "name").join(names.filter(alone).select("name", "match"), "name").select("node", "match", F.lit(1).alias("tier"))
    several = names.filter(~alone).select("name")
    side = lambda df, node: df.select(F.col("node").alias(node), "name", F.lower(F.trim("company")).alias(f"{node}_c")).filter(f"{node}_c <> ''").join(several, "name", "left_semi")
    asked, there = side(synthetic, "node"), side(real, "match")

    def within(short: DataFrame, s: str, long: DataFrame, at: str) -> DataFrame:
        met = short.withColumn("_key", F.substring(s, 1, block)).join(long.withColumn("_key", F.explode(_grams(F.col(at), block))), ["name", "_key"])
        return met.filter(F.contains(at, F.col(s))).select("node", "match")

    second = _only(within(asked, "node_c", there, "match_c").union(within(there, "match_c", asked, "node_c")))
    return first.unionByName(second.withColumn("tier", F.lit(2)))
