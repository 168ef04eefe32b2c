"""Queries of contacts: names, pages, handles, bounces, advertisers, work that is left, runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import components as CC
from ..operators import contacts as C
from ..sources import io
from ..sources.shared import folder as _folder
from .proxies import _pick, _sql_pick, read

PAGE_NAMES = ["John Smith, Realtor", "Ann O'hara - Lake Homes", "mark stone Realty", "The Jane Doe Team", "Claudia Sanchez Texas Realtor", "Thomas Upton Compass Real Estate", "Acme Corp", "River Bank, Inc", "Best Homes - Miami", "Maria Lopez/Broker", "Peter Pan", None]
FROM_PAGES = ["John Smith", "Ann O'hara", "mark stone", "Jane Doe", "Claudia Sanchez", "Thomas Upton", "Acme Corp", None, None, "Maria Lopez", "Peter Pan", None]
HANDLES = ["@dexter.brandao", "@mary_couser", "realtor.jo", "@al", "@a1b", None, "@JOHN_smith"]
FROM_HANDLES = ["Dexter", "Mary", None, None, None, None, "John"]
TEAMS = ["[{'name': 'Team'}, {'name': 'Ann Lee'}]", '[{"name": "Bob Ray"}]', "[]", None, "no list"]
FROM_TEAMS = ["Ann Lee", "Bob Ray", None, None, None]
BODIES = [
    "Your message to bob@y.example couldn't be delivered.", "Final-Recipient: rfc822; Zoe@X.example", "Address not found\nYour message wasn't delivered to <amy@z.example> because", "nothing here", None,
    "Delivery has failed to these recipients or groups:\n<tom@q.example>", "from <mailer-daemon@h.example>", "undeliverable to: <kim@own.example> or see <lea@w.example>",
]
BOUNCED = ["bob@y.example", "zoe@x.example", "amy@z.example", None, None, "tom@q.example", None, "lea@w.example"]
FINDS = ["We are hiring 5 new agents! Join our team", "Just closed my 100th deal, $12M in sales", "Top 1% and #3 team", "plain", None]
FOUND = ["hiring: hiring 5 new agents|hiring: join our team|hiring: we are hiring", "achievement: just closed my 100th deal|achievement: $12m in sales", "achievement: top 1%|achievement: #3 team", "", ""]
PAGES = [
    '<script type="application/ld+json">{"@type": "Person", "name": "Ann Lee", "jobTitle": "Broker"}</script><div class="team-card"><h3>Bob Ray</h3></div>',
    '<div class="agent card"><h3 class="name">Cyd Moss</h3><p class="role">Senior Agent</p><a href="https://instagram.com/Cyd.Moss">x</a></div><li class="agent"><h4>Contact Us</h4></li>',
    "<body><p>Dan Fox, Owner of this place</p></body>", "<body>Realtor: Eve Hill</body>", "<body>nobody</body>", None,
    '<section class="staff"><strong>Fay Gray</strong><span>Office Manager</span></section><section class="staff"><span>Home</span></section>',
]
PEOPLE = [("Ann Lee", "Broker"), ("Cyd Moss", "Senior Agent"), ("Dan Fox", "Owner"), ("Eve Hill", "Realtor"), ("", ""), ("", ""), ("", "")]
TEAM_OF = ["Bob Ray//", "Cyd Moss/Senior Agent/@cyd.moss|Contact Us//", "", "", "", "", "Fay Gray/Office Manager/"]


def contact_names(spark, d):
    k = F.col("c_custkey")
    return read(spark, d, "customer").select(k, C.name_from_page(_pick(PAGE_NAMES, k % 12)).alias("page"), C.name_from_handle(_pick(HANDLES, k % 7)).alias("handle"), C.first_member(_pick(TEAMS, k % 5)).alias("team"))


def contact_bounces(spark, d):
    k = F.col("c_custkey")
    header = F.when(k % 11 == 0, "x@header.example, y@b.example")
    status = F.when(k % 13 == 0, "Action: failed\nFinal-Recipient: rfc822;s@status.example")
    return read(spark, d, "customer").select(k, C.bounced_address(header, status, _pick(BODIES, k % 8), ["own.example"]).alias("bounced"))


def contact_findings(spark, d):
    return read(spark, d, "customer").select("c_custkey", F.array_join(C.findings(_pick(FINDS, F.col("c_custkey") % 5)), "|").alias("findings"))


def contact_people(spark, d):
    k = F.col("c_custkey")
    person, team = C.contact_person(_pick(PAGES, k % 7)), C.team_members(_pick(PAGES, k % 7))
    return read(spark, d, "customer").select(k, F.coalesce(person["name"], F.lit("")).alias("name"), F.coalesce(person["position"], F.lit("")).alias("position"), F.array_join(F.transform(team, lambda m: F.concat_ws("/", m["name"], m["position"], m["instagram"])), "|").alias("team"))


def contact_page_sets(spark, d):
    k = F.col("c_custkey")
    html = F.concat(F.lit("<p>mail e"), k % 23, F.lit("@s"), k % 3, F.lit(".org or (555) 010-"), F.lpad((k % 17).cast("string"), 4, "0"), F.lit('</p><a href="https://instagram.com/shop'), k % 29, F.lit('">i</a>'), F.when(k % 4 == 3, F.concat(F.lit('<meta name="description" content="about '), k, F.lit('">'))).otherwise(""), F.when(k % 5 == 2, F.concat(F.lit('<div class="team"><h3>'), _pick(["Ann Lee", "Bob Ray", "Cyd Moss"], k % 3), F.lit("</h3></div>"))).otherwise(""))
    pages = read(spark, d, "customer").select((k % 50).alias("site"), k.alias("ord"), html.alias("html"))
    out = C.page_sets(pages, "site", "ord")
    return out.select("site", "contact_name", "contact_position", "description", *(F.array_join(c, ",").alias(c) for c in ("emails", "phones", "instagram_handles", "team")))


def contact_technologies(spark, d):
    k = F.col("c_custkey")
    found = F.array_compact(F.array(F.when(k % 2 == 0, F.lit("crm:hubspot")), F.when(k % 3 == 0, F.lit("crm:zoho")), F.when(k % 5 == 0, F.lit("pixel:meta")), F.when(k % 7 == 0, F.lit("pixel:google")), F.when(k % 11 == 0, F.lit("form:jotform"))))
    return read(spark, d, "customer").select(k, C.technology_summary(found, k % 13 == 0).alias("x")).select("c_custkey", "x.*")


def _raw_ads(spark, d):
    k, p = F.col("o_orderkey"), F.col("o_custkey")
    return read(spark, d, "orders").select(
        p.alias("page_id"), k.alias("ord"), F.concat(F.lit("Page "), p).alias("page_name"), F.array(_pick(["FB", "IG", "MS"], k % 3), F.lit("FB")).alias("platforms"), F.array(_pick(["US", "CO"], k % 2)).alias("countries"), (k % 4 == 0).alias("active"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("start"),
        F.when(k % 3 > 0, k % 100).alias("spend_low"), F.when(k % 3 > 1, k % 100 + 50).alias("spend_high"), F.when(k % 5 == 1, "USD").alias("currency"), F.when(k % 2 == 0, k % 1000).alias("reach_high"),
        C.ad_text(F.when(k % 4 == 0, F.concat(F.lit(" body "), k % 6)), F.when(k % 4 == 1, F.array(F.lit("c1"), F.lit(""), F.concat(F.lit("c"), k % 5), F.lit("late"))), F.when(k % 4 == 2, "title"), F.when(k % 8 == 3, "legacy")).alias("text"))


def contact_ad_texts(spark, d):
    return _raw_ads(spark, d).groupBy("text").agg(F.count(F.lit(1)).alias("n"))


def contact_advertisers(spark, d):
    return C.advertisers(_raw_ads(spark, d), "ord").withColumns({c: F.array_join(c, ",") for c in ("platforms", "countries")})


def contact_handles(spark, d):
    k = F.col("c_custkey")
    personal = _pick([" AnnLee ", "@ab", "none", None, "@gmail"], k % 5)
    company = F.concat(F.lit("['shop"), k % 9, F.lit("', '@annlee', '9bad']"))
    owner = C.handle_owner(_pick(["@annleehomes", "@acmerealty", "@zz", "@other"], k % 4), F.lit("Ann Lee"), F.lit("Acme-Realty"))
    return read(spark, d, "customer").select(k, F.array_join(C.handles_of(personal, company), ",").alias("handles"), owner["personal"].alias("personal"), owner["company"].alias("company"), owner["confidence"].alias("confidence"))


def contact_handle_sources(spark, d):
    k = F.col("c_custkey")
    found = read(spark, d, "customer").select((k % 200).alias("key"), (k % 4).alias("rank"), F.concat(F.lit("source"), k % 4).alias("source"), F.when(k % 4 == 0, "x").otherwise(F.concat(F.lit("@Ha"), k % 90)).alias("handle"))
    return C.handle_waterfall(found, "key").withColumn("handles", F.array_join("handles", ","))


def _alternates(spark, d):
    """People whose addresses, others and new ones are written in several cases of letters."""
    k = F.col("c_custkey")
    at = lambda a, upper: F.when(upper, F.concat(F.lit(a.upper()), k, F.lit("@X.example"))).otherwise(F.concat(F.lit(a), k, F.lit("@x.example")))
    new = F.when(k % 2 == 0, F.concat(F.lit(" "), at("b", F.lit(True)))).when(k % 3 == 0, at("a", F.lit(True))).otherwise(at("p", k % 4 == 1))
    return read(spark, d, "customer").select(k, at("p", k % 2 == 0).alias("email"), F.array(at("a", k % 5 == 0)).alias("others"), new.alias("new"))


def contact_alternates(spark, d):
    k = F.col("c_custkey")
    people = _alternates(spark, d).withColumn("alternates", C.with_alternate(F.col("email"), F.col("others"), F.col("new")))
    asked = F.concat(_pick(["p", "a", "b", "z"], k % 4), k - k % 3, F.lit("@x.example"))
    asked = read(spark, d, "customer").select(F.when(k % 5 == 0, F.upper(asked)).otherwise(asked).alias("email"))
    return C.by_any_address(people, asked)


def contact_with_alternate(spark, d):
    return _alternates(spark, d).select("c_custkey", F.array_join(C.with_alternate(F.col("email"), F.col("others"), F.col("new")), ",").alias("alternates"))


def contact_domain_matches(spark, d):
    k = F.col("c_custkey")
    real = read(spark, d, "customer").select(k.alias("node"), F.concat(F.lit("Ann  Lee"), k % 400, F.when(k % 2 == 0, ", PhD").otherwise("")).alias("name"), F.concat(F.lit("e@"), F.when(k % 10 == 0, "gmail").otherwise(F.concat(F.lit("corp"), k % 7)), F.lit(".com")).alias("email"))
    synthetic = read(spark, d, "customer").select(k.alias("node"), F.concat(F.lit("ann lee"), k % 400).alias("name"), F.when(k % 9 == 0, "co").otherwise(F.concat(F.lit(" Corp"), k % 7)).alias("company"))
    return C.by_domain(synthetic, real, ["phd"])


def contact_first_tier(spark, d):
    k = F.col("c_custkey")
    return C.first_tier(read(spark, d, "customer").select((k % 100).alias("node"), k.alias("match"), (k * 7 % 3 + 1).alias("tier")))


def _rows(spark, d):
    k = F.col("c_custkey")
    return read(spark, d, "customer").select(
        k.alias("ord"), F.when(k % 3 == 0, F.concat(F.lit("e"), k % 300, F.lit("@x.example"))).when(k % 3 == 1, "bad").alias("primary_email"), (k % 4 == 0).alias("email_verified"), F.when(k % 5 > 0, F.concat(F.lit("https://s"), k)).otherwise("").alias("website_url"),
        (k % 10 / 10).alias("search_confidence"), _pick(["n/a", "Ann Lee", "", None], k % 4).alias("contact_name"), _pick(["sent", "failed", None], k % 3).alias("status"), _pick(["dm", "mail"], k % 2).alias("method"))


def contact_needing(spark, d):
    r = _rows(spark, d)
    return C.needing(r, "contact_name").select(F.lit("name").alias("step"), "ord").union(C.contacts_to_enrich(r).select(F.lit("email"), "ord")).union(C.needing(r, "absent").select(F.lit("absent"), "ord"))


def contact_prospects(spark, d):
    r, k = _rows(spark, d), F.col("c_custkey")
    gone = [read(spark, d, "customer").filter(k % m == 0).select(F.concat(F.lit(" E"), k % 300, F.lit("@x.example")).alias("address")) for m in (7, 31)]
    return C.prospects(r, gone, most=50).select("ord", "primary_email")


def contact_profiles(spark, d):
    k = F.col("c_custkey")
    rows = read(spark, d, "customer").select(k, F.when(k % 3 == 0, F.concat(F.lit("https://www.LinkedIn.com/in/p"), k)).when(k % 3 == 1, F.concat(F.lit("e"), k, F.lit("@x.example"))).alias("email"))
    return C.with_profile_column(rows)


def contact_appended(spark, d):
    k = F.col("c_custkey")
    rows = read(spark, d, "customer").select(k, F.when(k % 5 == 0, "old").alias("rating"), F.when(k % 7 > 0, F.concat(F.lit("site"), k)).alias("site"))
    return C.appended(rows, read(spark, d, "customer").filter(k % 2 == 0).select(k, F.concat(F.lit("r"), k).alias("rating"), (k % 9).alias("reviews")), "c_custkey", ["rating", "reviews"], "site").withColumn("reviews", F.col("reviews").cast("long"))


def contact_trial_run(spark, d):
    return C.first_n(_rows(spark, d).select("ord", "website_url"), ["ord"], 100, "website_url")


def contact_statuses(spark, d):
    return C.statuses(_rows(spark, d), "status", "method")


def contact_graph_status(spark, d):
    k = F.col("c_custkey")
    people = read(spark, d, "customer").select(F.when(k % 3 > 0, "n").alias("name"), F.when(k % 4 > 0, "c").otherwise("").alias("company"), F.when(k % 6 > 0, F.concat(F.lit("country"), F.col("c_nationkey"))).alias("country"))
    return C.graph_status(people, read(spark, d, "customer").select((k * 7 % 101).alias("v1"), (k * 3 % 101).alias("v2")))


def contact_drafts(spark, d):
    """Drafts with the prospect of their page, the first by order."""
    from ..operators.joins import lookup
    from ..operators.master import keep_first

    k = F.col("c_custkey")
    drafts = read(spark, d, "customer").select(k.alias("draft_id"), F.concat(F.lit("page"), k % 900).alias("page_name"))
    people = keep_first(read(spark, d, "customer").select(F.concat(F.lit("page"), k % 700).alias("page_name"), k.alias("prospect")), ["page_name"], "prospect")
    return lookup(drafts, people, "page_name")


def contact_mapped(spark, d):
    k = F.col("c_custkey")
    raw = read(spark, d, "customer").select(
        k.alias("id"), F.concat(F.lit(" Acme \U0001f600"), F.lit("ª"), k, F.lit(" ")).alias("Company"), _pick(["['a', 'b']", "x; y", "n/a"], k % 3).alias("tags"), _pick(["12.7", "many", None], k % 3).alias("ads"), _pick(["TRUE", "no", None], k % 3).alias("live"),
        _pick(["2024-05-06", "2024-05-06T07:08:09", "soon"], k % 3).alias("since"), F.when(k % 2 == 0, "555").alias("tel"), F.when(k % 5 > 0, " 777 ").otherwise(" ").alias("mobile"))
    out = C.mapped(raw, {"id": "id", "page_name": "Company", "platforms": "tags", "ad_count": "ads", "is_active": "live", "first_ad_date": "since", "lost": "nowhere"}, ["tel", "mobile"], ("platforms",), ("ad_count",), ("is_active",), ("first_ad_date",))
    return out.withColumns({c: F.array_join(c, "|") for c in ("platforms", "phones")})


def contact_profile(spark, d):
    return C.profile(_rows(spark, d))


def contact_runs(spark, d):
    k = F.col("event_id")
    return C.run_log(read(spark, d, "events").select((k % 20).alias("run_id"), F.col("ts").alias("at"), (k % 300).alias("item"), _pick(["done", "failed", "done"], k % 3).alias("status")))


def contact_versions(spark, d):
    """Two runs, the first of them twice; the newest run's rows; and batches of a long job, one of them repeated."""
    runs, batches, records = _folder(spark, "runs"), _folder(spark, "batches"), _folder(spark, "records")
    rows = read(spark, d, "customer").select("c_custkey", "c_nationkey")
    for run, part in (("20240101_a", rows), ("20240101_a", rows.filter("c_custkey % 2 = 0")), ("20240202_b", rows.filter("c_custkey % 3 = 0"))):
        io.save_version(part, runs, run)
    latest = io.latest_version(spark, runs)
    for batch, part in ((0, "c_custkey % 5 = 0"), (1, "c_custkey % 5 = 1"), (0, "c_custkey % 5 = 2")):
        io.save_batch(latest.filter(part), batches, batch)
    io.save_json(io.saved_batches(spark, batches).select("c_custkey", "batch", F.when(F.col("c_nationkey") > 5, F.col("c_nationkey")).alias("nation")), records)
    return spark.read.schema("c_custkey long, batch int, nation int").json(records)


BOXES = ["john.smith@x.example", "sarah@x.example", "johnsmith@x.example", "info@x.example", "jsmith@gmail.com", "mary-ann@century21.example", "j.smith@x.example", "no address", None]
FIRSTS, TWOS = ["John", "Sarah", "John", None, None, None, None, None, None], ["John Smith", None, None, None, None, "Mary Ann", None, None, None]
DOMAINS, WHY = ["x.example", "x.example", "x.example", "x.example", None, None, "x.example", None, None], ["", "", "", "", "personal", "franchise", "", "no_email", "no_email"]


def contact_mailboxes(spark, d):
    k = F.col("c_custkey")
    e = _pick(BOXES, k % 9)
    b = C.business_domain(e, ["gmail.com"], ["century21", "remax"])
    return read(spark, d, "customer").select(k, C.first_name_of_mailbox(e, ["info"]).alias("first"), C.two_names_of_mailbox(e, ["info"]).alias("two"), b["domain"].alias("domain"), b["reason"].alias("reason"))


def contact_industries(spark, d):
    """Contacts and who wrote back, by tier and industry."""
    k = F.col("c_custkey")
    kind = C.industry(F.concat(F.lit("e@"), _pick(["acme-realty.example", "bank.example", "x.example"], k % 3)), F.when(k % 5 == 0, "Law Firm"), {"real estate": ["realty", "homes"], "finance": ["bank"], "law": ["law"]})
    rows = read(spark, d, "customer").select(F.concat(F.lit("c"), k % 400).alias("contact"), (k % 400 % 4).alias("tier"), F.coalesce(kind, F.lit("other")).alias("industry"), (k % 2).alias("replies"))
    return C.replies_by(rows, "tier", "industry")


def contact_completeness(spark, d):
    k = F.col("c_custkey")
    rows = read(spark, d, "customer").select(k.alias("ord"), F.concat(F.lit("page"), k).alias("page_name"), F.when(k % 3 > 0, "e@x.example").alias("primary_email"), _pick(["Ann", "none", None], k % 4).alias("contact_name"), F.when(k % 5 == 0, "[]").otherwise("555").alias("phones"))
    return C.completeness(rows)


def contact_works_at(spark, d):
    from ..operators.matching import company_key

    k = F.col("c_custkey")
    rows = read(spark, d, "customer").select(F.concat(F.lit("e"), k % 300).alias("email"), F.concat(F.lit("Acme "), k % 7, _pick([" Inc", " LLC", ""], k % 3)).alias("company"), F.concat(F.lit("role"), k).alias("role"), F.when(k % 4 > 0, k / 10000).alias("confidence"), k.alias("ord"))
    return C.works_at(rows, company_key(F.col("company"))).withColumn("confidence", F.round("confidence", 6))


def contact_merged_people(spark, d):
    k = F.col("c_custkey")
    people = read(spark, d, "customer").select(k.alias("node"), F.when(k % 2 == 0, F.concat(F.lit("name"), k)).alias("name"), F.when(k % 3 == 0, F.concat(F.lit("url"), k)).otherwise("").alias("url"))
    return CC.merged_nodes(people, read(spark, d, "customer").filter(k % 5 == 0).select(k.alias("old"), (k + 1).alias("new")).unionByName(read(spark, d, "customer").filter(k % 5 == 4).select(k.alias("old"), (k + 2).alias("new"))))


QUERIES = {f.__name__: f for f in (
    contact_names, contact_bounces, contact_findings, contact_people, contact_page_sets, contact_technologies, contact_ad_texts, contact_advertisers, contact_handles, contact_handle_sources, contact_alternates, contact_with_alternate, contact_domain_matches, contact_first_tier,
    contact_needing, contact_prospects, contact_profiles, contact_appended, contact_trial_run, contact_statuses, contact_graph_status, contact_drafts, contact_mapped, contact_profile, contact_runs, contact_versions,
    contact_mailboxes, contact_industries, contact_completeness, contact_works_at, contact_merged_people)}
_K = "SELECT c_custkey AS k FROM customer"
_RAW = f"""ads AS (SELECT o_custkey AS page_id, o_orderkey AS k, o_orderdate AS o, CASE o_orderkey % 4 WHEN 0 THEN 'body ' || (o_orderkey % 6) WHEN 1 THEN 'c1 | c' || (o_orderkey % 5) WHEN 2 THEN 'title' ELSE CASE WHEN o_orderkey % 8 = 3 THEN 'legacy' ELSE '' END END AS text,
  CASE WHEN o_orderkey % 3 > 0 THEN o_orderkey % 100 ELSE 0 END AS lo, CASE WHEN o_orderkey % 3 > 1 THEN o_orderkey % 100 + 50 ELSE 0 END AS hi, {_sql_pick(["FB", "IG", "MS"], "o_orderkey % 3")} AS p, {_sql_pick(["US", "CO"], "o_orderkey % 2")} AS c FROM orders)"""
_ROWS = f"""r AS (SELECT k AS ord, CASE k % 3 WHEN 0 THEN 'e' || (k % 300) || '@x.example' WHEN 1 THEN 'bad' END AS primary_email, k % 4 = 0 AS email_verified, CASE WHEN k % 5 > 0 THEN 'https://s' || k ELSE '' END AS website_url, k % 10 / 10 AS search_confidence,
  {_sql_pick(["n/a", "Ann Lee", "", None], "k % 4")} AS contact_name, {_sql_pick(["sent", "failed", None], "k % 3")} AS status, {_sql_pick(["dm", "mail"], "k % 2")} AS method FROM ({_K}))"""
SQL = {
    "contact_names": f"SELECT k AS c_custkey, {_sql_pick(FROM_PAGES, 'k % 12')} AS page, {_sql_pick(FROM_HANDLES, 'k % 7')} AS handle, {_sql_pick(FROM_TEAMS, 'k % 5')} AS team FROM ({_K})",
    "contact_bounces": f"SELECT k AS c_custkey, CASE WHEN k % 11 = 0 THEN 'x@header.example' WHEN k % 13 = 0 THEN 's@status.example' ELSE {_sql_pick(BOUNCED, 'k % 8')} END AS bounced FROM ({_K})",
    "contact_findings": f"SELECT k AS c_custkey, {_sql_pick(FOUND, 'k % 5')} AS findings FROM ({_K})",
    "contact_people": f"SELECT k AS c_custkey, {_sql_pick([a for a, _ in PEOPLE], 'k % 7')} AS name, {_sql_pick([b for _, b in PEOPLE], 'k % 7')} AS position, {_sql_pick(TEAM_OF, 'k % 7')} AS team FROM ({_K})",
    "contact_page_sets": f"""WITH t AS (SELECT site, k, n, row_number() OVER (PARTITION BY site ORDER BY k) AS r FROM (SELECT k % 50 AS site, {_sql_pick(["Ann Lee", "Bob Ray", "Cyd Moss"], "k % 3")} AS n, min(k) AS k FROM ({_K}) WHERE k % 5 = 2 GROUP BY 1, 2)),
  m AS (SELECT site, string_agg(n, ',' ORDER BY k) AS team, arg_min(n, k) AS first FROM t WHERE r <= 10 GROUP BY 1),
  p AS (SELECT k % 50 AS site, k, 'e' || (k % 23) || '@s' || (k % 3) || '.org' AS e, '555010' || lpad(CAST(k % 17 AS VARCHAR), 4, '0') AS p, '@shop' || (k % 29) AS i FROM ({_K}))
  SELECT p.site, coalesce(any_value(first), '') AS contact_name, '' AS contact_position, coalesce('about ' || min(k) FILTER (k % 4 = 3), '') AS description, array_to_string(list_sort(list(DISTINCT e))[1:5], ',') AS emails, array_to_string(list_sort(list(DISTINCT p))[1:3], ',') AS phones,
  array_to_string(list_sort(list(DISTINCT i))[1:10], ',') AS instagram_handles, coalesce(any_value(team), '') AS team FROM p LEFT JOIN m ON m.site = p.site GROUP BY 1""",
    "contact_technologies": f"""SELECT k AS c_custkey, k % 2 = 0 OR k % 3 = 0 AS has_crm, CASE WHEN k % 2 = 0 THEN 'hubspot' WHEN k % 3 = 0 THEN 'zoho' ELSE '' END AS crm_name, k % 5 = 0 OR k % 7 = 0 AS has_marketing_pixel,
  CASE WHEN k % 35 = 0 THEN '["meta","google"]' WHEN k % 5 = 0 THEN '["meta"]' WHEN k % 7 = 0 THEN '["google"]' ELSE '[]' END AS pixel_types, FALSE AS has_scheduling_tool, '' AS scheduling_tool, FALSE AS has_chat_widget, '' AS chat_widget, k % 11 = 0 OR k % 13 = 0 AS has_lead_form,
  CAST(k % 2 = 0 AS INT) + CAST(k % 3 = 0 AS INT) + CAST(k % 5 = 0 AS INT) + CAST(k % 7 = 0 AS INT) + CAST(k % 11 = 0 AS INT) AS tech_count FROM ({_K})""",
    "contact_ad_texts": f"WITH {_RAW} SELECT text, count(*) AS n FROM ads GROUP BY 1",
    "contact_advertisers": f"""WITH {_RAW}, t AS (SELECT page_id, string_agg(text, ' | ' ORDER BY o, text) AS text FROM (SELECT page_id, text, min(k) AS o, row_number() OVER (PARTITION BY page_id ORDER BY min(k), text) AS r FROM ads WHERE text <> '' GROUP BY 1, 2) WHERE r <= 10 GROUP BY 1)
  SELECT a.page_id, 'Page ' || a.page_id AS page_name, count(*) AS ad_count, array_to_string(list_sort(list_distinct(flatten(list([p, 'FB'])))), ',') AS platforms, array_to_string(list_sort(list(DISTINCT c)), ',') AS countries, bool_or(k % 4 = 0) AS is_active, strftime(min(o), '%Y-%m-%d') AS first_ad_date,
  nullif(round(sum(CASE WHEN hi > 0 THEN (lo + hi) / 2 ELSE lo END), 2), 0) AS total_spend, max(CASE WHEN k % 5 = 1 THEN 'USD' END) AS currency, nullif(max(CASE WHEN k % 2 = 0 THEN k % 1000 END), 0) AS max_reach, coalesce(any_value(t.text), '') AS text FROM ads a LEFT JOIN t ON a.page_id = t.page_id GROUP BY 1, 2""",
    "contact_handles": f"SELECT k AS c_custkey, CASE WHEN k % 9 >= 0 THEN '@annlee,@shop' || (k % 9) END AS handles, k % 4 = 0 AS personal, k % 4 = 1 AS company, CAST(CASE k % 4 WHEN 0 THEN 0.8 WHEN 1 THEN 0.7 ELSE 0.0 END AS DOUBLE) AS confidence FROM ({_K})",
    "contact_handle_sources": f"WITH f AS (SELECT k % 200 AS key, k % 4 AS rank, '@ha' || (k % 90) AS h FROM ({_K}) WHERE k % 4 > 0), b AS (SELECT key, min(rank) AS rank FROM f GROUP BY 1) SELECT f.key, 'source' || any_value(f.rank) AS source, array_to_string(list_sort(list(DISTINCT h))[1:20], ',') AS handles FROM f JOIN b ON f.key = b.key AND f.rank = b.rank GROUP BY 1",
    "contact_alternates": f"""WITH q AS (SELECT k, k - k % 3 AS j, {_sql_pick(['p', 'a', 'b', 'z'], 'k % 4')} AS a FROM ({_K}))
  SELECT CASE WHEN k % 5 = 0 THEN upper(a || j || '@x.example') ELSE a || j || '@x.example' END AS email, CASE WHEN j IN (SELECT c_custkey FROM customer) AND (a = 'p' OR a = 'a' OR a = 'b' AND j % 2 = 0) THEN CASE WHEN j % 2 = 0 THEN 'P' || j || '@X.example' ELSE 'p' || j || '@x.example' END END AS primary_email FROM q""",
    "contact_with_alternate": f"""SELECT k AS c_custkey, CASE WHEN k % 5 = 0 THEN 'A' || k || '@X.example' ELSE 'a' || k || '@x.example' END || CASE WHEN k % 2 = 0 THEN ',b' || k || '@x.example' ELSE '' END AS alternates FROM ({_K})""",
    "contact_domain_matches": f"SELECT s.k AS node, min(r.k) AS match FROM ({_K}) s JOIN ({_K}) r ON s.k % 400 = r.k % 400 AND s.k % 7 = r.k % 7 WHERE s.k % 9 > 0 AND r.k % 10 > 0 GROUP BY 1 HAVING count(*) = 1",
    "contact_first_tier": f"SELECT k % 100 AS node, arg_min(k, (k * 7 % 3, k)) AS match, min(k * 7 % 3 + 1) AS tier FROM ({_K}) GROUP BY 1",
    "contact_needing": f"WITH {_ROWS} SELECT 'name' AS step, ord FROM r WHERE ord % 4 <> 1 UNION ALL SELECT 'email', ord FROM r WHERE ord % 3 > 0 AND (ord % 3 = 2 OR NOT email_verified) AND website_url <> '' AND search_confidence > 0.3 UNION ALL SELECT 'absent', ord FROM r",
    "contact_prospects": f"WITH {_ROWS} SELECT ord, primary_email FROM r WHERE ord % 3 = 0 AND ord % 300 NOT IN (SELECT k % 300 FROM ({_K}) WHERE k % 7 = 0 OR k % 31 = 0) ORDER BY ord LIMIT 50",
    "contact_profiles": f"SELECT k AS c_custkey, CASE k % 3 WHEN 0 THEN '' WHEN 1 THEN 'e' || k || '@x.example' END AS email, CASE WHEN k % 3 = 0 THEN 'https://www.LinkedIn.com/in/p' || k ELSE '' END AS linkedin_url FROM ({_K})",
    "contact_appended": f"SELECT k AS c_custkey, CASE WHEN k % 7 > 0 THEN 'site' || k END AS site, CASE WHEN k % 5 = 0 THEN 'old' WHEN o = 'found' THEN 'r' || k END AS rating, CASE WHEN o = 'found' THEN k % 9 END AS reviews, o AS outcome FROM (SELECT k, CASE WHEN k % 5 = 0 THEN 'kept' WHEN k % 7 = 0 THEN 'no_input' WHEN k % 2 = 0 THEN 'found' ELSE 'empty' END AS o FROM ({_K}))",
    "contact_trial_run": f"WITH {_ROWS}, n AS (SELECT ord FROM r ORDER BY ord LIMIT 100) SELECT ord, CASE WHEN ord IN (SELECT ord FROM n) THEN website_url END AS website_url FROM r",
    "contact_statuses": f"WITH {_ROWS} SELECT coalesce(status, '') AS status, coalesce(method, '') AS method, count(*) AS n FROM r GROUP BY 1, 2",
    "contact_graph_status": f"""WITH c AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 6 > 0 THEN 'country' || c_nationkey END AS country, c_custkey * 7 % 101 AS v1, c_custkey * 3 % 101 AS v2 FROM customer)
  SELECT 'filled' AS section, 'people' AS label, count(*) AS n FROM c UNION ALL SELECT 'filled', 'name', count(*) FILTER (k % 3 > 0) FROM c UNION ALL SELECT 'filled', 'company', count(*) FILTER (k % 4 > 0) FROM c UNION ALL SELECT 'filled', 'country', count(country) FROM c
  UNION ALL (SELECT 'country', country, count(*) AS n FROM c WHERE country IS NOT NULL GROUP BY 2 ORDER BY n DESC, 2 LIMIT 10) UNION ALL SELECT 'strength', CASE WHEN v2 >= 70 THEN 'strong' WHEN v2 >= 40 THEN 'medium' WHEN v2 >= 10 THEN 'weak' ELSE 'none' END, count(*) FROM c GROUP BY 2 UNION ALL SELECT 'strength', 'apart', count(*) FILTER (abs(v1 - v2) > 20) FROM c UNION ALL SELECT 'strength', 'dropped', count(*) FILTER (v1 - v2 > 20) FROM c""",
    "contact_drafts": f"WITH p AS (SELECT k % 700 AS g, min(k) AS prospect FROM ({_K}) GROUP BY 1) SELECT k AS draft_id, 'page' || (k % 900) AS page_name, prospect FROM ({_K}) LEFT JOIN p ON g = k % 900",
    "contact_mapped": f"SELECT CAST(k AS VARCHAR) AS id, 'Acme a' || k AS page_name, {_sql_pick(['a|b', 'x|y', ''], 'k % 3')} AS platforms, CASE WHEN k % 3 = 0 THEN 12 ELSE 0 END AS ad_count, k % 3 = 0 AS is_active, CASE WHEN k % 3 < 2 THEN '2024-05-06' ELSE '' END AS first_ad_date, concat_ws('|', CASE WHEN k % 2 = 0 THEN '555' END, CASE WHEN k % 5 > 0 THEN '777' END) AS phones FROM ({_K})",
    "contact_profile": f"WITH {_ROWS}, n AS (SELECT count(*) AS rows FROM r) " + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", (SELECT count(*) FROM r WHERE trim(CAST({c} AS VARCHAR)) <> '') AS filled, rows FROM n" for c in ("ord", "primary_email", "email_verified", "website_url", "search_confidence", "contact_name", "status", "method")),
    "contact_runs": "SELECT event_id % 20 AS run_id, min(ts) AS started, max(ts) AS ended, count(*) FILTER (event_id % 3 <> 1) AS n_done, count(*) FILTER (event_id % 3 = 1) AS n_failed, count(DISTINCT event_id % 300) AS n_items FROM events GROUP BY 1",
    "contact_mailboxes": f"SELECT k AS c_custkey, {_sql_pick(FIRSTS, 'k % 9')} AS first, {_sql_pick(TWOS, 'k % 9')} AS two, {_sql_pick(DOMAINS, 'k % 9')} AS domain, {_sql_pick(WHY, 'k % 9')} AS reason FROM ({_K})",
    "contact_industries": f"SELECT tier, industry, count(DISTINCT c) AS contacts, count(DISTINCT CASE WHEN r > 0 THEN c END) AS replied FROM (SELECT k % 400 AS c, k % 400 % 4 AS tier, CASE k % 3 WHEN 0 THEN 'real estate' WHEN 1 THEN 'finance' ELSE CASE WHEN k % 5 = 0 THEN 'law' ELSE 'other' END END AS industry, k % 2 AS r FROM ({_K})) GROUP BY 1, 2",
    "contact_completeness": f"SELECT CASE WHEN k % 3 = 0 THEN 'no_email' WHEN k % 4 = 0 AND k % 5 > 0 THEN 'complete' WHEN k % 4 = 0 THEN 'email_contact' ELSE 'email_only' END AS bucket, count(*) AS n, 'page' || min(k) AS first FROM ({_K}) GROUP BY 1",
    "contact_works_at": f"""WITH r AS (SELECT 'e' || (k % 300) AS email, 'acme ' || (k % 7) AS company_key, 'Acme ' || (k % 7) || {_sql_pick([" Inc", " LLC", ""], "k % 3")} AS company, 'role' || k AS role, CASE WHEN k % 4 > 0 THEN round(k / 10000, 6) ELSE 0.0 END AS confidence, k FROM ({_K})), s AS (SELECT company_key, arg_min(company, k) AS company FROM r GROUP BY 1)
  SELECT email, r.company_key, any_value(s.company) AS company, arg_max(role, k) AS role, arg_max(confidence, k) AS confidence FROM r JOIN s ON r.company_key = s.company_key GROUP BY 1, 2""",
    "contact_merged_people": f"""WITH p AS (SELECT k AS node, CASE WHEN k % 2 = 0 THEN 'name' || k END AS name, CASE WHEN k % 3 = 0 THEN 'url' || k END AS url FROM ({_K})), g AS (SELECT node - node % 5 + 1 + CASE WHEN node % 5 = 4 THEN 5 ELSE 0 END AS node, arg_min(name, node) FILTER (name IS NOT NULL) AS n, arg_min(url, node) FILTER (url IS NOT NULL) AS u FROM p WHERE node % 5 IN (0, 4) GROUP BY 1)
  SELECT p.node, coalesce(p.name, n) AS name, CASE WHEN p.url IS NULL AND g.node IS NULL THEN NULL ELSE coalesce(p.url, u) END AS url FROM p LEFT JOIN g ON g.node = p.node WHERE p.node % 5 NOT IN (0, 4) OR p.node % 5 = 4 AND p.node + 2 NOT IN (SELECT node FROM p)""",
    "contact_versions": "SELECT c_custkey, CASE c_custkey % 5 WHEN 1 THEN 1 ELSE 0 END AS batch, CASE WHEN c_nationkey > 5 THEN c_nationkey END AS nation FROM customer WHERE c_custkey % 3 = 0 AND c_custkey % 5 IN (1, 2)",
}
