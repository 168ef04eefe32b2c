"""Contacts: names from page names, handles and pages, page sets, bounced addresses, handles, technologies, work that is left."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import html as H
from ..functions.text import null_if_sentinel, parse_list, valid_email
from .joins import small
from .matching import matching_name

# Words, patterns and lists that decide results.
NOT_A_NAME = ["none", "none none", "nan", "n/a", "null", "undefined", "unknown", "meet our team", "social media", "featured video", "your information", "contact", "info", "support", "team", "admin", "founding member"]
NOT_A_FIRST_NAME = ["river", "lake", "hill", "ocean", "mountain", "percent", "prime", "best", "top", "first", "the", "west", "east"]
FIRST_NAMES = [
    "james", "john", "robert", "michael", "david", "william", "richard", "joseph", "thomas", "charles", "mary", "patricia", "jennifer", "linda", "elizabeth", "barbara", "susan", "jessica", "sarah", "karen",
    "alex", "brian", "chris", "daniel", "eric", "frank", "george", "henry", "ivan", "jack", "kevin", "larry", "mark", "nick", "paul", "ryan", "scott", "steve", "tom", "mike",
    "amy", "anna", "beth", "carol", "diana", "emily", "grace", "helen", "jane", "kate", "lisa", "maria", "nancy", "olivia", "rachel", "sandra", "tina", "wendy", "amber", "devon",
    "jeremy", "brendon", "fausto", "leah", "molly", "kyle", "ross", "seth", "tim", "dale", "luiz", "matthew", "lindsey", "suzanne", "aimee", "candis", "markus", "bob", "rosana",
    "bonnie", "liz", "michelle", "robin", "nolan", "donald", "tiffany", "brent", "vanessa", "todd", "marco", "bill", "ina", "tyler", "jonathan", "laura", "marcus", "kalyani",
    "don", "paulina", "aracely", "joaquin", "mandy", "peter", "jerry", "carla", "gary", "kim", "jason", "cindy", "eli", "claudia", "jerad",
]
_PERSON, _LONG = r"[A-Z][a-z]+ [A-Z][a-z']+", r"[A-Z][a-z]+ [A-Z][a-z']+(?:\s+[A-Z][a-z]+)?"
PAGE_NAMES = [
    (rf"^({_LONG}),\s*.+", []),
    (rf"^({_LONG})\s*[-–—]\s*.+", ["real", "estate", "home", "property", "group", "team", "door", "hill"]),
    (rf"^({_PERSON})\s+(?:Real Estate|Realty|Properties|Homes)$", []),
    (rf"^The\s+({_PERSON})\s+(?:Team|Group)$", []),
    (r"^([A-Z][a-z]+ [A-Z][a-z]+)\s+(?:Texas|Florida|California|Chicago|[A-Z][a-z]+)\s+(?:Realtor|Title|Realty)", []),
    (r"^([A-Z][a-z]+ [A-Z][a-z]+)\s+(?:Compass|Keller Williams|RE/MAX|Coldwell|Century|NextHome|EXP|Better Homes)", []),
    (rf"^({_PERSON})[/-].+", []),
    (r"^([A-Z][a-z]+ [A-Z][a-z]+)$", []),
]
HANDLE_WORDS = ["realtor", "realty", "realestate", "homes", "properties", "group", "team", "official", "miami", "florida", "la", "nyc"]
NOT_HANDLES = ["instagram", "explore", "accounts", "reels", "stories", "gmail", "yahoo", "hotmail", "outlook", "media", "import", "charset", "context", "type", "graph"]
HIRING = [r"hiring\s+\d+\s+(?:new\s+)?agents?", r"looking\s+for\s+\d+\s+agents?", r"join\s+(?:our\s+)?team", r"(?:we\s+are|we're)\s+hiring", r"\d+%?\s+lead\s+surplus"]
ACHIEVEMENTS = [r"(?:just\s+)?closed\s+(?:my\s+|our\s+)?\d+(?:th|st|nd|rd)?\s+deal", r"\$\d+(?:\.\d+)?[mbk]?\s+(?:in\s+)?sales", r"top\s+\d+%", r"#?\d+\s+(?:team|agent|realtor)"]
_ADDRESS = r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}"
BOUNCES = [
    rf"Remote Server returned[^<]*<({_ADDRESS})>", rf"couldn't be delivered to\s*({_ADDRESS})", rf"Delivery has failed to these recipients.*?<({_ADDRESS})>",
    rf"Address not found.*?<({_ADDRESS})>", rf"The email account.*?<({_ADDRESS})>.*?does not exist",
    rf"Final-Recipient:.*?({_ADDRESS})", rf"Original-Recipient:.*?({_ADDRESS})",
    rf"(?:could not be delivered to|failed for|rejected by|undeliverable to)[:\s]*<?({_ADDRESS})>?", rf"(?:recipient|to address)[:\s]*<?({_ADDRESS})>?",
    rf"Your message to\s+<?({_ADDRESS})>?", rf"message sent to\s+<?({_ADDRESS})>?", r"<([a-zA-Z0-9._%+-]+@(?!googlemail\.com|google\.com)[a-zA-Z0-9.-]+\.[a-zA-Z]{2,})>",
]
NOT_BOUNCED = ["mailer-daemon", "postmaster", "noreply"]
# first names by which an address's one part is known, longer ones first where both fit
MAILBOX_NAMES = [
    "john", "mike", "david", "james", "robert", "michael", "william", "mary", "jennifer", "linda", "sarah", "jessica", "emily", "ashley", "brian", "chris", "matt", "jason", "ryan", "kevin", "steve",
    "lisa", "kim", "anna", "karen", "nancy", "betty", "helen", "tim", "tom", "bob", "joe", "dan", "mark", "paul", "peter", "amy", "jen", "kate", "meg", "sue", "ann", "pat", "lee",
    "jeremy", "madison", "victoria", "wendy", "kelly", "tia", "camille", "charlee", "erin", "richard", "roy", "dean", "greg", "alex", "nick", "tony", "bill", "ben", "sam", "max",
    "jake", "luke", "adam", "jack", "eric", "sean", "alan", "carl", "chad", "cole", "drew", "evan", "gary", "glen", "ivan", "joel", "kent", "kirk", "kurt", "lane", "lars", "leon",
    "liam", "luis", "marc", "neil", "noah", "omar", "owen", "phil", "reid", "rick", "ross", "russ", "seth", "stan", "todd", "troy", "wade", "walt", "ward", "zach", "abby", "ally", "andy", "beth",
    "cara", "cary", "dana", "dawn", "deb", "gail", "gina", "hope", "jade", "jane", "jean", "jill", "joan", "jodi", "judy", "june", "kara", "katy", "kris", "lana", "lara", "lena", "lily", "lori",
    "lucy", "lynn", "macy", "maya", "megan", "nina", "nora", "olga", "pam", "rosa", "rose", "ruby", "ruth", "sara", "tara", "tina", "vera", "vicky", "zoe", "aspen", "chirag", "hoshyar", "keveanu",
    "terrance", "carroll", "stevie", "lovetra", "jesus",
]
GENERIC_DOMAINS = [
    "gmail.com", "yahoo.com", "hotmail.com", "outlook.com", "icloud.com", "aol.com", "live.com", "me.com", "msn.com", "mail.com", "protonmail.com", "zoho.com", "ymail.com", "googlemail.com",
    "comcast.net", "att.net", "verizon.net", "sbcglobal.net", "cox.net", "bellsouth.net", "earthlink.net", "mac.com",
]
PERSON_TYPES = ["Person", "RealEstateAgent", "Employee"]
NOT_PEOPLE = r"(?i)HOME|ABOUT|CONTACT|BLOG|MENU|LOGIN|SIGN|SEARCH|PROPERTY|LISTING|Bedroom|Bathroom|sqft|acre|price|\$|Click|Learn|Read|View|See|More|Submit|[0-9]{3,}|@|https?://"
NAME_SUFFIXES = r"Jr\.|Sr\.|Jr|Sr|II|III|IV"
TITLES = "CEO|President|Owner|Broker|Agent|Manager|Director|Founder|Partner|Realtor|Principal"
POSITIONS = ["realtor", "agent", "broker", "ceo", "founder", "manager", "director"]
EMOJI = r"[\x{1F600}-\x{1F64F}\x{1F300}-\x{1F5FF}\x{1F680}-\x{1F6FF}\x{1F1E0}-\x{1F1FF}\x{2702}-\x{27B0}\x{24C2}-\x{1F251}]+"


def _blank(c: Column) -> Column:
    return F.coalesce(F.trim(c.cast("string")), F.lit("")) == ""


def _found(text: Column, pattern: str, group: int = 1) -> Column:
    """What a group of the first match holds; null without one."""
    return F.nullif(F.regexp_extract(F.coalesce(text, F.lit("")), pattern, group), F.lit(""))


# names


def person_like(name: Column) -> Column:
    """Two words or more, the first a known first name, or capitalised, of three to twelve letters and no place or rank."""
    words = F.split(F.lower(F.trim(name)), r"\s+")
    first = words[0]
    usual = F.length(first).between(3, 12) & name.rlike("^[A-Z]") & ~first.isin(NOT_A_FIRST_NAME)
    return F.coalesce((F.size(words) >= 2) & (usual | first.isin(FIRST_NAMES)), F.lit(False))


def name_from_page(page_name: Column) -> Column:
    """A person's name in a page's name, by the first of PAGE_NAMES that gives one; null if none does."""
    t, got = F.trim(page_name), []
    for pattern, excluded in PAGE_NAMES:
        name = _found(t, f"(?i){pattern}")
        fits = person_like(name)
        if excluded:
            fits = fits & ~F.lower(name).rlike("|".join(excluded))
        got.append(F.when(fits, name))
    return F.coalesce(*got)


def name_from_handle(handle: Column) -> Column:
    """The first part of a handle, capitalised, of 3 to 20 letters and no common word; null else."""
    first = F.split(F.lower(F.replace(handle, F.lit("@"))), r"[._]")[0]
    return F.when(F.length(first).between(3, 20) & ~first.isin(HANDLE_WORDS) & ~first.rlike("[0-9]"), F.initcap(first))


def valid_name(name: Column) -> Column:
    t = F.lower(F.trim(name))
    return F.coalesce(~t.isin(NOT_A_NAME) & (F.length(t) >= 3) & ~F.contains(t, F.lit("'s listings")) & (F.size(F.split(t, r"\s+")) >= 2), F.lit(False))


def first_member(members: Column) -> Column:
    """The first valid name of a team's cell, JSON or with single quotes."""
    team = F.from_json(F.replace(members, F.lit("'"), F.lit('"')), "array<struct<name: string>>")
    return F.get(F.filter(F.transform(team, lambda m: m["name"]), valid_name), F.lit(0))


def first_name_of_mailbox(email: Column, generic: list[str]) -> Column:
    """A known first name that a mailbox begins with: before a point or line, alone, or before three letters or more; the longest one."""
    box = F.lower(F.substring_index(email, "@", 1))
    known = "|".join(sorted(MAILBOX_NAMES, key=lambda n: (-len(n), n)))
    found = F.coalesce(F.when(box.rlike("[._]"), _found(box, rf"^({known})[._]")), _found(box, rf"^({known})$"), _found(box, rf"^({known})[\p{{L}}]{{3,}}$"))
    return F.when(F.contains(email, F.lit("@")) & ~box.isin(generic), F.initcap(found))


def two_names_of_mailbox(email: Column, generic: list[str]) -> Column:
    """First Last of a mailbox of exactly two parts of over one character, by the first of . _ - that is in it."""
    box = F.lower(F.trim(F.substring_index(email, "@", 1)))
    two = lambda sep: F.split(box, sep)
    fits = lambda p: (F.size(p) == 2) & (F.length(F.get(p, F.lit(0))) > 1) & (F.length(F.get(p, F.lit(1))) > 1)
    named = F.coalesce(*(F.when(fits(two(s)), F.initcap(F.array_join(two(s), " "))) for s in (r"\.", "_", "-")))
    return F.when(F.contains(email, F.lit("@")) & ~box.isin(generic), named)


def business_domain(email: Column, personal: list[str], franchises: list[str]) -> Column:
    """domain, reason: the domain of an address, or why there is none: no_email, personal or franchise."""
    d = F.lower(F.trim(F.substring_index(email, "@", -1)))
    reason = F.when(~F.coalesce(F.contains(email, F.lit("@")), F.lit(False)), "no_email").when(d.isin(personal), "personal").when(d.rlike("|".join(franchises)), "franchise").otherwise("")
    return F.struct(F.when(reason == "", d).alias("domain"), reason.alias("reason"))


def industry(email: Column, company: Column, industries: dict[str, list[str]]) -> Column:
    """The first industry of which a word stands in the address's domain or the company's name."""
    where = F.lower(F.concat_ws(" ", F.substring_index(email, "@", -1), company))
    return F.coalesce(*(F.when(where.rlike("|".join(words)), F.lit(name)) for name, words in industries.items()))


def replies_by(contacts: DataFrame, *by: str) -> DataFrame:
    """by, contacts, replied: people who wrote back, by tier and industry."""
    return contacts.groupBy(*by).agg(F.count_distinct("contact").alias("contacts"), F.count_distinct(F.when(F.col("replies") > 0, F.col("contact"))).alias("replied"))


def completeness(df: DataFrame) -> DataFrame:
    """bucket, n, first: rows by what they have, each in one bucket, and the first name by order: complete, email_contact, email_only, no_email."""
    email = F.contains(F.coalesce("primary_email", F.lit("")), F.lit("@"))
    name, phone = null_if_sentinel(F.col("contact_name")).isNotNull(), F.size(parse_list(F.col("phones"))) > 0
    bucket = F.when(~email, "no_email").when(name & phone, "complete").when(name, "email_contact").otherwise("email_only")
    return df.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"), F.min_by("page_name", "ord").alias("first"))


def works_at(extractions: DataFrame, key: Column) -> DataFrame:
    """email, company_key, company (its first spelling), role, confidence (of the last extraction) of extractions (email, company, role, confidence, ord)."""
    rows = extractions.withColumn("company_key", key).filter("company_key <> ''")
    spelt = rows.groupBy("company_key").agg(F.min_by("company", "ord").alias("company"))
    last = rows.groupBy("email", "company_key").agg(F.max_by(F.struct("role", F.coalesce("confidence", F.lit(0.0)).alias("confidence")), "ord").alias("x"))
    return last.join(spelt, "company_key").select("email", "company_key", "company", "x.role", "x.confidence")


# pages


def person_name(text: Column) -> Column:
    """Whether a page's text is a person's name: two to four capitalised words, suffixes apart, none of a menu's."""
    words = F.split(text, r"\s+")
    each = F.forall(words, lambda w: w.rlike(rf"^(?:[A-Z][a-z]+|{NAME_SUFFIXES})$"))
    return F.coalesce(F.length(text).between(3, 50) & F.size(words).between(2, 4) & ~text.rlike(NOT_PEOPLE) & each, F.lit(False))


def _bare(html: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(html, r"(?s)<[^>]*>", ""), r"\s+", " "))


def _cards(html: Column, classes: str) -> Column:
    """Elements of a team's or person's class, each up to the next such element."""
    start = rf"""(?is)<(?:div|section|article|li|figure)\b[^>]*class=["'][^"']*(?:{classes})"""
    marked = F.regexp_replace(F.coalesce(html, F.lit("")), f"({start})", "\x01$1")
    return F.slice(F.split(marked, "\x01"), 2, 1 << 20)


def contact_person(html: Column) -> Column:
    """name, position of a page's person: by linked data, else a team card, else a name beside a title; null without one."""
    data = F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(r"""(?is)<script[^>]*application/ld\+json[^>]*>(.*?)</script>"""), F.lit(1))
    people = F.transform(data, lambda d: F.from_json(d, "struct<`@type`: string, name: string, jobTitle: string>"))
    told = F.transform(F.filter(people, lambda p: p["@type"].isin(PERSON_TYPES) & person_name(p["name"])), lambda p: F.struct(p["name"].alias("name"), F.coalesce(p["jobTitle"], F.lit("")).alias("position")))
    head = lambda c: F.coalesce(_found(c, r"""(?is)<(?:h[2-5]|strong|span|a)\b[^>]*class=["'][^"']*(?:name|title|heading)[^>]*>(.*?)</"""), _found(c, r"(?is)<h[2-5]\b[^>]*>(.*?)</h[2-5]>"))
    role = lambda c: _bare(F.regexp_extract(c, r"""(?is)<(?:p|span|div)\b[^>]*class=["'][^"']*(?:position|role|title|job|designation)[^>]*>(.*?)</""", 1))
    cards = F.transform(_cards(html, "team|agent|staff|member|card|profile"), lambda c: F.struct(_bare(head(c)).alias("name"), F.when(F.length(role(c)) <= 50, role(c)).otherwise("").alias("position")))
    text = H.visible(html)
    before = F.struct(_found(text, rf"([A-Z][a-z]+\s+[A-Z][a-z]+)\s*[,–—-]\s*(?:{TITLES})").alias("name"), _found(text, rf"[A-Z][a-z]+\s+[A-Z][a-z]+\s*[,–—-]\s*({TITLES})").alias("position"))
    after = F.struct(_found(text, rf"(?:{TITLES})\s*[:–—-]\s*([A-Z][a-z]+\s+[A-Z][a-z]+)").alias("name"), _found(text, rf"({TITLES})\s*[:–—-]\s*[A-Z][a-z]+\s+[A-Z][a-z]+").alias("position"))
    return F.get(F.filter(F.concat(told, cards, F.array(before, after)), lambda p: person_name(p["name"])), F.lit(0))


def team_members(html: Column, most: int = 10) -> Column:
    """name, position, instagram of a page's team cards that have a name or a handle, `most` at most: a report's length."""
    named = lambda t: F.when(F.size(F.split(t, r"\s+")).between(2, 4) & F.forall(F.split(t, r"\s+"), lambda w: w.rlike(r"^\p{Lu}")), t)
    heads = lambda c: F.transform(F.regexp_extract_all(c, F.lit(r"(?is)<(h[2-5]|strong)\b[^>]*>(.*?)</\1>"), F.lit(2)), _bare)
    roles = lambda c: F.filter(F.transform(F.regexp_extract_all(c, F.lit(r"(?is)<(p|span|div)\b[^>]*>([^<]*)</\1>"), F.lit(2)), lambda x: F.trim(x)), lambda x: (F.length(x) < 50) & F.lower(x).rlike("|".join(POSITIONS)))
    card = lambda c: F.struct(
        F.coalesce(F.get(F.filter(F.transform(heads(c), named), lambda x: x.isNotNull()), F.lit(0)), F.lit("")).alias("name"), F.coalesce(F.get(roles(c), F.lit(0)), F.lit("")).alias("position"),
        F.coalesce(F.concat(F.lit("@"), F.lower(_found(c, r"(?i)instagram\.com/([A-Za-z0-9_.]+)"))), F.lit("")).alias("instagram"))
    return F.slice(F.filter(F.transform(_cards(html, "team|agent|staff|member|card|profile|speaker|trainer"), card), lambda m: (m["name"] != "") | (m["instagram"] != "")), 1, most)


def page_sets(pages: DataFrame, site: str, order: str, html: str = "html") -> DataFrame:
    """A row for each site of its pages in order: addresses (5), phones (3), handles (10), members (10), first person and description.

    Pages are read for their findings before they are shuffled; each kind is united, sorted and cut to a report's length.
    """
    h = F.col(html)
    found = pages.select(site, order, H.emails(h).alias("e"), H.phones(h).alias("p"), H.handles(h).alias("i"), contact_person(h).alias("c"), F.nullif(H.description(h), F.lit("")).alias("d"), team_members(h).alias("t"))
    each = lambda c, k: F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))), 1, k)
    first = lambda c: F.min_by(c, F.when(F.col(c).isNotNull(), F.col(order)))
    rows = found.groupBy(site).agg(each("e", 5).alias("emails"), each("p", 3).alias("phones"), each("i", 10).alias("instagram_handles"), first("c").alias("c"), first("d").alias("description"))
    member = found.select(site, order, F.posexplode("t").alias("k", "m")).withColumn("key", F.lower(F.coalesce(F.nullif(F.col("m.name"), F.lit("")), F.col("m.instagram"))))
    member = member.groupBy(site, "key").agg(F.min(F.struct(order, "k", "m")).alias("x")).withColumn("r", F.row_number().over(Window.partitionBy(site).orderBy(f"x.{order}", "x.k"))).filter("r <= 10")
    teams = member.groupBy(site).agg(F.transform(F.array_sort(F.collect_list(F.struct("r", "x.m"))), lambda x: x["m"]).alias("team"))
    out = rows.join(teams, site, "left")
    lead = F.get("team", F.lit(0))
    name = F.coalesce(F.col("c.name"), F.nullif(lead["name"], F.lit("")), F.lit(""))
    position = F.when(F.col("c").isNotNull(), F.col("c.position")).otherwise(F.coalesce(lead["position"], F.lit("")))
    return out.select(site, "emails", "phones", "instagram_handles", name.alias("contact_name"), F.when(name != "", position).otherwise("").alias("contact_position"), F.coalesce("description", F.lit("")).alias("description"), F.coalesce(F.transform("team", lambda m: m["name"]), F.array().cast("array<string>")).alias("team"))


def technology_summary(found: Column, generic_form: Column) -> Column:
    """Flags, first name of each category, lists and count of `category:name` technologies in their order."""
    of = lambda kind: F.transform(F.filter(found, lambda t: t.startswith(f"{kind}:")), lambda t: F.substring_index(t, ":", -1))
    one = lambda kind: F.coalesce(F.get(of(kind), F.lit(0)), F.lit(""))
    has = lambda kind: F.size(of(kind)) > 0
    return F.struct(
        has("crm").alias("has_crm"), one("crm").alias("crm_name"), has("pixel").alias("has_marketing_pixel"), F.to_json(of("pixel")).alias("pixel_types"), has("scheduling").alias("has_scheduling_tool"),
        one("scheduling").alias("scheduling_tool"), has("chat").alias("has_chat_widget"), one("chat").alias("chat_widget"), (has("form") | generic_form).alias("has_lead_form"), F.size(found).alias("tech_count"))


# texts and mails


def findings(text: Column) -> Column:
    """`hiring: ...` and `achievement: ...` of every match, by pattern, in lower case."""
    t = F.lower(F.coalesce(text, F.lit("")))
    found = lambda kind, patterns: F.transform(F.concat(*(F.regexp_extract_all(t, F.lit(p), F.lit(0)) for p in patterns)), lambda m: F.concat(F.lit(f"{kind}: "), m))
    return F.concat(found("hiring", HIRING), found("achievement", ACHIEVEMENTS))


def bounced_address(header: Column, status: Column, body: Column, own: list[str] = ()) -> Column:
    """The address a bounce is about: of the failed-recipients header, of the delivery status, else of the body by BOUNCES; own domains never."""
    domains = [d.replace(".", r"\.") for d in own]
    patterns = [p.replace("(?!", f"(?!{'|'.join([*domains, ''])}") for p in BOUNCES]
    got = [F.lower(F.trim(_found(body, f"(?is){p}"))) for p in patterns]
    never = "|".join([*NOT_BOUNCED, *domains])
    return F.coalesce(_found(header, f"({_ADDRESS})"), _found(status, rf"(?is)(?:Final|Original)-Recipient:.*?({_ADDRESS})"), *(F.when(~a.rlike(never), a) for a in got))


def ad_text(body: Column, cards: Column, title: Column, *others: Column) -> Column:
    """An ad's text: its body, else the first three cards' bodies, else its title, else the first other field that is filled."""
    filled = F.filter(F.slice(F.coalesce(cards, F.array().cast("array<string>")), 1, 3), lambda x: F.coalesce(x, F.lit("")) != "")
    return F.coalesce(F.nullif(F.trim(body), F.lit("")), F.when(F.size(filled) > 0, F.array_join(filled, " | ")), *(F.nullif(F.trim(c), F.lit("")) for c in (title, *others)), F.lit(""))


def advertisers(ads: DataFrame, order: str, texts: int = 10) -> DataFrame:
    """A row for each page_id of raw ads: united platforms and countries, first date, any active, summed mid spend, largest reach, first currency, first texts.

    Each distinct text of a page counts once, before a page's first `texts` of them are taken, so no page meets whole.
    """
    ads = ads.filter("page_id is not null")
    lo, hi = F.coalesce("spend_low", F.lit(0)), F.coalesce("spend_high", F.lit(0))
    united = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_set(c))))
    rows = ads.groupBy("page_id").agg(
        F.min_by("page_name", order).alias("page_name"), F.count(F.lit(1)).alias("ad_count"), united("platforms").alias("platforms"), united("countries").alias("countries"), F.bool_or("active").alias("is_active"),
        F.min("start").alias("first_ad_date"), F.nullif(F.round(F.sum(F.when(hi > 0, (lo + hi) / 2).otherwise(lo)), 2), F.lit(0)).alias("total_spend"), F.min_by("currency", F.when(F.col("currency").isNotNull(), F.col(order))).alias("currency"), F.nullif(F.max("reach_high"), F.lit(0)).alias("max_reach"),
    )
    each = ads.filter("text <> ''").groupBy("page_id", "text").agg(F.min(order).alias("o"))
    each = each.withColumn("r", F.row_number().over(Window.partitionBy("page_id").orderBy("o", "text"))).filter(F.col("r") <= texts)
    said = each.groupBy("page_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("r", "text"))), lambda x: x["text"]), " | ").alias("text"))
    return rows.join(said, "page_id", "left").withColumn("text", F.coalesce("text", F.lit("")))


# handles and addresses


def clean_handle(handle: Column) -> Column:
    """With @, in lower case; null where it isn't a handle."""
    h = F.lower(F.trim(handle))
    h = F.when(h.startswith("@"), h).otherwise(F.concat(F.lit("@"), h))
    return F.when(h.rlike(r"^@[a-z][a-z0-9_.]{2,29}$") & ~F.substring(h, 2, 40).isin(NOT_HANDLES), h)


def handles_of(personal: Column, company: Column) -> Column:
    """Sorted distinct valid handles of a person's and a company's cells."""
    return F.array_sort(F.array_distinct(F.array_compact(F.transform(F.array_union(F.array(null_if_sentinel(personal)), parse_list(company)), clean_handle))))


def handle_owner(handle: Column, person: Column, company: Column) -> Column:
    """personal, company, confidence: whether a valid handle contains the person's or company's name without spaces, of over three letters."""
    h = F.replace(clean_handle(handle), F.lit("@"))
    inside = lambda n: F.coalesce((F.length(n) > 3) & F.contains(h, n), F.lit(False))
    p = inside(F.replace(F.lower(null_if_sentinel(person)), F.lit(" ")))
    c = inside(F.translate(F.lower(null_if_sentinel(company)), " -_", ""))
    return F.struct(p.alias("personal"), c.alias("company"), F.when(p, 0.8).when(c, 0.7).otherwise(0.0).alias("confidence"))


def handle_waterfall(found: DataFrame, key: str, most: int = 20) -> DataFrame:
    """key, source, handles of found (key, rank, source, handle): those of the first source by rank that has a valid one, sorted, `most` at most."""
    rows = found.select(key, "rank", "source", clean_handle(F.col("handle")).alias("handle")).filter("handle is not null")
    best = rows.groupBy(key).agg(F.min(F.struct("rank", "source")).alias("x"))
    met = rows.join(best, key).filter(F.col("rank") == F.col("x.rank"))
    return met.groupBy(key).agg(F.min("x.source").alias("source"), F.slice(F.array_sort(F.collect_set("handle")), 1, most).alias("handles"))


def with_alternate(primary: Column, alternates: Column, new: Column) -> Column:
    """An address added in lower case to a person's others, unless it is there or the primary one in any case of letters."""
    key = lambda c: F.lower(F.trim(c))
    n, have = key(new), F.coalesce(alternates, F.array().cast("array<string>"))
    known = (n == key(primary)) | F.exists(have, lambda x: key(x) == n)
    return F.when((F.coalesce(n, F.lit("")) == "") | F.coalesce(known, F.lit(False)), have).otherwise(F.concat(have, F.array(n)))


def by_any_address(people: DataFrame, asked: DataFrame) -> DataFrame:
    """asked (email) with the primary address, as it is written, of the person who has it as primary or other one, in any case of letters; the primary one first."""
    every = people.select(F.col("email").alias("p"), F.posexplode(F.concat(F.array("email"), F.coalesce("alternates", F.array().cast("array<string>")))).alias("k", "a"))
    owner = every.groupBy(F.lower(F.trim("a")).alias("a")).agg(F.min(F.struct((F.col("k") > 0).alias("other"), "p")).alias("x"))
    return asked.join(owner, F.lower(F.trim("email")) == F.col("a"), "left").select("email", F.col("x.p").alias("primary_email"))


# people who are one


def by_domain(synthetic: DataFrame, real: DataFrame, suffixes: list[str], block: int = 3) -> DataFrame:
    """node, match of people without an address (node, name, company) whose name in normal form is that of one person alone whose address's domain contains the company.

    They meet on the name and the company's first letters, which the domain has somewhere, so a common name makes no pairs of different companies.
    """
    s = synthetic.select("node", matching_name(F.col("name"), suffixes).alias("_n"), F.lower(F.trim("company")).alias("_c")).filter(f"_n <> '' and length(_c) >= {block}").withColumn("_k", F.substring("_c", 1, block))
    domain = F.lower(F.split("email", "@")[1])
    r = real.filter(F.contains("email", F.lit("@"))).select(F.col("node").alias("match"), matching_name(F.col("name"), suffixes).alias("_n"), domain.alias("_d")).filter(~F.col("_d").isin(GENERIC_DOMAINS) & (F.length("_d") >= block))
    r = r.withColumn("_k", F.explode(F.array_distinct(F.transform(F.sequence(F.lit(1), F.length("_d") - block + 1), lambda i: F.substr("_d", i, F.lit(block))))))
    met = s.join(r, ["_n", "_k"]).filter(F.contains("_d", F.col("_c")))
    return met.groupBy("node").agg(F.min("match").alias("match"), F.count(F.lit(1)).alias("n")).filter("n = 1").select("node", "match")


def first_tier(candidates: DataFrame, key: str = "node") -> DataFrame:
    """The candidate of the first tier for each node; of several in one tier, the smallest match."""
    return candidates.groupBy(key).agg(F.min(F.struct("tier", "match")).alias("x")).select(key, "x.match", "x.tier")


# work that is left


def needing(df: DataFrame, column: str, always: bool = False) -> DataFrame:
    """Rows whose cell is missing; all of them where the column is, or where the step always runs."""
    return df if always or column not in df.columns else df.filter(null_if_sentinel(F.col(column).cast("string")).isNull())


def contacts_to_enrich(df: DataFrame, least: float = 0.3) -> DataFrame:
    """Rows without an address that is verified or looks like one, whose site was found with more confidence than `least`."""
    email = F.trim(F.coalesce("primary_email", F.lit("")))
    return df.filter(~(F.contains(email, F.lit("@")) & (F.length(email) > 5)) & (_blank(F.col("primary_email")) | ~F.coalesce("email_verified", F.lit(False))) & ~_blank(F.col("website_url")) & (F.col("search_confidence") > least))


def prospects(df: DataFrame, gone: list[DataFrame], key: str = "primary_email", order: str = "ord", most: int | None = None) -> DataFrame:
    """Rows with a valid address that none of `gone` (sent, bounced, not to be written to: one column each) has; the first `most` by order where a batch has a size."""
    k = F.lower(F.trim(F.col(key)))
    out = reduce(lambda left, g: left.join(small(g.select(F.lower(F.trim(F.col(g.columns[0]))).alias("_g")).filter("_g is not null").distinct()), k == F.col("_g"), "left_anti"), gone, df.filter(valid_email(F.col(key))))
    return out if most is None else out.orderBy(order).limit(most)


def with_profile_column(df: DataFrame, email: str = "email", url: str = "linkedin_url") -> DataFrame:
    """Profile addresses that stand in the address column move to their own."""
    is_profile = F.contains(F.lower(F.trim(F.coalesce(email, F.lit("")))), F.lit("linkedin.com/in/"))
    was = F.col(url) if url in df.columns else F.lit("")
    return df.withColumns({url: F.when(is_profile, F.col(email)).otherwise(was), email: F.when(is_profile, F.lit("")).otherwise(F.col(email))})


def appended(df: DataFrame, found: DataFrame, key: str, columns: list[str], needs: str) -> DataFrame:
    """df with columns of found (a row a key) where the first of them is missing and the needed cell is there, and `outcome`: kept, no_input, found or empty."""
    have = ~_blank(F.col(columns[0])) if columns[0] in df.columns else F.lit(False)
    right = found.select(F.col(key), F.lit(True).alias("_hit"), *(F.col(c).alias(f"_{c}") for c in columns))
    outcome = F.when(have, "kept").when(_blank(F.col(needs)), "no_input").when(F.col("_hit"), "found").otherwise("empty")
    met = df.join(small(right), key, "left").withColumn("outcome", outcome)
    cell = lambda c: F.when(F.col("outcome") == "found", F.col(f"_{c}")).otherwise(F.col(c) if c in df.columns else F.lit(None))
    return met.select(*(c for c in df.columns if c not in columns), *(cell(c).alias(c) for c in columns), "outcome")


def first_n(df: DataFrame, order: list[str], n: int, column: str) -> DataFrame:
    """df whose cells of a column are blank beyond the first n rows by order: a trial run's rest."""
    kept = df.orderBy(*order).limit(n).select(*order, F.lit(True).alias("_in"))
    return df.join(F.broadcast(kept), order, "left").withColumn(column, F.when(F.col("_in"), F.col(column))).drop("_in")


def statuses(df: DataFrame, *by: str) -> DataFrame:
    """by, n: how many rows ended how."""
    return df.groupBy(*(F.coalesce(b, F.lit("")).alias(b) for b in by)).agg(F.count(F.lit(1)).alias("n"))


def graph_status(people: DataFrame, edges: DataFrame, top: int = 10) -> DataFrame:
    """section, label, n: filled cells of people, their most frequent countries, and bands of edges' strengths (0 to 100), edges whose scores are apart by over 20, and those whose second score is the lower one by so much."""
    filled = people.agg(F.count(F.lit(1)).alias("people"), *(F.count_if(~_blank(F.col(c))).alias(c) for c in people.columns if c != "country"), F.count_if(~_blank(F.col("country"))).alias("country"))
    cells = filled.select(F.explode(F.array(*(F.struct(F.lit("filled").alias("section"), F.lit(c).alias("label"), F.col(c).alias("n")) for c in filled.columns))).alias("x")).select("x.*")
    places = people.filter(~_blank(F.col("country"))).groupBy(F.col("country").alias("label")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "label").limit(top).select(F.lit("country").alias("section"), "label", "n")
    band = F.when(F.col("v2") >= 70, "strong").when(F.col("v2") >= 40, "medium").when(F.col("v2") >= 10, "weak").otherwise("none")
    bands = edges.groupBy(band.alias("label")).agg(F.count(F.lit(1)).alias("n")).select(F.lit("strength").alias("section"), "label", "n")
    drop = F.col("v1") - F.col("v2")
    counts = edges.agg(F.count_if(F.abs(drop) > 20).alias("apart"), F.count_if(drop > 20).alias("dropped"))
    apart = counts.select(F.explode(F.array(*(F.struct(F.lit("strength").alias("section"), F.lit(c).alias("label"), F.col(c).alias("n")) for c in counts.columns))).alias("x")).select("x.*")
    return cells.unionByName(places).unionByName(bands).unionByName(apart)


# schemas and runs


def mapped(df: DataFrame, mapping: dict[str, str], phones: list[str] = (), lists: tuple[str, ...] = (), numbers: tuple[str, ...] = (), flags: tuple[str, ...] = (), dates: tuple[str, ...] = ()) -> DataFrame:
    """Target columns {target: source} of a table: names without emoji, in form KC and trimmed, lists parsed, numbers, flags and dates coerced, filled phone columns as one list."""
    clean = lambda c: F.java_method(F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), F.trim(F.regexp_replace(F.coalesce(c.cast("string"), F.lit("")), EMOJI, "")), F.lit(True))

    def one(target: str, source: str) -> Column:
        c = F.col(source)
        if target in lists:
            return parse_list(c.cast("string"))
        if target in numbers:
            return F.coalesce(null_if_sentinel(c.cast("string")).try_cast("double").cast("long"), F.lit(0))
        if target in flags:
            return F.coalesce(F.lower(F.trim(c.cast("string"))).isin("true", "1", "yes", "active"), F.lit(False))
        if target in dates:
            return F.coalesce(F.date_format(F.try_to_timestamp(c.cast("string")), "yyyy-MM-dd"), F.lit(""))
        return clean(c) if target == "page_name" else F.coalesce(c.cast("string"), F.lit(""))

    all_phones = F.array_compact(F.array(*(F.nullif(F.trim(F.col(p).cast("string")), F.lit("")) for p in phones))) if phones else F.array().cast("array<string>")
    return df.select(*(one(t, s).alias(t) for t, s in mapping.items() if s in df.columns), all_phones.alias("phones"))


def profile(df: DataFrame) -> DataFrame:
    """column, filled, rows: how many cells hold something, in one pass."""
    out = df.agg(F.count(F.lit(1)).alias("_rows"), *(F.count_if(~_blank(F.col(c))).alias(c) for c in df.columns))
    return out.select(F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).alias("filled"), F.col("_rows").alias("rows")) for c in df.columns))).alias("x")).select("x.*")


def run_log(log: DataFrame) -> DataFrame:
    """run_id, started, ended, n_done, n_failed, n_items of a log of outcomes (run_id, at, item, status)."""
    return log.groupBy("run_id").agg(F.min("at").alias("started"), F.max("at").alias("ended"), F.count_if(F.col("status") == "done").alias("n_done"), F.count_if(F.col("status") == "failed").alias("n_failed"), F.count_distinct("item").alias("n_items"))
