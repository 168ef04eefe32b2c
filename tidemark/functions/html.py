"""What pages say about contacts: addresses, phones, links, handles, technologies. Spark expressions over the page's text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import let, may_match

# Parts of addresses that belong to assets and samples, platforms' hosts, paths of contact pages, signatures.
NOT_ADDRESSES = ["example.com", "sentry", "wixpress", ".png", ".jpg", ".jpeg", ".gif", ".svg", ".webp", "@2x", "@3x"]
PLATFORMS = {"facebook": r"facebook\.com", "instagram": r"instagram\.com", "linkedin": r"linkedin\.com", "twitter": r"(?:twitter|x)\.com", "youtube": r"youtube\.com"}
CONTACT_PATHS = ["contact", "about", "team", "staff", "agents", "people"]
NOT_HANDLES = ["p", "reel", "reels", "explore", "stories", "accounts", "about", "share"]
SERVICES = ["residential", "commercial", "property management", "buying", "selling", "rental", "mortgage", "investment", "luxury", "first-time buyers", "relocation", "foreclosure", "short sale", "new construction"]
SIGNATURES = {
    "crm": {
        "hubspot": r"js\.hs-scripts\.com|js\.hsforms\.net|hbspt\.forms|hs-script-loader|hubspot\.com|_hsq\.push", "salesforce": r"salesforce\.com|force\.com|pardot\.com|sfdc", "followupboss": r"followupboss\.com|fub\.com|followup\.boss",
        "kvcore": r"kvcore\.com|platform\.kvcore|idx\.kvcore", "liondesk": r"liondesk\.com|ld\.link", "cinc": r"cincpro\.com|cinc\.com", "boomtown": r"boomtownroi\.com|boomtown\.com", "realgeeks": r"realgeeks\.com", "chime": r"chime\.me|chimecentral\.com",
        "zoho": r"zoho\.com|zohocdn\.com", "pipedrive": r"pipedrive\.com|pipedrivewebforms",
    },
    "pixel": {
        "meta_pixel": r"connect\.facebook\.net|fbq\s*\(|facebook-pixel|facebook\.com/tr|_fbq", "google_analytics": r"google-analytics\.com|googletagmanager\.com|gtag\s*\(|ga\s*\(\s*.create.|analytics\.js|gtm\.js",
        "google_ads": r"googleadservices\.com|google_conversion|googleads\.g\.doubleclick|gtag.*config.*AW-", "tiktok_pixel": r"analytics\.tiktok\.com|ttq\.track", "linkedin_insight": r"snap\.licdn\.com|linkedin\.com/px|_linkedin_data_partner_id", "hotjar": r"static\.hotjar\.com|hotjar\.com|hj\s*\(",
    },
    "scheduling": {"calendly": r"calendly\.com|assets\.calendly\.com", "acuity": r"acuityscheduling\.com|squareup\.com/appointments", "hubspot_meetings": r"meetings\.hubspot\.com|hs-meetings", "booksy": r"booksy\.com", "setmore": r"setmore\.com", "appointy": r"appointy\.com"},
    "chat": {
        "intercom": r"intercom\.io|widget\.intercom\.io|intercomcdn\.com|Intercom\s*\(", "drift": r"drift\.com|js\.driftt\.com|driftt\.com", "livechat": r"livechatinc\.com|cdn\.livechatinc\.com|__lc\.license", "tawk": r"tawk\.to|embed\.tawk\.to",
        "zendesk_chat": r"zopim\.com|zendesk\.com.*chat|static\.zdassets\.com", "freshchat": r"freshchat\.com|wchat\.freshchat\.com", "crisp": r"crisp\.chat|client\.crisp\.chat", "olark": r"olark\.com|static\.olark\.com", "hubspot_chat": r"js\.usemessages\.com|hubspot.*conversations",
    },
    "form": {"typeform": r"typeform\.com|embed\.typeform\.com", "jotform": r"jotform\.com|cdn\.jotfor\.ms", "wufoo": r"wufoo\.com", "gravity_forms": r"gravityforms|gform_", "contact_form_7": r"wpcf7|contact-form-7"},
    "idx": {"idx_broker": r"idxbroker\.com|idx-broker", "showcase_idx": r"showcaseidx\.com", "ihomefinder": r"ihomefinder\.com"},
}


def visible(html: Column) -> Column:
    """Text without scripts, styles and tags, white space squeezed."""
    bare = F.regexp_replace(F.coalesce(html, F.lit("")), r"(?is)<(script|style)\b.*?</\1\s*>", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(bare, r"(?s)<[^>]*>", " "), r"\s+", " "))


def emails(html: Column) -> Column:
    """Distinct addresses in lower case, sorted, without assets' and samples'."""
    found = F.array_distinct(F.transform(F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"), F.lit(0)), lambda x: F.lower(x)))
    return F.array_sort(F.filter(found, lambda e: ~e.rlike("|".join(x.replace(".", r"\.") for x in NOT_ADDRESSES))))


def phones(html: Column) -> Column:
    """Distinct US numbers of the visible text as 10 digits, sorted."""
    found = F.regexp_extract_all(visible(html), F.lit(r"(?:\+?1[\s.-]?)?\(?[0-9]{3}\)?[\s.-]?[0-9]{3}[\s.-]?[0-9]{4}"), F.lit(0))
    digits = F.transform(F.transform(found, lambda x: F.regexp_replace(x, "[^0-9]", "")), lambda d: F.when((F.length(d) == 11) & d.startswith("1"), F.substring(d, 2, 10)).otherwise(d))
    return F.array_sort(F.array_distinct(F.filter(digits, lambda d: F.length(d) == 10)))


def social_links(html: Column) -> Column:
    """Platform to its first link."""
    link = lambda host: F.regexp_extract(html, rf"""(?i)href=["'](https?://(?:www\.)?{host}/[^"'\s]+)""", 1)
    found = F.array(*(F.struct(F.lit(k).alias("k"), link(h).alias("v")) for k, h in PLATFORMS.items()))
    return F.map_from_entries(F.filter(found, lambda x: F.coalesce(x["v"], F.lit("")) != ""))


def handles(html: Column, most: int = 10) -> Column:
    """Distinct handles of instagram links, in lower case with @, sorted, `most` at most: a report's length."""
    found = F.transform(F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(r"(?i)instagram\.com/([A-Za-z0-9_.]{1,30})"), F.lit(1)), lambda x: F.lower(x))
    return F.slice(F.array_sort(F.array_distinct(F.transform(F.filter(found, lambda h: ~h.isin(NOT_HANDLES)), lambda h: F.concat(F.lit("@"), h)))), 1, most)


def links(html: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(r"""(?i)href=["']([^"'#\s]+)"""), F.lit(1)))


def contact_pages(html: Column, host: Column, most: int = 5) -> Column:
    """Links of the same site whose path names a contact page."""
    same = lambda u: F.when(u.startswith("http"), F.regexp_extract(F.lower(u), r"^https?://(?:www\.)?([^/?#]+)", 1) == host).otherwise(F.lit(True))
    return F.slice(F.array_sort(F.filter(links(html), lambda u: same(u) & F.lower(u).rlike("|".join(CONTACT_PATHS)))), 1, most)


def title(html: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_extract(F.coalesce(html, F.lit("")), r"(?is)<title[^>]*>(.*?)</title>", 1), r"\s+", " "))


def description(html: Column) -> Column:
    """The meta description, else the open-graph one, of 500 characters."""
    meta = lambda key: F.regexp_extract(F.coalesce(html, F.lit("")), rf"""(?is)<meta[^>]+(?:name|property)=["']{key}["'][^>]*content=["']([^"']*)""", 1)
    return F.substring(F.coalesce(F.nullif(meta("description"), F.lit("")), F.nullif(meta("og:description"), F.lit("")), F.lit("")), 1, 500)


def technologies(html: Column) -> Column:
    """Sorted `category:name` of each signature in the page."""
    def search(t: Column) -> Column:
        def hits(low: Column) -> Column:
            return F.array(*(F.when(may_match(low, p) & t.rlike(f"(?i){p}"), F.lit(f"{kind}:{name}")) for kind, names in SIGNATURES.items() for name, p in names.items()))

        return let(F.lower(t), hits)

    return F.array_sort(F.array_compact(let(F.coalesce(html, F.lit("")), search)))


# Forms of contact that no provider is named in.
FORMS = [
    r"<form[^>]*(?:contact|lead|inquiry|schedule|get-started|request)",
    r"""<form[^>]*id\s*=\s*["'][^"']*(?:contact|lead|inquiry)[^"']*["']""",
    r"""<form[^>]*class\s*=\s*["'][^"']*(?:contact|lead|inquiry)[^"']*["']""",
    r"""type\s*=\s*["']email["'][^>]*placeholder\s*=\s*["'][^"']*email""",
    r"""<input[^>]*name\s*=\s*["'](?:email|phone|name)["']""",
]


def generic_form(html: Column) -> Column:
    """Whether a page has a contact form of its own: one pass for all patterns."""
    return F.coalesce(F.lower(html).rlike("(?:" + ")|(?:".join(FORMS) + ")"), F.lit(False))


def lead_form(html: Column) -> Column:
    """Whether a page has a form of a known provider, or one of its own."""
    return F.exists(technologies(html), lambda t: t.startswith("form:")) | generic_form(html)


def services(html: Column) -> Column:
    """The services of SERVICES that a page's text names, in their order."""
    return F.array_compact(let(F.lower(visible(html)), lambda t: F.array(*(F.when(F.contains(t, F.lit(s)), F.lit(s)) for s in SERVICES))))
