"""Queries of scalar expressions over texts, pages and JSON cells."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import html as H
from ..functions import text as T
from .proxies import _pick, _sql_pick, read


def text_fold(spark, d):
    return read(spark, d, "documents").select("doc_id", F.md5(T.fold(F.col("text")).cast("binary")).alias("folded"))


def text_patterns(spark, d):
    t = T.fold(F.col("text"))
    return read(spark, d, "documents").select("doc_id", T.count_matching(t, [r"\bthe\b", r"\bund\b", r"\bque\b", r"cion", r"\d{3}"]).alias("n_patterns"), T.matches_any(t, ["licen[cs]e", r"\bidiot\b"]).alias("any_pattern"), F.regexp_count("text", F.lit(r"\?")).alias("questions"))


def text_domains(spark, d):
    u = F.col("url")
    return read(spark, d, "pages").select("page_id", T.url_domain(u).alias("domain"), T.normal_url(u).alias("normal"))


def text_names(spark, d):
    name = F.when(F.col("c_custkey") % 9 == 0, "n/a").when(F.col("c_custkey") % 4 == 0, F.concat(F.lit(" Dr  "), F.col("c_name"))).otherwise(F.col("c_name"))
    first, rest = T.name_parts(name)
    phone = F.concat(F.when(F.col("c_custkey") % 2 == 0, "1-").otherwise(""), F.lit("555 010 "), F.lpad((F.col("c_custkey") % 10000).cast("string"), 4, "0"), F.when(F.col("c_custkey") % 5 == 0, "9").otherwise(""))
    return read(spark, d, "customer").select("c_custkey", first.alias("first_name"), rest.alias("last_name"), T.us_phone(phone).alias("phone"), T.invalid_company(F.when(F.col("c_custkey") % 7 == 0, "--").otherwise(F.col("c_name"))).alias("invalid"))


LIST_CELLS = ["['a', 'b']", '["x","y"]', " p; q ,r", "[]", None, """["it's", "b"]""", r"""['O\'Brien', "it's, ok", 'say "hi"']""", "[['a', 'b'], None, 1, True]", "('one',)", "[it's, b]"]
LISTS = ["a|b", "x|y", "p|q|r", "", "", "it's|b", """O'Brien|it's, ok|say "hi\"""", '["a","b"]|1|true', "one", "it's|b"]


def text_lists(spark, d):
    """Cells with JSON, Python literals, separated and broken lists."""
    cell = _pick(LIST_CELLS, F.col("event_id") % len(LIST_CELLS))
    return read(spark, d, "events").select("event_id", F.array_join(T.parse_list(cell), "|").alias("items"), F.get_json_object("props", "$.k").cast("long").alias("k"))


def text_times(spark, d):
    k = F.col("o_orderkey")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    cell = F.when(k % 4 == 0, F.unix_timestamp(F.col("o_orderdate").cast("timestamp")).cast("string")).when(k % 4 == 1, day).when(k % 4 == 2, F.concat(day, F.lit("T00:00:00Z"))).otherwise("soon")
    return read(spark, d, "orders").select("o_orderkey", T.parse_time(cell).alias("at"))


def html_contacts(spark, d):
    h = F.col("html")
    return read(spark, d, "pages").select("page_id", F.array_join(H.emails(h), ",").alias("emails"), F.array_join(H.phones(h), ",").alias("phones"), H.title(h).alias("title"), F.size(H.links(h)).alias("n_links"))


def html_sites(spark, d):
    h = F.col("html")
    return read(spark, d, "pages").select("page_id", F.array_join(H.contact_pages(h, T.url_domain(F.col("url"))), ",").alias("contact_pages"), F.array_join(H.technologies(h), ",").alias("technologies"), F.array_join(H.handles(h), ",").alias("handles"), F.array_join(F.map_keys(H.social_links(h)), ",").alias("platforms"), F.array_join(H.services(h), ",").alias("services"))


def html_forms(spark, d):
    """Pages as they are, and with forms of several kinds beside their text."""
    k = F.col("page_id")
    form = _pick(FORM_CELLS, k % len(FORM_CELLS))
    h = F.concat(F.coalesce("html", F.lit("")), F.coalesce(form, F.lit("")))
    return read(spark, d, "pages").select("page_id", H.generic_form(F.col("html")).alias("own"), H.generic_form(h).alias("generic"), H.lead_form(h).alias("lead"))


FORM_CELLS = ['<FORM action="/Contact-us">', '<form id = "my-lead-1">', "<form class='x inquiry y'>", '<input type="email" size=3 placeholder="Your Email">', "<input class=x name='phone'>", '<form action="/search"><input name="q">', None, '<script src="https://x.typeform.com/a.js">']
_SIGNATURES = ", ".join(f"CASE WHEN regexp_matches(h, '(?i){p}') THEN '{kind}:{name}' END" for kind, names in H.SIGNATURES.items() for name, p in names.items())
_PLATFORMS = ", ".join(f"CASE WHEN regexp_matches(h, '(?i)href=[\"'']https?://(?:www\\.)?{host}/[^\"''\\s]+') THEN '{name}' END" for name, host in H.PLATFORMS.items())
_VISIBLE = "trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(h, '(?is)<script\\b.*?</script\\s*>', ' ', 'g'), '(?is)<style\\b.*?</style\\s*>', ' ', 'g'), '(?s)<[^>]*>', ' ', 'g'), '\\s+', ' ', 'g'))"
_SERVICES = ", ".join(f"CASE WHEN contains(lower({_VISIBLE}), '{x}') THEN '{x}' END" for x in H.SERVICES)
_H = "WITH p AS (SELECT page_id, coalesce(html, '') AS h, nullif(regexp_extract(lower(trim(url)), '^(?:[a-z][a-z0-9+.-]*://)?(?:www\\.)?([^/?#]*)', 1), '') AS host FROM pages)"
_LINKS = "list_distinct(regexp_extract_all(h, '(?i)href=[\"'']([^\"''#\\s]+)', 1))"
_FOLD = "strip_accents(lower(coalesce(text, '')))"
QUERIES = {f.__name__: f for f in (text_fold, text_patterns, text_domains, text_names, text_lists, text_times, html_contacts, html_sites, html_forms)}
_FORM = lambda h: "(" + " OR ".join("regexp_matches(lower(%s), '%s')" % (h, p.replace("'", "''")) for p in H.FORMS) + ")"
_PROVIDER = " OR ".join(f"regexp_matches(h, '(?i){p}')" for p in H.SIGNATURES["form"].values())
SQL = {
    "html_forms": f"WITH p AS (SELECT page_id, coalesce(html, '') AS own, coalesce(html, '') || coalesce({_sql_pick(FORM_CELLS, f'page_id % {len(FORM_CELLS)}')}, '') AS h FROM pages) SELECT page_id, {_FORM('own')} AS own, {_FORM('h')} AS generic, {_FORM('h')} OR {_PROVIDER} AS lead FROM p",
    "html_contacts": f"""{_H}, q AS (SELECT *, list_transform(regexp_extract_all({_VISIBLE}, '(?:\\+?1[\\s.-]?)?\\(?[0-9]{{3}}\\)?[\\s.-]?[0-9]{{3}}[\\s.-]?[0-9]{{4}}'), lambda x: regexp_replace(x, '[^0-9]', '', 'g')) AS d FROM p)
  SELECT page_id, array_to_string(list_sort(list_filter(list_distinct(list_transform(regexp_extract_all(h, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{{2,}}'), lambda x: lower(x))), lambda e: NOT regexp_matches(e, '{"|".join(x.replace(".", "[.]") for x in H.NOT_ADDRESSES)}'))), ',') AS emails,
  array_to_string(list_sort(list_distinct(list_filter(list_transform(d, lambda x: CASE WHEN length(x) = 11 AND x[1] = '1' THEN x[2:] ELSE x END), lambda x: length(x) = 10))), ',') AS phones, trim(regexp_replace(regexp_extract(h, '(?is)<title[^>]*>(.*?)</title>', 1), '\\s+', ' ', 'g')) AS title, len({_LINKS}) AS n_links FROM q""",
    "html_sites": f"""{_H} SELECT page_id, array_to_string(list_sort(list_filter({_LINKS}, lambda u: (CASE WHEN starts_with(u, 'http') THEN coalesce(regexp_extract(lower(u), '^https?://(?:www\\.)?([^/?#]+)', 1) = host, FALSE) ELSE TRUE END) AND regexp_matches(lower(u), '{"|".join(H.CONTACT_PATHS)}')))[1:5], ',') AS contact_pages,
  array_to_string(list_sort(list_filter([{_SIGNATURES}], lambda x: x IS NOT NULL)), ',') AS technologies,
  array_to_string(list_sort(list_distinct(list_transform(list_filter(list_transform(regexp_extract_all(h, '(?i)instagram\\.com/([A-Za-z0-9_.]{{1,30}})', 1), lambda x: lower(x)), lambda x: NOT list_contains([{", ".join(f"'{x}'" for x in H.NOT_HANDLES)}], x)), lambda x: '@' || x)))[1:10], ',') AS handles, array_to_string(list_filter([{_PLATFORMS}], lambda x: x IS NOT NULL), ',') AS platforms, array_to_string(list_filter([{_SERVICES}], lambda x: x IS NOT NULL), ',') AS services FROM p""",
    "text_fold": f"SELECT doc_id, md5({_FOLD}) AS folded FROM documents",
    "text_patterns": f"SELECT doc_id, CAST(regexp_matches(t, '\\bthe\\b') AS INT) + CAST(regexp_matches(t, '\\bund\\b') AS INT) + CAST(regexp_matches(t, '\\bque\\b') AS INT) + CAST(regexp_matches(t, 'cion') AS INT) + CAST(regexp_matches(t, '\\d{{3}}') AS INT) AS n_patterns, regexp_matches(t, 'licen[cs]e|\\bidiot\\b') AS any_pattern, length(regexp_replace(text, '[^?]', '', 'g')) AS questions FROM (SELECT *, {_FOLD} AS t FROM documents)",
    "text_domains": "SELECT page_id, nullif(regexp_extract(lower(trim(url)), '^(?:[a-z][a-z0-9+.-]*://)?(?:www\\.)?([^/?#]*)', 1), '') AS domain, regexp_replace(regexp_replace(regexp_replace(lower(trim(url)), '^https?://', ''), '^www\\.', ''), '/+$', '') AS normal FROM pages",
    "text_names": "SELECT c_custkey, CASE WHEN c_custkey % 9 = 0 THEN '' WHEN c_custkey % 4 = 0 THEN 'Dr' ELSE split_part(c_name, ' ', 1) END AS first_name, CASE WHEN c_custkey % 9 = 0 THEN '' WHEN c_custkey % 4 = 0 THEN c_name ELSE split_part(c_name, ' ', 2) END AS last_name, CASE WHEN c_custkey % 5 = 0 THEN CASE WHEN c_custkey % 2 = 0 THEN '1-' ELSE '' END || '555 010 ' || lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0') || '9' ELSE '+1 (555) 010-' || lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0') END AS phone, c_custkey % 7 = 0 AS invalid FROM customer",
    "text_lists": f"SELECT event_id, {_sql_pick(LISTS, f'event_id % {len(LISTS)}')} AS items, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events",
    "text_times": "SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN o_orderdate WHEN 3 THEN NULL ELSE date_trunc('day', o_orderdate) END AS at FROM orders",
}
