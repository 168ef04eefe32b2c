"""Rules on rows that hit them: the test tables lack their vocabulary."""

import datetime as dt
import json
import re

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.functions import categories as C
from tidemark.functions import html as H
from tidemark.functions import patterns as P
from tidemark.functions import text as T
from tidemark.operators import ads, contacts, graph, joins, master, outreach
from tidemark.plans import icp
from tidemark.streaming import jobs

PAGE = "page_id long, page_name string, page_category string, ad_texts_combined string, dominant_cta string, dominant_dest string, link_urls string, distinct_ctas int, domains array<string>, share_message double, share_call double, share_form double, share_web double, active_ads long, always_on_share double, new_ads_30d long, page_like_count long"


def page(spark, **kw):
    row = dict(page_id=1, page_name="Plain Co", page_category="", ad_texts_combined="", dominant_cta="LEARN_MORE", dominant_dest="", link_urls="", distinct_ctas=1, domains=[], share_message=0.0, share_call=0.0, share_form=0.0, share_web=1.0, active_ads=0, always_on_share=0.0, new_ads_30d=0, page_like_count=0)
    return spark.createDataFrame([tuple((row | kw).values())], PAGE)


@pytest.mark.parametrize(("change", "reason"), [
    ({"share_message": 0.10}, "MESSAGE"), ({"share_message": 0.09}, "NO_SIGNAL_DROP"), ({"share_call": 0.10}, "CALL"), ({"share_form": 0.20}, "NO_SIGNAL_DROP"), ({"share_form": 0.20, "ad_texts_combined": "We'll call you"}, "FORM"), ({"share_form": 0.40}, "FORM"),
    ({"dominant_cta": "SHOP_NOW", "ad_texts_combined": "$20, 50% off, free shipping"}, "TRANSACTIONAL_DROP"), ({"dominant_cta": "SHOP_NOW", "link_urls": "https://a.example/cart"}, "TRANSACTIONAL_DROP"), ({"dominant_cta": "SHOP_NOW", "link_urls": "https://checkoutinn.example/about", "share_call": 0.5}, "CALL"),
    ({"ad_texts_combined": "$20 50% off promo code", "share_message": 0.0}, "TRANSACTIONAL_DROP"), ({"page_name": "Lake Realty"}, "RESCUED"), ({"page_name": "Lake Realty", "dominant_cta": "SHOP_NOW"}, "NO_SIGNAL_DROP"),
    ({"dominant_dest": "WEB", "ad_texts_combined": "Free consultation. Do you qualify?"}, "WEB_CONSULT"), ({"dominant_dest": "WEB", "ad_texts_combined": "Evaluación: verifica tu cita"}, "WEB_CONSULT"),
])
def test_gate(spark, change, reason):
    assert ads.gate(page(spark, **change)).first().gate_reason == reason


def test_pages_without_an_address_are_no_web_consults(spark):
    ad = "ad_id long, page_id long, page_name string, page_category string, cta string, link_url string, platforms array<string>, start timestamp, end timestamp, active boolean, text string, title string, description string, images int, videos int, cards int, likes long, collation_id long"
    row = lambda k, url: (k, k, "Plain Co", "", "LEARN_MORE", url, ["FACEBOOK"], dt.datetime(1998, 1, 1), None, True, "Free consultation. Do you qualify?", "", None, 0, 0, 0, 0, 1)
    raw = spark.createDataFrame([row(1, None), row(2, "https://a.example/about"), row(3, "https://a.example/cart")], ad)
    found = ads.clusters(ads.scores(ads.gate(ads.pages(ads.normalize(raw, "1998-09-01 00:00:00"), "1998-09-01 00:00:00", extended=True))))
    assert {r.page_id: (r.gate_reason, r.behavioral_cluster) for r in found.collect()} == {1: ("NO_SIGNAL_DROP", "uncategorized"), 2: ("WEB_CONSULT", "web_consult"), 3: ("NO_SIGNAL_DROP", "uncategorized")}


AD = "ad_id long, page_id long, page_name string, page_category string, cta string, link_url string, platforms array<string>, start timestamp, end timestamp, active boolean, text string, title string, description string, images int, videos int, cards int, likes long, collation_id long"


def gated_by_whole_texts(spark, texts):
    """What the gate finds on a page of ads with these texts, titles and descriptions."""
    rows = [(k, 1, "Plain Co", "", "LEARN_MORE", None, ["FACEBOOK"], dt.datetime(1998, 1, 1), None, True, *t, 0, 0, 0, 0, 1) for k, t in enumerate(texts)]
    as_of = "1998-09-01 00:00:00"
    found = ads.gate(ads.pages(ads.normalize(spark.createDataFrame(rows, AD).repartition(3), as_of), as_of, extended=True, whole=True)).first()
    return found.has_followup, found.has_consult, found.has_qualification, found.price_count, found.gate_reason


@pytest.mark.parametrize(("texts", "want"), [
    ([("plain", "", None)] * 40 + [("We will call you", "", None)], (True, False, False, 0, "NO_SIGNAL_DROP")), ([("p" * 9000 + " te contactamos", "", None)], (True, True, True, 0, "NO_SIGNAL_DROP")), ([("plain", "p" * 900 + " Evaluación", "p" * 900 + " coupon")] * 30, (False, True, True, 1, "NO_SIGNAL_DROP")),
    ([("", None, None), (None, "$20", "coupon"), ("$30", "50% off", "")], (False, False, False, 3, "TRANSACTIONAL_DROP")), ([("buy", "now", None), ("buy", "", "now"), ("now", "buy", "")], (False, False, False, 0, "NO_SIGNAL_DROP")),
])
def test_gate_reads_whole_texts_of_all_ads(spark, texts, want):
    assert gated_by_whole_texts(spark, texts) == want


def test_gate_patterns_match_within_one_text():
    """Ads are searched one by one, so no pattern may match the bar that joins texts."""
    for p in [*P.FOLLOW_UP, *P.CONSULT, *P.QUALIFICATION, *P.PRICES]:
        assert not re.search(r"(?<!\\)\.|\[\^|\\[WSD]|\\\|", p)


def orders(spark, path, rows):
    """Orders of which the plans make ads: key and customer."""
    spark.createDataFrame([(k, c, "O", 1.0, dt.datetime(1998, 1, 1), "1-URGENT") for k, c in rows], "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string").write.parquet(f"{path}/orders.parquet")
    return str(path)


def test_icp_gate_reads_texts_after_the_twentieth(spark, tmp_path):
    path = orders(spark, tmp_path, [(4 * k + 1, 7) for k in range(24)] + [(99, 7)])  # the last one alone says 'te contactamos'
    row = icp.icp_gate(spark, path).first()
    assert (row.has_followup, row.has_consult, row.price_count) == (True, True, 0)


def test_icp_gate_frequencies_read_texts_after_the_twentieth(spark, tmp_path):
    path = orders(spark, tmp_path, [(12 * k, 3) for k in range(24)] + [(291, 3)])  # a shop's page, but for the last one: 'Do you qualify?'
    assert [tuple(r) for r in icp.icp_gate_frequencies(spark, path).collect()] == [("MESSAGE", 1, 100.0)]


def scored_by_whole_texts(spark, texts):
    """The page of ads with these texts, titles and descriptions, scored and in its cluster."""
    rows = [(k, 1, "Plain Co", "", "LEARN_MORE", None, ["FACEBOOK"], dt.datetime(1998, 1, 1), None, True, *t, 0, 0, 0, 0, 1) for k, t in enumerate(texts)]
    as_of = "1998-09-01 00:00:00"
    return ads.clusters(ads.scores(ads.gate(ads.pages(ads.normalize(spark.createDataFrame(rows, AD).repartition(3), as_of), as_of, extended=True, whole=True)))).first()


TOLD = ["Evaluación: llámanos hoy. Call now?", "We will get back to you. Step 3, get started", "Speak with an advisor on insurance", "Our services: we offer a quote. Do you qualify?", "Check your credit score? Apply today"]


@pytest.mark.parametrize("texts", [
    [("plain", "", None)] * 30 + [(t, "", None) for t in TOLD], [("p" * 9000 + " " + t, "", None) for t in TOLD], [("", "p" * 900 + " " + t, t) for t in TOLD] * 9, [("\tplain", None, None), ("", "", ""), ("a | b\n\n", "c", "d ")], [(None, None, None)],
])
def test_scores_of_whole_texts_are_those_of_all_texts_joined(spark, texts):
    joined = " | ".join(x for t in texts for x in t if x)
    names = ["exp_questions", "exp_qualification", "exp_consult", "exp_followup", "exp_multistep", "imp_service_breadth", "imp_advisor", "imp_regulated", "urgency_immediacy", "urgency_qualification", "multi_funnel", "junk_risk"]
    got, want = scored_by_whole_texts(spark, texts), ads.clusters(ads.scores(ads.gate(page(spark, ad_texts_combined=joined)))).first()
    assert [got[n] for n in names] == [want[n] for n in names]


def test_clusters_read_whole_texts_of_all_ads(spark):
    row = scored_by_whole_texts(spark, [("plain", "", None)] * 30 + [(f"{w}: a text of its own, of over twenty characters", "", None) for w in ("movie", "trailer", "episode", "drama", "novel")])
    assert row.junk_risk and row.multi_funnel
    assert not scored_by_whole_texts(spark, [(f"the same text of over twenty characters | short {k}", "", None) for k in range(30)]).multi_funnel


def test_patterns_of_scores_match_within_one_text():
    for p in sum((*ads.ANY_OF.values(), *ads.HOW_MANY.values(), *ads.HOW_MANY_ACCENTED.values()), []):
        assert not re.search(r"(?<!\\)\.|\[\^|\\[WSD]|\\\|", p)


def test_icp_scores_read_texts_after_the_twentieth(spark, tmp_path):
    path = orders(spark, tmp_path, [(12 * k, 3) for k in range(24)] + [(291, 3)])  # the last one alone says 'Do you qualify? Apply now and we will contact you'
    row = icp.icp_scores(spark, path).first()
    assert (row.urgency_immediacy, row.urgency_qualification, row.exp_questions, row.exp_qualification, row.exp_consult, row.exp_followup) == (2, 5, 1, 2, 2, 2)


def test_icp_top_per_cluster_reads_texts_after_the_twentieth(spark, tmp_path):
    path = orders(spark, tmp_path, [(12 * k, 3) for k in range(24)] + [(291, 3)])  # a shop's page, but for the last one: 'Do you qualify?'
    assert [tuple(r) for r in icp.icp_top_per_cluster(spark, path).collect()] == [("message_first", 3, 1)]


@pytest.mark.parametrize(("change", "column", "value"), [
    ({"active_ads": 100}, "money_ad_volume", 14), ({"active_ads": 5000}, "money_ad_volume", 14), ({"active_ads": 10}, "money_ad_volume", 7), ({"new_ads_30d": 10}, "money_velocity", 6), ({"page_like_count": 99_999}, "money_scale", 10), ({"always_on_share": 0.99}, "money_always_on", 14),
    ({"share_message": 1.0}, "urgency_direct", 25), ({"share_message": 0.2, "share_call": 0.1}, "urgency_direct", 10), ({"ad_texts_combined": "Call now! Today only, last chance"}, "urgency_immediacy", 8), ({"ad_texts_combined": "Llámanos"}, "urgency_immediacy", 0),
    ({"ad_texts_combined": "a? b? c?"}, "exp_questions", 2), ({"distinct_ctas": 3, "share_message": 0.1, "share_form": 0.1}, "exp_complexity", 4), ({"dominant_dest": "CALL"}, "imp_conv_entry", 6), ({"dominant_cta": "CALL_NOW"}, "imp_generic_cta", 4),
    ({"page_category": "Lawyer & Law Firm"}, "imp_regulated", 2), ({"ad_texts_combined": "habla con un asesor"}, "imp_advisor", 4),
])
def test_scores(spark, change, column, value):
    assert ads.scores(ads.gate(page(spark, **change))).first()[column] == value


@pytest.mark.parametrize(("change", "cluster"), [({"share_message": 0.2}, "message_first"), ({"share_call": 0.2}, "call_first"), ({"share_form": 0.3}, "form_first"), ({"share_form": 0.25}, "uncategorized"), ({"share_form": 0.25, "ad_texts_combined": "te llamamos"}, "form_first")])
def test_clusters(spark, change, cluster):
    assert ads.clusters(ads.scores(ads.gate(page(spark, **change)))).first().behavioral_cluster == cluster


def test_junk_and_funnels(spark):
    row = ads.clusters(ads.scores(ads.gate(page(spark, ad_texts_combined="watch this movie trailer", share_message=0.1, share_call=0.1)))).first()
    assert row.junk_risk and row.multi_funnel


@pytest.mark.parametrize(("cta", "url", "platforms", "want"), [("contact_us", None, [], "MESSAGE"), (None, "https://wa.me/1", [], "MESSAGE"), (None, None, ["MESSENGER"], "MESSAGE"), (None, None, ["MESSENGER", "FACEBOOK"], "WEB"), ("CALL", None, [], "CALL"), (None, "tel:1", [], "CALL"), (None, "https://x.example/get-quote", None, "FORM"), ("LEARN_MORE", "https://x.example", None, "WEB")])
def test_destination(spark, cta, url, platforms, want):
    df = spark.createDataFrame([(cta, url, platforms)], "c string, u string, p array<string>")
    assert df.select(ads.destination(F.col("c"), F.col("u"), F.col("p"))).first()[0] == want


def one(spark, value, expression, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(expression(F.col("x")).alias("y")).first().y


@pytest.mark.parametrize(("cell", "want"), [("['a', 'b']", ["a", "b"]), ('["x","y"]', ["x", "y"]), ("a; b,c", ["a", "b", "c"]), ("[]", []), ("nan", []), (None, []), ("solo", ["solo"])])
def test_lists(spark, cell, want):
    assert one(spark, cell, T.parse_list) == want


def test_text(spark):
    assert one(spark, "Evaluación ÑANDÚ", T.fold) == "evaluacion nandu"
    assert one(spark, " N/A ", T.null_if_sentinel) is None
    assert one(spark, "WWW.Acme.example/x", T.url_domain) == "acme.example" and one(spark, "", T.url_domain) is None
    assert one(spark, "1 (555) 010-2345", T.us_phone) == "+1 (555) 010-2345" and one(spark, "12", T.us_phone) == "12"
    assert one(spark, "A@B.example", T.email_domain) == "b.example" and one(spark, "none", T.email_domain) is None
    assert one(spark, "1704067200", T.parse_time) == dt.datetime(2024, 1, 1) and one(spark, "soon", T.parse_time) is None
    assert one(spark, "🎉", T.invalid_company) and not one(spark, "Ñu 1", T.invalid_company)


def test_pages(spark):
    html = """<html><head><title>A  B</title><meta name="description" content="Homes"></head><script>x@y.zz</script>
    <a href="mailto:Ann@Lake.example">m</a> logo@2x.png (555) 010-2345 or 1-555-010-2345 <a href="https://instagram.com/lake.homes">i</a><a href="/contact">c</a><a href="https://other.example/team">t</a><script>fbq('x')</script>"""
    row = spark.createDataFrame([(html,)], "h string").select(H.emails(F.col("h")).alias("e"), H.phones(F.col("h")).alias("p"), H.handles(F.col("h")).alias("a"), H.title(F.col("h")).alias("t"), H.description(F.col("h")).alias("d"), H.technologies(F.col("h")).alias("k"), H.contact_pages(F.col("h"), F.lit("lake.example")).alias("c"), H.social_links(F.col("h")).alias("s")).first()
    assert row.e == ["ann@lake.example", "x@y.zz"] and row.p == ["5550102345"] and row.a == ["@lake.homes"] and row.t == "A B" and row.d == "Homes" and row.k == ["pixel:meta_pixel"] and row.c == ["/contact"] and row.s == {"instagram": "https://instagram.com/lake.homes"}


def test_deduplicate_is_sequential(spark):
    df = spark.createDataFrame([(1, "a", "m@x", None), (2, "a", "m@x", "u"), (3, "b", "m@x", "http://www.u/"), (4, "c", "", "U"), (5, "d", "", None), (6, "e", None, None)], "ord long, page_name string, primary_email string, website_url string")
    assert sorted(r.ord for r in master.deduplicate(df, "ord").collect()) == [2, 5, 6]


def test_update_and_waterfall(spark):
    m = spark.createDataFrame([("a", "1", None), ("b", None, "x")], "k string, p string, q string")
    new = spark.createDataFrame([("a", " ", "z", 1, "n"), ("a", "9", "", 2, None)], "k string, p string, q string, o int, extra string")
    assert {tuple(r) for r in joins.update(m, new, "k", "o").collect()} == {("a", "9", None, None), ("b", None, "x", None)}


@pytest.mark.parametrize(("n", "days", "want"), [(0, 1, 0), (1, 400, 1), (5, 10, 5), (13, 100, 5), (50, 200, 7), (51, 1, 10)])
def test_strength(spark, n, days, want):
    assert spark.range(1).select(graph.strength_v0(F.lit(n), F.lit(days))).first()[0] == want


def test_identity_and_paths(spark):
    syn = spark.createDataFrame([("li://1", "ann lee", "Acme"), ("li://2", "bob ray", "Acme Inc"), ("li://3", "cy", None)], "node string, name string, company string")
    real = spark.createDataFrame([("ann@a", "ann lee", None), ("bob@a", "bob ray", "acme"), ("bob@b", "bob ray", "Other"), ("cy@a", "cy", "x"), ("cy@b", "cy", "y")], "node string, name string, company string")
    assert {tuple(r) for r in graph.identity(syn, real).collect()} == {("li://1", "ann@a", 1), ("li://2", "bob@a", 2)}


def test_warm_up_keeps_state(spark, tmp_path):
    schema = "handle string, kind string, post string, ord int"
    rows = [("@a", "advance", None, k) for k in range(9)] + [("@a", "like", "p1", 20), ("@a", "like", "p1", 21), ("@b", "comment", "p1", 1), ("@b", "error", None, 2), ("@a", "like", "p2", 22)]
    src, out, marks = (str(tmp_path / x) for x in ("in", "out", "marks"))
    for part in (rows[:5] + rows[9:10], rows[5:]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(src)
        jobs.keep_updates(jobs.warm_up(jobs.landed(spark, src, schema)), out, marks)
    got = {r.handle: tuple(r)[1:] for r in jobs.last_updates(spark, out, ["handle"]).collect()}
    assert got == {"@a": ("in_progress", 7, 2, 0, 0), "@b": ("pending", 0, 0, 1, 1)}
    assert jobs.fold(pd.DataFrame({"kind": ["advance"] * 9, "post": [None] * 9}), (0, [], [], 0))[0] == 7


def test_ranks_go_on_over_scores(spark):
    df = spark.createDataFrame([(k, float(k * 7 % 5)) for k in range(60)] + [(100, None)], "page_id long, total_score double").repartition(5)
    want = {r: i + 1 for i, r in enumerate(sorted((p for p, _ in ((k, k) for k in range(60))), key=lambda k: (-(k * 7 % 5), k)))} | {100: 61}
    assert {r.page_id: r["rank"] for r in ads.ranked(df).collect()} == want


def test_budget_over_ranges(spark):
    """Rows tie in the order's first column, costs may be zero, and a null comes first."""
    data = [(k % 40 if k else None, k, float(k * 13 % 9)) for k in range(300)]
    order = sorted(data, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    want, spent = {}, 0.0
    for _, k, c in order:
        if spent < 200:
            want[k] = spent
        spent += c
    df = spark.createDataFrame(data, "day long, k long, cost double").repartition(4)
    got = {r.k: r.spent_before for r in outreach.within_budget(df, "cost", 200.0, ["day", "k"], ranges=16).collect()}
    assert got == want


def test_two_connectors_a_domain_are_enough(spark):
    edges = spark.createDataFrame([("me", f"p{k}@x.y", 10 - k % 3) for k in range(9)], "src string, dst string, n long")
    targets = spark.createDataFrame([(f"p{k}@x.y",) for k in (0, 1, 20)], "target string")
    best = {}
    for r in sorted(graph.by_company(edges, "me", targets).collect(), key=lambda r: (r.target, -r.n, r.connector)):
        best.setdefault(r.target, r.connector)
    assert best == {"p0@x.y": "p3@x.y", "p1@x.y": "p0@x.y", "p20@x.y": "p0@x.y"}


def test_patterns_are_tried_only_where_their_words_occur(spark):
    assert T.literals(r"\bsell(ing)?\s*(your|my)?\s*homes?\b") == [["home", "sell"]] and T.literals(r"a\.com|[xy]+z{2}|\$\d+") == [["a.com"], [], ["$"]]
    plan = spark.createDataFrame([("x",)], "x string").select(C.first_matched(F.col("x"), {"a": [r"\bhome\b"]}))._jdf.queryExecution().toString()
    assert "Contains" in plan or "contains" in plan


@pytest.mark.parametrize("table", [C.INTENTS, C.TRADES, C.SECTORS])
def test_words_of_patterns_lose_no_match(spark, table):
    texts = ["Selling your HOUSE? A free home valuation", "Ready to \u017fell, \u212aitchen remodel", "L\u0130ST\u0131NG my home", "parent barrat", "", "HVAC and AC repair; bed bug", "real estate law firm PC", "\u00c9cole, m\u00e9dical"]
    df = spark.createDataFrame([(t,) for t in [*texts, None]], "x string")
    counts = lambda ps: sum((F.regexp_count("x", F.lit(C.FLAGS + p)) for p in ps), F.lit(0))
    plain = df.select("x", *(counts(ps).alias(k) for k, ps in table.items())).collect()
    found = {r.x: (r.c, r.f) for r in df.select("x", C.match_counts(F.col("x"), table).alias("c"), C.first_matched(F.col("x"), table).alias("f")).collect()}
    for r in plain:
        assert [c.n or 0 for c in found[r.x][0]] == [r[k] or 0 for k in table] and found[r.x][1] == next((k for k in table if r[k]), None)


def test_a_snapshot_is_read_once(spark):
    raw = spark.createDataFrame([(1, "{'body': 'it is', 'cards': ['x', 'y']}")], "ad_id long, snapshot string").select("*", *(F.lit(None).cast(k).alias(c) for c, k in {"page_id": "long", "page_name": "string", "page_category": "string", "cta_type": "string", "link_url": "string", "publisher_platform": "string", "start_date": "string", "end_date": "string", "is_active": "boolean", "page_like_count": "long", "collation_id": "int"}.items()))
    out = ads.normalize(ads.from_snapshots(raw), "1998-09-01 00:00:00")
    assert out._jdf.queryExecution().optimizedPlan().toString().count("from_json(StructField(cta_type") == 1
    assert (out.first().text, out.first().has_carousel) == ("it is", True)


def test_texts_of_snapshots_stay_whole(spark):
    cells = {"body": {"text": "b" * 7000 + " end"}, "title": "t" * 700 + " end", "link_description": "d" * 700 + " end"}
    raw = spark.createDataFrame([(1, json.dumps(cells))], "ad_id long, snapshot string").select("*", *(F.lit(None).cast(k).alias(c) for c, k in {"page_id": "long", "page_name": "string", "page_category": "string", "cta_type": "string", "link_url": "string", "publisher_platform": "string", "start_date": "string", "end_date": "string", "is_active": "boolean", "page_like_count": "long", "collation_id": "int"}.items()))
    row = ads.normalize(ads.from_snapshots(raw), "1998-09-01 00:00:00").first()
    assert (row.text, row.title, row.description) == (cells["body"]["text"], cells["title"], cells["link_description"])


@pytest.mark.parametrize("cell", ["{'a': 'it\\'s \"b\"', 'c': (1, None,)}", "{'a': 'None, True', 'b': [False,]}", '{"a": "x"}', "{broken"])
def test_literals_as_json(spark, cell):
    import ast
    import json

    got = json.loads(one(spark, cell, T.literal_object))
    try:
        want = json.loads(json.dumps(ast.literal_eval(cell)))
    except SyntaxError:
        want = {}
    assert got == want


def test_scores_apart_either_way_count(spark):
    people = spark.createDataFrame([("n", "c", None)], "name string, company string, country string")
    rows = contacts.graph_status(people, spark.createDataFrame([(50, 20), (20, 50), (20, 0), (None, 90)], "v1 int, v2 int")).filter("label in ('apart', 'dropped')").collect()
    assert {r.label: r.n for r in rows} == {"apart": 2, "dropped": 1}


@pytest.mark.parametrize("more", [0, T.FEW])
def test_words_end_where_ascii_ends(spark, more):
    patterns = [r"\bund\b"] + [rf"\bnot{k}\b" for k in range(more)]
    df = spark.createDataFrame([("undße",), ("ßund",), ("und",), ("unde",), ("x und y",), (None,)], "x string").select(T.matches_any(F.col("x"), patterns).alias("m"), T.count_matching(F.col("x"), patterns).alias("n"))
    assert [tuple(r) for r in df.collect()] == [(True, 1), (True, 1), (True, 1), (False, 0), (True, 1), (None, None)]
