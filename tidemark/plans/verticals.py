"""What documents and pages are about, by pattern categories."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import categories as C
from ..operators import ads as A
from .proxies import _pick, _sql_pick, read

PHRASES = [
    "Selling your house? Get a free home valuation and a cash offer", "Find your dream home, new listing, open house", "Apartment for rent, monthly rent, no deposit", "Join our team, become an agent, now hiring", "Please leave a review",
    "Rental income and cash flow from investment property", "VA loan or FHA loan? Mortgage financing", "Roof repair and storm damage", "HVAC, heating and cooling, AC repair", "Drain, leaky faucet, water heater", "Solar panel and panel upgrade, lighting install",
    "Termite, bed bug and rat", "House cleaning, deep clean, power wash", "Lawn care, tree removal, garden", "Interior paint, exterior painting", "Kitchen remodel by a contractor", "Windows and doors, patio door", "Brenting barrat éant control", "",
]


def _texts(spark, d):
    k, n = F.col("doc_id"), len(PHRASES)
    text = F.concat_ws(". ", _pick(PHRASES, k % n), "text", _pick(PHRASES, (k * 7 + 3) % n))
    return read(spark, d, "documents").select("doc_id", F.when(k % 31 > 0, text).alias("text"))


def _joined(df, key):
    return df.select(key, "category", F.col("n").cast("long").alias("n"), F.array_join("categories", ", ").alias("categories"))


def vertical_intents(spark, d):
    return _joined(A.categorised(_texts(spark, d), F.col("text"), C.INTENTS), "doc_id")


def vertical_trades(spark, d):
    return _joined(A.categorised(read(spark, d, "pages"), F.col("html"), C.TRADES), "page_id")


def vertical_trade_texts(spark, d):
    return _joined(A.categorised(_texts(spark, d), F.col("text"), C.TRADES), "doc_id")


def vertical_sectors(spark, d):
    """The first sector of a document's text, or of nothing."""
    return _texts(spark, d).select("doc_id", C.first_matched(F.col("text"), C.SECTORS).alias("sector"))


def vertical_report(spark, d):
    """Of each intent: texts that have it first, and that have it at all."""
    return A.category_report(A.categorised(_texts(spark, d), F.col("text"), C.INTENTS))


def _escaped(p: str) -> str:
    return p.replace("'", "''")


# letters beyond ASCII are word characters, which this dialect's \b doesn't know
_TEXTS = f"t AS (SELECT doc_id AS k, CASE WHEN doc_id % 31 > 0 THEN regexp_replace(concat_ws('. ', {_sql_pick(PHRASES, f'doc_id % {len(PHRASES)}')}, text, {_sql_pick(PHRASES, f'(doc_id * 7 + 3) % {len(PHRASES)}')}), '[À-ÖØ-öø-ɏ]', 'z', 'g') END AS x FROM documents)"
_HTML = "t AS (SELECT page_id AS k, regexp_replace(html, '[À-ÖØ-öø-ɏ]', 'z', 'g') AS x FROM pages)"


def _counted(texts: str, key: str, table: dict, tail: str = "") -> str:
    sums = ", ".join("{'c': '%s', 'o': %d, 'n': %s}" % (name, i, " + ".join(f"len(regexp_extract_all(coalesce(x, ''), '(?i){_escaped(p)}'))" for p in ps)) for i, (name, ps) in enumerate(table.items()))
    out = f"""WITH {texts}, f AS (SELECT k, list_filter([{sums}], lambda s: s.n > 0) AS f FROM t),
r AS (SELECT k AS {key}, CASE WHEN len(f) = 0 THEN 'unknown' ELSE list_sort(list_transform(f, lambda s: {{'n': -s.n, 'o': s.o, 'c': s.c}}))[1].c END AS category, CAST(CASE WHEN len(f) = 0 THEN 0 ELSE list_max(list_transform(f, lambda s: s.n)) END AS BIGINT) AS n, list_transform(f, lambda s: s.c) AS cs FROM f)
"""
    return out + (tail or f"SELECT {key}, category, n, array_to_string(cs, ', ') AS categories FROM r")


QUERIES = {f.__name__: f for f in (vertical_intents, vertical_trades, vertical_trade_texts, vertical_sectors, vertical_report)}
SQL = {
    "vertical_intents": _counted(_TEXTS, "doc_id", C.INTENTS),
    "vertical_trades": _counted(_HTML, "page_id", C.TRADES),
    "vertical_trade_texts": _counted(_TEXTS, "doc_id", C.TRADES),
    "vertical_sectors": f"WITH {_TEXTS} SELECT k AS doc_id, CASE " + " ".join("WHEN " + " OR ".join(f"regexp_matches(x, '(?i){_escaped(p)}')" for p in ps) + f" THEN '{name}'" for name, ps in C.SECTORS.items()) + " END AS sector FROM t",
    "vertical_report": _counted(_TEXTS, "doc_id", C.INTENTS, "SELECT c AS category, CAST(sum(b) AS BIGINT) AS n_best, CAST(sum(1 - b) AS BIGINT) AS n_any FROM (SELECT category AS c, 1 AS b FROM r UNION ALL SELECT unnest(cs), 0 FROM r) GROUP BY 1"),
}
