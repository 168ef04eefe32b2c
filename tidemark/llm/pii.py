"""Personal data: patterns find values; what the corpus tells about terms beside a value finds terms that reveal it.

A value's information is -log2 of the share of documents that hold it. A term reveals it as far as their pointwise
mutual information goes: log2 of how much likelier the value is in a document with the term. A capitalised word, or one
of a script without capitals, near the value, in at least MIN_CONTEXTS different contexts, that gives away a share of ALPHA of that information, is
generalised in documents that hold the value. Contexts count by the words beyond the near ones before the value and by
those after it, and the smaller number holds: copies of a passage are one context, and copies with a change on one side
are too, so a passage doesn't speak against its own words; a phrase within NEAR_WORDS words of the value may be the same
everywhere. Where a text ends sooner on one side, the other side tells; where it does on both, all near words do.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections import Counter

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, entering, free_names, small, small_batches, stored

KINDS = ("email", "ip", "card", "phone", "term")
ALPHA, MIN_CONTEXTS, NEAR_WORDS = 0.75, 3, 8
#: Words beyond the near ones, on each side, that tell contexts apart.
FAR_WORDS = 3
#: Terms whose documents a task counts before it passes the counts on.
COUNTED = 50_000

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(\.[A-Za-z0-9-]++)+")
# a run of digits matches from its first digit or from none, so later ones needn't be tried
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_NAME = re.compile(r"[^\W\d_][^\W_]{2,}")


def _emails(text: str):
    """For each @, the longest local part before it: what a search from the left finds, in one pass."""
    done, at = 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > done and text[begin - 1] in _LOCAL:
            begin -= 1
        if begin < at and (m := _DOMAIN.match(text, at + 1)):
            yield begin, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def find(text: str) -> list[tuple[int, int, int]]:
    """(start, kind's number, end) of the pattern kinds, sorted."""
    spans = [(a, 0, b) for a, b in _emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
                spans.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            if len(m[0]) >= 14 and 14 <= len(d := m[0].replace(" ", "").replace("-", "")) <= 19 and luhn(d):
                spans.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= sum(c in "0123456789" for c in m[0]) <= 15:
                    spans.append((m.start(), 3, m.end()))
        spans.sort()
    return spans


def value_of(text: str, span: tuple[int, int, int]) -> str:
    """The value's own form, the same however it is set."""
    a, kind, b = span
    return f"{KINDS[kind]}:{text[a:b].lower() if kind < 2 else re.sub('[^0-9]', '', text[a:b])}"


def _named(word: str) -> bool:
    """Whether a word may be a name: it begins with a capital, or its script has none."""
    return not word[0].islower()


def _words(text: str, spans) -> tuple[list[tuple[int, int]], list[int]]:
    """All words of a text by their ends, a value being one word and parting those that it touches; and the words' beginnings."""
    words, k = [], 0
    for m in _WORD.finditer(text):
        at, end = m.span()
        while at < end:
            while k < len(spans) and spans[k][2] <= at:
                k += 1
            if k < len(spans) and spans[k][0] <= at:
                to = spans[k][2]
            elif k < len(spans) and spans[k][0] < end:
                to = spans[k][0]
            else:
                to = end
            words.append((at, min(to, end)))
            at = max(to, at + 1)
    return words, [a for a, _ in words]


def _beside(text: str, span: tuple[int, int, int], spans, words: list[tuple[int, int]], begins: list[int]) -> tuple[int, int, list[str]]:
    """Hashes that tell the context before a value and the one after it, and the names within NEAR_WORDS words of it, however long these are."""
    a, _, b = span
    reach = NEAR_WORDS + FAR_WORDS
    low, high = bisect_left(begins, a), bisect_left(begins, b)
    left, right = words[max(0, low - reach) : low], words[high : high + reach]
    said = lambda some: " ".join(text[x:y] for x, y in some)
    before = "< " + said(left[:FAR_WORDS]) if len(left) == reach else None
    after = "> " + said(right[NEAR_WORDS:]) if len(right) == reach else None
    left, right = left[-NEAR_WORDS:], right[:NEAR_WORDS]
    if not before and not after:
        before = said(left) + " | " + said(right)
    before, after = (xxhash.xxh64_intdigest(x) - (1 << 63) for x in (before or after, after or before))
    taken = [s for s, _, _ in spans]
    names = set()
    for x, y in left + right:
        k = bisect_right(taken, x) - 1
        if k < 0 or x >= spans[k][2]:
            names.update(filter(_named, _NAME.findall(text[x:y])))
    return before, after, sorted(names)


def _joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def _texts(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    return [t or "" for t in batch.column(name).to_pylist()]


BESIDE = "array<struct<value: string, term: string, before: long, after: long>>"
FOUND = f"doc_id long, key long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, beside {BESIDE}, name string, n_docs long"
_ARROW = [pa.int64()] * 6 + [pa.string()] * 2 + [pa.list_(pa.struct([("value", pa.string()), ("term", pa.string()), ("before", pa.int64()), ("after", pa.int64())])), pa.string(), pa.int64()]
_COLUMNS = ["doc_id", "key", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "beside", "name", "n_docs"]


def _found_rows(columns: dict[str, list], n: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[c], t) if c in columns else pa.nulls(n, t) for c, t in zip(_COLUMNS, _ARROW)], _COLUMNS)


def detected(docs: DataFrame) -> DataFrame:
    """FOUND, kept: a row for each document (key: its text's hash), with counts of each kind, base_sha256, spans, and beside: (value, term, before, after);
    and rows of names with in how many documents they stand, all names of all texts, summed by task. Texts are read once."""

    def scan(batches):
        entering("pii")
        names: Counter[str] = Counter()
        for batch in batches:
            out = {c: [] for c in _COLUMNS[:9]}
            for doc, key, text in zip(batch.column("doc_id").to_pylist(), batch.column("key").to_pylist(), batch.column("text").to_pylist()):
                text = text or ""
                names.update(filter(_named, set(_NAME.findall(text))))
                spans = find(text)
                base, beside = _joined(spans), []
                words, begins = _words(text, spans) if spans else ([], [])
                for s in spans:
                    before, after, near = _beside(text, s, spans, words, begins)
                    beside += [{"value": value_of(text, s), "term": n, "before": before, "after": after} for n in near or [None]]
                kinds = [k for _, k, _ in spans]
                for to, x in zip(out.values(), (doc, key, *(kinds.count(k) for k in range(4)), hashlib.sha256(base.encode()).hexdigest(), base, beside)):
                    to.append(x)
            yield _found_rows(out, batch.num_rows)
            if len(names) > COUNTED:
                yield _found_rows({"name": list(names), "n_docs": list(names.values())}, len(names))
                names.clear()
        if names:
            yield _found_rows({"name": list(names), "n_docs": list(names.values())}, len(names))

    with small_batches(docs.sparkSession):
        return stored(docs.select("doc_id", F.xxhash64("text").alias("key"), "text").mapInArrow(scan, FOUND), "found")


def disclosures(found: DataFrame, alpha: float = ALPHA, min_contexts: int = MIN_CONTEXTS) -> DataFrame:
    """value, term, share: terms that give away at least alpha of a value's information; statistics cover all documents."""
    rows = found.filter("base_sha256 is not null")
    pairs = rows.select(F.xxhash64("doc_id", "key").alias("doc"), F.explode("beside").alias("b")).select("doc", "b.*")
    near = pairs.filter("term is not null").groupBy("value", "term", "before", "after").agg(F.count_distinct("doc").alias("n"))
    contexts = F.least(F.count_distinct("before"), F.count_distinct("after"))
    near = cut(near.groupBy("value", "term").agg(contexts.alias("contexts"), F.sum("n").alias("both")).filter(F.col("contexts") >= min_contexts))
    if near.isEmpty():
        return near.select("value", "term", F.lit(0.0).alias("share"))
    total = rows.count()
    counts = found.filter("name is not null").join(small(cut(near.select(F.col("term").alias("name")).distinct())), "name").groupBy(F.col("name").alias("term")).agg(F.sum("n_docs").alias("n_docs"))
    values = pairs.select("value", "doc").distinct().join(small(cut(near.select("value").distinct())), "value").groupBy("value").agg(F.count(F.lit(1)).alias("with_value"))
    joint = F.least(F.col("both"), F.col("with_value"), F.col("n_docs"))
    mutual = F.log2(joint * F.lit(float(total)) / (F.col("with_value") * F.col("n_docs")))
    share = mutual / F.log2(F.lit(float(total)) / F.col("with_value"))
    told = near.join(counts, "term").join(values, "value").withColumn("share", F.when(F.col("with_value") < total, share).otherwise(F.lit(0.0)))
    return cut(told.filter(F.col("share") >= alpha).select("value", "term", "share"))


def revealing(found: DataFrame) -> DataFrame:
    """doc_id, key, terms of the documents that hold a value which terms reveal: the terms of all their values, kept."""
    told = disclosures(found).select("value", "term")
    holds = found.filter("base_sha256 is not null").select("doc_id", "key", F.explode(F.array_distinct("beside.value")).alias("value"))
    return cut(holds.join(small(told), "value").groupBy("doc_id", "key").agg(F.sort_array(F.collect_set("term")).alias("terms")))


def _with_terms(text: str, spans, terms: list[str]):
    """spans and those of the terms."""
    taken, names = [(a, b) for a, _, b in spans], set(terms)
    return sorted([*spans, *((m.start(), 4, m.end()) for m in _NAME.finditer(text) if m[0] in names and not any(a < m.end() and m.start() < b for a, b in taken))])


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans: a row for each document.

    Null texts count as empty: no spans, and the digest of an empty string. Places are code points; texts of any length
    count whole. Spans that begin together stand by kind. Repeated rows get a row each and count once in statistics; an
    empty table gives none. docs' other columns play no part, whatever their names. Where corpus statistics find
    revealing terms, documents with them are read once more.
    """
    found = detected(docs)
    out = found.filter("base_sha256 is not null").drop("beside", "name", "n_docs")
    terms = revealing(found)
    if terms.isEmpty():
        return out.drop("key")

    def scan(batches):
        entering("pii")
        for batch in batches:
            spans = [_joined(_with_terms(t or "", find(t or ""), names)) for t, names in zip(batch.column("text").to_pylist(), batch.column("terms").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("key"), pa.array(spans, pa.string())], ["doc_id", "key", "more"])

    texts = docs.select("doc_id", F.xxhash64("text").alias("key"), "text")
    t = terms.withColumnsRenamed({"doc_id": "_id", "key": "_key"})
    met = texts.join(small(t), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_key")))
    more = met.select("doc_id", "key", "text", "terms").mapInArrow(scan, "doc_id long, key long, more string").groupBy(F.col("doc_id").alias("_id"), F.col("key").alias("_key")).agg(F.first("more").alias("more"))
    out = out.join(small(cut(more)), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_key")), "left")
    return out.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", F.coalesce("more", "spans").alias("spans"))


def masked(text: str, spans) -> str:
    """text with each span, or run of overlapping ones, replaced by the first one's kind in brackets."""
    out, done = [], 0
    for a, kind, b in spans:
        if a >= done:
            out += [text[done:a], f"[{KINDS[kind].upper()}]"]
        done = max(done, b)
    return "".join([*out, text[done:]])


def redact(docs: DataFrame) -> DataFrame:
    """docs with values and revealing terms generalised in text; n_chars, where there is one, follows.

    Null texts stay null and empty ones empty; repeated rows change alike; an empty table gives an empty one. docs'
    other columns stay, whatever their names.
    """
    told = revealing(detected(docs))
    names = docs.columns
    key, i, k, terms = free_names(docs, "_text", "_id", "_key", "_terms")
    rows = docs.withColumn(terms, F.lit(None).cast("array<string>"))
    if not told.isEmpty():
        told = told.select(F.col("doc_id").alias(i), F.col("key").alias(k), F.col("terms").alias(terms))
        rows = docs.withColumn(key, F.xxhash64("text")).join(small(told), F.col("doc_id").eqNullSafe(F.col(i)) & (F.col(key) == F.col(k)), "left")

    def scan(batches):
        entering("pii")
        for batch in batches:
            out = []
            for text, more in zip(batch.column("text").to_pylist(), batch.column(terms).to_pylist()):
                spans = find(text) if text else []
                if spans:
                    text = masked(text, _with_terms(text, spans, more) if more else spans)
                out.append(text)
            columns = {n: batch.column(n) for n in names}
            columns["text"] = pa.array(out, batch.schema.field("text").type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), names)

    out = rows.select(*names, terms).mapInArrow(scan, docs.schema)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in names else out
