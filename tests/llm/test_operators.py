"""Every operator on awkward documents, against brute force."""

import base64
import hashlib
import math
import os
import random
import re
import struct
import unicodedata
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import xxhash
from pyspark.sql import functions as F

from tidemark.llm import fingerprints, jaccard_join, licenses, mixing, packing, pii, quality, token_store, tokens, toxicity, warc
from tidemark.llm.common import fresh_dir

from . import cases

TABLES = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return cases.docs(spark).cache()


def rows(df):
    return Counter(map(tuple, df.collect()))


# 1 document fingerprints


def _canonical(text):
    folded = unicodedata.normalize("NFKC", text or "").lower().replace("ß", "ss").replace("ς", "σ")
    return re.sub("[ \t\n\x0b\x0c\r\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+", " ", folded).strip(" ")


def _fingerprint(text):
    raw = _canonical(text).encode()
    seed = xxhash.xxh64_intdigest(struct.pack("<i", 0x7469646D), 42)
    return f"{xxhash.xxh64_intdigest(raw, 42):016x}{xxhash.xxh64_intdigest(raw, seed):016x}"


def test_canonical(spark):
    """Conjoining jamo, marks of all classes in any order, and other characters, one by one and in strange texts, as Python's tables have them."""
    rng = random.Random(9)
    texts = ["ＡＢＣ ｶﾞ", "é é É", "ﬁne ½ … ™ ①", "Straße ΣΑΣ\xa0 x\n\ty", "ệ ệ Việt", "Привет й й", "İstanbul", "", " a  b ", None]
    texts += ["\u1112\u1161\u11ab", "a\u0327\u0301", "a\u0301\u0327", "\u05d0\u05bc\u05b8", "a\u0301\u0345\u0323"]
    texts += ["".join(chr(c) for c in range(k, k + 64) if not 0xD800 <= c < 0xE000 and unicodedata.category(chr(c)) not in ("Cn", "Co") and unicodedata.bidirectional(chr(c)) not in ("B", "S")) for k in range(32, 0x2FA20, 64 * 7)]
    texts += [_strange(rng).replace("\x1c", "") for _ in range(4000)]
    texts = [t for t in texts if t is None or all(unicodedata.category(c) != "Cn" for c in t)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    bad = [(ascii(texts[r.i]), ascii(r.c)) for r in df.select("i", fingerprints.canonical(F.col("t")).alias("c")).collect() if r.c != _canonical(texts[r.i])]
    assert not bad


def _falling(data):
    """(doc_id, text) by falling doc_id, nulls last, then falling hash of the text."""
    key = lambda t: (lambda h: h - ((h >> 63) << 64))(_hash(42, t or ""))
    return sorted(((i, t or "") for i, t in data), key=lambda r: (r[0] is None, -(r[0] or 0), -key(r[1])))


def _fingerprints(data):
    order, want = _falling(data), Counter()
    for (i, t), (_, nxt) in zip(order, order[1:] + order[:1]):
        h = len(t) // 2
        changed = t[: len(t) - h] + nxt[:h]
        f, e = _fingerprint(t), _fingerprint(changed)
        want[(i, len(t), cases.sha(changed), f, e, float(f == e), float(f == _fingerprint(nxt)))] += 1
    return want


def test_fingerprints(docs, spark):
    got = fingerprints.fingerprints(docs)
    assert rows(got) == _fingerprints([(i, t) for i, t, _ in cases.texts()])
    by = {}
    for r in got.collect():
        by.setdefault(r.doc_id, set()).add(r.fingerprint)
    assert by[1] == by[2] and by[14] == by[15] and by[1] != by[3] and by[8] == by[9]
    assert fingerprints.fingerprints(cases.none(spark)).count() == 0


def test_followed_across_blocks(spark):
    """Ids in clumps, one that many rows have, and many without: each is followed by the next one, in blocks of a few rows."""
    data = [(i * i, f"t{i}") for i in range(1500)] + [(10**9 + i, f"u{i}") for i in range(1500)] + [(77_777, f"h{i}") for i in range(900)] + [(None, f"n{i}") for i in range(600)]
    df = fingerprints.keyed(spark.createDataFrame(data, "doc_id long, text string").repartition(4))
    order = _falling(data)
    want = Counter((i, t, nxt) for (i, t), (_, nxt) in zip(order, order[1:] + order[:1]))
    assert rows(fingerprints.followed(df, rows_a_block=2).select("doc_id", "text", "next_text")) == want
    sizes = [r[0] for r in fingerprints._blocks(df.select("doc_id", "key"), 2)(df).groupBy("block").count().select("count").collect()]
    assert max(sizes) <= 60


def test_hash_collisions_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "wide_hash", lambda c: [F.length(c).cast("long"), F.lit(0).cast("long")])
    df = spark.createDataFrame([(1, "ab"), (2, "ba"), (3, "AB"), (4, "c")], "doc_id long, text string")
    got = {r.doc_id: (r.class_id, r.n_copies) for r in fingerprints.exact_duplicates(df).collect()}
    assert got == {1: (1, 2), 3: (1, 2), 2: (2, 1), 4: (4, 1)}
    got = {r.doc_id: r.fingerprint for r in fingerprints.fingerprints(df).collect()}
    assert got[1] == got[3] and len({got[1], got[2], got[4]}) == 3


# 2 quality rules


def test_quality_features(docs, spark):
    want = Counter()
    for i, t, _ in cases.texts():
        t = t or ""
        w = cases.W.findall(t)
        lines = [x for x in t.split("\n") if cases.W.search(x)]
        at = {}
        for k in range(len(w) - 2):
            at.setdefault(tuple(w[k : k + 3]), []).append(k)
        covered = len({k + j for ks in at.values() if len(ks) > 1 for k in ks for j in range(3)})
        want[(i, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), covered, len(w) < 50 or 100 * covered > 50 * len(w))] += 1
    got = quality.quality(docs)
    assert rows(got.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")) == want
    assert not got.filter("base_failed and kept").count()
    assert quality.quality(cases.none(spark)).count() == 0


def test_quality_rejects_junk_and_keeps_prose(spark):
    good = [(k, cases.prose(k, 200 + k) + " the and of to in is") for k in range(60)]
    junk = [(100 + k, " ".join(f"{w}$$$ ###" for w in cases.prose(k, 90).split())) for k in range(6)]
    kept = {r.doc_id: r.kept for r in quality.quality(spark.createDataFrame(good + junk, "doc_id long, text string")).collect()}
    assert all(kept[k] for k, _ in good) and not any(kept[k] for k, _ in junk)
    left = quality.keep_good(spark.createDataFrame(good + junk, "doc_id long, text string"))
    assert {r.doc_id for r in left.collect()} == {k for k, _ in good} and left.columns == ["doc_id", "text"]


@pytest.mark.skipif(not os.path.exists(TABLES), reason="no test tables here")
def test_verdicts_against_labels(spark):
    """Of labelled documents, no bad one stays, and no good one goes that passes the base."""
    got = quality.quality(spark.read.parquet(f"{TABLES}/documents.parquet")).join(spark.read.parquet(f"{TABLES}/labels.parquet"), "doc_id").collect()
    bad, good = [r for r in got if r["quality"] is not None and r[-2] == 0], [r for r in got if r[-2] == 1]
    assert bad and not any(r.kept for r in bad)
    assert good and all(r.kept or r.base_failed for r in good)


def test_posterior_is_the_models(docs):
    """quality is the posterior chance of good, rule by rule; kept follows it and the base."""
    got = quality.quality(docs).collect()
    odds, weights = quality.fit(Counter(tuple(r.votes) for r in got))
    for r in got:
        want = 1 / (1 + math.exp(-odds - sum(w[v] for w, v in zip(weights, r.votes))))
        assert r["quality"] == pytest.approx(want, abs=1e-9) and r.kept == (not r.base_failed and want >= 0.5)


def test_em_learns_from_agreement():
    odds, w = quality.fit({(-1, -1, 0): 40, (-1, 0, 0): 5, (0, -1, 0): 5, (0, 0, 1): 900, (0, 0, 0): 50})
    assert odds > 0 and w[0][-1] < -2 and w[1][-1] < -2 and w[2][1] >= 0


# 3 n-gram Jaccard join


@pytest.mark.parametrize(("words", "percent"), [(4, 85), (5, 80), (2, 50)])
def test_components_match_brute_force(docs, spark, words, percent):
    assert rows(jaccard_join.linked(docs, words, percent)) == Counter(cases.components(cases.texts(), words, percent))
    assert jaccard_join.linked(cases.none(spark), words, percent).count() == 0


def test_components_of_chains_and_families(spark, monkeypatch):
    """Groups whose members link to few others, over split lists and groups."""
    for name, value in (("GROUP", 3), ("PARTNERS", 2), ("CHUNK", 500), ("LOCAL", 2), ("BLOCK", 2), ("HOT", 4)):
        monkeypatch.setattr(jaccard_join, name, value)
    data = _families()
    df = spark.createDataFrame([(i, t) for i, t, _ in data], "doc_id long, text string").repartition(3)
    assert rows(jaccard_join.linked(df, 3, 70)) == Counter(cases.components(data, 3, 70))


def _families():
    data = []
    for f in range(4):
        base = cases.prose(50 + f, 60).split()
        for k in range(12):
            w = list(base)
            for j in range(k % 6):
                w[(11 * j + 5 * (k % 4)) % 60] = f"e{j}" if k % 2 else f"e{k}x{j}"
            data.append((100 * f + k, " ".join(w), None))
    return data


def _near_misses(n):
    """Families of near copies whose members differ from other families' by less or more than a link takes, and long and short texts among them."""
    base, data = cases.prose(61, 80).split(), []
    for f in range(6):
        own = list(base)
        for j in range(f * 2):
            own[(j * 13 + f) % 80] = f"f{f}x{j}"
        for k in range(n):
            w = list(own)
            w[(7 * k) % 80] = f"k{k}f{f}"
            w = w[: 80 - k % 17]
            data.append((1000 * f + k, " ".join(w), None))
    return data


@pytest.mark.parametrize(("words", "percent"), [(2, 60), (3, 75), (4, 85)])
def test_answers_derived_from_likes(spark, monkeypatch, words, percent):
    """Sets of unlike components meet in lists, in split ones too, and their overlaps are derived from their leaders'."""
    data = _near_misses(14)
    df = spark.createDataFrame([(i, t) for i, t, _ in data], "doc_id long, text string").repartition(3)
    want = Counter(cases.components(data, words, percent))
    assert rows(jaccard_join.linked(df, words, percent)) == want
    for name, value in (("GROUP", 9), ("PARTNERS", 3), ("BLOCK", 3), ("HOT", 5), ("LOCAL", 2)):
        monkeypatch.setattr(jaccard_join, name, value)
    derived, verify = [], jaccard_join._verify

    def counting(pairs, sets_of, parts, percent, told=None):
        out = verify(pairs, sets_of, parts, percent, told)
        if told is not None:
            derived.append(pairs.join(told, "b").count())
            have = {r.doc_id: r.text for r in df.collect()}
            sets = {jaccard_join._digest(s)[0]: set(s.tolist()) for t in have.values() for s in jaccard_join.shingle_sets(pa.array([t]), words)}
            assert all(r.both == len(sets[r.a] & sets[r.b]) and r.n_a == len(sets[r.a]) and r.n_b == len(sets[r.b]) for r in out.collect())
        return out

    monkeypatch.setattr(jaccard_join, "_verify", counting)
    assert rows(jaccard_join.linked(df, words, percent)) == want
    assert sum(derived) > 0 or (words, percent) != (3, 75)


def test_near_copies_cost_about_their_number(spark, monkeypatch):
    """5,000 near copies in lists of thousands, and a few sets of other components in the same lists."""
    n, base = 5000, cases.prose(71, 60).split()
    data = [(k, " ".join([*base[: 20 + k % 20], f"own{k}", *base[21 + k % 20 :]])) for k in range(n)]
    data += [(n + k, " ".join([*base[: 8 + k], *(f"x{k}y{j}" for j in range(40))])) for k in range(5)]
    compared, verify = [], jaccard_join._verify

    def counting(pairs, *more, **named):
        compared.append(pairs.count())
        return verify(pairs, *more, **named)

    monkeypatch.setattr(jaccard_join, "_verify", counting)
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.component_id for r in jaccard_join.linked(df, 3, 80).collect()}
    assert all(got[k] == 0 for k in range(n)) and all(got[n + k] == n + k for k in range(5))
    assert sum(compared) < 2 * n


def test_blocks_reach_all_pairs_that_may_link():
    rng = np.random.default_rng(3)
    for percent in (50, 80, 85):
        make = lambda k: {"n": rng.integers(1, 60, k).astype(np.int32), "left": rng.integers(1, 9, k).astype(np.int32), "main": rng.integers(0, 2, k).astype(np.int32), "sid": np.arange(k)}
        held, passing = make(200), make(150)
        met = {(int(b["sid"][i]), int(passing["sid"][j])) for b in jaccard_join._blocks(held) for at, to in jaccard_join._reached(b, passing, percent) for i, j in zip(at, to)}
        for i in range(200):
            for j in range(150):
                na, nb, m = int(held["n"][i]), int(passing["n"][j]), int(min(held["left"][i], passing["left"][j]))
                link = (m + (percent * max(na, nb) + 99) // 100 - 1) * (100 + percent) >= percent * (na + nb) and 100 * min(na, nb) >= percent * max(na, nb)
                assert (i, j) in met or not link or (na > nb and not passing["main"][j])
        assert len(met) < 200 * 150 / 3


@pytest.mark.parametrize("n", [2, 3, 4, 5, 8])
def test_shingle_sets_of_few_words(n):
    for k in range(n + 1):
        assert [len(s) for s in jaccard_join.shingle_sets(pa.array([" ".join("abcdefgh"[:k])]), n)] == [min(k, 1)]


@pytest.mark.parametrize("size", [1, 2, 3, 10_000])
def test_lists_keep_each_set_across_batches(spark, size):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    try:
        many = [(t, s, 10, 0, 0) for t, sets in enumerate(["AB", "A", "ABC", "BC", "C", "AC"]) for s in map(ord, sets) for _ in range(1 + (3 * t + s) % 4)]
        got = rows(jaccard_join._lists(spark.createDataFrame(many, f"{jaccard_join.ENTRY}, part int"), 1))
        assert got == Counter((t, ord(s), 10, 0) for t, sets in enumerate(["AB", "", "ABC", "BC", "", "AC"]) for s in sets)
        # copies of a text in many partitions; it shares one prefix shingle with the other
        data = [(i, "a b c d e f g h", None) for i in range(8)] + [(8, "x a b c d e f g h", None), (9, "a b c d e f g y", None)]
        df = spark.createDataFrame([d[:2] for d in data], "doc_id long, text string").repartition(8)
        assert rows(jaccard_join.linked(df, 3, 70)) == Counter(cases.components(data, 3, 70))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_digest_clashes_get_other_numbers(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "_digest", lambda s: (len(s), int(s[0] >> np.uint64(1)) if len(s) else 0))
    data = [(i, cases.prose(i, 40), None) for i in range(6)] + [(10, cases.prose(1, 40), None)]
    df = spark.createDataFrame([(i, t) for i, t, _ in data], "doc_id long, text string")
    digests = {jaccard_join._digest(s) for s in jaccard_join.shingle_sets(pa.array([t for _, t, _ in data]), 3)}
    assert len(digests) == 6


def test_components_by_stars(spark):
    edges = [(k, k + 1) for k in range(0, 40)] + [(100, 101), (101, 102), (200, 205), (205, 203), (7, 7)]
    got = {r.node: r.component for r in jaccard_join.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(41)}, 100: 100, 101: 100, 102: 100, 200: 200, 203: 200, 205: 200}


def test_keep_one(docs):
    kept = jaccard_join.keep_one(docs)
    assert kept.columns == docs.columns
    ids = Counter(r.doc_id for r in kept.select("doc_id").collect())
    assert ids[1] == 1 and not ids[2] and not ids[3] and ids[4] == 1 and ids[5] == 1 and ids[9] == 0 and ids[8] == 1


def test_keep_one_of_repeated_and_null_ids(spark):
    """Rows of one doc_id may be unlike; copies without an id go too; rows equal in id and text leave one; texts without words all stay."""
    a, b, c = cases.prose(1, 80), cases.prose(2, 80), cases.prose(3, 80)
    near = " ".join(["changed", *c.split()[1:]])
    data = [(3, a), (7, a), (7, b), (None, a), (None, b), (9, c), (9, near), (9, near), (None, ""), (None, ""), (11, None), (None, near), (12, cases.prose(4, 80)), (12, cases.prose(4, 80)), (None, cases.prose(5, 80)), (None, cases.prose(5, 80))]
    df = spark.createDataFrame([(i, t, 1, 2, 3, 4) for i, t in data], "doc_id long, text string, _id int, _key int, _text int, comp int").repartition(3)
    got = Counter((r.doc_id, r.text) for r in jaccard_join.keep_one(df).collect())
    first = min((c, near), key=lambda t: next(r[0] for r in spark.createDataFrame([(t,)], "t string").select(F.xxhash64("t")).collect()))
    assert got == Counter([(3, a), (7, b), (9, first), (None, ""), (None, ""), (11, None), (12, cases.prose(4, 80)), (None, cases.prose(5, 80))])
    assert jaccard_join.keep_one(df).columns == df.columns


CLASHES = "doc_id long, text string, source string, _id int, _key int, _text int, _copies int, _source int, _again int, _of int, _rate int, _seed int, _group int, _rank int, at int, block int, rows int, comp int, size int, spans int, value int, term int, length int, _terms int, `_KEY_` int"


def test_columns_with_clashing_names(spark):
    """Whatever the operators name their helper columns, docs' own ones stay."""
    n = CLASHES.count(" int")
    df = spark.createDataFrame([(k, f"{cases.prose(k % 5, 90)} the and of to in is mail a{k}@b.cd", "s", *range(n)) for k in range(8)], CLASHES)
    for f in (quality.keep_good, jaccard_join.keep_one, pii.redact, mixing.mix):
        out = f(df)
        assert out.columns == df.columns and all(r[3:] == tuple(range(n)) for r in out.collect())
    for f in (fingerprints.fingerprints, quality.quality, jaccard_join.linked, pii.report, packing.packed, mixing.mixture, licenses.licenses, token_store.encoded):
        assert f(df).count() == df.count()
    pages = df.select("doc_id", "text", *df.columns[3:]).withColumnsRenamed({"doc_id": "page_id", "text": "html"}).withColumn("url", F.lit("http://a.b/c")).withColumns({c: F.lit(1) for c in ("_sha1", "urlkey", "refers_to", "bytes", "near", "shard")})
    assert warc.archived(pages).count() == df.count()
    labels = df.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic"), "_id", "block", F.lit("x").alias("text"))
    assert toxicity.toxicity(df, labels).count() == df.count()


# 4 personal data


def test_spans(docs, spark):
    want = Counter()
    for i, t, _ in cases.texts():
        s = cases.spans(t)
        n = Counter(k for _, k, _ in s)
        want[(i, n[0], n[1], n[2], n[3], cases.sha(cases.joined(s)), cases.joined(s))] += 1
    assert rows(pii.report(docs)) == want
    assert pii.report(cases.none(spark)).count() == 0


@pytest.mark.parametrize("text", ["a@b@c.de", "a@@b.c", "x@y.z.", "a.b@c..d", "p@q.r@s.t", "1.2.3.4.5.6.7.8", "999.1.1.1.1", "+1 (2) 3", "4111-1111-1111-1111 4111111111111112", "a" * 5000 + "@", "9" * 3000])
def test_find_is_the_patterns_search(text):
    assert pii.find(text) == cases.spans(text)


def test_revealing_terms_are_generalised(spark):
    """A name that stands by one address in many contexts, and hardly elsewhere, goes with it; common names stay."""
    data = [(k, f"note {k} from Zebulon about {cases.prose(k, 4)} write zeb@corp.example {cases.prose(k + 9, 5)} The end") for k in range(6)]
    data += [(100 + k, f"{cases.prose(k, 30)} The Office opened") for k in range(300)]
    df = spark.createDataFrame(data, "doc_id long, text string")
    told = {(r.value, r.term) for r in pii.disclosures(pii.detected(df)).collect()}
    assert told == {("email:zeb@corp.example", "Zebulon")}
    red = {r.doc_id: r.text for r in pii.redact(df).collect()}
    assert "Zebulon" not in red[3] and "[TERM]" in red[3] and "[EMAIL]" in red[3] and "The end" in red[3] and red[105] == data[11][1]
    got = {r.doc_id: r.spans for r in pii.report(df).collect()}
    assert "term:" in got[0] and got[100] == ""


def test_names_in_fixed_phrases_are_generalised(spark):
    """The phrase is the same in unlike documents, at an end of them too; copies of a passage, changed on one side, are one context."""
    data = [(k, f"{cases.prose(k, 30)} please contact Jane Dorsey jane@x.example for more details {cases.prose(k + 50, 30)}") for k in range(6)]
    data += [(10 + k, f"{cases.prose(k + 70, 30)} regards Ottokar ott@x.example") for k in range(6)]
    data += [(20 + k, f"Yours Wendelin wen@x.example {cases.prose(k + 80, 30)}") for k in range(6)]
    data += [(30 + k, f"{cases.prose(7, 30)} by Copied cop@x.example {cases.prose(k + 90, 30)}") for k in range(6)]
    data += [(40, "Only Twice two@x.example"), (41, "Only Twice two@x.example"), (42, "Only Twice two@x.example")]
    data += [(100 + k, cases.prose(k, 30)) for k in range(300)]
    df = spark.createDataFrame(data, "doc_id long, text string")
    told = {(r.value, r.term) for r in pii.disclosures(pii.detected(df)).collect()}
    assert told == {("email:jane@x.example", "Jane"), ("email:jane@x.example", "Dorsey"), ("email:ott@x.example", "Ottokar"), ("email:wen@x.example", "Yours"), ("email:wen@x.example", "Wendelin")}
    assert "contact [TERM] [TERM] [EMAIL] for" in {r.doc_id: r.text for r in pii.redact(df).collect()}[3]


def test_disclosures_are_brute_forces(spark):
    """Over texts with names of two scripts at values, share by share; repeated rows count once, lower-case words aren't names."""
    rng = random.Random(4)
    names, values = ["Zebulon", "Marfa", "Quill", "李小龙名", "Ottokar", "plain"], [f"p{k}@q.example" for k in range(4)]
    data = []
    for k in range(240):
        v = values[rng.randrange(4)] if k % 3 == 0 else None
        near = rng.sample(names, 2) if rng.random() < 0.06 else [names[values.index(v)] if v else "plain", "Common"]
        data.append((k, f"{cases.prose(k, 25)} {' '.join(near)} {v or 'nobody'} {cases.prose(k + 500, 25)}"))
    data += [data[0], data[3]]
    word = lambda t: {n for n in re.findall(r"[^\W\d_][^\W_]{2,}", t) if n[0].upper() == n[0]}
    distinct = sorted(set(data))
    want = {}
    for v in values:
        have = [t for _, t in distinct if v in t]
        for n in {n for t in have for n in word(t)}:
            met = [t.split() for t in have if n in t.split() and abs(t.split().index(n) - t.split().index(v)) <= 8]
            sides = [{" ".join(w[w.index(v) - 11 : w.index(v) - 8]) for w in met}, {" ".join(w[w.index(v) + 9 : w.index(v) + 12]) for w in met}]
            with_term = sum(n in word(t) for _, t in data)
            if min(map(len, sides)) >= 3:
                share = math.log2(min(len(met), len(have), with_term) * len(data) / (len(have) * with_term)) / math.log2(len(data) / len(have))
                if share >= pii.ALPHA:
                    want[f"email:{v}", n] = share
    got = {(r.value, r.term): r.share for r in pii.disclosures(pii.detected(spark.createDataFrame(data, "doc_id long, text string").repartition(3))).collect()}
    assert want and got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)


def test_redact_keeps_columns_and_nulls(docs):
    red = pii.redact(docs)
    assert red.columns == docs.columns
    got = {r.doc_id: r for r in red.filter("doc_id in (5, 16)").collect()}
    assert got[5].text is None and "[EMAIL]" in got[16].text and "[CARD]" in got[16].text and got[16].n_chars == len(got[16].text)


# 5 best-fit packing


def reference_ids(text):
    return np.asarray(tokens.encoder(tokens.default_path()).tok.encode(text or "", add_special_tokens=False).ids, "<u4")


def test_encoder_is_the_tokenizer():
    enc = tokens.encoder(tokens.default_path())
    assert enc.split
    got = list(enc.encode(pa.array([t for _, t, _ in cases.texts()])))
    for (_, t, _), ids in zip(cases.texts(), got, strict=True):
        assert ids.tobytes() == reference_ids(t).tobytes()


_POOLS = ["abcTHWYJKIİıſßΣσς", "\u0331\u0323\u0300\u0301\u0308\u030a\u030c\u0307\u0344\u0340\u0345", " .,;:!?'\t\n\x0b\x1c\x85\xa0", "\u0958\ufb2a\ufb31\u00b9\u00b2\u00bd\u2167\ufb01\uff76\uff9e", "\u1112\u1161\u11ab한각", "'s't're'll"]


def _strange(rng) -> str:
    """A short text of characters that a normaliser or a pre-tokenizer may treat apart, and of any others."""
    out = []
    for _ in range(rng.randint(1, 14)):
        k = rng.random()
        if k < 0.65:
            out.append(rng.choice(rng.choice(_POOLS)))
        elif k < 0.9:
            out.append(chr(rng.choice([rng.randrange(32, 0x250), rng.randrange(0x250, 0x3000), rng.randrange(0x3000, 0xD7FF), rng.randrange(0xE000, 0x110000)])))
        else:
            out.append(rng.choice(["<|endoftext|>", "<|STARTOFTEXT|>", "THE", "Don't", "x."]))
    return "".join(out)


def test_encoder_on_strange_texts():
    rng = random.Random(5)
    texts = ["İ.", "T\u0308", "straße! É? x1."] + [_strange(rng) for _ in range(20_000)]
    for t, ids in zip(texts, tokens.encoder(tokens.default_path()).encode(pa.array(texts)), strict=True):
        assert ids.tobytes() == reference_ids(t).tobytes(), ascii(t)


@pytest.mark.skipif(not os.path.exists(TABLES), reason="no test tables here")
def test_encoder_on_documents(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_BYTES", 1 << 18)
    texts = pq.read_table(f"{TABLES}/documents.parquet", columns=["text"]).column(0).combine_chunks()
    for t, ids in zip(texts.to_pylist(), tokens.encoder(tokens.default_path()).encode(texts), strict=True):
        assert ids.tobytes() == reference_ids(t).tobytes()


def test_packing(docs, spark):
    got = packing.packed(docs, 512).toPandas()
    want = Counter()
    for i, t, _ in cases.texts():
        ids = np.append(reference_ids(t), np.uint32(1)).astype("<u4")
        for k in range(0, len(ids), 512):
            want[(i, k // 512, k, len(ids[k : k + 512]), zlib.crc32(ids[k : k + 512].tobytes()))] += 1
    assert Counter((None if r.doc_id != r.doc_id else int(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in got.itertuples()) == want
    for _, g in got.sort_values("offset").groupby("sequence_id"):
        assert (g.length.cumsum() - g.length == g.offset).all() and g.length.sum() <= 512
    assert got.sequence_id.nunique() <= -(-got.length.sum() // 512) + 1
    assert packing.packed(cases.none(spark), 512).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_runs_place_each_piece_once(seed):
    rng = np.random.default_rng(seed)
    lengths = np.clip((rng.pareto(1.2, 4000) * 80).astype(int) + 1, 1, 1024)
    histogram = Counter(lengths.tolist())
    runs = packing.runs_of(histogram, 1024)
    used = Counter()
    for run, n in runs:
        assert sum(a * b for a, b in run) <= 1024
        for length, times in run:
            used[length] += n * times
    assert used == histogram
    assert sum(n for _, n in runs) <= -(-int(lengths.sum()) // 1024) * 1.02 + 1


def test_nnls():
    rng = np.random.default_rng(1)
    a, x = rng.random((8, 20)), np.zeros(20)
    x[[2, 5, 9]] = [1.0, 2.0, 0.5]
    got = packing.nnls(a, a @ x)
    assert (got >= 0).all() and np.abs(a @ got - a @ x).max() < 1e-6


# 6 mixing


def test_mixture(docs, spark):
    got = mixing.mixture(docs).collect()
    size = {}
    for _, t, s in cases.texts():
        size[s] = size.get(s, 0) + len(cases.W.findall(t or ""))
    names = sorted((s for s in size if s is not None)) + [None]
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    left, fixed = 1.5 * sum(size.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        share = {s: (left - sum(fixed.values())) * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 2 * size[s]]
        if not over:
            break
        fixed |= {s: 2 * size[s] for s in over}
    want = {**fixed, **share}
    for r in got:
        assert r.source_size == size[r.source] and r.target == pytest.approx(want[r.source]) and r.taken <= 2 * r.size
    assert rows(mixing.mixture(docs)) == Counter(map(tuple, got))
    assert mixing.mixture(cases.none(spark)).count() == 0
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    taken = Counter()
    for r in got:
        taken[r.doc_id] += r.copies
    assert Counter(r.doc_id for r in mixed.select("doc_id").collect()) == +taken


def _hash(seed, value):
    """Spark's xxhash64 of a value after a hash: nulls pass it on."""
    if value is None:
        return seed
    raw = value.encode() if isinstance(value, str) else struct.pack("<q", value)
    return xxhash.xxh64_intdigest(raw, seed)


def test_each_extra_copy_is_a_draw(docs):
    """Copies are floor(rate) and one more where the hash of the seed, the doc_id and the text is below the fraction; of all seeds, a source has the best."""
    per = {r.source: r for r in mixing.rates(mixing.sizes(docs), [5, 2, 1], 1.5, 2.0, 17).collect()}

    def extra(i, t, seed):
        key = _hash(42, t)
        key -= (key >> 63) << 64
        return _hash(_hash(xxhash.xxh64_intdigest(struct.pack("<i", seed), 42), i), key) >> 11

    want, words = Counter(), {s: [0] * mixing.SEEDS for s in per}
    for i, t, s in cases.texts():
        r, size = per[s], len(cases.W.findall(t or ""))
        part = r.rate - int(r.rate)
        want[(i, s, size, (int(r.rate) + (extra(i, t, r.seed) / 2**53 < part)) * size)] += 1
        for k in range(mixing.SEEDS):
            words[s][k] += size * (extra(i, t, 17 + k) / 2**53 < part)
    assert rows(mixing.mixture(docs).select("doc_id", "source", "size", "taken")) == want
    for s, r in per.items():
        off = [abs(w - (r.rate - int(r.rate)) * r.source_size) for w in words[s]]
        assert off[r.seed - 17] == pytest.approx(min(off), abs=1e-6)


def test_sources_come_near_their_targets(spark):
    df = spark.range(0, 3000).select(F.col("id").alias("doc_id"), F.expr("repeat('w ', cast(1 + id * 31 % 200 as int))").alias("text"), F.when(F.col("id") < 1000, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 7)).alias("source"))
    got = mixing.mixture(df).groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target")).collect()
    assert all(abs(r.taken - r.target) <= 0.01 * r.target + 200 for r in got)


def test_many_sources(spark):
    """Levels and weights over thousands of sources, whose places are numbered in ranges."""
    df = spark.range(0, 5000).select(F.concat(F.lit("s"), F.lpad(F.col("id"), 5, "0")).alias("source"), (1 + F.col("id") * 7919 % 300).alias("source_size"))
    got = {r.source: r for r in mixing.source_targets(df.repartition(4), [5, 2, 1], 1.5, 2.0).collect()}
    total, full, level = sum(r.source_size for r in got.values()), set(), 0.0
    names = sorted(got)
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    while True:
        level = (1.5 * total - sum(2 * got[s].source_size for s in full)) / sum(weight[s] for s in names if s not in full)
        more = {s for s in names if s not in full and level * weight[s] > 2 * got[s].source_size}
        if not more:
            break
        full |= more
    assert all(got[s].target == pytest.approx(min(2 * got[s].source_size, level * weight[s])) for s in names)


# 7 WARC


def test_archives(spark):
    pages = [(k, f"http://www.site{k % 5}.example:80/p/{k}?q", f"<p>{k % 7}</p>") for k in range(40)] + [(40, None, None), (41, "bad url\nx", ""), (None, "http://a.example", "<p>1</p>"), (3, "http://dup.example/", "<p>3</p>"), (50, "http://late.example/", "<p>3</p>")]
    df = spark.createDataFrame([(*p, "x") for p in pages], "page_id long, url string, html string, sha1 string")
    first, want = {}, Counter()
    for i, _, h in pages:
        if i is not None:
            first[h or ""] = min(i, first.get(h or "", i))
    for i, _, h in pages:
        b, f = (h or "").encode(), first[h or ""]
        want[(i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "response" if i == f else "revisit", None if i == f else f)] += 1
    assert rows(warc.archived(df)) == want
    assert warc.archived(df.limit(0)).count() == 0
    assert not warc.archived(df, min_bytes=1000).filter("record_type = 'revisit'").count()


def test_lookup_reads_ranges(spark, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_LINES", 3)
    df = spark.createDataFrame([(k, f"https://h{k % 9}.example/{k}", f"body {k}") for k in range(60)], "page_id long, url string, html string")
    folder = fresh_dir(spark, "test")
    shards = warc.write_index(warc.write_archives(df, folder), folder)
    urls = spark.createDataFrame([("http://www.h3.example/12#x",), ("https://h3.example/nowhere",), (None,), ("https://h0.example/0",)], "url string")
    got = warc.read_records(warc.lookup(shards, urls)).collect()
    assert sorted((r.page_id, bytes(r.payload)) for r in got) == [(0, b"body 0"), (12, b"body 12")]


# 8 toxicity


def _labelled(spark):
    data = []
    for k in range(1200):
        bad = k % 6 == 0
        who = ["muslim", "christian", "gay", "straight", "women", "men"][k % 6]
        text = cases.prose(k, 25) + (f" you {['idiot', 'scum', 'moron'][k % 3]} gay " if bad else f" {who} friends ") + cases.prose(k + 5, 10)
        data.append((k, text, int(bad)))
    return spark.createDataFrame(data, "doc_id long, text string, toxic int")


def test_toxicity_held_out(spark):
    df = _labelled(spark)
    got = toxicity.toxicity(df.select("doc_id", "text"), df.select("doc_id", "toxic")).join(df, "doc_id").filter("held_out").collect()
    assert np.mean([r.predicted == r.toxic for r in got]) > 0.98
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)


def test_scores_are_the_models(spark):
    """A text's score by brute force: the weights of its words, and of beginnings that stand in it twice and densely, and the bias."""
    df = _labelled(spark)
    model = toxicity.fit(df, df)
    weight = dict(zip(model["words"], model["weights"]))
    texts = [r.text for r in df.limit(50).collect()] + [t for _, t, _ in cases.texts()] + ["idiot Idioten idiotic gay"]
    got = [r.score for r in toxicity.score(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1), model).orderBy("doc_id").collect()]
    for t, s in zip(texts, got, strict=True):
        words = re.findall(r"(?:(?![\d_])\w|[\u0300-\u036f])+", (t or "").lower())
        marks = set(words)
        for k in toxicity.STEMS:
            for m, n in Counter(f"{w[:k]}*" for w in words if len(w) > k).items():
                if n >= 2 and n * toxicity.DENSITY >= len(words):
                    marks.add(m)
        assert s == pytest.approx(1 / (1 + math.exp(-model["bias"] - sum(weight.get(m, 0.0) for m in marks))), abs=1e-9)


def test_identity_terms_carry_no_weight(spark):
    df = _labelled(spark)
    model = toxicity.fit(df, df)
    weight = dict(zip(model["words"], model["weights"]))
    assert weight["idiot"] > 1 and max(abs(weight[a] - weight[b]) for a, b in (("gay", "straight"), ("gay", "lesbian"))) < 0.5
    bag = lambda fairness: dict(zip(model["words"], toxicity.train(*toxicity.examples(toxicity.labelled(df, df, 5000), model["words"]), model["words"], fairness)[0]))
    assert abs(bag(5.0)["gay"] - bag(5.0)["straight"]) < abs(bag(0.0)["gay"] - bag(0.0)["straight"])


def test_repeated_groups_carry_no_weight(spark):
    """Groups that toxic texts name twice, in the terms' own forms, in the plural and in other languages, aren't marks by a beginning."""
    who = ["muslims", "immigrants", "ausländer", "musulmans", "refugiados"]
    data = []
    for k in range(1200):
        bad = k % 6 == 0
        text = cases.prose(k, 25) + (f" {who[k // 6 % 5]} {['idiot', 'scum', 'moron'][k % 3]} {who[k // 6 % 5]} idiot " if bad else " friends ") + cases.prose(k + 5, 10)
        data.append((k, text, int(bad)))
    df = spark.createDataFrame(data, "doc_id long, text string, toxic int")
    model = toxicity.fit(df, df)
    assert not [m for m in model["words"] if m.endswith("*") and any(w.startswith(m[:-1]) for w in who)]
    neutral = [(i, f"the {a} met the other {a} in town") for i, a in enumerate(["muslims", "christians", "immigrants", "natives", "ausländer", "einheimische", "musulmans", "chrétiens", "refugiados", "nativos"])]
    got = [r.score for r in toxicity.score(spark.createDataFrame(neutral, "doc_id long, text string").coalesce(1), model).collect()]
    assert max(got) < 0.5 and max(abs(a - b) for a, b in zip(got[::2], got[1::2])) < 0.2
    flat = [w for g in toxicity.IDENTITY_TERMS for w in g]
    assert len(flat) == len(set(flat))


def test_toxicity_edges(docs, spark):
    labels = spark.createDataFrame([(1, 1), (3, 0), (None, 1), (4, None)], "doc_id long, toxic int")
    got = toxicity.toxicity(docs, labels).collect()
    assert len(got) == len(cases.texts()) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    assert toxicity.toxicity(cases.none(spark), labels).count() == 0
    assert toxicity.toxicity(docs, labels.limit(0)).count() == len(cases.texts())


# 9 licences


def test_licenses(docs, spark):
    data = [
        (1, f"{cases.prose(1, 400)} Released under the MIT License. {cases.prose(2, 50)}", "MIT"), (2, "LICENSED   under the apache license,\nversion 2.0", "Apache-2.0"), (3, cases.prose(3, 5000), ""),
        (4, "This work is licensed under the GNU General Public License, version 3.", "GPL-3.0"), (5, "Licensed under CC BY-NC 4.0. Also released under the MIT License", "CC-BY-NC-4.0,MIT"), (6, "the mit building was released under the old roof", ""),
        (7, "x " + licenses.TEMPLATES[2][1] + " y", "MIT"), (8, None, ""), (9, "license", ""),
    ]
    for shift in range(9):
        data.append((100 + shift, "pad " * shift + "Licensed under CC BY 4.0. " + cases.prose(4, 30), "CC-BY-4.0"))
    got = {r.doc_id: r.licenses for r in licenses.licenses(spark.createDataFrame([d[:2] for d in data], "doc_id long, text string")).collect()}
    assert got == {i: want for i, _, want in data}
    assert licenses.licenses(docs).count() == len(cases.texts()) and licenses.licenses(cases.none(spark)).count() == 0


def test_licenses_side_by_side(spark):
    """A lightly edited notice stays beside another's exact one; of notices in the same place the fuller stays."""
    mit = licenses.TEMPLATES[2][1].replace("free of charge", "free of any charge")
    data = [
        (1, f"{mit}. Licensed under the Apache License, Version 2.0.", "Apache-2.0,MIT"), (2, f"Licensed under CC BY 4.0. {mit}", "CC-BY-4.0,MIT"),
        (3, f"Licensed under the BSD 2-Clause License. Released under the MIT License. {cases.prose(5, 40)} {mit}", "BSD-2-Clause,MIT"), (4, licenses.TEMPLATES[8][1], "GPL-2.0"),
    ]
    df = spark.createDataFrame([d[:2] for d in data], "doc_id long, text string")
    assert {r.doc_id: r.licenses for r in licenses.licenses(df).collect()} == {i: want for i, _, want in data}
    at = {(x.license, x.start, x.end) for r in licenses.matches(df).filter("doc_id = 2").collect() for x in r.found}
    assert at == {("CC-BY-4.0", 0, 5), ("MIT", 5, 35)}


def _scanned(text, contained=licenses.CONTAINED):
    """Licences by brute force: every place of a text against every template, without bands."""
    shingle = lambda t: list(zip(w := re.findall(r"[^\W_]+(?:\.\d+)*", t.lower()), w[1:]))
    h, found = shingle(text or ""), []
    where = {}
    for i, x in enumerate(h):
        where.setdefault(x, []).append(i)
    for name, template in licenses.TEMPLATES:
        wanted = set(shingle(template))
        if len(wanted & where.keys()) < contained * len(wanted):
            continue
        for low in sorted({max(0, i - k) for x in wanted & where.keys() for i in where[x] for k in (0, len(wanted))}):
            text = h[low : low + 2 * len(wanted) + licenses.WINDOW]
            if len(common := wanted & set(text)) >= contained * len(wanted):
                ends = [(max(text.index(y, i) for y in common) - i, i) for i, x in enumerate(text) if x in common and all(y in text[i:] for y in common)]
                n, i = min(ends)
                found.append((name, len(common) / len(wanted), low + i, low + i + n + 1))
    return {a for a in found if not any(b[1] > a[1] and b[2] < a[3] and a[2] < b[3] for b in found)}


@pytest.mark.skipif(not os.path.exists(TABLES), reason="no test tables here")
def test_bands_find_what_brute_force_finds(spark):
    """Licences of all documents, and of made texts with every template whole, lightly edited and beside others."""
    rng, made = random.Random(6), []
    for k in range(400):
        t = licenses.TEMPLATES[k % len(licenses.TEMPLATES)][1].split()
        if k % 3 and len(t) > 12:
            t[rng.randrange(len(t))] = "edited"
        made.append((10**6 + k, f"{cases.prose(k, rng.randrange(40))} {' '.join(t)} {cases.prose(k + 1, rng.randrange(40))} {rng.choice(licenses.TEMPLATES)[1]}"))
    tables = spark.read.parquet(f"{TABLES}/documents.parquet").select("doc_id", "text")
    df = tables.unionByName(spark.createDataFrame(made, "doc_id long, text string"))
    want = {r.doc_id: {a[0] for a in _scanned(r.text)} for r in df.collect()}
    got = {r.doc_id: set(filter(None, r.licenses.split(","))) for r in licenses.licenses(df).collect()}
    n = sum(map(len, want.values()))
    assert n > 400 and sum(len(want[i] & got[i]) for i in want) >= 0.99 * n and sum(len(got[i] - want[i]) for i in want) <= 0.01 * n
    assert all(got[r.doc_id] == want[r.doc_id] for r in tables.select("doc_id").collect())


# 10 token shards


@pytest.mark.parametrize("shard", [1 << 27, 2000])
def test_token_shards(docs, spark, monkeypatch, shard):
    monkeypatch.setattr(token_store, "SHARD_BYTES", shard)
    monkeypatch.setattr(token_store, "BLOCK", shard >> 4)
    monkeypatch.setattr(token_store, "READ_BYTES", shard >> 1)
    got = [tuple(r) for r in token_store.encoded(docs).orderBy("start").collect()]
    signed = lambda h: h - ((h >> 63) << 64)
    order = sorted(cases.texts(), key=lambda r: (r[0] is not None, r[0] or 0, signed(_hash(42, r[1]))))
    want, at = [], 0
    for i, t, _ in order:
        ids = np.append(reference_ids(t), np.uint32(2)).astype("<u4")
        want.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert got == want
    assert token_store.encoded(cases.none(spark)).count() == 0


def test_lookup_by_binary_search(docs, spark, monkeypatch):
    monkeypatch.setattr(token_store, "BLOCK", 64)
    monkeypatch.setattr(token_store, "SHARD_KEYS", 2)
    shards = token_store.write_shards(docs, fresh_dir(spark, "test"))
    ids = spark.createDataFrame([(2,), (-5,), (999,), (None,), (19,)], "doc_id long")
    got = Counter((r.doc_id, tuple(r.ids)) for r in token_store.lookup(shards, ids).collect())
    assert got == Counter((i, (*reference_ids(t).tolist(), 2)) for i, t, _ in cases.texts() if i in (2, -5, 19, None))
