"""Decontamination, spelling variants and tokenizer alignment against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import alignment, decontaminate, queries, variants

from . import cases

TABLES = "/root/testdata/sf0.01"


def rows(df):
    return Counter(map(tuple, df.collect()))


# 11 benchmark decontamination

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
HIT = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]


def _words(text):
    return WORD.findall((text or "").translate(cases.LOWER))


def _windows(text, window):
    w = _words(text)
    n = min(window, len(w))
    return {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if w else set()


def _contamination(docs, items, window=10):
    want, wins = Counter(), [("" if i is None else str(i), v) for i, t in items for v in _windows(t, window)]
    for d, t in docs:
        w, hit, ids = _words(t), set(), set()
        at = {}
        for k, x in enumerate(w):
            at.setdefault(x, []).append(k)
        for i, v in wins:
            for k in at.get(v[0], ()):
                if tuple(w[k : k + len(v)]) == v:
                    hit |= set(range(k, k + len(v)))
                    ids.add(i)
        want[(d, len(w), len(hit), len(ids), cases.sha(",".join(sorted(ids))), bool(hit))] += 1
    return want


def _benchmark():
    a, b = cases.prose(1, 300), cases.prose(2, 120)
    return [
        (1, " ".join(a.split()[100:130])), (2, b.upper()), (3, "one TWO"), (10, "x"), (11, "x x"), (4, None), (5, ""), (6, "... --"), (7, " ".join(b.split()[:9]) + " unheard"), (7, " ".join(a.split()[-12:])),
        (None, "日本語 текст ñandú"), (12, "the quick nothing of this stands in any document at all here"), (12, "the quick nothing of this stands in any document at all here"),
    ]


def _items(spark, items):
    return spark.createDataFrame([(i, t, "z") for i, t in items], "item_id long, text string, terms string")


def test_contamination(spark):
    docs, items = cases.docs(spark).select("doc_id", "text", F.lit(1).alias("counts"), F.lit(2).alias("n_words")), _items(spark, _benchmark())
    data = [(r.doc_id, r.text) for r in docs.collect()]
    want = _contamination(data, _benchmark())
    assert rows(decontaminate.contamination(docs, items).select(HIT)) == want
    # many small blocks of items give the same
    assert rows(decontaminate.contamination(docs, items, size=300).select(HIT)) == want
    assert rows(decontaminate.contamination(docs, items, window=3).select(HIT)) == _contamination(data, _benchmark(), 3)


def test_contamination_of_nothing(spark):
    items, none = _items(spark, _benchmark()), _items(spark, [])
    assert decontaminate.contamination(cases.none(spark), items).count() == 0
    got = decontaminate.contamination(cases.docs(spark), none)
    assert got.count() == len(cases.texts()) and got.filter("contaminated OR n_hit > 0").count() == 0


def test_small_segments(spark):
    """Documents over many segments and stretches of candidates."""
    rng = random.Random(4)
    data = [(k, " ".join(rng.choice("a b c d e f".split()) for _ in range(rng.randrange(60)))) for k in range(300)]
    items = [(k, " ".join(rng.choice("a b c d e f g".split()) for _ in range(rng.randrange(1, 8)))) for k in range(60)]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    index = decontaminate.build(docs, size=500)
    assert index.count() > 10
    got = Counter((r.doc_id, r.item_id, r.first, r.last) for r in decontaminate.matches(index, _items(spark, items), window=4).collect())
    want = Counter()
    for d, t in data:
        w = _words(t)
        for i, x in items:
            for v in _windows(x, 4):
                want.update((d, str(i), k, k + len(v) - 1) for k in range(len(w)) if tuple(w[k : k + len(v)]) == v)
    assert got == want


def test_candidates_in_stretches(monkeypatch):
    text = " ".join("a b".split() * 500)
    batch = decontaminate._segment(pa.array([1]), pa.array([text], pa.large_string()))
    s = decontaminate.Segment({n: batch.column(n)[0] for n in batch.schema.names})
    b = decontaminate.Block(["i"], ["a b a"], None)
    whole = sorted(np.concatenate([x[1] for x in decontaminate.exact(s, b)]).tolist())
    monkeypatch.setattr(decontaminate, "TOGETHER", 7)
    assert sorted(np.concatenate([x[1] for x in decontaminate.exact(s, b)]).tolist()) == whole == list(range(0, 998, 2))


def test_near(spark):
    """Ordered words within a span, for each place of the rarest word, against all choices of places."""
    rng = random.Random(5)
    data = [(k, " ".join(rng.choice("a b c d e f".split()) for _ in range(25))) for k in range(80)]
    items = [(k, " ".join(rng.sample("a b c d e f".split(), 4))) for k in range(12)]
    index = decontaminate.build(spark.createDataFrame(data, "doc_id long, text string"))
    got = {(r.doc_id, r.item_id) for r in decontaminate.matches(index, _items(spark, items), window=None, slop=3).collect()}
    spans = {(r.last - r.first + 1) for r in decontaminate.matches(index, _items(spark, items), window=None, slop=3).collect()}

    def within(w, v, most):
        for k in range(len(w)):
            if w[k] == v[0]:
                at = k
                for x in v[1:]:
                    at = next((j for j in range(at + 1, len(w)) if w[j] == x), None)
                    if at is None:
                        break
                if at is not None and at - k + 1 <= most:
                    return True
        return False

    assert got == {(d, str(i)) for d, t in data for i, x in items if within(t.split(), x.split(), 7)}
    assert max(spans) <= 7
    exact = decontaminate.matches(index, _items(spark, items), window=None, slop=0)
    assert rows(exact) == rows(decontaminate.matches(index, _items(spark, items), window=None))


# 12 spelling variants


def _edited(docs):
    n = Counter()
    for d, t in docs:
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = w.translate(cases.LOWER)
            h = zlib.crc32(f"{'' if d is None else d}:{w}".encode())
            if h % 97 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            n[w] += 1
    return n


def _one_apart(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def _variants(count, shortest=5, least=3):
    n = {w: c for w, c in count.items() if len(w) >= shortest and c >= least}
    near, gaps = {w: set() for w in n}, {}
    for w in n:
        for k in range(len(w)):
            gaps.setdefault((w[:k], w[k + 1 :]), []).append(w)
            if (x := w[:k] + w[k + 1 :]) in n:
                near[w].add(x)
                near[x].add(w)
    for some in gaps.values():
        for w in some:
            near[w].update(x for x in some if x != w)
    assert all(_one_apart(w, x) for w in n for x in near[w])
    form = {}
    for w, some in near.items():
        best = min(some, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    want = Counter()
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        want[(w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None)] += 1
    return want


VARIANT = ["word", "form", "root", "n", "n_near", "form_n"]


def test_variants_of_documents(spark):
    got = rows(queries.op12_spelling_variants(spark, TABLES).select(VARIANT))
    data = [(r.doc_id, r.text) for r in spark.read.parquet(f"{TABLES}/documents.parquet").select("doc_id", "text").collect()]
    assert got == _variants(_edited(data))
    assert sum(1 for r in got if r[1]) > 100


def _typos(seed):
    rng, words = random.Random(seed), []
    for k in range(120):
        w = "".join(rng.choice("abé") for _ in range(rng.randrange(4, 9)))
        words += [w] * rng.randrange(1, 40)
    words += ["aaaaaa", "aaaaa", "aaaaaaa"] * 3 + ["aaabaa"] * 7 + ["x" * 3000] * 3 + ["x" * 2999 + "y"] * 6 + ["x" * 3001] * 30
    rng.shuffle(words)
    return words


def test_variants_of_close_words(spark):
    """Runs of one letter, words of thousands of letters, groups of many near words, chains of forms."""
    words = _typos(3)
    data = [(k, " ".join(words[k::40]).upper() if k % 2 else ", ".join(words[k::40])) for k in range(40)] + [(None, "chain chain chain"), (None, None), (7, "")]
    data += [(99, " ".join(w for k, w in enumerate(("abcde", "abcdef", "abcdefg", "abcdefgh", "abcdefghi")) for _ in range(3 << k)))]
    docs = spark.createDataFrame([(d, t, "w", 1, 2) for d, t in data], "doc_id long, text string, word string, n int, id int").repartition(5)
    assert rows(variants.variants(docs).select(VARIANT)) == _variants(_edited(data))
    assert rows(variants.variants(docs, shortest=4, least=1).select(VARIANT)) == _variants(_edited(data), 4, 1)
    plain = Counter(w for _, t in data for w in re.findall("[a-zÀ-ÿ]+", (t or "").translate(cases.LOWER)))
    assert rows(variants.variants(docs, edited=None).select(VARIANT)) == _variants(plain)
    assert variants.variants(docs.filter("false")).count() == 0


def test_colliding_keys(spark, monkeypatch):
    """Deletion keys that collide are told apart by strings."""
    monkeypatch.setattr(variants, "_BASE", np.uint64(1))  # a word's key is then the sum of its letters
    words = spark.createDataFrame([(k, w, 10 + k) for k, w in enumerate(sorted(["abcde", "abced", "bacde", "edcba", "abcd", "abcdf", "fbcde"]))], "id long, word string, n long")
    listed = {r.id: r.word for r in words.collect()}
    got = {listed[r.id]: r.n_near for r in variants.neighbours(words).collect()}
    want = {w: sum(_one_apart(w, x) for x in listed.values() if x != w) for w in listed.values()}
    assert got == {w: n for w, n in want.items() if n}


# 13 cross-tokenizer alignment

ALIGN = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def aligner():
    import public_tokenizers

    return alignment.Aligner(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def _decoder(tok):
    keep = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table = {chr(b): b for b in keep} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in keep)}
    return lambda i: bytes(table[c] for c in tok.id_to_token(i))


def _tokens(al, text):
    """[(id, begin, end)] of both, or nothing."""
    a = al.a.encode(" " + text, add_special_tokens=False).ids
    b = al.b.encode(text)
    da, raw = _decoder(al.a), (" " + text).encode()
    db = lambda i: bytes([int(al.b.id_to_piece(i)[3:5], 16)]) if al.b.is_byte(i) else al.b.id_to_piece(i).replace("▁", " ").encode()
    out = []
    for ids, f in ((a, da), (b, db)):
        at, spans = 0, []
        for i in ids:
            spans.append((i, at, at + len(f(i))))
            at += len(f(i))
        if b"".join(map(f, ids)) != raw:
            return [], []
        out.append(spans)
    return out


def _alignment(al, data):
    docs, seen = [], Counter()
    for d, t in data:
        a, b = _tokens(al, t) if t else ([], [])
        cuts = sorted({x[2] for x in a} & {x[2] for x in b})
        parts, i, j = [], 0, 0
        for c in cuts:
            ga, gb = [], []
            while i < len(a) and a[i][2] <= c:
                ga.append(str(a[i][0]))
                i += 1
            while j < len(b) and b[j][2] <= c:
                gb.append(str(b[j][0]))
                j += 1
            parts.append(",".join(ga) + "|" + ",".join(gb))
        links, j = [], 0
        for x, begin, end in a:
            while j and b[j - 1][2] > begin:
                j -= 1
            while j < len(b) and b[j][1] < end:
                if b[j][2] > begin:
                    links.append((x, b[j][0]))
                j += 1
        seen.update(set(links))
        docs.append((d, len(a), len(b), len(cuts), links, hashlib.sha256(";".join(parts).encode()).hexdigest() if a else ""))
    best = {}
    for (a, _), n in seen.items():
        best[a] = max(n, best.get(a, 0))
    return Counter((d, na, nb, ng, len(ls), sum(seen[x] == best[x[0]] for x in ls), sum(seen[x] for x in ls), sha) for d, na, nb, ng, ls, sha in docs)


STRANGE = [
    "it's  x\n\ny  <|endoftext|> \t z\n <s> </s>", "\n1 2\n", " ", "  ", "\n", "w  ", "  a", "a  b    c　 d  e  f", "x▁y", "▁", "\x00 \x7f a", "日本語 текст ñandú 😀 👩‍👩‍👧 x", "é ́ x", "12 34.5 6e7 '\"'",
    "a\r\n b\r\nc", "’ s ’ t’s “q” …", "� ﻿ x", "a" * 5000, "= " * 400, "tab\tspace \t x", "\x85 a\x85 b", "'s 's't x's", "<0x0A> <unk>", "ﬁ ﬀ ½ ²",
]


def test_chunks_are_encoded_as_in_their_text(aligner):
    rng = random.Random(8)
    alphabet = " \n\n\t  abcdeéñ1.,'’ 　 日😀▁\r\x85"
    texts = STRANGE + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 40))) for _ in range(3000)]
    assert aligner.split
    for t in texts:
        chunks, n = aligner.chunks(pa.array([t], pa.large_string()))
        assert "".join(chunks.to_pylist()) == " " + t and n.tolist() == [len(chunks)]
        a, _, b, _, ok = aligner.encode(chunks)
        if "▁" in t:
            assert not ok.all(), ascii(t)
        else:
            assert ok.all() and a.tolist() == aligner.a.encode(" " + t, add_special_tokens=False).ids and b.tolist() == aligner.b.encode(t), ascii(t)


def _data():
    rng = random.Random(6)
    data = [(i, t if t is None or len(t) < 20_000 else t[:20_000]) for i, t, _ in cases.texts()] + [(100 + k, t) for k, t in enumerate(STRANGE)]
    words = "the The ciónrcill thnt. éçeux, 2024 <|endoftext|> <s> don't naïve".split()
    return data + [(200 + k, "".join(rng.choice(words) + rng.choice([" ", "  ", "\n", "\n\n", ", ", "-", ""]) for _ in range(rng.randrange(80)))) for k in range(150)]


def test_alignment(spark, aligner):
    docs = spark.createDataFrame([(d, t, 1, "x") for d, t in _data()], "doc_id long, text string, kind int, key string").repartition(4)
    want = _alignment(aligner, _data())
    assert rows(alignment.alignment(docs).select(ALIGN)) == want
    # few groups broadcast, the others shuffled
    assert rows(alignment.alignment(docs, broadcast=5).select(ALIGN)) == want
    assert alignment.alignment(docs.filter("false")).count() == 0
    assert rows(alignment.alignment(docs.filter("text IS NULL OR text = ''")).select(ALIGN)) == Counter((d, 0, 0, 0, 0, 0, 0, "") for d, t in _data() if not t)


def test_groups_that_share_a_key(spark, aligner, monkeypatch):
    """A seed under which all keys are equal isn't taken."""
    docs = spark.createDataFrame(_data()[-20:], "doc_id long, text string")
    whole, seeds = alignment.parts, []

    def parts(df, a, b, seed=0):
        seeds.append(seed)
        found = whole(df, a, b, seed)
        return found if seed else found.withColumn("key", F.when(F.col("kind") == 1, F.lit(1)).otherwise(F.col("key")))

    monkeypatch.setattr(alignment, "parts", parts)
    assert rows(alignment.alignment(docs).select(ALIGN)) == _alignment(aligner, _data()[-20:])
    assert seeds == [0, 1]


def test_keys_that_clash_in_one_stretch_are_told(aligner, monkeypatch):
    monkeypatch.setattr(alignment, "_hash", lambda ids, group, edges, base: np.zeros(len(edges) - 1, np.uint64))
    found = list(alignment._stretch(aligner, pa.array([1]), pa.array(["one two three"], pa.large_string()), 0))
    assert len(found[1]["key"]) == 3
