"""Rows without an id, rows that repeat, and words of any length: right results, and no cost that grows with their square."""

import random
import time

import pytest
from pyspark.sql import functions as F

from tidemark.llm import fingerprints, jaccard_join, licenses, packing, pii, token_store, toxicity
from tidemark.llm.common import fresh_dir

from . import cases
from .test_operators import _falling, rows


def test_words_beside_a_value_are_whole():
    text = "Jane Doe " + "x" * 5000 + " a@b.co " + "y" * 5000 + " Anna end"
    spans = pii.find(text)
    assert pii._beside(text, spans[0], spans, *pii._words(text, spans))[2] == ["Anna", "Doe", "Jane"]
    # a value that touches others in one long word
    text = "Kim:a@b.co;" + "Lee," * 3 + "c@d.co,Max"
    spans = pii.find(text)
    words, begins = pii._words(text, spans)
    assert [text[a:b] for a, b in words] == ["Kim:", "a@b.co", ";Lee,Lee,Lee,", "c@d.co", ",Max"]
    assert pii._beside(text, spans[0], spans, words, begins)[2] == ["Kim", "Lee", "Max"]


def test_many_values_in_one_word_cost_their_number():
    text = ",".join(f"Ab{k}@x.example" for k in range(20_000))
    began = time.time()
    spans = pii.find(text)
    words, begins = pii._words(text, spans)
    for s in spans:
        pii._beside(text, s, spans, words, begins)
    assert len(spans) == 20_000 and time.time() - began < 20


def test_long_words_beside_values_disclose(spark):
    data = [(k, f"{cases.prose(k, 30)} Ottokar {'z' * 1000} ott@x.example {'q' * 1000} {cases.prose(k + 70, 30)}") for k in range(6)] + [(100 + k, cases.prose(k, 30)) for k in range(200)]
    told = pii.disclosures(pii.detected(spark.createDataFrame(data, "doc_id long, text string")))
    assert {(r.value, r.term) for r in told.collect()} == {("email:ott@x.example", "Ottokar")}


@pytest.mark.parametrize("doc_id", [None, 7])
def test_join_of_one_id(spark, doc_id):
    """Texts under one id, or none: each set is read from its own row alone, and repeated rows give it once."""
    rng = random.Random(3)
    texts = [cases.prose(k, 60) for k in range(60)]
    near = [" ".join(w if j != k else "changed" for j, w in enumerate(t.split())) for k, t in enumerate(texts)]
    data = [(doc_id, t) for t in texts + near + texts[:5] * 40] + [(500 + k, t + " end") for k, t in enumerate(texts[:20])]
    rng.shuffle(data)
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(4)
    want = cases.components([(i, t, None) for i, t in data], 4, 85)
    got = rows(jaccard_join.linked(df, words=4, percent=85).select("doc_id", "n_shingles", "component_id"))
    assert sum(got.values()) == len(data) and {(i, n, c) for i, n, c in got} == {(i, n, c) for i, n, c in want}
    assert jaccard_join.keep_one(df, words=4, percent=85).count() == 60


def test_followed_without_ids(spark):
    """Rows without an id over many blocks, and over few where these are at most so many."""
    data = [(None, f"n{i}") for i in range(3000)] + [(i, f"t{i}") for i in range(50)]
    df = fingerprints.keyed(spark.createDataFrame(data, "doc_id long, text string").repartition(4))
    order = _falling(data)
    want = rows(spark.createDataFrame([(i, t, nxt) for (i, t), (_, nxt) in zip(order, order[1:] + order[:1])], "i long, t string, n string"))
    assert rows(fingerprints.followed(df, rows_a_block=8).select("doc_id", "text", "next_text")) == want


def test_blocks_without_ids_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "RANGES", 2)
    monkeypatch.setattr(fingerprints, "MAX_PARTS", 3)
    df = fingerprints.keyed(spark.createDataFrame([(None, f"n{i}") for i in range(900)], "doc_id long, text string"))
    assert fingerprints._blocks(df.select("doc_id", "key"), 2)(df).select("block").distinct().count() <= 6


def test_labelled_documents_that_repeat(spark):
    ids = [k for k in range(60)]
    docs = spark.createDataFrame([(k, f"text {k}") for k in ids] + [(ids[1], "text 1")] * 500 + [(None, "x")], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in ids] * 3, "doc_id long, toxic int")
    got = toxicity.labelled(docs, labels, 1000)
    held = {r.doc_id for r in docs.filter(toxicity.held_out(F.col("doc_id"))).collect()}
    assert rows(got.select("doc_id")) == rows(spark.createDataFrame([(k,) for k in ids if k not in held], "doc_id long"))


def test_packing_of_rows_that_tie(spark, monkeypatch):
    monkeypatch.setattr(packing, "RANK_GROUP", 50)
    docs = spark.createDataFrame([(None, "")] * 3000 + [(3, "one two three")] * 500 + [(k, cases.prose(k, 40)) for k in range(200)], "doc_id long, text string").repartition(5)
    got = packing.packed(docs, 256).toPandas()
    assert len(got) == 3700
    for _, g in got.sort_values("offset").groupby("sequence_id"):
        assert (g.length.cumsum() - g.length == g.offset).all() and g.length.sum() <= 256


def test_shards_of_rows_that_repeat(spark):
    """Copies of one document are dealt to several tasks and read back in the order of ids."""
    docs = spark.createDataFrame([(5, "a b c")] * 2000 + [(k, f"d {k}") for k in range(50)], "doc_id long, text string").repartition(6)
    shards = token_store.write_shards(docs, fresh_dir(spark, "shards"), None, 2)
    assert shards.filter("n_docs > 1500").count() == 0
    got = token_store.read_shards(shards).orderBy("start").collect()
    assert len(got) == 2050 and [r.doc_id for r in got] == sorted(r.doc_id for r in got)
    assert all(b.start == a.start + a.n_tokens for a, b in zip(got, got[1:]))


def test_thousands_of_templates(spark):
    """Templates are met by their bands alone: each of those that stand in texts is found, and few others are looked at."""
    rng = random.Random(8)
    said = lambda n: " ".join(f"w{rng.randrange(3000)}" for _ in range(n))
    made = [(f"L{k}", said(40)) for k in range(1500)]
    docs = spark.createDataFrame([(k, f"{said(50)} {made[k * 7][1]} {said(50)}") for k in range(200)] + [(1000 + k, said(200)) for k in range(100)], "doc_id long, text string")
    got = {r.doc_id: {x.license for x in r.found} for r in licenses.matches(docs, made).collect()}
    assert all(got[k] == {f"L{k * 7}"} for k in range(200)) and not any(got[1000 + k] for k in range(100))
    met = licenses.candidates(docs.withColumn("key", F.xxhash64("text")), licenses.templates(spark, made)).count()
    assert met < 3 * 200


def test_full_texts(spark):
    """A whole licence is found as it is, reworded a little, and in copies of its row; a clause that it holds whole is told too."""
    texts = dict(licenses.FULL_TEXTS)
    edited = texts["MIT"].replace("publish", "print").replace("DAMAGES OR", "LOSS OR")
    rows = [(1, texts["BSD-3-Clause"]), (2, "x " + edited + " y"), (3, texts["Zlib"]), (3, texts["Zlib"]), (None, texts["ISC"]), (4, "no licence")]
    got = [(r.doc_id, r.licenses) for r in licenses.licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert {i: w for i, w in got} == {1: "BSD,BSD-3-Clause", 2: "MIT", 3: "Zlib", None: "ISC", 4: ""} and len(got) == 6
