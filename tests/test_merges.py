"""People who are one, addresses in any case of letters, cells with literals, categories."""

import ast
import json
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from tidemark.functions import categories, text
from tidemark.operators import ads, components, contacts, graph
from tidemark.sources import shared


def one(spark, value, expression):
    return spark.createDataFrame([(value,)], "x string").select(expression(F.col("x")).alias("y")).first().y


def _brute(pairs):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        if a is not None and b is not None and a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {x: find(x) for x in list(root)}


def test_components(spark):
    rng = random.Random(2)
    pairs = [(1, 2), (2, 3), (7, 7), (None, 4), (20, 21), (21, 22), (22, 20)] + [(k, k + 1) for k in range(100, 163)] + [(rng.randrange(1000, 1400), rng.randrange(1000, 1400)) for _ in range(180)]
    df = spark.createDataFrame(pairs, "a long, b long")
    assert {r.node: r.root for r in components.components(df).collect()} == _brute(pairs)
    assert components.components(df.filter("false")).count() == 0
    names = df.filter("a IS NOT NULL").select(F.concat(F.lit("n"), "a").alias("a"), F.concat(F.lit("n"), "b").alias("b"))
    assert {r.node: r.root for r in components.components(names).collect()} == _brute([(f"n{a}", f"n{b}") for a, b in pairs if a is not None])


def test_a_hub_of_100_000(spark):
    began = time.time()
    df = spark.range(1, 100_001).select(F.lit(0).cast("long").alias("a"), F.col("id").alias("b"))
    got = components.components(df).agg(F.count(F.lit(1)), F.max("root")).first()
    assert tuple(got) == (100_001, 0) and time.time() - began < 120


def test_survivors_of_chains_and_cycles(spark):
    same = spark.createDataFrame([(1, 2), (2, 3), (10, 11), (11, 10), (20, 22), (20, 21), (30, 30)], "old long, new long")
    assert {(r.old, r.new) for r in components.survivors(same).collect()} == {(1, 3), (2, 3), (11, 10), (20, 21), (22, 21)}
    people = spark.createDataFrame([(1, "a", "p1"), (2, "", "p2"), (3, None, "p3"), (10, "x", None), (11, "y", "p11"), (5, "z", None)], "node long, name string, profile string")
    got = {(r.node, r.name, r.profile) for r in components.merged_nodes(people, same, taken=("profile",)).collect()}
    assert got == {(3, "a", "p1"), (10, "x", "p11"), (5, "z", None)}
    # someone merged into a person who isn't there stays
    lost = spark.createDataFrame([(5, 6), (3, 6)], "old long, new long")
    assert {(r.node, r.name) for r in components.merged_nodes(people.filter("node in (3, 5)"), lost).collect()} == {(3, "z")}


def test_edges_of_merged_people(spark):
    edges = [("knows", 1, 9, 5, "old"), ("knows", 3, 9, 7, None), ("knows", 2, 9, None, "later"), ("sent", 2, 9, 1, None), ("knows", 9, 1, 4, "in"), ("knows", 1, 2, 8, "loop"), ("knows", 8, 9, 2, "stays")]
    df = spark.createDataFrame(edges, "kind string, src long, dst long, n long, note string")
    same = spark.createDataFrame([(1, 2), (2, 3)], "old long, new long")
    got = {tuple(r) for r in components.merged_edges(df, same).select("kind", "src", "dst", "n", "note").collect()}
    assert got == {("knows", 3, 9, 5, "later"), ("sent", 3, 9, 1, None), ("knows", 9, 3, 4, "in"), ("knows", 8, 9, 2, "stays")}


def test_names_that_thousands_share(spark):
    """5,000 people without an address and 5,000 with one, of one name: no pairs of different companies are made."""
    synthetic = spark.range(5000).select(F.concat(F.lit("s"), "id").alias("node"), F.lit("ann lee").alias("name"), F.concat(F.lit("firm"), "id", F.lit("x")).alias("company"))
    real = spark.range(5000).select(F.concat(F.lit("r"), "id").alias("node"), F.lit("ann lee").alias("name"), F.concat(F.lit("Firm"), F.col("id"), F.lit("x Ltd")).alias("company"))
    got = graph.identity(synthetic, real, block=9).agg(F.count(F.lit(1)), F.min("tier"), F.count_if(F.substring("node", 2, 9) != F.substring("match", 2, 9))).first()
    assert got[0] > 4000 and got[1] == 2 and got[2] == 0


def test_identity_tiers(spark):
    synthetic = spark.createDataFrame([("s1", "a", "x"), ("s2", "b", "Acme"), ("s3", "b", "zed"), ("s4", "c", None), ("s5", "b", "bo"), ("s6", "d", "q")], "node string, name string, company string")
    real = spark.createDataFrame([("r1", "a", None), ("r2", "b", "ACME Corp"), ("r3", "b", "Other bo"), ("r4", "b", "Robo"), ("r5", "c", "y"), ("r5", "c", "w")], "node string, name string, company string")
    assert {tuple(r) for r in graph.identity(synthetic, real).collect()} == {("s1", "r1", 1), ("s2", "r2", 2), ("s4", "r5", 1)}


def test_addresses_in_any_case(spark):
    people = spark.createDataFrame([("Ann@X.example", ["B@x.example"]), ("cy@x.example", None)], "email string, alternates array<string>")
    asked = spark.createDataFrame([("Ann@X.example",), ("ann@x.example",), (" b@X.example ",), ("CY@x.example",), ("no@x.example",), (None,)], "email string")
    got = {r.email: r.primary_email for r in contacts.by_any_address(people, asked).collect()}
    assert got == {"Ann@X.example": "Ann@X.example", "ann@x.example": "Ann@X.example", " b@X.example ": "Ann@X.example", "CY@x.example": "cy@x.example", "no@x.example": None, None: None}
    add = lambda new: people.filter("alternates IS NOT NULL").select(contacts.with_alternate(F.col("email"), F.col("alternates"), F.lit(new)).alias("a")).first().a
    assert add("b@x.example") == ["B@x.example"] and add("ANN@x.example") == ["B@x.example"] and add(" New@x.example") == ["B@x.example", "new@x.example"] and add(None) == ["B@x.example"]


LITERALS = [
    ["it's", "b"], ["O'Brien", 'say "hi"'], ["a, b", "c; d"], [["x", "y"], None, 1, 2.5, True], {"a": None, "b": {"c": "it's \"x\""}}, ["back\\slash", "\\'", '\\"'], ["None", "True", "(a)"], ["né", "日本", "tab\t", "nl\n"], [], {}, ("a",), ("a", 'b"', "c'"), {"k": ["'", '"', "\\"]},
]


@pytest.mark.parametrize("value", LITERALS)
def test_literals_as_python_writes_and_reads_them(spark, value):
    want = json.loads(json.dumps(value))
    assert json.loads(one(spark, repr(value), text.literal_json)) == want
    assert json.loads(one(spark, json.dumps(value), text.literal_json)) == want
    assert ast.literal_eval(repr(value)) == value


@pytest.mark.parametrize(("cell", "want"), [
    ('["it\'s", "b"]', ["it's", "b"]), ("['O\\'Brien', \"it's\"]", ["O'Brien", "it's"]), ("['a, b', 'c']", ["a, b", "c"]), ("('x', 'y')", ["x", "y"]), ("[it's, b]", ["it's", "b"]), ("[1, 2]", ["1", "2"]), ("['\\x41']", ["A"]), ("(555) 010-2345", ["(555) 010-2345"]), ("[open", ["open"]),
])
def test_list_cells(spark, cell, want):
    assert one(spark, cell, text.parse_list) == want


def _by_patterns(value, table):
    counts = {name: n for name, ps in table.items() if (n := sum(len(re.findall(p, value or "", re.IGNORECASE)) for p in ps))}
    best = max(counts.items(), key=lambda x: x[1], default=("unknown", 0))
    return best[0], best[1], list(counts)


def test_categories(spark):
    rng = random.Random(1)
    words = "roof repair roofing leak drain rent rental monthly studio home house sell selling your buy a dream loan mortgage agent join our team window windows door patio clean cleaning éant ant control rat mice tax auto car school dr. , pc".split()
    texts = [" ".join(rng.choice(words) for _ in range(rng.randrange(1, 25))) for _ in range(250)] + ["", None, "ROOF REPAIR roof repair", "nothing here"]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k long, text string")
    for table in (categories.INTENTS, categories.TRADES):
        got = {r.k: (r.category, r.n, r.categories) for r in ads.categorised(df, F.col("text"), table).collect()}
        assert got == {k: _by_patterns(t, table) for k, t in enumerate(texts)}
    got = {r.k: r.s for r in df.select("k", categories.first_matched(F.col("text"), categories.SECTORS).alias("s")).collect()}
    assert got == {k: next((name for name, ps in categories.SECTORS.items() if any(re.search(p, t or "", re.IGNORECASE) for p in ps)), None) for k, t in enumerate(texts)}


def test_places_of_equal_scores(spark):
    """One score that a third of all rows have is no group."""
    df = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % 50).alias("s"))
    rows = sorted(df.collect(), key=lambda r: (-r.s, r.id))
    got = {r.id: r.at for r in shared.numbered(df, [F.desc("s"), F.col("id")], "at").collect()}
    assert got == {r.id: k + 1 for k, r in enumerate(rows)}
    assert shared.numbered(df.filter("false"), [F.col("id")], "at").count() == 0
