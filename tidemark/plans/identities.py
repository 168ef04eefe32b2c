"""People who are one: components, and what becomes of cells and edges."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import components as C
from .proxies import _pick, _sql_pick, read

KINDS = ["connected", "messaged", "endorsed"]


def _pairs(spark, d):
    """Chains of seven, of which each second is a cycle and each tenth hangs on a hub."""
    k = F.col("c_custkey")
    c = read(spark, d, "customer")
    chain = c.filter(k % 7 > 0).select(k.alias("a"), (k + 1).alias("b"))
    return chain.union(c.filter(k % 14 == 0).select(k, k - 6)).union(c.filter(k % 70 == 1).select(k, F.lit(0).cast("long")))


def people_components(spark, d):
    return C.components(_pairs(spark, d))


def _same(spark, d):
    """Chains of three, and cycles of two."""
    k = F.col("c_custkey")
    c = read(spark, d, "customer")
    return c.filter((k % 9).isin(0, 1, 4)).select(k.alias("old"), (k + 1).alias("new")).union(c.filter(k % 9 == 5).select(k, k - 1))


def _edges(spark, d):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    rows = read(spark, d, "orders").select(_pick(KINDS, k % 3).alias("kind"), c.alias("src"), ((c * 7 + k % 5) % 150 + 1).alias("dst"), F.when(k % 4 > 0, F.concat(F.lit("n"), k)).alias("note"), F.col("o_orderdate").alias("since"), k.alias("_k"))
    return rows.groupBy("kind", "src", "dst").agg(F.max_by("note", "_k").alias("note"), F.min("since").alias("since"))


def people_merged_edges(spark, d):
    return C.merged_edges(_edges(spark, d), _same(spark, d))


def people_merged_cells(spark, d):
    """Cells along chains; the profile comes from those that go."""
    k = F.col("c_custkey")
    people = read(spark, d, "customer").select(k.alias("node"), F.when(k % 9 != 2, F.col("c_name")).otherwise("").alias("name"), F.when(k % 2 == 0, F.concat(F.lit("in/"), k)).alias("profile"))
    return C.merged_nodes(people, _same(spark, d), taken=("profile",))


_STAYS = "CASE {0} % 9 WHEN 0 THEN {0} + 2 WHEN 1 THEN {0} + 1 WHEN 5 THEN {0} - 1 ELSE {0} END"
QUERIES = {f.__name__: f for f in (people_components, people_merged_edges, people_merged_cells)}
SQL = {
    "people_components": """WITH RECURSIVE p AS (SELECT c_custkey AS a, c_custkey + 1 AS b FROM customer WHERE c_custkey % 7 > 0 UNION ALL SELECT c_custkey, c_custkey - 6 FROM customer WHERE c_custkey % 14 = 0 UNION ALL SELECT c_custkey, 0 FROM customer WHERE c_custkey % 70 = 1),
  both_ways AS (SELECT a, b FROM p UNION SELECT b, a FROM p), r(node, reach) AS (SELECT DISTINCT a, a FROM both_ways UNION SELECT r.node, w.b FROM r JOIN both_ways w ON w.a = r.reach) SELECT node, min(reach) AS root FROM r GROUP BY 1""",
    "people_merged_edges": f"""WITH o AS (SELECT {_sql_pick(KINDS, "o_orderkey % 3")} AS kind, o_custkey AS src, (o_custkey * 7 + o_orderkey % 5) % 150 + 1 AS dst, CASE WHEN o_orderkey % 4 > 0 THEN 'n' || o_orderkey END AS note, o_orderdate AS since, o_orderkey AS k FROM orders),
  e AS (SELECT kind, src, dst, arg_max_null(note, k) AS note, min(since) AS since FROM o GROUP BY 1, 2, 3),
  m AS (SELECT kind, {_STAYS.format("src")} AS s, {_STAYS.format("dst")} AS t, src, dst, note, since FROM e)
  SELECT kind, s AS src, t AS dst, arg_max(note, (src <> s OR dst <> t, src, dst)) FILTER (note IS NOT NULL) AS note, arg_max(since, (src <> s OR dst <> t, src, dst)) AS since FROM m WHERE s <> t GROUP BY 1, 2, 3""",
    "people_merged_cells": f"""WITH p AS (SELECT c_custkey AS node, CASE WHEN c_custkey % 9 <> 2 THEN c_name END AS name, CASE WHEN c_custkey % 2 = 0 THEN 'in/' || c_custkey END AS profile FROM customer), m AS (SELECT *, {_STAYS.format("node")} AS stays FROM p),
  g AS (SELECT stays, arg_min(name, node) FILTER (name IS NOT NULL) AS name, arg_min(profile, node) FILTER (profile IS NOT NULL) AS profile FROM m WHERE node <> stays GROUP BY 1)
  SELECT p.node, CASE WHEN p.name IS NULL THEN coalesce(g.name, CASE WHEN g.stays IS NULL THEN '' END) ELSE p.name END AS name, coalesce(g.profile, p.profile) AS profile FROM p LEFT JOIN g ON g.stays = p.node WHERE p.node IN (SELECT stays FROM m)""",
}
