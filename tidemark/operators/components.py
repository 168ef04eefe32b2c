"""Nodes that are one: connected components of pairs, who survives, and what becomes of cells and edges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.shared import cut
from .joins import small


def _stars(edges: DataFrame) -> DataFrame:
    """edges (a, b), b the smaller: each node's larger neighbours, then its smaller ones, are tied to its smallest.

    Connectivity stays; the longest way to a component's smallest node shrinks by more than half.
    """
    both = edges.union(edges.select("b", "a"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    least = large.groupBy("a").agg(F.min("b").alias("m"))
    return large.join(least, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("x")).select("x.*").filter("a <> b").distinct()


def components(pairs: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, root: each node of pairs and the smallest that it is tied to, over any number of steps. Loops and nulls tie nothing.

    Large and small stars by turns until nothing changes: some log2 of the longest chain many rounds, each a few joins on
    a node; a hub of any degree is met by its neighbours' rows, never gathered.
    """
    edges = pairs.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).filter("a <> b").distinct()
    mark = lambda df: tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38)"))).first())
    edges = cut(edges)
    now, before = mark(edges), None
    while now != before:
        edges = cut(_stars(edges))
        now, before = mark(edges), now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(edges.select("b", "b").distinct())


def survivors(same: DataFrame) -> DataFrame:
    """old, new of all nodes of same(old, new) that go, chains followed to their end.

    Of a component the node that stays is one that never goes itself; the smallest of several, or where all go (a cycle)
    the smallest of all.
    """
    of = components(same, "old", "new")
    goes = same.filter("old <> new").select(F.col("old").alias("node")).distinct().withColumn("goes", F.lit(True))
    ranked = of.join(goes, "node", "left").withColumn("goes", F.coalesce("goes", F.lit(False)))
    stays = ranked.groupBy("root").agg(F.min(F.struct("goes", "node")).alias("x")).select("root", F.col("x.node").alias("new"))
    return cut(of.join(stays, "root").select(F.col("node").alias("old"), "new").filter("old <> new"))


def _blank(c: Column) -> Column:
    return F.trim(F.coalesce(c.cast("string"), F.lit(""))) == ""


def merged_nodes(people: DataFrame, same: DataFrame, taken: tuple[str, ...] = ()) -> DataFrame:
    """people (node and cells) after those of same(old, new) became one, chains and cycles included.

    Empty cells of the one that stays are filled from those that go, the smallest first; cells named in `taken` come from
    those that go wherever one has them. A node of `same` that people doesn't have takes no part.
    """
    cells = [c for c in people.columns if c != "node"]
    lost = survivors(same).join(people.select(F.col("node").alias("old")), "old", "left_semi")
    # where the one that stays isn't among the people, the smallest that goes takes its place
    there = people.select(F.col("node").alias("new"), F.lit(True).alias("_there"))
    lost = lost.join(there, "new", "left")
    heirs = lost.filter("_there IS NULL").groupBy("new").agg(F.min("old").alias("_heir"))
    lost = cut(lost.join(heirs, "new", "left").select("old", F.coalesce("_heir", "new").alias("new")).filter("old <> new"))
    gone = people.join(small(lost.select(F.col("old").alias("node"), "new")), "node")
    fill = gone.groupBy(F.col("new").alias("node")).agg(*(F.min_by(c, F.when(~_blank(F.col(c)), F.col("node"))).alias(f"_{c}") for c in cells))
    kept = people.join(small(lost.select(F.col("old").alias("node"))), "node", "left_anti").join(fill, "node", "left")
    cell = lambda c: F.coalesce(f"_{c}", c) if c in taken else F.when(_blank(F.col(c)), F.col(f"_{c}")).otherwise(F.col(c))
    return kept.select("node", *(cell(c).alias(c) for c in cells))


def moved_edges(edges: DataFrame, same: DataFrame) -> DataFrame:
    """edges (src, dst ...) with both ends renamed to those that stay, loops among one component gone; _moved, _from: whether an end was renamed, and the old ends."""
    lost = survivors(same)
    src, dst = small(lost.select(F.col("old").alias("src"), F.col("new").alias("_s"))), small(lost.select(F.col("old").alias("dst"), F.col("new").alias("_d")))
    out = edges.join(src, "src", "left").join(dst, "dst", "left")
    rest = [c for c in edges.columns if c not in ("src", "dst")]
    return out.select(
        F.coalesce("_s", "src").alias("src"), F.coalesce("_d", "dst").alias("dst"), *rest, F.coalesce(F.col("_s").isNotNull() | F.col("_d").isNotNull(), F.lit(False)).alias("_moved"), F.struct("src", "dst").alias("_from"),
    ).filter("src <> dst")


def merged_edges(edges: DataFrame, same: DataFrame, kind: str = "kind") -> DataFrame:
    """Edges of several kinds (kind, src, dst and cells) after people became one: of edges of a kind between the same two, one stays.

    Cell by cell, an edge that moved goes before one that was there, of several that moved the last by old ends; a null
    cell takes nothing's place.
    """
    cells = [c for c in edges.columns if c not in (kind, "src", "dst")]
    order = F.struct("_moved", "_from")
    return moved_edges(edges, same).groupBy(kind, "src", "dst").agg(*(F.max_by(c, F.when(F.col(c).isNotNull(), order)).alias(c) for c in cells))
