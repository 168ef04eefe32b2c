"""Mixing sources to target weights: repetition rates by source, whole copies and one hash-seeded Bernoulli copy.

A document's extra copy is a draw of its own: a hash of its doc_id, its text and its source's seed, as a number from 0 up
to 1, lies below the fraction of its source's rate. The seed is one of SEEDS for each source, the one whose draws bring
the source's words nearest to its target: each of them alone is a draw with the fraction as its chance.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, cut, free_names, numbered, small

#: Seeds that a source's draws are tried with. Few long documents make a source miss its target by much with one seed alone.
SEEDS = 32


def n_words(text: Column) -> Column:
    """Words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(per: DataFrame, weights: list[float], share: float, cap: float) -> DataFrame:
    """source, source_size, target, rate of sources (source, source_size), a row each.

    Sources by code point, null last, take the weights in turn; `share` times all sizes is dealt out by weight. Sources
    above `cap` times their size stop there, and what is left is dealt out anew to the others, until none is above.
    """
    w = F.element_at(F.array(*map(F.lit, map(float, weights))), (F.col("place") % len(weights) + 1).cast("int"))
    table = cut(numbered(per, [F.col("source").asc_nulls_last()], "place").withColumn("weight", w))
    most = F.col("source_size") * F.lit(float(cap))
    total = (table.agg(F.sum("source_size")).first()[0] or 0) * float(share)
    level, full = 0.0, -1
    while True:  # levels rise, so a source that is at its cap stays there, and rounds end when no further one gets there
        capped = (most <= F.col("weight") * F.lit(level)) if full >= 0 else F.lit(False)
        n, spent, free = table.agg(F.count_if(capped), F.sum(F.when(capped, most)), F.sum(F.when(~capped, F.col("weight")))).first()
        if n == full or not free:
            break
        level, full = (total - (spent or 0.0)) / free, n
    level = F.lit(level) if full >= 0 and free else F.lit(float("inf"))
    target = F.least(most, level * F.col("weight"))
    rate = F.when(F.col("source_size") > 0, F.least(target / F.col("source_size"), F.lit(float(cap)))).otherwise(F.lit(0.0))
    return table.select("source", "source_size", target.alias("target"), rate.alias("rate"))


def draw(doc_id: Column, key: Column, seed: Column | int) -> Column:
    """A document's number from 0 up to 1, by its doc_id, its text's hash and a seed."""
    seed = seed if isinstance(seed, Column) else F.lit(seed)
    return F.shiftrightunsigned(F.xxhash64(seed.cast("int"), doc_id, key), 11) / F.lit(float(1 << 53))


def sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source, size, key (its text's hash) of each document; kept, as both the totals and the documents need them and only counting takes time."""
    return cut(docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), F.xxhash64("text").alias("key")))


def rates(sized: DataFrame, weights: list[float], share: float, cap: float, seed: int) -> DataFrame:
    """source, source_size, target, rate, seed: what decides how often each document of a source is taken."""
    targets = cut(source_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, cap))
    fractions = small(targets.select(F.col("source").alias("of"), (F.col("rate") - F.floor("rate")).alias("fraction")))
    met = sized.join(fractions, F.col("source").eqNullSafe(F.col("of")))
    # a row a seed, added up where it is made: one expression for all seeds, whose code would be as long as there are seeds
    tried = met.withColumn("seed", F.explode(F.sequence(F.lit(seed), F.lit(seed + SEEDS - 1))))
    drawn = F.when(draw(F.col("doc_id"), F.col("key"), F.col("seed")) < F.col("fraction"), F.col("size")).otherwise(F.lit(0))
    words = tried.groupBy("source", "seed").agg(F.sum(drawn).alias("words")).withColumnRenamed("source", "of")
    wanted = (F.col("rate") - F.floor("rate")) * F.col("source_size")
    off = words.join(small(targets), F.col("source").eqNullSafe(F.col("of"))).groupBy("of").agg(F.min(F.struct(F.abs(F.col("words") - wanted).alias("off"), "seed")).alias("best"))
    out = targets.join(small(cut(off)), F.col("source").eqNullSafe(F.col("of")), "left")
    return cut(out.select("source", "source_size", "target", "rate", F.coalesce(F.col("best.seed"), F.lit(seed)).cast("int").alias("seed")))


def times_taken(doc_id: Column, key: Column, rate: Column, seed: Column) -> Column:
    return (F.floor(rate) + (draw(doc_id, key, seed) < rate - F.floor(rate)).cast("int")).cast("int")


def mixture(docs: DataFrame, weights: list[float] = (5, 2, 1), share: float = 1.5, cap: float = 2.0, seed: int = 17) -> DataFrame:
    """What the mix takes of each document: doc_id, source, size, source_size, target, copies, taken.

    Null texts have size 0; null sources are one source, the last; repeated rows get a row each, and those of one doc_id,
    text and source one draw, while rows of one doc_id, or of none, with other texts have draws of their own. An empty
    table gives an empty one. Texts of any length are counted whole; docs' other columns play no part. Reruns agree.
    Sources hold any share of the rows: totals are combined before they are shuffled, and a source's rate is joined to
    documents by broadcast, or, beyond a bound, by a join that splits what is hot.
    """
    sized = sizes(docs)
    per = rates(sized, weights, share, cap, seed).withColumnRenamed("source", "of")
    met = sized.join(small(per), F.col("source").eqNullSafe(F.col("of")))
    out = met.withColumn("copies", times_taken(F.col("doc_id"), F.col("key"), F.col("rate"), F.col("seed")))
    return out.select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"))


def mix(docs: DataFrame, weights: list[float] = (5, 2, 1), share: float = 1.5, cap: float = 2.0, seed: int = 17) -> DataFrame:
    """The mix itself: each document as many times as `mixture` takes it, with docs' columns, whatever their names.

    Rates are fixed by totals over all documents, then documents are repeated where they are read: texts aren't
    shuffled. Nulls, empty texts, repeated rows and empty tables count as in `mixture`.
    """
    of, rate, own, n, again = free_names(docs, "_of", "_rate", "_seed", "_copies", "_again")
    per = rates(sizes(docs), weights, share, cap, seed).select(F.col("source").alias(of), F.col("rate").alias(rate), F.col("seed").alias(own))
    out = docs.join(small(per), docs["source"].eqNullSafe(F.col(of)))
    out = out.withColumn(n, times_taken(F.col("doc_id"), F.xxhash64("text"), F.col(rate), F.col(own))).filter(F.col(n) > 0)
    return out.withColumn(again, F.explode(F.sequence(F.lit(1), F.col(n)))).select(*docs.columns)
