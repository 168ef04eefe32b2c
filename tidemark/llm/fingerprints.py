"""Canonical exact digests: Unicode, case and white-space folding, two chained xxhash64, bytes compared inside equal buckets.

Expressions of Spark alone. Folding: NFKC, by the Unicode library that Spark comes with, for texts that aren't ASCII;
then lower case with sharp s and final sigma folded, then runs of white space become one space and those at the ends go.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, small, stored

#: Quantiles of doc_ids, and parts of each at most, that `followed` cuts documents into.
RANGES, MAX_PARTS = 256, 1024


def nfkc(text: Column) -> Column:
    """Normalisation form KC of a text that isn't null."""
    composed = F.java_method(F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), text, F.lit(True))
    return F.when(F.octet_length(text) != F.char_length(text), composed).otherwise(text)


def canonical(text: Column) -> Column:
    """The canonical form of a text; null counts as empty."""
    lowered = F.replace(F.replace(F.lower(nfkc(F.coalesce(text, F.lit("")))), F.lit("ß"), F.lit("ss")), F.lit("ς"), F.lit("σ"))
    # single spaces, most of all white space, aren't matched
    return F.trim(F.regexp_replace(lowered, r"[\s\p{Z}\x85&&[^ ]][\s\p{Z}\x85]*| [\s\p{Z}\x85]+", " "))


def wide_hash(canon: Column) -> list[Column]:
    """128 bits of a canonical text, as two columns: its xxhash64, and that with another seed."""
    return [F.xxhash64(canon), F.xxhash64(F.lit(0x7469646D), canon)]


def collisions(docs: DataFrame, hashed: DataFrame) -> DataFrame:
    """h1, h2, canon, nth for buckets of equal hashes that hold different canonical texts: none, as good as always.

    hashed has key (the text's own hash), h1, h2 of docs (key, text). Buckets are counted by hash first; only texts in
    buckets of several rows meet, and equal ones are joined before they are shuffled, so thousands of copies are one row
    a task, and are brought to their canonical form once.
    """
    several = hashed.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("h1", "h2")
    met = hashed.groupBy("key", "h1", "h2").agg(F.count(F.lit(1)).alias("n")).join(small(cut(several)), ["h1", "h2"], "left_semi").select("key", "h1", "h2")
    texts = docs.select("key", "text").join(small(cut(met)), "key").select("h1", "h2", "text").distinct()
    texts = texts.select("h1", "h2", canonical(F.col("text")).alias("canon")).distinct()
    mixed = cut(texts.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("h1", "h2"))
    if mixed.isEmpty():
        return mixed.select("h1", "h2", F.lit("").alias("canon"), F.lit(0).alias("nth"))
    nth = F.row_number().over(Window.partitionBy("h1", "h2").orderBy("canon")) - 1
    return cut(texts.join(small(mixed), ["h1", "h2"], "left_semi").withColumn("nth", nth))


def _named(h1: Column, h2: Column, nth: Column | None = None) -> Column:
    name = F.concat(F.lpad(F.lower(F.hex(h1)), 16, "0"), F.lpad(F.lower(F.hex(h2)), 16, "0"))
    return name if nth is None else F.when(F.coalesce(nth, F.lit(0)) > 0, F.concat(name, F.lit("-"), nth)).otherwise(name)


def hashes(df: DataFrame, text: str, a: str, b: str) -> DataFrame:
    """df with the wide hash of a text column's canonical form, in columns a and b."""
    canon = df.select("*", canonical(F.col(text)).alias("_canon"))
    return canon.select(*df.columns, *(h.alias(n) for h, n in zip(wide_hash(F.col("_canon")), (a, b))))


def with_fingerprint(df: DataFrame, text: str, a: str, b: str, name: str, clashes: DataFrame) -> DataFrame:
    """df, hashed, with the fingerprint of a text column: 32 hexadecimal digits; `-n` follows where bytes differ under one hash."""
    k = clashes.withColumnsRenamed({"h1": "_k1", "h2": "_k2", "canon": "_kc", "nth": "_nth"})
    met = df.withColumn("_canon", canonical(F.col(text))).join(small(k), (F.col(a) == F.col("_k1")) & (F.col(b) == F.col("_k2")) & (F.col("_canon") == F.col("_kc")), "left")
    return met.select(*df.columns, _named(F.col(a), F.col(b), F.col("_nth")).alias(name))


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text (null as empty), key (its hash)."""
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("key", F.xxhash64("text"))


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint, class_id (smallest doc_id of the class, null if none has one), n_copies: the classes of equal canonical texts.

    Null texts count as empty; an empty table gives none. A text is brought to its canonical form once.
    """
    docs = keyed(docs)
    hashed = stored(hashes(docs, "text", "h1", "h2").drop("text"), "hashes")
    clashes = collisions(docs, hashed)
    if clashes.isEmpty():
        named = hashed.select("doc_id", _named(F.col("h1"), F.col("h2")).alias("fingerprint"))
    else:
        named = cut(with_fingerprint(hashes(docs, "text", "h1", "h2"), "text", "h1", "h2", "fingerprint", clashes).select("doc_id", "fingerprint"))
    classes = named.groupBy("fingerprint").agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("n_copies"))
    return named.join(classes, "fingerprint")


def _blocks(ids: DataFrame, rows_a_block: int):
    """A function that adds a column `block` to a table with doc_id and key: about rows_a_block rows each, blocks in the order of ids.

    Quantiles of all ids, and of the ids between two of them, are the bounds, so ids may lie in clumps. An id that fills
    several parts, and rows without an id, are parted by key, into RANGES * MAX_PARTS parts at most.
    """
    spark = ids.sparkSession
    n, rows, bounds = ids.agg(F.count("doc_id"), F.count(F.lit(1)), F.percentile_approx("doc_id", [i / RANGES for i in range(RANGES + 1)], 10_000)).first()
    parts = max(1, min(MAX_PARTS, n // RANGES // rows_a_block))
    low = F.array(*(F.lit(int(b)) for b in sorted(set(bounds or [0]))))
    id_ = F.col("doc_id")
    upper = F.greatest(F.size(F.filter(low, lambda b: b <= id_)), F.lit(1))
    fine = ids.filter("doc_id is not null").groupBy(upper.alias("_upper")).agg(F.percentile_approx("doc_id", [i / parts for i in range(parts)], 10_000).alias("_bounds"))
    fine = cut(fine)  # RANGES rows at most
    often = {r[0]: r[1] for r in fine.select(F.explode("_bounds").alias("i")).groupBy("i").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").collect()}
    often |= {b: max(often.get(b, 0), bounds.count(b) * parts) for b in set(bounds or []) if bounds.count(b) > 2}
    hot = F.broadcast(spark.createDataFrame([*often.items(), (None, max(1, min(RANGES * MAX_PARTS, (rows - n) // rows_a_block)))], "_often long, _n long"))
    fine = F.broadcast(fine.withColumn("_bounds", F.array_distinct("_bounds")))

    def put(df: DataFrame) -> DataFrame:
        met = df.withColumn("_place", upper).join(fine, F.col("_place") == F.col("_upper"), "left")
        inner = F.size(F.filter(F.coalesce("_bounds", F.array().cast("array<bigint>")), lambda b: b <= id_))
        met = met.select(*df.columns, F.when(id_.isNull(), F.lit(-1)).otherwise(F.col("_place")).alias("_place"), F.when(id_.isNull(), F.lit(0)).otherwise(inner).alias("_inner"))
        met = met.join(hot, id_.eqNullSafe(F.col("_often")), "left")
        turn = F.floor((F.col("key") / F.lit(float(1 << 64)) + 0.5) * F.coalesce("_n", F.lit(1)))
        # an id that fills several parts is a bound, so it is the least of its part: others there come after it
        other = (F.col("_n").isNull()).cast("int")
        return met.select(*df.columns, F.struct(F.col("_place").alias("place"), F.col("_inner").alias("inner"), other.alias("other"), turn.alias("turn")).alias("block"))

    return put


def followed(docs: DataFrame, rows_a_block: int = 64) -> DataFrame:
    """docs (doc_id, key, text and any more) with next_text and so on: the next one by falling doc_id; after the last, the first.

    Documents fall into blocks of about equal counts (see _blocks). Texts are shuffled once, by block; the first document
    of each block, at most RANGES * MAX_PARTS and those of hot ids, also goes to the block before as its last row's
    successor. Null ids come last; equal ids by falling key, then text.
    """
    ids = docs.select("doc_id", "key")
    put = _blocks(ids, rows_a_block)
    heads = put(ids).groupBy("block").agg(F.max(F.struct("doc_id", "key")).alias("head"))
    falling = Window.orderBy(F.desc("block"))
    last = F.min("block").over(Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    heads = cut(heads.select("block", F.col("head.doc_id").alias("head_id"), F.col("head.key").alias("head_key"), F.coalesce(F.lag("block").over(falling), last).alias("to")))
    cols = docs.columns
    rows = put(docs).join(F.broadcast(heads), "block")
    own = F.struct(F.col("block"), F.lit(False).alias("guest"))
    there = F.when(F.col("doc_id").eqNullSafe(F.col("head_id")) & (F.col("key") == F.col("head_key")), F.struct(F.col("to").alias("block"), F.lit(True).alias("guest")))
    rows = rows.select(*cols, F.explode(F.array_compact(F.array(own, there))).alias("at"))
    rows = rows.select(*cols, F.col("at.block").alias("block"), F.col("at.guest").alias("guest"))
    within = Window.partitionBy("block").orderBy("guest", F.desc_nulls_last("doc_id"), F.desc("key"), F.desc("text"))
    rows = rows.select(*cols, "guest", *(F.lead(c).over(within).alias(f"next_{c}") for c in cols if c not in ("doc_id", "key")))
    return rows.filter(~F.col("guest")).drop("guest")


def edited(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text, key, h1, h2) with n_chars, next_text, next_h1, next_h2, edited, e1, e2."""
    rows = followed(docs)
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    rows = rows.withColumn("edited", F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half)))
    return hashes(rows.withColumn("n_chars", n.cast("long")), "edited", "e1", "e2")


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has its last half's code points replaced by the next document's first ones. Likeness of two
    fingerprints is 1 where they, and the canonical bytes under them, are equal, else 0: an exact digest has no nearer
    and farther. Null texts count as empty, and texts of any length whole; repeated rows get a row each; equal doc_ids
    follow each other by the hashes of their texts; an empty table gives none. docs' other columns play no part,
    whatever their names. A text, and its edited text, are brought to their canonical form once; copies, to compare
    their bytes, once more in all.
    """
    docs = keyed(docs)
    rows = edited(hashes(docs, "text", "h1", "h2"))

    def alike(a: str, b: str, other: str) -> Column:
        equal = (F.col("h1") == F.col(a)) & (F.col("h2") == F.col(b))
        return F.when(equal, (canonical(F.col("text")) == canonical(F.col(other))).cast("double")).otherwise(F.lit(0.0))

    near = {"near_edited": alike("e1", "e2", "edited"), "near_next": alike("next_h1", "next_h2", "next_text")}
    told = stored(rows.select("doc_id", "key", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "h1", "h2", "e1", "e2", *(c.alias(n) for n, c in near.items())), "fingerprints")
    clashes = collisions(docs, told)
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    if clashes.isEmpty():
        return told.withColumns({"fingerprint": _named(F.col("h1"), F.col("h2")), "edited_fingerprint": _named(F.col("e1"), F.col("e2"))}).select(*names)
    rows = rows.withColumns({"edited_sha256": F.sha2("edited", 256), **near})
    rows = with_fingerprint(rows, "text", "h1", "h2", "fingerprint", clashes)
    return with_fingerprint(rows, "edited", "e1", "e2", "edited_fingerprint", clashes).select(*names)
