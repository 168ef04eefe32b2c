"""Joins: lookups, updates, suppression, best matches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Most rows, and about how many bytes, of a side that is broadcast.
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 32 << 20
_FIXED = ("byte", "short", "integer", "long", "float", "double", "boolean", "date", "timestamp", "timestamp_ntz")


def small(df: DataFrame, limit: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> DataFrame:
    """df with a broadcast hint if it has at most `limit` rows and `size` bytes, else df: Spark then joins by a shuffle."""
    wide = [F.coalesce(F.octet_length(F.col(f"`{f.name}`").cast("string")), F.lit(0)) for f in df.schema.fields if f.dataType.typeName() not in _FIXED]
    rows, held = df.limit(limit + 1).agg(F.count(F.lit(1)), F.sum(sum(wide, F.lit(16 + 16 * len(df.columns))))).first()
    return F.broadcast(df) if rows <= limit and (held or 0) <= size else df


def lookup(df: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Left join on key with a table that has a row a key."""
    return df.join(small(table), key, "left")


def latest(df: DataFrame, key: str, order: str) -> DataFrame:
    """The last row of each key by order; of rows that tie, the one with the greatest cells."""
    rest = [F.desc(f.name) for f in df.schema.fields if f.name not in (key, order) and f.dataType.typeName() not in ("map", "variant")]
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(key).orderBy(F.desc(order), *rest))).filter("_r = 1").drop("_r")


def update(master: DataFrame, incoming: DataFrame, key: str, order: str) -> DataFrame:
    """master with incoming's cells that aren't null or blank, and its new columns; of several rows of a key the last counts."""
    new = latest(incoming, key, order).drop(order)
    cells = [c for c in new.columns if c != key]
    new = new.select(F.col(key), *(F.col(c).alias(f"_{c}") for c in cells))
    filled = {c: F.when(F.trim(F.col(f"_{c}").cast("string")) != "", F.col(f"_{c}")) for c in cells}
    out = master.join(new, key, "left")
    return out.select(*(F.coalesce(filled[c], F.col(c)).alias(c) if c in filled else F.col(c) for c in master.columns), *(filled[c].alias(c) for c in cells if c not in master.columns))


def fill(df: DataFrame, other: DataFrame, key: str, columns: list[str], order: str) -> DataFrame:
    """df with its missing cells filled from the last row of the key in other."""
    new = latest(other, key, order).select(F.col(key), *(F.col(c).alias(f"_{c}") for c in columns))
    blank = lambda c: F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))) == ""
    return df.join(small(new), key, "left").withColumns({c: F.when(blank(c), F.col(f"_{c}")).otherwise(F.col(c)) for c in columns}).drop(*(f"_{c}" for c in columns))


def suppress(df: DataFrame, column: str, blocked: DataFrame) -> DataFrame:
    """df without rows whose value, in lower case, is in blocked's one column; rows without a value stay."""
    b = blocked.select(F.lower(F.trim(F.col(blocked.columns[0]))).alias("_b")).filter("_b is not null").distinct()
    return df.join(small(b), F.lower(F.trim(F.col(column))) == F.col("_b"), "left_anti")


def within(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    return df.join(other.select(key).distinct(), key, "left_semi")


def best_match(df: DataFrame, candidates: DataFrame, key: str, score: Column, least: float, position: str = "pos") -> DataFrame:
    """df with the candidate of its key that scores most, if that is enough; the first by position of equal ones."""
    met = df.join(candidates, key).withColumn("match_score", score).filter(F.col("match_score") >= least)
    first = F.row_number().over(Window.partitionBy(key).orderBy(F.desc("match_score"), position))
    best = met.withColumn("_r", first).filter("_r = 1").select(key, *(c for c in candidates.columns if c != key), "match_score")
    return df.join(best, key, "left")


def waterfall(df: DataFrame, sources: list[tuple[str, DataFrame, str]], value: str) -> DataFrame:
    """df with value and lookup_method of the first source that has its key: sources are (method, table (key, value), key)."""
    found, method, out = [], [], df
    for name, table, key in sources:
        out = out.join(small(table.select(F.col(key), F.col(value).alias(f"_{name}"))), key, "left")
        found.append(F.col(f"_{name}"))
        method.append(F.when(F.col(f"_{name}").isNotNull(), F.lit(name)))
    return out.withColumns({value: F.coalesce(*found), "lookup_method": F.coalesce(*method)}).drop(*(f"_{n}" for n, _, _ in sources))
