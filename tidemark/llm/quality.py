"""Quality rules as weak supervision: rules vote or abstain, expectation-maximisation estimates them, the posterior decides.

Expressions of Spark alone. What is collected is a count for each pattern of votes, at most 3 ** len(RULES) rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, cut, free_names, small

# Frequent short words of the languages at hand.
COMMON_WORDS = ["the", "and", "of", "to", "in", "is", "that", "der", "die", "und", "von", "den", "das", "le", "la", "les", "des", "et", "que", "un", "el", "los", "de", "en", "y"]


def features(docs: DataFrame, text: str = "text", keep: list[str] = ("doc_id",)) -> DataFrame:
    """keep and n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, and what the rules need besides.

    n_repeat_words counts words inside 3-word windows that the text has twice or more. Windows are compared by xxhash64
    in one text; only texts with a repeated one sort them.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    df = docs.select(*keep, t.alias("_t"))
    df = df.select(*keep, "_t", F.regexp_extract_all("_t", F.lit(WORD), F.lit(0)).alias("_w"))
    df = df.select("*", F.size("_w").alias("_n"), F.filter(F.split("_t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("_lines"))
    w = F.col("_w")
    window = F.transform(F.sequence(F.lit(1), F.col("_n") - 2), lambda i: F.xxhash64(F.element_at(w, i), F.element_at(w, i + 1), F.element_at(w, i + 2)))
    df = df.select("*", F.when(F.col("_n") > 2, window).otherwise(F.array().cast("array<bigint>")).alias("_h"))
    repeats = F.size(F.array_distinct("_h")) < F.size("_h")
    placed = F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    df = df.select("*", F.when(repeats, F.sort_array(placed)).alias("_p"))
    p, last = F.col("_p"), F.size("_p") - 1
    twice = F.filter(p, lambda x, i: ((i > 0) & (F.get(p, i - 1)["h"] == x["h"])) | ((i < last) & (F.get(p, i + 1)["h"] == x["h"])))
    covered = F.size(F.array_distinct(F.flatten(F.transform(twice, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))))
    letters = F.regexp_count("_t", F.lit(r"\p{L}"))
    return df.select(
        *keep,
        F.col("_n").cast("long").alias("n_words"),
        F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        F.regexp_count("_t", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.when(p.isNotNull(), covered).otherwise(F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size("_lines").cast("long").alias("n_lines"),
        letters.cast("long").alias("n_letters"),
        F.regexp_count("_t", F.lit(r"\p{Lu}")).cast("long").alias("n_upper"),
        F.regexp_count("_t", F.lit("!")).cast("long").alias("n_shouts"),
        F.size(F.array_intersect(F.lit(COMMON_WORDS), "_w")).cast("long").alias("n_common"),
        F.size(F.array_distinct("_w")).cast("long").alias("n_distinct"),
    )


def rules() -> dict[str, Column]:
    """Votes on the features: -1 bad, 1 good, 0 abstains. Most rules know one kind of bad text and abstain on all else."""
    c, share = F.col, lambda a, b: F.col(a) / F.greatest(F.col(b), F.lit(1))
    enough = c("n_words") >= 20
    bad = {
        "repeats": share("n_repeat_words", "n_words") > 0.5,
        "word_length": enough & ((share("word_chars", "n_words") < 2.5) | (share("word_chars", "n_words") > 14)),
        "symbols": share("n_symbols", "n_words") > 0.2,
        "lines": (c("n_lines") >= 4) & (share("n_dup_lines", "n_lines") > 0.5),
        "common": enough & (c("n_common") == 0),
        "capitals": share("n_upper", "n_letters") > 0.5,
        "shouts": enough & (share("n_shouts", "n_words") > 0.3),
        "variety": c("n_words").between(50, 2000) & (share("n_distinct", "n_words") < 0.1),
        "letters": share("n_letters", "word_chars") < 0.5,
    }
    good = {"common": c("n_common") >= 3, "word_length": enough & share("word_chars", "n_words").between(3.5, 10.5)}
    return {k: F.when(v, F.lit(-1)).when(good.get(k, F.lit(False)), F.lit(1)).otherwise(F.lit(0)) for k, v in bad.items()}


def fit(patterns: dict[tuple[int, ...], int], rounds: int = 100, prior: float = 0.9) -> tuple[float, list[dict[int, float]]]:
    """log odds of good before any vote, and for each rule and vote the log of how much likelier it is in good texts.

    Rules are taken as independent given the class; a class has a chance of each of a rule's three votes, which tells
    how accurate the rule is. Bad texts are of many kinds, so an abstention speaks for neither side. It starts from
    trust in bad votes; votes never come to speak against their sign, and good votes, which most texts have, weigh
    little: so the two classes keep their meaning. Good texts are taken to be 80 to 95 of a hundred.
    """
    n = len(next(iter(patterns), ()))
    total = sum(patterns.values())
    odds = math.log(prior / (1 - prior))
    weights = [{-1: -4.0, 0: 0.0, 1: 0.25} for _ in range(n)]
    for _ in range(rounds if total else 0):
        good, counts = 0.0, [{v: [0.5, 0.5] for v in (-1, 0, 1)} for _ in range(n)]
        for votes, times in sorted(patterns.items()):
            p = 1 / (1 + math.exp(-max(-500.0, min(500.0, odds + sum(w[v] for w, v in zip(weights, votes))))))
            good += p * times
            for c, v in zip(counts, votes):
                c[v][0] += p * times
                c[v][1] += (1 - p) * times
        before, weights = (odds, weights), []
        for c in counts:
            sums = [sum(c[v][k] for v in c) for k in (0, 1)]
            ratio = {v: math.log(c[v][0] / sums[0]) - math.log(c[v][1] / sums[1]) for v in c}
            weights.append({-1: min(ratio[-1], -0.5), 0: 0.0, 1: min(max(ratio[1], 0.0), 0.25)})
        share = min(max(good / total, 0.8), 0.95)
        odds = math.log(share / (1 - share))
        if abs(before[0] - odds) + sum(abs(a[v] - b[v]) for a, b in zip(before[1], weights) for v in a) < 1e-9:
            break
    return odds, weights


def judged(feats: DataFrame, min_words: int = 50, most_repeated: int = 50, threshold: float = 0.5) -> DataFrame:
    """feats with base_failed, quality (posterior chance of good) and kept.

    feats should be stored: it is read for the counts of patterns and again for the result.
    """
    votes = rules()
    voted = feats.select("*", F.array(*votes.values()).alias("votes"))
    log_prior, weights = fit({tuple(r[0]): r[1] for r in voted.groupBy("votes").count().collect()})
    score = F.lit(log_prior)
    for k, w in enumerate(weights):
        v = F.get("votes", F.lit(k))
        score = score + F.when(v == -1, F.lit(w[-1])).when(v == 1, F.lit(w[1])).otherwise(F.lit(w[0]))
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > most_repeated * F.col("n_words"))
    out = voted.withColumns({"base_failed": failed, "quality": 1 / (1 + F.exp(-score))})
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= threshold))


def quality(docs: DataFrame, keep: list[str] = ("doc_id",)) -> DataFrame:
    """A row for each document: keep, features, votes, base_failed, quality, kept.

    Null texts have no words and fail the base; repeated rows get a row each; an empty table gives none. Texts of any
    length count whole; docs' other columns play no part, whatever their names. Equal posteriors get equal verdicts.
    Texts are read once: their features, a few numbers each, are kept for the two passes over them.
    """
    return judged(cut(features(docs, keep=keep)))


def keep_good(docs: DataFrame) -> DataFrame:
    """docs without the documents that fail; a document is known by its doc_id and its text's hash, so repeated rows go or stay together.

    Null and empty texts go, as they fail the base; an empty table gives an empty one. docs' columns may have any names.
    """
    key, i, k = free_names(docs, "_text", "_id", "_key")
    marked = docs.select("doc_id", "text", F.xxhash64("text").alias("key"))
    failed = quality(marked, ["doc_id", "key"]).filter("not kept").select(F.col("doc_id").alias(i), F.col("key").alias(k)).distinct()
    rows = docs.withColumn(key, F.xxhash64("text"))
    return rows.join(small(cut(failed)), F.col("doc_id").eqNullSafe(F.col(i)) & (F.col(key) == F.col(k)), "left_anti").drop(key)
