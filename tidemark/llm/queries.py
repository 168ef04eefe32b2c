"""The registered queries of this subpackage: one for each operator, over its whole table."""

from __future__ import annotations

from . import alignment, decontaminate, fingerprints, jaccard_join, licenses, mixing, packing, pii, quality, token_store, toxicity, variants, warc
from .common import read


def op1_document_fingerprints(spark, sf_dir):
    return fingerprints.fingerprints(read(spark, sf_dir, "documents"))


def op2_quality_rules(spark, sf_dir):
    return quality.quality(read(spark, sf_dir, "documents")).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality")


def op3_ngram_jaccard_join(spark, sf_dir):
    return jaccard_join.linked(read(spark, sf_dir, "documents"), words=4, percent=85)


def op4_pii(spark, sf_dir):
    return pii.report(read(spark, sf_dir, "documents"))


def op5_best_fit_packing(spark, sf_dir):
    return packing.packed(read(spark, sf_dir, "documents"))


def op6_source_mixing(spark, sf_dir):
    return mixing.mixture(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies")


def op7_warc(spark, sf_dir):
    return warc.archived(read(spark, sf_dir, "pages"))


def op8_toxicity(spark, sf_dir):
    return toxicity.toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op9_license_scans(spark, sf_dir):
    return licenses.licenses(read(spark, sf_dir, "documents"))


def op10_token_binary(spark, sf_dir):
    return token_store.encoded(read(spark, sf_dir, "documents"))


def op11_decontamination(spark, sf_dir):
    return decontaminate.contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op12_spelling_variants(spark, sf_dir):
    return variants.variants(read(spark, sf_dir, "documents"))


def op13_tokenizer_alignment(spark, sf_dir):
    return alignment.alignment(read(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_document_fingerprints, op2_quality_rules, op3_ngram_jaccard_join, op4_pii, op5_best_fit_packing, op6_source_mixing, op7_warc, op8_toxicity, op9_license_scans, op10_token_binary,
        op11_decontamination, op12_spelling_variants, op13_tokenizer_alignment,
    )
}

#: Hashes, fitted models, tokenizers and written files are out of SQL's reach; of the other operators:
ORACLE_SQL = {
    "op11_decontamination": r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
v AS (SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[k : k + least(10, len(w)) - 1], ' ') AS g FROM b, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS u(k) WHERE len(w) > 0),
p AS (SELECT r, k, n, array_to_string(w[k : k + n - 1], ' ') AS g FROM d, (SELECT DISTINCT n FROM v), unnest(generate_series(1, len(w) - n + 1)) AS u(k) WHERE len(w) >= n),
m AS (SELECT r, k, p.n, item_id FROM p JOIN v ON p.n = v.n AND p.g = v.g),
h AS (SELECT r, count(DISTINCT k + j) AS n_hit FROM m, unnest(generate_series(0, n - 1)) AS u(j) GROUP BY r),
i AS (SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT r, item_id FROM m) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (r) LEFT JOIN i USING (r)""",
}
