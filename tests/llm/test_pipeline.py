"""The stages one after another, each against what it should do to its own input."""

from collections import Counter

import corpus_pipeline
from tidemark.llm import jaccard_join, mixing, packing, quality
from tidemark.llm.common import stored

from . import cases


def linked(t, u):
    a, b = cases.shingles(t, 5), cases.shingles(u, 5)
    return bool(a & b) and 100 * len(a & b) >= 80 * len(a | b)


def test_stages(spark):
    docs = stored(cases.docs(spark), "documents")
    before = docs
    for name, stage in corpus_pipeline.STAGES:
        out = stored(stage(spark, before, ""), name)
        if name != "sequences":
            assert out.columns == docs.columns
        if name == "quality_rules":
            kept = {(r.doc_id, r.kept) for r in quality.quality(before).collect()}
            assert {r.doc_id for r in out.collect()} == {i for i, k in kept if k}
        if name == "near_duplicates":
            known = [(r.doc_id, r.text) for r in before.collect()]
            groups = {}
            for k, (i, t) in enumerate(known):
                like = [j for j, (_, u) in enumerate(known[:k]) if linked(t, u)]
                met = [g for g in groups if any(j in groups[g] for j in like)]
                groups[k] = {k}.union(*(groups.pop(g) for g in met))
            kept = Counter((r.doc_id, r.text) for r in out.collect())
            assert sum(kept.values()) == len(groups)
            for g in groups.values():
                least = min((known[k][0] is None, known[k][0] or 0) for k in g)
                assert any(kept[known[k]] and (known[k][0] is None, known[k][0] or 0) == least for k in g)
        if name == "personal_data":
            assert out.count() == before.count() and not any("@c-d.example" in (r.text or "") for r in out.collect())
        if name == "source_mixture":
            assert out.count() == sum(r.copies for r in mixing.mixture(before).collect())
        if name == "sequences":
            pieces = out.toPandas()
            assert pieces.groupby("sequence_id").length.sum().max() <= 4096
            assert len(pieces) == packing.pieces(before, 4096).count()
        before = out


def test_run_returns_the_last_stage(spark, tmp_path):
    cases.docs(spark).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]


def test_empty_documents(spark):
    docs = cases.none(spark)
    for _, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, ""), "empty")
    assert docs.count() == 0
    assert jaccard_join.keep_one(cases.none(spark)).count() == 0
