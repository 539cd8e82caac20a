import zlib

from pyspark.sql import functions as F

import corpus_pipeline as cp
from chronomark.llm import decontaminate, packing, pii, quality, simhash
from chronomark.llm._common import materialize
from tests.llm import _docs

SF = "/root/testdata/sf0.001"


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in cp.STAGES:
        docs = materialize(stage(spark, docs, SF), name)
        kept[name] = docs
        if name != cp.STAGES[-1][0]:
            assert docs.columns == columns
    n = {k: v.count() for k, v in kept.items()}
    assert 0 < n["quality_classifier"] <= 200 and n["simhash_near_dedup"] <= n["quality_classifier"]
    fps = [r["fp"] for r in simhash.fingerprints(kept["simhash_near_dedup"]).collect()]
    assert all(bin((a ^ b) & (1 << 64) - 1).count("1") > 2 for i, a in enumerate(fps) for b in fps[:i])
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    assert decontaminate.contamination(kept["benchmark_decontamination"], bench).where("contaminated").count() == 0
    before = {(k, v) for r in kept["benchmark_decontamination"].collect() for _, _, k, v, _ in pii.entities(r["text"])}
    after = {(k, v) for r in kept["pii_surrogates"].collect() for _, _, k, v, _ in pii.entities(r["text"])}
    assert before and not before & after
    t = packing.tokenizer(packing.default_tokenizer_path())
    want = {r["doc_id"]: t.encode(r["text"]) + b"\0\0\0\0" for r in kept["pii_surrogates"].collect()}
    packed = kept["best_fit_packing"].collect()
    assert sorted((r["doc_id"], r["start"], r["ids_crc32"]) for r in packed) == sorted((d, at // 4, zlib.crc32(b[at : at + 8192])) for d, b in want.items() for at in range(0, len(b), 8192))


def test_run(spark):
    assert {"doc_id", "sequence_id", "offset"} <= set(cp.run(spark, SF).columns)


def test_stages_on_awkward_rows(spark):
    """Nulls in every column, blank and very long texts, ties, repeated rows, clashing columns, an empty table."""
    docs = _docs.frame(spark).unionByName(spark.createDataFrame([(None, None, None, None, None, None, None, None), (None, "some words of nobody's document here", None, None, None, None, None, None)], _docs.SCHEMA))
    rows = docs.count()
    for name, stage in cp.STAGES:
        out = materialize(stage(spark, docs, SF), f"awkward-{name}")
        empty = stage(spark, _docs.empty(spark), SF)
        assert empty.count() == 0
        if name != "best_fit_packing":
            assert out.columns == empty.columns == docs.columns
            assert out.count() <= rows
    blank = ~F.coalesce(F.col("text"), F.lit("")).rlike(r"\S")
    assert cp.quality_classifier(spark, docs, SF).where(blank).count() == 0
    once = cp.simhash_near_dedup(spark, docs, SF)
    assert once.where(blank).count() == 1 and once.where("doc_id = 5").count() == 1 and once.where("doc_id is null").count() >= 1
    assert cp.benchmark_decontamination(spark, docs, SF).where(blank).count() == docs.where(blank).count()
    assert cp.pii_surrogates(spark, docs, SF).count() == rows
    assert cp.best_fit_packing(spark, docs, SF).where("piece = 0").count() == rows


def test_quality_stage_goes_by_the_classifier(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    verdict = quality.classify(docs, labels).where("keep and not toxic").select("doc_id").collect()
    assert sorted(r["doc_id"] for r in cp.quality_classifier(spark, docs, SF).select("doc_id").collect()) == sorted(r["doc_id"] for r in verdict)
