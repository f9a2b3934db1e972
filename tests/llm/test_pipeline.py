import os

import pytest

import corpus_pipeline

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_stages_follow_each_other(spark):
    from harvestframe.llm import decontam, mixing, quality, simhash
    from harvestframe.llm.common import stage
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, ids = docs.columns, [{r[0] for r in docs.select("doc_id").collect()}]
    for name, step in corpus_pipeline.STAGES:
        before, docs = docs, stage(step(spark, docs, SF), "test-pipeline")
        ids.append({r[0] for r in docs.select("doc_id").collect()})
        assert ids[-1] <= ids[-2]
        if name != "sharding":
            assert docs.columns == columns
        if name == "quality_rules":
            want = {r.doc_id for r in quality.op8_quality_rules(spark, SF).collect() if r.kept}
            assert ids[-1] == want
        if name == "near_dedup":
            assert ids[-1] == {r.component_id for r in simhash.simhash_groups(before).collect()}
            assert docs.count() == len(ids[-1])
        if name == "decontamination":
            assert ids[-2] - ids[-1] == {r.doc_id for r in decontam.contaminated(before, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
        if name == "mixing":
            assert docs.count() == sum(r.copies for r in mixing.mix(before).collect())
    assert docs.count() == before.count() and "shard" in docs.columns


def test_empty_table(nothing):
    docs = nothing.select("doc_id", "text", "lang", "source", "n_chars")
    for name, step in corpus_pipeline.STAGES:
        if name != "decontamination":
            assert step(nothing.sparkSession, docs, SF).count() == 0


def test_registered_queries():
    from harvestframe.llm.queries import ORACLE, QUERIES
    assert all(any(k.startswith(f"op{n}_") for k in QUERIES) for n in range(1, 11))
    assert set(ORACLE) <= set(QUERIES) and all(isinstance(v, str) for v in ORACLE.values())
