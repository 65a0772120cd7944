import corpus_pipeline as pipeline
import pytest
from tools import clashing
from stayflow.llm.common import stored
from stayflow.llm.minhash import near_duplicates
from stayflow.llm.mixing import mix

FOLDER = "/root/testdata/sf0.001"


def test_stages_over_the_smallest_folder(spark):
    docs = pipeline.table(spark, FOLDER, "documents")
    columns, texts = docs.columns, {r["doc_id"]: r["text"] for r in docs.collect()}
    kept = {}
    for name, stage in pipeline.STAGES:
        before = docs
        docs = stored(stage(spark, docs, FOLDER), f"test-{name}")
        kept[name] = sorted(r["doc_id"] for r in docs.collect())
        if name != "shards":
            assert docs.columns == columns
        if name == "near_dedup":
            assert kept[name] == sorted(r["doc_id"] for r in near_duplicates(before).where("kept").collect())
        if name == "mix":
            wanted = {r["doc_id"]: r["copies"] for r in mix(before).collect()}
            assert kept[name] == sorted(d for d, n in wanted.items() for _ in range(n))
    assert all(r["text"] == texts[r["doc_id"]] for r in docs.collect())
    assert kept["shards"] == kept["mix"]
    assert 0.7 * len(texts) < len(kept["quality"]) <= len(texts)
    assert pipeline.run(spark, FOLDER).count() == len(kept["shards"])


@pytest.mark.parametrize("name,stage", pipeline.STAGES)
def test_stages_take_odd_and_empty_tables(odd, nothing, spark, name, stage):
    assert stage(spark, nothing, FOLDER).count() == 0
    wide = clashing(odd)
    out = stage(spark, wide, FOLDER)
    rows = out.collect()
    assert len(set(out.columns)) == len(out.columns)
    if name != "shards":
        assert out.columns == wide.columns
    assert len(rows) <= 45


def test_stages_with_python_bound_their_batches(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    docs = pipeline.table(spark, FOLDER, "documents")
    before = spark.conf.get(key, None)
    try:
        for stage in (pipeline.quality, pipeline.near_dedup, pipeline.decontaminated):
            spark.conf.unset(key)
            stage(spark, docs.limit(5), FOLDER)
            assert int(spark.conf.get(key)) == pipeline.TEXT_BATCH
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)
