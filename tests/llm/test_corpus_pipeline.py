"""The pipeline's stages take effect, each on what the one before left."""

import corpus_pipeline as p
from stratamerge.llm.common import written


def test_stages(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    steps = {}
    now = docs
    for name, stage in p.STAGES:
        now = written(stage(spark, now, sf_dir), name)
        steps[name] = now
        if name != "packing":
            assert now.columns == docs.columns
    n = {k: v.count() for k, v in steps.items()}
    assert docs.count() > n["toxicity"] > n["near_duplicates"] == n["secrets"] > 0
    # one document of each group stays
    from stratamerge.llm.neardup import near_duplicates

    left = near_duplicates(steps["near_duplicates"].select("doc_id", "text"))
    assert left.where("doc_id <> component_id").count() == 0
    groups = near_duplicates(steps["toxicity"].select("doc_id", "text"))
    assert groups.select("component_id").distinct().count() == n["near_duplicates"]
    secret = "text RLIKE '(AKIA[A-Z0-9]{16,})|([0-9a-f]{24,})|(password=[0-9a-f]{6,})'"
    assert steps["secrets"].where(secret).count() == 0 < steps["near_duplicates"].where(secret).count()
    assert steps["secrets"].where("n_chars <> length(text)").count() == 0
    assert n["packing"] == n["mixing"] and steps["mixing"].select("doc_id").distinct().count() <= n["secrets"]
    assert p.run(spark, sf_dir).count() == n["packing"]


def test_stages_on_nothing_and_odd_rows(spark):
    sf_dir, schema = "/root/testdata/sf0.001", "doc_id long, text string, lang string, source string, n_chars long"
    for rows in ([], [(1, None, None, None, None), (2, "", "en", "a", 0), (2, "", "en", "a", 0), (None, "w " * 9, "en", "b", 18)]):
        for _, stage in p.STAGES:
            out = stage(spark, spark.createDataFrame(rows, schema), sf_dir)
            assert out.count() <= 4 * max(1, len(rows))
