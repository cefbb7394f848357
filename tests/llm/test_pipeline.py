"""The pipeline's stages take effect and keep their contracts."""

import corpus_pipeline

SMALL = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    leak = spark.read.parquet(f"{SMALL}/benchmark.parquet").first().text
    extra = [(10_001, f"before {leak} after", "en", "src0", 1), (10_002, None, None, None, None), (10_003, "same words " * 30, "en", "src1", 330),
             (10_004, "same words " * 30, "en", "src1", 330), (10_004, "same words " * 30, "en", "src1", 330)]
    docs = docs.unionByName(spark.createDataFrame(extra, docs.schema))
    seen, columns = [docs.count()], docs.columns
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path / name)
        stage(spark, docs, SMALL).write.parquet(path)
        docs = spark.read.parquet(path)
        seen.append(docs.count())
        if name != "mixing":
            assert docs.columns == columns
        if name == "ngram_join":
            assert docs.where("doc_id in (10003, 10004)").count() == 1
        if name == "decontaminate":
            assert docs.where("doc_id = 10001").count() == 0
    assert seen == sorted(seen, reverse=True) and seen[-1] == seen[-2] and docs.where("doc_id = 10002").count() == 1


def test_stages_on_empty_documents(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SMALL).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
    assert docs.count() == 0
