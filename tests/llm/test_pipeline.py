"""The pipeline's stages in order, each on what the one before kept."""

import corpus_pipeline
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("_id", F.lit("clash"))
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "line dedup", "n-gram Jaccard join", "benchmark decontamination", "best-fit packing"]
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and out.schema["n_chars"].dataType == docs.schema["n_chars"].dataType
        docs = spark.createDataFrame(out.collect(), out.schema)
        assert docs.filter(F.col("n_chars") != F.char_length("text")).count() == 0
        counts.append(docs.count())
    assert counts == sorted(counts, reverse=True) and counts[-1] > 0.7 * counts[0]
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert packed.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()


def test_run_and_empty(spark, tmp_path):
    rows = corpus_pipeline.run(spark, SF).collect()
    fill = {}
    for r in rows:
        fill[r.sequence_id] = fill.get(r.sequence_id, 0) + r.length
    assert rows and max(fill.values()) <= 1024
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
