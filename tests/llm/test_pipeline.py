from tests.llm import data


def test_stages_keep_columns(spark, tmp_path):
    import corpus_pipeline as c

    from tests.llm.test_classifiers import labelled

    rows, marks = labelled(160)
    spark.createDataFrame(rows + data.edge_rows(), data.SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    data.labels(spark, marks).write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    before = docs.count()
    assert [n for n, _ in c.STAGES] == ["toxicity", "quality", "near_dedup", "mix", "pack"]
    for name, stage in c.STAGES[:3]:
        out = c.materialize(stage(spark, docs, str(tmp_path)))
        assert out.columns == docs.columns and 0 < out.count() < before
        docs, before = out, out.count()
    assert c.run(spark, str(tmp_path)).count() > 0
