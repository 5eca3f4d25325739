import corpus_pipeline
from cadenza.llm import registry


def test_registry_names_all_operators():
    assert sorted(int(n[2:].split("_")[0]) for n in registry.QUERIES) == list(range(1, 11))
    assert set(registry.ORACLES) <= set(registry.QUERIES)


def test_stages_keep_columns_and_reruns_agree(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = corpus_pipeline.written(stage(spark, docs, sf_dir), name)
        assert out.columns == docs.columns, name
        assert out.count() > 0
        docs = out
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).drop("ids")
    assert sorted(map(str, last.collect())) == sorted(map(str, corpus_pipeline.run(spark, sf_dir).drop("ids").collect()))
    assert last.where("not lossless").count() == 0


def test_hostile_rows_pass(spark, edge, empty):
    for table in (edge, empty):
        docs = table
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, "")
            assert docs.columns == table.columns
        corpus_pipeline.STAGES[-1][1](spark, docs, "").count()
