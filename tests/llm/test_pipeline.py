import corpus_pipeline
from conftest import SF0001
from stockflow.llm import queries as q
from test_near_dedup import brute, shingles
from test_packing import check


def test_stages_against_the_operators(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "quality_classifier", "near_dedup", "best_fit_packing"]
    stages = dict(corpus_pipeline.STAGES)
    ruled = stages["quality_rules"](spark, docs, SF0001)
    assert ruled.columns == docs.columns
    assert {r.doc_id for r in ruled.collect()} == {r.doc_id for r in q.op4_fertility(spark, SF0001).where("kept").collect()}
    rated = stages["quality_classifier"](spark, ruled, SF0001)
    assert rated.columns == docs.columns and rated.join(ruled, "doc_id", "left_anti").count() == 0
    rows = [tuple(r) for r in rated.collect()]
    single = stages["near_dedup"](spark, rated, SF0001)
    assert single.columns == docs.columns
    assert {r.doc_id for r in single.collect()} == {i for _, i, n, c in brute(rows) if i == c or not n}
    assert all(shingles(r.text) for r in single.collect())
    done = corpus_pipeline.run(spark, SF0001).collect()
    assert {r.doc_id for r in done} == {r.doc_id for r in single.collect()}
    check(done, 2048)


def test_pipeline_of_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF0001)
    assert docs.count() == 0


def test_extra_columns_with_names_used_inside_survive(spark):
    from pyspark.sql import functions as F

    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    extra = ["set_id", "registers", "node", "script", "band", "_source", "_text", "_k0", "kept", "_row", "size", "shard", "_part"]
    wide = docs.select("*", *[F.concat(F.lit(c), F.col("doc_id").cast("string")).alias(c) for c in extra])
    for _, stage in corpus_pipeline.STAGES[:3]:
        out = stage(spark, wide, SF0001)
        assert out.columns == wide.columns
        rows = out.collect()
        assert rows and all(r[c] == f"{c}{r.doc_id}" for r in rows for c in extra)
    assert dict(corpus_pipeline.STAGES)["best_fit_packing"](spark, wide, SF0001).count() > 0
