import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from cases import docs, empty, odd_rows
from conftest import SF001
from stockflow.llm import cotraining
from stockflow.llm.queries import op1_cotraining


def test_rejects_junk_and_toxic_keeps_clean(spark):
    docs_ = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "lang", "text")
    got = (op1_cotraining(spark, SF001).join(spark.read.parquet(f"{SF001}/labels.parquet"), "doc_id").join(docs_, "doc_id"))
    clean = got.where("quality = 1 and toxic = 0").agg(F.avg(F.col("kept").cast("int"))).first()[0]
    low = got.where("quality = 0").agg(F.avg((~F.col("kept")).cast("int"))).first()[0]
    assert clean >= 0.97 and low >= 0.8


def test_generalises_to_rows_without_labels(spark):
    labels = spark.read.parquet(f"{SF001}/labels.parquet")
    docs_ = spark.read.parquet(f"{SF001}/documents.parquet")
    model = cotraining.fit(docs_, labels.where("doc_id % 2 = 0"))
    got = cotraining.classify(docs_, model).join(labels.where("doc_id % 2 = 1"), "doc_id")
    rows = got.select("quality", "p_low").collect()
    p, y = np.array([r.p_low for r in rows]), np.array([1 - r.quality for r in rows])
    assert (p[y == 1][:, None] > p[y == 0]).mean() > 0.95  # area under the curve


def test_views_by_brute_force():
    row, bucket = cotraining.text_features(pa.array(["Bad bad word", None, "word!! bad", ""], pa.string()))
    own = [set(bucket[row == k].tolist()) for k in range(4)]
    assert own[1] == own[3]                      # shape only
    assert len(own[0] & own[2]) >= 2             # "bad" and "word", whatever their case and marks
    alone = cotraining.text_features(pa.array(["word!! bad"]))
    assert set(alone[1].tolist()) == own[2]      # rows do not leak into each other


def test_odd_rows_no_labels_and_clashes(spark):
    df = docs(spark, odd_rows()).withColumn("P_LOW", F.lit("clash"))
    labels = spark.createDataFrame([(0, 1, 0), (3, 0, 1), (3, 1, 0), (99, 0, 0), (None, 1, 1), (5, None, None)], "doc_id bigint, quality int, toxic int")
    for have in (labels, labels.limit(0)):
        got = cotraining.classify(df, cotraining.fit(df, have)).collect()
        assert len(got) == len(odd_rows())
        assert all(0 <= r.p_low <= 1 and 0 <= r.p_toxic <= 1 and r.kept == (r.p_low < 0.5 and r.p_toxic < 0.5) for r in got)
    assert all(r.kept for r in got)  # nothing learned, nothing rejected
    model = cotraining.fit(empty(spark), labels)
    assert cotraining.classify(empty(spark), model).count() == 0


def test_sample_is_bounded(spark):
    docs_ = spark.read.parquet(f"{SF001}/documents.parquet")
    labels = spark.read.parquet(f"{SF001}/labels.parquet")
    seen = []
    real = cotraining.train
    try:
        cotraining.train = lambda table, s: seen.append(table.num_rows) or real(table, s)
        cotraining.fit(docs_, labels, cotraining.Settings(max_labelled=50, max_pool=30))
    finally:
        cotraining.train = real
    assert seen == [80]
