from pyspark.sql import functions as F

from cases import docs, empty, odd_rows
from conftest import SF0001
from stockflow.llm import language_id
from stockflow.llm.queries import op3_language_id


def test_held_out_accuracy(spark):
    truth = spark.read.parquet(f"{SF0001}/documents.parquet").select("doc_id", "lang")
    got = op3_language_id(spark, SF0001)
    assert got.columns == ["doc_id", "held_out", "lang_pred", "score"]
    share = got.where("held_out").join(truth, "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert share >= 0.95
    assert got.where("score < 0 or score > 1 or score is null").count() == 0


def test_brute_force_log_probabilities(spark):
    train = docs(spark, [(1, "abc abd", "x", None, None), (2, "zzy", "y", None, None), (3, "q", None, None, None)])
    model = language_id.fit(train)
    assert model.languages == ["x", "y"]

    def buckets(t):
        return [int(b) for part, _ in language_id.grams([t]) for b in part]

    assert len(buckets("abc abd")) == 7 + 6 + 5
    for k, t in ((0, "abc abd"), (1, "zzy")):
        own = buckets(t)
        total = len(own) + 0.5 * language_id.BUCKETS
        for b in set(own):
            assert abs(model.log_p[k][b] - __import__("math").log((own.count(b) + 0.5) / total)) < 1e-4
    names, p = language_id.score(model, ["abd", "zz", "", None, "12 !", "ABC"])
    assert names == ["x", "y", "und", "und", "und", "x"] and (p[2:5] == 0).all()


def test_rows_do_not_leak_into_each_other():
    together = language_id.grams(["ab", "", "c", "def"])
    for n, (bucket, off) in enumerate(together, 1):
        for i, t in enumerate(["ab", "", "c", "def"]):
            alone = language_id.grams([t])[n - 1][0]
            assert bucket[off[i]: off[i + 1]].tolist() == alone.tolist()


def test_odd_rows_and_no_training(spark):
    df = docs(spark, odd_rows()).withColumnRenamed("source", "Score")
    model = language_id.fit(docs(spark, odd_rows()))
    got = language_id.predict(df, model)
    assert got.columns == ["doc_id", "text", "lang", "n_chars", "lang_pred", "score"] and got.count() == len(odd_rows())
    nothing = language_id.fit(empty(spark))
    assert nothing.languages == []
    assert {r.lang_pred for r in language_id.predict(df, nothing).collect()} == {"und"}
    assert language_id.predict(empty(spark), model).count() == 0
