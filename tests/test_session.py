import os

from pyspark.sql import functions as F

from stockflow.session import materialize, scratch


def _exists(df):
    return os.path.exists(df.inputFiles()[0].removeprefix("file:"))


def test_scratch_removes_what_is_not_kept(spark):
    outside = materialize(spark.range(3), "s-outside")
    with scratch(spark) as keep:
        gone = materialize(spark.range(5), "s-gone")
        path = gone.inputFiles()[0].removeprefix("file:")
        kept = keep(materialize(gone.withColumn("x", F.col("id") * 2), "s-kept"))
        with scratch(spark) as inner:
            passed = inner(materialize(spark.range(1), "s-passed"))  # goes with the outer scratch
            here = passed.inputFiles()[0].removeprefix("file:")
        assert _exists(gone) and _exists(passed)
    assert not os.path.exists(path) and not os.path.exists(here)
    assert _exists(kept) and _exists(outside) and kept.agg(F.sum("x")).first()[0] == 20


def test_scratch_cleans_up_after_a_failure(spark):
    try:
        with scratch(spark):
            path = materialize(spark.range(5), "s-fails").inputFiles()[0].removeprefix("file:")
            raise RuntimeError
    except RuntimeError:
        pass
    assert not os.path.exists(path)
