import math
import random

from pyspark.sql import functions as F

from stockflow.llm import topk

SCHEMA = "vec_id bigint, vector array<float>"


def brute(rows, k):
    ints = [(i, [math.floor(64 * x) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = {}
    for q in sorted({i for i, _ in ints if i is not None and i % 20 == 0}):
        found = sorted((-sum(a * b for a, b in zip(v, w)), i) for v in [v for i, v in ints if i == q] for i, w in ints if i is not None and i != q and len(w) == len(v))
        out[q] = [(r + 1, i, -s) for r, (s, i) in enumerate(found[:k])]
    return {q: v for q, v in out.items() if v}


def search(df, k, **kw):
    got = {}
    v = topk.quantise(df, "vector", 64)
    for r in topk.top_k(v, v.where(F.col("vec_id") % 20 == 0), k, **kw).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return {q: sorted(v) for q, v in got.items()}


def test_against_brute_force_over_blocks(spark):
    rng = random.Random(2)
    f = lambda: round(rng.gauss(0, 0.2) * 128) / 128  # noqa: E731  exact in float32
    rows = [(i, [f() for _ in range(12)]) for i in range(700)]
    rows += [(700 + i, rows[3][1]) for i in range(60)]                          # ties at the last place
    rows += [(900, None), (920, [0.5, None] * 6), (940, [float("nan")] * 12), (960, [float("inf")] * 12), (None, [0.5] * 12), (980, [0.0] * 12)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("Score", F.lit(1))
    want = brute(rows, 20)
    assert search(df, 20) == want
    assert search(df, 20, block_rows=100, query_rows=7) == want


def test_few_rows_repeats_other_lengths_and_none(spark):
    rows = [(0, [0.5, -0.5]), (1, [0.25, 1.0]), (1, [0.25, 1.0]), (2, [1.0]), (20, []), (40, [1.0]), (60, [-1.0, 0.0])]
    df = spark.createDataFrame(rows, SCHEMA)
    assert search(df, 20) == brute(rows, 20)
    assert search(df.limit(0), 20) == {}


def test_components_too_large_fail(spark):
    import pytest
    assert search(spark.createDataFrame([(0, [1e6]), (1, [-1e6])], SCHEMA), 3) == {0: [(1, 1, -64_000_000 ** 2)]}
    with pytest.raises(Exception, match="beyond"):
        search(spark.createDataFrame([(0, [3e18]), (1, [1.0])], SCHEMA), 3)
