import zlib

from pyspark.sql import functions as F

from conftest import SF0001
from stockflow.llm import sharding
from stockflow.llm.queries import op5_byte_shards


def law(rows, shards, total):
    upto = 0
    slots = {}
    for key, size in rows:
        shard = (2 * upto + size) * shards // (2 * total)
        slots[key] = (shard, sum(1 for s, _ in slots.values() if s == shard))
        upto += size
    return slots


def test_brute_force_with_ties_and_hot_copies(spark):
    sizes = [(i, 1 + (i * 37) % 90, "hot" if i % 3 == 0 else f"t{i}") for i in range(400)] + [(None, 5, "x"), (7, 8, "hot")]
    df = spark.createDataFrame(sizes, "doc_id bigint, size bigint, content string").withColumn("Slot", F.lit("clash")).withColumn("_part", F.lit("own"))
    for n in (1, 3, 8):
        got = sharding.shard(df, n, "size", ["content", "doc_id", "size"]).collect()
        assert len(got) == len(sizes) and all(r._part == "own" for r in got)
        order = sorted(((c, -1 if d is None else d, s) for d, s, c in sizes))
        want = law([((c, d, s), s) for c, d, s in order], n, sum(s for _, s, _ in sizes))
        assert {(r.content, -1 if r.doc_id is None else r.doc_id, r["size"]): (r.shard, r.slot) for r in got} == want
        by = {}
        for r in got:
            by.setdefault(r.shard, []).append(r)
        for own in by.values():
            assert sorted(r.slot for r in own) == list(range(len(own)))
            assert abs(sum(r["size"] for r in own) - sum(s for _, s, _ in sizes) / n) <= 2 * 90


def test_repeated_rows_few_rows_and_none(spark):
    two = spark.createDataFrame([(1, 4, "a"), (1, 4, "a")], "doc_id bigint, size bigint, content string")
    got = sharding.shard(two, 8, "size", ["content", "doc_id"]).collect()
    assert len(got) == 2 and len({(r.shard, r.slot) for r in got}) == 2
    assert sharding.shard(two.limit(0), 8, "size", ["content", "doc_id"]).count() == 0


def test_query_is_native_and_balanced(spark):
    df = op5_byte_shards(spark, SF0001)
    plan = df._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
    rows = df.collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect()}
    total, largest = sum(r["size"] for r in rows), max(r["size"] for r in rows)
    for r in rows:
        b = (texts[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(b) + 1, zlib.crc32(b), "bytes", None)
    for k in range(8):
        assert abs(sum(r["size"] for r in rows if r.shard == k) - total / 8) <= largest
