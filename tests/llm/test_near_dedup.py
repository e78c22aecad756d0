import random

import numpy as np
from pyspark.sql import functions as F

from cases import WORD, docs, empty, odd_rows
from stockflow.llm import graph, hyperminhash, near_dedup
from stockflow.llm.shingles import shingle_sets


def shingles(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(low)
    return {tuple(w[i: i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}


def brute(rows):
    """Components by every pair of rows."""
    sets = [shingles(r[1]) for r in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)] = min(least.get(find(i), r[0]), r[0])
    return sorted((r[0] is None, r[0] or 0, len(s), r[0] if not s else least.get(find(i))) for i, (r, s) in enumerate(zip(rows, sets)))


def family(seed, base_words, n, edits):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(10 ** 6)}" for _ in range(base_words)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randint(0, edits)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(10 ** 6)}"
        out.append(" ".join(w))
    return out


def table():
    texts = family(1, 120, 60, 4) + family(2, 400, 25, 10) + family(3, 30, 30, 1) + family(4, 9, 12, 1) + ["Exact Copy of this one text here"] * 30
    rng = random.Random(9)
    order = list(range(1000, 1000 + len(texts)))
    rng.shuffle(order)
    rows = odd_rows() + [(i, t, "en", "s", 1) for i, t in zip(order, texts)]
    return rows + [(1000, texts[40], "en", "s", 1), (None, texts[70], "en", "s", 1)]


def test_against_all_pairs(spark):
    rows = table()
    df = docs(spark, rows).withColumnRenamed("source", "KEPT").withColumnRenamed("lang", "set_id")
    got = near_dedup.near_duplicates(df).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_shingles, r.component_id) for r in got) == brute(rows)
    assert all(r.kept == (r.doc_id == r.component_id) and r.set_id in ("en", None) for r in got)


def test_one_of_each_group_stays(spark):
    rows = [r for r in table() if r[0] is not None]
    want = {(i, c) for _, i, n, c in brute(rows) if n and i == c}
    left = near_dedup.representatives(docs(spark, rows)).collect()
    assert {r.doc_id for r in left if shingles(r.text)} == {i for i, _ in want}
    assert sum(not shingles(r.text) for r in left) == sum(not shingles(r[1]) for r in rows)


def test_blocks_of_a_large_meeting(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 8)
    rows = [(i, t, None, None, None) for i, t in enumerate(family(5, 60, 90, 5))]
    got = near_dedup.near_duplicates(docs(spark, rows)).collect()
    assert sorted((False, r.doc_id, r.n_shingles, r.component_id) for r in got) == brute(rows)


def test_empty_table_and_words_only(spark):
    assert near_dedup.near_duplicates(empty(spark)).count() == 0
    assert near_dedup.representatives(empty(spark)).count() == 0


def test_register_estimates():
    rng = np.random.default_rng(3)
    for n, shared in ((40, 36), (500, 430), (3000, 1500), (3000, 0)):
        a = rng.integers(0, 1 << 63, n).astype(np.uint64)
        b = np.concatenate([a[:shared], rng.integers(0, 1 << 63, n - shared).astype(np.uint64)])
        true = shared / (2 * n - shared)
        est = hyperminhash.jaccard(hyperminhash.registers(np.unique(a))[None], hyperminhash.registers(np.unique(b))[None], np.array([n * 1.0]), np.array([n * 1.0]))[0]
        assert abs(est - true) < 0.2
    same = hyperminhash.registers(np.unique(a))
    assert (same == hyperminhash.registers(np.unique(a))).all() and same.dtype == np.uint16


def test_components_of_a_long_chain(spark):
    n = 300
    links = spark.range(n - 1).select(F.lpad(F.col("id").cast("string"), 5, "0").cast("binary").alias("a"),
                                      F.lpad((F.col("id") + 1).cast("string"), 5, "0").cast("binary").alias("b"))
    got = graph.components(links).collect()
    assert len(got) == n and {bytes(r.root) for r in got} == {b"00000"}
    assert graph.components(links.limit(0)).count() == 0


def test_shingle_sets_by_brute_force():
    import pyarrow as pa

    texts = [r[1] for r in odd_rows()] + family(6, 40, 5, 3)
    flat, off = shingle_sets(pa.array(texts, pa.string()))
    assert np.diff(off).tolist() == [len(shingles(t)) for t in texts]


def test_joined_places():
    rng = np.random.default_rng(1)
    for n, m in ((1, 0), (50, 20), (300, 400), (300, 290)):
        a, b = (rng.integers(0, n, m), rng.integers(0, n, m)) if m != 290 else (np.arange(290), np.arange(1, 291))
        root = list(range(n))
        for _ in range(n):
            for x, y in zip(a.tolist(), b.tolist()):
                root[x] = root[y] = min(root[x], root[y])
        assert near_dedup._joined(n, a, b).tolist() == root
