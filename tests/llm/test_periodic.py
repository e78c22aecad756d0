import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
from pyspark.sql import functions as F

from cases import WORD, docs, empty, odd_rows, random_texts
from stockflow.llm import periodic, queries


def brute(w, least=6, repeats=4):
    """All runs (start, length, period) by every lag."""
    out, n = [], len(w)
    for q in range(1, n // repeats + 1):
        x = q
        while x < n:
            y = x
            while y < n and w[y] == w[y - q]:
                y += 1
            if y > x:
                seg = w[x - q: y]
                if len(seg) >= max(least, repeats * q) and not any(all(seg[t] == seg[t - p] for t in range(p, len(seg))) for p in range(1, q)):
                    out.append((x - q, len(seg), q))
            x = y + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def loops(seed, n):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        w = []
        for _ in range(rng.randint(0, 6)):
            base = [rng.choice("abcd"[: rng.randint(1, 4)]) for _ in range(rng.randint(1, 9))]
            w += (base * rng.randint(1, 7))[: rng.randint(1, 60)]
        out.append(rng.choice([" ", "\n", " \t"]).join(w))
    return out


def test_runs_of_small_alphabets():
    rows = [t.split() for t in loops(7, 1500)]
    names = {w: i for i, w in enumerate("abcd")}
    code = np.array([names[w] for r in rows for w in r], np.int64)
    off = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    got = [[] for _ in rows]
    for r, *run in zip(*(x.tolist() for x in periodic.find_runs(code, off))):
        got[r].append(tuple(run))
    assert got == [brute(r) for r in rows]


def test_long_periods_and_other_bounds():
    rng = random.Random(1)
    base = [rng.randrange(10 ** 6) for _ in range(1000)]
    w = [-1, *(base * 5)[:4321], -2, *[1, 2] * 30]
    code, off = np.unique(w, return_inverse=True)[1], np.array([0, len(w)])
    for least, repeats in ((6, 4), (100, 4), (6, 5)):
        got = [tuple(int(x) for x in r[1:]) for r in zip(*periodic.find_runs(code, off, least, repeats))]
        want = [r for r in ((1, 4321, 1000), (4323, 60, 2)) if r[1] >= max(least, repeats * r[2])]
        assert got == want


def expected(doc_id, text):
    w = WORD.findall(text or "")
    if doc_id is not None and w and (h := zlib.crc32(str(doc_id).encode())) % 10 == 0:
        g, n = h // 10, len(w)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute(w)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None, None, None))
    return (doc_id, len(runs), *best, best[0] if best[0] is None else 1000 * best[1] // best[2],
            hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(),
            hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in gone).encode()).hexdigest())


def test_query_against_brute_force(spark, tmp_path):
    texts = loops(3, 200) + random_texts(60) + ["x " * 5, "x " * 6, "one two " * 4, "one two " * 3]
    rows = odd_rows() + [(100 + i, t, "en", "s", 1) for i, t in enumerate(texts)]
    docs(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op11_periodic_runs(spark, str(tmp_path)).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r)
    assert sorted(map(tuple, got), key=lambda r: str(key(r))) == sorted((expected(*r[:2]) for r in rows), key=lambda r: str(key(r)))
    assert sum(r.n_runs > 0 for r in got) > 100


def test_operator_edge_cases(spark):
    df = docs(spark, [(1, "a b " * 5 + "c", "en", None, 3), (2, None, None, None, None)]).withColumnRenamed("source", "RUNS").withColumnRenamed("lang", "start")
    got = {r.doc_id: r for r in periodic.mark_runs(df).collect()}
    assert [tuple(x) for x in got[1].runs] == [(0, 10, 2)] and got[1].collapsed == "a b c" and got[1].start == "en" and got[1].n_words == 11
    assert got[2].runs == [] and got[2].collapsed == "" and got[2].n_words == 0
    assert periodic.mark_runs(empty(spark)).count() == 0


def test_text_over_a_chunk(spark):
    rng = random.Random(2)
    words = [f"w{rng.randrange(10 ** 9)}" for _ in range(60_000)]
    text = " ".join(words + words[:20_000] * 5 + ["z"] * 50_000 + ["é" * 100_000])
    assert len(text) > 1 << 20
    [r] = periodic.mark_runs(docs(spark, [(1, text, None, None, None)])).collect()
    assert [tuple(x) for x in r.runs] == [(60_000, 100_000, 20_000), (160_000, 50_000, 1)]
    assert r.collapsed.split(" ") == words + words[:20_000] + ["z", "é" * 100_000]


def test_words_of_equal_polynomial_hash(spark):
    """Thue-Morse words collide under any polynomial hash modulo 2 ** 64."""
    bits = [bin(i).count("1") & 1 for i in range(2048)]
    x, y = ("".join("ab"[b ^ f] for b in bits) for f in (0, 1))
    [r] = periodic.mark_runs(docs(spark, [(1, " ".join([x, y] * 5), None, None, None)])).collect()
    assert [tuple(x) for x in r.runs] == [(0, 10, 2)]
    assert r.collapsed == f"{x} {y}"


def test_whole_table_by_sql(spark):
    from oracle_check import compare, duck_connect
    ok, said = compare(queries.op11_periodic_runs(spark, "/root/testdata/sf0.001"), duck_connect("/root/testdata/sf0.001"), queries.ORACLE["op11_periodic_runs"])
    assert ok, said
    assert queries.op11_periodic_runs(spark, "/root/testdata/sf0.001").where(F.col("n_runs") > 0).count() > 0
