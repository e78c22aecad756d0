import hashlib
import random
import re

import numpy as np
from pyspark.sql import functions as F

from cases import docs, empty, odd_rows, random_texts
from stockflow.llm import decontamination, queries
from stockflow.llm.arrays import mix

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
ITEMS = "item_id bigint, text string"


def split(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(rows, items, span=10):
    wins = []
    for item, text in items:
        w = split(text)
        k = min(len(w), span)
        wins.append((item, k, {tuple(w[i: i + k]) for i in range(len(w) - k + 1)} if k else set()))
    out = []
    for doc_id, text, *_ in rows:
        w = split(text)
        hit, ids = set(), set()
        for item, k, own in wins:
            for i in range(len(w) - k + 1 if k else 0):
                if tuple(w[i: i + k]) in own:
                    hit.update(range(i, i + k))
                    ids.add(item)
        names = sorted(str(i) for i in ids if i is not None)
        out.append((doc_id, len(w), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit)))
    return out


def tables():
    rng = random.Random(4)
    items = [(i, t) for i, t in enumerate(random_texts(25, seed=8, words=(12, 60)))]
    items += [(30, "Short, one!"), (31, "x"), (32, None), (33, ""), (34, "..."), (3, "another text of the third item, with eleven words, a window"),
              (None, "no id but ten words long or more, which do hit text"), (36, items[2][1]), (37, "a b a b a b a b a b a b a b")]
    rows = odd_rows()
    for i, t in enumerate(random_texts(120, seed=9, words=(0, 90))):
        w = t.split(" ")
        for _ in range(rng.randint(0, 3)):
            item = (rng.choice(items)[1] or "").split(" ")
            a = rng.randrange(len(item))
            at = rng.randrange(len(w))
            w[at:at] = item[a: a + rng.randint(1, 30)]
        rows.append((100 + i, rng.choice([" ", ", ", "\n"]).join(w), "en", "s", 1))
    rows += [(500, items[0][1].upper(), "en", "s", 1), (501, "short ONE", "en", "s", 1), (502, "short x one", "en", "s", 1), (503, "b a " * 9, None, None, None)]
    return rows + rows[30:34], items


def test_query_against_brute_force(spark, tmp_path):
    rows, items = tables()
    docs(spark, rows).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, ITEMS).write.parquet(f"{tmp_path}/benchmark.parquet")
    got = queries.op13_winnowing(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(brute(rows, items), key=str)
    assert 20 < sum(r.contaminated for r in got) < len(got)


def test_hot_fingerprints_and_a_full_filter(spark, monkeypatch):
    """A passage in most documents is salted; a filter of 128 bits passes nearly everything."""
    monkeypatch.setattr(decontamination, "FILTER_BITS", 7)
    monkeypatch.setattr(decontamination, "SALTS", 8)
    rows, items = tables()
    common = " ".join(f"common{i}" for i in range(14))
    rows = [(r[0], f"{r[1]} {common}", *r[2:]) if k % 3 and r[1] else r for k, r in enumerate(rows)]
    items += [(40, common), (41, "go " + common + " on"), (42, common + " end")]
    df = docs(spark, rows).withColumnRenamed("source", "N_HIT").withColumnRenamed("lang", "print")
    got = decontamination.contaminated(df, spark.createDataFrame(items, ITEMS)).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items, hashlib.sha256(",".join(r["items"]).encode()).hexdigest(), r.contaminated) for r in got),
                  key=str) == sorted(brute(rows, items), key=str)
    assert got[0].print in ("en", None)


def test_other_spans(spark):
    rows, items = tables()
    for span, gram in ((6, 2), (13, 13), (4, 1)):
        got = decontamination.contaminated(docs(spark, rows), spark.createDataFrame(items, ITEMS), span=span, gram=gram, carry=["doc_id"]).collect()
        assert sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items) for r in got), key=str) == sorted((x[:4] for x in brute(rows, items, span)), key=str)


def test_every_span_keeps_a_fingerprint_in_the_same_place():
    rng = np.random.default_rng(2)
    word = mix(rng.integers(0, 6, 400).astype(np.uint64))
    at, print_ = decontamination.winnow(word, np.full(400, 400), 10, 5)
    assert 100 < len(at) < 200 and (np.diff(at) > 0).all()
    kept = set(at.tolist())
    for i in range(391):
        own, _ = decontamination.winnow(word[i: i + 10], np.full(10, 10), 10, 5)
        assert len(own) == 1 and int(own[0]) + i in kept


def test_empty_tables(spark):
    rows, items = tables()
    none = spark.createDataFrame([], ITEMS)
    assert decontamination.contaminated(empty(spark), spark.createDataFrame(items, ITEMS)).count() == 0
    assert decontamination.contaminated(empty(spark), none).count() == 0
    clean = decontamination.contaminated(docs(spark, rows), none)
    assert clean.count() == len(rows) and clean.where(F.col("contaminated") | (F.col("n_hit") > 0) | (F.size("items") > 0)).count() == 0


def test_text_over_a_chunk(spark):
    w = " ".join(random_texts(2400, seed=6, words=(100, 130)))
    assert len(w) > 1 << 20
    item = " ".join(w.split()[70_000: 70_040])
    [r] = decontamination.contaminated(docs(spark, [(1, w + " " + "é" * 50_000, None, None, None)]), spark.createDataFrame([(7, item), (8, "é" * 50_000)], ITEMS)).collect()
    n = brute([(1, w + " " + "é" * 50_000)], [(7, item), (8, "é" * 50_000)])[0]
    assert (r.n_words, r.n_hit, r["items"]) == (n[1], n[2], ["7", "8"])


def test_whole_table_by_sql(spark):
    from oracle_check import compare, duck_connect
    ok, said = compare(queries.op13_winnowing(spark, "/root/testdata/sf0.001"), duck_connect("/root/testdata/sf0.001"), queries.ORACLE["op13_winnowing"])
    assert ok, said
