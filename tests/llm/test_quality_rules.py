import math
from collections import Counter

import public_tokenizers as P
import sentencepiece
from pyspark.sql import functions as F

from cases import WORD, docs, empty, odd_rows, random_texts
from conftest import SF001
from stockflow.llm import quality_rules as qr
from stockflow.llm.queries import op4_fertility

FILES = (P.path("piece_bpe_32k.model"), P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)


def brute(text):
    t = text or ""
    w = WORD.findall(t)
    three = Counter(zip(w, w[1:], w[2:]))
    marked = {k for i in range(len(w) - 2) if three[tuple(w[i: i + 3])] > 1 for k in (i, i + 1, i + 2)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(marked))


def rows():
    repeats = ["one two three four " * 5, "a b c a b c x a b", "x\nx\r\nx\n\nx\n x", "## a | b\n## a | b"]
    return odd_rows() + [(200 + i, t, "en", "s", 1) for i, t in enumerate(repeats + random_texts(60, 3))]


def test_base_counts_against_brute_force(spark):
    df = docs(spark, rows()).withColumnRenamed("source", "Script")
    got = qr.measure(df, *FILES).collect()
    assert len(got) == len(rows())
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute(r.text), r.text


def test_fertility_against_library(spark):
    pieces = sentencepiece.SentencePieceProcessor(model_file=FILES[0])
    for r in qr.measure(docs(spark, rows()), *FILES).collect():
        t = r.text or ""
        ids = [i for k, w in enumerate(t.split(" ")) for i in pieces.encode(w) if w.strip()] if "  " not in t else None
        if ids and not any(c in t for c in "\n\t\r\x0b\x0c\x1c\x85\xa0"):
            n = Counter(ids)
            assert abs(r.chars_per_piece - len(t) / len(ids)) < 1e-9, t
            assert abs(r.fallback_share - sum(pieces.is_byte(i) for i in ids) / len(ids)) < 1e-9
            assert abs(r.token_entropy + sum(c / len(ids) * math.log2(c / len(ids)) for c in n.values())) < 1e-6


def test_clean_documents_stay_and_junk_goes(spark):
    got = op4_fertility(spark, SF001).join(spark.read.parquet(f"{SF001}/labels.parquet"), "doc_id")
    clean = got.where("quality = 1 and n_words >= 50 and not base_failed")
    assert clean.agg(F.avg(F.col("kept").cast("int"))).first()[0] >= 0.995
    junk = got.where("quality = 0")
    assert junk.agg(F.avg(F.col("kept").cast("int"))).first()[0] <= 0.6
    assert got.where("base_failed and kept").count() == 0


def test_empty_table_and_single_valued_groups(spark):
    rule = qr.Rule()
    none = qr.measure(empty(spark), *FILES)
    assert qr.verdict(none, qr.fit_bands(none, rule), rule).count() == 0
    text = " ".join(f"word{i}" for i in range(80))
    same = qr.measure(docs(spark, [(i, text, "en" if i % 2 else None, None, None) for i in range(6)]), *FILES)
    done = qr.verdict(same, qr.fit_bands(same, rule), rule).collect()
    assert len(done) == 6 and all(r.kept for r in done)
