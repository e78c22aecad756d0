from pyspark.sql import functions as F

from conftest import SF001
from stockflow.llm import quality_rules as qr
from stockflow.llm.queries import op4_fertility


def test_bands_reject_low_quality_beyond_the_base_rule(spark):
    got = op4_fertility(spark, SF001).join(spark.read.parquet(f"{SF001}/labels.parquet"), "doc_id").where("not base_failed")
    share = {r.quality: r.gone for r in got.groupBy("quality").agg(F.avg((~F.col("kept")).cast("int")).alias("gone")).collect()}
    assert share[0] >= 0.75 and share[1] <= 0.005, share


def test_bands_have_two_sides_and_know_the_length(spark):
    def row(i, words, chars=2.6, entropy=6.5):
        return (i, "en", words, 0, chars + i % 5 * 0.01, chars + i % 5 * 0.01, 0.01, entropy + i % 7 * 0.02, "Latin")

    rows = [row(i, 100, entropy=6.0) for i in range(100)] + [row(i, 1000, entropy=7.0) for i in range(100, 200)]
    odd = [row(200, 100, chars=4.5), row(205, 100, chars=1.5), row(210, 1000, entropy=9.0), row(215, 1000, entropy=6.0), row(220, 100, entropy=7.0)]
    rare = [row(225, 100_000)]  # its class has no bands of its own: those of the language hold
    df = spark.createDataFrame(rows + odd + rare, "doc_id int, lang string, n_words bigint, n_repeat_words bigint, chars_per_piece double, "
                               "chars_per_byte_token double, fallback_share double, token_entropy double, script string")
    rule = qr.Rule()
    done = qr.verdict(df, qr.fit_bands(df, rule), rule)
    assert {r.doc_id for r in done.where("not kept").collect()} == {r[0] for r in odd} and done.count() == 206
    assert done.columns == [*df.columns, "base_failed", "kept"]


def test_verdict_by_brute_force(spark):
    """Bands of the whole table, worked out again from the measured rows."""
    import random

    rng = random.Random(4)
    rows = []
    for i in range(900):
        lang, words = rng.choice(["en", "en", "de", None]), rng.choice([60, 100, 500, 5000, 70_000]) + rng.randint(0, 9)
        shift = 0.4 * len(bin(words)) + (1 if lang == "de" else 0)
        rows.append((i, lang, words, rng.choice([0, 0, words]), rng.gauss(3, 0.2), rng.gauss(3, 0.2), abs(rng.gauss(0.01, 0.01)), rng.gauss(shift, 0.2 if i % 20 else 5), rng.choice(["Latin", "Greek"])))
    rows.append((900, "fr", 80, 0, 3.0, 3.0, 0.0, 5.0, "Latin"))
    df = spark.createDataFrame(rows, "doc_id int, lang string, n_words bigint, n_repeat_words bigint, chars_per_piece double, chars_per_byte_token double, "
                               "fallback_share double, token_entropy double, script string")
    rule = qr.Rule()

    def quartiles(own):
        own = sorted(own)  # the lower value of a position, as percentile_approx has it
        return [own[max(0, -(-len(own) * k // 4) - 1)] for k in (1, 3)]

    passes = [r for r in rows if r[2] >= 50 and 100 * r[3] <= 50 * r[2]]
    group, size = lambda r: r[1] or f"script:{r[8]}", lambda r: len(bin(r[2])) - 2
    want = {}
    for r in rows:
        kept = r in passes
        for m, name in enumerate(qr.MEASURES, 4):
            if kept:
                lang = [x for x in passes if group(x) == group(r)]
                own = [x[m] for x in lang if size(x) == size(r)]
                q1, q3 = ((len(own) * a + qr.PRIOR * b) / (len(own) + qr.PRIOR) for a, b in zip(quartiles(own), quartiles([x[m] for x in lang])))
                spread = rule.width * max(q3 - q1, qr.MIN_SPREAD[name])
                kept = q1 - spread <= r[m] <= q3 + spread
        want[r[0]] = kept
    got = {r.doc_id: r.kept for r in qr.verdict(df, qr.fit_bands(df, rule), rule).collect()}
    assert got == want
    assert 5 < sum(not v and rows[k] in passes for k, v in want.items()) < 100
