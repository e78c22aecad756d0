"""The operators applied to the whole test tables, with their SQL where SQL can express them."""

from __future__ import annotations

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockflow.llm import (alignment, bpe, cotraining, decontamination, language_id, lm_scoring, near_dedup, packing, periodic, quality_rules, sharding,
                           token_counts, topk)
from stockflow.llm import oracle
from stockflow.llm.arrays import named, numbered, without
from stockflow.llm.lm_scoring import held_out
from stockflow.session import materialize

PATTERN = public_tokenizers.PATTERN
CAPACITY = 2048


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = cotraining.fit(docs, _table(spark, sf_dir, "labels"))
    return cotraining.classify(docs, model, carry=["doc_id"])


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    coded = bpe.encode(_table(spark, sf_dir, "documents"), path, PATTERN, carry=["doc_id"])
    back = bpe.decode(coded, path, PATTERN)
    return back.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
                       F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").withColumn("held_out", held_out(F.col("doc_id"), 3))
    model = language_id.fit(docs.where(~F.col("held_out")))
    return language_id.predict(docs, model, carry=["doc_id", "held_out"])


def _judged(docs: DataFrame, carry: list[str], text: str = "text", lang: str = "lang") -> DataFrame:
    rule = quality_rules.Rule()
    measured = materialize(quality_rules.measure(docs, public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                                                 PATTERN, text, carry), "measured")
    return quality_rules.verdict(measured, materialize(quality_rules.fit_bands(measured, rule, lang), "bands"), rule, lang)


def op4_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = _judged(_table(spark, sf_dir, "documents"), ["doc_id", "lang"])
    return done.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
                       *quality_rules.MEASURES, "script")


def op5_byte_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    docs = _table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 1).cast("bigint").alias("size"), F.crc32(text).alias("text_crc32"), F.md5(text).alias("content"))
    placed = sharding.shard(docs, 8, "size", ["content", "doc_id"])
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("bigint").alias("slot"),
                         F.lit(None).cast("int").alias("grown_shard"))


def op6_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents"), carry=["doc_id"])


def op7_attention_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    docs = _table(spark, sf_dir, "documents").withColumn("held_out", held_out(F.col("doc_id"), 5))
    docs = materialize(lm_scoring.encode(docs.select("doc_id", "text", "held_out"), path, PATTERN), "lm-texts")
    model = lm_scoring.fit(docs.where(~F.col("held_out")), path, PATTERN, ids="ids")
    return lm_scoring.score(docs, model, path, PATTERN, carry=["doc_id", "held_out"], ids="ids")


def packed(docs: DataFrame) -> DataFrame:
    cut = packing.pieces(docs, public_tokenizers.path("byte_bpe_50k.json"), PATTERN, CAPACITY, carry=["doc_id"])
    items = materialize(cut.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"),
                                   F.monotonically_increasing_id().alias("row")), "pieces")
    return packing.pack(items, CAPACITY).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op8_genetic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(_table(spark, sf_dir, "documents"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").withColumn("n_bytes", F.octet_length(F.coalesce("text", F.lit(""))).cast("bigint"))
    return (token_counts.count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"), PATTERN, carry=["doc_id", "n_bytes"])
            .withColumn("over_limit", F.col("n_tokens") > 512))


def op10_bit_sliced_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.quantise(_table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vector")), "vector", 64)
    return topk.top_k(vectors, vectors.where(F.col("vec_id") % 20 == 0), 20)


def _looped(b: pa.RecordBatch, off: np.ndarray) -> np.ndarray:
    """Words to read: from word a on, texts of ``loop`` = h with h % 10 = 0 repeat their p words from there."""
    size = np.diff(off)
    h = np.asarray(pa.compute.fill_null(b.column("loop"), 1), np.int64)  # no id: nothing repeats
    row = np.repeat(np.arange(len(size)), size)
    g, n = (h // 10)[row], size[row]
    i = np.arange(len(row)) - off[row]
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return off[row] + np.where((h % 10 == 0)[row] & (i >= a), a + (i - a) % p, i)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").withColumn("loop", F.crc32(F.col("doc_id").cast("string")))
    done = periodic.mark_runs(docs, carry=["doc_id", "loop"], rearrange=_looped)
    best = F.expr("aggregate(runs, cast(null as struct<start: bigint, length: bigint, period: bigint>), "
                  "(m, r) -> if(m is null or r.length * m.period > m.length * r.period, r, m))")
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    return (done.withColumn("best", best)
            .select("doc_id", F.size("runs").cast("bigint").alias("n_runs"), "best.start", "best.length", "best.period",
                    F.floor(F.lit(1000) * F.col("best.length") / F.col("best.period")).cast("bigint").alias("exponent_milli"),
                    F.sha2(F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise(""), 256).alias("runs_sha256"),
                    F.sha2("collapsed", 256).alias("collapsed_sha256")))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    aligned = alignment.align(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"),
                              PATTERN, carry=["doc_id"])
    digest = F.when(F.col("n_groups") > 0, F.sha2("groups", 256)).otherwise("")
    done = alignment.corpus_links(materialize(aligned.withColumn("groups_sha256", digest).drop("groups"), "aligned"))
    return done.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op13_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = decontamination.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), carry=["doc_id"])
    return done.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


QUERIES = {f.__name__: f for f in (op1_cotraining, op2_byte_bpe, op3_language_id, op4_fertility, op5_byte_shards, op6_hyperminhash,
                                   op7_attention_lm, op8_genetic_packing, op9_token_counts, op10_bit_sliced_topk, op11_periodic_runs, op12_token_alignment,
                                   op13_winnowing)}
ORACLE = {"op5_byte_shards": oracle.BYTE_SHARDS, "op6_hyperminhash": oracle.NEAR_DUPLICATES, "op10_bit_sliced_topk": oracle.TOP_K,
          "op11_periodic_runs": oracle.PERIODIC_RUNS, "op13_winnowing": oracle.CONTAMINATED}


# -- stages of the pipeline -----------------------------------------------------------------------

def keep_by_rules(docs: DataFrame) -> DataFrame:
    work = numbered(docs, _text="text", _lang="lang")
    return named(_judged(work, without(work, ["_text"]), "_text", "_lang").where("kept"), docs.columns)


def keep_by_classifier(docs: DataFrame, labels: DataFrame) -> DataFrame:
    model = cotraining.fit(docs, labels)
    work = numbered(docs, _text="text", _source="source", _lang="lang", _chars="n_chars")
    return named(cotraining.classify(work, model, text="_text", source="_source", lang="_lang", n_chars="_chars").where("kept"), docs.columns)


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    return near_dedup.representatives(docs)
