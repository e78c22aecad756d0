"""Language-model scores of whole texts: word unigrams and a causal attention model (operator 7).

``fit`` counts all words of all training texts with Spark, for the base score. The texts as they
stand, encoded once, give the counts of subword ids and of ids after input classes, with each text's
start and end, from which the classes of the attention model and the shares inside them follow. The
model is trained by averaged local runs over all training texts, each read in one of the rounds: each
task trains on its own part, and Spark averages the weights by places seen.

``score`` reads each text once. Words whose count reaches the 2 ** -19th part of all training
tokens, which are 2 ** 19 at most, have their counts broadcast; counts of the other words come by a
join on the 64-bit hash of the word. Subword ids go through the model in overlapping windows, each
place scored once.

Edge cases: a null or empty text is its end token only; with nothing to learn from, all counts are
0 and the model has its initial weights; repeated rows are scored alike; an empty table gives no
rows; a null doc_id is never held out. Input columns named like
added ones are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockflow.llm import attention as at
from stockflow.llm.arrays import (LOWER, add_columns, broadcast_file, chunks, digests, kept, list_array, named, numbered, offsets, small_batches, span_codes,
                                  span_digests, text_bytes, without, words)
from stockflow.llm.bpe import model
from stockflow.llm.pieces import HashIndex, PieceCache
from stockflow.session import materialize

FREQUENT = 1 << 19


@dataclass(frozen=True)
class Settings:
    share: int = 1       # one training text in so many trains the attention weights
    rounds: int = 2      # each text that trains does so in one of them
    rate: float = 0.01


@dataclass
class Model:
    vocabulary: DataFrame          # word, n: a written table
    tokens: int                    # N
    distinct: int                  # V
    ends: int                      # training texts
    classes: at.Classes
    weights: dict[str, np.ndarray]


def _low_words(col: pa.Array):
    data, off = text_bytes(col)
    low = LOWER[data]
    return low, *words(low, off)


def count_words(texts: DataFrame, text: str) -> DataFrame:
    """``word binary, n long`` over all rows, counted chunk by chunk before the shuffle."""
    def count(batches):
        for whole in batches:
            for b in chunks(whole, text):
                low, start, end, _ = _low_words(b.column(0))
                code, names = span_codes(low, start, end)
                yield pa.RecordBatch.from_arrays([names, pa.array(np.bincount(code, minlength=len(names)))], ["word", "n"])

    return small_batches(texts.select(text)).mapInArrow(count, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def encode(df: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Add ``ids array<int>``, the subword ids of every whole text. ``fit`` and ``score`` take them from
    a written table, so that its texts are encoded once for both."""
    return _with_ids(df, broadcast_file(df.sparkSession, path), pattern, text, ids)


def _with_ids(df: DataFrame, shared, pattern: str, text: str, ids: str, carry: list[str] | None = None) -> DataFrame:
    def make():
        cache = kept(("lm", hash((shared.value, pattern))), lambda: PieceCache(model(shared, pattern).encode, 250_000))

        def step(b: pa.RecordBatch) -> list[pa.Array]:
            return [list_array(*cache.ids(b.column(text)), pa.int32())]
        return step

    return add_columns(df, text, f"`{ids}` array<int>", make, carry, warm=True)


def _parted(train: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``id``, ``part`` (deals out the texts to rounds) and ``text`` beside the ids of training texts."""
    key = F.col(doc_id).cast("string")
    own = [F.col(text).alias("text"), key.alias("id"), F.xxhash64(key, F.col(text), F.lit(5)).alias("part")]
    return train.select(*own, *(["ids"] if "ids" in train.columns else []))


def _encoded(train: DataFrame, doc_id: str, text: str, shared, pattern: str) -> DataFrame:
    """``id, part, ids`` of every training text, written."""
    return materialize(_with_ids(_parted(train, doc_id, text), shared, pattern, "text", "ids", ["id", "part"]), "lm-ids")


def _texts(batches, column: int = 0):
    """Ids and offsets of 64 encoded texts at a time."""
    for b in batches:
        for i in range(0, b.num_rows, 64):
            col = b.slice(i, 64).column(column)
            yield np.asarray(col.flatten(), np.int64), offsets(np.asarray(pa.compute.list_value_length(col), np.int64))


def _over_texts(encoded: DataFrame, size: int, places) -> tuple[np.ndarray, np.ndarray]:
    """Counts over all encoded texts: ``places(ids, off)`` gives the places among ``size`` that some
    texts add 1 to; Spark sums what the tasks have counted. Returns places and counts."""
    def count(batches):
        total = np.zeros(size, np.int64)
        for ids, off in _texts(batches):
            np.add.at(total, places(ids, off), 1)
        at_ = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at_), pa.array(total[at_])], ["id", "n"])

    rows = small_batches(encoded.select("ids")).mapInArrow(count, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n")).toArrow()
    return np.asarray(rows["id"]), np.asarray(rows["n"])


def _classes(encoded: DataFrame, ends: int, shared, pattern: str) -> tuple[at.Classes, np.ndarray]:
    """Classes of the subword ids from their corpus counts, and counts of ids after input classes.
    Both tables are as large as the vocabulary file and the classes make them."""
    own = model(shared, pattern)
    n_ids = len(own.token_off)  # the file's ids and the end sign

    seen, n = _over_texts(encoded, n_ids, lambda ids, off: ids)
    counts = np.zeros(n_ids)
    counts[seen] = n
    counts[-1] = ends
    c = at.classes(counts, [own.token_bytes[a:b].tobytes() for a, b in zip(own.token_off, own.token_off[1:])] + [b""])
    inputs = c.inputs

    def pairs(ids, off):
        given, target = at.sequences(ids, off, inputs)
        return given * n_ids + target

    key, n = _over_texts(encoded, (at.INPUTS + 1) * n_ids, pairs)
    return at.given_last(c, key // n_ids, key % n_ids, n), counts


def _listed(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return np.asarray(col.flatten(), np.int64), offsets(np.asarray(pa.compute.list_value_length(col), np.int64))


def _train(encoded: DataFrame, c: at.Classes, counts: np.ndarray, s: Settings):
    """Rounds of local training. A task trains on a split of the written table, whose order is fixed,
    so a task that is run again, or the whole fit, gives the same weights."""
    spark = encoded.sparkSession
    sample = small_batches(encoded).where(F.pmod(F.xxhash64("id"), F.lit(s.share)) == 0)
    flat = at.pack(at.initial(c, counts))
    for k in range(s.rounds):
        given = spark.sparkContext.broadcast((flat, at.Classes(c.inputs, c.outputs, np.zeros((0, 0)))))

        def run(batches, k=k, given=given):
            start, own = given.value
            weights, seen = at.train_local(at.unpack(start), own, _texts(batches), s.rate / (k + 1), 11 + k)
            if seen:
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(start), dtype=np.int32)), pa.array(at.pack(weights).astype(np.float64) * seen),
                                                  pa.array(np.full(len(start), seen, np.int64))], ["at", "v", "seen"])

        mean = (sample.where(F.pmod(F.xxhash64("part"), F.lit(s.rounds)) == k).select("ids").mapInArrow(run, "at int, v double, seen bigint")
                .groupBy("at").agg((F.sum("v") / F.sum("seen")).alias("v")).toArrow())  # one row for each weight
        if mean.num_rows:
            flat = np.zeros(len(flat), np.float32)
            flat[np.asarray(mean["at"])] = np.asarray(mean["v"])
    return at.unpack(flat)


def fit(train: DataFrame, path: str, pattern: str, s: Settings = Settings(), doc_id: str = "doc_id", text: str = "text",
        ids: str | None = None) -> Model:
    """Learn word counts, subword classes and attention weights from the training rows; ``ids`` names
    the column that ``encode`` has added to a written table."""
    shared = broadcast_file(train.sparkSession, path)
    vocabulary = materialize(count_words(train, text), "lm-words")
    total = vocabulary.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    ends = train.count()
    if ids:
        encoded = _parted(train.withColumn("ids", F.col(ids)), doc_id, text).drop("text")
    else:
        encoded = _encoded(train, doc_id, text, shared, pattern)
    c, counts = _classes(encoded, ends, shared, pattern)
    weights = _train(encoded, c, counts, s)
    return Model(vocabulary, total["n"] + ends, total["v"] + (ends > 0), ends, c, weights)


def _hashed(vocabulary: DataFrame) -> DataFrame:
    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(digests(b.column(0).to_pylist()).view(np.int64)), b.column(1)], ["hash", "c"])

    return vocabulary.select("word", "n").mapInArrow(run, "hash bigint, c bigint")


def score(df: DataFrame, m: Model, path: str, pattern: str, text: str = "text", carry: list[str] | None = None,
          ids: str | None = None) -> DataFrame:
    """Add ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score`` to every row; with
    ``ids`` the texts are not encoded again."""
    spark = df.sparkSession
    shared = broadcast_file(spark, path)
    added = ["n_tokens", "n_known", "train_tokens", "base_score", "score"]
    keep = [c for c in without(df, added) if carry is None or c in carry]
    work, text = numbered(df, keep, _text=text, **({"_ids": ids} if ids else {})), "_text"
    if not ids:
        work = _with_ids(work, shared, pattern, text, "_ids")
    hashed = _hashed(m.vocabulary)
    often = hashed.where(F.col("c") * FREQUENT >= m.tokens).toArrow()  # FREQUENT rows at most
    h, c = np.asarray(often["hash"]).view(np.uint64), np.asarray(often["c"])
    given = spark.sparkContext.broadcast((h, c, m.ends, m.classes, m.weights))

    def make():
        known, count, ends, cl, weights = given.value
        index = HashIndex(max(8, int(2 * len(known) + 1).bit_length()))
        index.add(known, np.arange(len(known), dtype=np.int32))
        log_count = np.log10(np.append(count, 0) + 0.5)

        def step(b: pa.RecordBatch) -> list[pa.Array]:
            n = b.num_rows
            low, start, end, row = _low_words(b.column(text))
            h = span_digests(low, start, end)
            place = index.find(h)
            hit = place >= 0
            tokens = np.bincount(row, minlength=n) + 1
            base = np.bincount(row[hit], log_count[place[hit]], n) + np.log10(ends + 0.5)
            seen = np.bincount(row[hit], minlength=n) + (ends > 0)
            r, x = row[~hit], h[~hit]
            o = np.lexsort((x, r))
            r, x = r[o], x[o]
            new = np.ones(len(r), bool)
            new[1:] = (r[1:] != r[:-1]) | (x[1:] != x[:-1])
            first = np.flatnonzero(new)
            times = np.diff(np.append(first, len(r)))
            rare_off = offsets(np.bincount(r[first], minlength=n))
            lp = at.log_prob(weights, cl, *_listed(b.column("_ids"))) / np.log(10)
            return [pa.array(tokens), pa.array(seen.astype(np.int64)), pa.array(base), pa.array(lp),
                    list_array(x[first].view(np.int64), rare_off, pa.int64()), list_array(times, rare_off, pa.int64())]
        return step

    new = "n_tokens bigint, _seen bigint, _base double, score double, _rare array<bigint>, _times array<bigint>"
    read = add_columns(work.withColumn("_row", F.monotonically_increasing_id()), text, new, make, without(work, [text, "_ids"]) + ["_row"], warm=True, also=["_ids"])
    read = materialize(read, "lm-scored")  # from here on _row is fixed
    rare = (read.select("_row", F.explode(F.arrays_zip("_rare", "_times")).alias("x"))
            .select("_row", F.col("x._rare").alias("hash"), F.col("x._times").alias("times"))
            .join(hashed, "hash", "left").withColumn("c", F.coalesce("c", F.lit(0))))
    sums = rare.groupBy("_row").agg(F.sum(F.col("times") * F.log10(F.col("c") + 0.5)).alias("_more"),
                                    F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("_also"))
    down = float(np.log10(m.tokens + 0.5 * (m.distinct + 1)))
    done = (read.drop("_rare", "_times").join(sums, "_row", "left")
            .withColumn("n_known", F.col("_seen") + F.coalesce("_also", F.lit(0)))
            .withColumn("train_tokens", F.lit(m.tokens).cast("bigint"))
            .withColumn("base_score", F.col("_base") + F.coalesce("_more", F.lit(0.0)) - F.col("n_tokens") * F.lit(down)))
    return named(done, keep, added)


def held_out(doc_id: Column, parts: int, part: int = 1) -> Column:
    """Whether crc32 of the id as text leaves remainder ``part``; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts == part, F.lit(False))
