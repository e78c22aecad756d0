"""Language identification: multinomial naive Bayes over hashed character n-grams (operator 3).

``fit`` counts the hashed 1- to 3-grams of lower-cased characters of all training texts, language
by language, in the tasks; Spark sums the counts. The log-probability matrix has one row for each
language and ``BUCKETS`` columns; its size is checked before it is broadcast. ``predict`` scores
whole texts in numpy: a chunk's n-gram buckets pick their log-probabilities, which are summed by
document.

Edge cases: a text that is null or has no letter gets ``und`` with score 0, and so does every text
when nothing could be learned; training rows without a language are left out; of languages with
equal scores the first by name wins; repeated rows are predicted alike; a text of any length is read
whole; an empty table gives no rows. Input columns named like added ones are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockflow.llm.arrays import BROADCAST_BYTES, add_columns, chunks, offsets, small_batches

BUCKETS = 1 << 16
ORDERS = (1, 2, 3)
_LETTER = regex.compile(r"\p{L}")
_A, _B = np.uint32(0x9E3779B1), np.uint32(0x85EBCA77)


@dataclass
class Model:
    languages: list[str]
    log_p: np.ndarray  # float32 [language, bucket]
    prior: np.ndarray


def grams(texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each order: buckets of all n-grams of the texts, one after the other, and row offsets."""
    low = [t.lower() if t else "" for t in texts]
    size = np.array([len(t) for t in low], np.int64)
    code = np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), np.uint32)
    off = offsets(size)
    out, h = [], np.zeros(len(code), np.uint32)
    for n in ORDERS:
        if len(code) < n:
            out.append((np.zeros(0, np.int64), np.zeros(len(off), np.int64)))
            continue
        h = (h[: len(code) - n + 1] * _B) ^ (code[n - 1:] * _A)
        x = h ^ (h >> np.uint32(15))
        bucket = ((x * _A) ^ np.uint32(n * 0x27D4EB2F)) * _B >> np.uint32(32 - 16)
        if n == 1:
            out.append((bucket, off))
            continue
        inside = np.ones(len(code), bool)  # n-grams that start in the last n - 1 characters cross a row
        for k in range(1, n):
            at = off[1:] - k
            inside[at[at >= off[:-1]]] = False
        keep = np.maximum(size - n + 1, 0)
        out.append((bucket[inside[: len(bucket)]], offsets(keep)))
    return out


def fit(train: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """Learn from all rows whose ``lang`` is not null."""
    rows = train.where(F.col(lang).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text"))

    def count(batches):
        have: dict[str, np.ndarray] = {}
        docs: dict[str, int] = {}

        def flush():
            for k, v in have.items():
                at = np.flatnonzero(v)
                yield pa.RecordBatch.from_arrays([pa.array([k] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(v[at])], ["lang", "bucket", "n"])
                yield pa.RecordBatch.from_arrays([pa.array([k]), pa.array([-1], pa.int32()), pa.array([docs[k]], pa.int64())], ["lang", "bucket", "n"])
            have.clear()
            docs.clear()

        for whole in batches:
            for b in chunks(whole, "text"):
                langs, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
                for name in sorted(set(langs)):
                    own = [t for x, t in zip(langs, texts) if x == name]
                    docs[name] = docs.get(name, 0) + len(own)
                    v = have.setdefault(name, np.zeros(BUCKETS, np.int64))
                    for bucket, _ in grams(own):
                        v += np.bincount(bucket, minlength=BUCKETS)
                if len(have) > 64:
                    yield from flush()
        yield from flush()

    counted = (small_batches(rows).mapInArrow(count, "lang string, bucket int, n bigint")
               .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).persist())
    try:
        names = sorted(r[0] for r in counted.where("bucket = -1").select("lang").take(BROADCAST_BYTES // (4 * BUCKETS) + 1))
        if len(names) * BUCKETS * 4 > BROADCAST_BYTES:
            raise ValueError("more languages than the log-probability matrix may hold")
        table = counted.toArrow()  # at most len(names) * (BUCKETS + 1) rows
    finally:
        counted.unpersist()
    counts, docs = np.zeros((len(names), BUCKETS)), np.zeros(len(names))
    row = np.searchsorted(np.array(names, object), np.array(table["lang"].to_pylist(), object)) if names else np.zeros(0, int)
    bucket, n = np.asarray(table["bucket"]), np.asarray(table["n"])
    grams_only = bucket >= 0
    counts[row[grams_only], bucket[grams_only]] = n[grams_only]
    docs[row[~grams_only]] = n[~grams_only]
    log_p = np.log((counts + 0.5) / (counts.sum(1, keepdims=True) + 0.5 * BUCKETS)).astype(np.float32)
    return Model(names, log_p, np.log(docs / max(docs.sum(), 1)))


def score(model: Model, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    """Predicted language and its posterior probability for each text."""
    if not model.languages:
        return ["und"] * len(texts), np.zeros(len(texts))
    total = np.repeat(model.prior[:, None], len(texts), 1)
    for bucket, off in grams(texts):
        for k, log_p in enumerate(model.log_p):
            upto = np.concatenate([[0.0], np.cumsum(log_p[bucket], dtype=np.float64)])
            total[k] += upto[off[1:]] - upto[off[:-1]]
    best = total.argmax(0)
    p = 1 / np.exp(total - total.max(0)).sum(0)
    lettered = np.array([bool(t and _LETTER.search(t)) for t in texts], bool)
    return [model.languages[k] if ok else "und" for k, ok in zip(best.tolist(), lettered.tolist())], np.where(lettered, p, 0.0)


def predict(df: DataFrame, model: Model, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Add ``lang_pred string`` and ``score double``; only the text is looked at."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def make():
        own = shared.value

        def step(b: pa.RecordBatch) -> list[pa.Array]:
            names, p = score(own, b.column(text).to_pylist())
            return [pa.array(names, pa.string()), pa.array(p, pa.float64())]
        return step

    return add_columns(df, text, "lang_pred string, score double", make, carry)
