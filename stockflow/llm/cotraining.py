"""Quality classifier by co-training of two views (operator 1).

The text view sees words, runs of punctuation and the shape of the text; the metadata view sees
source, language, length and line layout. Each view has a logistic model for two targets: low
quality and toxic. In every round each view labels the pool documents it is most sure of for the
*other* view, and both are fitted again. Both views are then calibrated on labelled rows kept out
of the fit (Platt scaling), and a last logistic model combines the two calibrated log-odds.
All documents are scored with the broadcast weights. Copies and near copies in the sample, whose
shared words would pass for signs of their label, count once: of documents that agree in minima of
their rarer features only one is fitted.

Fitting uses at most ``max_labelled`` labelled documents and a pool of at most ``max_pool`` others,
both those with the smallest hashes of ``doc_id``, so the driver's share is bounded. Scoring covers
every row.

Edge cases: a null or empty text has only shape features; null metadata is a value of its own;
repeated labels of one document count as the worst of them; without labels, or with one class only,
a target's probability is its base rate (0 without labels). Of documents of equal confidence those
with the smaller id are handed over first. Repeated rows are scored alike, and a text of
any length is read whole. Input columns named like added ones are replaced; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockflow.llm.arrays import LOWER, Spans, add_columns, list_array, mix, named, numbered, offsets, row_sums, text_bytes, without, words

BUCKETS = 1 << 20
TARGETS = ("low", "toxic")
_LETTER = np.zeros(256, bool)
_LETTER[97:123] = _LETTER[65:91] = _LETTER[128:] = True
_MARK = np.zeros(256, bool)
for _a, _b in ((0x21, 0x30), (0x3A, 0x41), (0x5B, 0x61), (0x7B, 0x7F)):
    _MARK[_a:_b] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True


@dataclass(frozen=True)
class Settings:
    """Bounds and thresholds of the fit."""

    max_labelled: int = 8000
    max_pool: int = 8000
    rounds: int = 3
    confident: float = 0.95      # a pseudo-label needs this probability of its class
    grow: int = 400              # and at most so many of each class are handed over in a round
    min_chi2: float = 40.0       # text features kept: association with the target in labelled rows
    min_count: int = 8
    steps: int = 60
    l2: float = 1e-3
    reject: float = 0.5


@dataclass
class View:
    """Weights by bucket for each target, with the Platt line (slope, intercept) of each."""

    weights: np.ndarray = field(default_factory=lambda: np.zeros((len(TARGETS), BUCKETS), np.float32))
    bias: np.ndarray = field(default_factory=lambda: np.zeros(len(TARGETS)))
    platt: np.ndarray = field(default_factory=lambda: np.tile([1.0, 0.0], (len(TARGETS), 1)))


@dataclass
class Model:
    text: View
    meta: View
    combine: np.ndarray  # for each target: weight of text, of metadata, intercept


def _bucket(h: np.ndarray, salt: int) -> np.ndarray:
    return (mix(h + np.uint64(salt)) >> np.uint64(44)).astype(np.int64)


def _bin(x: np.ndarray, salt: int) -> np.ndarray:
    return _bucket(x.astype(np.int64).astype(np.uint64), salt)


def _log2(x: np.ndarray) -> np.ndarray:
    return np.floor(np.log2(np.maximum(x, 1)))


def text_features(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of every text feature that a row has, in order of rows, each once."""
    data, off = text_bytes(col)
    n = len(off) - 1
    low = LOWER[data]
    spans = Spans(low)
    ws, we, wr = words(low, off, _LETTER)
    ms, me, mr = words(data, off, _MARK)
    word, mark = spans.hash(ws, we), spans.hash(ms, me)
    long = me - ms > 1
    n_words = np.bincount(wr, minlength=n)
    distinct = np.unique(word + wr.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93), return_index=True)[1]
    share = np.bincount(wr[distinct], minlength=n) / np.maximum(n_words, 1)
    three = np.flatnonzero(wr[2:] == wr[:-2])
    window = mix(mix(mix(word[three]) + word[three + 1]) + word[three + 2]) + wr[three].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    fresh = np.unique(window, return_index=True)[1]
    repeats = 1 - np.bincount(wr[three[fresh]], minlength=n) / np.maximum(np.bincount(wr[three], minlength=n), 1)
    letters = np.maximum(row_sums(_LETTER[data], off), 1)
    size = np.maximum(np.diff(off), 1)
    rows = np.arange(n)
    shape = [(_bin(np.ceil(16 * row_sums(_UPPER[data], off) / letters), 11)),
             (_bin(np.ceil(64 * row_sums(_MARK[data], off) / size), 12)),
             (_bin(100 * np.floor(10 * share) + _log2(n_words), 13)),
             (_bin(_log2(n_words), 14)),
             (_bin(np.ceil(10 * repeats) + 100 * (n_words < 8), 17)),
             (_bin(np.ceil(16 * np.bincount(mr[long], minlength=n) / np.maximum(n_words, 1)), 15)),
             (_bin(np.ceil(16 * np.bincount(mr, minlength=n) / np.maximum(n_words, 1)), 16))]
    key = np.concatenate([wr << 20 | _bucket(word, 1), mr << 20 | _bucket(mark, 2), *[rows << 20 | s for s in shape]])
    key = np.unique(key)
    return key >> 20, key & (BUCKETS - 1)


def meta_features(source: pa.Array, lang: pa.Array, n_chars: pa.Array, text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of the metadata features of each row."""
    data, off = text_bytes(text)
    n = len(off) - 1
    rows = np.arange(n)
    lines = row_sums(data == 10, off) + 1
    size = np.asarray(pa.compute.fill_null(n_chars, -1), np.int64)

    def name(col: pa.Array, salt: int) -> np.ndarray:
        d, o = text_bytes(pa.compute.fill_null(col.cast(pa.string()), "\x00"))
        return _bucket(Spans(d).hash(o[:-1], o[1:]), salt)

    s, g = name(source, 21), name(lang, 22)
    parts = [s, g, _bin(s * 8191 + g, 23), _bin(_log2(size + 2), 24), _bin(_log2(lines), 25), _bin(_log2(np.diff(off) / lines), 26)]
    key = np.unique(np.concatenate([rows << 20 | p for p in parts]))
    return key >> 20, key & (BUCKETS - 1)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class _Rows:
    """Features of the sampled documents: row offsets into buckets."""

    def __init__(self, table: pa.Table, name: str):
        col = table[name].combine_chunks()
        self.bucket = np.asarray(col.flatten(), np.int64)
        self.off = offsets(np.asarray(pa.compute.list_value_length(col), np.int64))

    def margin(self, view: View, t: int) -> np.ndarray:
        c = np.concatenate([[0.0], np.cumsum(view.weights[t][self.bucket], dtype=np.float64)])
        return c[self.off[1:]] - c[self.off[:-1]] + view.bias[t]

    def counts(self, rows: np.ndarray) -> np.ndarray:
        pick = np.repeat(rows, np.diff(self.off))
        return np.bincount(self.bucket[pick], minlength=BUCKETS)

    def alone(self) -> np.ndarray:
        """True for one document of each family of (near) copies: rows that agree in the three least
        hashes of their rarer features, under any of six hashings, are one family."""
        row = np.repeat(np.arange(len(self.off) - 1), np.diff(self.off))
        rare = np.bincount(self.bucket, minlength=BUCKETS)[self.bucket] <= max(50, len(self.off) // 50)
        row, bucket = row[rare], self.bucket[rare]
        keep = np.ones(len(self.off) - 1, bool)
        size = np.bincount(row, minlength=len(keep))
        three = size[row] >= 3
        row, bucket = row[three], bucket[three]
        for k in range(6):
            order = np.lexsort((_bucket(bucket.astype(np.uint64), 100 + k), row))
            begin = np.flatnonzero(np.r_[True, np.diff(row[order]) > 0]) if len(order) else order
            least = [bucket[order[begin + j]] for j in range(3)] if len(order) else [order] * 3
            _, first, back = np.unique(np.stack(least), axis=1, return_index=True, return_inverse=True) if len(order) else (0, order, order)
            later = np.arange(len(begin)) != first[back] if len(order) else order
            keep[row[order[begin]][later]] = False
        return keep

    def fit(self, y: np.ndarray, use: np.ndarray, s: Settings) -> tuple[np.ndarray, float]:
        """Logistic weights by AdaGrad over rows ``use``, on features associated with ``y``."""
        n, pos = use.sum(), (use & (y > 0)).sum()
        prior = float(np.log((pos + 0.5) / (n - pos + 0.5))) if n else -30.0
        weights = np.zeros(BUCKETS, np.float32)
        if not pos or pos == n:
            return weights, prior if n else -30.0
        a, b = self.counts(use & (y > 0)), self.counts(use & (y == 0))
        seen = np.flatnonzero(a + b >= s.min_count)
        a, b = a[seen].astype(float), b[seen].astype(float)
        c, d = pos - a, (n - pos) - b
        chi2 = n * (a * d - b * c) ** 2 / np.maximum((a + b) * (c + d) * (a + c) * (b + d), 1)
        chosen = seen[chi2 >= s.min_chi2]
        if not len(chosen):
            return weights, prior
        place = np.full(BUCKETS, -1, np.int64)
        place[chosen] = np.arange(len(chosen))
        row = np.repeat(np.arange(len(y)), np.diff(self.off))
        keep = (place[self.bucket] >= 0) & use[row]
        row, col = row[keep], place[self.bucket[keep]]
        new = np.cumsum(use) - 1
        row, target = new[row], y[use].astype(float)
        w, bias, g2, gb2 = np.zeros(len(chosen)), prior, np.full(len(chosen), 1e-8), 1e-8
        for _ in range(s.steps):
            err = _sigmoid(np.bincount(row, w[col], len(target)) + bias) - target
            g = np.bincount(col, err[row], len(chosen)) / n + s.l2 * w
            g2 += g * g
            w -= 0.5 * g / np.sqrt(g2)
            gb = err.mean()
            gb2 += gb * gb
            bias -= 0.5 * gb / np.sqrt(gb2)
        weights[chosen] = w
        return weights, bias


def _line(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression of y on the columns of x (last entry: intercept), by damped Newton steps."""
    x = np.column_stack([x, np.ones(len(y))])
    w = np.zeros(x.shape[1])
    if not len(y) or y.min() == y.max():
        return np.r_[np.full(len(w) - 1, 1.0 / (len(w) - 1)), 0.0]
    for _ in range(25):
        p = _sigmoid(x @ w)
        h = x.T @ (x * (p * (1 - p))[:, None]) + 1e-2 * np.eye(len(w))
        w -= np.linalg.solve(h, x.T @ (p - y) + 1e-2 * w)
    return w


def train(table: pa.Table, s: Settings) -> Model:
    """Co-train on collected features; ``y`` is null for pool rows, ``held`` marks calibration rows."""
    views = {"text": _Rows(table, "text_features"), "meta": _Rows(table, "meta_features")}
    model = Model(View(), View(), np.zeros((len(TARGETS), 3)))
    held = np.asarray(table["held"], bool)
    alone = views["text"].alone()
    for t, target in enumerate(TARGETS):
        raw = np.asarray(pa.compute.fill_null(table[target], -1), np.int64)
        if not (raw >= 0).any():
            model.text.bias[t] = model.meta.bias[t] = -30.0
            model.combine[t] = [0.5, 0.5, 0.0]
            continue
        own = {v: raw.copy() for v in views}       # labels and pseudo-labels of each view
        pool = {v: raw < 0 for v in views}
        for k in range(s.rounds + 1):
            for v, rows in views.items():
                view = getattr(model, v)
                view.weights[t], view.bias[t] = rows.fit(own[v], (own[v] >= 0) & ~held & alone, s)
            if k == s.rounds:
                break
            for v, other in (("text", "meta"), ("meta", "text")):
                p = _sigmoid(views[v].margin(getattr(model, v), t))
                for value, sure in ((1, p), (0, 1 - p)):
                    ok = np.flatnonzero(pool[other] & (own[other] < 0) & ~held & (sure >= s.confident))
                    best = ok[np.argsort(-sure[ok], kind="stable")[: s.grow]]
                    own[other][best] = value
        check = held & (raw >= 0) & alone
        sides = []
        for v, rows in views.items():
            view = getattr(model, v)
            m = rows.margin(view, t)
            view.platt[t] = _line(m[check][:, None], raw[check].astype(float))
            sides.append(view.platt[t, 0] * m + view.platt[t, 1])
        model.combine[t] = _line(np.stack(sides, 1)[check], raw[check].astype(float))
    return model


def fit(docs: DataFrame, labels: DataFrame, s: Settings = Settings(), doc_id: str = "doc_id", text: str = "text",
        source: str = "source", lang: str = "lang", n_chars: str = "n_chars", label_id: str = "doc_id") -> Model:
    """Draw the bounded sample, take its features on the executors and co-train on the driver."""
    order = F.xxhash64(F.col("id").cast("string"), F.lit(7))
    known = (labels.select(F.col(label_id).alias("id"), (1 - F.col("quality")).alias("low"), F.col("toxic").alias("toxic"))
             .where(F.col("id").isNotNull() & (F.col("low").isNotNull() | F.col("toxic").isNotNull())))
    worst = known.groupBy("id").agg(F.max("low").alias("low"), F.max("toxic").alias("toxic"))
    all_ids = docs.select(F.col(doc_id).alias("id")).where(F.col("id").isNotNull())
    labelled = (worst.join(all_ids.distinct(), "id", "left_semi").orderBy(order, "id").limit(s.max_labelled))
    pool = (all_ids.join(known, "id", "left_anti").distinct().orderBy(order, "id").limit(s.max_pool)
            .select("id", F.lit(None).cast("int").alias("low"), F.lit(None).cast("int").alias("toxic")))
    chosen = labelled.unionByName(pool).withColumn("held", (F.pmod(order, F.lit(4)) == 0) & (F.col("low").isNotNull() | F.col("toxic").isNotNull()))
    rows = (docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"), F.col(source).alias("source"), F.col(lang).alias("lang"),
                        F.col(n_chars).cast("bigint").alias("n_chars"))
            .join(F.broadcast(chosen), "id"))  # at most max_labelled + max_pool rows of three small columns

    def make():
        def step(b: pa.RecordBatch) -> list[pa.Array]:
            out = []
            for row, bucket in (text_features(b.column("text")), meta_features(b.column("source"), b.column("lang"), b.column("n_chars"), b.column("text"))):
                out.append(list_array(bucket.astype(np.int32), np.searchsorted(row, np.arange(b.num_rows + 1)), pa.int32()))
            return out
        return step

    table = (add_columns(rows, "text", "text_features array<int>, meta_features array<int>", make)
             .select("id", "low", "toxic", "held", "text_features", "meta_features").dropDuplicates(["id"]).orderBy("id").toArrow())
    return train(table, s)


def classify(df: DataFrame, model: Model, s: Settings = Settings(), text: str = "text", source: str = "source",
             lang: str = "lang", n_chars: str = "n_chars", carry: list[str] | None = None) -> DataFrame:
    """Add ``p_low``, ``p_toxic`` and ``kept`` (both below ``reject``) to every row."""
    shared = df.sparkSession.sparkContext.broadcast(model)  # 4 arrays of BUCKETS floats: 16 MB
    added = ["p_low", "p_toxic", "kept"]
    keep = [c for c in without(df, added) if carry is None or c in carry]
    work = numbered(df, keep, _text=text, _source=source, _lang=lang, _n_chars=n_chars).withColumns(
        {"_source": F.col("_source").cast("string"), "_lang": F.col("_lang").cast("string"), "_n_chars": F.col("_n_chars").cast("bigint")})
    text = "_text"

    def make():
        own = shared.value

        def step(b: pa.RecordBatch) -> list[pa.Array]:
            feats = (text_features(b.column(text)), meta_features(b.column("_source"), b.column("_lang"), b.column("_n_chars"), b.column(text)))
            out = []
            for t in range(len(TARGETS)):
                total = own.combine[t, 2]
                for k, (view, (row, bucket)) in enumerate(zip((own.text, own.meta), feats)):
                    margin = np.bincount(row, view.weights[t][bucket], b.num_rows) + view.bias[t]
                    total = total + own.combine[t, k] * (view.platt[t, 0] * margin + view.platt[t, 1])
                out.append(_sigmoid(total))
            return [pa.array(out[0]), pa.array(out[1]), pa.array((out[0] < s.reject) & (out[1] < s.reject))]
        return step

    return named(add_columns(work, text, "p_low double, p_toxic double, kept boolean", make), keep, added)
