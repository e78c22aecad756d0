"""Quality rules by tokeniser fertility (operator 4).

``measure`` counts words, repeats and symbols of every whole text and encodes it with two public
vocabularies: a SentencePiece model with byte fallback (spaces at the text's ends are left out) and
a byte-level rank file. That gives
characters per token under each, the share of byte-fallback tokens, and the entropy of the text's
own token distribution. ``fit_bands`` takes, over all documents, the quartiles of these measures
for each language (for documents without one, each script) and length class and turns them into
rejection bands; ``verdict`` rejects what leaves its band to either side or fails the base rule.

Edge cases: a null or empty text has no words and fails the base rule; texts repeated in rows are
judged alike; an empty table has no bands and no rows; a group whose members all measure the same
still has a band of ``MIN_SPREAD`` to either side. Input columns named like added ones are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockflow.llm.arrays import SPACE, add_columns, broadcast_file, kept, mix, row_sums, span_codes, text_bytes, words
from stockflow.llm.bpe import model
from stockflow.llm.pieces import PieceCache, SpaceCache

SYMBOL = np.zeros(256, bool)
SYMBOL[list(b"#*$%&|<>")] = True
#: Script of a character by the first byte of its UTF-8 form (coarse, but one look-up a byte).
SCRIPTS = ("Latin", "Greek", "Cyrillic", "Hebrew", "Arabic", "Indic", "Kana", "Han", "Hangul", "Other")
_SCRIPT = np.full(256, 255, np.uint8)
for _low, _high, _k in ((65, 90, 0), (97, 122, 0), (0xC3, 0xC9, 0), (0xCD, 0xCF, 1), (0xD0, 0xD4, 2), (0xD6, 0xD7, 3),
                        (0xD8, 0xDB, 4), (0xE0, 0xE0, 5), (0xE3, 0xE3, 6), (0xE4, 0xE9, 7), (0xEA, 0xED, 8), (0xE1, 0xE1, 9), (0xF0, 0xF4, 9)):
    _SCRIPT[_low: _high + 1] = _k

MEASURES = ("chars_per_piece", "chars_per_byte_token", "fallback_share", "token_entropy")
MAX_BANDS = 10_000
MIN_SPREAD = {"chars_per_piece": 0.03, "chars_per_byte_token": 0.03, "fallback_share": 0.005, "token_entropy": 0.1}
#: Documents' worth of the language's quartiles in those of each of its length classes.
PRIOR = 8.0


@dataclass(frozen=True)
class Rule:
    """Thresholds. A band reaches from the quartiles outward by ``width`` quartile distances.

    On the labelled documents of sf0.1 that pass the base rule, width 3 rejects most of low quality
    and about 0.1 % of the clean ones; 2.5 rejects some more of both."""

    min_words: int = 50
    max_repeat_percent: int = 50
    width: float = 3.0


def base_counts(data: np.ndarray, off: np.ndarray) -> dict[str, np.ndarray]:
    """Counts of the base rule for each row of concatenated UTF-8 texts."""
    n = len(off) - 1
    start, end, row = words(data, off)
    h = span_codes(data, start, end)[0].astype(np.uint64)  # equal words have equal numbers, others do not
    lead = (data & 0xC0) != 0x80
    # three words in a row of one text
    w = np.flatnonzero(row[2:] == row[:-2]) if len(row) > 2 else np.zeros(0, np.int64)
    three = mix(mix(h[w] + np.uint64(1)) + mix(h[w + 1] + np.uint64(2)) * np.uint64(3) + h[w + 2]) + row[w].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    _, inverse, many = np.unique(three, return_inverse=True, return_counts=True)
    twice = w[many[inverse] > 1] if len(w) else w
    repeated = np.zeros(len(row), bool)
    for k in range(3):
        repeated[twice + k] = True
    # lines
    breaks = np.flatnonzero(data == 10)
    begin = np.unique(np.concatenate([off[:-1], breaks + 1]))
    begin = begin[begin < len(data)]
    stop = np.append(begin[1:], len(data))
    stop = stop - ((stop > begin) & (data[stop - 1] == 10)) if len(data) else stop
    line_row = np.searchsorted(off, begin, "right") - 1
    solid = np.concatenate([[0], np.cumsum(~SPACE[data])])
    has = solid[stop] > solid[begin]
    begin, stop, line_row = begin[has], stop[has], line_row[has]
    line, _ = span_codes(data, begin, stop)
    _, first = np.unique(line_row * (len(line) + 1) + line, return_index=True)
    later = np.ones(len(line), bool)
    later[first] = False
    return {
        "n_words": np.bincount(row, minlength=n),
        "word_chars": row_sums(lead & ~SPACE[data], off),
        "n_symbols": row_sums(SYMBOL[data], off),
        "n_dup_lines": np.bincount(line_row[later], minlength=n),
        "n_repeat_words": np.bincount(row[repeated], minlength=n),
    }


def entropy(flat: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Bits of entropy of each row's own distribution of ids."""
    size = np.diff(off)
    key = np.repeat(np.arange(len(size)), size) << 32 | flat
    ids, count = np.unique(key, return_counts=True)
    row = ids >> 32
    inner = np.bincount(row, count * np.log2(count), len(size))
    safe = np.maximum(size, 1)
    return np.maximum(0, np.log2(safe) - inner / safe)


def scripts(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Index of the most frequent script of each row (Other without any letter)."""
    kind = _SCRIPT[data]
    counts = np.stack([row_sums(kind == k, off) for k in range(len(SCRIPTS))], 1)
    return np.where(counts.sum(1) > 0, counts.argmax(1), len(SCRIPTS) - 1)


def measure(df: DataFrame, piece_path: str, byte_path: str, pattern: str, text: str = "text",
            carry: list[str] | None = None) -> DataFrame:
    """Add the base counts and the fertility measures of every whole text."""
    piece_file, byte_file = broadcast_file(df.sparkSession, piece_path), broadcast_file(df.sparkSession, byte_path)

    def make():
        import sentencepiece

        pieces = sentencepiece.SentencePieceProcessor(model_proto=piece_file.value)
        fallback = np.array([pieces.is_byte(i) for i in range(pieces.vocab_size())])
        byte_model = model(byte_file, pattern)

        def count_bytes(strings: list[str]):
            return np.diff(byte_model.encode(strings)[1]).astype(np.int32), np.arange(len(strings) + 1)

        key = hash((piece_file.value, byte_file.value, pattern))
        by_piece = kept(("fertility", key), lambda: SpaceCache(pieces, 120_000), 3)
        by_byte = kept(("fertility bytes", key), lambda: PieceCache(count_bytes, 120_000), 3)

        def step(b: pa.RecordBatch) -> list[pa.Array]:
            col = b.column(text)
            data, off = text_bytes(col)
            base = base_counts(data, off)
            ids, at = by_piece.ids(col)
            n = np.diff(at)
            byte_n = row_sums(*by_byte.ids(col))
            chars = row_sums((data & 0xC0) != 0x80, off)
            return [*[pa.array(v.astype(np.int64)) for v in base.values()],
                    pa.array(chars / np.maximum(n, 1)), pa.array(chars / np.maximum(byte_n, 1)),
                    pa.array(row_sums(fallback[ids], at) / np.maximum(n, 1)), pa.array(entropy(ids, at)),
                    pa.array([SCRIPTS[k] for k in scripts(data, off)], pa.string())]
        return step

    new = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, " + \
        ", ".join(f"{m} double" for m in MEASURES) + ", script string"
    return add_columns(df, text, new, make, carry, warm=True)


def base_failed(rule: Rule):
    n = F.col("n_words")
    return (n < rule.min_words) | (100 * F.col("n_repeat_words") > rule.max_repeat_percent * n)


def _group(lang: str):
    return F.coalesce(F.col(lang), F.concat(F.lit("script:"), F.col("script")))


def _length_class():
    """Binary digits of the number of words."""
    return F.length(F.bin("n_words"))


def fit_bands(measured: DataFrame, rule: Rule, lang: str = "lang") -> DataFrame:
    """Lowest and highest accepted value of each measure, for each language (or script) and length
    class, and for each language (null class).

    Quartiles are Spark's mergeable sketches over every document that passes the base rule.
    Entropy rises with a text's length, and the other measures of short texts vary more, so texts
    are held against those of their own length. The quartiles of a class are averaged with its
    language's, which weigh as much as ``PRIOR`` documents: a class of few documents leans on the
    language, a large one does not, and no size decides between the two.
    """
    stats = (measured.where(~base_failed(rule)).rollup(_group(lang).alias("band"), _length_class().alias("length_class"))
             .agg(F.count("*").alias("n"), *[F.percentile_approx(m, [0.25, 0.5, 0.75], 1000).alias(m) for m in MEASURES])
             .where(F.col("band").isNotNull()))
    whole = stats.where("length_class is null").select(F.col("band").alias("_band"), *[F.col(m).alias(f"{m}_all") for m in MEASURES])
    out = [F.col("band"), F.col("length_class")]
    for m in MEASURES:
        own = lambda k, m=m: (F.col("n") * F.col(m)[k] + PRIOR * F.col(f"{m}_all")[k]) / (F.col("n") + PRIOR)
        q1, q3 = own(0), own(2)
        spread = F.greatest(q3 - q1, F.lit(MIN_SPREAD[m])) * rule.width
        out += [(q1 - spread).alias(f"{m}_low"), (q3 + spread).alias(f"{m}_high")]
    # one row for each language beside one for each of its length classes (20 or so)
    return stats.join(whole, F.col("band") == F.col("_band")).select(*out)


def verdict(measured: DataFrame, bands: DataFrame, rule: Rule, lang: str = "lang") -> DataFrame:
    """Add ``base_failed`` and ``kept``; documents outside the bands of their language and length
    class (those of their language, where no document of the class passes the base rule) are not kept.

    ``bands`` must be a written table. As long as it has MAX_BANDS rows at most, it is broadcast, so
    the documents of a frequent language are not dealt to one task."""
    limits = [f"{m}_{side}" for m in MEASURES for side in ("low", "high")]
    own = bands.where("length_class is not null")
    whole = bands.where("length_class is null").select("band", *[F.col(c).alias(f"{c}_all") for c in limits])
    if bands.count() <= MAX_BANDS:
        own, whole = F.broadcast(own), F.broadcast(whole)
    joined = (measured.withColumns({"band": _group(lang), "length_class": _length_class()})
              .join(own, ["band", "length_class"], "left").join(whole, "band", "left"))
    inside = F.lit(True)
    for m in MEASURES:
        low, high = (F.coalesce(f"{m}_{side}", f"{m}_{side}_all") for side in ("low", "high"))
        inside = inside & F.coalesce(F.col(m).between(low, high), F.lit(True))
    failed = base_failed(rule)
    return (joined.withColumn("base_failed", failed).withColumn("kept", ~failed & inside)
            .drop("band", "length_class", *limits, *[f"{c}_all" for c in limits]))
