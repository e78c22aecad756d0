"""Benchmark decontamination by winnowed fingerprints (operator 13).

A window is ``span`` consecutive words of a benchmark item (an item of fewer words is one window);
a document's word is hit if it lies inside any occurrence of a window.

1. Winnowing: of every ``span`` consecutive words the least hash of their ``gram``-word grams (the
   last of equal ones) is kept, with up to ``span - gram`` words on either side. Equal windows keep
   the same gram, so every shared stretch of ``span`` words shares at least one fingerprint in the
   same place. Items shorter than ``span`` are fingerprinted as one gram each, and documents are cut
   into grams of just the lengths (below ``span``) that such items have.
2. Fingerprints of the benchmark set bits of a filter of fixed size (``FILTER_BITS``), which is
   broadcast; documents only write out fingerprints that pass it. A larger benchmark passes more of
   them but the filter never grows, and nothing is lost by it.
3. Fingerprints of documents and items are joined by a shuffle. Those that hold over 1 / ``SALTS`` of
   all document fingerprints (at most ``SALTS`` of them) are dealt out over ``SALTS`` salts.
4. Each match is extended over the words kept on either side, compared as strings, so no hash
   decides anything; stretches of at least ``span`` words are hits, and their union is counted.

Edge cases: null, empty and wordless texts have no words, hit nothing and are hit by nothing; rows
that repeat an id, on either side, are texts of their own; items that repeat an id count once for a
document; items with a null id hit words but are not listed; an empty benchmark or document table
gives no hits or no rows; input columns named like added ones are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockflow.llm.arrays import LOWER, Spans, add_columns, mix, named, numbered, offsets, text_bytes, without, words
from stockflow.session import materialize

FILTER_BITS = 26  # 8 MB when broadcast; at most 2 ** 20 rows come to the driver to set it
SALTS = 64

#: Letters and digits after lower-casing A-Z, and every byte of a character beyond ASCII.
_INSIDE = np.zeros(256, bool)
_INSIDE[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_MARKS = "array<struct<width: int, print: bigint, start: bigint, before: array<string>, gram: array<string>, after: array<string>>>"


def _grams(word: np.ndarray, width: int) -> np.ndarray:
    """Hash of the ``width`` words from each word on (those that leave the array are left out)."""
    n = max(len(word) - width + 1, 0)
    h = np.full(n, np.uint64(width))
    for k in range(width):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + word[k: k + n])
    return h


def winnow(word: np.ndarray, end: np.ndarray, span: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """First words and hashes of the grams kept: in each ``span`` words of one text (``end`` is where
    the text of each word ends) the least hash, of equal ones the last."""
    h = _grams(word, gram)
    first = np.flatnonzero(np.arange(len(word)) + span <= end)
    best, at = h[first], first.copy()
    for k in range(1, span - gram + 1):
        other = h[first + k]
        lower = other <= best
        best[lower], at[lower] = other[lower], first[lower] + k
    once = np.ones(len(at), bool)
    once[1:] = at[1:] != at[:-1]  # later windows never keep an earlier gram
    return at[once], best[once]


def _marked(df: DataFrame, text: str, carry: list[str], span: int, gram: int, short: list[int] | None, bits=None) -> DataFrame:
    """Add ``n_words`` and ``marks``, the fingerprints of every text; ``short`` names the widths below
    ``span`` that are wanted of every text (None: a text below ``span`` words is one gram)."""
    def make():
        def step(b: pa.RecordBatch) -> list[pa.Array]:
            data, off = text_bytes(b.column(text))
            low = LOWER[data]
            s, e, row = words(low, off, _INSIDE)
            n_words = np.bincount(row, minlength=b.num_rows)
            at = offsets(n_words)
            end = at[row + 1]
            word = Spans(low).hash(s, e)
            kept = [(*winnow(word, end, span, gram), span, gram)]
            if short is None:
                for width in np.unique(n_words[(n_words > 0) & (n_words < span)]).tolist():
                    of = np.flatnonzero(n_words == width)
                    kept.append((at[of], _grams(word, width)[at[of]], width, width))
            else:
                kept += [(*winnow(word, end, width, width), width, width) for width in short]
            place, prints, spans, grams = (np.concatenate(x) for x in zip(*[(p, h, np.full(len(p), w), np.full(len(p), g)) for p, h, w, g in kept]))
            if bits is not None:
                ok = (bits.value[prints >> np.uint64(70 - FILTER_BITS)] >> (prints >> np.uint64(64 - FILTER_BITS) & np.uint64(63))) & np.uint64(1) == 1
                place, prints, spans, grams = place[ok], prints[ok], spans[ok], grams[ok]
            own = row[place]
            order = np.argsort(own, kind="stable")
            place, prints, spans, grams, own = place[order], prints[order], spans[order], grams[order], own[order]
            raw = low.tobytes()

            def strings(first: np.ndarray, last: np.ndarray) -> pa.Array:
                return pa.array([[raw[s[k]: e[k]].decode() for k in range(i, j)] for i, j in zip(first.tolist(), last.tolist())], pa.list_(pa.string()))

            left = np.maximum(place - (spans - grams), at[own])
            right = np.minimum(place + spans, at[own + 1])
            fields = [pa.array(spans.astype(np.int32)), pa.array(prints.view(np.int64)), pa.array(place - at[own]),
                      strings(left, place), strings(place, place + grams), strings(place + grams, right)]
            listed = pa.ListArray.from_arrays(pa.array(offsets(np.bincount(own, minlength=b.num_rows)).astype(np.int32)),
                                              pa.StructArray.from_arrays(fields, ["width", "print", "start", "before", "gram", "after"]))
            return [pa.array(n_words), listed]
        return step

    return add_columns(df, text, f"n_words bigint, marks {_MARKS}", make, carry)


def _filter(prints: DataFrame):
    """Bits of all fingerprints, as a broadcast array of 64-bit words."""
    at = F.shiftrightunsigned("print", 64 - FILTER_BITS)
    rows = (prints.groupBy(F.shiftright(at, 6).alias("word")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), at.bitwiseAND(63).cast("int"))).alias("bits"))
            .toArrow())
    bits = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
    bits[np.asarray(rows["word"], np.int64)] = np.asarray(rows["bits"], np.int64).view(np.uint64)
    return prints.sparkSession.sparkContext.broadcast(bits)


def _same(a: str, b: str):
    """How many words two arrays share from their start."""
    differs = F.array_position(F.zip_with(a, b, lambda x, y: ~x.eqNullSafe(y)), True)
    return F.when(differs == 0, F.size(a)).otherwise(differs - 1)


def contaminated(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
                 span: int = 10, gram: int = 5, carry: list[str] | None = None) -> DataFrame:
    """Add ``n_words``, ``n_hit`` (words inside any window of any item), ``n_items`` and ``items
    array<string>`` (the ids of items with a window in the text, sorted as strings) and
    ``contaminated`` (n_hit > 0)."""
    added = ["n_words", "n_hit", "n_items", "items", "contaminated"]
    keep = [c for c in without(docs, added) if carry is None or c in carry]

    tests = materialize(_marked(numbered(items, [], _item=item_id, _text=item_text), "_text", ["_item"], span, gram, None)
                        .select(F.col("_item").cast("string").alias("item"), F.inline("marks")), "marks")
    short = sorted(r.width for r in tests.where(F.col("width") < span).select("width").distinct().collect())  # fewer than span
    work = numbered(docs, keep, _text=text)
    texts = materialize(_marked(work, "_text", without(work, ["_text"]), span, gram, short, _filter(tests))
                        .withColumn("_row", F.monotonically_increasing_id()), "marked")
    found = texts.select("_row", F.inline("marks"))

    total = F.lit(max(SALTS, found.count()))
    hot = F.broadcast(found.groupBy("print").count().where(F.col("count") * SALTS > total).select("print", F.lit(True).alias("hot")))
    left = (found.join(hot, "print", "left")
            .withColumn("salt", F.when(F.col("hot"), F.pmod(F.xxhash64("_row", "start"), F.lit(SALTS))).otherwise(0).cast("int")))
    right = (tests.join(hot, "print", "left")
             .withColumn("salt", F.explode(F.when(F.col("hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))))
             .select("print", "width", "salt", "item", F.col("gram").alias("t_gram"), F.col("before").alias("t_before"), F.col("after").alias("t_after")))
    matched = left.join(right, ["print", "width", "salt"]).where("gram = t_gram")
    before, after = _same(F.reverse("before"), F.reverse("t_before")), _same("after", "t_after")
    hits = materialize(matched.select("_row", "item", "width", (F.col("start") - before).alias("first"), (F.col("start") + F.size("gram") + after).alias("last"))
                       .where("last - first >= width").select("_row", "item", "first", "last").distinct(), "hits")

    upto = F.max("last").over(Window.partitionBy("_row").orderBy("first", "last").rowsBetween(Window.unboundedPreceding, -1))
    n_hit = (hits.select("_row", "first", "last").distinct().withColumn("upto", F.coalesce(upto, F.lit(0)))
             .groupBy("_row").agg(F.sum(F.greatest(F.lit(0), F.col("last") - F.greatest("first", "upto"))).alias("n_hit")))
    listed = (hits.select("_row", "item").distinct().groupBy("_row").agg(F.sort_array(F.collect_list("item")).alias("items")))
    done = (texts.drop("marks").join(n_hit, "_row", "left").join(listed, "_row", "left")
            .withColumn("n_hit", F.coalesce("n_hit", F.lit(0)).cast("bigint"))
            .withColumn("items", F.coalesce("items", F.array().cast("array<string>")))
            .withColumn("n_items", F.size("items").cast("bigint")).withColumn("contaminated", F.col("n_hit") > 0))
    return named(done, keep, added)
