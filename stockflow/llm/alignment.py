"""Alignment of the tokens that two vocabularies give the same bytes (operator 12).

Texts are encoded whole by both vocabularies (a byte-level BPE on a space and the text; SentencePiece
on the text, which puts that space itself). The cumulative byte ends of either id list are the keys
of an end-to-index dictionary - an array indexed by the end, as the ends of a chunk are small
numbers - and the ends that both dictionaries hold, in order, slice both lists into groups. A link is
a pair of token occurrences that end together, so a group has one: its last two tokens.

How often a pair of ids is linked in the whole corpus takes a second pass. Texts are laid down in
blocks (a chunk of ``CHUNK_BYTES``, or one longer text) with their links as numbers into the block's
list of distinct pairs. Only those lists are shuffled, to be summed by pair, and come back to their
blocks with the sums and whether a sum is the highest of its SentencePiece id; so a pair that stands
in every text is one row for each block, and a task holds the pairs of a few blocks.

Edge cases: a null or empty text has no tokens, nor has one whose tokens do not spell the space and
the text (such as one that holds the word mark itself): counts of 0, no groups; repeated rows are
aligned alike and each counts; an empty table gives no rows; input columns named like added ones are
replaced.
"""

from __future__ import annotations

from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockflow.llm.arrays import add_columns, broadcast_file, kept, named, numbered, offsets, ragged, text_bytes, without
from stockflow.llm.bpe import ByteBpe
from stockflow.llm.pieces import MARK, PieceCache, SpaceCache
from stockflow.llm.token_counts import RankMerger
from stockflow.session import materialize


class Library(SpaceCache):
    """SentencePiece ids of texts as they stand, outer spaces included."""

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.library.encode(text), np.int32)


class Names:
    """The byte strings of a vocabulary's tokens as ragged arrays, and their ids written out."""

    def __init__(self, names: list[bytes]):
        self.length = np.array([len(x) for x in names], np.int64)
        self.start, self.flat = offsets(self.length)[:-1], np.frombuffer(b"".join(names), np.uint8)
        digits = [b"%d," % i for i in range(len(names))]
        self.digits = np.array([len(x) for x in digits], np.int64)
        self.digit_start, self.digit_flat = offsets(self.digits)[:-1], np.frombuffer(b"".join(digits), np.uint8)

    def spell(self, ids: np.ndarray) -> np.ndarray:
        return ragged(self.flat, self.start[ids], self.length[ids])


def merge_names(own: RankMerger) -> list[bytes]:
    """Byte strings of a byte-level vocabulary, built up from its merges."""
    names = {int(i): bytes([b]) for b, i in enumerate(own.single)}
    for a, b, c in zip(own.left.tolist(), own.right.tolist(), own.made.tolist()):
        names[c] = names[a] + names[b]
    return [names.get(i, b"") for i in range(max(names) + 1)]


def piece_names(library) -> list[bytes]:
    """Byte strings of a SentencePiece vocabulary: word marks are spaces, <0xHH> is that byte."""
    return [bytes([int(x[3:5], 16)]) if library.is_byte(i) else x.replace(MARK, " ").encode()
            for i, x in ((i, library.id_to_piece(i)) for i in range(library.vocab_size()))]


class Aligner:
    """Both vocabularies with their piece caches."""

    def __init__(self, merges: bytes, pieces: bytes, pattern: str):
        own = RankMerger(merges, pattern)
        library = sentencepiece.SentencePieceProcessor(model_proto=pieces)
        self.a = PieceCache(ByteBpe.from_merges(own).encode)
        self.b = Library(library)
        self.name_a, self.name_b = Names(merge_names(own)), Names(piece_names(library))

    def ids(self, col: pa.Array):
        """Ids and row offsets of both sides; rows whose bytes differ have none."""
        some = pc.fill_null(pc.greater(pc.binary_length(col), 0), False)
        spaced = pc.if_else(some, pc.binary_join_element_wise(" ", pc.fill_null(col, ""), ""), "")
        data, off = text_bytes(spaced)
        sides = []
        wrong = np.zeros(len(col), bool)
        for cache, names, source in ((self.a, self.name_a, spaced), (self.b, self.name_b, col)):
            flat, at = cache.ids(source)
            ends = offsets(names.length[flat])
            size = ends[at[1:]] - ends[at[:-1]]
            wrong |= size != np.diff(off)
            if (size == np.diff(off)).all():
                differs = np.flatnonzero(names.spell(flat) != data)
                wrong[np.searchsorted(off, differs, "right") - 1] = True
            else:
                spelt = names.spell(flat).tobytes()
                for i in np.flatnonzero(size == np.diff(off)).tolist():
                    wrong[i] |= spelt[ends[at[i]]: ends[at[i + 1]]] != data[off[i]: off[i + 1]].tobytes()
            sides.append((flat, at))
        if wrong.any():
            for k, (flat, at) in enumerate(sides):
                size = np.where(wrong, 0, np.diff(at))
                sides[k] = ragged(flat, at[:-1], size), offsets(size)
        return sides


def shared_ends(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices, in two ascending lists of ends, of the ends that both hold."""
    index = np.full(max(a.max(initial=0), b.max(initial=0)) + 1, -1, np.int64)
    index[a] = np.arange(len(a))
    found = index[b]
    both = np.flatnonzero(found >= 0)
    return found[both], both


def written(a: np.ndarray, b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray, name_a: Names, name_b: Names) -> tuple[np.ndarray, np.ndarray]:
    """``a1,a2|b1;a3|b2,b3;`` of all groups as bytes, and where each group ends in them."""
    group_a, group_b = np.searchsorted(last_a, np.arange(len(a))), np.searchsorted(last_b, np.arange(len(b)))
    upto_a, upto_b = last_a + 1, last_b + 1
    before_b = np.concatenate([[0], upto_b])[group_a]      # tokens of b in the groups before that of each a
    place_a, place_b = np.arange(len(a)) + before_b, np.arange(len(b)) + upto_a[group_b]
    start, size = (np.empty(len(a) + len(b), np.int64) for _ in range(2))
    start[place_a], size[place_a] = name_a.digit_start[a], name_a.digits[a]
    start[place_b], size[place_b] = name_b.digit_start[b] + len(name_a.digit_flat), name_b.digits[b]
    out = ragged(np.concatenate([name_a.digit_flat, name_b.digit_flat]), start, size)
    end = np.cumsum(size)
    out[end[place_a[last_a]] - 1] = ord("|")
    out[end[place_b[last_b]] - 1] = ord(";")
    return out, end[place_b[last_b]]


def align(df: DataFrame, merges: str, pieces: str, pattern: str, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Add, for each whole text, ``n_a, n_b, n_groups, n_links``, ``groups string`` (ids of each group,
    ``a1,a2|b1;a3|b2,b3``), ``block`` and the block's number of each linked pair with its occurrences
    (``pair, times``); the first row of a block lists its pairs as ``a, b`` and how often each is linked."""
    sc = df.sparkSession
    shared = [broadcast_file(sc, p) for p in (merges, pieces)]

    def make():
        own = kept(("align", hash((shared[0].value, shared[1].value, pattern))), lambda: Aligner(shared[0].value, shared[1].value, pattern))
        blocks = count(TaskContext.get().partitionId() << 32)

        def step(b: pa.RecordBatch) -> list[pa.Array]:
            n = b.num_rows
            (a, at_a), (p, at_b) = own.ids(b.column(text))
            last_a, last_b = shared_ends(np.cumsum(own.name_a.length[a]), np.cumsum(own.name_b.length[p]))
            row = np.searchsorted(at_a, last_a, "right") - 1
            n_groups = np.bincount(row, minlength=n)
            at = offsets(n_groups)
            spelt, ends = written(a, p, last_a, last_b, own.name_a, own.name_b)
            cut = np.concatenate([[0], ends])[at]
            some = n_groups > 0
            stay = np.ones(len(spelt), bool)
            stay[cut[1:][some] - 1] = False  # no mark behind a text's last group
            out = offsets(np.diff(cut) - some)
            groups = pa.Array.from_buffers(pa.string(), n, [None, pa.py_buffer(out.astype(np.int32).tobytes()), pa.py_buffer(spelt[stay].tobytes())])
            size_b = len(own.name_b.length)
            pairs, number, often = np.unique(a[last_a].astype(np.int64) * size_b + p[last_b], return_inverse=True, return_counts=True)
            of_row, times = np.unique(row * max(len(pairs), 1) + number, return_counts=True)
            upto = offsets(np.bincount(of_row // max(len(pairs), 1), minlength=n)).astype(np.int32)
            first = pa.array(np.array([0] + [len(pairs)] * n, np.int32))
            lists = [pa.ListArray.from_arrays(pa.array(upto), pa.array(x.astype(np.int32))) for x in (of_row % max(len(pairs), 1), times)]
            lists += [pa.ListArray.from_arrays(first, pa.array(x.astype(t))) for x, t in ((pairs // size_b, np.int32), (pairs % size_b, np.int32), (often, np.int64))]
            return [pa.array(x) for x in (np.diff(at_a), np.diff(at_b), n_groups, n_groups)] + [groups, pa.array(np.full(n, next(blocks)))] + lists
        return step

    return add_columns(df, text, "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string, block bigint, pair array<int>, "
                       "times array<int>, a array<int>, b array<int>, often array<bigint>", make, carry, warm=True)


def pair_counts(aligned: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``block, pair, a, b, often`` of every block, and ``a, b, count, best`` of the corpus."""
    listed = (aligned.where(F.size("a") > 0).select("block", F.posexplode(F.arrays_zip("a", "b", "often")).alias("pair", "x"))
              .select("block", "pair", "x.a", "x.b", "x.often"))
    counts = materialize(listed.groupBy("a", "b").agg(F.sum("often").alias("count")), "counts")
    top = counts.groupBy("b").agg(F.max("count").alias("top"))
    return listed, counts.join(top, "b").select("a", "b", "count", (F.col("count") == F.col("top")).alias("best"))


def _summed(key, texts: pa.Table, pairs: pa.Table) -> pa.Table:
    texts = texts.combine_chunks()
    names = [c for c in texts.column_names if c not in ("block", "pair", "times")]
    count_of, best_of = np.zeros(len(pairs) + 1, np.int64), np.zeros(len(pairs) + 1, bool)
    number = np.asarray(pairs["pair"], np.int64)
    count_of[number], best_of[number] = np.asarray(pairs["count"], np.int64), np.asarray(pairs["best"], bool)
    length = np.asarray(pc.list_value_length(texts["pair"]), np.int64)
    off = offsets(length)
    pair, times = (np.asarray(pc.list_flatten(texts[c]), np.int64) for c in ("pair", "times"))
    total = lambda x: (lambda c: c[off[1:]] - c[off[:-1]])(np.concatenate([[0], np.cumsum(x)]))
    out = texts.select(names)
    return out.append_column("n_best", pa.array(total(times * best_of[pair]))).append_column("count_sum", pa.array(total(times * count_of[pair])))


def corpus_links(aligned: DataFrame) -> DataFrame:
    """``n_best`` and ``count_sum`` (long) beside the other columns of a written table from ``align``:
    links whose pair is linked most often, in the whole corpus, of all pairs with its SentencePiece
    id, and the sum over links of how often the corpus links their pair."""
    listed, counts = pair_counts(aligned)
    summed = listed.drop("often").join(counts, ["a", "b"]).select(F.col("block").alias("of"), "pair", "count", "best")
    texts = aligned.drop("a", "b", "often")
    schema = T.StructType([*texts.drop("block", "pair", "times").schema, T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType())])
    return texts.groupBy("block").cogroup(summed.groupBy("of")).applyInArrow(_summed, schema)


def alignment(df: DataFrame, merges: str, pieces: str, pattern: str, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Add ``n_a, n_b, n_groups, n_links`` (long), ``groups string`` and what ``corpus_links`` counts."""
    added = ["n_a", "n_b", "n_groups", "n_links", "groups", "n_best", "count_sum"]
    keep = [c for c in without(df, added) if carry is None or c in carry]
    work = numbered(df, keep, _text=text)
    return named(corpus_links(materialize(align(work, merges, pieces, pattern, "_text", without(work, ["_text"])), "aligned")), keep, added)
