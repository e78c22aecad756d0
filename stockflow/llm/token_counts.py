"""Token counts by rank-synchronous array merging (operator 9).

Pre-tokens of a batch lie one after the other in ragged numpy arrays of symbol ids. In each round
every sequence finds the least rank among its adjacent pairs and merges all places of that pair at
once (of overlapping places, as in ``aaa``, the odd ones from the left); sequences without a pair
leave, and what they still hold is their count. Merging all places of a pair together equals one
by one from the left when a merge only makes pairs of higher rank than its own, which is checked
of the merge list; of a list that breaks the rule only the leftmost place is merged in each round.

Edge cases: a null or empty text has 0 tokens; special tokens written out in a text count as one
token each, as the library's default has it; a text of any length is counted whole; repeated rows are
counted alike; an empty table gives no rows; an input column named like an added one is replaced.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from stockflow.llm.arrays import add_columns, broadcast_file, kept, offsets, row_sums
from stockflow.llm.bpe import NONE, PairTable
from stockflow.llm.pieces import MatchCache, PieceCache


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class RankMerger:
    """Merges of a byte-level ``tokenizers`` JSON file."""

    def __init__(self, data: bytes, pattern: str):
        spec = json.loads(data)
        model, pre = spec["model"], spec["pre_tokenizer"]
        if model["type"] != "BPE" or spec["normalizer"] or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or not pre["use_regex"]:
            raise ValueError("a byte-level BPE without normalizer or prefix space is needed")
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in spec["added_tokens"]):
            raise ValueError("added tokens must match as they stand")
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        vocab, merges = model["vocab"], [tuple(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        self.single = np.array([vocab[c] for c in byte_alphabet()], np.int32)
        self.left, self.right = left, right = [np.array([vocab[m[k]] for m in merges], np.int64) for k in (0, 1)]
        self.pairs = PairTable(left, right, np.arange(len(merges), dtype=np.int32))
        self.made = np.array([vocab[a + b] for a, b in merges], np.int32)
        born = dict(zip(self.made.tolist(), range(len(merges))))
        self.ordered = all(born.get(x, -1) < r and born.get(y, -1) < r for r, (x, y) in enumerate(zip(left.tolist(), right.tolist())))
        self.matches = MatchCache(regex.compile(pattern).findall, lambda parts: (self.survivors(parts).astype(np.int32), np.arange(len(parts) + 1)))

    def survivors(self, parts: list[bytes]) -> np.ndarray:
        """How many symbols each byte string keeps when nothing merges any more."""
        size = np.array([len(p) for p in parts], np.int64)
        out = size.copy()
        sym = self.single[np.frombuffer(b"".join(parts), np.uint8)]
        alive = np.flatnonzero(size > 0)
        size = size[alive]
        while len(alive):
            start = offsets(size)[:-1]
            rank = np.full(len(sym), NONE, np.int32)
            rank[:-1] = self.pairs(sym[:-1], sym[1:])
            rank[start[1:] - 1] = NONE  # the last symbol of a sequence has no right neighbour
            least = np.minimum.reduceat(rank, start)
            if (ended := least == NONE).any():
                out[alive[ended]] = size[ended]
                stay = np.repeat(~ended, size)
                sym, rank, alive, size, least = sym[stay], rank[stay], alive[~ended], size[~ended], least[~ended]
                if not len(alive):
                    break
            at = np.flatnonzero(rank == np.repeat(least, size))
            row = np.searchsorted(offsets(size), at, "right") - 1
            if self.ordered:  # of runs of overlapping places every second one
                begins = np.ones(len(at), bool)
                begins[1:] = np.diff(at) > 1
                run = np.maximum.accumulate(np.where(begins, np.arange(len(at)), 0))
                same = sym[at] == sym[at + 1]
                at_ok = ~same | ((np.arange(len(at)) - run) % 2 == 0)
            else:
                at_ok = np.ones(len(at), bool)
                at_ok[1:] = np.diff(row) > 0
            at, row = at[at_ok], row[at_ok]
            sym[at] = self.made[rank[at]]
            stay = np.ones(len(sym), bool)
            stay[at + 1] = False
            sym = sym[stay]
            size = size - np.bincount(row, minlength=len(size))
        return out

    def count(self, strings: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Token count of each string, as a ragged array of one number for each."""
        each, off = self.matches(strings)
        upto = np.concatenate([[0], np.cumsum(each, dtype=np.int64)])
        return (upto[off[1:]] - upto[off[:-1]]).astype(np.int32), np.arange(len(strings) + 1, dtype=np.int64)


def merger(shared, pattern: str) -> RankMerger:
    return RankMerger(shared.value, pattern)


def count_tokens(df: DataFrame, path: str, pattern: str, text: str = "text", n_tokens: str = "n_tokens",
                 carry: list[str] | None = None) -> DataFrame:
    """Add ``n_tokens long``: tokens of every whole text by the vocabulary file ``path``."""
    shared = broadcast_file(df.sparkSession, path)

    def make():
        def fresh() -> PieceCache:
            own = merger(shared, pattern)
            return PieceCache(own.count, 300_000, dict.fromkeys(own.special, 1))

        cache = kept(("counts", hash((shared.value, pattern))), fresh)

        def step(b: pa.RecordBatch) -> list[pa.Array]:
            return [pa.array(row_sums(*cache.ids(b.column(text))))]
        return step

    return add_columns(df, text, f"`{n_tokens}` bigint", make, carry, warm=True)


