"""Byte-level BPE encoding and decoding with numpy matrices (operator 2).

``encode`` adds the token ids of every whole text, equal to what the rank file's own library gives:
each match of the splitting pattern is merged alone. Matches are bucketed by byte length into
padded matrices; in each round every row merges its leftmost pair of least rank, found through an
open-addressing hash table of pairs, then the row is compacted (so the whole matrix narrows by one
column) and finished rows leave. Matches beyond ``HEAP_BYTES`` merge one by one from a heap of
pairs instead, as a matrix row that long would take quadratic work; the order of merges is the same.

Edge cases: a null or empty text has no ids (an empty array); a text of any length is encoded whole;
of pairs with equal rank the leftmost merges first; repeated rows are encoded alike; an empty table
gives no rows; an input column named like an added one is replaced.
"""

from __future__ import annotations

import base64
import heapq
from typing import TYPE_CHECKING

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from stockflow.llm.arrays import add_columns, binary_array, broadcast_file, kept, list_array, offsets, ragged, small_batches
from stockflow.llm.pieces import MatchCache, PieceCache

if TYPE_CHECKING:
    from stockflow.llm.token_counts import RankMerger

NONE = np.int32(0x7FFFFFFF)
HEAP_BYTES = 512
BUCKETS = (2, 3, 4, 6, 8, 12, 16, 24, 32, 64, 128, 256, HEAP_BYTES)


class PairTable:
    """Hash table (left id, right id) -> value of the merge, with linear probing in numpy."""

    def __init__(self, left: np.ndarray, right: np.ndarray, value: np.ndarray):
        self.bits = max(8, int(2 * len(left) + 1).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, NONE, np.int32)
        key = (left.astype(np.int64) << 32) | right
        slot, todo = self._slot(key), np.arange(len(key))
        while len(todo):
            free = todo[self.keys[slot[todo]] == -1]
            _, one = np.unique(slot[free], return_index=True)
            won = free[one]
            self.keys[slot[won]], self.values[slot[won]] = key[won], value[won]
            todo = todo[self.keys[slot[todo]] != key[todo]]
            slot[todo] = (slot[todo] + 1) & ((1 << self.bits) - 1)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Values of pairs (any shape); NONE where the pair does not merge or an id is negative."""
        shape = left.shape
        key = ((left.astype(np.int64) << 32) | right.astype(np.int64)).ravel()
        key[((left < 0) | (right < 0)).ravel()] = -2
        slot = self._slot(key)
        found = self.keys[slot]
        out = np.where(found == key, self.values[slot], NONE)
        todo = np.flatnonzero((found != key) & (found != -1) & (key != -2))
        while len(todo):
            slot[todo] = (slot[todo] + 1) & ((1 << self.bits) - 1)
            found = self.keys[slot[todo]]
            hit = found == key[todo]
            out[todo[hit]] = self.values[slot[todo[hit]]]
            todo = todo[~hit & (found != -1)]
        return out.reshape(shape)


class ByteBpe:
    """Ranks of byte strings, as a tiktoken file lists them; an id is its rank."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = self.whole = ranks
        self.matches = MatchCache(regex.compile(pattern).findall, self.merge)
        self.single = np.array([ranks[bytes([i])] for i in range(256)], np.int32)
        left, right, value = [], [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    value.append(rank)
        self.pairs = PairTable(np.array(left, np.int64), np.array(right, np.int64), np.array(value, np.int32))
        self._name(ranks)

    def _name(self, ranks: dict[bytes, int]) -> None:
        names = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            names[rank] = token
        self.token_off = offsets(np.array([len(x) for x in names]))
        self.token_bytes = np.frombuffer(b"".join(names), np.uint8)

    def _joined(self, a: int, b: int) -> int | None:
        """The id that two ids merge into, if they do."""
        name = lambda i: self.token_bytes[self.token_off[i]: self.token_off[i + 1]].tobytes()
        return self.ranks.get(name(a) + name(b))

    @classmethod
    def from_file(cls, data: bytes, pattern: str) -> ByteBpe:
        return cls({base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines()) if a}, pattern)

    @classmethod
    def from_merges(cls, own: RankMerger) -> ByteBpe:
        """The same encoder for a merge list whose ids grow with the ranks: only listed pairs merge,
        and a match that is itself in the vocabulary is built up like any other."""
        if (np.diff(own.made) <= 0).any():
            raise ValueError("ids must grow with the ranks of their merges")
        new = cls.__new__(cls)
        new.whole, new.single, new.ranks = {}, own.single, {}
        new.pairs = PairTable(own.left, own.right, own.made)
        new._pairs = dict(zip(zip(own.left.tolist(), own.right.tolist()), own.made.tolist()))
        new._joined = lambda a, b: new._pairs.get((a, b))
        new.matches = MatchCache(own.matches.find, new.merge)
        return new

    def encode(self, strings: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of strings, each split by the pattern: (flat, offsets)."""
        return self.matches(strings)

    def merge(self, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of byte strings that the pattern does not split further: (flat, offsets)."""
        size = np.array([len(p) for p in parts], np.int64)
        known = np.fromiter((self.whole.get(p, -1) for p in parts), np.int64, len(parts))
        done: list[tuple[np.ndarray, np.ndarray]] = [(np.flatnonzero(known >= 0), known[known >= 0][:, None].astype(np.int32))]
        data, off = np.frombuffer(b"".join(parts), np.uint8), offsets(size)
        least = 0
        for most in BUCKETS:
            rows = np.flatnonzero((known < 0) & (size > least) & (size <= most))
            for k in range(0, len(rows), 1 << 15):
                done += self._rounds(rows[k: k + (1 << 15)], data, off, most)
            least = most
        for i in np.flatnonzero((known < 0) & (size > HEAP_BYTES)).tolist():
            done.append((np.array([i]), self._heap(parts[i])[None, :]))
        count = np.zeros(len(parts), np.int64)
        for rows, m in done:
            count[rows] = (m >= 0).sum(1)
        out_off = offsets(count)
        flat = np.zeros(out_off[-1], np.int32)
        for rows, m in done:
            full = m >= 0
            flat[(out_off[rows][:, None] + np.arange(m.shape[1]))[full]] = m[full]
        return flat, out_off

    def _rounds(self, rows: np.ndarray, data: np.ndarray, off: np.ndarray, width: int):
        """Merge the rows of one length bucket; yields (rows, ids padded with -1) as rows finish."""
        size = off[rows + 1] - off[rows]
        at = off[rows][:, None] + np.arange(width)
        inside = np.arange(width) < size[:, None]
        ids = np.where(inside, self.single[data[np.where(inside, at, 0)]], np.int32(-1))
        rank = self.pairs(ids[:, :-1], ids[:, 1:])
        while len(rows):
            if not rank.shape[1]:
                yield rows, ids
                return
            here = np.arange(len(rows))
            j = rank.argmin(1)
            best = rank[here, j]
            if (ended := best == NONE).any():
                yield rows[ended], ids[ended]
                rows, ids, rank, j, best = rows[~ended], ids[~ended], rank[~ended], j[~ended], best[~ended]
                here = np.arange(len(rows))
                if not len(rows):
                    return
            # compaction: what stands right of the merged pair moves one column to the left
            moved = np.arange(ids.shape[1] - 1) > j[:, None]
            ids = np.where(moved, ids[:, 1:], ids[:, :-1])
            ids[here, j] = best
            rank = np.where(moved[:, :-1], rank[:, 1:], rank[:, :-1])
            left, right = j > 0, j < rank.shape[1]
            rank[here[left], j[left] - 1] = self.pairs(ids[here[left], j[left] - 1], best[left])
            rank[here[right], j[right]] = self.pairs(best[right], ids[here[right], j[right] + 1])

    def _heap(self, part: bytes) -> np.ndarray:
        ids = self.single[np.frombuffer(part, np.uint8)].tolist()
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        first = self.pairs(np.array(ids[:-1], np.int32), np.array(ids[1:], np.int32)).tolist()
        heap = [(r, i, ids[i], ids[i + 1]) for i, r in enumerate(first) if r != NONE]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            if ids[i] != a or after[i] >= n or ids[after[i]] != b:
                continue  # one of the two has merged meanwhile
            gone = after[i]
            ids[i], ids[gone] = r, -1
            after[i] = after[gone]
            if after[i] < n:
                before[after[i]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y < n and (rank := self._joined(ids[x], ids[y])) is not None:
                    heapq.heappush(heap, (rank, x, ids[x], ids[y]))
        return np.array([x for x in ids if x >= 0], np.int32)

    def decode(self, flat: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of ragged ids: (flat bytes, offsets)."""
        length = np.diff(self.token_off)[flat]
        return ragged(self.token_bytes, self.token_off[flat], length), offsets(length)[off]


def model(shared, pattern: str) -> ByteBpe:
    """The tables of a broadcast rank file, built once in each Python worker."""
    return kept(("ranks", hash((shared.value, pattern))), lambda: ByteBpe.from_file(shared.value, pattern), 3)


def encode(df: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids",
           carry: list[str] | None = None) -> DataFrame:
    """Add ``ids array<int>``: the BPE ids of every whole text by the ranks of the file ``path``."""
    shared = broadcast_file(df.sparkSession, path)

    def make():
        cache = kept(("bpe", hash((shared.value, pattern))), lambda: PieceCache(model(shared, pattern).encode))

        def step(b: pa.RecordBatch) -> list[pa.Array]:
            return [list_array(*cache.ids(b.column(text)), pa.int32())]
        return step

    return add_columns(df, text, f"`{ids}` array<int>", make, carry, warm=True)


def decode(df: DataFrame, path: str, pattern: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Add ``decoded binary``: the bytes that the ids stand for (null ids: no bytes)."""
    shared = broadcast_file(df.sparkSession, path)
    keep = [c for c in df.columns if c.lower() != out.lower()]
    schema = df.select(*[f"`{c}`" for c in keep]).schema.add(out, "binary")

    def run(batches):
        own = model(shared, pattern)
        for whole in batches:
            for k in range(0, whole.num_rows, 256):
                b = whole.slice(k, 256)
                col = b.column(ids)
                flat = np.asarray(col.flatten(), np.int64)
                off = offsets(np.asarray(pa.compute.fill_null(pa.compute.list_value_length(col), 0), np.int64))
                done = binary_array(*own.decode(flat, off))
                yield pa.RecordBatch.from_arrays([b.column(c) for c in keep] + [done], [*keep, out])

    return small_batches(df.select(*[f"`{c}`" for c in keep])).mapInArrow(run, schema)
