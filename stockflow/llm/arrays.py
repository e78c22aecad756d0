"""Texts as numpy arrays: Arrow column plumbing, byte words, rolling hashes, ragged gathers.

All helpers work on one bounded chunk of rows at a time (``CHUNK_BYTES`` of text, or one single
longer text), so a task's memory does not follow the size of its partition.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHUNK_BYTES = 1 << 20
#: Rows that Spark hands to Python at once: whole texts are long, and 10,000 of them (the default)
#: would stand in memory three times, in Spark's buffer and on both sides of the pipe.
BATCH_ROWS = 1000
#: Largest value that a driver-side table may have to be broadcast by this package.
BROADCAST_BYTES = 64 << 20

_U = np.uint64
_POW = _U(0x9E3779B97F4A7C15 | 1)
_INV = _U(pow(int(_POW), -1, 1 << 64))
_BYTE = np.random.Generator(np.random.PCG64(20240229)).integers(1, 1 << 64, 256, dtype=np.uint64, endpoint=False)
_powers: dict[int, np.ndarray] = {}
_digests: dict[bytes, int] = {}

#: Space, tab, newline, vertical tab, form feed, carriage return: what separates words.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes (a bijection)."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> _U(30)
    h *= _U(0xBF58476D1CE4E5B9)
    h ^= h >> _U(27)
    h *= _U(0x94D049BB133111EB)
    h ^= h >> _U(31)
    return h


def _power(base: np.uint64, n: int) -> np.ndarray:
    """base ** 0 .. base ** n modulo 2 ** 64; kept while it is of ordinary size."""
    have = _powers.get(int(base))
    if have is None or len(have) <= n:
        size = max(n + 1, CHUNK_BYTES + 1)
        have = np.full(size, base, np.uint64)
        have[0] = 1
        np.cumprod(have, out=have)
        if size <= 4 * CHUNK_BYTES:
            _powers[int(base)] = have
    return have


class Spans:
    """Hashes of any spans of one byte array, by prefix sums of a polynomial hash: for features and
    candidates, where two different spans of one hash change no result."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE[data] * _power(_POW, n)[:n], out=self.sums[1:])

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        h = (self.sums[end] - self.sums[start]) * _power(_INV, len(self.sums))[start]
        return mix(h + (end - start).astype(np.uint64))


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and its row offsets (from 0); null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = pc.fill_null(col, "")
    large = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    if not len(col):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offs, data = col.buffers()
    off = np.frombuffer(offs, np.int64 if large else np.int32)[col.offset: col.offset + len(col) + 1].astype(np.int64)
    if data is None or off[-1] == off[0]:
        return np.zeros(0, np.uint8), off - off[0]
    return np.frombuffer(data, np.uint8)[off[0]: off[-1]], off - off[0]


def words(data: np.ndarray, off: np.ndarray, inside: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every word: a longest run, in one row, of bytes that are no SPACE
    (or, with ``inside``, bytes for which that table of 256 holds)."""
    solid = ~SPACE[data] if inside is None else inside[data]
    n = len(data)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z
    first = np.zeros(n + 1, bool)
    first[off] = True  # a row starts here
    start = solid.copy()
    start[1:] &= ~solid[:-1] | first[1:n]
    end = solid.copy()
    end[:-1] &= ~solid[1:] | first[1:n]
    s, e = np.flatnonzero(start), np.flatnonzero(end) + 1
    return s, e, np.searchsorted(off, s, "right") - 1


def span_codes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """A number for each span that only equal byte strings share (no hash), and the distinct strings.

    Spans are in order, not empty and do not overlap; numbers hold within this call."""
    inside = np.zeros(len(data) + 1, np.int8)
    inside[start] = 1
    inside[end] -= 1
    flat = data[np.cumsum(inside, dtype=np.int8)[:-1].astype(bool)]
    coded = binary_array(flat, offsets(end - start)).dictionary_encode()
    return np.asarray(coded.indices, np.int64), coded.dictionary


def digests(strings: list[bytes]) -> np.ndarray:
    """64 bits of a cryptographic hash of each string; those seen lately are kept in this worker."""
    if len(_digests) > 300_000:
        _digests.clear()
    for x in strings:
        if x not in _digests:
            _digests[x] = int.from_bytes(blake2b(x, digest_size=8).digest(), "little")
    return np.fromiter(map(_digests.__getitem__, strings), np.uint64, len(strings))


def span_digests(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """``digests`` of spans as ``span_codes`` takes them: the same in every task, and out of reach of
    whoever writes the text, as a polynomial hash modulo 2 ** 64 is not (Thue-Morse words)."""
    code, names = span_codes(data, start, end)
    return digests(names.to_pylist())[code] if len(code) else np.zeros(0, np.uint64)


def row_sums(values: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Sum of values[off[i]:off[i+1]] for every row i (0 for an empty one)."""
    c = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return c[off[1:]] - c[off[:-1]]


def ragged(flat: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """flat[start[i]:start[i]+length[i]] for every i, one after the other."""
    total = int(length.sum())
    if not total:
        return flat[:0]
    ends = np.cumsum(length)
    return flat[np.repeat(start - (ends - length), length) + np.arange(total)]


def offsets(length: np.ndarray) -> np.ndarray:
    out = np.zeros(len(length) + 1, np.int64)
    np.cumsum(length, out=out[1:])
    return out


def list_array(flat: np.ndarray, off: np.ndarray, kind: pa.DataType | None = None) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), pa.array(flat, kind))


def binary_array(flat: np.ndarray, off: np.ndarray) -> pa.Array:
    """A binary column out of concatenated bytes."""
    flat = np.ascontiguousarray(flat).view(np.uint8)
    return pa.Array.from_buffers(pa.binary(), len(off) - 1,
                                 [None, pa.py_buffer(off.astype(np.int32).tobytes()), pa.py_buffer(flat.tobytes())])


def chunks(batch: pa.RecordBatch, text: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows with about ``limit`` text bytes each."""
    if not batch.num_rows:
        return
    size = np.asarray(pc.fill_null(pc.binary_length(batch.column(text)), 0), np.int64) + 64
    group = (np.cumsum(size) - size) // limit
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        yield batch.slice(a, b - a)


def gathered(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Batches of short rows put together, up to about ``rows`` rows each."""
    have: list[pa.RecordBatch] = []
    for b in batches:
        have.append(b)
        if sum(x.num_rows for x in have) >= rows:
            yield pa.concat_batches(have)
            have = []
    if have:
        yield pa.concat_batches(have)


def without(df: DataFrame, names: list[str]) -> list[str]:
    """The columns of df whose names, ignoring case, are none of ``names``."""
    gone = {n.lower() for n in names}
    return [c for c in df.columns if c.lower() not in gone]


_caches: dict[tuple, object] = {}


def kept(key: tuple, make: Callable[[], object], most: int = 2):
    """The object of ``key`` in this Python worker, so that its next task finds a warm cache."""
    if key not in _caches:
        if len(_caches) >= most:
            _caches.clear()
        _caches[key] = make()
    return _caches[key]


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, with this session set to hand at most BATCH_ROWS rows to Python at once."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(df.sparkSession.conf.get(name)) <= BATCH_ROWS:
        df.sparkSession.conf.set(name, str(BATCH_ROWS))
    return df


def numbered(df: DataFrame, columns: list[str] | None = None, **own: str) -> DataFrame:
    """Columns renamed to _k0, _k1, ..., so that no name can clash with one used inside; ``own`` adds
    copies of columns under further names. ``named`` gives the names back."""
    keep = df.columns if columns is None else columns
    return df.select(*[F.col(f"`{c}`").alias(f"_k{i}") for i, c in enumerate(keep)], *[F.col(f"`{c}`").alias(k) for k, c in own.items()])


def named(df: DataFrame, columns: list[str], added: list[str] = ()) -> DataFrame:
    return df.select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(columns)], *added)


def add_columns(df: DataFrame, text: str, new: str, make: Callable[[], Callable[[pa.RecordBatch], list[pa.Array]]],
                carry: list[str] | None = None, warm: bool = False, also: list[str] = ()) -> DataFrame:
    """Append columns computed from whole texts in Arrow batches, chunk by chunk.

    ``new`` is a DDL schema of the added columns. ``make()`` runs once in each task and returns
    the function from a chunk to the added arrays. ``carry`` names the input columns to keep
    (default: all), ``also`` those that are read without being kept; an input column whose name clashes
    with an added one is replaced by it. ``warm``:
    the operator has caches of its own that its next task in the same worker may use (``kept``).
    """
    added = T.StructType.fromDDL(new)
    read = {text.lower(), *(c.lower() for c in also)}
    keep = [c for c in without(df, added.names) if carry is None or c in carry]
    schema = T.StructType([df.schema[c] for c in keep] + added.fields)
    source = df.select(*[f"`{c}`" for c in dict.fromkeys([*keep, *[c for c in df.columns if c.lower() in read]])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not warm:
            _caches.clear()  # what operators before have left in this worker
            _digests.clear()
        step = make()
        for whole in batches:
            for b in chunks(whole, text):
                yield pa.RecordBatch.from_arrays([b.column(c) for c in keep] + step(b), [*keep, *added.names])

    return small_batches(source).mapInArrow(run, schema)


def broadcast_file(spark: SparkSession, path: str):
    """Broadcast a vocabulary file's bytes, read on the driver; its size is checked."""
    with open(path, "rb") as f:
        data = f.read(BROADCAST_BYTES + 1)
    if len(data) > BROADCAST_BYTES:
        raise ValueError(f"{path} is larger than the {BROADCAST_BYTES} bytes that may be broadcast")
    return spark.sparkContext.broadcast(data)
