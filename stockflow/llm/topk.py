"""Exact top-k inner products over a bit-sliced index (operator 10).

Components are quantised to integers, shifted to be non-negative, and every bit of every component
becomes one bitmap over the rows of a block. For a query, each set bit of a weight adds a component's
bitmaps, shifted, to the score: bitmaps of one significance are summed by carry-save adders (five
bitwise operations take three bitmaps to two), so the scores of all rows appear as bit slices
without any row being looked at. Negative weights use the complement bitmaps; the shifts only add a
constant for each query. The best k rows are then selected from the most significant slice downward:
rows with a one at a slice stay as long as at least k remain, and the rows that tie at the last place
are resolved by smaller id. Rows of a block are in order of id, and a block has at most
``block_rows`` of them (when ids hash evenly); scores are exact integers throughout.

Edge cases: vectors that are null or hold a null or non-finite component take no part; of vectors of
another length than the query's none is scored against it; a row never meets its own id; rows that
repeat an id are candidates one by one, and queries that repeat an id with other vectors share one
list, the best of them all; with fewer than k others all are returned; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

U64 = np.uint64
LARGEST = float(1 << 26)  # products of 1,024 components each stay within 62 bits


class BitIndex:
    """Bit slices of one block of integer vectors [rows, dims]."""

    def __init__(self, vectors: np.ndarray):
        self.rows, self.dims = vectors.shape
        self.low = vectors.min(0) if self.rows else np.zeros(self.dims, np.int64)
        high = vectors.max(0) if self.rows else self.low
        self.bits = [int(x).bit_length() for x in (high - self.low)]
        self.words = -(-self.rows // 64)
        shifted = vectors - self.low
        self.slices = [[self._pack((shifted[:, d] >> b) & 1) for b in range(self.bits[d])] for d in range(self.dims)]
        full = np.zeros(self.words * 64, np.uint8)
        full[: self.rows] = 1
        self.all = self._pack(full)

    def _pack(self, bit: np.ndarray) -> np.ndarray:
        out = np.zeros(self.words * 64, np.uint8)
        out[: len(bit)] = bit
        return np.packbits(out, bitorder="little").view(U64)

    def scores(self, query: np.ndarray) -> tuple[list[np.ndarray], int]:
        """Bit slices, least significant first, of every row's score less the returned constant."""
        constant = 0
        piles: list[list[np.ndarray]] = []
        for d, w in enumerate(query.tolist()):
            constant += w * int(self.low[d])
            if not w or not self.bits[d]:
                continue
            planes = self.slices[d]
            if w < 0:  # w * x = |w| * (top - x) - |w| * top, and top - x has the complement bits
                constant += w * ((1 << self.bits[d]) - 1)
                planes = [~p for p in planes]
                w = -w
            for j in range(w.bit_length()):
                if w >> j & 1:
                    while len(piles) < j + len(planes):
                        piles.append([])
                    for b, p in enumerate(planes):
                        piles[j + b].append(p)
        out, k = [], 0
        while k < len(piles):
            pile = piles[k]
            if len(pile) > 1 and k + 1 == len(piles):
                piles.append([])
            while len(pile) > 2:  # full adders, as many side by side as there are threes
                m = len(pile) // 3
                a, b, c = (np.stack(pile[i * m: (i + 1) * m]) for i in range(3))
                half = a ^ b
                piles[k + 1].extend((a & b) | (half & c))
                pile = [*(half ^ c), *pile[3 * m:]]
            if len(pile) == 2:
                piles[k + 1].append(pile[0] & pile[1])
                pile = [pile[0] ^ pile[1]]
            out.append(pile[0] if pile else np.zeros(self.words, U64))
            k += 1
        return out, constant

    def best(self, slices: list[np.ndarray], k: int, among: np.ndarray) -> np.ndarray:
        """Rows of the k highest scores among a bitmap of rows; at the last place the first rows."""
        sure, open_ = np.zeros(self.words, U64), among.copy()
        have, left = 0, int(np.bitwise_count(open_).sum())
        if left > k:
            for s in reversed(slices):
                ones = open_ & s
                n = int(np.bitwise_count(ones).sum())
                if have + n > k:
                    open_, left = ones, n
                elif n:
                    sure, have = sure | ones, have + n
                    open_, left = open_ & ~s, left - n
                    if have == k:
                        open_[:] = 0
                        break
        rows = np.flatnonzero(np.unpackbits(open_.view(np.uint8), bitorder="little"))[: k - have]
        return np.sort(np.concatenate([np.flatnonzero(np.unpackbits(sure.view(np.uint8), bitorder="little")), rows]))

    def read(self, slices: list[np.ndarray], rows: np.ndarray) -> np.ndarray:
        """The scores of some rows out of the slices."""
        out = np.zeros(len(rows), np.int64)
        for j, s in enumerate(slices):
            out += ((s[rows >> 6] >> (rows & 63).astype(U64)) & U64(1)).astype(np.int64) << j
        return out


def quantise(df: DataFrame, vector: str, scale: int) -> DataFrame:
    """Replace the vector by the integers floor(scale * x); rows that take no part leave. An integer
    beyond ``LARGEST`` fails the job, as scores of such vectors may leave 64 bits."""
    v = F.col(vector)
    ok = v.isNotNull() & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))

    def whole(x):
        y = F.floor(F.lit(float(scale)) * x.cast("double"))
        return F.when(F.abs(F.lit(float(scale)) * x.cast("double")) < LARGEST, y).otherwise(F.raise_error(F.lit(f"a component beyond {LARGEST}")).cast("bigint")).cast("bigint")

    return df.where(ok).withColumn(vector, F.transform(v, whole))


def top_k(base: DataFrame, queries: DataFrame, k: int, vec_id: str = "vec_id", vector: str = "vector",
          block_rows: int = 16384, query_rows: int = 16384) -> DataFrame:
    """For each query the k highest inner products with integer vectors of ``base``.

    Returns ``query_id, rank, vec_id, score``. Base rows and queries are dealt into blocks by a hash
    of the id; each pair of a base block and a query block is one group, whose size is bounded. A base
    row is sent, and its slices are made, once for each query block, so query blocks are as large as
    the base's, unless that gives too few groups to keep all cores busy.
    """
    spark = base.sparkSession
    n_queries = queries.count()
    n_base = max(1, -(-base.count() // block_rows))
    busy = -(-3 * spark.sparkContext.defaultParallelism // n_base)
    n_query = max(1, -(-n_queries // query_rows), min(busy, -(-n_queries // 128)))
    at = lambda n: F.pmod(F.xxhash64(F.col(vec_id).cast("string")), F.lit(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    pick = [F.col(vec_id).cast("bigint").alias("id"), F.col(vector).alias("v")]
    left = base.where(F.col(vec_id).isNotNull()).select(*pick, at(n_base).alias("b"), each(n_query).alias("q"))
    right = queries.where(F.col(vec_id).isNotNull()).select(*pick, at(n_query).alias("q"), each(n_base).alias("b")).dropDuplicates(["id", "v", "b"])

    def vectors(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        table = table.combine_chunks()
        col = table["v"].combine_chunks() if table.num_rows else pa.array([], pa.list_(pa.int64()))
        return np.asarray(table["id"], np.int64), np.asarray(col.flatten(), np.int64), np.asarray(pa.compute.list_value_length(col), np.int64)

    def search(_, rows, asked):
        out: dict[str, list[np.ndarray]] = {"query_id": [], "vec_id": [], "score": []}
        ids, flat, size = vectors(rows)
        q_ids, q_flat, q_size = vectors(asked)
        for dims in np.unique(q_size).tolist():
            own = np.flatnonzero(size == dims)
            own = own[np.argsort(ids[own], kind="stable")]
            mine = flat[np.repeat(size == dims, size)].reshape(-1, dims)[np.argsort(ids[size == dims], kind="stable")] if dims else np.zeros((len(own), 0), np.int64)
            if not len(own):
                continue
            index, names = BitIndex(mine), ids[own]
            asked_now = q_flat[np.repeat(q_size == dims, q_size)].reshape(-1, dims) if dims else np.zeros(((q_size == 0).sum(), 0), np.int64)
            for q, w in zip(q_ids[q_size == dims].tolist(), asked_now):
                slices, constant = index.scores(w)
                among = index.all.copy()
                for r in range(*np.searchsorted(names, [q, q + 1]).tolist()):
                    among[r >> 6] &= ~(U64(1) << U64(r & 63))
                best = index.best(slices, k, among)
                out["query_id"].append(np.full(len(best), q))
                out["vec_id"].append(names[best])
                out["score"].append(index.read(slices, best) + constant)
        return pa.table({c: pa.array(np.concatenate(v) if v else np.zeros(0, np.int64), pa.int64()) for c, v in out.items()})

    # groups cost CPU, not bytes: an explicit number of partitions, which AQE does not merge
    n = min(n_base * n_query, max(2000, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    found = (left.repartition(n, "b", "q").groupBy("b", "q").cogroup(right.repartition(n, "b", "q").groupBy("b", "q"))
             .applyInArrow(search, "query_id bigint, vec_id bigint, score bigint"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
