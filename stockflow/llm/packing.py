"""Best-fit packing of documents into sequences by a grouping genetic algorithm (operator 8).

``pieces`` encodes whole texts and cuts only what is longer than a sequence. ``pack`` deals the
pieces that do not fill a sequence into blocks of bounded size. Each block is solved by several
islands: a population of packings starts from best-fit in decreasing order, with noise. Crossover
injects the well-filled bins of one parent whole into the other, removes the other's bins that hold
a duplicate, and best-fits the displaced pieces, largest first; mutation dissolves a few of the
emptiest bins. After each epoch every island sends its elite to the next one of its block, through a
shuffle by Spark. The bins of a block's best packing that stayed clearly below the capacity are
dissolved and packed once more together with those of other blocks, until one block is left.

Edge cases: a null or empty text is a piece of its end id only; equal lengths are told apart by the
row; repeated rows are packed one by one; an empty table gives no rows; a piece that is exactly one
sequence long is its own sequence. Input columns named like added ones are replaced.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockflow.llm.arrays import binary_array, broadcast_file, chunks, kept, offsets, small_batches, without
from stockflow.llm.bpe import ByteBpe
from stockflow.llm.pieces import PieceCache
from stockflow.llm.token_counts import merger
from stockflow.session import materialize


@dataclass(frozen=True)
class Settings:
    block: int = 4096       # pieces that one island packs
    islands: int = 3
    population: int = 4
    epochs: int = 2
    crossovers: int = 10    # in an island and epoch
    inject: float = 0.3     # share of the other parent's bins that may come over
    dissolve: int = 3       # emptiest bins that a mutation takes apart
    well_filled: float = 0.995
    repacks: int = 3


# -- cutting --------------------------------------------------------------------------------------

def pieces(df: DataFrame, path: str, pattern: str, capacity: int, end_id: int = 0, text: str = "text",
           carry: list[str] | None = None) -> DataFrame:
    """One row for each piece: ``piece int, start long, length long, ids binary`` (unsigned 32-bit,
    little-endian). Ids are equal to those of the ``tokenizers`` library, then the end id. A text longer than
    ``capacity`` has full pieces behind a first one that may be shorter."""
    shared = broadcast_file(df.sparkSession, path)
    added = T.StructType.fromDDL("piece int, start bigint, length bigint, ids binary")
    keep = [c for c in without(df, added.names) if carry is None or c in carry]
    schema = T.StructType([df.schema[c] for c in keep] + added.fields)

    def run(batches):
        def fresh() -> PieceCache:
            own = merger(shared, pattern)
            return PieceCache(ByteBpe.from_merges(own).encode, 300_000, own.special)

        cache = kept(("pieces", hash((shared.value, pattern))), fresh)
        for whole in batches:
            for b in chunks(whole, text):
                flat, off = cache.ids(b.column(text))
                size = np.diff(off) + 1
                ids = np.insert(flat.astype(np.uint32), off[1:], end_id)
                n = -(-size // capacity)
                row = np.repeat(np.arange(len(size)), n)
                k = np.arange(n.sum()) - (np.cumsum(n) - n)[row]
                head = size - (n - 1) * capacity
                start = np.where(k == 0, 0, head[row] + (k - 1) * capacity)
                length = np.where(k == 0, head[row], capacity)
                take = b.select(keep).take(pa.array(row)) if keep else None
                cut = offsets(length) * 4  # pieces of a text lie one after the other
                yield pa.RecordBatch.from_arrays([*(take.columns if take else []), pa.array(k.astype(np.int32)), pa.array(start), pa.array(length), binary_array(ids, cut)], [*keep, *added.names])

    return small_batches(df.select(*[f"`{c}`" for c in dict.fromkeys([*keep, text])])).mapInArrow(run, schema)


# -- the genetic algorithm on one block -----------------------------------------------------------

def best_fit(free: list[tuple[int, int]], items: list[int], length: np.ndarray, capacity: int, bins: np.ndarray, fresh: int) -> int:
    """Put items, in the given order, into the open bin with the least room that suffices.

    ``free`` is the sorted list of (room, bin); ``bins`` gets each item's bin. Returns the next
    unused bin number.
    """
    for i in items:
        size = int(length[i])
        at = bisect_left(free, (size, -1))
        if at == len(free):
            room, b = capacity, fresh
            fresh += 1
        else:
            room, b = free.pop(at)
        bins[i] = b
        if room > size:
            insort(free, (room - size, b))
    return fresh


def compact(bins: np.ndarray) -> np.ndarray:
    return np.unique(bins, return_inverse=True)[1].astype(np.int32)


def fitness(bins: np.ndarray, length: np.ndarray, capacity: int) -> float:
    """Fewer bins first; among equals, the mean squared fill, which rewards full bins."""
    fill = np.bincount(bins, length) / capacity
    return -len(fill) + float((fill ** 2).mean()) if len(fill) else 0.0


def _refill(bins: np.ndarray, length: np.ndarray, capacity: int) -> np.ndarray:
    """Best-fit all items whose bin is -1 (items are in decreasing length)."""
    kept = bins >= 0
    out = bins.copy()
    n = int(out.max()) + 1 if kept.any() else 0
    room = capacity - np.bincount(out[kept], length[kept], n).astype(int) if n else np.zeros(0, int)
    free = sorted((r, b) for b, r in enumerate(room.tolist()) if r > 0)
    best_fit(free, np.flatnonzero(~kept).tolist(), length, capacity, out, n)
    return compact(out)


def crossover(a: np.ndarray, b: np.ndarray, length: np.ndarray, capacity: int, rng: np.random.Generator, inject: float) -> np.ndarray:
    """Child of a with well-filled bins of b injected whole."""
    fill = np.bincount(b, length) / capacity
    order = np.argsort(-fill - 0.02 * rng.random(len(fill)))
    chosen = np.zeros(len(fill), bool)
    chosen[order[: max(1, int(inject * len(fill) * rng.random()))]] = True
    moved = chosen[b]
    hit = np.zeros(int(a.max()) + 1, bool)
    hit[a[moved]] = True  # bins of a that hold a duplicate go
    child = np.where(hit[a], -1, a)
    child[moved] = len(hit) + b[moved]
    full = child >= 0
    child[full] = compact(child[full])
    return _refill(child, length, capacity)


def mutate(a: np.ndarray, length: np.ndarray, capacity: int, rng: np.random.Generator, dissolve: int) -> np.ndarray:
    """Dissolve the emptiest bins and a few random ones, and best-fit their items."""
    fill = np.bincount(a, length)
    gone = np.zeros(len(fill), bool)
    gone[np.argsort(fill)[:dissolve]] = True
    gone[rng.integers(0, len(fill), min(len(fill), 4 * dissolve))] = True
    child = np.where(gone[a], -1, a)
    kept = child >= 0
    child[kept] = compact(child[kept])
    return _refill(child, length, capacity)


def start(length: np.ndarray, capacity: int, rng: np.random.Generator, n: int) -> list[np.ndarray]:
    """Best-fit decreasing, and best-fit of slightly disturbed orders."""
    out = []
    for k in range(n):
        order = np.arange(len(length)) if not k else np.argsort(-length * (1 + 0.1 * k * rng.random(len(length))), kind="stable")
        bins = np.zeros(len(length), np.int32)
        best_fit([], order.tolist(), length, capacity, bins, 0)
        out.append(compact(bins))
    return out


def evolve(population: list[np.ndarray], length: np.ndarray, capacity: int, rng: np.random.Generator, s: Settings) -> list[np.ndarray]:
    bound = -(-int(length.sum()) // capacity)
    scored = sorted(((fitness(p, length, capacity), k, p) for k, p in enumerate(population)), key=lambda x: (-x[0], x[1]))
    serial = len(scored)
    for _ in range(s.crossovers):
        if int(scored[0][2].max()) + 1 <= bound:
            break  # no packing has fewer bins
        i, j = sorted(rng.integers(0, len(scored), 2).tolist())
        child = crossover(scored[i][2], scored[j][2], length, capacity, rng, s.inject) if i != j else scored[i][2]
        if i == j or rng.random() < 0.3:
            child = mutate(child, length, capacity, rng, s.dissolve)
        scored.append((fitness(child, length, capacity), serial, child))
        serial += 1
        scored = sorted(scored, key=lambda x: (-x[0], x[1]))[: s.population]
    return [p for *_, p in scored[: s.population]]


# -- islands in Spark -----------------------------------------------------------------------------

_STATE = "block int, island int, fitness double, length binary, bins binary"


def _rows(block: int, island: int, length: np.ndarray, population: list[np.ndarray], capacity: int) -> pa.Table:
    n = len(population)
    return pa.table({"block": pa.array([block] * n, pa.int32()), "island": pa.array([island] * n, pa.int32()),
                     "fitness": pa.array([fitness(p, length, capacity) for p in population], pa.float64()),
                     "length": pa.array([length.astype(np.int32).tobytes()] * n, pa.binary()),
                     "bins": pa.array([p.astype(np.int32).tobytes() for p in population], pa.binary())})


def _solve(items: DataFrame, capacity: int, s: Settings, salt: int) -> DataFrame:
    """``block, place, bin`` of the best packing of each block; items have ``block, place, length``."""
    def first(key, rows):
        block, island = (k.as_py() for k in key)
        order = np.argsort(np.asarray(rows["place"]))
        length = np.asarray(rows["length"], np.int64)[order]
        rng = np.random.default_rng([salt, block, island, 0])
        return _rows(block, island, length, evolve(start(length, capacity, rng, s.population), length, capacity, rng, s), capacity)

    def again(epoch: int):
        def run(key, rows):
            block, island = (k.as_py() for k in key)
            order = np.lexsort((np.array([x.as_py() for x in rows["bins"]], object), -np.asarray(rows["fitness"])))
            length = np.frombuffer(rows["length"][0].as_py(), np.int32).astype(np.int64)
            population = [np.frombuffer(rows["bins"][int(k)].as_py(), np.int32) for k in order]
            return _rows(block, island, length, evolve(population, length, capacity, np.random.default_rng([salt, block, island, epoch]), s), capacity)
        return run

    state = (items.select("block", "place", "length", F.explode(F.sequence(F.lit(0), F.lit(s.islands - 1))).alias("island"))
             .groupBy("block", "island").applyInArrow(first, _STATE))
    for epoch in range(1, s.epochs):
        state = materialize(state, "islands")
        best = Window.partitionBy("block", "island").orderBy(F.desc("fitness"), "bins")
        elite = (state.withColumn("_r", F.row_number().over(best)).where("_r = 1").drop("_r")
                 .withColumn("island", F.pmod(F.col("island") + 1, F.lit(s.islands)).cast("int")))
        state = state.unionByName(elite).groupBy("block", "island").applyInArrow(again(epoch), _STATE)

    def spread(batches):
        for b in batches:
            for block, bins in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                own = np.frombuffer(bins, np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), block, np.int32)), pa.array(np.arange(len(own), dtype=np.int32)), pa.array(own)], ["block", "place", "bin"])

    top = state.groupBy("block").agg(F.max(F.struct("fitness", "bins")).alias("top")).select("block", F.col("top.bins").alias("bins"))
    return top.mapInArrow(spread, "block int, place int, bin int")


def pack(items: DataFrame, capacity: int, s: Settings = Settings(), length: str = "length") -> DataFrame:
    """Add ``sequence_id long`` and ``offset long`` to a *written* table with a unique long ``row``.

    Lengths run from 1 to ``capacity``; a sequence's lengths sum up to ``capacity`` at most.
    """
    items = items.select(*[f"`{c}`" for c in without(items, ["sequence_id", "offset"])])
    full = items.where(F.col(length) == capacity).select("row", (-F.col("row") - 1).alias("sequence_id"), F.col(length).alias("_length"))
    rest = items.where(F.col(length) < capacity).select("row", F.col(length).alias("length"))
    done, base = [full], 0
    for k in range(s.repacks + 1):
        n = rest.count()
        if not n:
            break
        blocks = -(-n // s.block)
        place = Window.partitionBy("block").orderBy(F.desc("length"), "row")
        dealt = materialize(rest.withColumn("block", F.pmod(F.xxhash64("row", F.lit(k)), F.lit(blocks)).cast("int"))
                            .withColumn("place", F.row_number().over(place) - 1), "blocks")
        placed = materialize(dealt.join(_solve(dealt, capacity, s, k), ["block", "place"])
                             .withColumn("sequence_id", F.lit(base) + F.col("block").cast("bigint") * (1 << 20) + F.col("bin"))
                             .withColumn("_fill", F.sum("length").over(Window.partitionBy("sequence_id"))), "packed")
        last = blocks == 1 or k == s.repacks
        good = placed if last else placed.where(F.col("_fill") >= int(s.well_filled * capacity))
        done.append(good.select("row", "sequence_id", F.col("length").alias("_length")))
        if last:
            break
        rest = placed.where(F.col("_fill") < int(s.well_filled * capacity)).select("row", "length")
        base += blocks << 20
    every = done[0]
    for d in done[1:]:
        every = every.unionByName(d)
    before = Window.partitionBy("sequence_id").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    every = every.withColumn("offset", F.coalesce(F.sum("_length").over(before), F.lit(0)).cast("bigint")).drop("_length")
    return items.join(every, "row")
