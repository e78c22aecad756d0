"""Near-duplicate groups by HyperMinHash, confirmed on full shingle sets (operator 6).

1. ``signatures``: the distinct five-word shingles of each whole text give its set id (equal sets
   have equal ids) and compressed registers. Equal sets collapse to one node, so exact copies cost
   nothing further, however many there are.
2. Bands of registers that agree make nodes meet. Of each meeting one node is the hub, and every
   other node is a candidate pair with it - one row for each member, never all pairs.
3. Collision-corrected Jaccard estimates from the registers drop pairs that are 4.5 standard errors
   below the threshold; the rest is confirmed by intersecting full sets.
4. Links found so far merge nodes into components. A meeting whose members are still in several
   components may hide links between them: its cross pairs are compared in blocks of bounded size
   (members of its largest component are not compared with each other), each pair only in the first
   band that it shares, by the same estimate and confirmation. What confirmed links join leaves a
   task, one row for each node.
5. The components of all links give each document the least doc_id that it reaches.

With 32 bands of 5 registers a pair of similarity 0.85 meets with probability 1 - 7e-9 when
registers agree independently.

Edge cases: a text without words (null, empty, white space) has an empty set, is its own component
and is kept; rows that repeat a doc_id with another text are documents of their own; a null doc_id counts as the largest, and a component of nulls only has a null id;
an empty table gives no rows. Input columns named like added ones are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockflow.llm.arrays import add_columns, binary_array, mix, named, numbered, without
from stockflow.llm.graph import components
from stockflow.llm.hyperminhash import BANDS, REGISTERS, band_keys, jaccard, registers
from stockflow.llm.shingles import shingle_sets
from stockflow.session import materialize

BLOCK = 256          # rows of a meeting that one task holds from either side
ERRORS = 4.5         # standard errors below the threshold at which an estimate is dropped
BIT_LIMIT = 1 << 17  # shared shingles of a block pair up to which sets are compared as bitmaps


def set_id(hashes: np.ndarray) -> bytes:
    """16 bytes that tell a set of hashes from any other."""
    a, b = mix(hashes).sum(dtype=np.uint64), mix(hashes ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
    return np.array([mix(np.array([a + np.uint64(len(hashes))]))[0], b], np.uint64).tobytes()


def signatures(df: DataFrame, text: str = "text", width: int = 5, carry: list[str] | None = None) -> DataFrame:
    """Add ``n_shingles long``, ``set_id binary`` and ``registers binary`` (null for an empty set)."""
    def make():
        def step(b: pa.RecordBatch) -> list[pa.Array]:
            flat, off = shingle_sets(b.column(text), width)
            ids, regs = [], []
            for i in range(b.num_rows):
                own = flat[off[i]: off[i + 1]]
                ids.append(set_id(own) if len(own) else None)
                regs.append(registers(own).tobytes() if len(own) else None)
            return [pa.array(np.diff(off)), pa.array(ids, pa.binary()), pa.array(regs, pa.binary())]
        return step

    return add_columns(df, text, "n_shingles bigint, set_id binary, registers binary", make, carry)


def _rows16(col: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(col.to_pylist()), np.uint16).reshape(-1, REGISTERS)


def _allowance(n: np.ndarray, m: np.ndarray, similar: float) -> np.ndarray:
    """Least estimate that a pair of the wanted similarity may show."""
    filled = REGISTERS * -np.expm1(-np.minimum(n, m) / REGISTERS)
    return similar - ERRORS * np.sqrt(similar * (1 - similar) / np.maximum(filled, 1))


def _enough(same: np.ndarray, n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    return 100 * same >= percent * (n + m - same)


def _meetings(nodes: DataFrame) -> DataFrame:
    """``key, band, node, hub, members`` of every band key that at least two nodes share."""
    def keys(batches):
        for b in batches:
            k = band_keys(_rows16(b.column(1))).view(np.int64) if b.num_rows else np.zeros((0, BANDS), np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(
                pa.array(np.arange(b.num_rows + 1, dtype=np.int32) * BANDS), pa.array(k.ravel()))], ["node", "keys"])

    banded = (nodes.select("node", "registers").mapInArrow(keys, "node binary, keys array<bigint>")
              .select("node", F.posexplode("keys").alias("band", "key")))
    shared = banded.groupBy("key").agg(F.min("node").alias("hub"), F.count("*").alias("members")).where("members > 1")
    return banded.join(shared, "key")


def _confirm(pairs: DataFrame, nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The links among pairs ``a, b``: estimates first, then full sets."""
    side = lambda x: nodes.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("registers").alias(f"r_{x}"))

    def estimate(batches):
        for b in batches:
            n, m = (np.asarray(b.column(c), np.float64) for c in ("n_a", "n_b"))
            if not b.num_rows:
                continue
            j = jaccard(_rows16(b.column("r_a")), _rows16(b.column("r_b")), n, m)
            ok = (j >= _allowance(n, m, percent / 100)) & (100 * np.minimum(n, m) >= percent * np.maximum(n, m))
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b")], ["a", "b"]).filter(pa.array(ok))

    likely = (pairs.join(side("a"), "a").join(side("b"), "b")
              .select("a", "b", "n_a", "n_b", "r_a", "r_b").mapInArrow(estimate, "a binary, b binary"))

    def verify(batches):
        for b in batches:
            for k in range(0, b.num_rows, 64):
                part = b.slice(k, 64)
                ok = []
                for x, y in zip(part.column("s_a"), part.column("s_b")):
                    x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                    same = len(np.intersect1d(x, y, assume_unique=True))
                    ok.append(bool(_enough(same, len(x), len(y), percent)))
                yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b")], ["a", "b"]).filter(pa.array(ok, pa.bool_()))

    with_set = lambda x: sets.select(F.col("node").alias(x), F.col("shingles").alias(f"s_{x}"))
    return (likely.join(with_set("a"), "a").join(with_set("b"), "b")
            .select("a", "b", "s_a", "s_b").mapInArrow(verify, "a binary, b binary"))


def _joined(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least place of 0 .. n - 1 that each place reaches by the links a, b."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _compare(percent: int):
    """What the links between a block pair of one meeting join (``side`` 0 and 1; equal blocks come
    once, as 2): every node with the least node that it reaches in the block pair, so a dense family
    gives as many rows as it has nodes, not as it has links."""
    def compare(_, rows):
        rows = rows.combine_chunks()
        regs, n = _rows16(rows["registers"]), np.asarray(rows["n"], np.int64)
        node, side = rows["node"].to_pylist(), np.asarray(rows["side"])
        comp = np.unique(np.array([x.hex() for x in rows["root"].to_pylist()]), return_inverse=True)[1]
        band = rows["band"][0].as_py()
        keys = band_keys(regs)
        left = np.flatnonzero(side != 1)
        right = np.flatnonzero(side != 0)
        i, j = (x.ravel() for x in np.meshgrid(left, right, indexing="ij"))
        ok = (comp[i] != comp[j]) & (100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j]))
        if (side == 2).any():
            ok &= i < j
        i, j = i[ok], j[ok]
        out_a, out_b = [], []
        if len(i):
            earlier = np.zeros(len(i), bool)
            for b in range(band):
                earlier |= keys[i, b] == keys[j, b]
            i, j = i[~earlier], j[~earlier]
            likely = np.zeros(len(i), bool)
            for k in range(0, len(i), 8192):
                x, y = i[k: k + 8192], j[k: k + 8192]
                likely[k: k + 8192] = jaccard(regs[x], regs[y], n[x].astype(float), n[y].astype(float)) >= _allowance(n[x], n[y], percent / 100)
            i, j = i[likely], j[likely]
        if len(i):
            used = np.unique(np.concatenate([i, j]))
            sets = {k: np.frombuffer(rows["shingles"][k].as_py(), np.uint64) for k in used.tolist()}
            flat = np.concatenate([sets[k] for k in used.tolist()])
            names, code, often = np.unique(flat, return_inverse=True, return_counts=True)
            common = np.flatnonzero(often > 1)
            if len(common) <= BIT_LIMIT:
                place = np.full(len(names), -1)
                place[common] = np.arange(len(common))
                bits = np.zeros((len(used), len(common)), bool)
                row = np.repeat(np.arange(len(used)), [len(sets[k]) for k in used.tolist()])
                hit = place[code] >= 0
                bits[row[hit], place[code[hit]]] = True
                packed = np.packbits(bits, axis=1)
                packed = np.pad(packed, ((0, 0), (0, -packed.shape[1] % 8))).view(np.uint64)
                x, y = np.searchsorted(used, i), np.searchsorted(used, j)
                step = max(1, (1 << 22) // max(packed.shape[1], 1))
                same = np.concatenate([np.bitwise_count(packed[x[k: k + step]] & packed[y[k: k + step]]).sum(1, dtype=np.int64) for k in range(0, len(x), step)])
            else:
                same = np.array([len(np.intersect1d(sets[p], sets[q], assume_unique=True)) for p, q in zip(i.tolist(), j.tolist())])
            found = _enough(same, n[i], n[j], percent)
            root = _joined(len(node), i[found], j[found])
            later = np.flatnonzero(root != np.arange(len(node)))
            out_a, out_b = [node[k] for k in root[later].tolist()], [node[k] for k in later.tolist()]
        return pa.table({"a": pa.array(out_a, pa.binary()), "b": pa.array(out_b, pa.binary())})
    return compare


def _cross_links(meetings: DataFrame, roots: DataFrame, nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between different components that meet in a band, from bounded blocks of each meeting."""
    placed = (meetings.select("key", "band", "node", "members").join(roots, "node", "left")
              .withColumn("root", F.coalesce("root", "node")))
    sizes = placed.groupBy("key", "root").agg(F.count("*").alias("n_root"))
    mixed = (sizes.groupBy("key").agg(F.count("*").alias("n_roots"), F.max(F.struct("n_root", "root")).alias("top")).where("n_roots > 1")
             .select("key", F.col("top.root").alias("top"), F.col("top.n_root").alias("n_top")))
    # blocks 0 .. nt-1 hold the largest component, blocks nt .. nt+no-1 all others
    up = lambda c: F.greatest(F.lit(1), F.ceil(c / F.lit(BLOCK))).cast("int")
    spread = F.xxhash64("node", "key")
    blocks = (placed.join(mixed, "key").withColumn("nt", up(F.col("n_top"))).withColumn("no", up(F.col("members") - F.col("n_top")))
              .withColumn("block", F.when(F.col("root") == F.col("top"), F.pmod(spread, F.col("nt"))).otherwise(F.col("nt") + F.pmod(spread, F.col("no"))).cast("int"))
              # a block of the largest component meets all others'; one of the others meets every block
              .withColumn("with", F.explode(F.when(F.col("block") < F.col("nt"), F.sequence(F.col("nt"), F.col("nt") + F.col("no") - 1))
                                            .otherwise(F.sequence(F.lit(0), F.col("nt") + F.col("no") - 1)))))
    work = (blocks.select("key", "band", "node", "root", F.least("block", "with").alias("x"), F.greatest("block", "with").alias("y"),
                          F.when(F.col("block") == F.col("with"), 2).when(F.col("block") < F.col("with"), 0).otherwise(1).alias("side"))
            .join(nodes.select("node", "n", "registers"), "node").join(sets, "node"))
    return (work.select("key", "x", "y", "band", "node", "root", "side", "n", "registers", "shingles")
            .groupBy("key", "x", "y").applyInArrow(_compare(percent), "a binary, b binary"))


def _sets(docs: DataFrame, wanted: DataFrame, doc_id: str, text: str, width: int) -> DataFrame:
    """``node, shingles`` (sorted hashes) of the wanted nodes, from one document of each."""
    source = (docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text"))
              .join(wanted.select("node", F.col("label").alias("_label")), F.col("_id").eqNullSafe(F.col("_label"))).select("node", "_text"))

    def make():
        def step(b: pa.RecordBatch) -> list[pa.Array]:
            flat, off = shingle_sets(b.column("_text"), width)
            right = [bool(off[i + 1] > off[i]) and set_id(flat[off[i]: off[i + 1]]) == x.as_py() for i, x in enumerate(b.column("node"))]
            return [binary_array(flat, off * 8), pa.array(right, pa.bool_())]
        return step

    return (add_columns(source, "_text", "shingles binary, right boolean", make, ["node"])
            .where("right").dropDuplicates(["node"]).select("node", "shingles"))


def groups(signed: DataFrame, docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = 85,
           width: int = 5) -> DataFrame:
    """``set_id, label, component_id, root`` of every non-empty set in the signed documents.

    ``signed`` must be a written table (it is read several times); ``docs`` has the whole texts.
    """
    nodes = materialize(signed.where("n_shingles > 0").groupBy(F.col("set_id").alias("node"))
                        .agg(F.min(doc_id).alias("label"), F.first("n_shingles").alias("n"), F.first("registers").alias("registers")), "nodes")
    meetings = materialize(_meetings(nodes), "meetings")
    met = meetings.select("node").distinct()
    sets = materialize(_sets(docs, nodes.join(met, "node", "left_semi"), doc_id, text, width), "sets")
    pairs = meetings.where("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    links = materialize(_confirm(pairs, nodes, sets, percent), "links")
    cross = materialize(_cross_links(meetings, components(links), nodes, sets, percent), "links")
    roots = components(links.unionByName(cross))
    labelled = nodes.join(roots, "node", "left").select("node", "label", F.coalesce("root", "node").alias("root"))
    least = labelled.groupBy("root").agg(F.min("label").alias("component_id"))
    return labelled.join(least, "root").select(F.col("node").alias("set_id"), "label", "component_id", "root")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = 85, width: int = 5,
                    carry: list[str] | None = None) -> DataFrame:
    """Add ``n_shingles``, ``component_id`` and ``kept`` (doc_id = component_id) to every document."""
    added = ["n_shingles", "component_id", "kept"]
    keep = [c for c in without(docs, added) if carry is None or c in carry]
    work = numbered(docs, keep, _id=doc_id, _text=text)
    signed = materialize(signatures(work, "_text", width, without(work, ["_text"])), "signed")
    found = groups(signed, work, "_id", "_text", percent, width)
    done = (signed.drop("registers").join(found.select("set_id", "component_id"), "set_id", "left")
            .withColumn("component_id", F.when(F.col("n_shingles") == 0, F.col("_id")).otherwise(F.col("component_id")))
            .withColumn("kept", F.col("_id").eqNullSafe(F.col("component_id"))))
    return named(done, keep, added)


def representatives(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = 85, width: int = 5) -> DataFrame:
    """The rows of ``docs`` with one document of each group: that of the least doc_id.

    Documents without a word stay, all of them; of rows that repeat id and set, one stays.
    """
    work = numbered(docs, _id=doc_id, _text=text)
    signed = materialize(signatures(work, "_text", width, without(work, ["_text"])), "signed")
    found = groups(signed, work, "_id", "_text", percent, width)
    best = (found.where(F.col("label").eqNullSafe(F.col("component_id"))).groupBy("root")
            .agg(F.min(F.struct("set_id", "label")).alias("best")).select(F.col("best.set_id").alias("_set"), F.col("best.label").alias("_label")))
    once = Window.partitionBy("set_id", "_id").orderBy(F.lit(0))
    stay = (signed.drop("registers", "n_shingles").where("set_id is not null")
            .join(best, (F.col("set_id") == F.col("_set")) & F.col("_id").eqNullSafe(F.col("_label")))
            .withColumn("_n", F.row_number().over(once)).where("_n = 1"))
    return named(stay, docs.columns).unionByName(named(signed.where("set_id is null"), docs.columns))
