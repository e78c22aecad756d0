"""Size-driven compaction, mergeable counts, change lists, JSON cells."""

import os
import uuid
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from conftest import SF0001
from stockflow.operators import aggregates as ag
from stockflow.operators import logs as lg
from stockflow.operators import runs as rn
from stockflow.plans import lake
from stockflow.session import ensure_checkpoint_dir, materialize
from stockflow.sources import fixtures as fx
from stockflow.sources.movements import finalize

SPAN = (date(1990, 1, 1), date(2005, 1, 1))


def _root(spark):
    return os.path.join(ensure_checkpoint_dir(spark), f"t-upkeep-{uuid.uuid4().hex}")


def _files(spark, root):
    out = {}
    for month in lake._list_dirs(spark, f"{root}/company=HR"):
        path, fs = lake._path(spark, f"{root}/company=HR/{month}")
        out[month] = {f.getPath().getName(): f.getLen() for f in fs.listStatus(path) if f.getPath().getName()[0] not in "._"}
    return out


def _rows(spark, root):
    return sorted(map(str, lake.read_table(spark, root).collect()))


@pytest.fixture
def table(spark):
    root = _root(spark)
    rows = finalize(fx.movement_source(spark, SF0001)).filter("company = 'HR' and create_date >= '1995-01-01' and create_date < '1996-01-01'").withColumn("load_month", lake.load_month())
    rows = materialize(rows, "t-rows")
    for k in range(3):
        lake._write_leaves(rows.filter(F.pmod(F.xxhash64("mov_id"), F.lit(3)) == k), root, "append")
    return root


def test_bins_of_adjacent_small_files():
    b = lambda *sizes: lake._bins([(str(i), n) for i, n in enumerate(sizes)], 100)
    assert b(10, 20, 30) == [["0", "1", "2"]] and b(10) == [] and b() == []
    assert b(40, 40, 40, 40) == [["0", "1"], ["2", "3"]]
    assert b(10, 90, 10, 10) == [["2", "3"]]      # the large file stays and parts the bins
    assert b(49, 50, 49) == []


def test_small_files_merge_and_large_ones_stay(spark, table):
    before, rows = _files(spark, table), _rows(spark, table)
    sizes = sorted(n for f in before.values() for n in f.values())
    assert any(len(f) == 3 for f in before.values())
    # no file below half of this target: nothing to do
    assert lake.compact(spark, table, "HR", *SPAN, target_bytes=2 * sizes[0])["rewritten"] == 0 and _files(spark, table) == before
    target = 2 * sizes[len(sizes) // 2]
    got = lake.compact(spark, table, "HR", *SPAN, target_bytes=target)
    after = _files(spark, table)
    assert got["files_before"] == sum(map(len, before.values())) and got["files_after"] == sum(map(len, after.values())) < got["files_before"]
    for month, files in before.items():
        large = {k for k, n in files.items() if 2 * n >= target}
        assert large <= set(after[month])
    assert _rows(spark, table) == rows
    done = lake.compact(spark, table, "HR", *SPAN)
    assert done["files_after"] == len(before) and lake.compact(spark, table, "HR", *SPAN)["rewritten"] == 0
    assert _rows(spark, table) == rows and not lake._list_dirs(spark, f"{table}/_staging")


def test_a_cut_off_swap_is_finished(spark, table, monkeypatch):
    rows = _rows(spark, table)
    real, calls = lake._delete, []

    def cut_off(spark, path):
        if path.endswith(".parquet"):
            calls.append(path)
            if len(calls) == 4:
                raise RuntimeError("cut off")
        real(spark, path)

    monkeypatch.setattr(lake, "_delete", cut_off)
    with pytest.raises(RuntimeError):
        lake.compact(spark, table, "HR", *SPAN)
    monkeypatch.setattr(lake, "_delete", real)
    assert _rows(spark, table) != rows
    assert lake.recover(spark, table) == 1 and _rows(spark, table) == rows
    assert all(len(f) == 1 for f in _files(spark, table).values()) and lake.recover(spark, table) == 0


def test_sketches_roll_up_within_their_error(spark):
    n = 30_000
    mov = spark.range(n * 4).select(F.pmod("id", F.lit(n)).cast("string").alias("item_code"), F.lit("A").alias("warehouse"), F.lit(15).alias("trans_type"),
                                    F.when(F.col("id") % 10 > 0, F.col("id")).alias("base_entry"),
                                    F.date_add(F.lit("1995-01-01").cast("date"), F.pmod("id", F.lit(700)).cast("int")).alias("doc_date"))
    stored = materialize(ag.distinct_sketches(mov), "sk")
    for by in (ag.QUARTER, ag.YEAR):
        est = {tuple(r[c] for c in by): r for r in ag.sketch_counts(ag.roll_sketches(stored, by)).collect()}
        exact = ag.with_retail_coords(mov).groupBy(*by).agg(F.count_distinct("item_code").alias("items"), F.count_distinct("warehouse").alias("warehouses"),
                                                            F.count_distinct("trans_type", "base_entry").alias("documents")).collect()
        assert len(est) == len(exact)
        for r in exact:
            for c in ag.SKETCHES:
                assert abs(est[tuple(r[k] for k in by)][c] - r[c]) <= max(1, ag.sketch_error() * r[c])
    assert "movement" not in ag.roll_sketches(stored, ag.YEAR)._jdf.queryExecution().toString()
    assert ag.sketch_counts(ag.roll_sketches(ag.distinct_sketches(mov.limit(0)), ag.YEAR)).count() == 0


def test_change_lists(spark):
    t = [datetime(2026, 1, 1, h) for h in range(4)]
    ev = spark.createDataFrame([(1, 0, t[0], "ana", "open", 5, None), (1, 1, t[1], "ben", "open", 7, None), (1, 2, t[2], "ben", "open", 7, None),
                                (1, 3, t[3], "eva", "sent", None, ["x"]), (2, 0, t[0], "ana", None, None, None)],
                               "id long, seq int, event_at timestamp_ntz, trigger string, state string, qty int, tags array<string>")
    got = {(r.id, r.seq): {k: tuple(v) for k, v in r.changes.items()} for r in rn.change_list(ev, ["state", "qty", "tags"]).collect()}
    assert got == {(1, 0): {"state": (None, "open"), "qty": (None, "5")}, (1, 1): {"qty": ("5", "7")}, (1, 2): {},
                   (1, 3): {"state": ("open", "sent"), "qty": ("7", None), "tags": (None, "[x]")}, (2, 0): {}}
    assert rn.change_rows(rn.change_list(ev, ["state", "qty", "tags"])).count() == 6


def test_nested_cells_become_json(spark):
    api = fx.api_logs(spark, SF0001).limit(1)
    rows = (api.withColumn("detail", F.struct(F.lit(1).alias("a"), F.lit(None).cast("string").alias("b"), F.array(F.lit("ñ"), F.lit('"')).alias("c")))
            .withColumn("source", F.create_map(F.lit("k"), F.lit(2))).withColumn("path", F.array(F.lit("x"))))
    r = lg.typed_batch(rows, "api").first()
    assert r.detail == '{"a":1,"b":null,"c":["ñ","\\""]}' and r.source == '{"k":2}' and r.path == '["x"]'
    assert lg.typed_batch(api, "api").first() == api.first()
