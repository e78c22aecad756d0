import os
import uuid
from datetime import date

from pyspark.sql import functions as F

from conftest import SF0001, SF001
from stockflow.operators import aggregates as ag
from stockflow.operators import reconcile as rc
from stockflow.plans import lake
from stockflow.session import ensure_checkpoint_dir
from stockflow.sources import fixtures as fx
from stockflow.sources.movements import finalize, read_movements


def test_entry_flagship_rows(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() == 23
    assert set(df.columns) == {"company", "item_code", "warehouse", "qty_recon", "qty_sap", "diff"}


def test_reconcile_planted_errors(spark):
    mov = fx.movements(spark, SF001)
    stock = fx.stock_snapshot(spark, SF001, mov)
    out = rc.reconcile(mov, stock)
    assert out.count() == 201
    # within tolerance never reported unless another plant applies
    tol_only = out.filter((F.col("item_code").cast("bigint") % 89 == 0) & (F.col("item_code").cast("bigint") % 97 != 0)
                          & (F.col("item_code").cast("bigint") % 101 != 0))
    assert tol_only.count() == 0
    assert out.filter(F.col("item_code") == "9999999").count() == 3


def test_reconcile_clean_is_empty(spark):
    mov = fx.movements(spark, SF0001)
    stock = rc.on_hand(mov).withColumnRenamed("qty_recon", "qty_sap")
    assert rc.reconcile(mov, stock).count() == 0


def test_f1_last_equals_e1(spark):
    from stockflow.operators.inventory import running_on_hand
    mov = fx.movements(spark, SF0001)
    last = running_on_hand(mov).groupBy(*rc.KEY).agg(F.max_by("on_hand", "doc_date").alias("last"))
    j = last.join(rc.on_hand(mov), rc.KEY)
    assert j.filter(F.col("last") != F.col("qty_recon")).count() == 0


def test_transfer_netting_planted(spark):
    mov = fx.movements(spark, SF0001)
    bad_doc = mov.filter("trans_type = 67").select("base_entry").first()[0]
    broken = mov.withColumn("in_qty", F.when((F.col("trans_type") == 67) & (F.col("base_entry") == bad_doc)
                                              & (F.col("in_qty") > 0), F.col("in_qty") + 1).otherwise(F.col("in_qty")))
    assert ag.transfer_netting(mov).count() == 0
    assert ag.transfer_netting(broken).filter(F.col("base_entry") == bad_doc).count() >= 1


def _root(spark):
    return os.path.join(ensure_checkpoint_dir(spark), f"t-lake-{uuid.uuid4().hex}")


def _rows(df):
    return sorted(tuple(r) for r in df.select("mov_id", "in_qty", "out_qty", "create_date").collect())


def test_replace_idempotent_and_backfill_equivalence(spark):
    src = fx.movement_source(spark, SF0001)
    one, many = _root(spark), _root(spark)
    lake.replace_window(spark, one, finalize(read_movements(src, "HR", date(1990, 1, 1), date(2005, 1, 1))),
                        "HR", date(1990, 1, 1), date(2005, 1, 1))
    report = lake.backfill(spark, many, src, "HR", date(1990, 1, 1), date(2005, 1, 1))
    assert len(report) > 1
    expected = _rows(finalize(read_movements(src, "HR", None, None)))
    assert _rows(lake.read_table(spark, one)) == expected == _rows(lake.read_table(spark, many))
    # replacing a partial window twice is idempotent; an empty window is a no-op
    since, until = date(1996, 3, 10), date(1997, 2, 20)
    inc = finalize(read_movements(src, "HR", since, until))
    lake.replace_window(spark, one, inc, "HR", since, until)
    lake.replace_window(spark, one, inc, "HR", since, until)
    assert lake.replace_window(spark, one, inc.limit(0), "HR", since, until) == 0
    assert _rows(lake.read_table(spark, one)) == expected


def test_replace_removes_rows_gone_upstream(spark):
    src = fx.movement_source(spark, SF0001)
    root = _root(spark)
    lake.replace_window(spark, root, finalize(read_movements(src, "CAP", None, None)), "CAP",
                        date(1990, 1, 1), date(2005, 1, 1))
    since, until = date(1996, 1, 1), date(1997, 1, 1)
    smaller = finalize(read_movements(src, "CAP", since, until)).filter("trans_type <> 15")
    lake.replace_window(spark, root, smaller, "CAP", since, until)
    t = lake.read_table(spark, root)
    inside = t.filter((F.col("create_date") >= F.lit(since)) & (F.col("create_date") < F.lit(until)))
    assert inside.filter("trans_type = 15").count() == 0
    assert inside.count() == smaller.count()
    outside = t.filter((F.col("create_date") < F.lit(since)) | (F.col("create_date") >= F.lit(until)))
    exp_out = read_movements(src, "CAP", None, None).filter(
        (F.col("create_date") < F.lit(since)) | (F.col("create_date") >= F.lit(until)))
    assert outside.count() == exp_out.count()


def test_sync_resumes_at_watermark(spark):
    src = fx.movement_source(spark, SF0001)
    root = _root(spark)
    lake.sync(spark, root, src, "HR", until=date(1996, 1, 1), since=date(1990, 1, 1))
    w = lake.table_watermark(spark, root, "HR")
    assert w < date(1996, 1, 1)
    lake.sync(spark, root, src, "HR", until=date(2005, 1, 1))
    assert _rows(lake.read_table(spark, root)) == _rows(finalize(read_movements(src, "HR", None, None)))


def test_interrupted_write_loses_no_row_outside_its_window(spark, monkeypatch):
    src = fx.movement_source(spark, SF0001)
    root = _root(spark)
    lake.backfill(spark, root, src, "HR", date(1990, 1, 1), date(2005, 1, 1))
    expected = _rows(lake.read_table(spark, root))
    since, until = date(1996, 3, 10), date(1996, 5, 20)
    inc = finalize(read_movements(src, "HR", since, until))
    real = lake._write_leaves

    def cut_off(df, path, mode):
        if path == root and mode == "overwrite":  # a commit that removed leaves and wrote nothing
            for month in ("1996-03", "1996-04", "1996-05"):
                lake._delete(spark, f"{root}/company=HR/load_month={month}")
            raise RuntimeError("cut off")
        real(df, path, mode)

    monkeypatch.setattr(lake, "_write_leaves", cut_off)
    try:
        lake.replace_window(spark, root, inc, "HR", since, until)
    except RuntimeError:
        pass
    assert _rows(lake.read_table(spark, root)) != expected
    monkeypatch.setattr(lake, "_write_leaves", real)
    assert lake.replace_window(spark, root, inc, "HR", since, until) == inc.count()
    assert _rows(lake.read_table(spark, root)) == expected
    assert lake.recover(spark, root) == 0


def test_several_files_of_one_window_all_arrive(spark):
    from stockflow.streaming import streams as st

    src = fx.movement_source(spark, SF0001).filter("create_date >= '1996-01-01' and create_date < '1996-02-01'")
    base = _root(spark)
    src.repartition(3).write.parquet(base + "/in")
    st.stream_sync(spark, base + "/in", src.schema, base + "/out", base + "/ckpt", max_files=1)
    assert _rows(lake.read_table(spark, base + "/out")) == _rows(finalize(src))


def test_rows_outside_the_window_fail(spark):
    src = fx.movement_source(spark, SF0001)
    import pytest
    with pytest.raises(Exception, match="outside"):
        lake.replace_window(spark, _root(spark), finalize(read_movements(src, "HR", None, None)), "HR", date(1996, 1, 1), date(1996, 2, 1))
