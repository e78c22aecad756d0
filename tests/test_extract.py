from datetime import date

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import SF0001
from stockflow.sources import extract as ex
from stockflow.sources import fixtures as fx
from stockflow.sources import movements as mv

SPAN = (date(1992, 1, 1), date(2005, 1, 1))


@pytest.fixture(scope="module")
def source(spark):
    return fx.movement_source(spark, SF0001).cache()


@pytest.fixture(scope="module")
def extract(spark, source, tmp_path_factory):
    """The extract and a log of the windows that it was asked for."""
    rows = source.toArrow()
    log = str(tmp_path_factory.mktemp("extract") / "asked")

    def fetch(company, since, until):
        with open(log, "a") as f:
            f.write(f"{company} {since} {until}\n")
        keep = [c == company and since <= d < until for c, d in zip(rows["company"].to_pylist(), rows["create_date"].to_pylist())]
        return rows.filter(pa.array(keep)).to_batches()

    df = ex.read_extract(spark, fetch, mv.COMPANIES, *SPAN, source.schema)

    def asked():
        with open(log, "a+") as f:
            f.seek(0)
            out = sorted({tuple(x.split()) for x in f})
            f.truncate(0)
        return out

    return df, asked


def test_windows():
    w = list(ex.month_windows(date(2020, 1, 15), date(2020, 4, 2)))
    assert w == [(date(2020, 1, 15), date(2020, 2, 1)), (date(2020, 2, 1), date(2020, 3, 1)), (date(2020, 3, 1), date(2020, 4, 1)), (date(2020, 4, 1), date(2020, 4, 2))]
    assert list(ex.month_windows(date(2020, 1, 1), date(2020, 1, 1))) == []
    assert list(ex.month_windows(date(2020, 12, 31), date(2021, 1, 2)))[-1] == (date(2021, 1, 1), date(2021, 1, 2))


def test_a_filter_reads_only_its_windows(spark, source, extract):
    df, asked = extract
    part = mv.read_movements(df, "HR", date(1996, 1, 10), date(1996, 4, 1))
    assert part.rdd.getNumPartitions() == 3
    got = sorted(map(str, part.collect()))
    assert got == sorted(map(str, mv.read_movements(source, "HR", date(1996, 1, 10), date(1996, 4, 1)).collect())) and len(got) > 10
    assert asked() == [("HR", "1996-01-10", "1996-02-01"), ("HR", "1996-02-01", "1996-03-01"), ("HR", "1996-03-01", "1996-04-01")]
    assert df.filter("create_date = DATE '1996-05-05' and company in ('HR', 'CAP')").count() == source.filter("create_date = DATE '1996-05-05' and company in ('HR', 'CAP')").count()
    assert asked() == [("CAP", "1996-05-05", "1996-05-06"), ("HR", "1996-05-05", "1996-05-06")]
    assert df.filter("create_date > DATE '1998-11-30' and create_date <= DATE '1998-12-05'").count() == source.filter(
        "create_date > DATE '1998-11-30' and create_date <= DATE '1998-12-05'").count()
    assert len(asked()) == 3


def test_the_whole_extract_and_other_filters(spark, source, extract):
    df, asked = extract
    assert df.rdd.getNumPartitions() == 3 * 156
    some = lambda x: x.filter("trans_type = 15 and (company = 'HR' or in_qty > 0)")
    assert some(df).count() == some(source).count()
    asked()
    assert df.filter("company = 'NOBODY'").count() == 0 and df.filter("create_date < DATE '1980-01-01'").count() == 0
    assert asked() == []
    assert [f.name for f in df.schema] == ["company", *ex.SOURCE_COLUMNS]
    assert df.agg(F.sum("out_qty")).first() == source.agg(F.sum("out_qty")).first()
