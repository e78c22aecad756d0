import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stockflow.operators import analogs as an

PART = "p_partkey bigint, p_brand string, p_type string, p_retailprice double"
SERIES = "company string, item_code string, p int, qty double"


def market(seed=1, items=160, noise=1.0):
    """Items whose demand follows from brand, type, season and price, and some with a short history."""
    rng = random.Random(seed)
    brand, kind = {f"B{i}": rng.uniform(5, 40) for i in range(6)}, {f"T{i}": rng.uniform(-5, 15) for i in range(5)}
    season = [0.0, 6.0, -3.0, 9.0]
    part, rows, true = [], [], {}
    for i in range(items):
        b, t, px = rng.choice(list(brand)), rng.choice(list(kind)), float(rng.choice([10, 20, 20, 35, rng.randint(5, 60)]))
        part.append((i, b, t, px))
        code = f"{i:07d}"
        for c in ("HR", "CAP"):
            base = [brand[b] + kind[t] + season[k] - 0.2 * px for k in range(4)]
            true[c, code] = base
            first = 95 if i % 8 == 0 else 0
            rows += [(c, code, p, base[(p % 52) // 13] + rng.gauss(0, noise)) for p in range(first, 104)]
    return part, rows, true


@pytest.fixture(scope="module")
def tables(spark):
    part, rows, true = market()
    return spark.createDataFrame(part, PART).cache(), spark.createDataFrame(rows, SERIES).cache(), true


def test_ranked_analogs_by_all_pairs(spark, tables):
    part, series, _ = tables
    stats = an.item_stats(series, part).cache()
    for k in (1, 5, 200):
        got = {}
        for r in an.ranked_analogs(stats, k).collect():
            got.setdefault((r.company, r.item_code), []).append((r.rank, r.analog, round(r.distance, 9)))
        rows = stats.collect()
        new = [r for r in rows if not r.known]
        assert len(got) == len(new) == 40
        for n in new:
            every = sorted(((n.p_brand != e.p_brand) + (n.p_type != e.p_type) + abs(n.price - e.price) / max(n.price, e.price), e.item_code)
                           for e in rows if e.known and e.company == n.company)
            assert sorted(got[n.company, n.item_code]) == [(i + 1, code, round(d, 9)) for i, (d, code) in enumerate(every[:k])]


def test_profile_transfers_the_season(spark, tables):
    part, series, true = tables
    got = {}
    for r in an.analog_profile(series, part, 5).collect():
        got.setdefault((r.company, r.item_code), {})[r.r_week] = r.qty
    assert len(got) == 40 and all(sorted(v) == list(range(1, 53)) for v in got.values())
    shape = []
    for key, weeks in got.items():
        quarter = np.array([np.mean([weeks[w] for w in range(13 * k + 1, 13 * k + 14)]) for k in range(4)])
        shape.append(np.corrcoef(quarter, true[key])[0, 1])
    assert np.median(shape) > 0.9


def test_attribute_model_beats_the_category_mean_on_held_out_items(spark, tables):
    part, series, true = tables
    model = an.fit_attributes(series, part)
    known = an.item_stats(series, part).filter("known").groupBy("p_brand").agg(F.avg("mean_qty").alias("m"))
    mean = {r.p_brand: r.m for r in known.collect()}
    brand = {f"{r.p_partkey:07d}": r.p_brand for r in part.collect()}
    err, base = [], []
    for r in an.attribute_forecast(series, part).collect():
        want = true[r.company, r.item_code][int(r.season) - 1]
        err.append(abs(r.attribute_weekly_qty - want))
        base.append(abs(mean[brand[r.item_code]] - want))
    assert len(err) == 160 and np.mean(err) < 0.2 * np.mean(base)
    c = an.coefficients(model)
    assert set(c) == {"p_brand", "p_type", "season", "price"} and c["price"] < 0
    assert abs(c["season"]["4"] - c["season"]["3"] - 12) < 1


def test_unseen_attributes_and_empty_tables(spark, tables):
    part, series, _ = tables
    more = part.unionByName(spark.createDataFrame([(900, "new brand", None, 12.0), (901, None, "T1", None)], PART))
    rows = series.unionByName(spark.createDataFrame([("HR", "0000900", 103, 4.0), ("HR", "0000901", 103, 1.0), ("NEW", "0000001", 103, 2.0)], SERIES))
    near = an.ranked_analogs(an.item_stats(rows, more), 3).filter("item_code >= '0000900' or company = 'NEW'").collect()
    assert [(r.item_code, r.rank) for r in sorted(near)] == [("0000900", 1), ("0000900", 2), ("0000900", 3)]  # no price or no known items: none
    out = an.attribute_forecast(rows, more).filter("item_code >= '0000900'").count()
    assert out == 0 and an.attribute_forecast(rows, more).filter("company = 'NEW'").count() == 4
    assert an.ranked_analogs(an.item_stats(series.limit(0), part), 3).count() == 0
