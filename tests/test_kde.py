from statistics import NormalDist

import numpy as np

from stockflow.operators import forecast as fc


def test_quantiles_of_densities():
    rng = np.random.default_rng(1)
    samples = [rng.poisson(4, 200).astype(float), rng.normal(0, 1, 50), np.array([3.0]), np.array([5.0, 5.0, 5.0]), np.zeros(0)]
    row = np.repeat(np.arange(5), [len(s) for s in samples])
    x = np.concatenate(samples)
    for tau in (0.05, 0.5, 0.95):
        got = fc.kde_quantiles(x, np.ones(len(x)), row, 5, tau)
        for k, s in enumerate(samples[:4]):
            w = 1.06 * s.std() * len(s) ** -0.2 if s.std() > 0 else 1.0
            assert abs(np.mean([NormalDist(v, w).cdf(got[k]) for v in s]) - tau) < 1e-9
            one = fc.kde_quantiles(s, np.ones(len(s)), np.zeros(len(s), int), 1, tau)
            values, c = np.unique(s, return_counts=True)
            assert one[0] == got[k] and abs(fc.kde_quantiles(values, c.astype(float), np.zeros(len(values), int), 1, tau)[0] - got[k]) < 1e-9
        assert np.isnan(got[4])


def test_safety_stock(spark):
    rng = np.random.default_rng(2)
    own = {str(i): rng.poisson(6, 80).astype(float) for i in range(12)}
    df = spark.createDataFrame([("HR", k, float(v)) for k, s in own.items() for v in s] + [("HR", "none", None)], "company string, item_code string, ltd double")
    got = {r.item_code: r for r in fc.kde_safety_stock(df).collect()}
    assert set(got) == set(own)
    for k, s in own.items():
        kde = fc.kde_quantiles(s, np.ones(80), np.zeros(80, int), 1, 0.95)[0] - s.mean()
        three = (kde + np.quantile(s, 0.95) - s.mean() + s.std() * NormalDist().inv_cdf(0.95)) / 3
        assert abs(got[k].ss_kde - kde) < 1e-9 and abs(got[k].ss_average - three) < 1e-9
