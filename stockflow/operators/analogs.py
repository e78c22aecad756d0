"""Forecasts of new items from similar ones (H28): ranked analogs with their weekly profiles, and a
pooled regression on item attributes.

Analogs are found without pairing all new items with all known ones. The distance of two items of a
company is 1 for another brand, plus 1 for another type, plus the relative difference of their prices
(below 1). Inside a block of equal attributes it is the price alone that decides, so the k nearest on
either side of a price are the only candidates; the k best of the blocks (brand and type, brand, type,
company) are the k best of all.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockflow.functions.movement_fields import item_code
from stockflow.operators.demand import ITEM
from stockflow.operators.sequence import running_by_value
from stockflow.session import materialize

BLOCKS = (["p_brand", "p_type"], ["p_brand"], ["p_type"], [])
MIN_PERIODS = 13


def item_stats(series: DataFrame, part: DataFrame, by=ITEM, min_periods: int = MIN_PERIODS) -> DataFrame:
    """Periods and mean demand of every item with its brand, type and price; ``known`` tells the
    established ones (at least ``min_periods`` of history) from the new."""
    p = part.select(item_code("p_partkey").alias("item_code"), "p_brand", "p_type", F.col("p_retailprice").alias("price"))
    g = series.groupBy(*by).agg(F.count(F.lit(1)).alias("periods"), F.avg("qty").alias("mean_qty"))
    return g.withColumn("known", F.col("periods") >= min_periods).join(p, "item_code")


def _relative(a, b):
    return F.abs(a - b) / F.greatest(a, b)


def _nearest(stats: DataFrame, block: list[str], k: int, above: bool) -> DataFrame:
    """Pairs of each new item with the k known ones of its block that are nearest in price, of those at
    least as dear (``above``) or cheaper; equal prices in order of the item code."""
    by = ["company", *block]
    x = stats.filter("price is not null").withColumn("_known", F.col("known").cast("int"))
    # upwards a new item stands before known ones of its price, downwards behind them
    x = x.withColumn("_turn", F.col("_known") if above else 1 - F.col("_known"))
    x = running_by_value(x, by, "price", ["_turn", "item_code"], "_known", "_rank", "_total", desc=not above)
    known = x.filter("known").select(*by, "_rank", F.col("item_code").alias("analog"), F.col("price").alias("analog_price"),
                                     F.col("p_brand").alias("_brand"), F.col("p_type").alias("_type"))
    new = x.filter("not known").withColumn("_rank", F.explode(F.sequence(F.col("_rank") + 1, F.col("_rank") + k)))
    return (new.join(known, [*by, "_rank"])
            .select("company", "item_code", "price", "analog", "analog_price",
                    ((~F.col("p_brand").eqNullSafe(F.col("_brand"))).cast("int") + (~F.col("p_type").eqNullSafe(F.col("_type"))).cast("int")
                     + _relative(F.col("price"), F.col("analog_price"))).alias("distance")))


def ranked_analogs(stats: DataFrame, k: int = 5) -> DataFrame:
    """The k nearest known items of the company for every new item: ``rank`` (from 1, ties by item
    code), ``analog``, ``distance`` and both prices. A company without known items gives no rows.

    The items are written down first: the blocks read them sixteen times."""
    stats, found = materialize(stats, "items"), None
    for block in BLOCKS:
        for above in (True, False):
            near = _nearest(stats, block, k, above)
            found = near if found is None else found.unionByName(near)
    best = F.slice(F.array_sort(F.collect_set(F.struct("distance", "analog", "analog_price"))), 1, k)  # of 8 k at most
    return (found.groupBy("company", "item_code", "price").agg(best.alias("b"))
            .select("company", "item_code", "price", F.posexplode("b").alias("_i", "x"))
            .select("company", "item_code", (F.col("_i") + 1).alias("rank"), "x.analog", "x.distance", "x.analog_price", "price"))


def analog_profile(series: DataFrame, part: DataFrame, k: int = 5, by=ITEM, digits: int = 6) -> DataFrame:
    """Demand of every new item in each retail week: the mean weekly profile of its k analogs, each
    scaled by the ratio of the prices and weighted by 1 / (1 + distance)."""
    near = ranked_analogs(item_stats(series, part, by), k)
    weekly = (series.withColumn("r_week", F.pmod(F.col("p"), F.lit(52)) + 1)
              .groupBy("company", F.col("item_code").alias("analog"), "r_week").agg(F.avg("qty").alias("week_qty")))
    weight = 1 / (1 + F.col("distance"))
    x = near.join(weekly, ["company", "analog"])
    return x.groupBy(*by, "r_week").agg(F.round(
        F.sum(F.col("week_qty") * F.col("price") / F.col("analog_price") * weight) / F.sum(weight), digits).alias("qty"))


def _seasons(series: DataFrame, by) -> DataFrame:
    """Mean demand of every item in each retail quarter that it has."""
    quarter = (F.floor(F.pmod(F.col("p"), F.lit(52)) / 13) + 1).cast("string").alias("season")
    return series.groupBy(*by, quarter).agg(F.avg("qty").alias("qty"))


def fit_attributes(series: DataFrame, part: DataFrame, by=ITEM, min_periods: int = MIN_PERIODS, ridge: float = 1e-3, stats: DataFrame | None = None):
    """One regression over all known items: mean demand of an item and retail quarter on its brand,
    type, season and price. Attributes are one-hot; one unseen in the fit counts as none. The normal
    equations are summed over all rows, so only a matrix of the attributes' size leaves the cluster.

    The rows, four an item at most, are written down first: each stage of the pipeline reads them.
    ``stats`` hands in ``item_stats`` that is there already."""
    stats = (item_stats(series, part, by, min_periods) if stats is None else stats).filter("known").drop("mean_qty", "periods")
    rows = materialize(_seasons(series, by).join(stats, [*by]).select("qty", "p_brand", "p_type", "season", "price").dropna(), "seasons")
    names = ["p_brand", "p_type", "season"]
    steps = [StringIndexer(inputCols=names, outputCols=[f"{c}_i" for c in names], handleInvalid="keep"),
             OneHotEncoder(inputCols=[f"{c}_i" for c in names], outputCols=[f"{c}_v" for c in names], handleInvalid="keep"),
             VectorAssembler(inputCols=["price"], outputCol="_price"), StandardScaler(inputCol="_price", outputCol="price_v", withMean=True),
             VectorAssembler(inputCols=[*[f"{c}_v" for c in names], "price_v"], outputCol="features"),
             LinearRegression(labelCol="qty", regParam=ridge, solver="normal", predictionCol="forecast")]
    return Pipeline(stages=steps).fit(rows)


def attribute_forecast(series: DataFrame, part: DataFrame, by=ITEM, min_periods: int = MIN_PERIODS, digits: int = 3) -> DataFrame:
    """Weekly demand of every new item in each of the four retail quarters by ``fit_attributes``."""
    stats = materialize(item_stats(series, part, by, min_periods), "items")
    model = fit_attributes(series, part, by, min_periods, stats=stats)
    new = (stats.filter("not known").dropna(subset=["p_brand", "p_type", "price"])
           .withColumn("season", F.explode(F.array(*[F.lit(str(k)) for k in range(1, 5)]))))
    return model.transform(new).select(*by, "season", F.round("forecast", digits).alias("attribute_weekly_qty"))


def coefficients(model) -> dict[str, list[float]]:
    """Effects of brand, type, season and price in the fitted pipeline, as plain numbers."""
    index, line = model.stages[0], model.stages[-1]
    at, out = 0, {}
    for c, labels in zip(("p_brand", "p_type", "season"), index.labelsArray):
        out[c] = dict(zip(labels, line.coefficients[at: at + len(labels)].tolist()))
        at += len(labels) + 1  # and one for values unseen
    return out | {"price": float(line.coefficients[-1])}
