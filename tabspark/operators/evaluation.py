"""Cohorts, baselines, calibrated intervals and error metrics of forecasts; a boosted model on top if wanted."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabspark.functions.mathx import interval, robust_scale
from tabspark.operators.aggs import error_metrics, exact_quantiles


def cohort(prior: Column, target: Column, baseline: Column, least_prior: int = 10, role: Column | None = None) -> Column:
    ok = (prior >= least_prior) & target.isNotNull() & baseline.isNotNull()
    return F.coalesce(ok & role if role is not None else ok, F.lit(False))


def check_split_sizes(df: DataFrame, split: str, labels: Sequence[str], least: int = 50) -> None:
    sizes = {r[0]: r[1] for r in df.groupBy(split).count().collect()}  # one row per split
    small = {x: sizes.get(x, 0) for x in labels if sizes.get(x, 0) < least}
    if small:
        raise ValueError(f"splits are too small: {small}")


def calibrated(df: DataFrame, split: str, calibration: str, test: str, actual: str, predicted: str, std: str, coverage: float = 0.8) -> DataFrame:
    """Test rows with low and high: the prediction plus quantiles of the calibration residuals in units of a robust scale.

    The fallback scale is the calibration's root mean squared error.
    """
    tail = (1 - coverage) / 2
    cal = df.filter(F.col(split) == calibration)
    fallback = cal.agg(F.sqrt(F.avg(F.pow(F.col(actual) - F.col(predicted), 2))).alias("__fallback"))  # one row
    scaled = cal.crossJoin(F.broadcast(fallback)).select(((F.col(actual) - F.col(predicted)) / robust_scale(F.col(std), F.col("__fallback"))).alias("r"))
    qs = exact_quantiles(scaled.withColumn("__all", F.lit(1)), ["__all"], "r", [tail, 1 - tail]).select(F.col("quantiles").alias("__q")).crossJoin(fallback)  # one row
    out = df.filter(F.col(split) == test).crossJoin(F.broadcast(qs))
    low, high = interval(F.col(predicted), robust_scale(F.col(std), F.col("__fallback")), F.col("__q")[0], F.col("__q")[1])
    return out.withColumn("low", low).withColumn("high", high).drop("__q", "__fallback")


def interval_metrics(df: DataFrame, actual: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    covered = F.avg(F.col(actual).between(F.col("low"), F.col("high")).cast("double"))
    return df.groupBy(*by).agg(*error_metrics(F.col(actual), F.col(predicted)), covered.alias("coverage"), F.avg(F.col("high") - F.col("low")).alias("width"))


# The settings of the boosted trees.
def boosted(train: DataFrame, features: Sequence[str], target: str, seed: int = 41, rounds: int = 90):
    """Pipeline of median imputation with missing flags and gradient-boosted trees, fitted on all rows of train."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import Imputer, VectorAssembler
    from pyspark.ml.regression import GBTRegressor

    filled = [f"{f}__filled" for f in features]
    stages = [
        Imputer(strategy="median", inputCols=list(features), outputCols=filled),
        VectorAssembler(inputCols=filled, outputCol="__features", handleInvalid="skip"),
        GBTRegressor(featuresCol="__features", labelCol=target, maxIter=rounds, maxDepth=4, stepSize=0.07, minInstancesPerNode=50, maxBins=127, seed=seed),
    ]
    return Pipeline(stages=stages).fit(train)


def yearly_gain(df: DataFrame, at: str, actual: str, baseline: str, predicted: Column, eligible: Column, least: int = 50) -> DataFrame:
    """(year, n, baseline_mae, model_mae, mae_gain_pct, enough): per year, over eligible rows with a known value and baseline."""
    rows = df.withColumn("__p", predicted).filter(F.coalesce(eligible, F.lit(False)) & F.col(actual).isNotNull() & F.col(baseline).isNotNull())
    base, model = F.avg(F.abs(F.col(baseline) - F.col(actual))), F.avg(F.abs(F.col("__p") - F.col(actual)))
    return rows.groupBy(F.year(at).alias("year")).agg(F.count("*").alias("n"), F.round(base, 6).alias("baseline_mae"), F.round(model, 6).alias("model_mae"), F.round(100 * (1 - model / base), 4).alias("mae_gain_pct"), (F.count("*") >= least).alias("enough"))
