"""Walk-forward forecasting of monthly counts: folds, models, blends, metrics and bands."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, GeneralizedLinearRegression
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sedimenta.operators.ordered import quantiles


def folds(panel: DataFrame, month: str, target: str, cutoffs: Sequence[str], horizon: int = 3) -> DataFrame:
    """Rows by fold and role: TRAIN if the month's target was complete at the cutoff, TEST in the cutoff's month.

    The cutoffs are a handful of literals; each row is matched with them by a range condition, without a shuffle.
    """
    spark = panel.sparkSession
    table = spark.createDataFrame([(c,) for c in cutoffs], "cutoff string").select(F.to_date("cutoff").alias("cutoff"))
    train = (F.col(month) <= F.add_months("cutoff", -horizon)) & F.col(target).isNotNull()
    test = F.col(month) == F.col("cutoff")
    return panel.join(F.broadcast(table), train | test).withColumn("role", F.when(test, "TEST").otherwise("TRAIN"))


def blend(poisson: Column, naive: Column, weight: float = 0.7) -> Column:
    """A weighted mean of two forecasts, neither below zero."""
    return weight * F.greatest(poisson, F.lit(0.0)) + (1 - weight) * F.greatest(naive, F.lit(0.0))


def model_pipeline(kind: str, categories: Sequence[str], features: Sequence[str], target: str, **options) -> Pipeline:
    """One-hot categories and numeric features into a regressor: 'poisson', 'tweedie' (variance power 1.3) or 'squared' (boosted trees)."""
    stages = [StringIndexer(inputCols=list(categories), outputCols=[f"{c}_ix" for c in categories], handleInvalid="keep"), OneHotEncoder(inputCols=[f"{c}_ix" for c in categories], outputCols=[f"{c}_hot" for c in categories], handleInvalid="keep")]
    stages.append(VectorAssembler(inputCols=[*[f"{c}_hot" for c in categories], *features], outputCol="features", handleInvalid="keep"))
    if kind == "squared":
        stages.append(GBTRegressor(labelCol=target, featuresCol="features", maxDepth=5, stepSize=0.05, seed=42, **({"maxIter": 40} | options)))
    elif kind == "poisson":
        stages.append(GeneralizedLinearRegression(labelCol=target, featuresCol="features", family="poisson", link="log", regParam=0.1, **({"maxIter": 25} | options)))
    else:
        stages.append(GeneralizedLinearRegression(labelCol=target, featuresCol="features", family="tweedie", variancePower=1.3, linkPower=0.0, regParam=0.1, **({"maxIter": 25} | options)))
    return Pipeline(stages=stages)


def fit_and_predict(train: DataFrame, test: DataFrame, kinds: Sequence[str], categories: Sequence[str], features: Sequence[str], target: str, **options) -> tuple[DataFrame, dict[str, PipelineModel]]:
    """test with a forecast column for each kind, none below zero; and the fitted pipelines, which share their first stages."""
    stages = {k: model_pipeline(k, categories, features, target, **options).getStages() for k in kinds}
    prepared = Pipeline(stages=stages[kinds[0]][:-1]).fit(train)
    ready, out = prepared.transform(train), prepared.transform(test)
    fitted = {k: stages[k][-1].fit(ready) for k in kinds}
    for k, m in fitted.items():
        out = m.transform(out).withColumn(k, F.greatest(F.col("prediction"), F.lit(0.0))).drop("prediction")
    return out.select(*test.columns, *kinds), {k: PipelineModel([*prepared.stages, m]) for k, m in fitted.items()}


def walk_forward(train: DataFrame, test: DataFrame, fold: str, kinds: Sequence[str], categories: Sequence[str], features: Sequence[str], target: str, **options) -> tuple[DataFrame, dict[object, dict[str, PipelineModel]]]:
    """test with a forecast column for each kind, each row by pipelines fitted to the training rows of its own fold; and those pipelines by fold.

    A fold without training rows forecasts zero. Folds are fitted one after another: at once they would crowd the driver.
    """
    learn = sorted(r[0] for r in train.select(fold).distinct().collect())
    out, models = test.where(~F.col(fold).isin(learn)).withColumns({k: F.lit(0.0) for k in kinds}), {}
    for value in learn:
        own = F.col(fold) == F.lit(value)
        forecast, models[value] = fit_and_predict(train.where(own), test.where(own), kinds, categories, features, target, **options)
        out = out.unionByName(forecast)
    return out, models


def metrics(predictions: DataFrame, group: Sequence[str], actual: str, model_columns: Sequence[str], tie: Sequence[str], top_share: float = 0.10) -> DataFrame:
    """(group..., model, mae, rmse, wape, top_capture, top_lift): errors, and the share of actuals among the top tenth of forecasts, ties by the given columns."""
    parts = []
    for m in model_columns:
        p = F.greatest(F.col(m), F.lit(0.0))
        parts.append(predictions.select(*group, *tie, F.col(actual).cast("double").alias("__y"), p.cast("double").alias("__p"), F.lit(m).alias("model")))
    long = reduce(DataFrame.unionByName, parts)
    keys = [*group, "model"]
    by = Window.partitionBy(*keys)
    placed = long.withColumn("__place", F.row_number().over(by.orderBy(F.desc("__p"), *tie))).withColumn("__n", F.count("*").over(by))
    error, total = F.abs(F.col("__y") - F.col("__p")), F.greatest(F.sum("__y"), F.lit(1.0))
    top = F.sum(F.when(F.col("__place") <= F.greatest(F.lit(1), F.ceil(F.col("__n") * F.lit(top_share))), F.col("__y"))) / total
    return placed.groupBy(*keys).agg(F.avg(error).alias("mae"), F.sqrt(F.avg(error * error)).alias("rmse"), (F.sum(error) / total).alias("wape"), top.alias("top_capture"), (top / top_share).alias("top_lift"))


def best_model(fold_metrics: DataFrame, baseline: str, measure: str = "wape") -> DataFrame:
    """(best, best_value, baseline_value, improvement): the model of the least mean, and what it gains on the baseline."""
    mean = fold_metrics.groupBy("model").agg(F.avg(measure).alias("m"))
    out = mean.agg(F.min_by("model", F.struct("m", "model")).alias("best"), F.min("m").alias("best_value"), F.max(F.when(F.col("model") == baseline, F.col("m"))).alias("baseline_value"))
    return out.withColumn("improvement", (F.col("baseline_value") - F.col("best_value")) / F.nullif(F.col("baseline_value"), F.lit(0.0)))


def residual_band(history: DataFrame, future: DataFrame, key: str, actual: str, forecast: str, q: float = 0.90) -> DataFrame:
    """future with a band of the q-quantile of absolute residuals by key, not below zero, and whether it covers the actual."""
    width = quantiles(history.select(key, F.abs(F.col(actual) - F.col(forecast)).alias("__off")), [key], "__off", q)
    out = future.join(width.withColumnRenamed("quantile", "band"), key, "left")
    out = out.withColumns({"band_low": F.greatest(F.col(forecast) - F.col("band"), F.lit(0.0)), "band_high": F.col(forecast) + F.col("band")})
    return out.withColumn("covered", F.col(actual).between(F.col("band_low"), F.col("band_high")))


def seasonality(counts: DataFrame, month: str, source: str, value: str) -> DataFrame:
    """Mean value by month of year and source, over the rows that exist."""
    return counts.groupBy(F.month(month).cast("long").alias("month_of_year"), source).agg(F.avg(value).alias("mean_value"))


def importances(model: PipelineModel, frame: DataFrame) -> list[tuple[str, float]]:
    """(feature, importance) of a boosted model, largest first; names come from the assembled vector's metadata."""
    attributes = model.transform(frame.limit(1)).schema["features"].metadata["ml_attr"]["attrs"]
    names = {a["idx"]: a["name"] for group in attributes.values() for a in group}
    values = model.stages[-1].featureImportances
    return sorted(((names.get(i, str(i)), float(values[i])) for i in range(values.size)), key=lambda x: (-x[1], x[0]))
