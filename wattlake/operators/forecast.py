"""Load forecasting with Spark ML: two models, selection, and a recursive day-ahead forecast."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import Model, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from wattlake.functions.numeric import half_up
from wattlake.operators.keyed import first_per_key
from wattlake.operators.series import (FEATURES, LOAD, SERIES, chronological_split, regression_metrics,
                                       time_features, time_parts)

# Defaults of training and of the confidence band (fixed values).
RIDGE_ALPHA = 1.0
FOREST_TREES = 100
FOREST_DEPTH = 10
SEED = 42
TRAIN_RATIO = 0.8
Z_95 = 1.96
WIDEN_PER_STEP = 0.02
DEFAULT_RMSE = 45.0
FLOOR_KW = 100.0
HORIZON = 24
NO_HISTORY_KW = 800.0

RIDGE, FOREST = "RidgeRegressor", "RandomForestRegressor"


def _assembler() -> VectorAssembler:
    return VectorAssembler(inputCols=list(FEATURES), outputCol="features")


def fit_ridge(train: DataFrame, alpha: float = RIDGE_ALPHA, label: str = LOAD) -> PipelineModel:
    """J-07: linear regression with an L2 penalty of ``alpha`` on unscaled features.

    Spark minimises the mean squared error of the label scaled by its deviation,
    so the penalty is rescaled by that deviation over the row count.
    """
    size = train.agg(F.count(label).alias("n"), F.stddev_pop(label).alias("sd")).first()
    penalty = alpha * (size["sd"] or 0.0) / size["n"]
    ridge = LinearRegression(featuresCol="features", labelCol=label, solver="normal", elasticNetParam=0.0,
                             standardization=False, regParam=penalty)
    assembler = _assembler()
    return PipelineModel([assembler, ridge.fit(assembler.transform(train))])


def ridge_moments(train: DataFrame, features: Sequence[str], keys: Sequence[str], label: str) -> DataFrame:
    """One row per series: the row count, the means, and the centred second moments of features and label.

    Moments are sums, so a series is reduced before the exchange and a long one costs its tasks nothing more.
    Rows with a null among features and label do not count.
    """
    known = train.dropna("any", subset=[*features, label])
    columns = [F.col(name).cast("double") for name in (*features, label)]
    pairs = [(i, j) for i in range(len(columns)) for j in range(i, len(columns))]
    sums = known.groupBy(*keys).agg(
        F.count("*").alias("n"), *[F.avg(column).alias(f"_m{i}") for i, column in enumerate(columns)],
        *[F.covar_pop(columns[i], columns[j]).alias(f"_c{i}_{j}") for i, j in pairs])
    place = {pair: F.col(f"_c{pair[0]}_{pair[1]}") for pair in pairs}
    size = range(len(columns))
    return sums.select(*keys, "n", F.array(*[F.col(f"_m{i}") for i in size]).alias("means"),
                       F.array(*[place[min(i, j), max(i, j)] for i in size for j in size]).alias("moments"))


def fit_ridge_per_series(train: DataFrame, keys: Sequence[str] = (SERIES,), alpha: float = RIDGE_ALPHA,
                         features: Sequence[str] = FEATURES, label: str = LOAD) -> DataFrame:
    """J-07 for many series at once: keys, n, intercept and coefficients (in the order of ``features``).

    The normal equations of all series come from one grouped aggregate; each is a small system, solved in batches.
    The penalty is ``alpha`` on the coefficients, not on the intercept, as in ``fit_ridge``.  A series without rows has
    no model.
    """
    wide = len(features) + 1

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column("n").to_numpy().astype(np.float64)
            means = batch.column("means").flatten().to_numpy().reshape(-1, wide)
            moments = batch.column("moments").flatten().to_numpy().reshape(-1, wide, wide) * n[:, None, None]
            system = moments[:, :-1, :-1] + alpha * np.eye(wide - 1)
            # a series of equal rows and no penalty has many solutions: the smallest
            weights = np.stack([np.linalg.lstsq(a, b, rcond=None)[0] for a, b in zip(system, moments[:, :-1, -1])]) \
                if len(n) else np.zeros((0, wide - 1))
            bias = means[:, -1] - (means[:, :-1] * weights).sum(1)
            offsets = pa.array(np.arange(len(n) + 1) * (wide - 1), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(key) for key in keys], batch.column("n"), pa.array(bias, pa.float64()),
                 pa.ListArray.from_arrays(offsets, pa.array(weights.ravel(), pa.float64()))],
                [*keys, "n", "intercept", "coefficients"])

    found = ridge_moments(train, features, keys, label)
    shape = StructType([*[found.schema[key] for key in keys], *[StructField(name, kind) for name, kind in (
        ("n", LongType()), ("intercept", DoubleType()), ("coefficients", ArrayType(DoubleType())))]])
    return found.mapInArrow(solve, shape)


def predict_ridge(rows: DataFrame, models: DataFrame, keys: Sequence[str] = (SERIES,),
                  features: Sequence[str] = FEATURES) -> DataFrame:
    """Rows with the ``prediction`` of their series' model; null without a model or with a null feature."""
    total = F.col("_intercept")
    for place, name in enumerate(features):
        total = total + F.col("_coefficients")[place] * F.col(name).cast("double")
    named = models.select(*keys, F.col("intercept").alias("_intercept"), F.col("coefficients").alias("_coefficients"))
    return rows.join(named, list(keys), "left").withColumn("prediction", total).drop("_intercept", "_coefficients")


def compare_per_series(predictions: dict[str, DataFrame], keys: Sequence[str] = (SERIES,), label: str = LOAD) -> DataFrame:
    """J-10 for many series: the test metrics of each named model, a row per series and model, and which one is chosen.

    The lower RMSE is chosen, of equal ones the name that comes first in ``predictions``; a model without an RMSE last.
    """
    parts = [regression_metrics(rows.where(F.col("prediction").isNotNull() & F.col(label).isNotNull()), label, keys=keys)
             .withColumns({"model": F.lit(name), "_place": F.lit(place)}) for place, (name, rows) in enumerate(predictions.items())]
    together = parts[0]
    for part in parts[1:]:
        together = together.unionByName(part)
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(F.asc_nulls_last("RMSE"), "_place"))
    return together.withColumn("chosen", first == 1).drop("_place")


def fit_forest(train: DataFrame, trees: int = FOREST_TREES, depth: int = FOREST_DEPTH, seed: int = SEED,
               label: str = LOAD, max_bins: int = 128) -> PipelineModel:
    """J-08: random forest over all features."""
    forest = RandomForestRegressor(featuresCol="features", labelCol=label, numTrees=trees, maxDepth=depth,
                                   seed=seed, featureSubsetStrategy="all", maxBins=max_bins)
    assembler = _assembler()
    return PipelineModel([assembler, forest.fit(assembler.transform(train))])


@dataclass(frozen=True)
class Forecaster:
    """The selected model with its name and test metrics."""

    name: str
    model: Model
    metrics: dict[str, float]
    compared: dict[str, dict[str, float]]
    test_samples: int

    def save(self, path: str) -> None:
        """Writes the model and, next to it, one row with name, metrics and features."""
        self.model.write().overwrite().save(f"{path}/model")
        spark = SparkSession.active()
        info = [(self.name, *[self.metrics[key] for key in ("MAE", "RMSE", "MAPE")], list(FEATURES),
                 self.test_samples)]
        spark.createDataFrame(info, "name string, MAE double, RMSE double, MAPE double, "
                                    "features array<string>, test_samples bigint") \
            .coalesce(1).write.mode("overwrite").parquet(f"{path}/info")


def load_forecaster(path: str) -> Forecaster:
    """J-10: the saved model with its metrics."""
    info = SparkSession.active().read.parquet(f"{path}/info").first()
    metrics = {key: info[key] for key in ("MAE", "RMSE", "MAPE")}
    return Forecaster(info["name"], PipelineModel.load(f"{path}/model"), metrics, {info["name"]: metrics},
                      info["test_samples"])


def select_model(series: DataFrame, ratio: float = TRAIN_RATIO, alpha: float = RIDGE_ALPHA,
                 trees: int = FOREST_TREES, depth: int = FOREST_DEPTH, seed: int = SEED,
                 means_from: str = "all") -> Forecaster:
    """J-10: trains both models on the first part of the series and keeps the one with the lower RMSE.

    A tie goes to the forest.  Only the metric rows come to the driver.
    """
    known = time_features(series.where(F.col(LOAD).isNotNull()), means_from=means_from)
    rows = chronological_split(known.dropna("any", subset=list(FEATURES)), ratio).persist()
    try:
        train, test = rows.where("is_train"), rows.where("NOT is_train")
        models = {FOREST: fit_forest(train, trees, depth, seed), RIDGE: fit_ridge(train, alpha)}
        compared, samples = {}, 0
        for name, model in models.items():
            found = regression_metrics(model.transform(test)).first()
            compared[name] = {key: found[key] for key in ("MAE", "RMSE", "MAPE")}
            samples = found["test_samples"]
    finally:
        rows.unpersist()
    best = min(models, key=lambda name: compared[name]["RMSE"])  # the forest comes first, so it wins ties
    return Forecaster(best, models[best], compared[best], compared, samples)


def recent_history(series: DataFrame, keys: Sequence[str] = (SERIES,), n: int = HORIZON) -> DataFrame:
    """The last time and the last ``n`` known loads of each series as an array, oldest first.

    Hours without a load do not count as history, as in training; the last time is that of any row.
    """
    known = F.col(LOAD).isNotNull()
    tail = first_per_key(series, keys, [F.desc(known), F.desc("ds")], n)
    ordered = F.array_sort(F.collect_list(F.when(known, F.struct("ds", LOAD))))  # at most n entries
    loads = tail.groupBy(*keys).agg(F.transform(ordered, lambda row: row[LOAD]).alias("history"))
    ends = series.groupBy(*keys).agg(F.max("ds").alias("last_ds"))
    return ends.join(loads, list(keys)).select(*keys, "last_ds", "history")


def forecast_24h(model: Model, series: DataFrame, keys: Sequence[str] = (SERIES,), rmse: float = DEFAULT_RMSE,
                 horizon: int = HORIZON, floor_kw: float = FLOOR_KW, start_time: str | None = None,
                 rmse_of: DataFrame | None = None) -> DataFrame:
    """J-11: recursive forecast of the next hours of every series.

    The first hour is ``start_time``, or the hour after the series' last one.  ``rmse_of`` gives each series
    its own error (columns ``keys`` and RMSE; one without it has ``rmse``).  The floor of 100 kW is that of
    the whole campus; name another one for smaller series.

    A series is one row holding its last day of loads.  Each step adds the
    features of the next hour, applies the model and appends its prediction to
    the loads, which later steps read as lags.  The steps are narrow projections
    of one plan: thousands of series advance in parallel without a shuffle, and
    nothing leaves the JVM.
    """
    state = recent_history(series, keys, HORIZON).withColumnRenamed("history", "loads")
    if start_time is not None:
        first = F.lit(start_time).cast(series.schema["ds"].dataType)
        state = state.withColumn("last_ds", first - F.expr("INTERVAL '1' HOUR"))
    for step in range(horizon):
        at = F.col("last_ds") + F.expr(f"INTERVAL '{step + 1}' HOUR")
        newest = F.coalesce(F.try_element_at("loads", F.lit(-1)), F.lit(NO_HISTORY_KW))
        state = state.withColumns({
            **time_parts(at), "lag_1": newest,
            "lag_24": F.coalesce(F.try_element_at("loads", F.lit(-24)), newest)})
        predicted = F.greatest(F.lit(float(floor_kw)), half_up("prediction", 2))
        state = model.transform(state).select(
            *keys, "last_ds", F.concat("loads", F.array(predicted)).alias("loads"))
    rows = state.select(*keys, "last_ds", F.posexplode(F.slice("loads", F.lit(-horizon), F.lit(horizon)))
                        .alias("step", "predicted_load_kw"))
    at = F.expr("last_ds + make_dt_interval(0, step + 1)")
    rows = rows.select(*keys, at.alias("forecast_time"), F.hour(at).alias("hour_of_day"),
                       "step", "predicted_load_kw")
    if rmse_of is None:
        return confidence_band(rows, rmse).drop("step")
    errors = rmse_of.select(*keys, F.col("RMSE").alias("_rmse"))
    return confidence_band(rows.join(errors, list(keys), "left"), F.coalesce("_rmse", F.lit(float(rmse)))) \
        .drop("step", "_rmse")


def confidence_band(forecast: DataFrame, rmse: float | Column = DEFAULT_RMSE) -> DataFrame:
    """J-12: 95 % limits that widen by 2 % a step; the lower one is floored at 0."""
    error = F.lit(float(rmse)) if isinstance(rmse, (int, float)) else rmse
    margin = half_up(F.lit(Z_95) * error * (F.lit(1.0) + F.col("step") * F.lit(WIDEN_PER_STEP)), 2)
    load = F.col("predicted_load_kw")
    return forecast.withColumns({
        "lower_ci_95": F.greatest(F.lit(0.0), half_up(load - margin, 2)),
        "upper_ci_95": half_up(load + margin, 2),
    })
