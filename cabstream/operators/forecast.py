"""Demand model: training, evaluation, batch forecasts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cabstream.operators.features import FEATURE_COLUMNS, SLOT, add_calendar_features
from cabstream.operators.latest import latest_per_key

LABEL = "demand_count"
# Stand-ins for features a zone's latest row lacks.
FORECAST_DEFAULTS = {
    "population_density": 5000.0, "is_residential": 0.0, "is_commercial": 0.0,
    "is_industrial": 0.0, "is_transit_hub": 0.0, "temperature_2m": 20.0, "rain": 0.0,
    "is_raining": 0.0, "temp_cold": 0.0, "temp_hot": 0.0, "temp_mild": 1.0,
    "demand_lag_1d": 10.0, "demand_lag_7d": 12.0, "rolling_7d_mean": 11.5,
}


def as_model_input(features: DataFrame, columns: Sequence[str] = FEATURE_COLUMNS) -> DataFrame:
    """Cast the model inputs to double."""
    return features.withColumns({c: F.col(c).cast("double") for c in columns})


def demand_estimator(columns: Sequence[str] = FEATURE_COLUMNS, max_iter: int = 50,
                    max_depth: int = 5, seed: int = 42) -> Pipeline:
    """Assemble (rows with invalid inputs are skipped), scale by deviation only, boost trees."""
    return Pipeline(stages=[
        VectorAssembler(inputCols=list(columns), outputCol="rawFeatures", handleInvalid="skip"),
        StandardScaler(inputCol="rawFeatures", outputCol="scaledFeatures", withStd=True,
                       withMean=False),
        GBTRegressor(featuresCol="scaledFeatures", labelCol=LABEL, maxIter=max_iter,
                     maxDepth=max_depth, seed=seed),
    ])


def month_fold(folds: int = 3, month: str = "year_month") -> Column:
    """Fold number by calendar month, so that neighbouring slots stay in one fold."""
    year, number = F.substring(month, 1, 4).cast("int"), F.substring(month, 6, 2).cast("int")
    return F.pmod(year * 12 + number, F.lit(folds)).cast("int")


def cross_validate(train: DataFrame, depths: Sequence[int] = (5, 7), folds: int = 3,
                   max_iter: int = 50, by_month: bool = True, parallelism: int = 2,
                   columns: Sequence[str] = FEATURE_COLUMNS) -> CrossValidatorModel:
    """Pick the tree depth by RMSE over folds; random folds leak time and are the option."""
    pipeline = demand_estimator(columns, max_iter)
    gbt = pipeline.getStages()[-1]
    cv = CrossValidator(
        estimator=pipeline, numFolds=folds, parallelism=parallelism, seed=42,
        estimatorParamMaps=ParamGridBuilder().addGrid(gbt.maxDepth, list(depths)).build(),
        evaluator=RegressionEvaluator(labelCol=LABEL, metricName="rmse"))
    data = as_model_input(train, columns)
    if by_month:
        data = data.withColumn("fold", month_fold(folds))
        cv.setFoldCol("fold")
    return cv.fit(data)


def forecast_metrics(predictions: DataFrame, label: str = LABEL, prediction: str = "prediction",
                     baseline: str = "demand_lag_7d") -> DataFrame:
    """RMSE and MAE of the model, RMSE of the seven-day lag, and whether the model wins."""
    error, naive = F.col(label) - F.col(prediction), F.col(label) - F.col(baseline)
    return predictions.agg(
        F.count(F.lit(1)).alias("rows"), F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"), F.sqrt(F.avg(naive * naive)).alias("baseline_rmse"),
    ).withColumn("beats_baseline", F.col("rmse") < F.col("baseline_rmse"))


def zone_metrics(predictions: DataFrame, label: str = LABEL, prediction: str = "prediction",
                 baseline: str = "demand_lag_7d") -> DataFrame:
    """Model and baseline RMSE per zone."""
    error, naive = F.col(label) - F.col(prediction), F.col(label) - F.col(baseline)
    return predictions.groupBy("zone_id").agg(
        F.sqrt(F.avg(error * error)).alias("model_rmse"),
        F.sqrt(F.avg(naive * naive)).alias("baseline_rmse"))


def feature_importances(model: PipelineModel, spark: SparkSession,
                        columns: Sequence[str] = FEATURE_COLUMNS) -> DataFrame:
    """Importance of every model input, largest first."""
    weights = model.stages[-1].featureImportances.toArray()
    rows = sorted(zip(columns, (float(w) for w in weights), strict=True), key=lambda r: (-r[1], r[0]))
    return spark.createDataFrame(
        [(place, name, weight) for place, (name, weight) in enumerate(rows, 1)],
        "place INT, feature STRING, importance DOUBLE")


def forecast_inputs(features: DataFrame, at: Column, zones: DataFrame | None = None) -> DataFrame:
    """One input row per zone: its latest features with the calendar of ``at``.

    Zones without any feature row get the defaults; training and forecasting
    use the same weekday numbering (1 = Sunday).
    """
    latest = latest_per_key(features, ["zone_id"], [SLOT])
    if zones is not None:
        latest = zones.select("zone_id").join(latest, "zone_id", "left")
    rows = latest.withColumn(SLOT, F.date_trunc("second", at.cast("timestamp")))
    typed = as_model_input(add_calendar_features(rows))
    return typed.fillna(FORECAST_DEFAULTS)


def forecast_zones(features: DataFrame, model: PipelineModel, at: Column,
                   zones: DataFrame | None = None) -> DataFrame:
    """Forecast of every zone in one distributed scoring pass, rounded to two digits."""
    scored = model.transform(forecast_inputs(features, at, zones))
    return scored.select(F.col("zone_id").cast("int").alias("zone_id"),
                         F.col(SLOT).alias("window_start"),
                         F.round("prediction", 2).alias("forecasted_demand"))


def forecast_vs_actual(actual: DataFrame, forecast: DataFrame, on: Sequence[str] = ("zone_id", "window_start"),
                       value: str = "pending_requests") -> DataFrame:
    """Forecast next to the observed demand; slots without a forecast keep null."""
    joined = actual.join(forecast.select(*on, "forecasted_demand"), list(on), "left")
    return joined.withColumn("error", F.col("forecasted_demand") - F.col(value))


def forecast_errors(compared: DataFrame) -> DataFrame:
    """Mean error and mean absolute error per zone over the slots that had a forecast."""
    return compared.filter(F.col("error").isNotNull()).groupBy("zone_id").agg(
        F.count(F.lit(1)).alias("slots"), F.avg("error").alias("bias"),
        F.avg(F.abs("error")).alias("mae"))


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
