"""Speed models on Spark ML: training, evaluation, scoring and the run record."""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streetflow.functions.time import hour_of_day, sunday_weekday, unix_seconds
from streetflow.operators.aggregates import regression_errors
from streetflow.operators.contracts import PREDICTIONS, broken
from streetflow.operators.windows import FEATURES

# Seed, train share in percent, baseline size, rounds, learning rate, model version.
SEED = 42
TRAIN_PERCENT = 80
BASELINE_FEATURES = ["hour", "day_of_week", "ts_numeric"]
BASELINE_ROUNDS, BASELINE_DEPTH = 20, 5
ROUNDS = 400
LEARNING_RATE = 0.05
MODEL_VERSION = "gbt_speed_v1"


def baseline_features(df: DataFrame, ts: str = "ts") -> DataFrame:
    t = F.col(ts)
    return df.withColumns({"hour": hour_of_day(t), "day_of_week": sunday_weekday(t), "ts_numeric": unix_seconds(t)})


def baseline_model(rounds: int = BASELINE_ROUNDS, depth: int = BASELINE_DEPTH) -> Pipeline:
    """Assemble, standardise, boosted trees (M1)."""
    return Pipeline(stages=[
        VectorAssembler(inputCols=BASELINE_FEATURES, outputCol="raw_features"),
        StandardScaler(inputCol="raw_features", outputCol="scaled_features", withMean=True, withStd=True),
        GBTRegressor(featuresCol="scaled_features", labelCol="speed", maxIter=rounds, maxDepth=depth, seed=SEED)])


def _bucket(key: Sequence[tuple[str, str]], seed: int) -> Column:
    """0 to 99 by the checksum of key and seed, times as microseconds."""
    parts = [F.unix_micros(c) if kind == "timestamp" else F.col(c) for c, kind in key]
    digest = F.md5(F.concat_ws("|", *[p.cast("string") for p in parts], F.lit(str(seed))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % 100


def _typed(df: DataFrame, names: Sequence[str]) -> list[tuple[str, str]]:
    kinds = dict(df.dtypes)
    return [(c, kinds[c]) for c in names]


def hash_split(df: DataFrame, key: Sequence[str], percent: int = TRAIN_PERCENT, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """Train and test rows by a hash of the row's key (M2): the same rows on every run and layout."""
    bucket = _bucket(_typed(df, key), seed)
    return df.filter(bucket < percent), df.filter(bucket >= percent)


def train_speed(df: DataFrame, key: Sequence[str], rounds: int = ROUNDS, depth: int = 6,
                rate: float = LEARNING_RATE, validation_percent: int = 10) -> PipelineModel:
    """Boosted trees on the seven features (M3).

    Training stops early on a validation share of its own, not on the test rows; `rounds` is the most it takes.
    """
    assembled = VectorAssembler(inputCols=FEATURES, outputCol="features")
    trees = GBTRegressor(featuresCol="features", labelCol="speed", maxIter=rounds, maxDepth=depth, stepSize=rate,
                         validationIndicatorCol="is_validation", minInstancesPerNode=50, seed=SEED)
    marked = df.withColumn("is_validation", _bucket(_typed(df, key), SEED + 1) < validation_percent)
    return Pipeline(stages=[assembled, trees]).fit(marked)


def evaluate(predictions: DataFrame, label: str = "speed", prediction: str = "prediction") -> DataFrame:
    """RMSE, MAE, R2 and row count (M4)."""
    return regression_errors(predictions, label, prediction)


def importances(model: PipelineModel, names: Sequence[str] = tuple(FEATURES)) -> list[tuple[str, float]]:
    return list(zip(names, model.stages[-1].featureImportances.toArray().tolist()))


def importance_table(df: DataFrame, model: PipelineModel, names: Sequence[str] = tuple(FEATURES)) -> DataFrame:
    """One row per feature (M5)."""
    return df.sparkSession.createDataFrame(importances(model, names), "feature string, importance double")


def prediction_rows(predictions: DataFrame) -> DataFrame:
    """Batch predictions table (M6)."""
    return predictions.select("sensor_id", F.col("ts").alias("timestamp"), "speed", "prediction")


def save_model(model: PipelineModel, path: str) -> None:
    """Save, replacing what was there (K9)."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def run_record(model: PipelineModel, scored: DataFrame, n_train: int, seconds: float,
               names: Sequence[str] = tuple(FEATURES), version: str = MODEL_VERSION) -> DataFrame:
    """One row about a training run: parameters, errors, sizes, features, importances."""
    last = model.stages[-1]
    params = {p.name: str(v) for p, v in last.extractParamMap().items()}
    spark = scored.sparkSession
    head = spark.createDataFrame(
        [(version, time.time(), params, n_train, float(seconds), list(names), dict(importances(model, names)))],
        "model_version string, trained_at double, params map<string,string>, n_train bigint, train_seconds double,"
        " features array<string>, importances map<string,double>")
    errors = evaluate(scored).withColumnRenamed("n", "n_test")
    return head.withColumns({c: errors.select(c).scalar() for c in ("rmse", "mae", "r2", "n_test")})


def output_records(scored: DataFrame, version: str = MODEL_VERSION, micros: Column | None = None) -> DataFrame:
    """Scored readings as prediction messages of eight fields.

    The horizon is 0: the value estimates the current reading from the ones before it.
    """
    return scored.select(
        "sensor_id", F.col("ts").cast("string").alias("timestamp"), F.col("speed").cast("double").alias("actual_speed"),
        F.col("prediction").alias("predicted_speed"), F.lit(0).alias("horizon_minutes"),
        F.lit(version).alias("model_version"),
        (F.lit(None).cast("double") if micros is None else micros).alias("inference_us"),
        (F.unix_micros(F.current_timestamp()) / 1e6).alias("processed_at"))


def keep_valid(records: DataFrame) -> DataFrame:
    """Records that keep the prediction contract; the others count as `output_invalid`."""
    return records.filter(~broken(records.schema, PREDICTIONS))
