"""Model training, split, record."""

import pytest
from pyspark.sql import functions as F

from streetflow.operators import model
from streetflow.operators.windows import FEATURES, speed_features


@pytest.fixture(scope="module")
def readings(spark):
    """A daily wave with sensor-specific height."""
    n = F.col("id")
    return spark.range(3000).select(
        (n % 5).cast("string").alias("sensor_id"), F.timestamp_seconds(F.floor(n / 5) * 300).alias("ts"),
        (40 + n % 5 + 20 * F.sin(n / 5 / 288 * 6.283)).alias("speed")).cache()


def test_split_is_stable(readings):
    train, test = model.hash_split(readings, ("sensor_id", "ts"))
    assert train.count() + test.count() == 3000 and abs(test.count() - 600) < 90
    again = model.hash_split(readings.repartition(7), ("sensor_id", "ts"))[1]
    assert test.exceptAll(again).count() == 0


def test_speed_model_learns(spark, readings):
    train, test = model.hash_split(speed_features(readings), ("sensor_id", "ts"))
    fitted = model.train_speed(train, ("sensor_id", "ts"), rounds=60, depth=4, rate=0.2)
    scored = fitted.transform(test)
    errors = model.evaluate(scored).first()
    assert errors.r2 > 0.9 and errors.n == test.count()
    table = {r.feature: r.importance for r in model.importance_table(readings, fitted).collect()}
    assert list(table) == FEATURES and sum(table.values()) == pytest.approx(1.0)
    record = model.run_record(fitted, scored, train.count(), 1.5).first()
    assert (record.n_test, record.train_seconds, record.features) == (test.count(), 1.5, FEATURES)
    assert record.rmse == pytest.approx(errors.rmse) and record.params["maxDepth"] == "4"


def test_baseline(readings):
    train, test = model.hash_split(model.baseline_features(readings), ("sensor_id", "ts"))
    fitted = model.baseline_model(rounds=3, depth=2).fit(train)
    rows = model.prediction_rows(fitted.transform(test))
    assert rows.columns == ["sensor_id", "timestamp", "speed", "prediction"] and rows.count() == test.count()
    assert fitted.stages[1].mean[0] > 0
