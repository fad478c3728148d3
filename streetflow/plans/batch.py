"""Batch jobs: road-graph tables, sensor places, speed model."""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from streetflow.operators import graph, model
from streetflow.operators.windows import speed_features
from streetflow.session import stage
from streetflow.sinks.tables import append_once, write_snapshot
from streetflow.sources.sensors import sensor_metadata


def build_graph_tables(vertices: DataFrame, edges: DataFrame, root: str,
                       landmarks: Sequence[str] = graph.LANDMARKS) -> DataFrame:
    """Write `graph_pagerank` and `graph_shortest_paths`; returns the graph's figures."""
    root = root.rstrip("/")
    edges = stage(edges)
    write_snapshot(graph.pagerank_table(graph.pagerank(vertices, edges)), f"{root}/graph_pagerank")
    hops = graph.hops_to(vertices, edges, landmarks)
    write_snapshot(graph.distance_maps(vertices, hops, landmarks), f"{root}/graph_shortest_paths")
    return graph.graph_stats(vertices, edges)


def build_sensor_metadata(spark: SparkSession, root: str, csv_paths: Sequence[str], ids: DataFrame | None = None) -> None:
    write_snapshot(sensor_metadata(spark, csv_paths, ids), f"{root.rstrip('/')}/sensor_metadata")


def train(readings: DataFrame, root: str, run_id: int, key: Sequence[str] = ("sensor_id", "ts"),
          rounds: int = 100) -> PipelineModel:
    """Features, split, fit, score; saves the model and appends the run record.

    `readings(sensor_id, ts, speed)`. The features are stored once: every boosting round reads
    them again.
    """
    started = time.time()
    features = stage(speed_features(readings, order=tuple(k for k in key if k != "sensor_id")))
    train_rows, test_rows = model.hash_split(features, key)
    fitted = model.train_speed(train_rows, key, rounds=rounds)
    record = model.run_record(fitted, fitted.transform(test_rows), train_rows.count(), time.time() - started)
    root = root.rstrip("/")
    model.save_model(fitted, f"{root}/models/speed_predictor")
    append_once(record, f"{root}/model_runs", run_id)
    return fitted


def train_baseline(readings: DataFrame, root: str, key: Sequence[str] = ("sensor_id", "ts")) -> PipelineModel:
    """The baseline on time features alone; saves model and predictions."""
    train_rows, test_rows = model.hash_split(model.baseline_features(readings), key)
    fitted = model.baseline_model().fit(train_rows)
    root = root.rstrip("/")
    model.save_model(fitted, f"{root}/models/speed_baseline")
    write_snapshot(model.prediction_rows(fitted.transform(test_rows)), f"{root}/baseline_predictions")
    return fitted
