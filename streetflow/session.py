"""Settings shared by every job: time zone, lineage cuts and the scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def prepare(spark: SparkSession) -> SparkSession:
    """Fix the session time zone, so that hours, weekdays and dates mean UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local session without the setting gets a folder of its own; on a cluster a
    missing setting is an error, because executors could not read each other's files.
    """
    sc = spark.sparkContext
    folder = spark.conf.get(CHECKPOINT_DIR, None) or sc.getConf().get(CHECKPOINT_DIR, None)
    folder = folder or sc.getCheckpointDir()
    if not folder:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="streetflow-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(folder)
    return folder


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame) -> DataFrame:
    """Write `df` once to the shared folder and go on from the stored rows.

    The stored rows survive lost executors, cut the lineage of iterative jobs and pin the
    outcome of sampling.
    """
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def store(df: DataFrame, name: str) -> DataFrame:
    """As `stage`, in columns: faster to write and to read again where the rows' partitioning does not matter."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def fixed_partitions(spark: SparkSession) -> Iterator[int]:
    """Run with the planned partitions as they are, and yield their number.

    Tables staged inside keep their hash partitioning and order, so later joins and aggregations
    on the same key do not move them again. Whoever uses this sees to skewed keys.
    """
    adaptive = "spark.sql.adaptive.enabled"
    before = spark.conf.get(adaptive)
    spark.conf.set(adaptive, "false")
    try:
        yield int(spark.conf.get("spark.sql.shuffle.partitions"))
    finally:
        spark.conf.set(adaptive, before)
