"""Table writes that can be repeated, compaction and retention.

With the Delta extension in the session its transactions are used. Otherwise a table is a
Parquet folder in which every batch owns the folder `txn=<writer>@<run>@<number>`; writing a batch again
replaces its folder, whatever it holds now, also when the repeated batch is empty.
"""

from __future__ import annotations

import logging
import time
from collections.abc import Sequence
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

logger = logging.getLogger(__name__)

TXN = "txn"
STAGING, SUPERSEDED = "_staging", "_superseded"

# Retention in hours, time format that keeps microseconds, tables of the nightly run.
RETENTION_HOURS = 168
JSON_OPTIONS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
MAINTAINED_TABLES = ["sensor_speeds", "cv_vehicle_counts", "gps_trips", "speed_predictions", "weather",
                     "rerouting_alerts", "dlq_sensors", "pipeline_latency"]


def has_delta(spark: SparkSession) -> bool:
    return "DeltaSparkSessionExtension" in spark.conf.get("spark.sql.extensions", "")


def _batch_folder(app_id: str, run: str, batch_id: int) -> str:
    """Folder of a batch: its number, and in full who wrote it unless that is the default writer outside a stream."""
    if (app_id, run) == ("streetflow", ""):
        return f"{TXN}={int(batch_id)}"
    return f"{TXN}={quote(app_id, safe='')}@{quote(run, safe='')}@{int(batch_id)}"


def _batch_of(folder: str) -> tuple[str, int]:
    """Writer with run, and number, of a batch folder; sorts by writer, then number."""
    writer, _, number = folder.removeprefix(f"{TXN}=").rpartition("@")
    return writer, int(number)


def append_once(df: DataFrame, path: str, batch_id: int, app_id: str = "streetflow",
                partition_by: Sequence[str] = (), run: str = "") -> None:
    """Append a batch so that appending it again changes nothing (K3, K4).

    A batch is known by its writer `app_id`, the writer's `run` and its number, so writers and
    runs, such as a stream on a new checkpoint, keep their rows apart. New columns are allowed;
    older rows then read as null.
    Rows of a partitioned table are brought together by partition first, in pieces of the
    advisory size: otherwise every task would write a file into every partition.
    """
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    if has_delta(df.sparkSession):
        (df.write.format("delta").mode("append").option("mergeSchema", "true").option("txnAppId", f"{app_id}-{run}" if run else app_id)
         .option("txnVersion", str(batch_id)).partitionBy(*partition_by).save(path))
    else:
        df.write.mode("overwrite").partitionBy(*partition_by).parquet(f"{path.rstrip('/')}/{_batch_folder(app_id, run, batch_id)}")


def write_snapshot(df: DataFrame, path: str) -> None:
    """Replace the whole table (K5)."""
    df.write.format("delta" if has_delta(df.sparkSession) else "parquet").mode("overwrite").save(path)


def to_keyed_json(df: DataFrame, key: str | None = None) -> DataFrame:
    """Messages `(key, value)`: the row as JSON under its entity id; null key when none is named (K6)."""
    entity = F.lit(None).cast("string") if key is None else F.col(key).cast("string")
    return df.select(entity.alias("key"), F.to_json(F.struct("*"), JSON_OPTIONS).alias("value"))


def publish(messages: DataFrame, where: str, topic: str | None = None) -> None:
    """Send messages to a topic, or write their values as text files when no topic is named."""
    if topic:
        messages.write.format("kafka").option("kafka.bootstrap.servers", where).option("topic", topic).save()
    else:
        messages.select("value").write.mode("append").text(where)


def publish_once(messages: DataFrame, where: str, batch_id: int, topic: str | None = None, app_id: str = "streetflow", run: str = "") -> None:
    """Publish a batch of a stream (K6). Text files of a batch written again replace those before; a topic gets them once more."""
    if topic:
        publish(messages, where, topic)
    else:
        messages.select("value").write.mode("overwrite").text(f"{where.rstrip('/')}/{_batch_folder(app_id, run, batch_id)}")


class _Folder:
    """The few file operations compaction needs, through Hadoop's file system API."""

    def __init__(self, spark: SparkSession, path: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self.root = path.rstrip("/")
        self.fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def at(self, *names: str):
        return self._path("/".join([self.root, *names]))

    def exists(self, *names: str) -> bool:
        return self.fs.exists(self.at(*names))

    def names(self, *below: str) -> list[str]:
        if not self.exists(*below):
            return []
        return sorted(s.getPath().getName() for s in self.fs.listStatus(self.at(*below)) if s.isDirectory())

    def batches(self) -> list[str]:
        """Folders of the batches, by writer and number."""
        return sorted((n for n in self.names() if n.startswith(f"{TXN}=")), key=_batch_of)

    def layout(self, batch: str) -> list[str]:
        """Partition columns of a batch, from the names of its folders."""
        below, columns = [batch], []
        while found := [n for n in self.names(*below) if "=" in n]:
            columns.append(found[0].split("=")[0])
            below.append(found[0])
        return columns

    def mean_file_size(self, name: str) -> float:
        content = self.fs.getContentSummary(self.at(name))
        return content.getLength() / max(1, content.getFileCount())

    def move(self, source: Sequence[str], target: Sequence[str]) -> None:
        self.fs.mkdirs(self.at(*target).getParent())
        if not self.fs.rename(self.at(*source), self.at(*target)):
            raise OSError(f"could not move {source} to {target} below {self.root}")


def path_exists(spark: SparkSession, path: str) -> bool:
    return _Folder(spark, path).exists()


def compact(spark: SparkSession, path: str, target_mb: int = 128, partition_by: Sequence[str] = (),
            keep_latest: int = 1) -> bool:
    """Merge small files (K7); returns whether anything was rewritten.

    Parquet: neighbouring batches of small files become one batch folder each; batches of files
    near the target size, such as the result of an earlier run, are left alone, and so are the
    newest `keep_latest` of each writer, which a restarted stream may still repeat. Partition
    columns are those of the folders unless named. A merged batch is written
    aside first; then the old folders move to `_superseded`, and it takes their place. A run
    that was cut off is finished by the next. Rows keep their columns, `batch_id` too.
    """
    if has_delta(spark):
        spark.sql(f"OPTIMIZE delta.`{path}`")
        return True
    folder = _Folder(spark, path)
    for span in folder.names(STAGING):
        if folder.exists(STAGING, span, "_SUCCESS"):
            _swap_in(folder, span)
        else:
            folder.fs.delete(folder.at(STAGING, span), True)
    batches = folder.batches()
    writers: dict[str, list[str]] = {}
    for batch in batches:
        writers.setdefault(_batch_of(batch)[0], []).append(batch)
    newest = {b for own in writers.values() for b in own[len(own) - keep_latest:]} if keep_latest else set()
    target = target_mb * 1024 * 1024
    runs: list[list[str]] = [[]]
    for batch in (b for b in batches if b not in newest):
        layout = folder.layout(batch)
        if runs[-1] and (_batch_of(runs[-1][-1])[0] != _batch_of(batch)[0] or folder.layout(runs[-1][-1]) != layout):
            runs.append([])
        if folder.mean_file_size(batch) < target / 2:
            runs[-1].append(batch)
        elif runs[-1]:
            runs.append([])
    runs = [run for run in runs if len(run) > 1]
    for run in runs:
        _merge(spark, folder, run, target, partition_by or folder.layout(run[0]))
    return bool(runs)


def _merge(spark: SparkSession, folder: _Folder, run: list[str], target: int, partition_by: Sequence[str]) -> None:
    # named after the batch whose place it takes, and the first one it holds
    span = f"{run[-1]}@{_batch_of(run[0])[1]}"
    sources = [f"{folder.root}/{b}" for b in run]
    rows = spark.read.option("basePath", folder.root).option("mergeSchema", "true").parquet(*sources).drop(TXN)
    # Pieces of the target size, also where one partition holds most of the rows.
    advisory = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(advisory, None)
    spark.conf.set(advisory, str(target))
    try:
        (rows.hint("rebalance", *[F.col(c) for c in partition_by]).write.mode("overwrite")
         .partitionBy(*partition_by).parquet(f"{folder.root}/{STAGING}/{span}"))
    finally:
        spark.conf.unset(advisory) if before is None else spark.conf.set(advisory, before)
    _swap_in(folder, span)


def _swap_in(folder: _Folder, span: str) -> None:
    last, _, first = span.rpartition("@")
    stamp = str(int(time.time() * 1000))
    for batch in folder.batches():
        if _batch_of(batch)[0] == _batch_of(last)[0] and int(first) <= _batch_of(batch)[1] <= _batch_of(last)[1]:
            folder.move([batch], [SUPERSEDED, stamp, batch])
    folder.move([STAGING, span], [last])


def replaced_batches(spark: SparkSession, path: str) -> list[str]:
    """Batch folders that compaction replaced and expiry has not deleted yet."""
    folder = _Folder(spark, path)
    return [batch for stamp in folder.names(SUPERSEDED) for batch in folder.names(SUPERSEDED, stamp)]


def expire(spark: SparkSession, path: str, hours: float = RETENTION_HOURS, force: bool = False) -> int:
    """Delete files no longer part of the table and older than `hours` (K8); returns folders deleted."""
    if hours < RETENTION_HOURS and not force:
        raise ValueError(f"retention below {RETENTION_HOURS} hours needs force=True")
    if has_delta(spark):
        if force:
            spark.conf.set("spark.databricks.delta.retentionDurationCheck.enabled", "false")
        spark.sql(f"VACUUM delta.`{path}` RETAIN {hours} HOURS")
        return 0
    folder = _Folder(spark, path)
    limit = (time.time() - hours * 3600) * 1000
    old = [stamp for stamp in folder.names(SUPERSEDED) if int(stamp) <= limit]
    for stamp in old:
        folder.fs.delete(folder.at(SUPERSEDED, stamp), True)
    return len(old)


def maintain(spark: SparkSession, root: str, tables: Sequence[str] = tuple(MAINTAINED_TABLES),
             hours: float = RETENTION_HOURS, force: bool = False, skip_expire: bool = False,
             partition_by: dict[str, Sequence[str]] | None = None) -> dict[str, str]:
    """Compact, then expire each table; an error stops only its own table."""
    outcome = {}
    for name in tables:
        path = f"{root.rstrip('/')}/{name}"
        if not path_exists(spark, path):
            outcome[name] = "absent"
            continue
        try:
            outcome[name] = "compacted" if compact(spark, path, partition_by=(partition_by or {}).get(name, ())) else "unchanged"
        except Exception as error:  # noqa: BLE001 - the other tables must still be maintained
            logger.warning("compaction of %s failed: %s", name, error)
            outcome[name] = "failed"
            continue
        if not skip_expire:
            try:
                expire(spark, path, hours, force)
            except Exception as error:  # noqa: BLE001
                logger.warning("expiry of %s failed: %s", name, error)
                outcome[name] += ", not expired"
    return outcome
