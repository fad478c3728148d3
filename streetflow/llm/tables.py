"""Reading the corpus tables, keeping intermediate tables, and the list of this folder's queries."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streetflow.session import scratch

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, with the SQL that must give the same rows."""

    def add(build: Query) -> Query:
        QUERIES[name] = build
        if sql is not None:
            SQL[name] = sql
        return build

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write a table once to the folder that the cluster shares and go on from the written rows."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    rows = df.sparkSession.read.schema(df.schema).parquet(path)
    rows.kept_path = path
    return rows


def release(*tables: DataFrame) -> None:
    """Delete tables that `keep` wrote, once nothing will read them again."""
    for rows in tables:
        spark = rows.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(rows.kept_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def drop_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of plans that nothing refers to any more.

    It does so when the driver's garbage collector finds them gone, which in a job of many rounds is long after their last use.
    """
    spark._jvm.System.gc()


def map_arrow(df: DataFrame, work, schema) -> DataFrame:
    """`mapInArrow` with a pyarrow schema."""
    from pyspark.sql.pandas.types import from_arrow_schema

    return df.mapInArrow(work, from_arrow_schema(schema))


#: A bitmap has 2**MARK_BITS bits, 8 MB, however many values it marks.
MARK_BITS = 26


def marks(values: DataFrame) -> np.ndarray:
    """Bitmap of the one column of evenly spread 64-bit hashes; `marked` says no only to values that are not among them.

    It spares a pass the rows that can't matter. Whatever follows must be right for rows that are
    let through needlessly, so a full bitmap costs time and never rows.
    """
    bit = F.shiftrightunsigned(values[values.columns[0]], 64 - MARK_BITS)
    rows = values.select(bit.alias("b")).selectExpr("shiftright(b, 6) w", "shiftleft(1L, cast(b & 63 as int)) m")
    found = rows.groupBy("w").agg(F.bit_or("m").alias("m")).toArrow()
    out = np.zeros(1 << (MARK_BITS - 6), np.uint64)
    out[found.column(0).to_numpy()] = found.column(1).to_numpy().view(np.uint64)
    return out


def marked(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    at = values >> np.uint64(64 - MARK_BITS)
    return (bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1
