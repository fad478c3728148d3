"""Decoding, filters and the split into good and bad rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streetflow.functions.display import CONGESTION_MPH

# Valid speed range in mph, stale-frame bound in seconds, reason text.
SPEED_RANGE = (0.0, 150.0)
MAX_FRAME_AGE_SEC = 10.0
FAILED_VALIDATION = "failed_validation"


def decode(df: DataFrame, schema: T.StructType, value: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """JSON text to columns; malformed text gives nulls, unknown fields are left out (V1)."""
    parsed = F.from_json(F.col(value).cast("string"), schema)
    return df.select(*keep, parsed.alias("_d")).select(*keep, "_d.*")


def require(df: DataFrame, *columns: str) -> DataFrame:
    """Rows in which all the columns are set (V2)."""
    for name in columns:
        df = df.filter(F.col(name).isNotNull())
    return df


def in_range(column: Column, low: float, high: float) -> Column:
    """Both ends inclusive; null and NaN do not pass (V3)."""
    return F.coalesce(column.between(low, high), F.lit(False))


def valid_reading() -> Column:
    return F.col("sensor_id").isNotNull() & in_range(F.col("speed"), *SPEED_RANGE)


def split(df: DataFrame, good: Column, distinct_invalid: bool = False) -> tuple[DataFrame, DataFrame]:
    """The rows that satisfy `good`, and the others (V4).

    With `distinct_invalid` equal bad rows collapse to one, as the set difference of the batch
    and its good rows would give (V5, J4). Whether a row is good depends on its values only, so
    no join against the good rows is needed: one partial aggregation does it.
    """
    passed = F.coalesce(good, F.lit(False))
    bad = df.filter(~passed)
    return df.filter(passed), bad.distinct() if distinct_invalid else bad


def dead_letter(df: DataFrame, batch_id: int, reason: str = FAILED_VALIDATION) -> DataFrame:
    """Stamp rejected rows with reason, time and batch (V6)."""
    return df.withColumns({"dlq_reason": F.lit(reason), "dlq_at": F.current_timestamp(),
                           "batch_id": F.lit(batch_id).cast("bigint")})


def drop_stale(df: DataFrame, ts: Column, max_age: float = MAX_FRAME_AGE_SEC, now: Column | None = None) -> DataFrame:
    """Drop rows more than `max_age` seconds older than `now`, both in epoch seconds (V8)."""
    return df.filter(~is_stale(ts, max_age, now))


def is_stale(ts: Column, max_age: float = MAX_FRAME_AGE_SEC, now: Column | None = None) -> Column:
    if now is None:
        now = F.unix_micros(F.current_timestamp()) / 1e6
    return (now - ts) > max_age


def skip_reason(*rules: tuple[str, Column]) -> Column:
    """Name of the first rule that holds, null when none does (V9)."""
    reason = F.lit(None).cast("string")
    for name, holds in reversed(rules):
        reason = F.when(holds, F.lit(name)).otherwise(reason)
    return reason


def drop_missing(df: DataFrame, *columns: str) -> DataFrame:
    """Drop rows with a null or NaN in one of the columns."""
    kinds = dict(df.dtypes)
    for name in columns:
        df = df.filter(F.col(name).isNotNull())
        if kinds[name] in ("float", "double"):
            df = df.filter(~F.isnan(name))
    return df


def congested(df: DataFrame, threshold: float = CONGESTION_MPH, speed: str = "speed") -> DataFrame:
    """Readings strictly below the threshold (V11); a NaN is not below it."""
    return df.filter(F.col(speed) < threshold)


def first_rows(df: DataFrame, n: int, *order: str) -> DataFrame:
    """The first `n` rows in a stated order, for quick runs."""
    return df.orderBy(*order).limit(n)
