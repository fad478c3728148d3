"""Ordered windows over groups of any size.

A window partitioned by a key sends the whole group to one task. That is right for groups
that fit a task and wrong for a key holding a third of a 100 TB table. The helpers here count
the groups first. While every group is small they return the plain window: one shuffle, no
further work. Groups over the limit are cut into blocks of consecutive rows by split points
drawn from a sample, each block becomes a window partition of its own, and what a block needs
from its neighbours (a few halo rows, or the sum of what went before) is added exactly.

The sample only decides where blocks begin, never what a row's result is.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from streetflow.session import stage

# A group of up to twice this many rows is sorted in one task.
BLOCK_ROWS = 4_000_000
# Upper bound of split points over all groups, hence of every table broadcast from here.
MAX_BLOCKS = 65_536
# Each level of the lookup of a row's block holds fewer than 2**LOOKUP_BITS points, about sqrt(MAX_BLOCKS).
LOOKUP_BITS = 10
# Groups are counted together in this many lots first, by hash; a lot within the limit holds no group beyond it.
LOTS = 65_536
# Sampled rows per block; more give more even blocks.
SAMPLE_PER_BLOCK = 40

_ALL, _BLOCK, _HALO, _HOT = "_all", "_block", "_halo", "_hot"


@dataclass(frozen=True)
class Blocks:
    """Rows labelled with `_block`; `_hot` marks rows of a group that was cut."""

    rows: DataFrame
    keys: list[str]
    split: bool


def _attach(df: DataFrame, small: DataFrame, names: Sequence[str]) -> DataFrame:
    """Left join of a table with at most MAX_BLOCKS rows, nulls matching nulls."""
    side = small.select(
        *[F.col(n).alias(f"_r_{n}") for n in names],
        *[c for c in small.columns if c not in names],
    )
    on = F.lit(True)
    for n in names:
        on = on & F.col(n).eqNullSafe(F.col(f"_r_{n}"))
    return df.join(F.broadcast(side), on, "left").drop(*[f"_r_{n}" for n in names])


def _split_points(df: DataFrame, keys: list[str], order: Sequence[str], block_rows: int,
                  counts: DataFrame) -> tuple[DataFrame, DataFrame] | None:
    """The sorted split points of the oversized groups, or None: by group the last point of each chunk, and the chunks."""
    hot = stage(counts.filter(F.col("_n") > 2 * block_rows)
                .withColumn("_blocks", F.ceil(F.col("_n") / block_rows).cast("bigint")))
    hot_rows, blocks = hot.agg(F.sum("_n"), F.sum("_blocks")).first()
    if not hot_rows:
        return None
    point = F.struct(*[F.col(c) for c in order])
    share = min(1.0, SAMPLE_PER_BLOCK * blocks / hot_rows)
    sample = _attach(df.select(*keys, point.alias("_p")), hot, keys).filter("_blocks is not null")
    if share < 1.0:
        sample = sample.sample(share, seed=7)
    group = Window.partitionBy(*keys)
    place = F.floor(F.col("_rn") * F.col("_blocks") / F.col("_m"))
    before = F.floor((F.col("_rn") - 1) * F.col("_blocks") / F.col("_m"))
    picked = (sample.withColumn("_rn", F.row_number().over(group.orderBy("_p")).cast("bigint"))
              .withColumn("_m", F.count(F.lit(1)).over(group))
              .filter((place > before) & (F.col("_rn") < F.col("_m"))))
    points = picked.groupBy(*keys).agg(F.array_sort(F.array_distinct(F.collect_list("_p"))).alias("_pts"))
    # Two levels of about sqrt(blocks) points, so that no row ever carries all points of its group.
    step = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size("_pts"))).cast("int"))
    points = points.withColumn("_step", step).withColumn(
        "_pts", F.expr("transform(sequence(0, (size(_pts) - 1) div _step),"
                       " i -> slice(_pts, cast(i * _step + 1 as int), _step))"))
    points = stage(points)
    ends = points.select(*keys, "_step", F.expr("transform(_pts, c -> element_at(c, -1))").alias("_ends"))
    chunks = points.select(*keys, F.posexplode("_pts").alias("_c", "_chunk"))
    return ends, chunks


def _smaller(points: Column, me: Column) -> Column:
    """How many of an array of sorted points lie before `me`, by halving."""
    steps = F.array(*[F.lit(1 << bit) for bit in reversed(range(LOOKUP_BITS))])
    return F.aggregate(steps, F.lit(0), lambda low, n: F.when(F.get(points, low + n - 1) < me, low + n).otherwise(low))


def largest_lot(df: DataFrame, keys: Sequence[str]) -> tuple[int | None, int | None]:
    """The number of rows, and a bound of the largest group's size: that of the largest lot of groups.

    Unlike a count by group it shuffles no more than LOTS rows of a task, however many groups there are.
    """
    lots = df.groupBy(F.pmod(F.xxhash64(*keys), F.lit(LOTS)).alias("_lot")).agg(F.count(F.lit(1)).alias("_n"))
    return tuple(lots.agg(F.sum("_n"), F.max("_n")).first())


def into_blocks(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                block_rows: int = BLOCK_ROWS, sizes: DataFrame | None = None,
                derived: bool = False) -> Blocks:
    """Label rows with a block number that grows with `order` inside each group.

    `sizes` may name a cheaper DataFrame with the same keys to judge group sizes by. `derived`
    says that the rows come out of a shuffle: if groups must be cut, which takes several passes,
    the rows are stored first instead of computed anew in each pass.
    """
    keys = list(keys)
    if not keys:
        keys = [_ALL]
        df = df.withColumn(_ALL, F.lit(0))
        sizes = None if sizes is None else sizes.withColumn(_ALL, F.lit(0))
    total, largest = largest_lot(df if sizes is None else sizes, keys)
    points = None
    if total and largest > 2 * block_rows:
        df = stage(df) if derived else df
        counts = (df if sizes is None else sizes).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
        points = _split_points(df, keys, order, max(block_rows, -(-total // MAX_BLOCKS)), counts)
    if points is None:
        return Blocks(df.withColumn(_BLOCK, F.lit(0)).withColumn(_HOT, F.lit(False)), keys, False)
    ends, chunks = points
    me = F.struct(*[F.col(c) for c in order])
    rows = (_attach(df, ends, keys).withColumn(_HOT, F.col("_ends").isNotNull())
            .withColumn("_c", _smaller(F.col("_ends"), me)).drop("_ends"))
    rows = _attach(rows, chunks, [*keys, "_c"])
    rows = (rows.withColumn(_BLOCK, F.when(F.col(_HOT), F.col("_c") * F.col("_step") + _smaller(F.col("_chunk"), me))
                            .otherwise(F.lit(0)))
            .drop("_chunk", "_step", "_c"))
    return Blocks(rows, keys, True)


def _done(df: DataFrame) -> DataFrame:
    return df.drop(_BLOCK, _HOT, _ALL, _HALO)


def running_sum(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, out: str,
                block_rows: int = BLOCK_ROWS, sizes: DataFrame | None = None,
                derived: bool = False) -> DataFrame:
    """Add `out`: the sum of `value` over the group's rows up to and including this one."""
    blocks = into_blocks(df, keys, order, block_rows, sizes, derived)
    keys = blocks.keys
    part = Window.partitionBy(*keys, _BLOCK) if blocks.split else Window.partitionBy(*keys)
    upto = part.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = blocks.rows
    result = rows.withColumn(out, F.sum(value).over(upto))
    if blocks.split:
        earlier = (Window.partitionBy(*keys).orderBy(_BLOCK)
                   .rowsBetween(Window.unboundedPreceding, -1))
        before = (rows.filter(_HOT).groupBy(*keys, _BLOCK).agg(F.sum(value).alias("_s"))
                  .withColumn("_before", F.sum("_s").over(earlier)).drop("_s"))
        result = (_attach(result, before, [*keys, _BLOCK])
                  .withColumn(out, F.col(out) + F.coalesce(F.col("_before"), F.lit(0)))
                  .drop("_before"))
    return _done(result)


def row_window(df: DataFrame, keys: Sequence[str], order: Sequence[str],
               columns: Callable[[Window], dict[str, Column]], before: int = 0, after: int = 0,
               block_rows: int = BLOCK_ROWS, sizes: DataFrame | None = None,
               derived: bool = False) -> DataFrame:
    """Add window columns that look at most `before` rows back and `after` rows ahead.

    `columns` gets the ordered window and returns the expressions by name.
    """
    blocks = into_blocks(df, keys, order, block_rows, sizes, derived)
    keys, rows = blocks.keys, blocks.rows
    if not blocks.split:
        return _done(rows.withColumns(columns(Window.partitionBy(*keys).orderBy(*order))))
    main = rows.withColumn(_HALO, F.lit(False))
    hot = rows.filter(_HOT)
    parts = [main]
    if before:
        parts.append(_halo(hot, keys, order, before, ahead=False))
    if after:
        parts.append(_halo(hot, keys, order, after, ahead=True))
    whole = parts[0]
    for extra in parts[1:]:
        whole = whole.unionByName(extra)
    windowed = whole.withColumns(columns(Window.partitionBy(*keys, _BLOCK).orderBy(*order)))
    return _done(windowed.filter(~F.col(_HALO)))


def _halo(hot: DataFrame, keys: list[str], order: Sequence[str], depth: int, ahead: bool) -> DataFrame:
    """Copies of the `depth` rows next to each block, labelled with that block's number.

    The nearest rows of a block lie among the outer `depth` rows of the other blocks, so only
    those (at most MAX_BLOCKS * depth) are looked at again.
    """
    columns = hot.columns
    toward = [F.col(c).asc() for c in order] if ahead else [F.col(c).desc() for c in order]
    edge = Window.partitionBy(*keys, _BLOCK).orderBy(*toward)
    edges = hot.withColumn("_e", F.row_number().over(edge)).filter(F.col("_e") <= depth)
    # Walking away from the block: the row before the first edge row seen is the nearest one.
    away = [F.col(c).desc() for c in order] if ahead else [F.col(c).asc() for c in order]
    path = Window.partitionBy(*keys).orderBy(*away)
    near = (edges.withColumn("_row", F.struct(*columns))
            .withColumn("_near", F.collect_list("_row").over(path.rowsBetween(-depth, -1)))
            .withColumn("_seen", F.lag(_BLOCK).over(path))
            .filter(F.col("_seen").isNull() | (F.col("_seen") != F.col(_BLOCK))))
    copies = near.select(F.col(_BLOCK).alias("_to"), F.explode("_near").alias("_row"))
    return (copies.select("_to", "_row.*").drop(_BLOCK).withColumnRenamed("_to", _BLOCK)
            .withColumn(_HALO, F.lit(True)))


def row_index(df: DataFrame, order: Sequence[str], out: str = "row_index",
              block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Number the rows 0, 1, ... in the given total order."""
    numbered = running_sum(df.withColumn("_one", F.lit(1).cast("bigint")), [], order, "_one", out,
                           block_rows)
    return numbered.withColumn(out, F.col(out) - 1).drop("_one")
