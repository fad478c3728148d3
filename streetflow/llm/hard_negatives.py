"""Hard-negative mining by slots of the score line.

A vector's components x become floor(GRID * x), a score is the inner product with an anchor in whole
numbers; of equal scores the smaller id comes first. An anchor's positives are its first rows of the same
label. For each positive of score s the negatives are the first rows of other labels with a score from low to
high percent of s, so the windows of one anchor overlap.

The upper limits of an anchor's windows, in descending order, cut the score line into disjoint slots,
the last one ending at the lowest lower limit. Tasks keep the first rows of each slot while they read, Spark merges them by
anchor and slot, and no slot needs more rows than one window returns. The slots stand behind each other, so
a window's answer is the front of the merge of its own and all lower slots, as far as its lower limit; one
list for each anchor, read from several places, answers all windows.

Anchors meet all rows in blocks of at most ANCHORS and BLOCK_BYTES, which bounds what is sent; each block reads
the table twice, for positives and for negatives. A task holds one block, CELLS scores and the
first rows of each slot. Labels and ids are never shuffle keys for rows, so hot ones do no harm.

Rows with a null id, label or vector or with a null or non-finite component take no part. Shorter vectors count as
if followed by zeros. Rows with an anchor's id are not its positives or negatives; otherwise rows that repeat an id each count, as
anchors too. A window that ends below its start is empty (scores below 0). Scores that do not fit in
SCORE_BITS bits are an error. Empty tables give empty results. Only the three named columns are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from streetflow.llm.tables import keep, map_arrow, query, table
from streetflow.session import scratch

GRID = 256
POSITIVES = 5
NEGATIVES = 5
LOW_PERCENT = 80
HIGH_PERCENT = 100
ANCHORS = 4096
BLOCK_BYTES = 1 << 25
CELLS = 1 << 21
SCORE_BITS = 54

LOWEST, HIGHEST = np.iinfo(np.int64).min, np.iinfo(np.int64).max
SCORED = pa.schema([("anchor", pa.int64()), ("slot", pa.int32()), ("score", pa.int64()), ("id", pa.int64())])


class Rows:
    """Ids, labels and whole-number vectors of the rows that take part, as far as `width` components."""

    def __init__(self, batch: pa.RecordBatch, width: int | None = None):
        lists = batch.column("vector")
        n = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = np.asarray(lists.flatten().to_numpy(zero_copy_only=False), np.float64)
        of = np.repeat(np.arange(len(n)), n)
        bad = np.bincount(of[~np.isfinite(flat)], minlength=len(n)) > 0
        for c in ("id", "label", "vector"):
            bad |= batch.column(c).is_null().to_numpy(zero_copy_only=False)
        at = np.arange(len(flat)) - np.repeat(np.cumsum(n) - n, n)
        width = int(n.max(initial=0)) if width is None else width
        use = ~bad[of] & (at < width)
        grid = np.floor(GRID * flat[use])
        if len(grid) and np.abs(grid).max() >= 2.0**SCORE_BITS:
            raise ValueError("components are too large for whole-number scores")
        vectors = np.zeros((len(n), width))
        vectors[of[use], at[use]] = grid
        self.vectors = vectors[~bad]
        self.ids, self.labels = (batch.column(c).fill_null(0).to_numpy(zero_copy_only=False)[~bad] for c in ("id", "label"))

    def __len__(self) -> int:
        return len(self.ids)


def products(one: np.ndarray, two: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers held as floats; an error if one of the asked is too large."""
    most = np.abs(one).max(initial=0) * np.abs(two).max(initial=0) * max(one.shape[1], 1)
    if most < 2.0**53:
        return (one @ two.T).astype(np.int64)
    exact = np.array(one.astype(np.int64).astype(object) @ two.astype(np.int64).astype(object).T)
    if (np.abs(exact[asked]) >= 2**SCORE_BITS).any():
        raise ValueError("scores are too large")
    return np.where(asked, exact, 0).astype(np.int64)


class Best:
    """The first k rows of every group, by descending score and ascending id."""

    def __init__(self, groups: int, k: int):
        self.k = k
        self.bar = np.full(groups, LOWEST)
        self.group, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))

    def add(self, group: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        group, score, ids = (np.concatenate(x) for x in ((self.group, group), (self.score, score), (self.id, ids)))
        order = np.lexsort((ids, -score, group))
        group, score, ids = group[order], score[order], ids[order]
        first = np.searchsorted(group, group, "left")
        front = np.arange(len(group)) - first < self.k
        self.group, self.score, self.id = group[front], score[front], ids[front]
        full = np.flatnonzero(np.arange(len(group)) - first == self.k - 1)
        self.bar[group[full]] = score[full]


def _scored(anchors: Rows, uppers: np.ndarray | None, lowers: np.ndarray | None, k: int, batches):
    """The first k rows of each anchor and slot; without limits, of each anchor among the rows of its label."""
    slots = 1 if uppers is None else uppers.shape[1]
    best = Best(len(anchors) * slots, k)
    step = max(1, CELLS // max(1, len(anchors)))
    for b in batches:
        rows = Rows(b, anchors.vectors.shape[1])
        for low in range(0, len(rows), step):
            part = slice(low, low + step)
            alike = anchors.labels[:, None] == rows.labels[None, part]
            may = (alike if uppers is None else ~alike) & (anchors.ids[:, None] != rows.ids[None, part])
            scores = products(anchors.vectors, rows.vectors[part], may)
            for j in range(slots):
                bar = best.bar.reshape(-1, slots)[:, j]
                if uppers is None:
                    a, r = np.nonzero(may & (scores >= bar[:, None]))
                else:
                    bar = np.maximum(bar, lowers[:, j])
                    a, r = np.nonzero(may & (scores >= bar[:, None]) & (scores <= uppers[:, j, None]))
                if len(a):
                    best.add(a * slots + j, scores[a, r], rows.ids[part][r])
    yield pa.RecordBatch.from_arrays([pa.array(best.group // slots), pa.array((best.group % slots).astype(np.int32)), pa.array(best.score), pa.array(best.id)],
                                     schema=SCORED)


def _first(rows: DataFrame, k: int) -> DataFrame:
    """The first k rows of each anchor and slot over all tasks, with their rank."""
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "id")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def slot_limits(positives: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(uppers, floors, lowers) from descending positive scores, LOWEST where there is none.

    Slot j of an anchor reaches from uppers[j] down to floors[j]; lowers[j] is where window j ends.
    """
    known = positives != LOWEST
    scores = np.where(known, positives, 0)
    uppers = np.where(known, high * scores // 100, LOWEST)
    lowers = np.where(known, -(-low * scores // 100), HIGHEST)
    below = np.concatenate([uppers[:, 1:], np.full((len(uppers), 1), LOWEST)], axis=1)
    floors = np.maximum(lowers, np.where(below == LOWEST, LOWEST, below + 1))
    return uppers, np.where(known, floors, HIGHEST), lowers


def _mined(rows: DataFrame, anchors: Rows, settings: tuple[int, int, int, int]) -> DataFrame:
    """Result rows of one block of anchors."""
    n_positives, n_negatives, low, high = settings
    spark = rows.sparkSession
    sent = spark.sparkContext.broadcast(anchors)
    same = map_arrow(rows, lambda batches: _scored(sent.value, None, None, n_positives, batches), SCORED)
    # at most n_positives rows for each anchor of the block
    positives = _first(same, n_positives).toArrow()
    anchor, place = positives.column("anchor").to_numpy(), positives.column("rank").to_numpy() - 1
    scores, ids = (np.full((len(anchors), n_positives), LOWEST) for _ in range(2))
    scores[anchor, place], ids[anchor, place] = positives.column("score").to_numpy(), positives.column("id").to_numpy()
    uppers, floors, lowers = slot_limits(scores, low, high)
    limits = spark.sparkContext.broadcast((uppers, floors))

    others = map_arrow(rows, lambda batches: _scored(sent.value, *limits.value, n_negatives, batches), SCORED)
    found = F.struct("slot", (-F.col("score")).alias("down"), F.col("id").alias("negative_id"))
    merged = _first(others, n_negatives).groupBy("anchor").agg(F.sort_array(F.collect_list(found)).alias("merged"))
    asked = spark.createDataFrame(pa.table({
        "anchor": anchor, "anchor_id": anchors.ids[anchor], "positive_id": ids[anchor, place], "positive_score": scores[anchor, place],
        "place": place.astype(np.int32), "lower": lowers[anchor, place]}))
    # slots come in descending order, so a window is the front of the list from its own slot on
    front = F.slice(F.filter("merged", lambda x: (x["slot"] >= F.col("place")) & (-x["down"] >= F.col("lower"))), 1, n_negatives)
    return (asked.join(merged, "anchor").select("anchor_id", "positive_id", "positive_score", F.posexplode(front).alias("at", "x"))
            .select("anchor_id", "positive_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("x.negative_id").alias("negative_id"),
                    "positive_score", (-F.col("x.down")).alias("negative_score")))


def mine(vectors: DataFrame, anchors: Column, key: str = "vec_id", vector: str = "embedding", label: str = "label", positives: int = POSITIVES,
         negatives: int = NEGATIVES, low: int = LOW_PERCENT, high: int = HIGH_PERCENT) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): up to so many negatives for each of up to so many
    positives of the rows that `anchors` chooses."""
    if not (positives >= 1 and negatives >= 1 and 0 < low <= high):
        raise ValueError(f"no windows with {positives} positives, {negatives} negatives, {low} to {high} percent")
    spark = vectors.sparkSession
    rows = vectors.select(F.col(key).cast("bigint").alias("id"), F.col(label).cast("bigint").alias("label"), F.col(vector).alias("vector"))
    chosen = vectors.where(anchors).select(F.col(key).cast("bigint").alias("id"), F.col(label).cast("bigint").alias("label"), F.col(vector).alias("vector"))
    chosen = keep(chosen.where("id is not null and label is not null and vector is not null").withColumn("place", F.monotonically_increasing_id()), "anchors")
    n, width = chosen.agg(F.count("*"), F.max(F.size("vector"))).first()
    path = scratch(spark, "negatives")
    # a block takes places by hash, so a few more or less than its share
    blocks = -(-n // max(1, min(ANCHORS, BLOCK_BYTES // (8 * max(width or 1, 1)))))
    schema = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    for block in range(blocks):
        own = chosen.where(F.pmod(F.xxhash64("place"), F.lit(blocks)) == block).select("id", "label", "vector").toArrow().combine_chunks()
        own = [Rows(b) for b in own.to_batches()]
        if own and len(own[0]):
            _mined(rows, own[0], (positives, negatives, low, high)).write.parquet(f"{path}/block={block}")
    if not blocks:
        return spark.createDataFrame([], schema)
    spark.createDataFrame([], schema).write.parquet(f"{path}/block=-1")
    return spark.read.schema(schema + ", block int").parquet(path).drop("block")


SQL = """
with r as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, list_transform(embedding, lambda x: floor(256 * x::double)) as v
           from embeddings where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select a.vec_id as anchor_id, b.vec_id as id, a.label = b.label as alike, list_inner_product(a.v, b.v)::bigint as score
      from r a join r b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id),
p as (select anchor_id, id as positive_id, score as positive_score from s where alike
      qualify row_number() over (partition by anchor_id order by score desc, id) <= 5),
n as (select p.*, id as negative_id, score as negative_score, row_number() over (partition by p.anchor_id, positive_id order by score desc, id)::integer as rank
      from p join s on s.anchor_id = p.anchor_id and not alike and 80 * positive_score <= 100 * score and score <= positive_score)
select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from n where rank <= 5
"""


@query("op13_hard_negatives", SQL)
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    noisy = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return mine(noisy, F.col("vec_id") % 100 == 0)
