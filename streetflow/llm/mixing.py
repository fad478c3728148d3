"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Each source's documents stand in a fixed permuted order (by a hash of seed and id) that is cut
into blocks. A source's target says how many words, and so how many blocks, it gives: whole
passes over its documents, then the front of the permutation until the target is met. The tree
deals these blocks to the output shards: every node splits its block counts per source between
its two halves by one multivariate-hypergeometric draw, so each shard gets a random but exact
share of every source and all quotas add up. Shards take disjoint consecutive ranges of each
source's permuted blocks and shuffle their rows locally.

Only counts per source pass through the driver. Windows run over the blocks of one source or the
documents of one block, never over the documents of a whole source.

Null and repeated rows: a null text has size 0, a null source is a source of its own and comes
last, rows with equal ids each count as a document and each are dealt. Sources without words get
target 0 and nothing is taken from them; empty tables give empty results.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from streetflow.llm.tables import keep, query, table

WORD = r"[^\x20\x09-\x0D]+"
SHARE = 1.5
WEIGHTS = (5, 2, 1)
MOST = 2.0
BLOCK_DOCS = 256
SHARDS = 16
SEED = 7

_SOURCE = ("_absent", "_source")


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("bigint")


def targets(sizes: DataFrame, share: float = SHARE, weights: tuple = WEIGHTS, most: float = MOST) -> DataFrame:
    """One row per source with its size, number of documents and target.

    Water filling: sources in the order of cap / weight; those before the first whose cap lies
    above the level are full, the rest get level * weight.
    """
    sources = sizes.groupBy(*_SOURCE).agg(F.sum("_size").alias("source_size"), F.count("*").alias("_docs"))
    # these windows see one row per source, not per document
    every = Window.orderBy(F.col("_absent"), F.col("_source"))
    cycle = F.array(*(F.lit(float(w)) for w in weights))
    sources = (sources.withColumn("_weight", F.element_at(cycle, (F.row_number().over(every) - 1) % len(weights) + 1))
               .withColumn("_cap", F.lit(most) * F.col("source_size")))
    rising = Window.orderBy(F.col("_cap") / F.col("_weight"), "_absent", "_source")
    before, after = rising.rowsBetween(Window.unboundedPreceding, -1), rising.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy()
    level = ((F.lit(share) * F.sum("source_size").over(whole) - F.coalesce(F.sum("_cap").over(before), F.lit(0.0)))
             / F.sum("_weight").over(after))
    sources = sources.withColumn("_level", level)
    # it rises up to the first source that stays below its cap and falls from there on
    return sources.withColumn("target", F.least("_cap", F.max("_level").over(whole) * F.col("_weight")))


def drawn(docs: DataFrame, key: str = "doc_id", share: float = SHARE, weights: tuple = WEIGHTS, most: float = MOST,
          block_docs: int = BLOCK_DOCS, seed: int = SEED, text: str = "text", source: str = "source") -> DataFrame:
    """Per document (key, size, source_size, target, _block, _copies): how often the mix takes it."""
    sizes = keep(docs.select(F.col(key).alias("_key"), F.col(source).isNull().alias("_absent"),
                             F.coalesce(F.col(source), F.lit("")).alias("_source"), word_count(text).alias("_size")), "sizes")
    sources = keep(targets(sizes, share, weights, most), "sources")
    order = F.md5(F.concat(F.lit(f"{seed}-"), F.coalesce(F.col("_key").cast("string"), F.lit(""))))
    place = F.conv(F.substring("_order", 1, 12), 16, 10).cast("double") / float(16**12)
    blocks = F.ceil(F.col("_docs") / block_docs)
    rows = (sizes.withColumn("_order", order).join(sources.drop("_weight", "_cap", "_level"), list(_SOURCE))
            .withColumn("_blocks", blocks).withColumn("_block", F.floor(place * F.col("_blocks")))
            .withColumn("_full", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0))
            .withColumn("_rest", F.col("target") - F.col("_full") * F.col("source_size")))
    of_source = Window.partitionBy(*_SOURCE).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = (rows.groupBy(*_SOURCE, "_block").agg(F.sum("_size").alias("_words"))
              .select(*_SOURCE, "_block", F.coalesce(F.sum("_words").over(of_source), F.lit(0)).alias("_start")))
    inside = (Window.partitionBy(*_SOURCE, "_block").orderBy("_order", "_key", "_size")
              .rowsBetween(Window.unboundedPreceding, -1))
    reached = F.col("_start") + F.coalesce(F.sum("_size").over(inside), F.lit(0))
    extra = (F.col("_size") > 0) & (F.col("_rest") > 0) & (reached + F.col("_size") / 2 <= F.col("_rest"))
    return (rows.join(starts, [*_SOURCE, "_block"])
            .withColumn("_copies", F.when(F.col("_size") > 0, F.col("_full")).otherwise(0).cast("int") + extra.cast("int")))


def split_quotas(counts: np.ndarray, shards: int, seed: int) -> np.ndarray:
    """Deal counts[s] blocks of each source to shards; rows add up to counts, shards differ by one block at most."""
    quotas = np.zeros((len(counts), shards), np.int64)
    total = int(counts.sum())
    bounds = np.array([total * i // shards for i in range(shards + 1)])

    def split(colours: np.ndarray, low: int, high: int) -> None:
        if high - low == 1:
            quotas[:, low] = colours
            return
        middle = (low + high) // 2
        draw = np.random.default_rng([seed, low, high])
        left = draw.multivariate_hypergeometric(colours, int(bounds[middle] - bounds[low]), method="marginals")
        split(left, low, middle)
        split(colours - left, middle, high)

    split(counts.astype(np.int64), 0, shards)
    return quotas


def mix(docs: DataFrame, key: str = "doc_id", shards: int = SHARDS, seed: int = SEED, **settings) -> DataFrame:
    """Per document (key, size, source_size, target, taken, shards): shards has the output shard of each copy dealt, taken their words."""
    rows = keep(drawn(docs, key, seed=seed, **settings), "drawn")
    spark = docs.sparkSession
    copies = rows.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))).where("_copies > 0")
    units = copies.groupBy(*_SOURCE, "_copy", "_block").agg(F.count("*").alias("_n"))
    numbered = keep(units.withColumn("_rank", F.row_number().over(
        Window.partitionBy(*_SOURCE).orderBy("_copy", F.md5(F.concat_ws("-", F.lit(seed), "_copy", "_block"))))), "units")
    counts = numbered.groupBy(*_SOURCE).agg(F.max("_rank").alias("n")).orderBy(*_SOURCE).collect()
    ends = np.cumsum(split_quotas(np.array([r.n for r in counts], np.int64), shards, seed), axis=1) if counts else []
    quotas = spark.createDataFrame([(r._absent, r._source, [int(x) for x in e]) for r, e in zip(counts, ends)],
                                   "_absent boolean, _source string, _ends array<bigint>")
    dealt = (numbered.join(quotas, list(_SOURCE))
             .withColumn("_shard", F.size(F.filter("_ends", lambda e: e < F.col("_rank"))))
             .groupBy(*_SOURCE, "_block").agg(F.sort_array(F.collect_list(F.struct("_copy", "_shard"))).alias("_dealt")))
    own = F.filter("_dealt", lambda d: d["_copy"] <= F.col("_copies"))
    return (rows.join(dealt, [*_SOURCE, "_block"], "left")
            .select(F.col("_key").alias(key), F.col("_size").alias("size"), "source_size", "target",
                    F.when(F.col("_copies") > 0, F.transform(own, lambda d: d["_shard"]))
                    .otherwise(F.array().cast("array<int>")).alias("shards"))
            .select(key, "size", "source_size", "target", (F.col("size") * F.size("shards")).alias("taken"), "shards"))


def mixed(docs: DataFrame, key: str = "doc_id", shards: int = SHARDS, seed: int = SEED, **settings) -> DataFrame:
    """The mix itself: the documents' columns for every copy, with mix_shard and mix_copy, shuffled within each shard.

    Rows that share an id are joined as one document, so ids must differ here.
    """
    plan = mix(docs, key, shards, seed, **settings).where(F.size("shards") > 0)
    plan = plan.select(F.col(key).alias("__mixed_id"), F.posexplode("shards").alias("mix_copy", "mix_shard"))
    rows = docs.drop("mix_copy", "mix_shard").join(plan, F.col(key).eqNullSafe(F.col("__mixed_id"))).drop("__mixed_id")
    shuffled = F.xxhash64(F.lit(seed), F.col(key), F.col("mix_copy"))
    return rows.repartition(shards, "mix_shard").sortWithinPartitions("mix_shard", shuffled)


SQL = f"""
with sizes as (select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::bigint as size from documents),
s0 as (select source, sum(size)::bigint as source_size,
              case (row_number() over (order by source nulls last) - 1) % 3 when 0 then 5.0::double when 1 then 2.0::double else 1.0::double end as w
       from sizes group by source),
s1 as (select *, 2.0::double * source_size as cap, 2.0::double * source_size / w as r from s0),
s2 as (select *, (1.5::double * sum(source_size) over () - coalesce(sum(cap) over (order by r, source nulls last rows between unbounded preceding and 1 preceding), 0))
              / sum(w) over (order by r, source nulls last rows between current row and unbounded following) as level from s1),
s3 as (select source, source_size, least(cap, max(level) over () * w) as target from s2),
d as (select sizes.*, source_size, target, floor(target / nullif(source_size, 0)) as f, md5(concat('{SEED}-', doc_id)) as o
      from sizes join s3 on sizes.source is not distinct from s3.source),
e as (select *, coalesce(sum(size) over (partition by source order by o, doc_id, size rows between unbounded preceding and 1 preceding), 0) as b from d)
select doc_id, size, source_size, target,
       (size * (coalesce(f, 0) + case when size > 0 and target - f * source_size > 0 and b + size / 2.0 <= target - f * source_size then 1 else 0 end))::bigint as taken
from e
"""


@query("op10_mix_sources", SQL)
def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).drop("shards")
