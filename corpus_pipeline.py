"""The corpus pipeline: five stages, each on all that the one before kept.

Quality rules drop the documents they reject, line dedup takes out repeated lines, the n-gram
Jaccard join keeps the document of smallest id of each group, decontamination drops documents
with benchmark items, and mixing deals the rest to shards by source weight. All but the last
return the columns of documents. Rows that share an id are treated as one document from the
quality rules on; what an operator does with nulls, ties and empty tables its module says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streetflow.llm.jaccard_join import join
from streetflow.llm.latent_leaks import decontaminate
from streetflow.llm.line_dedup import without_repeats
from streetflow.llm.mixing import mixed
from streetflow.llm.ngram_quality import judge
from streetflow.llm.tables import keep, table


#: Near duplicates: words a shingle and least similarity in percent, not those of the op4 query.
NEAR_SHINGLE = 5
NEAR_PERCENT = 80


def _passed(docs: DataFrame, judged: DataFrame) -> DataFrame:
    """The documents of whose rows in judged (doc_id, kept) one at least is kept.

    Only ids to be dropped are sent: where they are few, the join needs no shuffle of the texts.
    """
    dropped = judged.groupBy("doc_id").agg(F.max("kept").alias("kept")).where(~F.coalesce("kept", F.lit(False)))
    dropped = keep(dropped.select(F.col("doc_id").alias("_dropped")), "dropped")
    return docs.join(dropped, F.col("doc_id").eqNullSafe(F.col("_dropped")), "left_anti")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _passed(docs, judge(docs).select("doc_id", "kept"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated lines; n_chars follows the text."""
    rows = without_repeats(docs)
    return rows.withColumn("n_chars", F.length("text").cast("bigint")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    groups = join(docs, NEAR_SHINGLE, NEAR_PERCENT)
    return _passed(docs, groups.select("doc_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every copy that the mix takes, with its shard."""
    return mixed(docs)


STAGES = [("quality", quality), ("line_dedup", lines), ("near_duplicates", near_duplicates),
          ("decontamination", decontamination), ("mixing", mixture)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), name)
    return docs


#: Perplexity and cosines can't be told in SQL; tests/llm compares the stages with plain versions.
ORACLE_SQL = None
