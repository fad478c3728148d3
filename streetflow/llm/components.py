"""Connected components of a link table by repeated contraction, without collecting links or members."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streetflow.llm.tables import keep, release


def components(links: DataFrame) -> DataFrame:
    """(v, root) of every end of links(a, b): one root for each component.

    Each round every vertex takes the least vertex within two links, links between what they took
    remain, and both tables are written, so rounds have no lineage. The vertices left shrink by a
    constant factor; stars and groups of copies vanish in one round.
    """
    edges = keep(links.where("a <> b").select("a", "b").union(links.where("a <> b").select("b", "a")).distinct(), "edges")
    label = None
    while not edges.isEmpty():
        near = edges.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        far = edges.join(near.select(F.col("a").alias("b"), "m"), "b").groupBy("a").agg(F.min("m").alias("m"))
        taken = keep(far.select(F.col("a").alias("v"), F.least("a", "m").alias("p")), "taken")
        ends = (edges.join(taken.select(F.col("v").alias("a"), F.col("p").alias("pa")), "a")
                .join(taken.select(F.col("v").alias("b"), F.col("p").alias("pb")), "b"))
        done, edges = edges, keep(ends.where("pa <> pb").select(F.col("pa").alias("a"), F.col("pb").alias("b")).distinct(), "edges")
        if label is None:
            label, old = keep(taken.withColumnRenamed("p", "root"), "label"), ()
        else:
            step = taken.select(F.col("v").alias("root"), F.col("p").alias("next"))
            old, label = (label,), keep(label.join(step, "root", "left").select("v", F.coalesce("next", "root").alias("root")), "label")
        release(done, taken, *old)
    if label is None:
        return keep(edges.select(F.col("a").alias("v"), F.col("b").alias("root")), "label")
    return label
