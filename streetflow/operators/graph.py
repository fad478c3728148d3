"""Road-graph measures as iterated joins and aggregations.

Vertices are `(id)`, edges `(src, dst, weight)`. The edges are partitioned and sorted by their
join key once and stay where they are; a round moves only per-vertex rows and map-side combined
sums. A search keeps a vertex's edges as one list. Edges of hubs, vertices with very many edges, are kept apart without partitioning and meet
the few hub rows by broadcast, so no task gets all edges of a hub. Every round's vertex table is
stored in the shared folder, which keeps the lineage one round long and survives lost executors.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from streetflow.operators.blocks import largest_lot
from streetflow.session import fixed_partitions, stage, store

# Damping, round limit, tolerance per vertex, landmark vertices, list length.
ALPHA = 0.85
MAX_ROUNDS = 100
TOLERANCE = 1e-6
LANDMARKS = ("0", "50", "100")
TOP_VERTICES = 10

# A vertex with more edges is a hub. The limit rises with the graph, so that there are never
# more than MAX_HUBS hubs, which is what gets broadcast.
HUB_EDGES = 2_000_000
MAX_HUBS = 65_536
# Levels of a search are merged into one table after this many rounds.
MERGE_ROUNDS = 16


@dataclass(frozen=True)
class _Edges:
    """Edges partitioned by `key`, and those of hubs apart; with `packed`, a key's other ends, of that name, are one list."""

    key: str
    common: DataFrame
    of_hubs: DataFrame | None
    hubs: DataFrame | None
    packed: str | None = None

    def join(self, table: DataFrame) -> DataFrame:
        """Inner join with a table that has one or few rows per key."""
        joined = self.common.join(table, self.key)
        if self.packed is not None:
            joined = joined.select(*table.columns, F.explode("_ends").alias("_end")).select(*table.columns, f"_end.{self.packed}")
        if self.hubs is None:
            return joined
        few = table.join(F.broadcast(self.hubs), self.key, "left_semi")
        return joined.unionByName(self.of_hubs.join(F.broadcast(few), self.key))


def _partition_edges(edges: DataFrame, key: str, partitions: int, hub_edges: int, packed: str | None = None) -> _Edges:
    of_hubs = hubs = None
    total, most = largest_lot(edges, [key])
    if total and most > hub_edges:
        degrees = edges.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
        limit = max(hub_edges, -(-total // MAX_HUBS))
        hubs = stage(degrees.filter(F.col("_n") > limit).select(key))
        of_hubs = stage(edges.join(F.broadcast(hubs), key, "left_semi"))
        edges = edges.join(F.broadcast(hubs), key, "left_anti")
    common = edges.repartition(partitions, key)
    if packed is None:
        return _Edges(key, stage(common.sortWithinPartitions(key)), of_hubs, hubs)
    # one row for a vertex instead of one for an edge, so that a round passes over what it does not need at little cost
    common = common.groupBy(key).agg(F.collect_list(F.struct(packed)).alias("_ends"))
    return _Edges(key, stage(common.sortWithinPartitions(key)), of_hubs, hubs, packed)


def pagerank(vertices: DataFrame, edges: DataFrame, alpha: float = ALPHA, max_rounds: int = MAX_ROUNDS,
             tolerance: float = TOLERANCE, weighted: bool = True, hub_edges: int = HUB_EDGES) -> DataFrame:
    """PageRank with rank passed on in proportion to edge weight (G2): `(id, pagerank)`.

    The rank of vertices without outgoing edges is spread evenly. Stops once the ranks change
    by less than `tolerance` per vertex in total, or after `max_rounds`; a tolerance of 0 runs
    exactly `max_rounds` rounds. A round shuffles one sum per vertex and task and nothing else.
    """
    weight = F.col("weight").cast("double") if weighted else F.lit(1.0)
    stored = stage(edges.select("src", "dst", weight.alias("weight")))
    with fixed_partitions(vertices.sparkSession) as partitions:
        parts = _partition_edges(stored, "src", partitions, hub_edges)
        out = stored.groupBy(F.col("src").alias("id")).agg(F.sum("weight").alias("out"))
        known = stage(vertices.select("id").repartition(partitions, "id").join(out, "id", "left"))
        n, sinks = known.agg(F.count(F.lit(1)), F.count_if(F.col("out").isNull())).first()
        if not n:
            return known.select("id", F.lit(None).cast("double").alias("pagerank"))
        ranks, loose = known.withColumn("rank", F.lit(1.0 / n)), sinks / n
        for _ in range(max_rounds):
            passed = (parts.join(ranks.select(F.col("id").alias("src"), "rank", "out"))
                      .groupBy(F.col("dst").alias("id"))
                      .agg(F.sum(F.col("rank") * F.col("weight") / F.col("out")).alias("got")))
            base = (1.0 - alpha + alpha * loose) / n
            fresh = ranks.withColumnRenamed("rank", "before").join(passed, "id", "left").select(
                "id", "out", "before", (F.lit(base) + alpha * F.coalesce("got", F.lit(0.0))).alias("rank"))
            seen = Observation()
            ranks = stage(fresh.observe(
                seen, F.sum(F.abs(F.col("rank") - F.col("before"))).alias("moved"),
                F.sum(F.when(F.col("out").isNull(), F.col("rank"))).alias("loose"))).drop("before")
            loose = seen.get["loose"] or 0.0
            if seen.get["moved"] < n * tolerance:
                break
        return ranks.select("id", F.col("rank").alias("pagerank"))


def pagerank_table(ranks: DataFrame) -> DataFrame:
    """Stored form: string id and 32-bit rank."""
    return ranks.select(F.col("id").cast("string").alias("id"), F.col("pagerank").cast("float").alias("pagerank"))


def top_vertices(ranks: DataFrame, n: int = TOP_VERTICES) -> DataFrame:
    """Highest ranks, ties by id."""
    return ranks.orderBy(F.col("pagerank").desc(), F.col("id")).limit(n)


def hops_to(vertices: DataFrame, edges: DataFrame, landmarks: Sequence[str] = LANDMARKS,
            hub_edges: int = HUB_EDGES) -> DataFrame:
    """Fewest edges from each vertex to each landmark (G4): `(id, landmark, hops)`.

    A breadth-first search against the edge direction, all landmarks at once. Pairs without a
    path and landmarks outside the graph are left out.
    """
    spark = vertices.sparkSession
    stored = store(edges.select(F.col("dst").alias("at"), F.col("src").alias("id")), "edges")
    with fixed_partitions(spark) as partitions:
        back = _partition_edges(stored, "at", partitions, hub_edges, "id")
    goals = spark.createDataFrame([(str(x),) for x in landmarks], "landmark string")
    front = stage(goals.withColumn("id", F.col("landmark").cast(vertices.schema["id"].dataType)).distinct()
                  .join(vertices.select("id").distinct(), "id").select("landmark", "id", F.lit(0).alias("hops")))
    found, parts, hops = front, 1, 0
    while True:
        hops += 1
        seen = Observation()
        reached = (back.join(front.select("landmark", F.col("id").alias("at"))).select("landmark", "id").distinct()
                   .join(found.select("landmark", "id"), ["landmark", "id"], "left_anti")
                   .select("landmark", "id", F.lit(hops).alias("hops")))
        front = stage(reached.observe(seen, F.count(F.lit(1)).alias("n")))
        if not seen.get["n"]:
            return found.select("id", "landmark", "hops")
        found, parts = found.unionByName(front), parts + 1
        if parts >= MERGE_ROUNDS:
            found, parts = stage(found), 1


def distance_maps(vertices: DataFrame, hops: DataFrame, landmarks: Sequence[str] = LANDMARKS) -> DataFrame:
    """`(id string, distances map)` for every vertex; one that reaches none has an empty map."""
    names = [str(x) for x in landmarks]
    per = [F.max(F.when(F.col("landmark") == name, F.col("hops"))).alias(f"_d{i}") for i, name in enumerate(names)]
    wide = vertices.select("id").join(hops.groupBy("id").agg(*per), "id", "left")
    whole = F.map_from_arrays(F.array(*[F.lit(n) for n in names]),
                              F.array(*[F.col(f"_d{i}") for i in range(len(names))]))
    return wide.select(F.col("id").cast("string").alias("id"),
                       F.map_filter(whole, lambda _, v: v.isNotNull()).alias("distances"))


def graph_stats(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """Vertex and edge counts, mean out-degree and density."""
    m = edges.agg(F.count(F.lit(1)).alias("m"))
    n = F.col("vertices")
    return (vertices.agg(F.count(F.lit(1)).alias("vertices"))
            .select("vertices", m.scalar().alias("edges"))
            .withColumns({
                "mean_out_degree": F.col("edges") / F.greatest(F.lit(1), n),
                "density": F.when(n < 2, F.lit(0.0)).otherwise(F.col("edges") / (n * (n - 1)))}))
