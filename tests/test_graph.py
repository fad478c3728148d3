"""Graph measures on small graphs worked out by hand or with plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from streetflow.operators import graph
from streetflow.sources.sensors import adjacency_to_edges


def build(spark, n, edges):
    return (spark.range(n).select(F.col("id").cast("string").alias("id")),
            spark.createDataFrame([(str(a), str(b), float(w)) for a, b, w in edges], "src string, dst string, weight double"))


def rank_by_hand(n, edges, alpha=0.85, rounds=100, tolerance=1e-6):
    out = {}
    for a, _, w in edges:
        out[a] = out.get(a, 0) + w
    x = [1 / n] * n
    for _ in range(rounds):
        loose = sum(x[v] for v in range(n) if v not in out)
        new = [(1 - alpha + alpha * loose) / n] * n
        for a, b, w in edges:
            new[b] += alpha * x[a] * w / out[a]
        moved = sum(abs(p - q) for p, q in zip(new, x))
        x = new
        if moved < n * tolerance:
            break
    return x


# Vertex 4 is a sink, 5 stands alone, 6 and 7 are a part of their own.
EDGES = [(0, 1, 2.0), (1, 2, 1.0), (2, 0, 1.0), (0, 2, 1.0), (2, 4, 5.0), (6, 7, 1.0), (7, 6, 3.0)]


def test_pagerank(spark):
    got = {int(r.id): r.pagerank for r in graph.pagerank(*build(spark, 8, EDGES)).collect()}
    want = rank_by_hand(8, EDGES)
    assert sum(got.values()) == pytest.approx(1.0)
    assert [got[i] for i in range(8)] == pytest.approx(want, abs=1e-9)


def test_hubs_change_nothing(spark):
    v, e = build(spark, 8, EDGES)
    with_hubs = {int(r.id): r.pagerank for r in graph.pagerank(v, e, hub_edges=1).collect()}
    assert [with_hubs[i] for i in range(8)] == pytest.approx(rank_by_hand(8, EDGES), abs=1e-9)
    plain = graph.hops_to(v, e, ["0", "4"])
    assert sorted(graph.hops_to(v, e, ["0", "4"], hub_edges=1).collect()) == sorted(plain.collect())


@pytest.mark.parametrize("hub_edges", [1, 100])
def test_a_search_passes_over_vertices(spark, hub_edges):
    """The edges of a vertex are one row of the search, of a hub one each; repeated ones and those without an end are all met."""
    from streetflow.session import fixed_partitions
    edges = [(1, "a"), (1, "a"), (1, None), (1, "b"), (2, "a"), (3, None), (None, "c")]
    e = spark.createDataFrame(edges, "at int, id string")
    front = spark.createDataFrame([("x", 1), ("y", 1), ("x", 3), ("x", 9), ("x", None)], "landmark string, at int")
    with fixed_partitions(spark) as n:
        parts = graph._partition_edges(e, "at", n, hub_edges, "id")
        got = parts.join(front.select("landmark", "at")).select("landmark", "id").collect()
        assert parts.common.count() == (3 if hub_edges == 1 else 4)
        assert "Exchange" not in parts.common._jdf.queryExecution().executedPlan().toString()
    want = [(mark, end) for mark, at in [("x", 1), ("y", 1), ("x", 3)] for key, end in edges if key == at]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_rounds_do_not_move_the_edges(spark):
    from streetflow.session import fixed_partitions
    _, e = build(spark, 8, EDGES)
    ids = spark.range(8).select(F.col("id").cast("string").alias("src"), F.lit(1.0).alias("rank")).hint("merge")
    with fixed_partitions(spark) as n:
        parts = graph._partition_edges(e, "src", n, 100)
        plan = parts.join(ids)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_pagerank_unweighted_differs(spark):
    plain = {int(r.id): r.pagerank for r in graph.pagerank(*build(spark, 8, EDGES), weighted=False).collect()}
    want = rank_by_hand(8, [(a, b, 1.0) for a, b, _ in EDGES])
    assert [plain[i] for i in range(8)] == pytest.approx(want, abs=1e-9)


def test_pagerank_without_edges(spark):
    v, e = build(spark, 3, EDGES)
    got = [r.pagerank for r in graph.pagerank(v, e.filter("false")).collect()]
    assert got == pytest.approx([1 / 3] * 3)


def test_stored_ranks(spark):
    ranks = graph.pagerank(*build(spark, 8, EDGES))
    assert graph.pagerank_table(ranks).dtypes == [("id", "string"), ("pagerank", "float")]
    assert graph.top_vertices(ranks, 1).first().id == "6" or graph.top_vertices(ranks, 1).first().id == "7"


def test_hops_on_small_graph(spark):
    v, e = build(spark, 8, EDGES)
    got = {(r.id, r.landmark): r.hops for r in graph.hops_to(v, e, ["0", "4", "99"]).collect()}
    assert got == {("0", "0"): 0, ("2", "0"): 1, ("1", "0"): 2, ("4", "4"): 0, ("2", "4"): 1, ("1", "4"): 2, ("0", "4"): 2}
    maps = {r.id: r.distances for r in graph.distance_maps(v, graph.hops_to(v, e, ["0", "4", "99"]), ["0", "4", "99"]).collect()}
    assert maps["1"] == {"0": 2, "4": 2} and maps["5"] == {} and maps["6"] == {} and len(maps) == 8


def test_hops_against_plain_search(spark):
    rnd = random.Random(5)
    n, marks = 60, [0, 7]
    edges = [(rnd.randrange(n), rnd.randrange(n), 1.0) for _ in range(90)] + [(i, i + 1, 1.0) for i in range(0, 40)]
    want = {}
    for mark in marks:
        front, depth = {mark}, 0
        while front:
            for x in front:
                want[(str(x), str(mark))] = depth
            front = {a for a, b, _ in edges if b in front} - {int(k) for k, m in want if m == str(mark)}
            depth += 1
    v, e = build(spark, n, edges)
    got = {(r.id, r.landmark): r.hops for r in graph.hops_to(v, e, marks).collect()}
    assert got == want


def test_adjacency(spark):
    m = spark.createDataFrame([(0, [0.0, 0.5, 0.0]), (1, [0.2, 9.0, 0.0]), (2, [0.0, 0.0, 1.0])], "row int, weights array<double>")
    v, e = adjacency_to_edges(m)
    assert {(r.src, r.dst, r.weight) for r in e.collect()} == {("0", "1", 0.5), ("1", "0", 0.2)}
    s = graph.graph_stats(v, e).first()
    assert (s.vertices, s.edges, round(s.mean_out_degree, 6), round(s.density, 6)) == (3, 2, 0.666667, 0.333333)
