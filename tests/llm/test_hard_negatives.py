"""Hard negatives against a plain search over all rows."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from streetflow.llm import hard_negatives

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def plain(rows, is_anchor, positives=5, negatives=5, low=80, high=100):
    clean = [(i, [math.floor(256 * float(np.float32(x))) for x in v], c) for i, v, c in rows
             if i is not None and v is not None and c is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = Counter()
    for a, va, ca in clean:
        if not is_anchor(a):
            continue
        scored = sorted((-sum(x * y for x, y in zip(va, v)), i, c) for i, v, c in clean if i != a)
        for s, p, _ in [x for x in scored if x[2] == ca][:positives]:
            window = [(-t, i) for t, i, c in scored if c != ca and low * -s <= 100 * -t <= high * -s]
            for rank, (t, i) in enumerate(window[:negatives], 1):
                out[(a, p, rank, i, -s, t)] += 1
    return out


def mined(docs, **settings):
    found = hard_negatives.mine(docs, F.col("vec_id") % 10 == 0, **settings)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return Counter(tuple(r) for r in found.collect())


def vectors(seed, n, labels=3, kinds=4):
    """Few directions, so that many scores are equal, and one label with half of all rows."""
    draw = random.Random(seed)
    for i in range(n):
        v = [draw.randint(-1, kinds) / 8 for _ in range(3)]
        yield i, v, 0 if draw.random() < 0.5 else draw.randrange(labels)


@pytest.mark.parametrize("settings", [{}, {"positives": 2, "negatives": 7, "low": 30, "high": 95}, {"positives": 40, "negatives": 1}])
def test_against_all_rows(spark, monkeypatch, settings):
    rows = list(vectors(len(settings), 300))
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    want = plain(rows, lambda i: i % 10 == 0, **settings)
    assert len(want) > 100 and mined(docs, **settings) == want
    monkeypatch.setattr(hard_negatives, "ANCHORS", 7)
    monkeypatch.setattr(hard_negatives, "CELLS", 64)
    assert mined(docs, **settings) == want


def test_odd_rows(spark):
    rows = [*vectors(5, 60), (None, [1.0, 1.0, 1.0], 0), (100, None, 0), (110, [1.0, None, 1.0], 1), (120, [1.0, float("nan"), 0.0], 1), (130, [float("inf")], 2),
            (140, [1.0, 1.0, 1.0], None), (150, [], 0), (160, [0.5], 1), (170, [0.5, 0.5, 0.5, 9.0], 1), (20, [0.5, 0.5, 0.5], 1), (20, [0.5, 0.5, 0.5], 1), (7, [0.4, 0.1, 0.3], 0),
            (180, [3e9, 1.0, 1.0], 2)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("clash") for c in ("id", "vector", "anchor", "slot", "rank", "score")})
    assert mined(docs) == plain(rows, lambda i: i % 10 == 0)
    with pytest.raises(Exception, match="too large"):
        mined(spark.createDataFrame([(0, [1e30], 1), (1, [1.0], 1)], SCHEMA))
    with pytest.raises(Exception, match="too large"):
        mined(spark.createDataFrame([(0, [1e12], 1), (1, [1e12], 1)], SCHEMA))


def test_empty_tables(spark):
    assert not mined(spark.createDataFrame([], SCHEMA)) and not mined(spark.createDataFrame([(1, [0.5], 1)], SCHEMA))
    assert not mined(spark.createDataFrame([(10, [0.5], 1), (20, None, 1), (11, [0.5], 2)], SCHEMA))


def test_slots_are_disjoint():
    draw = np.random.default_rng(4)
    scores = -np.sort(-draw.integers(-50, 400, (200, 5)), axis=1)
    scores[:20, 3:] = hard_negatives.LOWEST
    uppers, floors, lowers = hard_negatives.slot_limits(scores, 80, 100)
    for up, floor, low, own in zip(uppers.tolist(), floors.tolist(), lowers.tolist(), scores.tolist()):
        slots = [set(range(f, u + 1)) for u, f in zip(up, floor) if u > hard_negatives.LOWEST]
        assert sum(map(len, slots)) == len(set().union(*slots))
        for j, s in enumerate(own):
            if s != hard_negatives.LOWEST:
                window = {t for t in range(-60, 401) if 80 * s <= 100 * t <= 100 * s}
                assert low[j] == math.ceil(80 * s / 100) and window <= set().union(*slots[j:])
