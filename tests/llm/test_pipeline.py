"""The pipeline: every stage works on what the one before kept."""

import corpus_pipeline

SF_DIR = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = given = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    counts = []
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.keep(stage(spark, docs, SF_DIR), name)
        counts.append(docs.count())
        assert docs.columns[:len(given.columns)] == given.columns
    assert given.count() > counts[0] >= counts[2] >= counts[3] > 0 and counts[4] > counts[3]


def test_only_dropped_ids_are_sent(spark, monkeypatch):
    """Rows of one id stay together if one is kept, null ids included; what is stored and joined are the ids that go."""
    stored = []
    keep = corpus_pipeline.keep
    monkeypatch.setattr(corpus_pipeline, "keep", lambda df, name: stored.append(keep(df, name)) or stored[-1])
    judged = [(1, True), (1, False), (2, False), (3, True), (None, True), (None, False), (4, None), (5, False), (5, False)]
    docs = spark.createDataFrame([(i, f"text {i} {k}") for k in range(2) for i in (1, 2, 3, None, 4, 5)], "doc_id bigint, text string")
    got = corpus_pipeline._passed(docs, spark.createDataFrame(judged, "doc_id bigint, kept boolean"))
    assert sorted(r.text for r in got.collect()) == sorted(f"text {i} {k}" for k in range(2) for i in (1, 3, None))
    assert sorted(r[0] for r in stored[0].collect()) == [2, 4, 5]


def test_sets_of_few_texts_are_held_at_once(monkeypatch):
    """What the join's first count holds follows a small slice of the texts, nulls included; the regions are the same for any slice."""
    import random
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    from streetflow.llm import jaccard_join as j

    rng = random.Random(3)
    texts = [None if i % 50 == 0 else " ".join(f"w{rng.randrange(5000)}" for _ in range(700)) for i in range(700)]
    rows = pa.RecordBatch.from_pydict({"text": pa.array(texts, pa.string())})

    def met():
        return np.sort(np.concatenate([x.column("region").to_numpy() for x in j._meetings(j.Rule(5, 80), [rows])]))

    want = met()
    tracemalloc.start()
    for _ in j._meetings(j.Rule(5, 80), [rows]):
        pass
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    monkeypatch.setattr(j, "SET_BYTES", 1 << 30)
    assert (met() == want).all() and peak < 30e6
