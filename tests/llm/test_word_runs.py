"""Runs of words against a plain search over all periods."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from streetflow.llm import word_runs

SF_DIR = "/root/testdata/sf0.001"


def plain_runs(words):
    """(start, length, period) of every run, by comparing all words q apart."""
    found = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i > start and i - start + q >= max(6, 4 * q):
                found.setdefault((start, i - start + q), q)  # smaller periods come first
            i += 1
    return sorted((s, n, q) for (s, n), q in found.items())


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def folded(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def texts(seed, count):
    draw = random.Random(seed)
    for _ in range(count):
        words = draw.choices("abc"[: draw.randint(1, 3)], k=draw.randint(0, 60))
        for _ in range(draw.randint(0, 3)):
            at = draw.randint(0, len(words))
            words[at:at] = draw.choices("abcd", k=draw.randint(1, 9)) * draw.randint(2, 9) + draw.choices("ab", k=draw.randint(0, 2))
        yield words


@pytest.mark.parametrize("period", [1, 4, 7, 64, 100])
def test_every_difference_is_covered(period):
    moves = word_runs.shifts(period)
    inside = set(word_runs.cover(period).tolist())
    assert all({(i + moves[i, j]) % period, (j + moves[i, j]) % period} <= inside for i in range(period) for j in range(period))


@pytest.mark.parametrize("period", [4, 16, 64])
def test_extensions(period):
    draw = random.Random(period)
    words = np.array(draw.choices((1, 2), k=200) + [1, 2, 2] * 60 + [2] * 90 + [3], np.int64)
    reach = word_runs.Extensions(words, period)
    i, j = (np.array(x) for x in zip(*[draw.sample(range(len(words)), 2) for _ in range(4000)]))
    for a, b, n in zip(i.tolist(), j.tolist(), reach(i, j).tolist()):
        want = 0
        while max(a, b) + want < len(words) and words[a + want] == words[b + want]:
            want += 1
        assert n == want


def test_runs_of_small_texts(spark):
    given = list(texts(4, 400))
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(given)], "doc_id bigint, text string")
    rows = word_runs.find_runs(docs).collect()
    assert len(rows) == len(given) and sum(len(r.runs) for r in rows) > 400
    for r in rows:
        runs = plain_runs(given[r.doc_id])
        assert [tuple(x) for x in r.runs] == runs and r.collapsed == collapsed(given[r.doc_id], runs)
        assert (tuple(r.best) if r.best else None) == min(runs, key=lambda x: (-x[1] / x[2], x[0], x[2]), default=None)


def test_query_on_a_table(spark):
    given = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = word_runs.op12_word_runs(spark, SF_DIR).collect()
    assert len(rows) == len(given) and sum(r.n_runs > 0 for r in rows) > 10
    for r in rows:
        words = [w.decode() for w in given[r.doc_id].encode().split()]
        words = folded(r.doc_id, words)
        runs = plain_runs(words)
        said = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        best = min(runs, key=lambda x: (-x[1] / x[2], x[0], x[2]), default=(None,) * 3)
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        assert r.runs_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(collapsed(words, runs).encode()).hexdigest()


def test_odd_and_empty_tables(odd, empty):
    rows = word_runs.find_runs(odd).collect()
    assert len(rows) == 7 and {r.doc_id: r.n_words for r in rows} == {1: 5, 2: 0, 3: 0, None: 3, 4: 0, 5: 20_001}
    long = next(r for r in rows if r.doc_id == 5)
    assert [tuple(x) for x in long.runs] == [(1, 20_000, 1)] and len(long.collapsed) == 50_004
    assert word_runs.find_runs(empty).count() == 0
