"""Periodic runs of words, by longest common extensions over a difference cover.

A run is a stretch of consecutive words with smallest period q (words q apart are identical) and a
length of at least max(LEAST_WORDS, LEAST_PERIODS * q) that no neighbouring word extends with that
period. Words are runs of bytes other than ASCII white space, compared as they are.

Spark cuts the table into batches, a task takes a few million bytes of texts, or one longer text,
at a time. All their words stand in one sequence with a separator of its own after each text, so no
extension leaves its text.

- A difference cover is a set of residues modulo COVER in which every difference occurs. Only
  suffixes that start at such a residue are sorted: by their first COVER words, then by doubling.
  Common prefixes of neighbours in that order stand in a sparse table.
- The longest common extension of two places compares fewer than COVER words, until both places are
  in the cover, and takes the rest from one range minimum. A second table runs backwards.
- A run of period p with at least LEAST_PERIODS periods holds a place of the grid of step
  (LEAST_PERIODS - 1) p and the place p behind it; extending that pair both ways gives the run. Over all
  periods the grids have n log n places. A stretch found with several periods keeps the smallest.

Memory follows the slice, or the longest text; nothing is shuffled or broadcast. Null and empty texts have no words and no
runs; repeated rows and rows with equal or null ids are each judged alone; an empty table gives an
empty result. Only the two named columns are read, so other columns can't clash.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streetflow.llm.tables import map_arrow, query, table
from streetflow.llm.textscan import BLANK, Slice, slices

LEAST_WORDS = 6
LEAST_PERIODS = 4
COVER = 64
#: Grid places that are looked at together.
AT_ONCE = 1 << 20

RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
JUDGED = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("best", RUN), ("runs", pa.list_(RUN)), ("collapsed", pa.string())])

Fold = Callable[[int | None, int], tuple[int, int] | None]


def cover(period: int) -> np.ndarray:
    """Residues such that every difference modulo period is one of two of them: 0 to r - 1 and the multiples of r, r the root."""
    root = int(np.ceil(np.sqrt(period)))
    return np.union1d(np.arange(root), np.arange(0, period, root))


def shifts(period: int) -> np.ndarray:
    """[i, j]: by how much places of residues i and j move on until both are in the cover."""
    inside = np.isin(np.arange(2 * period) % period, cover(period))
    out = np.full((period, period), -1, np.int16)
    every = np.arange(period)
    for by in range(period):
        both = inside[every + by][:, None] & inside[every + by][None, :]
        out[both & (out < 0)] = by
    return out


def _refined(rank: np.ndarray, tied: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Order the tied places further by key; rank is the number of places before. Returns those still tied."""
    order = np.lexsort((key, rank[tied]))
    tied, key = tied[order], key[order]
    old = rank[tied]
    group = np.ones(len(tied), bool)
    group[1:] = old[1:] != old[:-1]
    new = group.copy()
    new[1:] |= key[1:] != key[:-1]
    at = np.arange(len(tied))
    begin = np.maximum.accumulate(np.where(group, at, 0))
    own = np.maximum.accumulate(np.where(new, at, 0))
    rank[tied] = old + own - begin
    alone = new & np.append(new[1:], True)
    return tied[~alone]


class Extensions:
    """Longest common extensions to the right in a sequence of word numbers from 1, whose last word occurs nowhere else."""

    def __init__(self, words: np.ndarray, period: int = COVER):
        self.n, self.period = len(words), period
        self.words = np.concatenate([words, np.zeros(2 * period + 2, words.dtype)]).astype(np.int64)
        self.shift = shifts(period)
        self.places = np.flatnonzero(np.isin(np.arange(period), cover(period)))
        self.per = len(self.places)
        at = (np.arange(0, self.n, period)[:, None] + self.places).ravel()
        at = at[at < self.n]
        self.column = np.full(period, -1, np.int64)
        self.column[self.places] = np.arange(self.per)
        ranks = self._sorted(at)
        order = np.empty(len(at), np.int64)
        order[ranks[-1]] = np.arange(len(at))
        self.rank = ranks[-1]
        common = np.zeros(len(at), np.int32)
        common[1:] = self._neighbours(at, order, ranks)
        self.least = [common]
        while 2 << (len(self.least) - 1) <= len(at):
            last, step = self.least[-1], 1 << (len(self.least) - 1)
            self.least.append(np.minimum(last[:-step], last[step:]))

    def _sorted(self, at: np.ndarray) -> list[np.ndarray]:
        """Ranks of the sampled suffixes by their first period, 2 period, 4 period, ... words, until all differ."""
        rank, tied = np.zeros(len(at), np.int64), np.arange(len(at))
        for k in range(0, self.period, 2):
            if not len(tied):
                break
            first = at[tied] + k
            tied = _refined(rank, tied, (self.words[first] << 32) | self.words[first + 1])
        ranks, width = [rank.copy()], self.per
        while len(tied):
            ahead = tied + width
            key = np.where(ahead < len(at), ranks[-1][np.minimum(ahead, len(at) - 1)], -1)
            tied = _refined(rank, tied, key)
            ranks.append(rank.copy())
            width *= 2
        return ranks

    def _neighbours(self, at: np.ndarray, order: np.ndarray, ranks: list[np.ndarray]) -> np.ndarray:
        """Common prefixes of neighbours in the order of the suffixes."""
        one, two = order[:-1].copy(), order[1:].copy()
        length = np.zeros(len(one), np.int64)
        for level in range(len(ranks) - 1, -1, -1):
            inside = np.flatnonzero((one < len(at)) & (two < len(at)))
            same = inside[ranks[level][one[inside]] == ranks[level][two[inside]]]
            one[same] += self.per << level
            two[same] += self.per << level
            length[same] += self.period << level
        return length + self._compared(at[order[:-1]] + length, at[order[1:]] + length, np.full(len(one), self.period))

    def _compared(self, i: np.ndarray, j: np.ndarray, most: np.ndarray) -> np.ndarray:
        """How many words from i and j on are equal, at most so many."""
        out = np.zeros(len(i), np.int64)
        left = np.flatnonzero(most > 0)
        done = 0
        while len(left):
            left = left[self.words[np.minimum(i[left] + done, self.n)] == self.words[np.minimum(j[left] + done, self.n)]]
            done += 1
            out[left] = done
            left = left[most[left] > done]
        return out

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Number of equal words from each i and j on, i and j being different places."""
        by = self.shift[i % self.period, j % self.period].astype(np.int64)
        out = self._compared(i, j, by)
        reached = np.flatnonzero(out == by)
        i, j = i[reached] + by[reached], j[reached] + by[reached]
        inside = (i < self.n) & (j < self.n)
        reached, i, j = reached[inside], i[inside], j[inside]
        a, b = (self.rank[x // self.period * self.per + self.column[x % self.period]] for x in (i, j))
        low, high = np.minimum(a, b) + 1, np.maximum(a, b)
        level = np.frexp((high - low + 1).astype(np.float64))[1] - 1
        for k in np.unique(level):
            some = np.flatnonzero(level == k)
            least = self.least[k]
            out[reached[some]] += np.minimum(least[low[some]], least[high[some] - (1 << int(k)) + 1])
        return out


def _grid(first: np.ndarray, n: np.ndarray):
    """Chunks of (text, period, place): places of the grids of all periods that a run in the text can have."""
    periods = n // LEAST_PERIODS
    periods[n < LEAST_WORDS] = 0
    text = np.repeat(np.arange(len(n)), periods)
    period = np.arange(len(text)) - np.repeat(np.cumsum(periods) - periods, periods) + 1
    step = (LEAST_PERIODS - 1) * period
    count = -((period - n[text]) // step)
    ends = np.cumsum(count)
    low = 0
    while low < len(text):
        base = ends[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(ends, base + AT_ONCE, "right")))
        part = slice(low, high)
        k = np.arange(ends[high - 1] - base) - np.repeat(ends[part] - count[part] - base, count[part])
        yield np.repeat(text[part], count[part]), np.repeat(period[part], count[part]), np.repeat(first[text[part]], count[part]) + k * np.repeat(step[part], count[part])
        low = high


def runs_of(words: np.ndarray, first: np.ndarray, n: np.ndarray, period: int = COVER) -> np.ndarray:
    """Rows (text, start, length, period) in this order; text t has the n[t] words from first[t] on, followed by a separator."""
    found = []
    ahead = behind = None
    for text, p, i in _grid(first, n):
        some = np.flatnonzero(words[i] == words[i + p])
        text, p, i = text[some], p[some], i[some]
        if not len(i):
            continue
        if ahead is None:
            ahead, behind = Extensions(words, period), Extensions(np.concatenate([words[::-1], words[-1:] + 1]), period)
        right = ahead(i, i + p)
        last = len(words) - 1
        left = behind(last - i + 1, last - i - p + 1)
        length = p + right + left
        long = np.flatnonzero(length >= np.maximum(LEAST_WORDS, LEAST_PERIODS * p))
        found.append(np.column_stack([text, i - left - first[text], length, p])[long])
    rows = np.concatenate(found) if found else np.zeros((0, 4), np.int64)
    rows = rows[np.lexsort((rows[:, 3], rows[:, 2], rows[:, 1], rows[:, 0]))]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:, :3] != rows[:-1, :3]).any(axis=1)
    rows = rows[new]
    return rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]


def _words(part: Slice) -> tuple[pa.Array, np.ndarray]:
    """The words of a slice, and how many each text has."""
    part.words()
    sizes = np.concatenate([[0], np.cumsum(part.ends - part.starts)]).astype(np.int32)
    raw = part.data[~BLANK[part.data]]
    words = pa.Array.from_buffers(pa.string(), len(part.starts), [None, pa.py_buffer(sizes), pa.py_buffer(np.ascontiguousarray(raw))])
    return words, np.diff(part.first)


def _folded(ids: list, n: np.ndarray, first: np.ndarray, fold: Fold) -> np.ndarray:
    """For each word the number of the word that stands there after folding."""
    at = np.arange(int(n.sum()))
    for doc_id, size, low in zip(ids, n.tolist(), first.tolist()):
        place = fold(doc_id, size) if size else None
        if place:
            a, p = place
            at[low + a: low + size] = low + a + np.arange(size - a) % p
    return at


def _judged(fold: Fold | None, batches):
    for b in batches:
        for at, part in slices(b.column("text")):
            words, n = _words(part)
            first = np.cumsum(n) - n
            ids = b.column("doc_id").slice(at, part.n)
            if fold:
                words = words.take(pa.array(_folded(ids.to_pylist(), n, first, fold)))
            codes = words.dictionary_encode()
            spread = np.zeros(len(words) + len(n), np.int64)
            text = np.repeat(np.arange(len(n)), n)
            spread[np.arange(len(words)) + text] = codes.indices.to_numpy() + 1
            spread[first + n + np.arange(len(n))] = len(codes.dictionary) + 1 + np.arange(len(n))
            rows = runs_of(spread, first + np.arange(len(n)), n)
            # texts shorter than 2**27 words: their quotients of whole numbers differ by more than a float's last place
            best = rows[np.lexsort((rows[:, 3], rows[:, 1], -rows[:, 2] / rows[:, 3], rows[:, 0]))]
            best = best[np.searchsorted(best[:, 0], np.arange(len(n))).clip(max=max(len(best) - 1, 0))] if len(best) else np.full((len(n), 4), -1)
            none = best[:, 0] != np.arange(len(n))
            edges = np.bincount(first[rows[:, 0]] + rows[:, 1] + rows[:, 3], minlength=len(words) + 1)[: len(words) + 1]
            edges = edges - np.bincount(first[rows[:, 0]] + rows[:, 1] + rows[:, 2], minlength=len(words) + 1)[: len(words) + 1]
            kept = np.cumsum(edges)[: len(words)] == 0
            left = np.concatenate([[0], np.cumsum(np.bincount(text[kept], minlength=len(n)))]).astype(np.int32)
            collapsed = pc.binary_join(pa.ListArray.from_arrays(pa.array(left), words.filter(pa.array(kept))), " ")
            bounds = np.searchsorted(rows[:, 0], np.arange(len(n) + 1)).astype(np.int32)
            runs = pa.StructArray.from_arrays([pa.array(rows[:, k]) for k in (1, 2, 3)], fields=list(RUN))
            tops = pa.StructArray.from_arrays([pa.array(best[:, k]) for k in (1, 2, 3)], fields=list(RUN), mask=pa.array(none))
            yield pa.RecordBatch.from_arrays([ids, pa.array(n, pa.int64()), tops, pa.ListArray.from_arrays(pa.array(bounds), runs), collapsed], schema=JUDGED)


def find_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", fold: Fold | None = None) -> DataFrame:
    """Per document doc_id, n_words, best (start, length, period; null without runs), runs by start and period, and the collapsed text.

    best has the greatest length / period, of equal ones the smallest start. collapsed has the words that no run holds after
    its first period, joined by a space. fold(doc_id, n) may name a place a and a period p: word i >= a
    of the text is then its word a + (i - a) % p, which plants a run.
    """
    rows = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))

    def work(batches):
        return _judged(fold, batches)

    return map_arrow(rows, work, JUDGED)


def _planted(doc_id: int | None, n: int) -> tuple[int, int] | None:
    """Where the query folds the text of every tenth document, by its checksum."""
    if doc_id is None:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    return a, 1 + (n - a) // (3 + g % 8)


@query("op12_word_runs")
def op12_word_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = find_runs(table(spark, sf_dir, "documents"), fold=_planted)
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = [F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")]
    return rows.select("doc_id", F.size("runs").cast("bigint").alias("n_runs"), *best,
                       F.expr("1000 * best.length div best.period").alias("exponent_milli"),
                       F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
