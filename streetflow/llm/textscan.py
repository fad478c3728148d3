"""Words, lines and hashes of many texts at once, with numpy on Arrow buffers.

Used inside `mapInArrow`: Spark cuts the table into batches, this module cuts a batch into slices
of a few million bytes, so that a task's memory follows one slice, or one text where a single
text is longer. A null text counts as an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Word separators: space, tab, line feed, vertical tab, form feed, carriage return.
BLANK = np.zeros(256, bool)
BLANK[[32, 9, 10, 11, 12, 13]] = True
#: Every ASCII byte that is neither letter nor digit.
NOT_WORD = np.array([i < 128 and not chr(i).isalnum() for i in range(256)])
NEWLINE = np.arange(256) == 10

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTES = np.random.default_rng(20240607).integers(1, 2**63, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
SLICE_BYTES = 1 << 21

_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (the splitmix64 finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse, modulo 2**64."""
    global _powers, _inverses
    if len(_powers) < n:
        size = 1 << (n - 1).bit_length()
        _powers = np.full(size, _BASE, np.uint64)
        _inverses = np.full(size, _INVERSE, np.uint64)
        _powers[0] = _inverses[0] = 1
        np.multiply.accumulate(_powers, out=_powers)
        np.multiply.accumulate(_inverses, out=_inverses)
    return _powers[:n], _inverses[:n]


def range_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of values[s:e] for each s, e: equal sequences get equal hashes wherever they stand."""
    powers, inverses = _tables(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers[:-1], out=sums[1:])
    found = (sums[ends] - sums[starts]) * inverses[starts]
    return mix(found + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


class Slice:
    """Some consecutive texts of a batch, cut into pieces (words or lines).

    starts, ends: byte positions of each piece in data; rows: the text of each piece;
    first: for each text the number of its first piece, and at last the number of pieces.
    """

    def __init__(self, texts: pa.Array, lower: bool):
        offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset: texts.offset + len(texts) + 1].astype(np.int64)
        raw = texts.buffers()[2]
        data = np.frombuffer(raw, np.uint8)[offsets[0]: offsets[-1]] if raw is not None else np.zeros(0, np.uint8)
        self.offsets = offsets - offsets[0]
        self.data = _LOWER[data] if lower else data
        self.n = len(texts)

    def words(self, separators: np.ndarray = BLANK) -> Slice:
        inside = ~separators[self.data]
        before, after = np.zeros_like(inside), np.zeros_like(inside)
        before[1:], after[:-1] = inside[:-1], inside[1:]
        begins, stops = self.offsets[:-1], self.offsets[1:]
        before[begins[begins < len(inside)]] = False
        after[stops[stops > 0] - 1] = False
        self.starts = np.flatnonzero(inside & ~before)
        self.ends = np.flatnonzero(inside & ~after) + 1
        return self._numbered()

    def lines(self) -> Slice:
        """Pieces between line feeds; a text with k line feeds has k + 1 lines, an empty one has one."""
        breaks = np.flatnonzero(NEWLINE[self.data])
        starts = np.concatenate([self.offsets[:-1], breaks + 1])
        ends = np.concatenate([self.offsets[1:], breaks])
        rows = np.concatenate([np.arange(self.n), np.searchsorted(self.offsets, breaks, "right") - 1])
        self.starts = starts[np.lexsort((starts, rows))]
        self.ends = ends[np.lexsort((ends, rows))]
        self.rows = np.sort(rows)
        self.first = np.searchsorted(self.rows, np.arange(self.n + 1))
        return self

    def _numbered(self) -> Slice:
        self.first = np.searchsorted(self.starts, self.offsets)
        self.rows = np.repeat(np.arange(self.n), np.diff(self.first))
        return self

    def hashes(self) -> np.ndarray:
        return range_hash(_BYTES[self.data], self.starts, self.ends)


def slices(texts: pa.Array, lower: bool = False, most: int = SLICE_BYTES) -> Iterator[tuple[int, Slice]]:
    """Consecutive slices of a column of at most so many bytes or one text, each with the number of its first row."""
    texts = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
    ends = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(texts), 0), np.int64)) if len(texts) else np.zeros(0, np.int64)
    at = 0
    while at < len(texts):
        base = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, base + most, "right")))
        yield at, Slice(pc.fill_null(texts.slice(at, to - at), ""), lower)
        at = to


def signed(x: np.ndarray) -> np.ndarray:
    """64-bit hashes as Spark's bigint."""
    return x.view(np.int64)


def batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def lists(flat: np.ndarray, first: np.ndarray, kind: pa.DataType) -> pa.Array:
    """Rows of a list column: flat[first[i]:first[i + 1]]."""
    return pa.ListArray.from_arrays(pa.array(np.asarray(first, np.int32)), pa.array(flat, kind))
