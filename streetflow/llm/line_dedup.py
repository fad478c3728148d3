"""Line dedup by a deletion-neighbourhood join.

A line is its sequence of words (runs without ASCII white space). Two lines count as the same if
their words are equal or, if both have at least NEAR_WORDS words, one word apart: one replaced,
added or left out. A line is removed if an earlier line, by (doc_id, line number) in the input,
is the same; lines without words always stay.

Every line that may have a partner emits its own hash and that of each variant with one word
deleted. Lines that share a variant with the word deleted at the same place differ by replacing
it; a line that equals another's variant lacks that word. So equal keys with their places verify
the edit distance. Within a key only the earliest line is passed on, never pairs.

Which lines may have a partner is known beforehand: one edit leaves a line's first or last words
in place, so a line whose first and last parts occur in no other line can't have one. Those parts
are counted over all lines and sent as a bitmap of fixed size, which only spares work.

A null text stays null and has no lines; null ids come first; an empty table gives an empty result.
Rows are told apart by id and text: rows with one id and different texts are documents of their own,
in the order of their texts' hashes; rows with equal id and text are one document, and neither removes the
other's line at the same number. Other columns are passed through, `n_lines` and `n_removed` are replaced.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from streetflow.llm.tables import keep, map_arrow, marked, marks, query, table
from streetflow.llm.textscan import _INVERSE, Slice, _tables, batch, lists, mix, range_hash, signed, slices

NEAR_WORDS = 10
#: Which line of which document: the order in which the earliest is kept.
PLACE = ("doc_id", "body", "number")
#: Tells rows with one id apart.
BODY = "xxhash64(text)"

PARTS = pa.schema([("key", pa.int64()), ("line", pa.int64())])
FOUND = pa.schema([("line", pa.int64()), ("doc_id", pa.int64()), ("body", pa.int64()), ("number", pa.int32()), ("variants", pa.list_(pa.int64()))])
VARIANT = pa.schema([("key", pa.int64()), ("at", pa.int32()), ("line", pa.int64()), ("doc_id", pa.int64()), ("body", pa.int64()), ("number", pa.int32())])


class _Lines:
    """The lines of a slice with words: hash, words [low, high), text and number in it."""

    def __init__(self, part: Slice):
        part.lines()
        starts, rows, first = part.starts, part.rows, part.first
        part.words()
        of_word = np.searchsorted(starts, part.starts, "right") - 1
        bounds = np.searchsorted(of_word, np.arange(len(starts) + 1))
        self.words = part.hashes()
        keep = np.flatnonzero(np.diff(bounds))
        self.low, self.high = bounds[keep], bounds[keep + 1]
        self.row, self.number = rows[keep], keep - first[rows[keep]]
        self.hash = range_hash(self.words, self.low, self.high)
        self.n = self.high - self.low

    def parts(self) -> tuple[np.ndarray, np.ndarray]:
        """(key, index of line): hashes of first and last words, for the lengths shared with lines one word shorter."""
        keys, index = [], []
        near = np.flatnonzero(self.n >= NEAR_WORDS)
        own, less = self.n[near] // 8 * 4, (self.n[near] - 1) // 8 * 4
        for at, size in ((near, own), (near[less < own], less[less < own])):
            low, high = self.low[at], self.high[at]
            keys += [mix(range_hash(self.words, low, low + size)), mix(range_hash(self.words, high - size, high) ^ np.uint64(1))]
            index += [at, at]
        return np.concatenate(keys), np.concatenate(index)

    def variants(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the chosen lines with one word deleted, and the bounds of each line's list."""
        powers, inverses = _tables(len(self.words) + 1)
        sums = np.zeros(len(self.words) + 1, np.uint64)
        np.cumsum(self.words * powers[:-1], out=sums[1:])
        n = np.where(chosen, self.n, 0)
        first = np.concatenate([[0], np.cumsum(n)])
        low, high = np.repeat(self.low, n), np.repeat(self.high, n)
        at = low + np.arange(first[-1]) - np.repeat(first[:-1], n)
        rest = ((sums[at] - sums[low]) + (sums[high] - sums[at + 1]) * np.uint64(_INVERSE)) * inverses[low]
        return mix(rest + (high - low - 1).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)), first


def _parts(batches):
    """Each line's hash as its own key, and its parts."""
    for b in batches:
        for _, part in slices(b.column("text")):
            lines = _Lines(part)
            keys, index = lines.parts()
            yield batch(PARTS, signed(np.concatenate([lines.hash, keys])), signed(np.concatenate([lines.hash, lines.hash[index]])))


def candidates(docs: DataFrame) -> DataFrame:
    """(line, doc_id, body, number, variants): every line that may be the same as another; near ones with their variants."""
    keys = (map_arrow(docs.select("text"), _parts, PARTS).groupBy("key")
            .agg(F.count("*").alias("n"), F.min("line").alias("a"), F.max("line").alias("b")))
    # parts of different lines, or a line found again
    sent = docs.sparkSession.sparkContext.broadcast(marks(keys.where("a <> b or (n > 1 and a = key)").select("key")))

    def work(batches):
        known = sent.value
        for b in batches:
            for at, part in slices(b.column("text")):
                lines = _Lines(part)
                keys, index = lines.parts()
                near = np.zeros(len(lines.hash), bool)
                near[index[marked(known, keys)]] = True
                wanted = np.flatnonzero(near | marked(known, lines.hash))
                for name in ("low", "high", "row", "number", "hash", "n"):
                    setattr(lines, name, getattr(lines, name)[wanted])
                flat, first = lines.variants(near[wanted])
                ids, bodies = (b.column(c).slice(at, part.n).take(pa.array(lines.row)) for c in ("doc_id", "body"))
                yield pa.RecordBatch.from_arrays([pa.array(signed(lines.hash)), ids, bodies, pa.array(lines.number, pa.int32()),
                                                  lists(signed(flat), first, pa.int64())], schema=FOUND)

    return map_arrow(docs.select(F.col("doc_id").cast("bigint"), F.expr(BODY).alias("body"), "text"), work, FOUND)


def _shared_variants(found: DataFrame) -> DataFrame:
    """(key, at, line, doc_id, body, number): variants that are a variant or the whole of another line too."""
    near = found.where(F.size("variants") > 0)
    keys = near.select("line", F.explode("variants").alias("key")).unionByName(near.select("line", F.col("line").alias("key")))
    sent = found.sparkSession.sparkContext.broadcast(
        marks(keys.groupBy("key").agg(F.min("line").alias("a"), F.max("line").alias("b")).where("a <> b").select("key")))

    def work(batches):
        for b in batches:
            column = b.column("variants")
            n = pc.list_value_length(column).to_numpy()
            flat = column.flatten().to_numpy()
            of = np.repeat(np.arange(len(n)), n)
            hit = np.flatnonzero(marked(sent.value, flat.view(np.uint64)))
            at = np.arange(len(flat)) - np.repeat(np.cumsum(n) - n, n)
            rows = b.take(pa.array(of[hit]))
            yield batch(VARIANT, flat[hit], at[hit], *(rows.column(c) for c in ("line", "doc_id", "body", "number")))

    return map_arrow(near, work, VARIANT)


def removed_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, body, number) of every line to remove; body is the hash of its document's text."""
    found = keep(candidates(docs), "lines")
    place = F.struct(*PLACE)
    firsts = keep(found.groupBy("line").agg(F.min(place).alias("first"), F.max(F.size("variants") > 0).alias("near")), "firsts")
    near = _shared_variants(found).groupBy("key", "at", "line").agg(F.min(place).alias("first"))
    own = firsts.where("near").select(F.col("line").alias("key"), F.lit(-1).alias("at"), "line", "first")
    rows = keep(near.unionByName(own), "variants")
    by_place = rows.groupBy("key", "at").agg(F.min("first").alias("same"), F.min("line").alias("a"), F.max("line").alias("b"))
    # a key is of use if it has two lines
    by_key = (by_place.groupBy("key").agg(F.min("a").alias("a"), F.max("b").alias("b"), F.min(F.when(F.col("at") < 0, F.col("same"))).alias("whole"),
                                          F.min(F.when(F.col("at") >= 0, F.col("same"))).alias("longer"))
              .where("a <> b").drop("a", "b"))
    earliest = F.when(F.col("at") < 0, F.col("longer")).otherwise(F.least("same", "whole"))
    others = (rows.join(by_key, "key").join(by_place.drop("a", "b"), ["key", "at"])
              .groupBy("line").agg(F.min(earliest).alias("earliest")))
    # written first, so that the join with a line's copies stands alone and Spark can split a line with many
    verdict = keep(firsts.join(others, "line", "left"), "verdicts")
    place = F.struct(*(found[c] for c in PLACE))
    gone = (F.col("earliest") < F.col("first")) | (place != F.col("first"))
    return found.join(verdict, "line").where(F.coalesce(gone, F.lit(False))).select(*(found[c] for c in PLACE))


@F.pandas_udf(StringType())
def _without(text: pd.Series, gone: pd.Series) -> pd.Series:
    """Texts without their lines of the numbers in gone; null where nothing goes."""
    out = []
    for x, numbers in zip(text, gone):
        if numbers is None:
            out.append(None)
            continue
        lines = x.split("\n")
        stay = np.ones(len(lines), bool)
        stay[numbers] = False
        out.append("\n".join(line for line, stays in zip(lines, stay) if stays))
    return pd.Series(out, dtype=object)


def _cut(docs: DataFrame) -> DataFrame:
    """The documents with the shortened text as __dedup_text and the numbers of the removed lines as __dedup_gone, null if none goes."""
    gone = (removed_lines(docs).groupBy(F.col("doc_id").alias("__dedup_id"), F.col("body").alias("__dedup_body"))
            .agg(F.collect_set("number").alias("__dedup_gone")))
    rows = docs.join(gone, F.col("doc_id").eqNullSafe(F.col("__dedup_id")) & (F.expr(BODY) == F.col("__dedup_body")), "left")
    # only texts that lose lines go to Python
    cut = _without(F.when(F.col("__dedup_gone").isNotNull(), F.col("text")), "__dedup_gone")
    return rows.withColumn("__dedup_text", F.coalesce(cut, "text")).drop("__dedup_id", "__dedup_body")


def without_repeats(docs: DataFrame) -> DataFrame:
    """The documents without the removed lines; columns of any other name stay as they are."""
    columns = docs.columns
    return _cut(docs).select(*(F.col("__dedup_text").alias(c) if c == "text" else F.col(f"`{c}`") for c in columns))


def dedup_lines(docs: DataFrame) -> DataFrame:
    """The documents without the removed lines, with n_lines and n_removed."""
    newlines = F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit("")))
    return (_cut(docs.drop("n_lines", "n_removed")).withColumn("n_lines", F.coalesce(newlines + 1, F.lit(0)).cast("bigint"))
            .withColumn("n_removed", F.coalesce(F.array_size("__dedup_gone"), F.lit(0)).cast("bigint"))
            .withColumn("text", F.col("__dedup_text")).drop("__dedup_text", "__dedup_gone"))


@query("op3_line_dedup")
def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = dedup_lines(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))
