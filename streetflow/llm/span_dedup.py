"""Substring dedup by relative Lempel-Ziv parsing with an index of reference blocks.

A window is WINDOW consecutive words. Each window has an anchor: of the GRAM-word sequences in it
the one with the least hash, so equal windows have equal anchors at equal places. The windows of a
document that share an anchor are a block: the words they cover, 50 to 84 of them. All blocks of
all documents are the reference; its index is the anchor.

A document is parsed greedily against the blocks of documents with smaller ids. A block that
occurs whole in one is a factor, and all its windows are duplicates; neighbouring blocks overlap by
WINDOW - 1 words, so chains of them are the long factors of the parse. A block whose anchor has
other blocks but not this one earlier is where a factor may begin or end: its windows are compared
with those blocks' one by one. The words under duplicate windows are the spans to remove.

Blocks are compared by 64-bit hashes of anchor and words. A bitmap of fixed size leaves out blocks
whose anchor occurs once in all documents; it only spares work.

Null text has no words; a document without id is neither judged nor a reference; documents with
equal ids don't count against each other; texts under WINDOW words are left alone. An empty table
gives an empty result, other columns are passed through.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streetflow.llm.tables import keep, map_arrow, marked, marks, query, table
from streetflow.llm.textscan import SLICE_BYTES, Slice, batch, lists, range_hash, signed, slices

WINDOW = 50
GRAM = 16

ANCHOR = pa.schema([("anchor", pa.int64())])
BLOCK = pa.schema([("anchor", pa.int64()), ("block", pa.int64()), ("doc_id", pa.int64()), ("low", pa.int64()), ("n", pa.int64())])
WINDOWS = pa.schema([("anchor", pa.int64()), ("block", pa.int64()), ("doc_id", pa.int64()), ("windows", pa.list_(pa.int64()))])
PARSED = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())])


def _least(keys: np.ndarray, width: int) -> np.ndarray:
    """Least of each `width` consecutive keys, by running minima of blocks from both ends."""
    n = len(keys) - width + 1
    padded = np.full(-(-len(keys) // width) * width, np.uint64(2**64 - 1))
    padded[: len(keys)] = keys
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1: width - 1 + n])


class _Blocks:
    """Blocks of a slice: text, first window (a word number), number of windows, hashes of anchor and words."""

    def __init__(self, part: Slice):
        part.words()
        words = part.hashes()
        starts = np.flatnonzero(part.rows[: -WINDOW + 1] == part.rows[WINDOW - 1:]) if len(words) >= WINDOW else np.zeros(0, np.int64)
        self.words = words
        if not len(starts):
            self.row = self.low = self.n = self.in_text = np.zeros(0, np.int64)
            self.anchor = self.block = np.zeros(0, np.uint64)
            return
        at = np.arange(len(words) - GRAM + 1)
        grams = range_hash(words, at, at + GRAM)
        bits = max(24, int(len(words)).bit_length())
        places = np.uint64((1 << bits) - 1)
        least = _least((grams & ~places) | at.astype(np.uint64), WINDOW - GRAM + 1)
        where = (least[starts] & places).astype(np.int64)
        new = np.ones(len(starts), bool)
        new[1:] = (where[1:] != where[:-1]) | (starts[1:] != starts[:-1] + 1)
        first = np.flatnonzero(new)
        self.low = starts[first]
        self.n = np.diff(np.append(first, len(starts)))
        self.row = part.rows[self.low]
        self.in_text = self.low - part.first[self.row]
        self.anchor = grams[where[first]]
        self.block = range_hash(words, self.low, self.low + self.n - 1 + WINDOW)

    def only(self, chosen: np.ndarray) -> None:
        for name in ("low", "n", "row", "in_text", "anchor", "block"):
            setattr(self, name, getattr(self, name)[chosen])


def _ids(b: pa.RecordBatch, at: int, part: Slice, rows: np.ndarray) -> pa.Array:
    return b.column("doc_id").slice(at, part.n).take(pa.array(rows))


def _anchors(batches):
    for b in batches:
        for _, part in slices(b.column("text")):
            yield batch(ANCHOR, signed(_Blocks(part).anchor))


def shared_blocks(docs: DataFrame) -> DataFrame:
    """(anchor, block, doc_id, low, n) of the blocks whose anchor occurs again somewhere."""
    counts = map_arrow(docs.select("text"), _anchors, ANCHOR).groupBy("anchor").agg(F.count("*").alias("k"))
    sent = docs.sparkSession.sparkContext.broadcast(marks(counts.where("k > 1").select("anchor")))

    def work(batches):
        for b in batches:
            for at, part in slices(b.column("text")):
                found = _Blocks(part)
                found.only(marked(sent.value, found.anchor))
                yield batch(BLOCK, signed(found.anchor), signed(found.block), _ids(b, at, part, found.row), found.in_text, found.n)

    return map_arrow(docs.select("doc_id", "text"), work, BLOCK)


def boundary_windows(docs: DataFrame, anchors: DataFrame) -> DataFrame:
    """(anchor, block, doc_id, windows): hashes of every window of the blocks that have one of the anchors."""
    sent = docs.sparkSession.sparkContext.broadcast(marks(anchors))

    def work(batches):
        for b in batches:
            for at, part in slices(b.column("text")):
                found = _Blocks(part)
                found.only(marked(sent.value, found.anchor))
                first = np.concatenate([[0], np.cumsum(found.n)])
                starts = np.repeat(found.low - first[:-1], found.n) + np.arange(first[-1])
                windows = signed(range_hash(found.words, starts, starts + WINDOW))
                yield batch(WINDOWS, signed(found.anchor), signed(found.block), _ids(b, at, part, found.row),
                            lists(windows, first, pa.int64()))

    return map_arrow(docs.select("doc_id", "text"), work, WINDOWS)


def duplicate_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, spans): word ranges [low, high) under duplicate windows."""
    docs = docs.select(F.col("doc_id").cast("bigint"), "text").where("doc_id is not null")
    blocks = keep(shared_blocks(docs), "blocks")
    by = ["anchor", "block"]
    firsts = keep(blocks.groupBy(*by).agg(F.min("doc_id").alias("first")), "firsts")
    several = keep(firsts.groupBy("anchor").agg(F.count("*").alias("k")).where("k > 1").select("anchor"), "several")
    ends = boundary_windows(docs, several).groupBy(*by).agg(F.min(F.struct("doc_id", "windows")).alias("e"))
    windows = keep(ends.select(*by, F.col("e.doc_id").alias("first"), F.posexplode("e.windows").alias("at", "window")), "windows")
    earliest = windows.groupBy("window").agg(F.min("first").alias("earliest"), F.max("first").alias("latest")).where("earliest < latest")
    inside = (windows.join(earliest, "window").where("earliest < first").groupBy(*by)
              .agg(F.collect_set("at").alias("inside")))
    # written first, so that the join with a block's copies stands alone and Spark can split a block with many
    verdict = keep(firsts.join(inside, by, "left"), "verdicts")
    rows = blocks.join(verdict, by).where("doc_id > first or inside is not null")
    every = F.array(F.struct(F.col("low").alias("low"), (F.col("low") + F.col("n") + WINDOW - 1).alias("high")))
    some = F.transform("inside", lambda k: F.struct((F.col("low") + k).alias("low"), (F.col("low") + k + WINDOW).alias("high")))
    spans = rows.select("doc_id", F.explode(F.when(F.col("doc_id") > F.col("first"), every).otherwise(some)).alias("span"))
    return spans.groupBy("doc_id").agg(F.collect_list("span").alias("spans"))


def _cut(batches):
    for b in batches:
        out, size = [], 0
        for doc_id, text, spans in zip(b.column("doc_id"), b.column("text").cast(pa.binary()), b.column("spans")):
            words = (text.as_py() or b"").split()
            n = len(words)
            if spans.is_valid:
                pairs = pc.struct_field(spans.values, "low").to_numpy(), pc.struct_field(spans.values, "high").to_numpy()
                edges = np.bincount(pairs[0], minlength=n + 1)[: n + 1] - np.bincount(pairs[1], minlength=n + 1)[: n + 1]
                words = [w for w, depth in zip(words, np.cumsum(edges)) if depth == 0]
            out.append((doc_id.as_py(), n, n - len(words), b" ".join(words).decode()))
            size += len(out[-1][3])
            if size > SLICE_BYTES:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*out), PARSED)], schema=PARSED)
                out, size = [], 0
        yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*out) if out else [[]] * 4, PARSED)], schema=PARSED)


def cut_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): each document without the words under duplicate windows."""
    spans = duplicate_spans(docs).withColumnRenamed("doc_id", "_id")
    rows = docs.select(F.col("doc_id").cast("bigint"), "text").join(spans, F.col("doc_id") == F.col("_id"), "left")
    return map_arrow(rows.select("doc_id", "text", "spans"), _cut, PARSED)


SQL = """
with w as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as ws from documents),
p as (select doc_id, unnest(range(len(ws) - 49)) as i, ws from w where len(ws) >= 50),
h as (select doc_id, i, md5(array_to_string(ws[i + 1:i + 50], ' ')) as k from p),
d as (select doc_id, i from (select *, min(doc_id) over (partition by k) as first from h) where first < doc_id),
c as (select distinct doc_id, i + unnest(range(50)) as i from d),
u as (select doc_id, unnest(range(len(ws))) as i, unnest(ws) as word from w),
r as (select u.doc_id, count(c.i) as n_removed, string_agg(case when c.i is null then word end, ' ' order by u.i) as kept
      from u left join c on u.doc_id = c.doc_id and u.i = c.i group by u.doc_id)
select w.doc_id, len(ws)::bigint as n_words, coalesce(n_removed, 0)::bigint as n_removed, sha256(coalesce(kept, '')) as kept_sha256
from w left join r on w.doc_id = r.doc_id
"""


@query("op5_span_dedup", SQL)
def op5_span_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cut_spans(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
