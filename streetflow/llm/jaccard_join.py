"""N-gram Jaccard join in metric space: pivots, triangle-inequality windows and recursive regions, exact.

A document's set holds its distinct shingles of some words (`Rule.shingle`), words being runs without ASCII white
space with A-Z lower-cased; shorter texts are one shingle, texts without words have none and link
with nothing. Two documents link at a Jaccard similarity of at least `Rule.percent`, so at a distance
of at most the radius. The query asks for 3 words and 90 percent, the pipeline for 5 and 80. The result gives each
document the smallest id that it reaches by links.

Equal sets are one point. In this space almost all points lie at distance 1 from each other, so
pivots are set where neighbours are: the radius bounds how many shingles two linked sets can differ
in; of one part more than that, cut by shingle hash and not empty, linked sets agree in one at least. So each set
takes its first so many parts in one order for all, and linked sets meet in a region, the points that agree in one part. Parts that occur in
more than POPULAR texts come last in that order, so that what many texts share, like a passage, brings together only texts that have little else.
There are enough parts for that in nearly all sets. (A set with too few that are not empty takes them all, and meets
others like it by the least-hash prefix of its shingles as well.) Each region takes as pivot
the point that shares most of its parts with others, the core of a group of copies if there is one,
and the regions of one pivot form its cell. Every point's distance to its pivots is measured.

Points within the radius of a pivot link with it. The rest need comparing only where a cell still has
several components, and of two linked points of different components one at least lies beyond the radius.
Few points of a cell are compared where their distances to the pivot differ by at most the radius, by the
triangle inequality. Many near the pivot, and still more far from it, are divided by what they differ in from it: the
inequality, counted in shingles, says how many of its differences a point must share with any other that
it may link with, so both meet at one of the first few differences, shingles that the pivot lacks coming
first, of these the rarest. Points that meet so make the next regions, whose pivots are their points nearest to the old
pivot; boundary points stand in several. A pivot is in no region of its own cell, so cells shrink until
none is open, or until the pairs of all that are left are few beside the points of the table, and are compared at once; no
pairs within a component are formed. Points of such large cells with more shingles of their own than
linked sets can differ in are left out first, as they link with nothing.

A distance is measured in steps. Bitmaps of fixed size, which hold the parity of what falls in each place, rule out most
pairs of a cell in the join that forms them. A sketch holds one byte for each of about as many cells of the
hash space as the set has shingles (half as many for large sets), the sum of what falls in it; two sets differ in at least as
many shingles as their sketches differ in cells. Where that bound already exceeds the radius it is
used as the distance's lower bound; the shingles themselves are fetched for the other pairs only.

Regions are found by counting first: parts that occur in one point only are left out by a bitmap of
fixed size, which only spares work.

Null and empty texts: no shingles, a component of their own. Null ids stay null and name no component.
Equal rows are equal points. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from functools import cache, partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streetflow.llm.components import components
from streetflow.llm.tables import drop_shuffles, keep, map_arrow, marked, marks, query, release, table
from streetflow.llm.textscan import Slice, batch, lists, mix, signed, slices

SHINGLE = 3
PERCENT = 90
#: Below it linked sets can be more than one step of _BOUNDS apart.
LEAST_PERCENT = 70
#: Points nearer to their pivot than NEAR are compared in pairs if the cell has at most FEW of them, others if it has at most MANY.
NEAR = 0.5
#: Parts in more texts than this are used last.
POPULAR = 32
FEW = 128
MANY = 256
#: All large cells of a round are compared in pairs once these are at most so many for each point.
PAIRS = 256
#: Rows of a cell that meet all others of it in one task.
SHARE = 512
#: Numbers of sets from which on a shingle of divided cells is used later.
RARITY = (2, 8, 32, 128, 512, 4096)
#: Bytes of texts whose sets are made at once: for each, the parts of its sets take some hundred bytes of a task's memory.
SET_BYTES = 1 << 19
#: Bitmaps of 64 bits that tell most pairs apart before their sketches are compared.
MAPS = [f"map{i}" for i in range(8)]

POINT = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("point", pa.int64())])
MEETING = pa.schema([("region", pa.int64()), ("point", pa.int64())])
MEMBER = pa.schema([("point", pa.int64()), ("regions", pa.list_(pa.int64())), ("n", pa.int64()), ("sketch", pa.binary()),
                    *((c, pa.int64()) for c in MAPS)])
GRAMS = pa.schema([("point", pa.int64()), ("grams", pa.list_(pa.int64()))])
RANKED = pa.schema([*GRAMS, ("live", pa.bool_())])
BOUND = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("low", pa.float64()), ("may_link", pa.bool_())])

#: Sizes at which one count of parts ends and the next begins, each 1.5 times the one before.
_BOUNDS = [1]
while _BOUNDS[-1] < 1 << 40:
    _BOUNDS.append(max(_BOUNDS[-1] + 1, _BOUNDS[-1] * 3 // 2))
_BOUNDS = np.array(_BOUNDS, np.int64)


@cache
def _parting(percent: int) -> tuple[np.ndarray, np.ndarray]:
    """For each span of sizes, in how many shingles linked sets differ at most, and into how many parts they are cut.

    So many parts that even the smallest set of the span has a quarter more that are not empty than
    the shingles it may differ in, by mean and two deviations; where the sets are too small for that, twice as many as shingles.
    """
    low, top = _BOUNDS[:-1].astype(float), _BOUNDS[1:] - 1
    differ = (100 - percent) * (top + 100 * top // percent) // (100 + percent)
    parts = differ + 2.0
    for _ in range(100):
        empty = np.exp(-low / parts)
        few = (parts * (1 - empty) - 2 * np.sqrt(parts * empty) < 1.25 * (differ + 1)) & (parts < 2 * low)
        parts = np.where(few, parts * 1.05, parts)
    return differ, np.ceil(parts).astype(np.int64)


class Rule(NamedTuple):
    """Words a shingle, and the least similarity of linked documents."""

    shingle: int = SHINGLE
    percent: int = PERCENT

    @property
    def radius(self) -> float:
        return 1 - self.percent / 100


class _Sets:
    """Sets of a slice: sorted distinct hashes of all texts in a row, with the bounds of each text's own."""

    def __init__(self, part: Slice, rule: Rule):
        self.percent, size = rule.percent, rule.shingle
        part.words()
        w = part.hashes()
        n = np.diff(part.first)
        self.parts, sizes = [], np.zeros(part.n, np.int64)
        if len(w) >= size:
            grams = w[: len(w) - size + 1].copy()
            for k in range(1, size):
                grams = mix(grams + np.uint64(k)) + w[k: len(w) - size + 1 + k]
            grams = mix(grams)
        for i in range(part.n):
            low, high = part.first[i], part.first[i + 1]
            if n[i] >= size:
                own = np.unique(grams[low: high - size + 1])
            elif n[i]:
                whole = np.uint64(n[i])
                for k in range(low, high):
                    whole = mix(np.array([whole]))[0] ^ w[k]
                own = mix(np.array([whole]))
            else:
                own = np.zeros(0, np.uint64)
            self.parts.append(own)
            sizes[i] = len(own)
        self.n = sizes
        self.grams = np.concatenate(self.parts) if self.parts else np.zeros(0, np.uint64)
        self.first = np.concatenate([[0], np.cumsum(sizes)])
        sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(self.grams ^ np.uint64(0x5851F42D4C957F2D)))])
        self.point = mix(sums[self.first[1:]] - sums[self.first[:-1]] + sizes.astype(np.uint64))

    def sketches(self, chosen: np.ndarray) -> list[bytes]:
        """Per text the sums modulo 256 over 2**k cells of its hash space, about as many as its size, half for 512 or more."""
        out = []
        for i in chosen:
            grams = self.parts[i]
            k = int(self.n[i]).bit_length() - (1 if self.n[i] < 512 else 2)
            cells = (grams >> np.uint64(64 - k)).astype(np.int64) if k else np.zeros(len(grams), np.int64)
            sums = np.bincount(cells, ((mix(grams) & np.uint64(255)) | np.uint64(1)).astype(np.float64), 1 << k)
            out.append((sums.astype(np.int64) & 255).astype(np.uint8).tobytes())
        return out

    def maps(self, chosen: np.ndarray) -> np.ndarray:
        """Per text, for each place of its bitmaps, whether an odd number of its shingles falls there."""
        places = 64 * len(MAPS)
        out = np.zeros((len(chosen), places // 8), np.uint8)
        for row, i in enumerate(chosen):
            at = (mix(self.parts[i]) >> np.uint64(32)) % np.uint64(places)
            out[row] = np.packbits(np.bincount(at.astype(np.int64), minlength=places) & 1)
        return out.view(np.int64)

    def regions(self, popular: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(region, text) of parts of which linked texts agree in one at least; of all parts without a bitmap of the popular ones."""
        band = np.searchsorted(_BOUNDS, self.n, "right") - 1
        keys, texts = [], []
        percent = self.percent
        differs, parts_of = _parting(percent)
        lower = np.where(100 * (_BOUNDS[np.maximum(band, 1)] - 1) >= percent * self.n, band - 1, -1)
        for space in (band, lower):
            differ = differs[np.maximum(space, 0)]
            chosen = np.flatnonzero((space >= 0) & (self.n > 0) & (differ > 0))
            if not len(chosen):
                continue
            size = self.n[chosen]
            of = np.repeat(np.arange(len(chosen)), size)
            at = np.repeat(self.first[chosen] - np.concatenate([[0], np.cumsum(size)])[:-1], size) + np.arange(size.sum())
            grams, parts = self.grams[at], parts_of[space[chosen]].astype(np.uint64)
            # grams are sorted, so a text's parts are consecutive
            part = ((grams >> np.uint64(32)) * parts[of]) >> np.uint64(32)
            new = np.ones(len(of), bool)
            new[1:] = (of[1:] != of[:-1]) | (part[1:] != part[:-1])
            begins = np.flatnonzero(new)
            sums = np.add.reduceat(mix(grams), begins)
            text = of[begins]
            label = part[begins] + (space[chosen][text].astype(np.uint64) << np.uint64(48))
            own = mix(sums ^ mix(label + np.uint64(1)))
            if popular is not None:
                order = np.lexsort((part[begins], marked(popular, own), text))
                wanted = order[np.arange(len(text)) - np.searchsorted(text, text) <= differ[chosen][text]]
                own, of_own = own[wanted], text[wanted]
            else:
                of_own = text
            keys.append(own)
            texts.append(chosen[of_own])
            sparse = np.flatnonzero(np.bincount(text, minlength=len(chosen)) <= differ[chosen])
            for i in sparse:
                low, k = self.first[chosen[i]], int(self.n[chosen[i]])
                prefix = self.grams[low: low + k - -(-percent * k // 100) + 1]
                keys.append(mix(prefix ^ mix(np.array([space[chosen[i]]], np.uint64) + np.uint64(7))))
                texts.append(np.full(len(prefix), chosen[i]))
        if not keys:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        return np.concatenate(keys), np.concatenate(texts)


def _points(rule, batches):
    for b in batches:
        for at, part in slices(b.column("text"), True, SET_BYTES):
            found = _Sets(part, rule)
            yield batch(POINT, b.column("doc_id").slice(at, part.n), found.n, signed(found.point))


def _meetings(rule, batches):
    for b in batches:
        for _, part in slices(b.column("text"), True, SET_BYTES):
            found = _Sets(part, rule)
            keys, texts = found.regions()
            yield batch(MEETING, signed(keys), signed(found.point[texts]))


def members(docs: DataFrame, rule: Rule) -> DataFrame:
    """(point, regions, n, sketch) of the points that share a region with another point."""
    counts = keep(map_arrow(docs.select("text"), partial(_meetings, rule), MEETING).groupBy("region")
                  .agg(F.min("point").alias("a"), F.max("point").alias("b"), F.count("*").alias("n")).where("a <> b")
                  .select("region", (F.col("n") > POPULAR).alias("popular")), "counts")
    sent = docs.sparkSession.sparkContext.broadcast((marks(counts.select("region")), marks(counts.where("popular").select("region"))))
    release(counts)

    def work(batches):
        for b in batches:
            for _, part in slices(b.column("text"), True, SET_BYTES):
                found = _Sets(part, rule)
                shared, popular = sent.value
                keys, texts = found.regions(popular)
                hit = marked(shared, keys)
                keys, texts = keys[hit], texts[hit]
                order = np.argsort(texts, kind="stable")
                chosen, n = np.unique(texts, return_counts=True)
                yield batch(MEMBER, signed(found.point[chosen]), lists(signed(keys[order]), np.concatenate([[0], np.cumsum(n)]), pa.int64()),
                            found.n[chosen], found.sketches(chosen), *found.maps(chosen).T)

    rows = map_arrow(docs.select("text"), work, MEMBER)
    return rows.groupBy("point").agg(*(F.first(c).alias(c) for c in ("regions", "n", "sketch", *MAPS)))


def grams_of(docs: DataFrame, points: DataFrame, rule: Rule) -> DataFrame:
    """(point, grams) of some points, from one more pass over the texts."""
    sent = docs.sparkSession.sparkContext.broadcast(marks(points))

    def work(batches):
        for b in batches:
            for _, part in slices(b.column("text"), True, SET_BYTES):
                found = _Sets(part, rule)
                chosen = np.flatnonzero(marked(sent.value, found.point) & (found.n > 0))
                own = [found.parts[i] for i in chosen] or [np.zeros(0, np.uint64)]
                sizes = np.concatenate([[0], np.cumsum(found.n[chosen])])
                yield batch(GRAMS, signed(found.point[chosen]), lists(signed(np.concatenate(own)), sizes, pa.int64()))

    rows = map_arrow(docs.select("text"), work, GRAMS).join(points.toDF("point").distinct(), "point", "left_semi")
    return rows.groupBy("point").agg(F.first("grams").alias("grams"))


def _folded(sketch: np.ndarray, cells: int) -> np.ndarray:
    """A sketch over fewer cells."""
    return sketch.reshape(cells, -1).sum(axis=1, dtype=np.uint8)


def _bounds(percent, batches):
    for b in batches:
        low, may = [], []
        for na, nb, sa, sb in zip(b.column("na").to_pylist(), b.column("nb").to_pylist(), b.column("sa"), b.column("sb")):
            one, two = np.frombuffer(sa.as_py(), np.uint8), np.frombuffer(sb.as_py(), np.uint8)
            cells = min(len(one), len(two))
            differ = max(int(np.count_nonzero(_folded(one, cells) != _folded(two, cells))), abs(na - nb))
            low.append(2 * differ / (na + nb + differ))
            may.append(100 * (na + nb - differ) >= percent * (na + nb + differ))
        yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b"), pa.array(low, pa.float64()), pa.array(may, pa.bool_())], schema=BOUND)


def _exact(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """pairs(a, b) with their distance as low and high, and whether they link."""
    both = F.size(F.array_intersect("ga", "gb"))
    either = F.size("ga") + F.size("gb") - both
    d = 1 - both / either
    return (pairs.join(sets.select(F.col("point").alias("a"), F.col("grams").alias("ga")), "a")
            .join(sets.select(F.col("point").alias("b"), F.col("grams").alias("gb")), "b")
            .select("a", "b", d.alias("low"), d.alias("high"), (100 * both >= percent * either).alias("linked")))


def _measured(pairs: DataFrame, found: DataFrame, docs: DataFrame, rule: Rule, sets: DataFrame | None = None) -> DataFrame:
    """pairs(a, b) with bounds low and high of their distance, and whether they link, as a table; sets: their shingles, if at hand."""
    one, two = (found.select(F.col("point").alias(x), F.col("n").alias(f"n{x}"), F.col("sketch").alias(f"s{x}")) for x in "ab")
    bounds = keep(map_arrow(pairs.join(one, "a").join(two, "b").select("a", "b", "na", "nb", "sa", "sb"), partial(_bounds, rule.percent), BOUND), "bounds")
    asked = bounds.where("may_link").select("a", "b")
    sure = _exact(asked, grams_of(docs, asked.select("a").union(asked.select("b")), rule) if sets is None else sets, rule.percent)
    rows = keep(sure.union(bounds.where("not may_link").select("a", "b", "low", F.lit(1.0).alias("high"), F.lit(False).alias("linked"))), "measured")
    release(bounds)
    return rows


def links(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """(v, root) of all points that link with another; root names their component."""
    found = keep(members(docs, rule), "members")
    meet = keep(found.select(F.lit(0).cast("bigint").alias("parent"), F.explode("regions").alias("region"), "point",
                             (-F.size("regions")).alias("rank")), "meetings")
    drop_shuffles(docs.sparkSession)
    linked = sets = None
    points = found.count()
    while True:
        cells = _cells(meet)
        d = _measured(_asked(cells), found, docs, rule, sets)
        more = keep(d.where("linked").select("a", "b"), "links")
        linked = more if linked is None else linked.union(more)
        roots = components(linked)
        open_ = keep(_open(cells, d, roots), "open")
        release(cells, d, meet)
        large = open_.where(f"far_n > {MANY} or (near_n > {FEW} and near)")
        whole = _few_pairs(open_, points)
        pairs = _pairs(open_, found, rule, whole)
        if not pairs.isEmpty():
            close = _measured(pairs, found, docs, rule, sets)
            linked = linked.union(keep(close.where("linked").select("a", "b"), "links"))
            release(roots, close)
            roots = components(linked)
        release(pairs)
        if whole or large.isEmpty():
            release(open_, found, *([] if sets is None else [sets]))
            return roots
        if sets is None:
            plain = keep(grams_of(docs, large.select("point").union(large.select("pivot")), rule), "plain")
            sets = keep(_ranked(plain, rule.percent), "sets")
            release(plain)
            large = large.join(sets.where("live"), "point", "left_semi")
        meet = _divided(large, roots, sets, rule.percent)
        release(open_, roots)
        drop_shuffles(docs.sparkSession)


def _cells(meet: DataFrame) -> DataFrame:
    """(cell, pivot, point): regions with the same pivot and parent in one, the pivot itself left out."""
    pivots = (meet.groupBy("parent", "region").agg(F.min(F.struct("rank", "point")).alias("first"), F.min("point").alias("low"), F.max("point").alias("high"))
              .where("low <> high").select("parent", "region", F.col("first.point").alias("pivot")))
    rows = meet.join(pivots, ["parent", "region"]).where("point <> pivot").select("parent", "pivot", "point").distinct()
    return keep(rows.select(F.xxhash64("parent", "pivot").alias("cell"), "pivot", "point"), "cells")


def _asked(cells: DataFrame) -> DataFrame:
    return cells.select(F.col("point").alias("a"), F.col("pivot").alias("b")).distinct()


def _rooted(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """rows with the components of their point and their pivot as root and main."""
    for point, name in (("point", "root"), ("pivot", "main")):
        rows = rows.join(roots.select(F.col("v").alias(point), F.col("root").alias(name)), point, "left").withColumn(name, F.coalesce(name, point))
    return rows


def _open(cells: DataFrame, d: DataFrame, roots: DataFrame) -> DataFrame:
    """(cell, pivot, point, low, high, root, main, near, near_n, far_n) of the cells with several components; n: so many points."""
    d = d.select(F.col("a").alias("point"), F.col("b").alias("pivot"), "low", "high", (F.col("low") <= NEAR).alias("near"))
    rows = _rooted(cells, roots).join(d, ["point", "pivot"])
    counts = (rows.groupBy("cell").agg(F.count_if("near").alias("near_n"), F.count_if(~F.col("near")).alias("far_n"),
                                       F.max(F.col("root") != F.col("main")).alias("several"))
              .where("several and near_n + far_n > 1").drop("several"))
    return rows.join(counts, "cell").select("cell", "pivot", "point", "low", "high", "root", "main", "near", "near_n", "far_n")


def _few_pairs(cells: DataFrame, points: int) -> bool:
    """Whether all points of large cells can be compared in pairs, at most PAIRS for each point of the table."""
    large = cells.where(f"far_n > {MANY} or near_n > {FEW}").select("cell", (F.col("near_n") + F.col("far_n")).alias("n")).distinct()
    return (large.agg(F.sum(F.col("n").cast("double") * F.col("n"))).first()[0] or 0) <= 2 * PAIRS * points


def _pairs(cells: DataFrame, found: DataFrame, rule: Rule, whole: bool) -> DataFrame:
    """Pairs (a, b) that may link and join two components, of near points where they are few, and with far points where these are; of all if whole.

    A place of the bitmaps in which two sets disagree holds a shingle that only one of them has, and linked
    sets of n and m shingles differ in at most (n + m) r, r = (100 - percent) / (100 + percent); large sets disagree in fewer places and go on to the sketches.
    """
    few, many = ("true", "true") if whole else (f"near_n <= {FEW}", f"far_n <= {MANY}")
    # a large cell's points are dealt to shares, each of which meets all points of the cell
    shares = F.ceil((F.col("near_n") + F.col("far_n")) / SHARE).cast("int") if whole else F.lit(1)
    cells = compared = keep(cells.where(f"{few} or {many}").join(found.select("point", "n", *MAPS), "point").withColumn("shares", shares), "compared")
    carried = ["near", "point", "low", "high", "root", "n", *MAPS]
    other = cells.select("cell", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"), *(F.col(c).alias(f"{c}_p") for c in carried))
    cells = cells.withColumn("share", F.pmod(F.xxhash64("point"), F.col("shares")).cast("int"))
    reach = rule.radius + 1e-9
    differ = " + ".join(f"bit_count({c} ^ {c}_p)" for c in MAPS)
    may = ((F.col("low") <= F.col("high_p") + reach) & (F.col("low_p") <= F.col("high") + reach) & (F.col("root") != F.col("root_p"))
           & F.expr(f"{differ} <= ({100 - rule.percent} * (n + n_p)) div {100 + rule.percent}"))
    on = ["cell", "share"]
    near = cells.where(F.expr(few) & F.col("near")).join(other.where("near_p"), on).where(may & (F.col("point") < F.col("point_p")))
    far = (cells.where(F.expr(many) & ~F.col("near")).join(other, on)
           .where(may & (F.col("near_p") | (F.col("point") < F.col("point_p")))))
    pair = [F.least("point", "point_p").alias("a"), F.greatest("point", "point_p").alias("b")]
    pairs = keep(near.select(*pair).union(far.select(*pair)).distinct(), "pairs")
    release(compared)
    return pairs


def _ranked(sets: DataFrame, percent: int) -> DataFrame:
    """sets with their shingles in the order of `RARITY`, least hash first among equals, and whether a point may link with another.

    A set of n shingles that links with another has at most n q, q = (100 - percent) / percent, that the
    other lacks, so no more than these may be in no other set. Shingles of several sets are found by their upper 32 bits and
    sent as bitmaps, so some count as shared, or as more frequent, that are not: that leaves more points in, and the order is one for all sets still.
    """
    upper = F.shiftright("gram", 32).cast("int").alias("gram")
    counts = keep(sets.select(F.explode("grams").alias("gram")).groupBy(upper).agg(F.count("*").alias("n")).where(f"n >= {RARITY[0]}")
                  .select(F.shiftleft(F.col("gram").cast("bigint"), 32).alias("gram"), "n"), "frequencies")
    sent = sets.sparkSession.sparkContext.broadcast([marks(counts.where(F.col("n") >= least).select("gram")) for least in RARITY])
    release(counts)

    def work(batches):
        for b in batches:
            n = pc.list_value_length(b.column("grams")).to_numpy().astype(np.int64)
            grams = b.column("grams").flatten().to_numpy().view(np.uint64)
            level = sum(marked(bits, grams).astype(np.int8) for bits in sent.value)
            ends = np.cumsum(n)
            sums = np.concatenate([[0], np.cumsum(level == 0)])
            may = sums[ends] - sums[ends - n] <= (100 - percent) * n // percent
            order = np.lexsort((grams, level, np.repeat(np.arange(len(n)), n)))
            yield batch(RANKED, b.column("point"), lists(signed(grams[order]), np.concatenate([[0], ends]), pa.int64()), may)

    return map_arrow(sets.select("point", "grams"), work, RANKED)


def _divided(cells: DataFrame, roots: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(parent, region, point, rank): the regions of points that share a difference from their pivot.

    Linked sets of n and m shingles differ in at most (n + m) r, r = (100 - percent) / (100 + percent),
    and in at most n q, q = (100 - percent) / percent. Let them differ from a pivot of k shingles in d
    and e. They then share at least (d + e - (n + m) r) / 2 of these differences, so at least d - n q.
    If the second does not link with the pivot, e > (m + k) r, and they share more than (d + (k - n) r) / 2. A point of the pivot's component
    need meet only such seconds, and so takes fewer differences than a point outside, whose
    further ones count only in regions with a point of the pivot's component. The rarest differences come first, in an order that
    `_ranked` sets and `array_except` keeps, so that passages of many texts do not bring their texts together again in every round.
    """
    rows = _rooted(cells.select("cell", "pivot", "point"), roots)
    sides = (rows.join(sets.select("point", F.col("grams").alias("gx")), "point")
             .join(sets.select(F.col("point").alias("pivot"), F.col("grams").alias("gp")), "pivot")
             .select("cell", "point", "root", (F.col("root") != F.col("main")).alias("outside"), F.size("gx").alias("n"), F.size("gp").alias("k"),
                     F.concat(F.array_except("gx", "gp"), F.array_except("gp", "gx")).alias("differ")))
    shared = F.greatest(F.lit(1), F.expr(f"d - {100 - percent}L * n div {percent}"))
    sides = (sides.withColumn("d", F.size("differ")).withColumn("any", F.col("d") - shared + 1)
             .withColumn("far", F.least("any", F.expr(f"d - ({100 + percent}L * d + {100 - percent}L * (k - n)) div {2 * (100 + percent)}"))))
    firsts = F.slice("differ", F.lit(1), F.when(F.col("outside"), F.col("any")).otherwise(F.col("far")).cast("int"))
    rows = sides.select("cell", "point", "root", "outside", "d", "far", F.posexplode(firsts).alias("at", "gram"))
    rows = keep(rows.select(F.col("cell").alias("parent"), F.xxhash64("cell", "gram").alias("region"), "point", "root", F.col("d").alias("rank"),
                            "outside", (F.col("outside") & (F.col("at") >= F.col("far"))).alias("further")), "differences")
    used = (rows.groupBy("parent", "region").agg(F.min("root").alias("a"), F.max("root").alias("b"), F.min("outside").alias("all_outside"))
            .where("a <> b").select("parent", "region", "all_outside"))
    meet = keep(rows.join(used, ["parent", "region"]).where("not (further and all_outside)").select("parent", "region", "point", "rank"), "meetings")
    release(rows)
    return meet


def join(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document."""
    if not (shingle >= 1 and LEAST_PERCENT <= percent < 100):
        raise ValueError(f"shingle must be at least 1 and percent from {LEAST_PERCENT} to 99, not {shingle} and {percent}")
    rule = Rule(shingle, percent)
    docs = docs.select(F.col("doc_id").cast("bigint"), "text")
    points = keep(map_arrow(docs, partial(_points, rule), POINT), "points")
    own = points.where("n_shingles > 0").groupBy("point").agg(F.min("doc_id").alias("least"))
    rooted = own.join(links(docs, rule).withColumnRenamed("v", "point"), "point", "left").withColumn("root", F.coalesce("root", "point"))
    rooted = keep(rooted, "rooted")
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    of_point = rooted.join(named, "root").select(F.col("point").alias("_point"), "component_id")
    rows = points.join(of_point, (F.col("point") == F.col("_point")) & (F.col("n_shingles") > 0), "left")
    return rows.select("doc_id", "n_shingles", F.coalesce("component_id", F.when(F.col("n_shingles") == 0, F.col("doc_id"))).alias("component_id"))


SQL = """
with w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') as ws from documents),
s as (select distinct doc_id, unnest(case when len(ws) = 0 then [] when len(ws) < 3 then [array_to_string(ws, ' ')]
                                     else [ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] for i in range(1, len(ws) - 1)] end) as g from w),
n as (select doc_id, count(*) as n from s group by doc_id),
i as (select a.doc_id as x, b.doc_id as y, count(*) as c from s a join s b on a.g = b.g and a.doc_id < b.doc_id group by all),
l as (select x, y from i join n p on p.doc_id = x join n q on q.doc_id = y where 100 * c >= 90 * (p.n + q.n - c)),
e as (select x, y from l union all select y, x from l),
r as (with recursive r(doc_id, to_id) as (select doc_id, doc_id from w union select r.doc_id, e.y from r join e on r.to_id = e.x) select * from r)
select w.doc_id, coalesce(n, 0)::bigint as n_shingles, min(to_id) as component_id from w left join n on n.doc_id = w.doc_id join r on r.doc_id = w.doc_id group by all
"""


@query("op4_jaccard_join", SQL)
def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join(table(spark, sf_dir, "documents"), SHINGLE, PERCENT)
