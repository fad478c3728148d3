"""Benchmark decontamination by latent semantic retrieval.

Words are runs of letters and digits, ASCII letters in lower case, hashed to 2**DIM_BITS
dimensions; weights are term counts times the inverse document frequency over all documents.

Fit: items are taken in blocks of at most RANK, each with a basis of its own, so that the directions
suffice for the items however many there are. For each block a randomised SVD, in Spark tasks, of the
TF-IDF rows of its items and of all passages of FIT_WIDTH words of all documents, on the dimensions of the items' words; a passage
weighs so much that all together weigh FIT_SHARE. Each task
multiplies its rows with random signs and back (one power iteration; the documents' as sums over
pairs of words of a passage, if the block has at most PAIRED_DIMS dimensions), the sums give an
orthonormal basis. The Gram matrix in it, of the items by a second pass over them, of the documents from the same product (Nystrom),
gives the leading RANK directions. What a task sums is bounded by these parameters and the words of a block. The benchmark is the query
set: BLOCKS of it are sent to every task at a time, and each such group has its own pass over the
documents.

Search: every document is cut into overlapping passages, of widths that rise from the shortest to
the longest item by at most STEP, in steps of a sixth, and every passage is compared. Two bounds on its latent cosine with any item are running
sums: the part of its weight that lies on dimensions of the basis, and the sum over its words of
what each adds to its best item at most. Passages below a bound are done at once; the others are
projected, and items with cosine of at least COSINE are candidates. The cosine is divided by the
share of the item's energy that its basis keeps, so that a copy of an item always has cosine 1.
Whatever a passage's other words weigh, places that share ANCHOR_WORDS consecutive words with an
item, or all words of a shorter one, are candidates too; so no verbatim copy of any length is lost.

Check: the longest common subsequence of the item's words with the document's words around the
passage, as a share of the item, and whether the item's answer, its last ANSWER_WORDS words, stands
there too. A document is reported for a share of at least COPIED, or PARAPHRASED with the answer.

Null and empty texts and items without words match nothing; repeated documents and items are each
reported; documents shorter than a passage are one passage. Empty tables give no pairs. Only the
named columns are used.
"""

from __future__ import annotations

from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from streetflow.llm.tables import keep, map_arrow, query, table
from streetflow.llm.textscan import NOT_WORD, Slice, batch, lists, mix, range_hash, slices

DIM_BITS = 20
RANK = 256
BLOCKS = 4
OVERSAMPLE = 10
#: Words a passage of the fit, what all passages weigh together beside items of 1 each, and passages that are worked on at a time.
FIT_WIDTH = 36
FIT_SHARE = 5.0
FIT_PASSAGES = 64
#: Dimensions of a block of items up to which a task sums pairs of them (8 bytes each, 200 MB at most), and rows multiplied at a time.
PAIRED_DIMS = 5000
PAIRED_ROWS = 512
STEP = 1.5
ANCHOR_WORDS = 8
PROJECTED_WORDS = 100_000
#: Words whose vectors are summed at a time, and bytes of texts the first pass works on: few enough for a processor's cache.
SUMMED_WORDS = 512
PASS_BYTES = 1 << 18
#: Bits of the table of the anchors that may be there.
ANCHOR_BITS = 18
COSINE = 0.65
COPIED = 0.9
PARAPHRASED = 0.6
ANSWER_WORDS = 3

FREQUENCY = pa.schema([("dim", pa.int32()), ("n", pa.int64())])
ROW = pa.schema([("order", pa.int64()), ("dims", pa.list_(pa.int32()))])
VECTOR = pa.schema([("dim", pa.int32()), ("v", pa.list_(pa.float32()))])
GRAM = pa.schema([("g", pa.list_(pa.float64()))])
LEAK = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("cosine", pa.float64()), ("lcs_share", pa.float64()),
                  ("answer_found", pa.bool_())])


def _words(part: Slice) -> np.ndarray:
    part.words(NOT_WORD)
    return part.hashes()


def _dims(words: np.ndarray) -> np.ndarray:
    return (words >> np.uint64(64 - DIM_BITS)).astype(np.int32)


def _frequencies(batches):
    n = np.zeros(1 << DIM_BITS, np.int64)
    texts = 0
    for b in batches:
        for _, part in slices(b.column("text"), lower=True, most=PASS_BYTES):
            dims = _dims(_words(part)).astype(np.int64)
            # sorting is several times as fast here as the hash table of np.unique
            seen = np.sort((part.rows.astype(np.int64) << DIM_BITS) | dims)
            seen = seen[np.append(True, seen[1:] != seen[:-1])[:len(seen)]] & ((1 << DIM_BITS) - 1)
            n += np.bincount(seen, minlength=len(n))
            texts += part.n
    at = np.flatnonzero(n)
    yield batch(FREQUENCY, np.append(at, -1), np.append(n[at], texts))


def inverse_frequencies(docs: DataFrame) -> np.ndarray:
    """Weight of each dimension, from how many of all documents have it."""
    rows = map_arrow(docs.select("text"), _frequencies, FREQUENCY).groupBy("dim").agg(F.sum("n").alias("n")).toArrow()
    dims, n = rows.column(0).to_numpy(), rows.column(1).to_numpy()
    total = int(n[dims < 0].sum())
    found = np.zeros(1 << DIM_BITS)
    found[dims[dims >= 0]] = n[dims >= 0]
    return np.log((total + 1) / (found + 0.5)).clip(0.01).astype(np.float32)


def _signs(dims: np.ndarray) -> np.ndarray:
    """Random signs of each dimension, the same wherever they are drawn."""
    width = RANK + OVERSAMPLE
    blocks = np.arange(-(-width // 64), dtype=np.uint64)
    bits = mix(mix(dims.astype(np.uint64))[:, None] + blocks + np.uint64(1))
    return np.unpackbits(bits.view(np.uint8).reshape(len(dims), -1), axis=1)[:, :width].astype(np.float32) * 2 - 1


def _sparse(b: pa.RecordBatch, idf: np.ndarray):
    """(dims, values) of each row, of unit length times its weight."""
    for dims, weight in zip(b.column("dims"), b.column("weight")):
        own, n = np.unique(dims.values.to_numpy(), return_counts=True)
        values = n * idf[own]
        yield own, (values / np.linalg.norm(values) * weight.as_py()).astype(np.float32)


def _spread(sent, batches):
    """Rows of A' A times random signs, summed by dimension within the task."""
    idf, dims, sums = sent.value, np.zeros(0, np.int64), None
    for b in batches:
        rows = list(_sparse(b, idf))
        if not rows:
            continue
        new = np.union1d(dims, np.concatenate([d for d, _ in rows])).astype(np.int64)
        grown = np.zeros((len(new), RANK + OVERSAMPLE), np.float32)
        if sums is not None:
            grown[np.searchsorted(new, dims)] = sums
        dims, sums = new, grown
        for own, values in rows:
            sums[np.searchsorted(dims, own)] += values[:, None] * (values @ _signs(own))
    if sums is not None:
        yield batch(VECTOR, dims, lists(sums.ravel(), np.arange(len(dims) + 1) * sums.shape[1], pa.float32()))


def _grams(sent, batches):
    idf, index, basis = sent.value
    gram = np.zeros((basis.shape[1],) * 2)
    for b in batches:
        for own, values in _sparse(b, idf):
            w = values @ basis[index[own]]
            gram += np.outer(w, w)
    yield pa.RecordBatch.from_arrays([pa.array([gram.ravel()], pa.list_(pa.float64()))], schema=GRAM)


def _added(pairs):
    """Sum the vectors of each dimension of one group of dimensions."""
    dims = pairs.column("dim").to_numpy()
    vectors = pairs.column("v").combine_chunks().flatten().to_numpy().reshape(len(dims), -1)
    own, at = np.unique(dims, return_inverse=True)
    sums = np.zeros((len(own), vectors.shape[1]), np.float32)
    np.add.at(sums, at, vectors)
    return pa.Table.from_batches([batch(VECTOR, own, lists(sums.ravel(), np.arange(len(own) + 1) * sums.shape[1], pa.float32()))])


def _paired(pairs: np.ndarray, of: np.ndarray, row: np.ndarray, values: np.ndarray) -> None:
    """Add the products of all pairs of words of one passage, each pair once, and half of a word's with itself."""
    low, flat = row * np.int64(len(pairs)), pairs.ravel()
    np.add.at(flat, low + row, values**2 / 2)
    for far in range(1, min(FIT_WIDTH, len(of))):
        at = np.flatnonzero(of[far:] == of[:-far])
        np.add.at(flat, low[at] + row[far:][at], values[at] * values[far:][at])


def _spread_passages(sums: np.ndarray, signs: np.ndarray, of: np.ndarray, row: np.ndarray, values: np.ndarray) -> None:
    """Add the products of passages with the signs and back, some passages at a time; for blocks of many dimensions."""
    bounds = np.searchsorted(of, np.arange(0, of[-1] + 1 + FIT_PASSAGES, FIT_PASSAGES)) if len(of) else []
    for low, high in zip(bounds, bounds[1:]):
        if low == high:
            continue
        own, dims, weights = of[low:high], row[low:high], values[low:high, None].astype(np.float32)
        begins = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
        projected = np.add.reduceat(weights * signs[dims], begins)
        order = np.argsort(dims, kind="stable")
        firsts = np.flatnonzero(np.append(True, np.diff(dims[order]) != 0))
        sums[dims[order][firsts]] += np.add.reduceat(weights[order] * projected[np.searchsorted(own[begins], own)[order]], firsts)


def _corpus(sent, batches):
    """`_spread` for all passages of the documents, on the dimensions of the index alone; their number stands at dimension -1.

    A passage has few words of the index, so pairs of them are summed first and multiplied by the signs once, at the end of the task.
    """
    idf, index, signs = sent.value
    sums, count = np.zeros((len(signs), RANK + OVERSAMPLE), np.float32), 0
    pairs = np.zeros((len(signs),) * 2) if len(signs) <= PAIRED_DIMS else None
    for b in batches:
        for _, part in slices(b.column("text"), lower=True):
            dims = _dims(_words(part))
            # passages of FIT_WIDTH words in a row, the last of a text as long as what is left
            begins = (np.arange(len(dims)) - part.first[part.rows]) % FIT_WIDTH == 0
            start = np.flatnonzero(begins)
            count += len(start)
            if not len(start):
                continue
            weight = idf[dims].astype(np.float64)
            norm = np.sqrt(np.add.reduceat(weight**2, start))
            row = index[dims]
            known = np.flatnonzero(row >= 0)
            of = np.cumsum(begins)[known] - 1
            values = weight[known] / norm[of]
            if pairs is None:
                _spread_passages(sums, signs, of, row[known], values)
            else:
                _paired(pairs, of, row[known], values)
    for at in range(0, len(signs) if pairs is not None and count else 0, PAIRED_ROWS):
        own = slice(at, at + PAIRED_ROWS)
        sums[own] = (pairs[own] + pairs[:, own].T).astype(np.float32) @ signs
    dims = np.flatnonzero(index >= 0)
    yield batch(VECTOR, np.append(dims, -1), lists(np.append(sums[index[dims]].ravel(), np.full(sums.shape[1], count, np.float32)),
                                                   np.arange(len(dims) + 2) * sums.shape[1], pa.float32()))


def _summed(spread: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The dimensions of a table of vectors, in order, and the sum of each one's."""
    ddl = "dim int, v array<float>"
    rows = spread.groupBy(F.shiftright("dim", DIM_BITS - 10).alias("part")).applyInArrow(_added, ddl).toArrow()
    dims = rows.column("dim").to_numpy()
    order = np.argsort(dims)
    return dims[order], rows.column("v").combine_chunks().flatten().to_numpy().reshape(len(dims), RANK + OVERSAMPLE)[order].astype(np.float64)


def fit(items: DataFrame, docs: DataFrame, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index, basis) of a block of items: the row in basis of each dimension, -1 for those outside, and the leading directions."""
    spark = items.sparkSession
    own = map_arrow(items.select("text"), _item_rows, ROW).withColumn("weight", F.lit(1.0))
    rows = keep(own.where(F.size("dims") > 0).repartition(8, F.xxhash64("order")), "fit")
    weights = spark.sparkContext.broadcast(idf)
    dims, sums = _summed(map_arrow(rows, partial(_spread, weights), VECTOR))
    index = np.full(1 << DIM_BITS, -1, np.int32)
    if not len(dims):
        return index, np.zeros((1, 1), np.float32)
    index[dims] = np.arange(len(dims))
    signs = _signs(dims)
    of, corpus = _summed(map_arrow(docs.select("text"), partial(_corpus, spark.sparkContext.broadcast((idf, index, signs))), VECTOR))
    corpus = corpus[1:] * (FIT_SHARE / max(corpus[0, 0], 1)) if len(of) else np.zeros(sums.shape)
    basis = np.linalg.qr(sums + corpus)[0]
    sent = spark.sparkContext.broadcast((idf, index, basis.astype(np.float32)))
    grams = map_arrow(rows, partial(_grams, sent), GRAM).select(F.posexplode("g").alias("i", "x")).groupBy("i").agg(F.sum("x").alias("x")).toArrow()
    gram = np.zeros(basis.shape[1] ** 2)
    gram[grams.column("i").to_numpy()] = grams.column("x").to_numpy()
    # the corpus in the basis, from its product with the signs
    inside = basis.T @ corpus
    gram = gram.reshape(basis.shape[1], -1) + inside @ np.linalg.pinv(signs.T.astype(np.float64) @ corpus, rcond=1e-4, hermitian=True) @ inside.T
    values, vectors = np.linalg.eigh(gram)
    lead = np.argsort(-values)[:RANK]
    return index, (basis @ vectors[:, lead]).astype(np.float32)


def _item_rows(batches):
    for b in batches:
        for _, part in slices(b.column("text"), lower=True):
            words = _words(part)
            yield batch(ROW, (range_hash(words, part.first[:-1], part.first[1:]) >> np.uint64(1)).astype(np.int64),
                        lists(_dims(words), part.first, pa.int32()))


def common_length(places: dict[int, int], width: int, words: list[int]) -> int:
    """Length of the longest common subsequence, with the rows of the table as bits; places: bits of each word of the item."""
    full = (1 << width) - 1
    row = full
    for w in words:
        hit = row & places.get(w, 0)
        row = ((row + hit) | (row - hit)) & full
    return width - row.bit_count()


class _Item:
    def __init__(self, item_id, words: np.ndarray):
        self.id, self.words, self.places = item_id, words.tolist(), {}
        for i, w in enumerate(self.words):
            self.places[w] = self.places.get(w, 0) | 1 << i
        self.answer = self.words[-ANSWER_WORDS:]

    def check(self, words: list[int]) -> tuple[float, bool]:
        """Share of the item that stands in the words, in order, and whether its answer does; (0, False) where too few do to be reported."""
        known = [w for w in words if w in self.places]
        if len(known) < PARAPHRASED * len(self.words):
            return 0.0, False
        share = common_length(self.places, len(self.words), known) / len(self.words)
        if share < PARAPHRASED:
            return share, False
        k = len(self.answer)
        return share, any(words[i: i + k] == self.answer for i in range(len(words) - k + 1))


def _queries(items: pa.Table, idf, index, basis) -> tuple[list[_Item], np.ndarray, float]:
    """The items, their latent vectors divided by the share of their energy in the basis, and the root of the least share."""
    found, latent = [], []
    for b in items.to_batches():
        for at, part in slices(b.column("text"), lower=True):
            words = _words(part)
            for i in range(part.n):
                own = words[part.first[i]: part.first[i + 1]]
                if len(own):
                    dims, n = np.unique(_dims(own), return_counts=True)
                    values = n * idf[dims]
                    known = index[dims] >= 0
                    latent.append((values / np.linalg.norm(values))[known] @ basis[index[dims[known]]])
                    found.append(_Item(b.column("item_id")[at + i].as_py(), own))
    latent = np.array(latent, np.float32).reshape(len(found), basis.shape[1])
    held = np.maximum((latent.astype(np.float64)**2).sum(axis=1), 1e-6)
    return found, (latent / held[:, None]).astype(np.float32), float(np.sqrt(held.min(initial=1)))


def passage_widths(lengths: list[int]) -> list[int]:
    """Widths from the least to the greatest length, neighbours at most STEP apart or one word."""
    low, high = min(lengths), max(lengths)
    n = int(np.ceil(np.log(high / low) / np.log(STEP)))
    return sorted({round(low * (high / low) ** (k / max(n, 1))) for k in range(n + 1)})


class _Anchors:
    """Hashes of the word n-grams of items, with their items and places."""

    def __init__(self, items: list[_Item]):
        self.by_size = {}
        for size in {min(len(i.words), ANCHOR_WORDS) for i in items}:
            keys, item, at = [], [], []
            for k, i in enumerate(items):
                if min(len(i.words), ANCHOR_WORDS) == size:
                    low = np.arange(len(i.words) - size + 1)
                    keys.append(range_hash(np.array(i.words, np.uint64), low, low + size))
                    item.append(np.full(len(low), k))
                    at.append(low)
            keys, item, at = np.concatenate(keys), np.concatenate(item), np.concatenate(at)
            order = np.argsort(keys)
            maybe = np.zeros(1 << ANCHOR_BITS, bool)
            maybe[keys >> np.uint64(64 - ANCHOR_BITS)] = True
            self.by_size[size] = keys[order], item[order], at[order], maybe
        self.lengths = np.array([len(i.words) for i in items])

    def places(self, part: Slice, words: np.ndarray) -> np.ndarray:
        """Distinct rows (text, item, low, high) of the places that items would take, cut to the text."""
        found = [np.zeros((0, 4), np.int64)]
        for size, (keys, item, at, maybe) in self.by_size.items():
            low = np.flatnonzero(part.rows[: len(words) - size + 1] == part.rows[size - 1:]) if len(words) >= size else np.zeros(0, np.int64)
            own = range_hash(words, low, low + size)
            # nearly no place of a text has an anchor
            few = np.flatnonzero(maybe[own >> np.uint64(64 - ANCHOR_BITS)])
            low, own = low[few], own[few]
            begins, n = np.searchsorted(keys, own), np.searchsorted(keys, own, "right")
            n -= begins
            of = np.repeat(np.arange(len(low)), n)
            hit = np.repeat(begins - np.cumsum(n) + n, n) + np.arange(n.sum())
            text, start = part.rows[low[of]], low[of] - at[hit]
            found.append(np.stack([text, item[hit], np.maximum(start, part.first[text]),
                                   np.minimum(start + self.lengths[item[hit]], part.first[text + 1])], axis=1))
        return np.unique(np.concatenate(found), axis=0)


def _cosine(one: np.ndarray, two: np.ndarray, idf: np.ndarray) -> float:
    """Cosine of two runs of words, without a basis."""
    dims, at = np.unique(_dims(np.concatenate([one, two])), return_inverse=True)
    a, b = (np.bincount(x, minlength=len(dims)) * idf[dims].astype(np.float64) for x in (at[: len(one)], at[len(one):]))
    return float(a @ b / (np.linalg.norm(a) * np.linalg.norm(b)))


def _passages(part: Slice, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the passages of a width of all texts of a slice, the last one ending with its text."""
    n = np.diff(part.first)
    step = max(1, width // 6)
    count = np.where(n > 0, -(-np.maximum(n - width, 0) // step) + 1, 0)
    text = np.repeat(np.arange(part.n), count)
    k = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    low = part.first[text] + np.minimum(k * step, np.maximum(n[text] - width, 0))
    return low, np.minimum(low + width, part.first[text + 1])


def _reach(basis: np.ndarray, latent: np.ndarray) -> np.ndarray:
    """What a word of each dimension of the basis adds to its best item at most, per weight; 0 at the end for all others."""
    best = np.zeros(len(basis) + 1)
    for at in range(0, len(latent), 256):
        np.maximum(best[:-1], (basis @ latent[at: at + 256].T).max(axis=1), out=best[:-1])
    return best


def _candidates(part: Slice, words, idf, widths, index, basis, latent, least, reach):
    """Yield arrays (text, low, high, item, cosine) of passages near an item."""
    dims = _dims(words)
    weight = idf[dims].astype(np.float64)
    row = index[dims]
    total = np.concatenate([[0], np.cumsum(weight**2)])
    known = np.concatenate([[0], np.cumsum(np.where(row >= 0, weight**2, 0))])
    most = np.concatenate([[0], np.cumsum(weight * reach[row])])
    scaled = np.where(row >= 0, weight, 0).astype(np.float32)
    for width in widths:
        low, high = _passages(part, width)
        norm = total[high] - total[low]
        near = np.flatnonzero((most[high] - most[low] >= COSINE * np.sqrt(norm)) & (known[high] - known[low] >= (COSINE * least)**2 * norm * (1 - 1e-6)))
        for few in np.array_split(near, max(1, len(near) * width // PROJECTED_WORDS)):
            if not len(few):
                continue
            size = high[few] - low[few]
            first = np.cumsum(size) - size
            latents = np.empty((len(few), basis.shape[1]), np.float32)
            cuts = np.searchsorted(first, np.arange(0, size.sum() + SUMMED_WORDS, SUMMED_WORDS))
            for a, z in zip(cuts, cuts[1:]):
                if a < z:
                    begins = first[a:z] - first[a]
                    at = np.repeat(low[few[a:z]] - begins, size[a:z]) + np.arange(size[a:z].sum())
                    np.add.reduceat(scaled[at][:, None] * basis[np.maximum(row[at], 0)], begins, axis=0, out=latents[a:z])
            cosines = latents @ latent.T / np.sqrt(np.maximum(norm[few], 1e-9))[:, None]
            passage, item = np.nonzero(cosines >= COSINE)
            k = few[passage]
            yield part.rows[low[k]], low[k], high[k], item, cosines[passage, item].astype(np.float64)


def find_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id, cosine, lcs_share, answer_found) of every document and benchmark item in it."""
    docs = docs.select(F.col("doc_id").cast("bigint"), "text")
    asked = items.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text")).toArrow()
    blocks = [asked.slice(at, RANK) for at in range(0, asked.num_rows, RANK)]
    if not blocks:
        return docs.sparkSession.createDataFrame([], from_arrow_schema(LEAK))
    idf = inverse_frequencies(docs)
    passes = [_searched(docs, blocks[at: at + BLOCKS], idf) for at in range(0, len(blocks), BLOCKS)]
    return reduce(DataFrame.unionByName, passes)


def _searched(docs: DataFrame, blocks: list[pa.Table], idf: np.ndarray) -> DataFrame:
    """The leaks of some blocks of items, by one pass over the documents."""
    spark, queries, fitted = docs.sparkSession, [], []
    for block in blocks:
        index, basis = fit(spark.createDataFrame(block), docs, idf)
        own, latent, least = _queries(block, idf, index, basis)
        if own:
            fitted.append((len(queries), passage_widths([len(i.words) for i in own]), index, basis, latent, least, _reach(basis, latent)))
        queries += own
    sent = spark.sparkContext.broadcast((idf, queries, _Anchors(queries), fitted))

    def work(batches):
        idf, queries, anchors, fitted = sent.value
        for b in batches:
            out = []
            for at, part in slices(b.column("text"), lower=True) if len(queries) else ():
                words = _words(part)
                if not len(words):
                    continue
                found: dict[tuple[int, int], list] = {}
                for start, *space in fitted:
                    for text, low, high, item, cosine in _candidates(part, words, idf, *space):
                        rows = zip(text.tolist(), (start + item).tolist(), np.minimum(cosine, 1.0).tolist(), low.tolist(), high.tolist())
                        for text, item, *place in rows:
                            found.setdefault((text, item), []).append(tuple(place))
                # after the others, and measured only if they are to be checked
                for text, item, low, high in anchors.places(part, words).tolist():
                    found.setdefault((text, item), []).append((-1.0, low, high))
                for (text, item), places in found.items():
                    asked, seen, best = queries[item], [], None
                    for cosine, low, high in sorted(places, reverse=True):
                        if any(a <= low and high <= z for a, z in seen):
                            continue
                        if cosine < 0:
                            cosine = _cosine(words[low:high], np.array(asked.words, np.uint64), idf)
                        a = max(part.first[text], low - len(asked.words))
                        z = min(part.first[text + 1], high + len(asked.words))
                        seen.append((a, z))
                        share, answered = asked.check(words[a:z].tolist())
                        if (share >= COPIED or share >= PARAPHRASED and answered) and (best is None or share > best[1]):
                            best = (cosine, share, answered)
                    if best:
                        out.append((b.column("doc_id")[at + text].as_py(), asked.id, *best))
            yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*out) if out else [[]] * 5, LEAK)], schema=LEAK)

    return map_arrow(docs, work, LEAK)


def decontaminate(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents in which no benchmark item was found. A null id can't be told from another and stays only if none is reported."""
    leaks = keep(find_leaks(docs, items).select(F.col("doc_id").alias("_leaked")).distinct(), "leaks")
    return docs.join(leaks, F.col("doc_id").eqNullSafe(F.col("_leaked")), "left_anti")


@query("op1_latent_leaks")
def op1_latent_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
