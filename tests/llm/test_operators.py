"""Each operator against a plain version, and on odd and empty tables."""

import hashlib
import random
from collections import Counter
from functools import partial

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from streetflow.llm import (archives, chat, components, jaccard_join, latent_leaks, line_dedup, mixing, ngram_quality,
                            piece_counts, span_dedup, url_rules)

SF_DIR = "/root/testdata/sf0.001"
WORDS = [f"w{i}" for i in range(200)]


def test_odd_documents(odd):
    n = odd.count()
    assert mixing.mix(odd).count() == n and ngram_quality.judge(odd).where("kept").count() == 0
    assert {r.n_words for r in piece_counts.count_tokens(odd, piece_counts.read_pieces()).collect()} == {0, 3, 5, 20_001}
    lines = line_dedup.dedup_lines(odd)
    assert lines.count() == n and lines.agg(F.sum("n_removed")).first()[0] == 0
    assert span_dedup.cut_spans(odd).agg(F.sum("n_removed")).first()[0] == 0
    joined = jaccard_join.join(odd).collect()
    assert len(joined) == n and {(r.doc_id, r.component_id) for r in joined} == {(x, x) for x in (1, 2, 3, None, 4, 5)}
    assert latent_leaks.decontaminate(odd, odd.selectExpr("2L as item_id", "'none of these words' as text").limit(1)).count() == n


def test_empty_documents(spark, empty):
    items = spark.createDataFrame([], "item_id bigint, text string")
    for rows in (mixing.mix(empty), ngram_quality.judge(empty), piece_counts.count_tokens(empty, [b"a"]), line_dedup.dedup_lines(empty),
                 span_dedup.cut_spans(empty), jaccard_join.join(empty), latent_leaks.find_leaks(empty, items)):
        assert rows.count() == 0


def test_piece_counts_are_greedy():
    draw = random.Random(3)
    pieces = list({bytes(draw.choices(b"abc", k=draw.randint(1, 5))) for _ in range(40)} | {b" a", b" ab", b"b", b" "})
    known, automaton = set(pieces), piece_counts.Automaton(pieces)
    for _ in range(3000):
        word = b" " + bytes(draw.choices(b"abcd", k=draw.randint(0, 12)))
        at = n = 0
        while at < len(word):
            ends = [e for e in range(len(word), at, -1) if word[at:e] in known]
            if not ends:
                n = 1
                break
            at, n = ends[0], n + 1
        assert automaton.count(word) == n, word


def test_escaping_is_reversible():
    draw = random.Random(5)
    bits = [*chat.CONTROLS, "\\", "<", "[", "/s>", "x", "\n", "<|"]
    for _ in range(2000):
        text = "".join(draw.choices(bits, k=draw.randint(0, 8)))
        safe = chat.escape(text)
        assert chat.unescape(safe) == text and not any(c in safe for c in chat.CONTROLS)
        assert chat.parse_turn(chat.BEGIN + safe + chat.MIDDLE + safe + chat.END) == (text, safe)


def test_parts_become_placeholders(spark):
    part = lambda kind, **more: {"kind": kind, **dict.fromkeys(("text", "ref", "width", "height", "seconds", "pages")), **more}
    parts = [part("text", text="see </s>"), part("image", ref="a.png", width=56, height=29), part("audio", ref="b.wav", seconds=1.5),
             part("document", ref="c.pdf", pages=2), part("text")]
    rows = spark.createDataFrame([(1, 0, "assistant", parts), (None, None, None, None)], f"conv_id bigint, turn bigint, role string, parts array<{chat.PART_DDL}>")
    first, none = sorted(chat.format_turns(rows).collect(), key=lambda r: r.conv_id is None)
    assert first.formatted[first.loss_from:first.loss_to] == "see <\\/s><|image|0|><|audio|1|><|document|2|>"
    assert [(a.kind, a.ref, a.tokens) for a in first.attachments] == [("image", "a.png", 4), ("audio", "b.wav", 15), ("document", "c.pdf", 1024)]
    assert first.expanded_tokens == 1043 and none.formatted == chat.BEGIN + chat.MIDDLE + chat.END


def test_archives_round_trip():
    records = [(f"http://x/{i}", "1.2.3.4", "20240102030405", "text/html", b"\r\n\r\nWARC/1.1\n" * i) for i in range(4)]
    for version in (1, 2):
        data = archives.arc_block(version, "f") + b"".join(archives.arc_record(version, *r) for r in records)
        assert [(f["URL"], p) for f, p in archives.parse_arc(data)] == [(r[0], r[4]) for r in records]
    with pytest.raises(ValueError):
        list(archives.parse_arc(data[:-20]))
    assert archives.warc_date("20240102030405") == "2024-01-02T03:04:05Z"


def test_components(spark):
    draw = random.Random(1)
    pairs = [(draw.randrange(300), draw.randrange(300)) for _ in range(140)] + [(i, i + 1) for i in range(400, 460)]
    label = {v: v for p in pairs for v in p}
    for _ in range(100):
        for a, b in pairs:
            label[a] = label[b] = min(label[a], label[b])
    got = {r.v: r.root for r in components.components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()}
    named = {}
    assert all(named.setdefault(label[v], root) == root for v, root in got.items()) and len(set(named.values())) == len(named)


def test_near_copies_in_cells(spark, monkeypatch):
    """Many copies at all distances around the bound, with and without the recursion into cells."""
    draw = random.Random(9)
    base = draw.choices(WORDS, k=120)
    texts = []
    for _ in range(60):
        words = list(base)
        for _ in range(draw.randint(0, 6)):
            words[draw.randrange(120)] = draw.choice(WORDS)
        texts.append(" ".join(words))
    sets = [{tuple(t.split()[i:i + 3]) for i in range(118)} for t in texts]
    label = list(range(60))
    for _ in range(60):
        for i in range(60):
            for j in range(i):
                if 100 * len(sets[i] & sets[j]) >= 90 * len(sets[i] | sets[j]):
                    label[i] = label[j] = min(label[i], label[j])
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for few in (256, 4):
        monkeypatch.setattr(jaccard_join, "FEW", few)
        assert {r.doc_id: r.component_id for r in jaccard_join.join(docs).collect()} == dict(enumerate(label))


def test_leak_basis_is_fitted_to_all_passages(spark):
    """What the fit takes from the documents is the product of all their passages, as in plain numpy."""
    draw = random.Random(3)
    texts = [" ".join(draw.choices(WORDS, k=draw.randint(0, 90))) for _ in range(700)] + [None]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    part = next(latent_leaks.slices(pa.array(texts[:700]), lower=True))[1]
    words = latent_leaks._dims(latent_leaks._words(part))
    idf = latent_leaks.inverse_frequencies(docs)
    dims = np.unique(words[:40])
    index = np.full(1 << latent_leaks.DIM_BITS, -1, np.int32)
    index[dims] = np.arange(len(dims))
    signs = latent_leaks._signs(dims)
    passages = [words[i: min(i + latent_leaks.FIT_WIDTH, high)] for low, high in zip(part.first, part.first[1:])
                for i in range(low, high, latent_leaks.FIT_WIDTH)]
    rows = np.zeros((len(passages), len(dims)))
    for row, own in zip(rows, passages):
        known = own[index[own] >= 0]
        np.add.at(row, index[known], idf[known] / np.sqrt((idf[own]**2).sum()))
    sent = spark.sparkContext.broadcast((idf, index, signs))
    of, got = latent_leaks._summed(latent_leaks.map_arrow(docs, partial(latent_leaks._corpus, sent), latent_leaks.VECTOR))
    assert of.tolist() == [-1, *dims] and len(passages) > 500 and (got[0] == len(passages)).all()
    np.testing.assert_allclose(got[1:], rows.T @ (rows @ signs), rtol=1e-3, atol=1e-3)


@pytest.mark.parametrize("limit", [0, 5000])
def test_leak_basis_sums_pairs_or_passages(monkeypatch, limit):
    """Sums over pairs of words and sums by passage are the same product; pairs do without a gather of signs for every word."""
    draw = random.Random(5)
    texts = pa.array([" ".join(draw.choices(WORDS, k=draw.randint(0, 150))) for _ in range(300)] + [None, "", "alpha"])
    part = next(latent_leaks.slices(texts, lower=True))[1]
    words = latent_leaks._dims(latent_leaks._words(part))
    idf = np.random.default_rng(5).uniform(0.1, 5, 1 << latent_leaks.DIM_BITS).astype(np.float32)
    dims = np.unique(words)[::2]
    index = np.full(1 << latent_leaks.DIM_BITS, -1, np.int32)
    index[dims] = np.arange(len(dims))
    signs, used = latent_leaks._signs(dims), []
    monkeypatch.setattr(latent_leaks, "PAIRED_DIMS", limit)
    paired = latent_leaks._paired
    monkeypatch.setattr(latent_leaks, "_paired", lambda *a: (used.append(1), paired(*a)))
    sent = type("Sent", (), {"value": (idf, index, signs)})
    (got,) = latent_leaks._corpus(sent, [pa.RecordBatch.from_arrays([texts], ["text"])])
    passages = [words[i: min(i + latent_leaks.FIT_WIDTH, high)] for low, high in zip(part.first, part.first[1:])
                for i in range(low, high, latent_leaks.FIT_WIDTH)]
    rows = np.zeros((len(passages), len(dims)))
    for row, own in zip(rows, passages):
        known = own[index[own] >= 0]
        np.add.at(row, index[known], idf[known] / np.sqrt((idf[own].astype(float)**2).sum()))
    sums = got.column(1).flatten().to_numpy().reshape(len(dims) + 1, -1)
    assert bool(used) == (limit > 0) and (sums[-1] == len(passages)).all()
    np.testing.assert_allclose(sums[:-1], rows.T @ (rows @ signs), rtol=1e-4, atol=1e-4)


def test_few_pairs_need_no_further_rounds(spark, monkeypatch):
    """Cells over the limits are compared at once while their pairs are few beside the table, else divided, with the same result."""
    draw, shingle, percent = random.Random(81), 5, 80
    texts = []
    for size in (40, 90):
        base = draw.choices(WORDS, k=size)
        for _ in range(16):
            words = list(base)
            for _ in range(draw.randint(0, 1 + size // 20)):
                words[draw.randrange(size)] = draw.choice(WORDS)
            texts.append(" ".join(words))
    sets = [{tuple(w[i:i + shingle]) for i in range(len(w) - shingle + 1)} for w in map(str.split, texts)]
    label = list(range(len(texts)))
    for _ in texts:
        for i in range(len(texts)):
            for j in range(i):
                if 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                    label[i] = label[j] = min(label[i], label[j])
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")

    def found():
        return {r.doc_id: r.component_id for r in jaccard_join.join(docs, shingle, percent).collect()}

    monkeypatch.setattr(jaccard_join, "FEW", 4)
    monkeypatch.setattr(jaccard_join, "MANY", 4)
    divided, rounds = jaccard_join._divided, []
    monkeypatch.setattr(jaccard_join, "_divided", lambda *of: rounds.append(1) or divided(*of))
    monkeypatch.setattr(jaccard_join, "SHARE", 8)
    assert found() == dict(enumerate(label)) and not rounds
    monkeypatch.setattr(jaccard_join, "PAIRS", 0)
    assert found() == dict(enumerate(label)) and rounds


@pytest.mark.parametrize("shingle, percent", [(3, 90), (5, 80)])
def test_near_copies_by_rule(spark, monkeypatch, shingle, percent):
    draw = random.Random(percent)
    texts = []
    for size in (4, 7, 12, 25, 60, 130):
        base = draw.choices(WORDS, k=size)
        for _ in range(12):
            words = list(base)
            for _ in range(draw.randint(0, 1 + size // 25)):
                words[draw.randrange(size)] = draw.choice(WORDS)
            cut = draw.randint(0, size // 6)
            texts.append(" ".join(words[: size - cut] if draw.random() < 0.5 else words + draw.choices(WORDS, k=cut)))
    sets = [{tuple(w[i:i + shingle]) for i in range(max(1, len(w) - shingle + 1))} for w in map(str.split, texts)]
    near = [(i, j) for i in range(len(texts)) for j in range(i) if 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])]
    label = list(range(len(texts)))
    for _ in texts:
        for i, j in near:
            label[i] = label[j] = min(label[i], label[j])
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for few, many in ((128, 256), (4, 4)):
        monkeypatch.setattr(jaccard_join, "FEW", few)
        monkeypatch.setattr(jaccard_join, "MANY", many)
        assert {r.doc_id: r.component_id for r in jaccard_join.join(docs, shingle, percent).collect()} == dict(enumerate(label))


def test_lines_one_word_apart(spark):
    line = WORDS[:12]
    other = [line[:5] + ["new"] + line[6:], line[:5] + line[6:], line[:3] + ["new"] + line[3:], line[:2] + ["a", "b"] + line[4:], line]
    text = "\n".join(" ".join(x) for x in [line, *other, ["short", "line"], ["short", "line"]])
    rows = line_dedup.dedup_lines(spark.createDataFrame([(7, text)], "doc_id bigint, text string")).first()
    assert rows.n_lines == 8 and rows.n_removed == 5 and rows.text.split("\n")[1:] == [" ".join(other[3]), "short line"]


def test_repeats_of_short_lines_go(spark):
    texts = ["one\nfar line\n\nnext\nhttps://x.org/a", "far line\n\nnew", "one\nhttps://x.org/a\n \n漢字漢字"]
    rows = line_dedup.dedup_lines(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()
    assert {r.doc_id: r.text for r in rows} == {0: texts[0], 1: "\nnew", 2: " \n漢字漢字"}


def test_rows_of_one_id_keep_their_own_lines(spark):
    docs = spark.createDataFrame([(1, "a b\nonly here"), (1, "a b\nonly there"), (1, "a b\nonly there"), (2, "a b\nlast")],
                                 "doc_id bigint, text string").selectExpr("*", "'mine' as n_lines", "'too' as n_removed")
    rows = line_dedup.without_repeats(docs).collect()
    assert {(r.n_lines, r.n_removed) for r in rows} == {("mine", "too")} and len(rows) == 4
    texts = [x for r in rows for x in r.text.split("\n")]
    assert texts.count("only here") == 1 and texts.count("only there") == 2 and texts.count("last") == 1
    assert texts.count("a b") in (1, 2)  # equal rows count as one document, which may be the first


def test_lines_against_brute_force(spark):
    """Exact repeats of any length, and lines of ten words or more that are one word apart from an earlier line."""
    draw = random.Random(5)
    base = [[draw.choice(WORDS) for _ in range(draw.choice([1, 3, 9, 10, 11, 14]))] for _ in range(14)]

    def spoiled(line):
        line, at = list(line), draw.randrange(len(line))
        how = draw.randrange(6)
        if how == 0:
            line[at] = draw.choice(WORDS)
        elif how == 1 and len(line) > 1:
            del line[at]
        elif how == 2:
            line.insert(at, draw.choice(WORDS))
        return line

    texts = {i: [spoiled(draw.choice(base)) if draw.random() < 0.9 else [] for _ in range(draw.randrange(6))] for i in range(60)}

    def near(a, b):
        short, long = sorted((a, b), key=len)
        if len(long) - len(short) > 1 or len(short) < line_dedup.NEAR_WORDS:
            return False
        if len(long) == len(short):
            return sum(x != y for x, y in zip(a, b)) == 1
        return any(long[:k] + long[k + 1:] == short for k in range(len(long)))

    seen, want = [], {}
    for i, lines in texts.items():
        stay = []
        for line in lines:
            if not line or not any(line == x or near(line, x) for x in seen):
                stay.append(" ".join(line))
            seen.append(line)
        want[i] = "\n".join(stay)
    docs = spark.createDataFrame([(i, "\n".join(map(" ".join, x))) for i, x in texts.items()], "doc_id bigint, text string")
    assert {r.doc_id: r.text for r in line_dedup.dedup_lines(docs).collect()} == want


def test_many_lines_in_one_document(spark):
    text = "\n".join(["same line"] * 200_000 + ["other"])
    row = line_dedup.dedup_lines(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).first()
    assert (row.n_lines, row.n_removed, row.text) == (200_001, 199_999, "same line\nother")


def test_quotas_add_up():
    counts = np.array([1000, 3, 0, 77])
    quotas = mixing.split_quotas(counts, 7, 1)
    assert (quotas.sum(axis=1) == counts).all() and np.ptp(quotas.sum(axis=0)) <= 1 and (quotas >= 0).all()


def test_mined_url_rules(spark):
    pages = [(i, f"http://{'spam-win' if i % 3 == 0 else 'good'}.example.org/en/{i}") for i in range(300)] + [(900, None), (901, "no scheme")]
    labels = [(i, 0 if i % 3 == 0 else 1, 0) for i in range(300)]
    rows = url_rules.judge(spark.createDataFrame(pages, "page_id bigint, url string"), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")).collect()
    assert {r.page_id for r in rows if r.verdict == "block"} == set(range(0, 300, 3)) and len(rows) == 302


def test_paraphrases_are_found(spark):
    draw = random.Random(2)
    item = [f"q{i}" for i in range(30)]
    changed = [w if i % 7 else "other" for i, w in enumerate(item)][:-3] + item[-3:]
    filler = lambda n: [draw.choice(WORDS) for _ in range(n)]
    docs = [(i, " ".join(filler(150))) for i in range(40)] + [(50, " ".join(filler(90) + item + filler(80))), (51, " ".join(filler(60) + changed + filler(30)))]
    found = latent_leaks.find_leaks(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame([(1, " ".join(item)), (2, None)], "item_id bigint, text string"))
    assert {(r.doc_id, r.item_id) for r in found.collect()} == {(50, 1), (51, 1)}


@pytest.mark.parametrize("most", [50, 512])
def test_vectors_are_summed_in_parts(monkeypatch, most):
    """Passages near an item are those of plain cosines; a part has the vectors of so many words, and of one passage, at most."""
    class Counted(np.ndarray):
        def __getitem__(self, k):
            read.append(np.size(k))
            return np.asarray(self)[k]

    draw, read = random.Random(7), []
    item = [f"q{i}" for i in range(24)]
    texts = [" ".join(draw.choices(WORDS, k=draw.randint(0, 60)) + draw.sample(item, draw.choice([0, 22, 24])) + draw.choices(WORDS, k=30)) for _ in range(20)]
    part = next(latent_leaks.slices(pa.array([*texts, "", None, " ".join(item)]), lower=True))[1]
    words = latent_leaks._words(part)
    idf = np.random.default_rng(7).uniform(1, 3, 1 << latent_leaks.DIM_BITS).astype(np.float32)
    own = np.unique(latent_leaks._dims(latent_leaks._words(next(latent_leaks.slices(pa.array([" ".join(item)]), lower=True))[1])))
    index = np.full(1 << latent_leaks.DIM_BITS, -1, np.int32)
    index[own] = np.arange(len(own))
    basis = np.eye(len(own), dtype=np.float32)
    latent = (idf[own] / np.linalg.norm(idf[own]))[None]
    monkeypatch.setattr(latent_leaks, "SUMMED_WORDS", most)
    found = latent_leaks._candidates(part, words, idf, [12, 16, 24], index, basis.view(Counted), latent, 1.0, latent_leaks._reach(basis, latent))
    got = {(t, a, z): c for rows in found for t, a, z, _, c in zip(*(x.tolist() for x in rows))}
    dims, want = latent_leaks._dims(words), {}
    for width in (12, 16, 24):
        for a, z in zip(*(x.tolist() for x in latent_leaks._passages(part, width))):
            vector = np.zeros(len(own))
            np.add.at(vector, index[dims[a:z]][index[dims[a:z]] >= 0], idf[dims[a:z]][index[dims[a:z]] >= 0])
            cosine = float(vector @ latent[0]) / np.sqrt((idf[dims[a:z]].astype(float)**2).sum())
            if cosine >= latent_leaks.COSINE:
                want[part.rows[a], a, z] = cosine
    assert len(want) > 30 and got == pytest.approx(want, abs=1e-5)
    assert max(read) <= most + 24


def test_places_with_too_few_words_are_not_aligned(monkeypatch):
    """The common subsequence is measured only where enough of the item's words stand."""
    item = latent_leaks._Item(1, np.arange(20, dtype=np.uint64))
    measured = []
    monkeypatch.setattr(latent_leaks, "common_length", lambda *a, plain=latent_leaks.common_length: (measured.append(1), plain(*a))[1])
    assert item.check([*range(11), *range(50, 90)])[0] < latent_leaks.PARAPHRASED and not measured
    assert item.check([*range(12), 99]) == (0.6, False) and item.check([5, *range(3, 20)]) == (0.85, True)
    assert item.check(list(range(19, -1, -1))) == (0.05, False) and len(measured) == 3


def test_copies_of_many_items_are_found(spark):
    draw = random.Random(13)
    words = [f"v{i}" for i in range(3000)]
    items = [" ".join(draw.choices(words, k=draw.randint(15, 59))) for _ in range(1100)]
    docs = [(i, " ".join([*draw.choices(words, k=80), text, *draw.choices(words, k=80)])) for i, text in enumerate(items)]
    found = latent_leaks.find_leaks(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string"))
    assert {(r.doc_id, r.item_id) for r in found.collect()} == {(i, i) for i in range(1100)}


@pytest.mark.parametrize("size", [5, 8, 160, 300])
def test_copies_of_short_and_long_items_are_found(spark, size):
    draw = random.Random(size)
    items = [" ".join(draw.choices(WORDS[:40] + [f"{size}x{i}" for i in range(400)], k=size)) for i in range(30)]
    filler = lambda n: draw.choices(WORDS + [f"r{draw.randint(0, 9999)}" for _ in range(50)], k=n)
    docs = [(i, " ".join([*filler(300), text, *filler(200)])) for i, text in enumerate(items)]
    found = latent_leaks.find_leaks(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string"))
    assert {(i, i) for i in range(30)} <= {(r.doc_id, r.item_id) for r in found.where("lcs_share = 1").collect()}


def test_passage_widths_follow_the_items():
    for low, high in ((1, 1), (5, 300), (15, 59), (7, 8)):
        widths = latent_leaks.passage_widths([low, high])
        assert widths[0] == low and widths[-1] == high and all(b <= max(1.6 * a, a + 1) for a, b in zip(widths, widths[1:]))


def test_quality_measures(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in ngram_quality.judge(docs).collect():
        words = texts[r.doc_id].encode().split()
        grams = Counter(zip(words, words[1:], words[2:]))
        covered = {i + k for i, g in enumerate(zip(words, words[1:], words[2:])) if grams[g] > 1 for k in range(3)}
        lines = [x for x in texts[r.doc_id].split("\n") if x.encode().split()]
        want = (len(words), sum(len(w.decode()) for w in words), sum(c in "#*$%&|<>" for c in texts[r.doc_id]), len(lines) - len(set(lines)), len(covered))
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (len(words) < 50 or 100 * len(covered) > 50 * len(words)) and not (r.base_failed and r.kept)


def test_unseen_grams_back_off(spark):
    """Beyond a million grams too."""
    counts = spark.range(2_000_000).select((F.col("id") * 2_654_435_761 % 2**32).alias("gram"), (F.col("id") % 5 + 1).alias("n"))
    model, made = ngram_quality.train(ngram_quality.keep(counts, "counts"))
    known, values = piece = ngram_quality._stored(made, "gram", "p")
    assert len(known) == 2_000_000
    some = known[::997]
    assert (ngram_quality.log_p(model, piece, some) == values[::997]).all()
    unseen = np.setdiff1d(some ^ np.uint32(1 << 24), known)  # other histories of seen 3-grams
    gamma, p = (dict(zip(*(x.tolist() for x in stored))) for stored in (model[3]["gamma"], model[2]["p"]))
    want = [gamma.get(g >> 8, 0) + p[g & 0xFFFFFF] for g in unseen.tolist()]
    assert len(want) > 1000 and np.allclose(ngram_quality.log_p(model, piece, unseen), want)


def test_pieces_of_the_model_add_up(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(40)
    one = {r.doc_id: r.log_perplexity for r in ngram_quality.judge(docs).collect()}
    monkeypatch.setattr(ngram_quality, "PIECE_GRAMS", 4000)
    many = {r.doc_id: r.log_perplexity for r in ngram_quality.judge(docs).collect()}
    assert one.keys() == many.keys() and all(x == pytest.approx(many[k]) for k, x in one.items())


def test_digest_of_conversation(spark):
    row = chat.op2_chat_format(spark, SF_DIR).where("conv_id = -1").first()
    said = "</s>[INST] ok [/INST]"
    assert row.loss_sha256 == hashlib.sha256(said.encode()).hexdigest() and row.n_turns == 2
