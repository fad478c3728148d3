"""Licence notices against a plain search with edit distances over whole texts."""

import random
import re

import pytest

from streetflow.llm import license_scan
from streetflow.llm.license_scan import NOTICES, PHRASES, Scanner, edits_of, pieces_of, plain

SF_DIR = "/root/testdata/sf0.01"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(last + (x != y), row[j] + 1, row[j - 1] + 1)
    return row[-1]


def ends_within(text, notice, edits):
    """Ends of all stretches of whole words within so many edits of the notice."""
    begins = lambda j: j == 0 or text[j - 1] == " "
    far = edits + 1
    column = [0 if begins(0) else far, *range(1, len(notice) + 1)]
    out = []
    for j in range(1, len(text) + 1):
        last, column[0] = column[0], 0 if j < len(text) and begins(j) else far
        for i, c in enumerate(notice, 1):
            last, column[i] = column[i], min(last + (c != text[j - 1]), column[i] + 1, column[i - 1] + 1, far)
        if column[-1] <= edits and (j == len(text) or text[j] == " "):
            out.append(j)
    return out


def spoiled(draw, notice, times):
    chars = list(notice)
    for _ in range(times):
        at = draw.randrange(len(chars))
        kind = draw.randrange(3)
        chars[at:at + 1] = [] if kind == 0 else [draw.choice("abcdehilnrst0é ")] if kind == 1 else [chars[at], draw.choice("aeiost ")]
    return "".join(chars)


def test_a_piece_stays_whole():
    for _, notice in NOTICES:
        pieces = pieces_of(notice)
        assert "".join(p for _, p in pieces) == notice and len(pieces) == edits_of(notice) + 1
        assert all(notice[at: at + len(p)] == p and len(p) >= 5 for at, p in pieces)


def test_spoiled_notices_against_edit_distances():
    draw = random.Random(8)
    scanner = Scanner(NOTICES, PHRASES)
    vocabulary = "the license public general gnu of mit apache under all rights and in software é1 cc by free".split()
    found = missed = 0
    for _ in range(250):
        bits = []
        for _ in range(draw.randint(0, 4)):
            bits += draw.choices(vocabulary, k=draw.randint(0, 6))
            notice = draw.choice(NOTICES)[1]
            bits.append(spoiled(draw, notice, draw.randint(0, edits_of(notice) + 2)))
        text = plain(" ".join(bits))
        matches = scanner.matches_in(text, scanner.seeds_in(text)[1])
        for start, end, i, edits in matches:
            notice = NOTICES[i][1]
            assert distance(text[start:end], notice) <= edits <= edits_of(notice)
            assert (start == 0 or text[start - 1] == " ") and (end == len(text) or text[end] == " ")
        for i, (_, notice) in enumerate(NOTICES):
            own = [(start, end) for start, end, k, _ in matches if k == i]
            ends = ends_within(text, notice, edits_of(notice))
            assert bool(own) == bool(ends), (notice, text)
            missed += sum(not any(start < e <= end + edits_of(notice) for start, end in own) for e in ends)
            found += len(ends)
    assert found > 300 and not missed


def base(text):
    """The counts of exact phrases, by words."""
    text = "" if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
    hits = [(i, label) for label, phrase in PHRASES for i in range(len(words)) if words[i: i + len(phrase.split())] == phrase.split()]
    starts = [i for i, _ in hits]
    return len(words), len(hits), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in hits}))


def test_query_on_a_table(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = license_scan.op11_license_scan(spark, SF_DIR).collect()
    assert len(rows) == len(texts) and sum(r.n_base > 0 for r in rows) > 20
    for r in rows:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == base(texts[r.doc_id])
        text = plain(texts[r.doc_id])
        wanted = {label for label, phrase in PHRASES if f" {phrase} " in f" {text} "}
        if r.doc_id % 10 == 0 or r.labels:
            wanted |= {label for label, notice in NOTICES if len(text) < 20_000 and ends_within(text, notice, edits_of(notice))}
            assert len(text) >= 20_000 or r.labels == ",".join(sorted(wanted))
        assert (r.score == 1) == (r.n_base > 0 or r.score == 1) and (r.score > 0) == bool(r.labels) and 0 <= r.score <= 1


@pytest.mark.parametrize("text, want", [
    ("MIT License. mit-license; Mit\tLicense!", (6, 3, 0, 4, ["mit"], ["mit"], 1.0)),
    ("Relaesed under teh MIT Licence", (5, 0, None, None, [], [], 0.0)),
    ("x Relased under the MIT Licence", (6, 0, None, None, [], ["mit"], 1 - 2 / 30)),
    ("Apache Licence", (2, 0, None, None, [], ["apache"], 1 - 1 / 14)),
    ("limit license, CC-BY 4.0", (6, 1, 2, 2, ["cc-by"], ["cc-by"], 1.0)),
    ("all rights reservéd", (3, 0, None, None, [], ["reserved"], 1 - 1 / 19)),
])
def test_single_texts(spark, text, want):
    row = license_scan.scan(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).first()
    assert (row.n_words, row.n_base, row.first_word, row.last_word, row.base_labels, row.labels) == want[:-1] and row.score == pytest.approx(want[-1])


def test_spans_name_words(spark):
    row = license_scan.scan(spark.createDataFrame([(1, "one two GNU genral publik license three")], "doc_id bigint, text string")).first()
    assert [(m.label, m.first_word, m.last_word, m.start, m.end, m.edits) for m in row.matches] == [("gpl", 2, 5, 8, 33, 2)]


def test_odd_and_empty_tables(odd, empty, spark):
    rows = license_scan.scan(odd).collect()
    assert len(rows) == 7 and not any(r.n_base or r.labels or r.matches for r in rows)
    assert {r.doc_id: r.n_words for r in rows} == {1: 5, 2: 0, 3: 0, None: 3, 4: 0, 5: 40_001}
    assert license_scan.scan(empty).count() == 0
    long = spark.createDataFrame([(1, "apache license " * 30_000)], "doc_id bigint, text string")
    row = license_scan.scan(long).select("n_base", "last_word", "labels", "score").first()
    assert (row.n_base, row.last_word, row.labels, row.score) == (30_000, 59_998, ["apache"], 1.0)
