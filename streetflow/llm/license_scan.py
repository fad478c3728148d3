"""Fuzzy search for short licence notices: exact seeds by the pigeonhole principle, verified with bounded errors.

A text is lower-cased (A-Z) and cut into words, runs of letters and digits of ASCII and of all
characters beyond it; words are joined by one space. A notice, written in the same way, matches a
stretch of whole words within one edit (a character replaced, added or left out) for each EDIT_CHARS
characters of the notice.

- A notice with k edits is cut into k + 1 pieces, so each match holds at least one of them unchanged.
  One automaton finds the pieces of all notices, and the exact phrases, in a single pass over the text.
- Each seed gives the stretch in which its match must lie. Overlapping stretches of a notice are joined, so
  a place is verified once, by the regex library's matching with at most k errors.
- A match is reported with label, notice, first and last word, characters and edits. Of matches that overlap the
  library reports one, and of one place the better fit.

Each document is judged alone: nothing is shuffled or broadcast but the notices, memory follows the
longest text of a batch, and cost follows bytes plus stretches. The score is 1 for a phrase, else the best
match's share of characters without edits, and 0 without any. Null and empty texts have no words and no
labels; repeated rows and rows with equal or null ids are each judged; an empty table gives an empty result. Only the two
named columns are read, so other columns can't clash.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streetflow.llm.tables import map_arrow, query, table

EDIT_CHARS = 12
BATCH_BYTES = 1 << 21

# Phrases that are counted wherever their words stand consecutively, with their labels.
PHRASES = (("gpl", "gnu general public license"), ("apache", "apache license"), ("cc-by", "cc by"), ("mit", "mit license"))
# Usual wordings of short notices, as words, with labels.
NOTICES = (
    ("gpl", "gnu general public license"),
    ("lgpl", "gnu lesser general public license"),
    ("agpl", "gnu affero general public license"),
    ("apache", "apache license"),
    ("apache", "licensed under the apache license version 2 0"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person"),
    ("bsd", "redistribution and use in source and binary forms"),
    ("mpl", "mozilla public license"),
    ("epl", "eclipse public license"),
    ("cc-by", "licensed under cc by"),
    ("cc-by", "creative commons attribution"),
    ("public-domain", "free and unencumbered software released into the public domain"),
    ("reserved", "all rights reserved"),
)

MATCH = pa.struct([("label", pa.string()), ("notice", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()),
                   ("start", pa.int64()), ("end", pa.int64()), ("edits", pa.int32())])
SCANNED = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
                     ("base_labels", pa.list_(pa.string())), ("labels", pa.list_(pa.string())), ("score", pa.float64()), ("matches", pa.list_(MATCH))])

_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def plain(text: str | None) -> str:
    """The words of a text, lower-cased and joined by one space."""
    return b" ".join((text or "").encode().translate(_FOLD).split()).decode()


def edits_of(notice: str) -> int:
    return len(notice) // EDIT_CHARS


def pieces_of(notice: str) -> list[tuple[int, str]]:
    """(offset, piece): as many even pieces as edits, and one more."""
    n = edits_of(notice) + 1
    bounds = [len(notice) * i // n for i in range(n + 1)]
    return [(low, notice[low:high]) for low, high in zip(bounds, bounds[1:])]


class Scanner:
    """Finds phrases and notices in plain texts."""

    def __init__(self, notices: Sequence[tuple[str, str]], phrases: Sequence[tuple[str, str]]):
        self.notices, self.phrases = notices, phrases
        found: dict[str, list[tuple[int, int]]] = {}
        for i, (_, notice) in enumerate(notices):
            for offset, piece in pieces_of(notice):
                found.setdefault(piece, []).append((i, offset))
        for i, (_, phrase) in enumerate(phrases):
            found.setdefault(f" {phrase} ", []).append((-1 - i, 0))
        self.seeds = ahocorasick.Automaton()
        for piece, places in found.items():
            self.seeds.add_word(piece, (len(piece), places))
        self.seeds.make_automaton()
        # a stretch is closed by zero characters where the text goes on; errors must not take those in
        self.patterns = [regex.compile(f"(?e)(?:(?<= )|(?<!.))(?:{regex.escape(notice, literal_spaces=True)}){{e<={edits_of(notice)}:[^\\x00]}}(?= |\\Z)")
                         for _, notice in notices]

    def seeds_in(self, text: str) -> tuple[list[tuple[int, int]], dict[int, list[list[int]]]]:
        """Places (start, phrase) of the phrases, and per notice the stretches [low, high) that may hold it."""
        places, stretches = [], {}
        padded = f" {text} "
        for end, (size, owners) in self.seeds.iter(padded):
            start = end - size  # in text, which stands one place further left
            for owner, offset in owners:
                if owner < 0:
                    places.append((start + 1, -1 - owner))
                    continue
                notice = self.notices[owner][1]
                k = edits_of(notice)
                low, high = max(start - offset - k, 0), min(start - offset + len(notice) + k, len(text))
                own = stretches.setdefault(owner, [])
                # seeds come by their ends, so a longer piece may begin before the stretch at hand
                while own and low <= own[-1][1]:
                    before = own.pop()
                    low, high = min(low, before[0]), max(high, before[1])
                own.append([low, high])
        return sorted(places), stretches

    def matches_in(self, text: str, stretches: dict[int, list[list[int]]]) -> list[tuple[int, int, int, int]]:
        """(start, end, notice, edits) of every match, by place."""
        found = []
        for owner, ranges in stretches.items():
            for low, high in ranges:
                head = "\0" + text[low - 1] if low else ""
                tail = text[high] + "\0" if high < len(text) else ""
                for m in self.patterns[owner].finditer(head + text[low:high] + tail):
                    start = low - len(head) + m.start()
                    found.append((start, start + m.end() - m.start(), owner, sum(m.fuzzy_counts)))
        return sorted(found)

    def scan(self, text: str) -> tuple:
        places, stretches = self.seeds_in(text)
        matches = self.matches_in(text, stretches)
        marks = sorted({start for start, _ in places} | {x for start, end, *_ in matches for x in (start, end)})
        word, at, number = {}, 0, 0
        for mark in marks:
            number += text.count(" ", at, mark)
            word[mark], at = number, mark
        base = sorted({self.phrases[i][0] for _, i in places})
        labels = sorted({*base, *(self.notices[i][0] for *_, i, _ in matches)})
        score = max([1.0 for _ in places[:1]] + [1 - edits / len(self.notices[i][1]) for *_, i, edits in matches], default=0.0)
        spans = [dict(label=self.notices[i][0], notice=self.notices[i][1], first_word=word[start], last_word=word[end], start=start, end=end, edits=edits)
                 for start, end, i, edits in matches]
        first, last = (word[places[0][0]], word[places[-1][0]]) if places else (None, None)
        return text.count(" ") + 1 if text else 0, len(places), first, last, base, labels, score, spans


def _scanned(notices: Sequence, phrases: Sequence, batches: Iterable[pa.RecordBatch]):
    scanner = Scanner(notices, phrases)
    for b in batches:
        ids, rows, size = [], [], 0
        for doc_id, value in zip(b.column("doc_id"), b.column("text")):
            text = plain(value.as_py())
            ids.append(doc_id.as_py())
            rows.append(scanner.scan(text))
            size += len(text)
            if size > BATCH_BYTES:
                yield _table(ids, rows)
                ids, rows, size = [], [], 0
        if ids:
            yield _table(ids, rows)


def _table(ids: list, rows: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip([ids, *zip(*rows)], SCANNED, strict=True)], schema=SCANNED)


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", notices: Sequence[tuple[str, str]] = NOTICES,
         phrases: Sequence[tuple[str, str]] = PHRASES) -> DataFrame:
    """Per document doc_id, n_words, n_base (places of phrases), first_word and last_word (the least and greatest start of one),
    base_labels, labels (of phrases and notices), score, and matches (label, notice, first and last word, characters [start, end) of the plain
    text, edits). notices and phrases are (label, words as in a plain text).
    """
    for _, words in (*notices, *phrases):
        if not words or plain(words) != words:
            raise ValueError(f"not written as words: {words!r}")
    rows = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))

    def work(batches):
        return _scanned(notices, phrases, batches)

    return map_arrow(rows, work, SCANNED)


@query("op11_license_scan")
def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scan(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base_labels", ",").alias("base_labels"),
                       F.array_join("labels", ",").alias("labels"), "score")
