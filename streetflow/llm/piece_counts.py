"""Token counts by a linear longest-match automaton.

The vocabulary's pieces form a byte trie. A node's failure link leads to the node that matching
goes on from once the node's text is cut into longest pieces as far as it is certain, and the
number of pieces cut off on the way is stored with it, so a word is counted in time linear in its
bytes, without building pieces or starting over. Words are runs of bytes other than ASCII white
space, each matched with a leading space as the vocabulary has it; pieces that begin words start
with that space. A word with a part no piece matches counts as one unknown token.

The automaton's size is bounded by the vocabulary; it is built once and sent to the tasks. A task
remembers counts of at most REMEMBERED words.

Null and empty texts have 0 words and tokens; repeated rows are each counted; an empty table gives
an empty result. Only the named columns are used.
"""

from __future__ import annotations

import json
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streetflow.llm.tables import map_arrow, query, table

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
REMEMBERED = 1 << 17
COUNTED = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_tokens", pa.int64())])


def read_pieces(path: str = VOCABULARY) -> list[bytes]:
    """Pieces of a byte-level vocabulary file; its printable stand-ins are turned back into bytes."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    back = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}
    with open(path, encoding="utf-8") as file:
        vocabulary = json.load(file)["model"]["vocab"]
    return [bytes(back[c] for c in piece) for piece in vocabulary if all(c in back for c in piece)]


class Automaton:
    """Trie with failure links. next: (node << 8 | byte) -> node; links[node]: failure node or -1; popped[node]: pieces cut off there."""

    def __init__(self, pieces: Iterable[bytes]):
        self.next, final, levels = {}, {0: False}, [(0, 0, 0)]
        for piece in pieces:
            node = 0
            for byte in piece:
                edge = node << 8 | byte
                if edge not in self.next:
                    self.next[edge] = len(final)
                    final[len(final)] = False
                node = self.next[edge]
            final[node] = node != 0
        depth = [0] * len(final)
        for edge, node in self.next.items():  # parents come before their children
            depth[node] = depth[edge >> 8] + 1
        levels = sorted(self.next.items(), key=lambda item: depth[item[1]])
        self.links, self.popped = [-1] * len(final), [0] * len(final)
        for edge, node in levels:
            if final[node]:
                self.links[node], self.popped[node] = 0, 1
                continue
            byte, at, cut = edge & 255, self.links[edge >> 8], self.popped[edge >> 8]
            while at >= 0 and (at << 8 | byte) not in self.next:
                at, cut = self.links[at], cut + self.popped[at]
            if at >= 0:
                self.links[node], self.popped[node] = self.next[at << 8 | byte], cut

    def count(self, word: bytes) -> int:
        """Number of greedy longest-match pieces; 1 if some part is in no piece."""
        following, links, popped = self.next, self.links, self.popped
        node = total = 0
        for byte in word:
            to = following.get(node << 8 | byte)
            while to is None:
                if links[node] < 0:
                    return 1
                total += popped[node]
                node = links[node]
                to = following.get(node << 8 | byte)
            node = to
        while node:
            if links[node] < 0:
                return 1
            total += popped[node]
            node = links[node]
        return total


class _Memory(dict):
    def __init__(self, automaton: Automaton):
        self.count = automaton.count

    def __missing__(self, word: bytes) -> int:
        n = self.count(b" " + word)
        if len(word) < 64:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = n
        return n


def count_tokens(docs: DataFrame, pieces: list[bytes], key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document doc_id, n_words and n_tokens."""
    sent = docs.sparkSession.sparkContext.broadcast(Automaton(pieces))

    def work(batches):
        memory = _Memory(sent.value)
        for b in batches:
            words, tokens = [], []
            for value in b.column("text").cast(pa.binary()):
                parts = (value.as_py() or b"").split()
                words.append(len(parts))
                tokens.append(sum(map(memory.__getitem__, parts)))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(words, pa.int64()), pa.array(tokens, pa.int64())],
                                             schema=COUNTED)

    return map_arrow(docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text")), work, COUNTED)


@query("op9_piece_counts")
def op9_piece_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), read_pieces())
