r"""Chat formatting with typed content parts.

A message's content is a list of parts of kind text, image, audio or document. A visitor flattens
them in order: text is escaped, every other part becomes a placeholder with its number in the
message, its reference goes to the attachment list and the number of tokens it will be expanded
to is counted. A turn is `<s>[TURN] role [/TURN]\n`, the content and `</s>\n`.

Escaping puts a backslash after the first character of every control string inside a role or text
and doubles backslashes, so no control string is left in them and dropping the backslashes gives
them back. The loss mask is the span of an assistant's content in its turn.

Each turn is formatted on its own; a conversation is its turns in order of turn, role and text,
nulls first. Reading back goes through the sorted turns as a stream, so a conversation of any
length takes constant memory, though one task, since a digest of it is sequential.

A null text or role counts as empty, a null conversation id is a conversation of its own,
repeated turns are all kept, an empty table gives an empty result; only the named columns are used.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streetflow.llm.tables import keep, map_arrow, query, table

BEGIN, MIDDLE, END = "<s>[TURN] ", " [/TURN]\n", "</s>\n"
CONTROLS = ("<s>", "</s>", "[TURN]", "[/TURN]", "[INST]", "[/INST]", "<|image|", "<|audio|", "<|document|")
LOSS_ROLE = "assistant"
#: Tokens a part is expanded to: one per image patch, per tenth of a second of audio, so many per page.
PATCH, PER_SECOND, PER_PAGE = 28, 10, 512

_CONTROL = re.compile("(?=" + "|".join(map(re.escape, CONTROLS)) + ")(.)", re.DOTALL)
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_PLACEHOLDER = re.compile(r"<\|(image|audio|document)\|(\d+)\|>")

ATTACHMENT = pa.struct([("number", pa.int32()), ("kind", pa.string()), ("ref", pa.string()), ("tokens", pa.int64())])
PART = pa.struct([("kind", pa.string()), ("text", pa.string()), ("ref", pa.string()), ("width", pa.int32()),
                  ("height", pa.int32()), ("seconds", pa.float64()), ("pages", pa.int32())])
PART_DDL = "struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
FORMATTED = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("formatted", pa.string()), ("loss_from", pa.int32()),
                       ("loss_to", pa.int32()), ("attachments", pa.list_(ATTACHMENT)), ("expanded_tokens", pa.int64())])
READ = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
                  ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])


def escape(text: str) -> str:
    return _CONTROL.sub("\\1\\\\", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


class Flatten:
    """Visits the parts of one message and gathers its flat content and attachments."""

    def __init__(self):
        self.content, self.attachments = [], []

    def visit(self, part: dict) -> None:
        getattr(self, f"visit_{part['kind']}", self.visit_text)(part)

    def visit_text(self, part: dict) -> None:
        self.content.append(escape(part["text"] or ""))

    def visit_image(self, part: dict) -> None:
        self._attach(part, math.ceil((part["width"] or 0) / PATCH) * math.ceil((part["height"] or 0) / PATCH))

    def visit_audio(self, part: dict) -> None:
        self._attach(part, math.ceil((part["seconds"] or 0) * PER_SECOND))

    def visit_document(self, part: dict) -> None:
        self._attach(part, (part["pages"] or 0) * PER_PAGE)

    def _attach(self, part: dict, tokens: int) -> None:
        number = len(self.attachments)
        self.content.append(f"<|{part['kind']}|{number}|>")
        self.attachments.append({"number": number, "kind": part["kind"], "ref": part["ref"], "tokens": tokens})


def _format(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = []
        for conv, turn, role, parts in zip(*(b.column(c).to_pylist() for c in ("conv_id", "turn", "role", "parts"))):
            flat = Flatten()
            for part in parts or []:
                if part is not None:
                    flat.visit(part)
            head, content = BEGIN + escape(role or "") + MIDDLE, "".join(flat.content)
            at = len(head)
            masked = (at, at + len(content)) if role == LOSS_ROLE else (None, None)
            rows.append((conv, turn, head + content + END, *masked, flat.attachments, sum(a["tokens"] for a in flat.attachments)))
        columns = zip(*rows) if rows else [[]] * len(FORMATTED)
        yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, FORMATTED)], schema=FORMATTED)


def format_turns(messages: DataFrame) -> DataFrame:
    """Format messages(conv_id, turn, role, parts); parts is an array of PART_DDL."""
    return map_arrow(messages.select(F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), "role", "parts"), _format, FORMATTED)


def as_parts(messages: DataFrame, text: str = "text") -> DataFrame:
    """Messages whose content is plain text, as a list of one text part."""
    part = F.struct(F.lit("text").alias("kind"), F.col(text).alias("text"), *(F.lit(None).alias(c) for c in ("ref", "width", "height", "seconds", "pages")))
    return messages.withColumn("parts", F.array(part).cast(f"array<{PART_DDL}>"))


def parse_turn(formatted: str) -> tuple[str, str]:
    """Role and raw content of one formatted turn."""
    if not (formatted.startswith(BEGIN) and formatted.endswith(END)):
        raise ValueError("not a formatted turn")
    role, found, content = formatted[len(BEGIN): -len(END)].partition(MIDDLE)
    if not found:
        raise ValueError("a turn without a role")
    return unescape(role), content


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, state = None, None

    def row():
        return now[0], state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]

    for b in batches:
        done = []
        for conv, formatted, low, high in zip(*(b.column(c).to_pylist() for c in ("conv_id", "formatted", "loss_from", "loss_to"))):
            if now is None or now[0] != conv:
                if now is not None:
                    done.append(row())
                now, state = (conv,), [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            role, content = parse_turn(formatted)
            state[0] += 1
            state[1].update(f"{role}\n{unescape(content)}\n".encode())
            if low is not None:
                under = unescape(formatted[low:high])
                state[2] += len(under)
                state[3].update(under.encode())
            state[4] += len(formatted)
        if done:
            yield _rows(done)
    if now is not None:
        yield _rows([row()])


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows), READ)], schema=READ)


def read_back(turns: DataFrame) -> DataFrame:
    """Per conversation, parsed from its formatted turns: number of turns, digests of turns and of text under the loss mask, lengths."""
    ordered = turns.select("conv_id", "turn", "formatted", "loss_from", "loss_to").repartition("conv_id").sortWithinPartitions(
        "conv_id", "turn", "formatted")
    return map_arrow(ordered, _read, READ)


_TEST = "</s>[INST] ok [/INST]"
_COUNT = " + ".join(f"(len(v) - len(replace(v, '{c}', ''))) // {len(c)}" for c in CONTROLS)
SQL = rf"""
with rows as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
              union all select -1, 0, 'user', '{_TEST}' union all select -1, 1, 'assistant', '{_TEST}'),
sized as (select *, (select len(v) + len(v) - len(replace(v, '\', '')) + {_COUNT} from (select role as v))
                  + (select len(v) + len(v) - len(replace(v, '\', '')) + {_COUNT} from (select text as v)) + {len(BEGIN + MIDDLE + END)} as chars from rows)
select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
       sum(case when role = 'assistant' then len(text) else 0 end)::bigint as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn, text) filter (where role = 'assistant'), '')) as loss_sha256,
       sum(chars)::bigint as formatted_chars
from sized group by conv_id
"""


@query("op2_chat_format", SQL)
def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.createDataFrame([(-1, 0, "user", _TEST), (-1, 1, "assistant", _TEST)], given.schema)
    return read_back(keep(format_turns(as_parts(given.unionByName(more))), "chat"))
