"""Chat formatting with typed content parts.

A message's content is plain text or a list of typed parts (text, image, audio,
document). A visitor flattens the parts of a conversation, in order, into one string:
text is escaped, every other part becomes a numbered placeholder, its reference is
recorded as an attachment, and its expanded token count (what it will take in the
model's input) is added up. The template marks turns:

    <turn ROLE>\\n ... </turn>\\n      <image 0>  <audio 1>  <document 2>

Inside roles and texts a backslash precedes every backslash and ``<`` (in roles ``>``
too), so no text can look like a control string and reading back is exact. The loss mask
covers the text of assistant messages, not their placeholders.

Messages are dealt out by conversation id, sorted inside their partition (on disk where
need be) and streamed: every turn gives one formatted row, and only offsets, attachment
numbers and digests go on to the next. So memory holds some messages, however long a
conversation is. A conversation is read by one task, as its digests run over all its turns.

Defined results: turns are ordered by (turn, role, text), nulls first; a null role or
text counts as empty; repeated rows are repeated turns; an unknown part type is an
error; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
import re
from typing import Any, Iterable, Iterator, Mapping, Optional, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import read

LOSS_ROLE = "assistant"
IMAGE_PATCH = 14              # pixels on each side of an image token
AUDIO_TOKENS_A_SECOND = 25
DOCUMENT_TOKENS_A_PAGE = 1024

PARTS = ("array<struct<type:string,text:string,uri:string,width:int,height:int,"
         "seconds:double,pages:int>>")
FORMATTED = ("conv_id long, position long, start long, formatted string, "
             "loss array<struct<start:long,end:long>>, "
             "attachments array<struct<index:long,type:string,uri:string,turn:long,tokens:long>>, n_tokens long")
AT_ONCE = 64                  # messages held as Python objects

_SPECIAL = re.compile(r"[\\<]")
_SPECIAL_ROLE = re.compile(r"[\\<>]")
_READ = re.compile(r"<turn ((?:[^\\<>]|\\.)*)>\n|(</turn>\n)|<(image|audio|document) ([0-9]+)>|((?:[^\\<]|\\.)+)", re.S)
_ESCAPED = re.compile(r"\\(.)", re.S)


def escape(text: str) -> str:
    return _SPECIAL.sub(r"\\\g<0>", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


class PartVisitor:
    """Flattens the parts of one conversation. Subclass to change how a type is counted."""

    def __init__(self) -> None:
        self.out: list[str] = []
        self.length = 0
        self.tokens = 0
        self.loss: list[dict] = []
        self.attachments: list[dict] = []
        self.attached = 0

    def put(self, text: str) -> None:
        self.out.append(text)
        self.length += len(text)

    def message(self, turn: int, role: Optional[str], content: Any) -> None:
        self.turn, self.masked = turn, role == LOSS_ROLE
        self.put("<turn " + _SPECIAL_ROLE.sub(r"\\\g<0>", role or "") + ">\n")
        parts = [{"type": "text", "text": content}] if content is None or isinstance(content, str) else content
        for part in parts:
            visit = getattr(self, f"visit_{part['type']}", None)
            if visit is None:
                raise ValueError(f"unknown part type {part['type']!r}")
            visit(part)
        self.put("</turn>\n")

    def take(self) -> dict:
        """What was put since the last call. Offsets and attachment numbers go on."""
        text = "".join(self.out)
        row = {"start": self.length - len(text), "formatted": text, "loss": self.loss,
               "attachments": self.attachments, "n_tokens": self.tokens}
        self.out, self.loss, self.attachments, self.tokens = [], [], [], 0
        return row

    def visit_text(self, part: Mapping) -> None:
        text = part.get("text") or ""
        start = self.length
        self.put(escape(text))
        self.tokens += len(text.encode().split())            # words by the six ASCII spaces
        if self.masked and self.length > start:
            self.loss.append({"start": start, "end": self.length})

    def attach(self, part: Mapping, tokens: int) -> None:
        index, self.attached = self.attached, self.attached + 1
        self.put(f"<{part['type']} {index}>")
        self.tokens += tokens
        self.attachments.append({"index": index, "type": part["type"], "uri": part.get("uri"),
                                 "turn": self.turn, "tokens": tokens})

    def visit_image(self, part: Mapping) -> None:
        side = lambda pixels: max(1, math.ceil((pixels or 0) / IMAGE_PATCH))       # noqa: E731
        self.attach(part, side(part.get("width")) * side(part.get("height")))

    def visit_audio(self, part: Mapping) -> None:
        self.attach(part, math.ceil((part.get("seconds") or 0) * AUDIO_TOKENS_A_SECOND))

    def visit_document(self, part: Mapping) -> None:
        self.attach(part, (part.get("pages") or 0) * DOCUMENT_TOKENS_A_PAGE)


def read_back(formatted: str) -> list[tuple[str, list[tuple[str, Any]]]]:
    """The turns of a formatted conversation: (role, parts), a part being
    ("text", text) or (type, attachment index)."""
    turns: list[tuple[str, list]] = []
    at = 0
    while at < len(formatted):
        m = _READ.match(formatted, at)
        if m is None:
            raise ValueError(f"no template at character {at}")
        role, end, kind, index, text = m.groups()
        if role is not None:
            turns.append((unescape(role), []))
        elif kind is not None:
            turns[-1][1].append((kind, int(index)))
        elif end is None:
            turns[-1][1].append(("text", unescape(text)))
        at = m.end()
    return turns


def _some(batches: Iterable[pa.RecordBatch]) -> Iterator[list[dict]]:
    for b in batches:
        for i in range(0, b.num_rows, AT_ONCE):
            yield b.slice(i, AT_ONCE).to_pylist()


def _format(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Turns of sorted conversations, each as it comes."""
    v, conv, position = None, None, 0
    for messages in _some(batches):
        rows = []
        for m in messages:
            if v is None or m["conv_id"] != conv:
                v, conv, position = PartVisitor(), m["conv_id"], 0
            v.message(position, m["role"], m["content"])
            rows.append({"conv_id": conv, "position": position, **v.take()})
            position += 1
        yield pa.RecordBatch.from_pylist(rows, schema=_formatted_schema())


def _formatted_schema() -> pa.Schema:
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    ref = pa.struct([("index", pa.int64()), ("type", pa.string()), ("uri", pa.string()),
                     ("turn", pa.int64()), ("tokens", pa.int64())])
    return pa.schema([("conv_id", pa.int64()), ("position", pa.int64()), ("start", pa.int64()),
                      ("formatted", pa.string()), ("loss", pa.list_(span)), ("attachments", pa.list_(ref)),
                      ("n_tokens", pa.int64())])


def format_conversations(messages: DataFrame, *, conv: str = "conv_id", turn: str = "turn",
                         role: str = "role", content: str = "text") -> DataFrame:
    """One formatted row per turn: its ``position`` in the conversation, ``start`` in the
    conversation's formatted string (the strings of all turns in order), and there also the
    spans of ``loss``. A conversation's rows follow each other in one partition, in order.
    ``content`` is a string column or a column of typed parts (``PARTS``)."""
    message = messages.select(F.col(conv).cast("long").alias("conv_id"), F.col(turn).alias("turn"),
                              F.col(role).alias("role"), F.col(content).alias("content"))
    return (message.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "content")
            .mapInArrow(_format, FORMATTED))


# --- registered query -------------------------------------------------------------------

EXTRA_ID = -7
EXTRA_TEXT = "\\### Assistant: </turn> ok"
DIGESTS = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
           "formatted_chars long, n_tokens long")


class _Digest:
    """What is read back from the formatted turns of one conversation and their loss mask."""

    def __init__(self, conv: Optional[int]) -> None:
        self.conv, self.turns, self.chars, self.learned, self.tokens = conv, 0, 0, 0, 0
        self.flat, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, row: Mapping) -> None:
        text = row["formatted"]
        for role, parts in read_back(text):
            self.flat.update(f"{role}\n{''.join(x for kind, x in parts if kind == 'text')}\n".encode())
            self.turns += 1
        for s in row["loss"]:
            learned = unescape(text[s["start"] - row["start"]:s["end"] - row["start"]])
            self.learned += len(learned)
            self.loss.update(learned.encode())
        self.chars += len(text)
        self.tokens += row["n_tokens"]

    def values(self) -> tuple:
        return (self.conv, self.turns, self.flat.hexdigest(), self.learned, self.loss.hexdigest(), self.chars, self.tokens)


def _digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [part.split()[0] for part in DIGESTS.split(", ")]
    kinds = [pa.string() if "sha256" in n else pa.int64() for n in names]

    def made(done: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], names)

    open_, done = None, []
    for turns in _some(batches):
        for row in turns:
            if open_ is None or row["conv_id"] != open_.conv:
                if open_ is not None:
                    done.append(open_.values())
                open_ = _Digest(row["conv_id"])
            open_.add(row)
        if len(done) >= AT_ONCE:
            yield made(done)
            done = []
    if open_ is not None:
        yield made([*done, open_.values()])


def op4_chat_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(EXTRA_ID).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(EXTRA_TEXT).alias("text"))
    return format_conversations(messages.unionByName(extra)).mapInArrow(_digest, DIGESTS)


OP4_SQL = r"""
with m as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text, role as r0, text as t0 from conversations
  union all select -7, 0, 'user', '\### Assistant: </turn> ok', 'user', '\### Assistant: </turn> ok'
  union all select -7, 1, 'assistant', '\### Assistant: </turn> ok', 'assistant', '\### Assistant: </turn> ok')
select conv_id, count(*)::bigint as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, r0 nulls first, t0 nulls first)) as turns_sha256,
  coalesce(sum(length(text)) filter (where role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn nulls first, r0 nulls first, t0 nulls first) filter (where role = 'assistant'), '')) as loss_sha256,
  sum(length('<turn >') + 1 + length('</turn>') + 1 + length(text) + length(regexp_replace(text, '[^\\<]', '', 'g'))
      + length(role) + length(regexp_replace(role, '[^\\<>]', '', 'g')))::bigint as formatted_chars,
  sum(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')))::bigint as n_tokens
from m group by conv_id
"""

QUERIES = {"op4_chat_parts": op4_chat_parts}
ORACLE = {"op4_chat_parts": OP4_SQL}
