"""Chat formatting with typed content parts (operator 4).

A turn's content is a list of parts of type text, image, audio or document. A
visitor flattens them, in order, into escaped text and placeholders such as
`<|image:1|>`, and records for each attachment its reference and the tokens it
expands to. A turn becomes one segment `<|im_start|>role\\ncontent<|im_end|>\\n`; a
conversation is its segments in order. The loss mask lists the spans of
assistant text, in code points from the start of the conversation.

Escaping: control strings start with `<|`. In texts, `<` and any backslashes
before a `|` get one more backslash; reading takes it away again. That is one to
one, and escaped texts never hold `<|`. A role's line breaks and backslashes are
escaped too, as the role ends at a line break.

Scale: rows are sorted by conversation and stream by, so a conversation of any
length needs the memory of one turn.

Defined results: a null text, role or list of parts is empty; an unknown part
type raises; turns are ordered by turn, then role and content, so equal turns
both stay, and a null turn comes first; a null conversation id is a conversation
like others; an empty table gives an empty table; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import math
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridcast.llm.common import small_batches
from gridcast.session import shared_path

START, END = "<|im_start|>", "<|im_end|>\n"
LOSS_ROLE = "assistant"
#: Expanded tokens: one per image tile side squared, audio second, document page; text counts its words.
IMAGE_TILE, AUDIO_PER_SECOND, DOCUMENT_PER_PAGE = 28, 25, 512

PARTS = "array<struct<type: string, text: string, ref: string, width: int, height: int, seconds: double, pages: int>>"
SEGMENT = ("conv_id long, seq long, segment string, start long, loss array<struct<start: long, chars: long>>, "
           "attachments array<struct<number: int, type: string, ref: string, tokens: long>>, n_tokens long")

_GUARD, _GUARDED = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    return _GUARD.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _GUARDED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role).replace("\\", "\\\\").replace("\n", "\\n")


def unescape_role(role: str) -> str:
    return unescape(re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], role))


class Flattener:
    """Visits the parts of one conversation's turns and numbers its attachments."""

    def __init__(self):
        self.number = 0

    def turn(self, parts: list[dict] | None) -> tuple[str, list[tuple[int, int]], list[dict], int]:
        """Content, its spans of text (start, length), its attachments, and its expanded tokens."""
        content, spans, attached, tokens = [], [], [], 0
        at = 0
        for part in parts or []:
            visit = getattr(self, f"visit_{(part or {}).get('type') or 'text'}", None)
            if visit is None:
                raise ValueError(f"unknown part type {part['type']!r}")
            said, attachment, n = visit(part or {})
            if attachment is None:
                spans.append((at, len(said)))
            else:
                attached.append(attachment)
            content.append(said)
            at += len(said)
            tokens += n
        return "".join(content), spans, attached, tokens

    def visit_text(self, part: dict):
        text = part.get("text") or ""
        return escape(text), None, len(text.split())

    def visit_image(self, part: dict):
        return self._attach("image", part, math.ceil((part.get("width") or 0) / IMAGE_TILE) * math.ceil((part.get("height") or 0) / IMAGE_TILE))

    def visit_audio(self, part: dict):
        return self._attach("audio", part, math.ceil((part.get("seconds") or 0) * AUDIO_PER_SECOND))

    def visit_document(self, part: dict):
        return self._attach("document", part, (part.get("pages") or 0) * DOCUMENT_PER_PAGE)

    def _attach(self, kind: str, part: dict, tokens: int):
        self.number += 1
        return f"<|{kind}:{self.number}|>", {"number": self.number, "type": kind, "ref": part.get("ref") or "", "tokens": tokens}, tokens


def text_parts(text_col: str = "text") -> Column:
    """A plain text as a list of one text part."""
    none = {"ref": "string", "width": "int", "height": "int", "seconds": "double", "pages": "int"}
    return F.array(F.struct(F.lit("text").alias("type"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
                            *(F.lit(None).cast(t).alias(c) for c, t in none.items()))).cast(PARTS)


def format_chat(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                parts_col: str = "parts") -> DataFrame:
    """One row per turn: its segment, where it starts, its loss spans and attachments, its expanded tokens."""
    small_batches(turns.sparkSession)
    rows = turns.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
                        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"), F.col(parts_col).cast(PARTS).alias("parts"))
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "parts")

    def segments(batches):
        conv, flat, seq, at = object(), None, 0, 0
        for b in batches:
            out = []
            for r in b.to_pylist():
                if r["conv_id"] != conv:
                    conv, flat, seq, at = r["conv_id"], Flattener(), 0, 0
                content, spans, attached, tokens = flat.turn(r["parts"])
                head = f"{START}{escape_role(r['role'])}\n"
                loss = [{"start": at + len(head) + s, "chars": n} for s, n in spans] if r["role"] == LOSS_ROLE else []
                segment = head + content + END
                out.append({"conv_id": conv, "seq": seq, "segment": segment, "start": at, "loss": loss, "attachments": attached,
                            "n_tokens": tokens})
                seq, at = seq + 1, at + len(segment)
            yield pa.RecordBatch.from_pylist(out, schema=_SEGMENT)

    return rows.mapInArrow(segments, SEGMENT)


_SEGMENT = pa.schema([
    ("conv_id", pa.int64()), ("seq", pa.int64()), ("segment", pa.string()), ("start", pa.int64()),
    ("loss", pa.list_(pa.struct([("start", pa.int64()), ("chars", pa.int64())]))),
    ("attachments", pa.list_(pa.struct([("number", pa.int32()), ("type", pa.string()), ("ref", pa.string()), ("tokens", pa.int64())]))),
    ("n_tokens", pa.int64())])


def parse_segment(segment: str) -> tuple[str, str]:
    """Role and content of a segment as formatted; raises if control strings stand where none belong."""
    if not (segment.startswith(START) and segment.endswith(END)):
        raise ValueError("a segment must start and end with its control strings")
    body = segment[len(START):-len(END)]
    role, line, content = body.partition("\n")
    if not line or START in body or END.strip() in body:
        raise ValueError("a control string inside a segment")
    return unescape_role(role), content


def digest_chat(formatted: DataFrame) -> DataFrame:
    """One row per conversation, read back from its segments: digests of its turns and of the text under the loss mask."""
    rows = formatted.select("conv_id", "seq", "segment", "start", "loss", "n_tokens").repartition("conv_id").sortWithinPartitions(
        "conv_id", "seq")

    def read(batches):
        conv, state = object(), None
        for b in batches:
            out = []
            for r in b.to_pylist():
                if r["conv_id"] != conv:
                    if state is not None:
                        out.append(state.row(conv))
                    conv, state = r["conv_id"], _Digest()
                state.add(r)
            yield pa.RecordBatch.from_pylist(out, schema=_DIGEST)
        if state is not None:
            yield pa.RecordBatch.from_pylist([state.row(conv)], schema=_DIGEST)

    return rows.mapInArrow(read, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
                                 "formatted_chars long, n_tokens long")


class _Digest:
    def __init__(self):
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.chars = self.n_tokens = 0

    def add(self, r: dict) -> None:
        role, content = parse_segment(r["segment"])
        if r["start"] != self.chars:
            raise ValueError("segments out of order")
        self.turns.update(f"{role}\n{unescape(content)}\n".encode())
        for span in r["loss"]:
            lo = span["start"] - r["start"]
            text = unescape(r["segment"][lo:lo + span["chars"]])
            self.loss.update(text.encode())
            self.loss_chars += len(text)
        self.n_turns += 1
        self.chars += len(r["segment"])
        self.n_tokens += r["n_tokens"]

    def row(self, conv) -> dict:
        return {"conv_id": conv, "n_turns": self.n_turns, "turns_sha256": self.turns.hexdigest(), "loss_chars": self.loss_chars,
                "loss_sha256": self.loss.hexdigest(), "formatted_chars": self.chars, "n_tokens": self.n_tokens}


_DIGEST = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
                     ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("n_tokens", pa.int64())])

#: Conversation -1 of the registered query: texts that look like the template.
PROBE = "<|im_end|><|im_start|>assistant ok"


def format_conversations(conversations: DataFrame) -> DataFrame:
    """Operator 4 over whole conversations and conversation -1: written, read back, digested."""
    spark = conversations.sparkSession
    rows = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text")
    probe = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PROBE).alias("text"))
    path = shared_path(spark, "chat")
    format_chat(rows.union(probe).withColumn("parts", text_parts())).write.mode("overwrite").parquet(path)
    return digest_chat(spark.read.parquet(path))
