"""Chat formatting with typed content parts.

A visitor walks over the parts of a turn - text, image, audio, document - and flattens them into one string in which
each attachment is a placeholder, noting the attachment's reference and the tokens it will expand to. Turns are set into
a template with control strings; text that looks like one is escaped so that reading back restores it exactly.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, objects

START, END = "<|im_start|>", "<|im_end|>"
PART = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
OUT = "formatted string, loss array<struct<start:long,end:long>>, attachments array<struct<turn:int,position:int,type:string,ref:string,tokens:long>>"
_CONTROL, _ESCAPED = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")
_TURN = re.compile(re.escape(START) + r"((?:(?!\n).)*)\n(.*?)" + re.escape(END) + r"\n", re.S)


def escape(text: str) -> str:
    """No control string is left: every ``<`` that backslashes or nothing separate from a ``|`` gets one backslash more."""
    return _CONTROL.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def _role(role: str | None) -> str:
    return escape((role or "").replace("\\", "\\\\").replace("\n", "\\n"))


def _unrole(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role), flags=re.S)


@dataclass
class Flattener:
    """Visits the parts of a turn in order. Adjacent texts are joined before they are escaped, so that no control string
    can form across parts. A part of an unknown kind is an error; a null part, or a null text, is an empty text."""

    patch: int = 14
    audio_rate: float = 25.0
    page_tokens: int = 256
    pieces: list[str] = field(default_factory=list)
    pending: list[str] = field(default_factory=list)
    attached: list[tuple[str, str | None, int]] = field(default_factory=list)

    def visit(self, part: dict | None) -> None:
        kind = (part or {}).get("type") or "text"
        visitor = getattr(self, f"visit_{kind}", None)
        if visitor is None:
            raise ValueError(f"unknown kind of content part: {kind}")
        visitor(part or {})

    def visit_text(self, part: dict) -> None:
        self.pending.append(part.get("text") or "")

    def visit_image(self, part: dict) -> None:
        across, down = (math.ceil((part.get(k) or self.patch) / self.patch) for k in ("width", "height"))
        self._attach("image", part, across * down)

    def visit_audio(self, part: dict) -> None:
        self._attach("audio", part, math.ceil((part.get("seconds") or 0.0) * self.audio_rate))

    def visit_document(self, part: dict) -> None:
        self._attach("document", part, (part.get("pages") or 1) * self.page_tokens)

    def _attach(self, kind: str, part: dict, tokens: int) -> None:
        self._settle()
        self.pieces.append(f"<|{kind}|>")
        self.attached.append((kind, part.get("ref"), tokens))

    def _settle(self) -> None:
        self.pieces.append(escape("".join(self.pending)))
        self.pending.clear()

    def done(self) -> str:
        self._settle()
        return "".join(self.pieces)


def format_turns(turns: list[dict]) -> dict:
    """The formatted conversation, the spans of code points under the loss mask (assistants' contents), the attachments."""
    out, at, loss, attachments = [], 0, [], []
    for number, turn in enumerate(turns):
        visitor = Flattener()
        for part in turn["parts"] if turn["parts"] is not None else []:
            visitor.visit(part)
        content = visitor.done()
        head = f"{START}{_role(turn['role'])}\n"
        out += [head, content, f"{END}\n"]
        if turn["role"] == "assistant":
            loss.append({"start": at + len(head), "end": at + len(head) + len(content)})
        at += len(head) + len(content) + len(END) + 1
        attachments += [{"turn": number, "position": k, "type": kind, "ref": ref, "tokens": tokens} for k, (kind, ref, tokens) in enumerate(visitor.attached)]
    return {"formatted": "".join(out), "loss": loss, "attachments": attachments}


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns (role, text) of a formatted conversation; attachments are read back as their placeholders."""
    return [(_unrole(role), unescape(content)) for role, content in _TURN.findall(formatted)]


def text_part(text: Column) -> Column:
    """An array of one text part."""
    return F.array(F.struct(F.lit("text").alias("type"), text.alias("text")).cast("struct<type:string,text:string>")).cast("array<struct<type:string,text:string>>")


def format_chats(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", parts_col: str = "parts") -> DataFrame:
    """One row for each conversation: its id, ``formatted``, ``loss`` (spans) and ``attachments``.

    ``parts_col`` holds an array of parts, structs with a ``type`` and the fields of ``PART`` that they need. Turns go by
    ``turn_col``, null first; equal ones by role and parts. A null id is a conversation of its own; a null role is an
    empty one; null parts are an empty text; repeated rows are turns of their own. A conversation is one output record
    and has to fit into a task; partial lists are gathered before the shuffle. Other columns play no part.
    """
    lists = bounded_batches(turns).groupBy(F.col(conv_col).alias(conv_col)).agg(F.array_sort(F.collect_list(F.struct(F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), F.col(parts_col).alias("parts")))).alias("turns"))

    @F.pandas_udf(OUT)
    def formatted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for convs in batches:
            made = [format_turns(list(c)) for c in convs]
            yield pd.DataFrame({k: objects([m[k] for m in made]) for k in ("formatted", "loss", "attachments")})

    return lists.select(conv_col, formatted("turns").alias("f")).select(conv_col, "f.*")


def digests(chats: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """Numbers and digests read back from what ``format_chats`` returns."""

    @F.pandas_udf("n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
    def read(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, masks in batches:
            rows = []
            for text, mask in zip(texts, masks, strict=True):
                turns = parse(text)
                loss = "".join(unescape(text[m["start"] : m["end"]]) for m in mask)
                said = "".join(f"{role}\n{content}\n" for role, content in turns)
                rows.append((len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(text)))
            yield pd.DataFrame({k: objects([r[i] for r in rows]) for i, k in enumerate(("n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"))})

    return chats.select(conv_col, read("formatted", "loss").alias("r")).select(conv_col, "r.*")
