"""Chat formatting of typed content parts.

A visitor flattens a turn's text, image, audio and document parts into one string in which every
attachment is an ordered placeholder, and records its reference and the tokens it expands to. The
template marks turns with control strings; those of this and of other common templates are escaped
inside texts, reversibly.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TURN, CONTENT, END = "<|turn|>", "<|content|>", "<|end|>"
# Control strings that may not stand in a formatted text unescaped ("<|" opens all of this template's).
CONTROL = ["<|", "</s>", "<s>", "[INST]", "[/INST]"]
_ESCAPE = re.compile("|".join(map(re.escape, ["\\", *CONTROL])))
_PARSED = re.compile(re.escape(TURN) + "(.*?)" + re.escape(CONTENT) + "(.*?)" + re.escape(END), re.DOTALL)
_PLACEHOLDER = re.compile(r"<\|(\w+):(\d+)\|>")
LEARNED_ROLE = "assistant"

PARTS = ("array<struct<type:string,text:string,uri:string,width:int,height:int,seconds:double,pages:int>>")
ATTACHMENT = pa.struct([("place", pa.int32()), ("kind", pa.string()), ("uri", pa.string()), ("tokens", pa.int64())])


def escape(text: str) -> str:
    """A backslash is doubled; one goes behind the first character of every control string."""
    return _ESCAPE.sub(lambda m: "\\\\" if m[0] == "\\" else f"{m[0][0]}\\{m[0][1:]}", text)


def unescape(text: str) -> str:
    return re.sub(r"\\(\\?)", r"\1", text)


@dataclass
class Expansion:
    """How many tokens the model spends on an attachment."""

    patch: int = 14
    side: int = 336            # of an image whose size is unknown
    tokens_per_second: float = 25.0
    tokens_per_page: int = 256


@dataclass
class Flattener:
    """Visits the parts of one turn in order. ``spans`` are the places of text, not of placeholders."""

    expansion: Expansion
    pieces: list[str] = field(default_factory=list)
    spans: list[int] = field(default_factory=list)
    attachments: list[dict] = field(default_factory=list)
    length: int = 0

    def visit(self, part: dict | None) -> None:
        kind = (part or {}).get("type") or "text"
        getattr(self, f"visit_{kind}", self.visit_other)(part or {}, kind)

    def visit_text(self, part: dict, kind: str) -> None:
        text = escape(part.get("text") or "")
        if text and self.spans and self.spans[-1] == self.length:
            self.spans[-1] += len(text)
        elif text:
            self.spans += [self.length, self.length + len(text)]
        self._add(text)

    def visit_image(self, part: dict, kind: str) -> None:
        e = self.expansion
        across, down = (max(1, math.ceil((part.get(k) or e.side) / e.patch)) for k in ("width", "height"))
        self._attach(kind, part, across * down)

    def visit_audio(self, part: dict, kind: str) -> None:
        self._attach(kind, part, math.ceil(max(0.0, part.get("seconds") or 0.0) * self.expansion.tokens_per_second))

    def visit_document(self, part: dict, kind: str) -> None:
        self._attach(kind, part, max(0, part.get("pages") or 0) * self.expansion.tokens_per_page)

    def visit_other(self, part: dict, kind: str) -> None:
        """Parts of an unknown type keep their place and reference; they expand to nothing."""
        self._attach("other", part, 0)

    def _attach(self, kind: str, part: dict, tokens: int) -> None:
        self.attachments.append({"place": len(self.attachments), "kind": kind, "uri": part.get("uri"), "tokens": tokens})
        self._add(f"<|{kind}:{len(self.attachments) - 1}|>")

    def _add(self, piece: str) -> None:
        self.pieces.append(piece)
        self.length += len(piece)


def _format(parts_col: str | None, expansion: Expansion):
    names = ["conv_id", "turn", "segment", "loss_spans", "attachments", "expanded_tokens"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            segments, spans, attachments, tokens = [], [], [], []
            content = b.column("content").to_pylist()
            for role, parts in zip(b.column("role").to_pylist(), content):
                f = Flattener(expansion)
                for part in (parts or []) if parts_col else [{"text": parts}]:
                    f.visit(part)
                head = f"{TURN}{escape(role or '')}{CONTENT}"
                segments.append(f"{head}{''.join(f.pieces)}{END}")
                spans.append([len(head) + x for x in f.spans] if role == LEARNED_ROLE else [])
                attachments.append(f.attachments)
                tokens.append(sum(a["tokens"] for a in f.attachments))
            yield pa.RecordBatch.from_arrays(
                [b.column("conv_id"), b.column("turn"), pa.array(segments, pa.string()), pa.array(spans, pa.list_(pa.int32())),
                 pa.array(attachments, pa.list_(ATTACHMENT)), pa.array(tokens, pa.int64())], names=names)

    return run


def format_turns(turns: DataFrame, parts_col: str | None = None, expansion: Expansion | None = None) -> DataFrame:
    """One formatted segment per row of ``turns`` (conv_id, turn, role, text or a ``parts_col`` of type PARTS).

    A conversation's formatted text is its segments in order of turn. ``loss_spans`` are flat first and
    last-plus-one code points of the segment that an assistant's texts occupy, placeholders left out;
    ``attachments`` hold place, kind, uri and expanded tokens. Null role, text, part and part type count
    as empty, empty, an empty text part and text. Rows are independent: repeated rows, ties, long texts
    and other columns (which are dropped) need no care; an empty frame gives an empty frame.
    """
    content = F.col(f"`{parts_col}`") if parts_col else F.col("text")
    return turns.select("conv_id", "turn", "role", content.alias("content")).mapInArrow(
        _format(parts_col, expansion or Expansion()),
        "conv_id long, turn long, segment string, loss_spans array<int>, "
        "attachments array<struct<place:int,kind:string,uri:string,tokens:long>>, expanded_tokens long")


def read_back(segment: str) -> tuple[str, str]:
    """Role and content text of a formatted turn; placeholders are left out of the text."""
    role, content = _PARSED.fullmatch(segment).groups()
    return unescape(role), unescape(_PLACEHOLDER.sub("", content))


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted segments to one row per conversation, in one pass that holds a single conversation's running digests."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "expanded_tokens"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
    current, state, done = object(), None, []

    def close():
        if state:
            done.append((current, state["n"], state["turns"].hexdigest(), state["loss_n"], state["loss"].hexdigest(), state["chars"], state["tokens"]))

    def batch():
        out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), types)], names=names)
        done.clear()
        return out

    for b in batches:
        for conv, segment, spans, tokens in zip(*(b.column(c).to_pylist() for c in ("conv_id", "segment", "loss_spans", "expanded_tokens"))):
            if state is None or conv != current:
                close()
                current = conv
                state = {"n": 0, "turns": hashlib.sha256(), "loss": hashlib.sha256(), "loss_n": 0, "chars": 0, "tokens": 0}
            role, text = read_back(segment)
            loss = "".join(unescape(segment[i:j]) for i, j in zip(spans[::2], spans[1::2]))
            state["n"] += 1
            state["turns"].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
            state["loss"].update(loss.encode("utf-8", "surrogatepass"))
            state["loss_n"] += len(loss)
            state["chars"] += len(segment)
            state["tokens"] += tokens
        if done:
            yield batch()
    close()
    if done:
        yield batch()


def conversation_digests(segments: DataFrame) -> DataFrame:
    """Per conv_id, read back from its segments in order: number of turns, digest of role and text lines, code
    points and digest of the text under the loss mask, code points of the formatted conversation.

    Segments of equal turn are ordered by their text, null turns come first, and a null conv_id is one
    conversation. A conversation is streamed, never gathered, so its length does not matter.
    """
    return (segments.select("conv_id", "turn", "segment", "loss_spans", "expanded_tokens").repartition("conv_id")
            .sortWithinPartitions("conv_id", "turn", "segment")
            .mapInArrow(_digest, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
                                 "formatted_chars long, expanded_tokens long"))
