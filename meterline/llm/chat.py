"""Chat formatting by incremental black-box rendering.

A template is any function from a list of turns to a string. Successive prefixes of a conversation are rendered and
consecutive outputs compared: what the longer one adds is the turn's span; an output that doesn't begin with the one
before shows a template that rewrites history, which is refused. Inside a span the text is located by rendering the
prefix once more with a probe in its last turn's place. Every prefix is rendered whole, however long the conversation:
nothing is known of a template, so no shorter history can stand for the whole one. The work grows with the square of a
conversation's turns, never with the number of conversations.

Turns are sorted within Spark's partitions and stream through; a task holds the turns of one conversation, as a whole
prefix needs them. Control strings inside roles and texts are escaped reversibly, so reading the output back gives the
turns that went in.

Defined results: null roles and texts count as empty; turns sort by turn number (nulls first), then role and text;
repeated rows are turns of their own; rows with a null conversation id form one conversation; an empty table gives no
rows. Extra columns are neither read nor required.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Turn = tuple[str, str]
Template = Callable[[list[Turn]], str]

START, END = "<|im_start|>", "<|im_end|>"
_PROBE = "probe"
#: Rows of one output batch.
_ROWS = 4096


def escape(text: str) -> str:
    """No control string is left: each begins with '<|'. ``unescape`` is its exact inverse."""
    return text.replace("&", "&amp;").replace("<|", "&lt;|")


def unescape(text: str) -> str:
    return text.replace("&lt;|", "<|").replace("&amp;", "&")


def chat_template(turns: list[Turn]) -> str:
    """Marks every turn; a role is kept to one line."""
    return "".join(f"{START}{escape(role).replace(chr(10), '&#10;')}\n{escape(text)}{END}\n" for role, text in turns)


class RewritesHistory(ValueError):
    """The template changes what it rendered for earlier turns, so turns have no fixed span."""


def _added(before: str, after: str, number: int) -> str:
    if not after.startswith(before):
        same = next((k for k, (x, y) in enumerate(zip(before, after)) if x != y), min(len(before), len(after)))
        raise RewritesHistory(f"turn {number} changes the output from character {same} on")
    return after[len(before):]


class IncrementalRenderer:
    """Gives the span of each further turn of one conversation and the place of its text in it. ``take`` gives the spans
    since the last call."""

    def __init__(self, template: Template):
        self.template, self.turns = template, []
        self.opening = self.whole = template([])
        self.settled = []

    def add(self, turn: Turn) -> tuple[str, int, int]:
        """(span, start, end) of the turn's text inside the span."""
        number, history = len(self.turns), list(self.turns)
        self.turns.append(turn)
        now = self.template([*history, turn])
        span, start, end = self._placed(_added(self.whole, now, number), self.whole, history, turn, number)
        self.whole = now
        shift = 0 if number else len(self.opening)
        self.settled.append(((self.opening if not number else "") + span, start + shift, end + shift))
        return self.settled[-1]

    def settle(self) -> None:
        """Nothing is left open: every span has been compared with its whole prefix."""

    def take(self) -> list[tuple[str, int, int]]:
        out, self.settled = self.settled, []
        return out

    def _placed(self, span: str, base: str, history: list[Turn], turn: Turn, number: int) -> tuple[str, int, int]:
        probe = _added(base, self.template([*history, (turn[0], _PROBE)]), number)
        start, tail = probe.find(_PROBE), len(probe) - probe.find(_PROBE) - len(_PROBE)
        end = len(span) - tail
        if start < 0 or end < start or span[:start] != probe[:start] or span[end:] != probe[len(probe) - tail:]:
            raise RewritesHistory(f"turn {number}: the template's marks depend on the text")
        return span, start, end


SPANS = "conv_id bigint, seq bigint, role string, span string, text_start int, text_end int"


def format_turns(conversations: DataFrame, template: Template = chat_template, conv_col: str = "conv_id", turn_col: str = "turn",
                 role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per turn in SPANS' columns, sorted within partitions; the spans of a conversation joined by ``seq`` are
    its formatted text, and the text of a turn lies at text_start to text_end of its span, escaped."""
    turns = conversations.select(F.col(conv_col).cast("bigint").alias("conv_id"), F.col(turn_col).alias("turn"),
                                 F.coalesce(role_col, F.lit("")).alias("role"), F.coalesce(text_col, F.lit("")).alias("text"))
    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, renderer, given = object(), None, 0

        def settled() -> list[tuple]:
            nonlocal given
            rows = [(current, seq, renderer.turns[seq][0], *found) for seq, found in enumerate(renderer.take(), given)]
            given += len(rows)
            return rows

        def out(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
            for k in range(0, len(rows), _ROWS):
                yield _arrow(rows[k:k + _ROWS], (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int32(), pa.int32()), SPANS)

        for batch in batches:
            rows = []
            for conv, role, text in zip(batch["conv_id"].to_pylist(), batch["role"].to_pylist(), batch["text"].to_pylist(), strict=True):
                if renderer is None or conv != current:
                    if renderer is not None:
                        renderer.settle()
                        rows += settled()
                    current, renderer, given = conv, IncrementalRenderer(template), 0
                renderer.add((role, text))
                rows += settled()
            yield from out(rows)
        if renderer is not None:
            renderer.settle()
            yield from out(settled())

    return ordered.mapInArrow(spans, SPANS)


def _arrow(rows: list[tuple], kinds: tuple, schema: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names=[x.split()[0] for x in schema.split(", ")])


_TURN = re.compile(re.escape(START) + r"([^\n]*)\n(.*?)" + re.escape(END) + "\n", re.S)


class Reader:
    """Reads formatted text back, piece by piece, and keeps digests only."""

    def __init__(self):
        self.rest, self.turns, self.chars, self.loss_chars = "", 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def feed(self, piece: str, loss: str | None) -> None:
        """``loss``: the part of the piece under the loss mask."""
        self.chars += len(piece)
        self.rest += piece
        at = 0
        while found := _TURN.match(self.rest, at):
            role, text = unescape(found[1].replace("&#10;", "\n")), unescape(found[2])
            self.all.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
            self.turns, at = self.turns + 1, found.end()
        self.rest = self.rest[at:]
        if loss is not None:
            plain = unescape(loss)
            self.loss_chars += len(plain)
            self.loss.update(plain.encode("utf-8", "surrogatepass"))

    def row(self, conv) -> tuple:
        if self.rest:
            raise ValueError(f"conversation {conv}: the formatted text doesn't end with a whole turn")
        return conv, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


DIGEST = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"


def read_back(spans: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """One row per conversation in DIGEST's columns, from the output of ``format_turns`` as it lies."""
    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
        current, reader = object(), None
        for batch in batches:
            rows = []
            for conv, seq, role, span, start, end in zip(*(batch[c].to_pylist() for c in range(6)), strict=True):
                if seq == 0:
                    if reader is not None:
                        rows.append(reader.row(current))
                    current, reader = conv, Reader()
                reader.feed(span, span[start:end] if role == loss_role else None)
            yield _arrow(rows, kinds, DIGEST)
        if reader is not None:
            yield _arrow([reader.row(current)], kinds, DIGEST)
    return spans.mapInArrow(digests, DIGEST)
