"""Conversations rendered by a compiled template, and read back from the output."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import groupby

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfpulse.llm.common import ship
from shelfpulse.llm.template import FILTERS, Template

TURN, END = "<|turn|>", "<|end|>\n"


def escape(text) -> str:
    """Text in which no control string can arise; ``unescape`` is the way back."""
    return (text or "").replace("\\", "\\\\").replace("<|", "<\\|")


def escape_line(text) -> str:
    """The same on a single line."""
    return escape(text).replace("\n", "\\n")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], text, flags=re.S)


CHAT_FILTERS = {**FILTERS, "escape": escape, "escape_line": escape_line}

CHAT = (
    "{% for message in messages %}"
    "<|turn|>{{ message.role | escape_line }}\n"
    "{% if message.role == 'assistant' %}"
    "{% generation %}{{ message.text | escape }}{% endgeneration %}"
    "{% else %}{{ message.text | escape }}{% endif %}"
    "<|end|>\n"
    "{% endfor %}"
)


class Reader:
    """Reads a rendering of ``CHAT`` back as it comes, holding one turn at a time."""

    def __init__(self) -> None:
        self.turns = self.loss_chars = self.chars = 0
        self.turn_hash, self.loss_hash = hashlib.sha256(), hashlib.sha256()
        self.held: list[str] = []
        self.marked: list[str] = []

    def take(self, text: str, marked: bool) -> None:
        self.chars += len(text)
        if marked:
            self.marked.append(text)
        elif self.marked:
            self._close_span()
        self.held.append(text)
        if END in text:
            self._close_turns()

    def _close_span(self) -> None:
        loss = unescape("".join(self.marked))
        self.marked = []
        self.loss_chars += len(loss)
        self.loss_hash.update(loss.encode())

    def _close_turns(self) -> None:
        *done, rest = "".join(self.held).split(END)
        for turn in done:
            if not turn.startswith(TURN):
                raise ValueError(f"no turn: {turn[:40]!r}")
            role, _, text = turn[len(TURN) :].partition("\n")
            self.turns += 1
            self.turn_hash.update(f"{unescape(role)}\n{unescape(text)}\n".encode())
        self.held = [rest]

    def finish(self) -> tuple[int, str, int, str, int]:
        if self.marked:
            self._close_span()
        if any(self.held):
            raise ValueError("the output ends within a turn")
        return (
            self.turns,
            self.turn_hash.hexdigest(),
            self.loss_chars,
            self.loss_hash.hexdigest(),
            self.chars,
        )


def _ordered(conversations: DataFrame) -> DataFrame:
    """Rows of a conversation together and in order, in a partition that Spark may spill.

    Turns that are equal or null go by role, then by text; null roles and texts are empty.
    """
    rows = conversations.select(
        F.col("conv_id").cast("string").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


def _streams(frames: Iterator[pd.DataFrame]) -> Iterator[tuple]:
    """Each conversation's id and an iterator over its messages."""
    rows = (
        row
        for frame in frames
        for row in zip(
            [None if pd.isna(x) else int(x) for x in frame["conv_id"]],
            frame["role"].tolist(),
            frame["text"].tolist(),
            strict=True,
        )
    )
    for conv_id, own in groupby(rows, key=lambda row: row[0]):
        yield conv_id, ({"role": role, "text": text} for _, role, text in own)


def format_conversations(conversations: DataFrame, template: str = CHAT) -> DataFrame:
    """conv_id, text and loss_spans (start and end in code points) for each conversation.

    The template sees ``messages`` with role and text. Rows without conv_id are one
    conversation. Repeated rows are repeated turns. An empty table gives no row; other
    columns are not read. The text of a conversation is one value, so it must fit in a task;
    ``conversation_digests`` has no such bound.
    """
    ship(conversations.sparkSession)

    def rendered(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        compiled = Template(template, CHAT_FILTERS)
        for conv_id, messages in _streams(frames):
            text, spans = compiled.render({"messages": list(messages)})
            spans = [{"start": a, "end": b} for a, b in spans]
            yield pd.DataFrame(
                {"conv_id": pd.array([conv_id], "Int64"), "text": [text], "loss_spans": [spans]}
            )

    return _ordered(conversations).mapInPandas(
        rendered, "conv_id long, text string, loss_spans array<struct<start: long, end: long>>"
    )


DIGESTS = "n_turns turns_sha256 loss_chars loss_sha256 formatted_chars".split()


def conversation_digests(conversations: DataFrame) -> DataFrame:
    """What reading the output of ``CHAT`` back gives, a row for each conversation.

    n_turns, turns_sha256, loss_chars, loss_sha256 and formatted_chars. Rendering and
    reading go turn by turn, so a task holds one turn however long the conversation; the
    digest of a conversation follows its order, so one task makes it. Nulls, ties and
    repeated rows are as in ``format_conversations``.
    """
    ship(conversations.sparkSession)

    def digested(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        compiled = Template(CHAT, CHAT_FILTERS)
        held: list[tuple] = []
        for conv_id, messages in _streams(frames):
            reader = Reader()
            compiled.stream({"messages": messages}, reader.take)
            held.append((conv_id, *reader.finish()))
            if len(held) == 4096:
                yield _frame(held)
                held = []
        if held:
            yield _frame(held)

    return _ordered(conversations).mapInPandas(
        digested,
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
        "loss_sha256 string, formatted_chars long",
    )


def _frame(rows: list[tuple]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=["conv_id", *DIGESTS])
    out["conv_id"] = pd.array([row[0] for row in rows], "Int64")
    return out
