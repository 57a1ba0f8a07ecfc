"""Chat formatting: a finite-state machine over roles and a declarative template.

``segments`` turns conversations into rows of formatted text, three per turn
(opening, text, closing), each with its loss flag. A task reads its conversations
in order and holds one turn at a time, so a conversation of any length fits.
``read_back`` parses the formatted text of the segments again.

A marker inside a text gets one backslash more after its ``<``, and one less when
read back: no text can forge a turn and every text returns as it was.

Defined results: a NULL text or role counts as empty; rows of a NULL conversation
are one conversation; equal turn numbers are ordered by role, then text; a turn
that the state machine does not allow is formatted all the same and flagged
``valid = false``; an empty table gives no rows; other columns are dropped.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
_MARKER = re.compile(r"<(\\*)\|im_(start|end)\|>")
_ESCAPED = re.compile(r"<\\(\\*)\|im_(start|end)\|>")


@dataclass(frozen=True)
class Template:
    """Text around a turn, the roles that learn, and the allowed successors of each role."""

    opening: str = START + "{role}\n"
    closing: str = END + "\n"
    learned: frozenset[str] = frozenset({"assistant"})
    follows: dict[str, frozenset[str]] = field(
        default_factory=lambda: {
            "": frozenset({"system", "user"}),
            "system": frozenset({"user"}),
            "user": frozenset({"assistant"}),
            "assistant": frozenset({"user"}),
        }
    )


CHATML = Template()


def escape(text: str) -> str:
    return _MARKER.sub(lambda m: f"<\\{m[1]}|im_{m[2]}|>", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: f"<{m[1]}|im_{m[2]}|>", text)


def _escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def _unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


SEGMENTS = "conv_id long, turn_no long, part int, text string, loss boolean, valid boolean"


def segments(conversations: DataFrame, template: Template = CHATML) -> DataFrame:
    """Rows of formatted text in order; ``turn_no`` counts the turns of a conversation from 0."""
    rows = conversations.select(
        F.col("conv_id").cast("long"),
        F.col("turn").cast("long"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        conv, state, valid, turn_no = object(), "", True, 0
        for frame in frames:
            out = []
            for conv_id, role, text in zip(frame["conv_id"], frame["role"], frame["text"], strict=True):
                key = None if pd.isna(conv_id) else int(conv_id)
                if key != conv:
                    conv, state, turn_no = key, "", 0
                valid = role in template.follows.get(state, ())
                opening = template.opening.format(role=_escape_role(role))
                parts = ((opening, False), (escape(text), role in template.learned), (template.closing, False))
                out += [(key, turn_no, i, t, loss, valid) for i, (t, loss) in enumerate(parts)]
                state, turn_no = role, turn_no + 1
            made = pd.DataFrame(out, columns=["conv_id", "turn_no", "part", "text", "loss", "valid"])
            made["conv_id"] = made["conv_id"].astype("Int64")
            yield made

    return ordered.mapInPandas(run, SEGMENTS)


class _Reader:
    """Parses one conversation's formatted text as its segments arrive."""

    def __init__(self):
        self.turns, self.chars, self.loss_chars, self.valid = 0, 0, 0, True
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()
        self._buffer = ""

    def add(self, text: str, loss: bool, valid: bool) -> None:
        self.chars += len(text)
        self.valid &= valid
        if loss:
            plain = unescape(text)
            self.loss_chars += len(plain)
            self.loss.update(plain.encode())
        self._buffer += text
        closing = END + "\n"
        while (end := self._buffer.find(closing)) >= 0:
            turn, self._buffer = self._buffer[:end], self._buffer[end + len(closing) :]
            if not turn.startswith(START):
                raise ValueError("a turn does not begin with its marker")
            role, _, body = turn[len(START) :].partition("\n")
            self.turns += 1
            self.all.update(f"{_unescape_role(role)}\n{unescape(body)}\n".encode())

    def row(self):
        if self._buffer:
            raise ValueError("text after the last turn")
        return self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars, self.valid


READ = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, valid boolean"


def read_back(formatted: DataFrame) -> DataFrame:
    """Per conversation what its formatted text says: turns, text under the loss mask, validity.

    Expects the order and partitioning of ``segments``.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        conv, reader = object(), None
        names = [c.split()[0] for c in READ.split(", ")]
        for frame in frames:
            done = []
            for conv_id, text, loss, valid in zip(
                frame["conv_id"], frame["text"], frame["loss"], frame["valid"], strict=True
            ):
                key = None if pd.isna(conv_id) else int(conv_id)
                if key != conv:
                    if reader is not None:
                        done.append((conv, *reader.row()))
                    conv, reader = key, _Reader()
                reader.add(text, loss, valid)
            if done:
                yield pd.DataFrame(done, columns=names).astype({"conv_id": "Int64"})
        if reader is not None:
            yield pd.DataFrame([(conv, *reader.row())], columns=names).astype({"conv_id": "Int64"})

    return formatted.mapInPandas(run, READ)
