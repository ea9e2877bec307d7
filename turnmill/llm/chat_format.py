"""Chat formatting with a grammar round trip.

A turn is rendered, parsed back by a deterministic parser and compared with its source.  Whatever comes
back changed is escaped and the turn is rendered again, until it comes back identical.  Rendering and
checking a turn needs no other turn, so no conversation has to be in one place for it; since every segment
parses by itself to exactly its turn, the joined segments parse to the turns in order.

    conversation = { turn }
    turn         = "<|im_start|>" role "\\n" text "<|im_end|>" "\\n"

Escapes, which the parser always undoes: in a text, a backslash after the "<" of a control string (one more
if there are some already); in a role, besides, a backslash before a backslash and ``\\n`` for a line break.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"

#: Roles whose texts are learned from.
LEARNED = "assistant"

CONTROL = re.compile(r"<(\\*)\|(im_start|im_end)\|>")
ESCAPED = re.compile(r"<\\(\\*)\|(im_start|im_end)\|>")
ROLE_ESCAPED = re.compile(r"\\([\\n])")


def escape_text(text: str) -> str:
    return CONTROL.sub(r"<\\\1|\2|>", text)


def unescape_text(text: str) -> str:
    return ESCAPED.sub(r"<\1|\2|>", text)


def escape_role(role: str) -> str:
    return escape_text(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return ROLE_ESCAPED.sub(lambda m: "\n" if m.group(1) == "n" else "\\", unescape_text(role))


@dataclass(frozen=True)
class Turn:
    role: str
    text: str
    start: int  # where the text, still escaped, begins and ends in what was fed
    end: int


class Malformed(ValueError):
    """The input doesn't follow the grammar."""


class Parser:
    """Deterministic incremental parser: text goes in piece by piece, whole turns come out.

    Only the unfinished turn is held.
    """

    def __init__(self):
        self.rest, self.at = "", 0

    def feed(self, piece: str) -> Iterator[Turn]:
        data, done = self.rest + piece, 0
        while True:
            close = data.find(END + "\n", done)
            if close < 0:
                break
            if not data.startswith(START, done):
                raise Malformed(f"no turn begins at {self.at + done}")
            line = data.find("\n", done)
            if line > close:
                raise Malformed(f"the turn at {self.at + done} has no line of its own for the role")
            role, text = data[done + len(START) : line], data[line + 1 : close]
            if any(c in part for c in (START, END) for part in (role, text)):
                raise Malformed(f"a control string inside the turn at {self.at + done}")
            yield Turn(unescape_role(role), unescape_text(text), self.at + line + 1, self.at + close)
            done = close + len(END) + 1
        self.rest, self.at = data[done:], self.at + done

    def finish(self) -> None:
        if self.rest:
            raise Malformed(f"an unfinished turn at {self.at}")


def parse(formatted: str) -> list[Turn]:
    parser = Parser()
    turns = list(parser.feed(formatted))
    parser.finish()
    return turns


def render(role: str, text: str) -> str:
    return f"{START}{role}\n{text}{END}\n"


def segment(role: str, text: str) -> tuple[str, int, int]:
    """A turn's rendering that parses back to it, and where its text is.

    Escapes the parts that come back changed, or both if the rendering doesn't parse at all.  An escaped part
    comes back as it was, so this ends after the first escape of each part.
    """
    own_role, own_text = role, text
    for _ in range(3):
        rendered = render(own_role, own_text)
        try:
            turns = parse(rendered)
        except Malformed:
            turns = []
        if len(turns) == 1 and (turns[0].role, turns[0].text) == (role, text):
            return rendered, turns[0].start, turns[0].end
        if len(turns) != 1 or turns[0].text != text:
            own_text = escape_text(text)
        if len(turns) != 1 or turns[0].role != role:
            own_role = escape_role(role)
    raise AssertionError("an escaped turn must parse to itself")


def format_turns(turns: DataFrame) -> DataFrame:
    """One row per row of (conv_id, turn, role, text): conv_id, turn, role, text, segment, text_start, text_end, learned.

    The conversation's text is its segments in the order of turn, role, text.  ``text_start`` and ``text_end``
    mark the text in the segment; it is under the loss mask where ``learned``.  NULL roles and texts are
    empty; NULL ids make one conversation; NULL turns come first; repeated rows are turns of their own; other
    columns are not read; an empty table gives no rows.  Narrow: no shuffle.
    """
    own = turns.select("conv_id", "turn", *(F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("role", "text")))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for roles, texts in batches:
            rows = [(*segment(role, text), role == LEARNED) for role, text in zip(roles, texts)]
            yield pd.DataFrame(rows, columns=["segment", "text_start", "text_end", "learned"])

    rendered = F.pandas_udf(run, "segment string, text_start long, text_end long, learned boolean").asNondeterministic()
    parts = ("segment", "text_start", "text_end", "learned")
    return own.select("*", rendered("role", "text").alias("as")).select(*own.columns, *(F.col(f"as.{c}").alias(c) for c in parts))


class _Digest:
    """What is read back of one conversation; holds hash states, never its text."""

    def __init__(self, conv_id):
        self.conv_id, self.parser = conv_id, Parser()
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.chars = self.n_learned = 0

    def feed(self, piece: str, learned: bool, start: int, end: int) -> None:
        for turn in self.parser.feed(piece):
            self.turns.update(f"{turn.role}\n{turn.text}\n".encode())
            self.n_turns += 1
        if learned:  # the mask, applied to the output and not to the source
            masked = unescape_text(piece[start:end])
            self.loss.update(masked.encode())
            self.loss_chars += len(masked)
            self.n_learned += 1
        self.chars += len(piece)

    def row(self) -> tuple:
        self.parser.finish()
        digests = (self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars)
        return (self.conv_id, self.n_turns, *digests, self.n_learned)


COLUMNS = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_learned"]


def read_back(segments: DataFrame) -> DataFrame:
    """One row per conversation, computed from the formatted output alone: parsed turns and masked text as digests.

    A digest runs over a whole conversation in order, so its segments pass through one task; they stream
    through it, sorted by the shuffle, and only hash states and one unfinished turn are held.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = None
        for batch in batches:
            done = []
            for conv_id, piece, learned, start, end in batch.itertuples(index=False, name=None):
                if own is None or own.conv_id != conv_id:
                    if own is not None:
                        done.append(own.row())
                    own = _Digest(conv_id)
                own.feed(piece, learned, start, end)
            yield pd.DataFrame(done, columns=COLUMNS)
        if own is not None:
            yield pd.DataFrame([own.row()], columns=COLUMNS)

    ordered = segments.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    # As text, since pandas would turn whole numbers beside NULLs into fractions.
    name = F.col("conv_id").cast("string").alias("conv_id")
    schema = "conv_id string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_learned long"
    read = ordered.select(name, "segment", "learned", "text_start", "text_end").mapInPandas(run, schema)
    return read.withColumn("conv_id", F.col("conv_id").cast(segments.schema["conv_id"].dataType))
