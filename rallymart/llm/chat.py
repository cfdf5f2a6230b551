"""Conversations as training text: rendered by a compiled template, with a mask, and read back.

Control strings that stand in a turn's own text are escaped, so that what the template writes is
the only thing that marks turns, and reading gives back the same roles and texts.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import groupby, islice
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .chat_template import Template
from .shared import small

#: What marks turns; in texts a backslash and a letter of its own stand for each.
CONTROLS = ("[INST]", "[/INST]", "<s>", "</s>", "[TURN]", "[/TURN]")

TEMPLATE = """
{%- for turn in turns -%}
  {%- if turn.role == 'user' -%}
    {{ '[INST] ' }}{{ turn.text | escape }}{{ ' [/INST]' }}
  {%- elif turn.role == 'assistant' -%}
    <s>{% generation %}{{ turn.text | escape }}{% endgeneration %}</s>
  {%- else -%}
    {{ '[TURN] ' }}{{ turn.role | escape_line }}{{ '\\n' }}{{ turn.text | escape }}{{ ' [/TURN]' }}
  {%- endif -%}
{%- endfor -%}
"""

#: One whole turn as the template writes it. No closing mark begins as it ends, and texts hold none,
#: so the first closing mark is the turn's own.
TURN = r"""
    \[INST\]\ (?P<user>.*?)\ \[/INST\]
  | <s>(?P<assistant>.*?)</s>
  | \[TURN\]\ (?P<role>[^\n]*)\n(?P<text>.*?)\ \[/TURN\]
"""

#: Characters of a piece of output, from which on it is given away.
PIECE = 2**18

FORMATTED = (
    "conv_id long, piece long, start long, text string, loss array<struct<start: long, end: long>>"
)
DIGESTS = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
    "formatted_chars long"
)


class Escapes:
    """A reversible spelling of texts in which none of the given strings is left.

    A backslash becomes two, string number k a backslash and the k-th letter. What is left between
    these holds none of the strings, and no string holds a backslash.
    """

    def __init__(self, strings: Iterable[str]) -> None:
        strings = list(strings)
        if len(strings) > 26 or any(not s or "\\" in s for s in strings):
            raise ValueError("at most 26 strings, none empty and none with a backslash")
        self._to = {s: "\\" + chr(ord("a") + k) for k, s in enumerate(strings)} | {"\\": "\\\\"}
        self._back = {v: k for k, v in self._to.items()}
        # Of strings that begin alike the longer one is meant.
        longest = sorted(self._to, key=len, reverse=True)
        self._seen = re.compile("|".join(map(re.escape, longest)))

    def escape(self, text: str | None) -> str:
        return self._seen.sub(lambda m: self._to[m[0]], text or "")

    def restore(self, text: str) -> str:
        return re.sub(r"\\.", lambda m: self._back[m[0]], text) if "\\" in text else text


@dataclass(frozen=True)
class Format:
    """A template, the control strings it uses, and the expression that reads one turn of it.

    The expression's groups are named for the role they hold the text of, or `role` and `text`.
    """

    template: str = TEMPLATE
    controls: tuple[str, ...] = CONTROLS
    turn: str = TURN

    def compiled(self) -> Template:
        filters = {"escape": self.texts().escape, "escape_line": self.lines().escape}
        return Template(self.template, filters)

    def texts(self) -> Escapes:
        return Escapes(self.controls)

    def lines(self) -> Escapes:
        return Escapes([*self.controls, "\n"])


Turn = tuple[int | None, str | None, str | None]  # conv_id, role, text


def render(turns: Iterable[Turn], fmt: Format, piece: int = PIECE) -> Iterator[tuple]:
    """Rows of `FORMATTED`: each conversation's output, cut between stretches of `piece` characters.

    The turns of a conversation must stand together. They are read one by one, and only one piece
    is held, however long the conversation is.
    """
    template = fmt.compiled()
    for conv_id, rows in groupby(turns, key=itemgetter(0)):
        named = ({"role": role or "", "text": text or ""} for _, role, text in rows)
        parts: list[str] = []
        loss: list[tuple[int, int]] = []
        number, start, at = 0, 0, 0
        for text, marked in template.render(turns=named):
            if marked:
                loss.append((at, at + len(text)))
            parts.append(text)
            at += len(text)
            if at - start >= piece:
                yield conv_id, number, start, "".join(parts), loss
                parts, loss, number, start = [], [], number + 1, at
        if parts or not number:
            yield conv_id, number, start, "".join(parts), loss


class _Reader:
    """Turns and masked text of one conversation, read from pieces of its output."""

    def __init__(self, fmt: Format) -> None:
        self.turn = re.compile(fmt.turn, re.S | re.X)
        self.texts, self.lines = fmt.texts().restore, fmt.lines().restore
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.chars = 0
        self.left, self.next = "", 0

    def read(self, text: str, start: int, loss: Iterable[tuple[int, int]]) -> None:
        for a, b in loss:
            wanted = self.texts(text[a - start : b - start])
            self.loss.update(wanted.encode())
            self.loss_chars += len(wanted)
        self.chars += len(text)
        whole, at = self.left + text, 0
        # A turn that a piece leaves open is tried again once as much has come.
        if len(whole) >= self.next:
            while found := self.turn.match(whole, at):
                role, said = self._of(found)
                self.turns.update(f"{role}\n{said}\n".encode())
                self.n_turns, at = self.n_turns + 1, found.end()
            self.next = 2 * (len(whole) - at)
        self.left = whole[at:]

    def _of(self, found: re.Match) -> tuple[str, str]:
        if found.lastgroup == "text":
            return self.lines(found["role"]), self.texts(found["text"])
        return found.lastgroup, self.texts(found[found.lastgroup])

    def row(self, conv_id: int | None) -> tuple:
        self.next = 0
        self.read("", 0, ())
        if self.left:
            raise ValueError(f"conversation {conv_id} can't be read back at {self.left[:40]!r}")
        digests = self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest()
        return conv_id, self.n_turns, *digests, self.chars


def read_back(pieces: Iterable[tuple], fmt: Format) -> Iterator[tuple]:
    """Rows of `DIGESTS` from rows of `FORMATTED`, a conversation's pieces in order."""
    for conv_id, rows in groupby(pieces, key=itemgetter(0)):
        reader = _Reader(fmt)
        for _, _, start, text, loss in rows:
            reader.read(text, start, loss)
        yield reader.row(conv_id)


def _turns(batches: Iterator[pa.RecordBatch]) -> Iterator[Turn]:
    for batch in batches:
        for part in small([batch]):
            columns = [part.column(c).to_pylist() for c in ("conv_id", "role", "text")]
            yield from zip(*columns, strict=True)


def _in_order(conversations: DataFrame) -> DataFrame:
    """The turns of each conversation side by side in one partition, sorted on disk if need be."""
    narrow = conversations.select(
        F.col("conv_id").cast("long"),
        F.col("turn").cast("long"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    return narrow.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


def _pass(conversations: DataFrame, make, schema: str, at_once: int) -> DataFrame:
    kinds = T._parse_datatype_string(schema)

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        shape = to_arrow_schema(kinds)
        rows = make(_turns(batches))
        while held := list(islice(rows, at_once)):
            columns = zip(*held, strict=True)
            arrays = [pa.array(c, type=f.type) for c, f in zip(map(_plain, columns), shape, strict=True)]
            yield pa.record_batch(arrays, schema=shape)

    return _in_order(conversations).mapInArrow(run, kinds)


def _plain(column: tuple) -> list:
    """Spans as mappings, which Arrow takes for structs."""
    if column and isinstance(column[0], list):
        return [[{"start": a, "end": b} for a, b in spans] for spans in column]
    return list(column)


def format_conversations(conversations: DataFrame, fmt: Format | None = None) -> DataFrame:
    """Training text: conv_id, piece, start, text, loss.

    A conversation's turns (conv_id, turn, role, text) are rendered in order of turn, equal turns by
    role and text. Its output is cut into pieces of some `PIECE` characters, of which most have one;
    `start` counts the characters before a piece, `loss` holds the masked spans from the
    conversation's start. A null turn comes first; null roles and texts are empty; repeated rows are
    turns of their own; rows without conv_id make one conversation without id. An empty table gives
    no rows; other columns are not read. A conversation streams through one task, its turns sorted by
    Spark with spilling, so its length is not bound by memory.
    """
    fmt = fmt or Format()
    return _pass(conversations, lambda turns: render(turns, fmt), FORMATTED, 16)


def formatted_digests(conversations: DataFrame, fmt: Format | None = None) -> DataFrame:
    """Rows of `DIGESTS`: what reading the output of `format_conversations` gives back.

    turns_sha256 is of role, newline, text, newline of each turn; loss_sha256 of all masked text,
    unescaped, nothing between. Both digests need the texts of a conversation in order. Odd input as
    in `format_conversations`.
    """
    fmt = fmt or Format()
    return _pass(conversations, lambda turns: read_back(render(turns, fmt), fmt), DIGESTS, 1024)
