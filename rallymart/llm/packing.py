"""Packing documents into sequences by bin completion, a branch and bound over the longest piece.

Lengths are whole numbers up to the capacity, so a corpus of any size is a histogram of at most
`capacity` counts. The plan is made on that histogram: a pattern (lengths in one sequence) and how
often it is used. Pieces then find their place by their number among the pieces of their length.
"""

from __future__ import annotations

import os
import string
import sys
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations
from types import ModuleType

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import arrow_pass, numbered, sent, stage, texts

CAPACITY = 2048
SEPARATOR = b"\0\0\0\0"
#: Steps of the search, after which the best plan so far counts: one for each partial filling, and
#: for a branch and for a best-fit plan of what it leaves as many as take the same time.
SEARCH_STEPS = 250_000
BRANCH_STEPS, FIT_STEPS = 20, 15_000
#: Bytes of text chunks and ids a task remembers.
MOST_REMEMBERED = 96 * 2**20

#: How often, and the lengths of one sequence from long to short.
Plan = list[tuple[int, tuple[int, ...]]]


def lower_bound(counts: np.ndarray) -> int:
    """Sequences that any plan needs (the bound L2 of Martello and Toth); counts by length."""
    capacity = len(counts) - 1
    lengths = np.arange(capacity + 1)
    number, total = np.cumsum(counts), np.cumsum(counts * lengths)
    half = capacity // 2
    best = -(-int(total[-1]) // capacity)
    small = np.arange(1, half + 1)
    over = capacity - small
    n1 = number[-1] - number[over]
    n2 = number[over] - number[half]
    room = n2 * capacity - (total[over] - total[half])
    rest = total[half] - total[small - 1] - room
    return int(max([best, *(n1 + n2 + np.maximum(0, -(-rest // capacity)))]))


def best_fit(counts: np.ndarray) -> Plan:
    """Best-fit decreasing on a histogram: equal sequences are kept as one group."""
    capacity = len(counts) - 1
    open_: dict[int, list[tuple[int, tuple[int, ...]]]] = {capacity: []}

    def put(room: int, group: tuple[int, tuple[int, ...]]) -> None:
        if group[0]:
            open_.setdefault(room, []).append(group)

    for length in range(capacity, 0, -1):
        left = int(counts[length])
        while left:
            rooms = [r for r in open_ if r >= length and open_[r]]
            if rooms:
                room = min(rooms)
                n, held = open_[room].pop()
            else:
                room, n, held = capacity, left, ()
            each = room // length
            full = min(n, left // each)
            left -= full * each
            put(room - each * length, (full, held + (length,) * each))
            if full < n and left:
                put(room - left * length, (1, held + (length,) * left))
                full, left = full + 1, 0
            if held:
                put(room, (n - full, held))
    return [group for groups in open_.values() for group in groups]


def _dominated(filling: tuple[int, ...], slack: int, left: np.ndarray) -> bool:
    """Whether a longer piece could stand for one, two or three of the filling's.

    That is the dominance of Martello and Toth for such parts, looked for among the filling's
    longest ones; a dominated filling that is not noticed only costs time.
    """
    parts, free = filling[:6], left > 0
    for piece in set(filling):
        free[piece] = left[piece] > filling.count(piece)
    for size in (1, 2, 3):
        for part in dict.fromkeys(combinations(parts, size)):
            have = sum(part)
            if free[have + (size == 1) : have + slack + 1].any():
                return True
    return False


@dataclass
class _Search:
    """Bin completion: the longest piece left, all its undominated fillings, and so on."""

    counts: np.ndarray
    steps: int

    def fillings(self, left: np.ndarray, room: int, waste: int) -> Iterator[tuple[int, ...]]:
        """Undominated fillings of `room` that waste at most `waste`, long pieces first."""
        stack: list[tuple[tuple[int, ...], int, int]] = [((), room, room)]
        while stack and self.steps > 0:
            held, space, most = stack.pop()
            self.steps -= 1
            fits = np.flatnonzero(left[: min(space, most) + 1])
            fits = [int(y) for y in fits if left[y] > held.count(y)] if held else fits.tolist()
            if not fits:
                if space <= waste and not _dominated(held, space, left):
                    yield held
                continue
            # Short pieces first on the stack: the longest is tried next.
            stack.extend((held + (y,), space - y, y) for y in fits[-16:])
            if len(fits) > 16:
                stack.insert(0, (held, space, fits[-17]))

    def run(self, best: Plan) -> Plan:
        capacity = len(self.counts) - 1
        total = int((self.counts * np.arange(capacity + 1)).sum())
        bound, used = lower_bound(self.counts), sum(n for n, _ in best)
        chosen: Plan = []
        left = self.counts.copy()
        waste = bins = 0

        def options() -> Iterator[tuple[int, tuple[int, ...]]]:
            longest = int(np.flatnonzero(left)[-1])
            left[longest] -= 1
            allowed = (used - 1) * capacity - total - waste
            here = left.copy()
            left[longest] += 1
            for filling in self.fillings(here, capacity - longest, allowed):
                pattern = (longest, *filling)
                slack = capacity - sum(pattern)
                times = min(int(left[y]) // pattern.count(y) for y in set(pattern))
                if slack:
                    times = min(times, max(1, allowed // slack))
                yield from ((n, pattern) for n in dict.fromkeys((times, 1)))

        levels = [options()] if left.any() else []
        fitted = self.steps
        while levels and used > bound and self.steps > 0:
            step = next(levels[-1], None)
            if step is None:
                levels.pop()
                if chosen:
                    n, pattern = chosen.pop()
                    for y in pattern:
                        left[y] += n
                    waste -= n * (capacity - sum(pattern))
                    bins -= n
                continue
            n, pattern = step
            slack = n * (capacity - sum(pattern))
            if waste + slack > (used - 1) * capacity - total:
                continue
            for y in pattern:
                left[y] -= n
            chosen.append(step)
            waste += slack
            bins += n
            self.steps -= BRANCH_STEPS
            if not left.any():
                best, used = list(chosen), bins
            elif bins + lower_bound(left) < used:
                if fitted - self.steps > 2 * FIT_STEPS:
                    rest = best_fit(left)
                    self.steps -= FIT_STEPS
                    fitted = self.steps
                    if bins + sum(n for n, _ in rest) < used:
                        best = [*chosen, *rest]
                        used = sum(n for n, _ in best)
                levels.append(options())
                continue
            n, pattern = chosen.pop()
            for y in pattern:
                left[y] += n
            waste -= slack
            bins -= n
        return best


def plan(counts: np.ndarray, steps: int = SEARCH_STEPS) -> Plan:
    """Patterns for all pieces; `counts[n]` is the number of pieces of length n.

    Best fit gives the first incumbent; the search ends when the lower bound is reached, when all
    branches are done (then the plan is optimal) or after `steps` steps.
    """
    counts = np.asarray(counts, "int64")
    best = best_fit(counts)
    if sum(n for n, _ in best) > lower_bound(counts):
        best = _Search(counts, steps).run(best)
    return best


@dataclass
class Places:
    """For pieces numbered within their length: the sequence and the offset."""

    start: np.ndarray  # length * 2**44 + first number of the run, ascending
    each: np.ndarray  # pieces of that length in one sequence
    sequence: np.ndarray  # of the run's first piece
    offset: np.ndarray

    @staticmethod
    def of(best: Plan) -> Places:
        rows, given, first = [], {}, 0
        for times, pattern in best:
            offset = 0
            for length in dict.fromkeys(pattern):
                each = pattern.count(length)
                rows.append((length << 44 | given.get(length, 0), each, first, offset))
                given[length] = given.get(length, 0) + times * each
                offset += each * length
            first += times
        rows.sort()
        return Places(*np.array(rows or [(0, 1, 0, 0)], "int64").T)

    def find(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = length.astype("int64") << 44 | number
        run = np.searchsorted(self.start, key, side="right") - 1
        place = key - self.start[run]
        sequence = self.sequence[run] + place // self.each[run]
        return sequence, self.offset[run] + place % self.each[run] * length


def _byte_letters() -> list[str]:
    """The letter for each byte in vocabularies of byte-level models, by their public rule."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = (chr(n) for n in range(256, 512))
    return [chr(b) if b in shown else next(hidden) for b in range(256)]


_MARKS = string.punctuation.encode()


class WordIds(dict):
    """Ids of text chunks as little-endian bytes; a chunk that is missing is encoded and kept.

    The tokenizer drops white space and no token crosses it, so a text's ids are its chunks' ids
    in order. Chunks are cut at ASCII white space only; other white space stays inside a chunk.
    A chunk of plain letters goes to the model directly, marks after them count by themselves;
    every other chunk takes the whole tokenizer.
    """

    def __init__(self, vocabulary: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        self.raw = [n.to_bytes(4, "little") for n in range(self.tokenizer.get_vocab_size())]
        self.size = 0

    def _encode(self, chunk: bytes) -> bytes:
        word = chunk.rstrip(_MARKS)
        ascii_ = word.isalpha()
        if not ascii_:
            text = word.decode()
            if not text.isalpha() or max(text) > "\u00ff":
                ids = self.tokenizer.encode(chunk.decode(), add_special_tokens=False).ids
                return b"".join([self.raw[n] for n in ids])
        if len(word) < len(chunk):
            # ASCII and Latin-1 letters are one run for the tokenizer, the marks after them another.
            return self[word] + self[chunk[len(word) :]]
        low = word.lower() if ascii_ else text.lower().encode()
        if low != word:
            return self[low]
        shown = low.decode() if ascii_ else "".join([self.letters[b] for b in low])
        return b"".join([self.raw[t.id] for t in self.model.tokenize(shown)])

    def __missing__(self, chunk: bytes) -> bytes:
        ids = self._encode(chunk)
        self.size += len(chunk) + len(ids) + 160
        if self.size > MOST_REMEMBERED:
            self.clear()
            self.size = 0
        self[chunk] = ids
        return ids

    def of(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, text.encode().split()))


def word_ids(vocabulary: str) -> WordIds:
    """One for each Python worker, kept from task to task."""
    kept = sys.modules.setdefault("_word_ids_of_this_worker", ModuleType("_word_ids_of_this_worker"))
    if vocabulary not in kept.__dict__:
        setattr(kept, vocabulary, WordIds(vocabulary))
    return getattr(kept, vocabulary)


def pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY) -> DataFrame:
    """Every document's ids and the separator, cut into pieces only where they are too long."""

    def work():
        ids = word_ids(vocabulary)

        def each(batch: pa.RecordBatch) -> dict:
            out = {k: [] for k in ("doc_id", "piece", "start", "length", "ids_crc32")}
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts(batch, "text"), strict=True):
                made = ids.of(text) + SEPARATOR
                for piece, at in enumerate(range(0, len(made), 4 * capacity)):
                    part = made[at : at + 4 * capacity]
                    row = doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part)
                    for column, value in zip(out.values(), row, strict=True):
                        column.append(value)
            return out

        return each

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    return arrow_pass(docs.select(F.col("doc_id").cast("long"), "text"), work, schema)


def pack(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY) -> DataFrame:
    """Places of all pieces of all documents in as few sequences as the search finds.

    Null and empty texts are their separator alone. Repeated rows and doc_ids are packed each; an
    empty table gives no rows; other columns are not read. Pieces of equal length take their
    places by doc_id (null first) and piece.
    """
    cut = stage(pieces(docs, vocabulary, capacity), "pieces")
    counts = np.zeros(capacity + 1, "int64")
    for row in cut.groupBy("length").count().collect():  # at most one row for each length
        counts[row["length"]] = row["count"]
    places = sent(cut.sparkSession, Places.of(plan(counts)))
    rows = numbered(cut, "length", ["doc_id", "piece", "ids_crc32"], "number")

    def work():
        find = places().find

        def each(batch: pa.RecordBatch) -> dict:
            length, number = (batch.column(n).to_numpy() for n in ("length", "number"))
            sequence, offset = find(length, number)
            same = {n: batch.column(n) for n in ("doc_id", "piece", "start", "length", "ids_crc32")}
            return same | {"sequence_id": sequence, "offset": offset}

        return each

    schema = (
        "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    )
    return arrow_pass(rows, work, schema)
