"""Document fingerprints by context-triggered piecewise hashing.

A rolling hash over the last bytes of a text ends a chunk wherever it meets a trigger, so an edit
only changes the chunks around it. A chunk gives one letter of the signature. Triggers depend on
the block size, which follows from the length; a fingerprint has the signatures at that size and
at its double, and two fingerprints are compared where they share a size (Kornblum, 2006).
"""

from __future__ import annotations

import hashlib
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import stage

WINDOW = 7
#: Chunks a text should have at its block size: from half of this to all of it.
CHUNKS = 64
LETTERS = string.ascii_uppercase + string.ascii_lowercase + string.digits + "+/"
#: Signatures without a common run of so many letters have nothing in common.
RUN = 4
_SCRAMBLED = np.array(
    [xxhash.xxh32_intdigest(bytes([b])) | 1 for b in range(256)], "uint32"
)


def _rolling(raw: np.ndarray) -> np.ndarray:
    """A hash of the last `WINDOW` bytes at every place (fewer at the start)."""
    scrambled = _SCRAMBLED[raw]
    rolled = scrambled.copy()
    for back in range(1, min(WINDOW, len(raw))):
        turned = scrambled[:-back] << np.uint32(4 * back) | scrambled[:-back] >> np.uint32(32 - 4 * back)
        rolled[back:] ^= turned
    return rolled * np.uint32(2654435761) >> np.uint32(7)


def block_size(length: int) -> int:
    """The least power of two that gives at most `CHUNKS` chunks, from the length in bytes."""
    return 1 << max(0, (max(length, 1) - 1) // CHUNKS).bit_length()


def _signature(raw: bytes, rolled: np.ndarray, size: int) -> str:
    ends = np.flatnonzero((rolled & np.uint32(size - 1)) == size - 1) + 1
    cuts, last, gap = [], 0, max(1, size // 4)
    at = 0
    # Triggers closer than a quarter block are skipped: repeated bytes can't make it longer.
    while (at := at + int(np.searchsorted(ends[at:], last + gap))) < len(ends):
        last = int(ends[at])
        cuts.append(last)
    if last < len(raw):
        cuts.append(len(raw))
    starts = [0, *cuts][: len(cuts)]
    digest = xxhash.xxh32_intdigest
    return "".join([LETTERS[digest(raw[a:b]) & 63] for a, b in zip(starts, cuts, strict=True)])


def fingerprint(text: str) -> str:
    """`block size:signature:signature at the double size`; of an empty text `1::`."""
    raw = text.encode()
    size = block_size(len(raw))
    rolled = _rolling(np.frombuffer(raw, "uint8"))
    return f"{size}:{_signature(raw, rolled, size)}:{_signature(raw, rolled, 2 * size)}"


def _common(a: str, b: str) -> int:
    """The length of the longest common subsequence, all rows of the table in one whole number."""
    places: dict[str, int] = {}
    for i, letter in enumerate(a):
        places[letter] = places.get(letter, 0) | 1 << i
    full = (1 << len(a)) - 1
    state = full
    for letter in b:
        met = state & places.get(letter, 0)
        state = (state + met | state - met) & full
    return len(a) - state.bit_count()


def _alike(a: str, b: str) -> float:
    """One less the edit distance (letters put in or taken out) over both lengths."""
    if a == b:
        return 1.0
    shorter = min(len(a), len(b))
    run = min(RUN, max(1, shorter // 2))
    runs = {a[i : i + run] for i in range(len(a) - run + 1)}
    if not shorter or not any(b[i : i + run] in runs for i in range(len(b) - run + 1)):
        return 0.0
    return 2 * _common(a, b) / (len(a) + len(b))


def likeness(one: str, other: str) -> float:
    """From 0 to 1; 1 for equal fingerprints, 0 where no block size is shared."""
    if one == other:
        return 1.0
    a_size, *a = one.split(":")
    b_size, *b = other.split(":")
    if a_size == b_size:
        return max(_alike(a[0], b[0]), _alike(a[1], b[1]))
    if int(a_size) == 2 * int(b_size):
        return _alike(a[0], b[1])
    if int(b_size) == 2 * int(a_size):
        return _alike(a[1], b[0])
    return 0.0


def edited(text: str, following: str) -> str:
    """The last half of the text replaced by as much of the following text, or all of it."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _result(doc_id, text: str, own: str, following: str, next_print: str) -> tuple:
    changed = edited(text, following)
    print_ = fingerprint(changed)
    return (
        doc_id,
        len(text),
        hashlib.sha256(changed.encode()).hexdigest(),
        own,
        print_,
        likeness(own, print_),
        likeness(own, next_print),
    )


RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)


def fingerprints(docs: DataFrame) -> DataFrame:
    """Of every whole text (null as empty) its fingerprint, that of its edited text, and likenesses.

    The next document is the next by doc_id, null first and equal ids by text; after the last
    comes the first. A table of one row is its own next, an empty table gives no rows, other
    columns are not read.

    Texts are range-partitioned and sorted by doc_id once. Each partition compares neighbours and
    leaves its first and last document; those two per partition are paired across partitions.
    """
    ordered = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    keys = [F.col("doc_id").asc_nulls_first(), F.col("text")]
    ordered = ordered.repartitionByRange(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
    ordered = ordered.sortWithinPartitions(*keys)
    schema = f"{RESULT}, part long, first string, last string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, first, held = TaskContext.get().partitionId(), None, None
        names = [c.split()[0] for c in schema.split(", ")]

        def made(rows: list[tuple]) -> pa.RecordBatch:
            kinds = {"long": pa.int64(), "double": pa.float64(), "string": pa.string()}
            types = [kinds[c.split()[1]] for c in schema.split(", ")]
            columns = list(zip(*rows, strict=True)) or [()] * len(names)
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, names=names)

        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = fingerprint(text)
                if held is None:
                    first = text
                else:
                    rows.append((*_result(*held, text, own), None, None, None))
                held = doc_id, text, own
            yield made(rows)
        if held is not None:
            doc_id, text, own = held
            yield made([(doc_id, None, None, own, None, None, None, part, first, text)])

    table = stage(ordered.mapInArrow(run, schema), "piecewise")
    inner = table.where("part IS NULL").drop("part", "first", "last")
    ends = table.where("part IS NOT NULL")
    # Which partition comes after which, over their numbers alone.
    parts = ends.select("part").withColumn(
        "after", F.coalesce(F.lead("part").over(Window.orderBy("part")), F.min("part").over(Window.partitionBy()))
    )
    pairs = (
        ends.select("part", "doc_id", "last", "fingerprint")
        .join(parts, "part")
        .join(ends.select(F.col("part").alias("after"), "first"), "after")
    )

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in RESULT.split(", ")]
        for batch in batches:
            rows = [
                _result(r["doc_id"], r["last"], r["fingerprint"], r["first"], fingerprint(r["first"]))
                for r in batch.to_pylist()
            ]
            columns = list(zip(*rows, strict=True)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

    return inner.unionByName(pairs.select("doc_id", "last", "fingerprint", "first").mapInArrow(finish, RESULT))
