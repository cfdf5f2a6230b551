"""Two tokenizers' tokens of the same text, aligned at the byte offsets where both end a token.

The cuts are found by divide and conquer: in an interval, the end nearest to the middle that both
tokenizers share is located by bisecting the other one's ends, and both halves go on by themselves;
an interval without such an end inside is a leaf, one group. All intervals of a level are bisected at
once, and the texts of a batch are one long stream, cut at their ends to begin with.

How many documents link a pair of ids counts over the whole corpus, so there are two passes. The
first writes blocks of documents, each with a dictionary of its groups and of its pairs; pairs are
counted from the dictionaries, which is far less than all links, and the counts of a block's pairs
come back to it to sum them up for its documents.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from .shared import arrow_pass, kept, small, stage, texts

#: Characters of text in a block, from which on it is closed; a longer text is a block by itself.
BLOCK_BYTES = 2**21
#: Shared ends that are sought one by one from the middle, before an interval is bisected whole.
STEPS = 6
#: Groups of so many links are first reduced to their different ids.
LARGE_GROUP = 256
#: Chunks of text that a worker remembers.
MOST_REMEMBERED = 3 * 2**17

BLOCKS = (
    "block long, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, "
    "n_links array<long>, groups_sha256 array<string>, sequence binary, group_ends binary, "
    "group_pairs binary, group_links binary, pairs array<long>, documents array<long>"
)
SUMMARY = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
    "groups_sha256 string"
)
GROUPS = "doc_id long, a array<int>, b array<int>, a_ends array<int>, b_ends array<int>"


# --- tokens -----------------------------------------------------------------------------


def byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for.

    Printable bytes stand for themselves, the others are numbered from 256 on.
    """
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = (b for b in range(256) if b not in printable)
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


#: Text from a space or line break up to the next one that does not stand behind white space.
_CHUNK = re.compile(r"\s*\S+(?:[^\S \n]\s*\S+)*(?:[^\S \n]\s*\Z)?|\s+")
#: Characters of chunks that are worth remembering.
LONG_CHUNK = 64
#: Characters of new chunks that are encoded as one text.
TOGETHER = 2**13


class ByteLevel:
    """A `tokenizers` file of byte-level BPE."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.model = Tokenizer.from_file(path)
        self.model.encode_special_tokens = True
        byte = byte_letters()
        size = self.model.get_vocab_size(with_added_tokens=True)
        entries = (self.model.id_to_token(i) or "" for i in range(size))
        self.bytes = [bytes(byte[c] for c in entry if c in byte) for entry in entries]
        #: Without a normalizer, and with a token for each byte, its tokens spell every text.
        self.spells = self.model.normalizer is None and len({t for t in self.bytes if len(t) == 1}) == 256

    def spelt(self, text: str, ids: list[int]) -> bool:
        return self.spells or _spelling(self, ids) == text.encode()

    def encode(self, chunks: list[str]) -> list[list[int]]:
        # The faster form leaves out character offsets, which nobody asks for.
        return [e.ids for e in self.model.encode_batch_fast(chunks, add_special_tokens=False)]


class Pieces:
    """A `sentencepiece` model with byte fallback, which puts a space before what it encodes."""

    def __init__(self, path: str) -> None:
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.bytes = [
            bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in enumerate(pieces)
        ]
        #: Whether no piece goes on from another character to a space, and none has a line break, so
        #: that none crosses chunks.
        self.separable = not any("\n" in p or re.search("[^▁]▁", p) for p in pieces)

    def spelt(self, text: str, ids: list[int]) -> bool:
        return _spelling(self, ids) == text.encode()

    def encode(self, chunks: list[str]) -> list[list[int]]:
        made = self.model.encode([c.removeprefix(" ") for c in chunks], num_threads=1)
        # Before a line break the space is a piece by itself.
        return [ids if c[0] == " " else ids[1:] for c, ids in zip(chunks, made, strict=True)]


def _spelling(model: ByteLevel | Pieces, ids: list[int]) -> bytes:
    return b"".join(map(model.bytes.__getitem__, ids))


class Numbers(dict):
    """Numbers from 0, in the order in which keys are first asked for."""

    def __missing__(self, key: str) -> int:
        number = self[key] = len(self)
        return number


class Tokenizers:
    """Both tokenizers, and the ids of chunks they have met.

    A chunk begins with a space or line break behind something that is no white space. The byte-level
    pattern has no match that goes on from there to white space, and no piece goes over to either, so
    chunks can be encoded one by one, or in any order many at once if none ends in white space; a
    model with pieces that do gets whole texts.
    """

    def __init__(self, one: ByteLevel, other: Pieces) -> None:
        self.both = one, other
        self.lengths = [np.array([len(t) for t in model.bytes]) for model in self.both]
        self._remember(Numbers(), [np.zeros(0, "int32")] * 2, [np.zeros(1, "int64")] * 2, np.zeros(0, bool), np.zeros(0, "int64"))

    def _remember(self, known: Numbers, ids: list, starts: list, spelt: np.ndarray, uses: np.ndarray) -> None:
        #: The number of each chunk, also its place among the keys.
        self.known = known
        #: For each tokenizer the ids of all chunks by number, and where each begins, with the end.
        self.ids, self.starts = ids, starts
        #: Whether the tokens of both spell the chunk, and how often it was met.
        self.spelt, self.uses = spelt, uses

    def _of(self, model: int, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One tokenizer's ids of some chunks, one after another, and how many each has."""
        start = self.starts[model][numbers]
        counts = self.starts[model][numbers + 1] - start
        return self.ids[model][np.repeat(start, counts) + _within(counts)], counts

    def _keep(self, numbers: np.ndarray) -> None:
        """Forgets all chunks but these."""
        chunks, known = list(self.known), Numbers()
        for i in numbers.tolist():
            known[chunks[i]] = len(known)
        kept_ids, counts = zip(*(self._of(model, numbers) for model in range(2)), strict=True)
        starts = [np.append(0, np.cumsum(n)) for n in counts]
        self._remember(known, list(kept_ids), starts, self.spelt[numbers], self.uses[numbers])

    def encode(self, said: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """The ids of a space and each text; none for an empty text or where they do not spell it."""
        if len(self.known) > MOST_REMEMBERED:
            # The half that was met most stays, and counts less than before.
            self._keep(np.sort(np.argsort(-self.uses, kind="stable")[: MOST_REMEMBERED // 2]))
            self.uses //= 2
        # A space at the end would be a chunk that is nothing without the space put before it.
        whole = not self.both[1].separable
        chunks = [
            [] if not t else [" " + t] if whole or t.endswith(" ") else _CHUNK.findall(" " + t) for t in said
        ]
        n_chunks = np.array([len(each) for each in chunks], "int64")
        before, met = len(self.known), chain.from_iterable(chunks)
        numbers = np.fromiter(map(self.known.__getitem__, met), "int64", n_chunks.sum())
        new = list(islice(reversed(self.known), len(self.known) - before))[::-1]
        long = np.fromiter(map(len, new), "int64", len(new)) > LONG_CHUNK
        if long.any():
            # They get the last numbers and are forgotten below.
            order = np.argsort(long, kind="stable")
            numbers = np.append(np.arange(before), before + np.argsort(order))[numbers]
            new = [new[i] for i in order.tolist()]
            self.known.update(zip(new, range(before, len(self.known)), strict=True))
        self._learn(new, whole)
        self.uses = self.uses + np.bincount(numbers, minlength=len(self.known))
        texts_of = np.repeat(np.arange(len(said)), n_chunks)
        wrong = np.bincount(texts_of[~self.spelt[numbers]], minlength=len(said)) > 0
        if wrong.any():
            numbers, texts_of = (x[~wrong[texts_of]] for x in (numbers, texts_of))
        made = []
        for model in range(2):
            ids, counts = self._of(model, numbers)
            upto = np.append(0, np.cumsum(counts))
            made.append(np.split(ids, upto[np.searchsorted(texts_of, np.arange(1, len(said)))] if said else []))
        if long.any():
            self._forget_last(new[len(new) - int(long.sum()) :])
        return list(zip(*made, strict=True))[: len(said)]

    def _forget_last(self, chunks: list[str]) -> None:
        for chunk in chunks:
            del self.known[chunk]
        n = len(self.known)
        self.ids = [ids[: starts[n]].copy() for ids, starts in zip(self.ids, self.starts, strict=True)]
        self.starts = [starts[: n + 1] for starts in self.starts]
        self.spelt, self.uses = self.spelt[:n], self.uses[:n]

    def _learn(self, new: list[str], whole: bool) -> None:
        """Puts the ids of new chunks behind the others."""
        sizes = np.array([len(c.encode()) for c in new], "int64")
        spelt, stretches = np.ones(len(new), bool), list(_encoded_together(new, whole))
        joined = ["".join(new[x:y]) for x, y in stretches]
        for i, model in enumerate(self.both):
            ids, counts = [self.ids[i]], np.zeros(len(new), "int64")
            for (x, y), said, made in zip(stretches, joined, model.encode(joined), strict=True):
                n = self._counts(i, said, sizes[x:y], made)
                if n is None:
                    # One of them is not spelt, so they are encoded one by one.
                    each = model.encode(new[x:y]) if y - x > 1 else [made]
                    n, made = [len(one) for one in each], list(chain.from_iterable(each))
                    spelt[x:y] &= [model.spelt(c, one) for c, one in zip(new[x:y], each, strict=True)]
                counts[x:y] = n
                ids.append(np.array(made, "int32"))
            self.ids[i] = np.concatenate(ids)
            self.starts[i] = np.append(self.starts[i], self.starts[i][-1] + np.cumsum(counts))
        self.spelt = np.append(self.spelt, spelt)
        self.uses = np.append(self.uses, np.zeros(len(new), "int64"))

    def _counts(self, model: int, said: str, sizes: np.ndarray, ids: list[int]) -> np.ndarray | None:
        """How many of the ids lie in each part of so many bytes; none if the ids do not spell the parts."""
        ends = np.cumsum(self.lengths[model][np.array(ids, "int64")])
        stops = np.cumsum(sizes)
        if not len(ends) or ends[-1] != stops[-1] or not self.both[model].spelt(said, ids):
            return None
        at = np.searchsorted(ends, stops)
        return np.diff(at, prepend=-1) if (ends[at] == stops).all() else None


def _encoded_together(chunks: list[str], whole: bool) -> Iterator[tuple[int, int]]:
    """Stretches of some `TOGETHER` characters; a chunk that ends in white space is one by itself."""
    start, held = 0, 0
    for i, chunk in enumerate(chunks):
        alone = whole or chunk[-1].isspace()
        if i > start and (alone or held >= TOGETHER):
            yield start, i
            start, held = i, 0
        held += TOGETHER if alone else len(chunk)
    if chunks:
        yield start, len(chunks)


def _tokenizers(one: str, other: str) -> Tokenizers:
    return kept(f"{one} {other}", lambda: Tokenizers(ByteLevel(one), Pieces(other)))


# --- cuts -------------------------------------------------------------------------------


def shared_cuts(ends_a: np.ndarray, ends_b: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The groups of a stream: how many tokens of `a` and of `b` have passed at the end of each.

    `ends_a` and `ends_b` are the tokens' ascending byte ends, `stops` some ends that both have,
    the last one among them.
    """
    if not len(stops):
        return np.zeros(0, "int64"), np.zeros(0, "int64")
    a_hi, b_hi = np.searchsorted(ends_a, stops) + 1, np.searchsorted(ends_b, stops) + 1
    a_lo, b_lo = np.append(0, a_hi[:-1]), np.append(0, b_hi[:-1])
    leaves_a, leaves_b = [], []
    while len(a_lo):
        # An interval can only be cut between two tokens of each.
        leaf = (a_hi - a_lo < 2) | (b_hi - b_lo < 2)
        cut = np.full(len(a_lo), -1)
        open_ = np.flatnonzero(~leaf)
        cut[open_] = _near_middle(ends_a, ends_b, a_lo[open_], a_hi[open_])
        leaf = cut < 0
        leaves_a.append(a_hi[leaf])
        leaves_b.append(b_hi[leaf])
        a_lo, a_hi, b_lo, b_hi, cut = (x[~leaf] for x in (a_lo, a_hi, b_lo, b_hi, cut))
        at_a, at_b = cut + 1, np.searchsorted(ends_b, ends_a[cut]) + 1
        # The halves stay in the order of the stream, as ascending ends are found sooner.
        a_lo, a_hi = _in_turn(a_lo, at_a), _in_turn(at_a, a_hi)
        b_lo, b_hi = _in_turn(b_lo, at_b), _in_turn(at_b, b_hi)
    return np.sort(np.concatenate(leaves_a)), np.sort(np.concatenate(leaves_b))


def _in_turn(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    return np.stack([one, other], axis=1).ravel()


def _near_middle(ends_a, ends_b, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """For each interval `lo` to `hi` of tokens the shared end inside nearest to its middle, or -1."""
    found = np.full(len(lo), -1)
    last = hi - 2  # the interval's own end does not count
    middle = (lo + last) // 2
    waiting = np.arange(len(lo))
    for step in range(STEPS):
        for probe in (middle - step, middle + step)[: 1 + (step > 0)]:
            if not len(waiting):
                return found
            at = probe[waiting]
            inside = (at >= lo[waiting]) & (at <= last[waiting])
            asked, at = waiting[inside], at[inside]
            shared = _is_end(ends_a[at], ends_b)
            found[asked[shared]] = at[shared]
            waiting = waiting[found[waiting] < 0]
        waiting = waiting[(middle[waiting] - step > lo[waiting]) | (middle[waiting] + step < last[waiting])]
    # Few are left, where shared ends are rare: all ends inside are bisected.
    for i in waiting.tolist():
        inside = np.arange(lo[i], hi[i] - 1)
        shared = inside[_is_end(ends_a[inside], ends_b)]
        if len(shared):
            found[i] = shared[np.argmin(np.abs(shared - middle[i]))]
    return found


def _is_end(at: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return ends[np.searchsorted(ends, at)] == at


class Aligned:
    """The tokens of some texts and their groups; a text that its tokens don't spell has none.

    `a`, `b`: all ids, `a_ends`, `b_ends`: tokens up to the end of each group, `of_a`, `of_b`: tokens
    up to the end of each text, `of`: groups up to the end of each text.
    """

    def __init__(self, said: list[str], tokenizers: Tokenizers) -> None:
        made = tokenizers.encode(said)
        self.a, self.of_a = _flat([a for a, _ in made])
        self.b, self.of_b = _flat([b for _, b in made])
        ends_a, ends_b = (
            np.cumsum(lengths[ids])
            for lengths, ids in zip(tokenizers.lengths, (self.a, self.b), strict=True)
        )
        stops = ends_a[np.unique(self.of_a[self.of_a > 0]) - 1]
        self.a_ends, self.b_ends = shared_cuts(ends_a, ends_b, stops)
        self.of = np.searchsorted(self.a_ends, self.of_a, side="right")


def _flat(lists: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return np.concatenate([np.zeros(0, "int64"), *lists]), np.cumsum([len(x) for x in lists], dtype="int64")


# --- blocks -----------------------------------------------------------------------------


def _starts(ends: np.ndarray) -> np.ndarray:
    return np.append(0, ends[:-1]) if len(ends) else ends


def _within(counts: np.ndarray) -> np.ndarray:
    """0, 1, … for each of `counts`, one after another."""
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


class Block:
    """Documents, one after another, with the groups they consist of and the pairs of these."""

    def __init__(self, size: int) -> None:
        #: Above every id.
        self.size = size
        #: The number of each group, by a whole number for the groups of up to three tokens and by
        #: its tokens for larger ones; its ids, how many are of `a`, and its text.
        self.numbers: dict[int | tuple, int] = {}
        self.tokens: list[np.ndarray] = []
        self.of_a: list[int] = []
        self.texts: list[bytes] = []
        self.sequences: list[np.ndarray] = []
        self.rows: list[tuple] = []
        self.bytes = 0

    def add(self, doc_ids: list, said: list[str], aligned: Aligned) -> None:
        a_ends, b_ends, of = aligned.a_ends, aligned.b_ends, aligned.of
        n_a, n_b = np.diff(a_ends, prepend=0), np.diff(b_ends, prepend=0)
        ids = self._numbers(aligned, n_a, n_b)
        self.sequences.append(ids.astype("int32"))
        listed, text = ids.tolist(), self.texts.__getitem__
        digests = [
            hashlib.sha256(b"".join(map(text, listed[x:y]))[:-1]).hexdigest() if y > x else ""
            for x, y in zip([0, *of.tolist()], of.tolist(), strict=False)
        ]
        links = np.append(0, np.cumsum(n_a * n_b))
        counts = [np.diff(x, prepend=0).tolist() for x in (aligned.of_a, aligned.of_b, of)]
        self.rows += zip(doc_ids, *counts, (links[of] - links[_starts(of)]).tolist(), digests, strict=True)
        self.bytes += sum(map(len, said))

    def _numbers(self, aligned: Aligned, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
        """The number of each group; new ones are described."""
        a, b = aligned.a, aligned.b
        at_a, at_b = aligned.a_ends - n_a, aligned.b_ends - n_b
        keys = np.zeros(len(n_a), "int64")
        shapes = ((1, 1), (1, 2), (2, 1))
        for shape, (x, y) in enumerate(shapes):
            here = np.flatnonzero((n_a == x) & (n_b == y))
            for values, at, n in ((a, at_a, x), (b, at_b, y)):
                for i in range(n):
                    keys[here] = keys[here] * self.size + values[at[here] + i]
            keys[here] = keys[here] * len(shapes) + shape
        large = np.flatnonzero(n_a + n_b > 3)
        spans = [x[large].tolist() for x in (at_a, at_b, n_a, n_b)]
        bytes_a, bytes_b, wide, known = a.tobytes(), b.tobytes(), a.itemsize, self.numbers.get
        for i, p, q, x, y in zip(large.tolist(), *spans, strict=True):
            key = bytes_a[p * wide : (p + x) * wide], bytes_b[q * wide : (q + y) * wide]
            number = known(key)
            if number is None:
                number = self._described(key, a[p : p + x], b[q : q + y])
            # Negative keys are the numbers that these groups have.
            keys[i] = -1 - number
        codes, different = pd.factorize(keys)
        first = np.zeros(len(different), "int64")
        first[codes[::-1]] = np.arange(len(codes))[::-1]
        numbers = np.empty(len(different), "int64")
        spans = [x[first].tolist() for x in (at_a, at_b, n_a, n_b)]
        for i, (key, p, q, x, y) in enumerate(zip(different.tolist(), *spans, strict=True)):
            number = -1 - key if key < 0 else known(key)
            numbers[i] = self._described(key, a[p : p + x], b[q : q + y]) if number is None else number
        return numbers[codes]

    def _described(self, key: int | tuple, a: np.ndarray, b: np.ndarray) -> int:
        """The number of a new group."""
        number = self.numbers[key] = len(self.numbers)
        self.tokens.append(np.concatenate([a, b]))
        self.of_a.append(len(a))
        both = ",".join(map(str, a.tolist())), ",".join(map(str, b.tolist()))
        self.texts.append("|".join(both).encode() + b";")
        return number

    def row(self, number: int) -> dict:
        """A row of `BLOCKS`."""
        group, pair, times = self._group_pairs()
        pairs, place = np.unique(pair, return_inverse=True)
        group_ends = np.cumsum(np.bincount(group, minlength=len(self.numbers)))
        sequence = np.concatenate([np.zeros(0, "int32"), *self.sequences])
        n_groups = np.array([r[3] for r in self.rows])
        doc = np.repeat(np.arange(len(self.rows)), n_groups)
        doc, used = np.divmod(pd.unique(doc * max(1, len(self.numbers)) + sequence), max(1, len(self.numbers)))
        held = np.diff(group_ends, prepend=0)[used]
        at = np.repeat(_starts(group_ends)[used] if len(used) else used, held) + _within(held)
        linked = pd.unique(np.repeat(doc, held) * max(1, len(pairs)) + place[at])
        documents = np.bincount(linked % max(1, len(pairs)), minlength=len(pairs))
        doc_id, n_a, n_b, n_groups, n_links, digests = zip(*self.rows, strict=True)
        return {
            "block": number,
            "doc_id": doc_id,
            "n_a": n_a,
            "n_b": n_b,
            "n_groups": n_groups,
            "n_links": n_links,
            "groups_sha256": digests,
            "sequence": _packed(sequence),
            "group_ends": _packed(group_ends),
            "group_pairs": _packed(place),
            "group_links": _packed(times),
            "pairs": pairs,
            "documents": documents,
        }

    def _group_pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For the block's groups: group, different pair (a's id above b's) and how often it is linked."""
        ids = np.concatenate([np.zeros(0, "int64"), *self.tokens])
        ends = np.cumsum([len(x) for x in self.tokens], dtype="int64")
        n_a = np.array(self.of_a, "int64")
        n_b = ends - _starts(ends) - n_a
        little = np.flatnonzero(n_a * n_b <= LARGE_GROUP)
        links = (n_a * n_b)[little]
        group, within = np.repeat(little, links), _within(links)
        of_a, of_b = np.divmod(within, n_b[group])
        first = _starts(ends)[group]
        pair = ids[first + of_a] << 32 | ids[first + n_a[group] + of_b]
        parts = [(group, pair, np.ones(len(group), "int64"))]
        for g in np.flatnonzero(n_a * n_b > LARGE_GROUP).tolist():
            start, bar = ends[g] - n_a[g] - n_b[g], ends[g] - n_b[g]
            a, times_a = np.unique(ids[start:bar], return_counts=True)
            b, times_b = np.unique(ids[bar : ends[g]], return_counts=True)
            pair = (a[:, None] << 32 | b).ravel()
            parts.append((np.full(len(pair), g), pair, (times_a[:, None] * times_b).ravel()))
        group, pair, times = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.lexsort((pair, group))
        group, pair, times = group[order], pair[order], times[order]
        new = np.flatnonzero((np.diff(group, prepend=-1) != 0) | (np.diff(pair, prepend=-1) != 0))
        return group[new], pair[new], np.add.reduceat(times, new) if len(new) else times


def _packed(numbers: np.ndarray) -> bytes:
    """Whole numbers of at most 64 bits, as small as they are and compressed."""
    wide = int(numbers.max(initial=0)) >= 2**31
    raw = numbers.astype("<i8" if wide else "<i4").tobytes()
    head = (len(raw) * 2 + wide).to_bytes(8, "little")
    return head + pa.compress(raw, codec="zstd", asbytes=True)


def _unpacked(packed: bytes) -> np.ndarray:
    size, wide = divmod(int.from_bytes(packed[:8], "little"), 2)
    raw = pa.decompress(packed[8:], decompressed_size=size, codec="zstd", asbytes=True)
    return np.frombuffer(raw, "<i8" if wide else "<i4").astype("int64")


def _narrow(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), "text")


def blocks(docs: DataFrame, one: str, other: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents, encoded and aligned, in rows of `BLOCKS`, written to the shared folder."""
    kinds = T._parse_datatype_string(BLOCKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        shape = to_arrow_schema(kinds)
        tokenizers = _tokenizers(one, other)
        size = max(len(model.bytes) for model in tokenizers.both)
        number = TaskContext.get().partitionId() << 32

        def made(block: Block) -> pa.RecordBatch:
            row = block.row(number)
            return pa.record_batch([pa.array([row[f.name]], type=f.type) for f in shape], schema=shape)

        block = Block(size)
        for batch in small(batches):
            said, ids = texts(batch, "text"), batch.column("doc_id").to_pylist()
            for x, y in _stretches([len(t) for t in said], block_bytes // 8):
                block.add(ids[x:y], said[x:y], Aligned(said[x:y], tokenizers))
                if block.bytes >= block_bytes:
                    yield made(block)
                    block, number = Block(size), number + 1
        if block.rows:
            yield made(block)

    return stage(_narrow(docs).mapInArrow(run, kinds), "blocks")


def _stretches(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Rows in stretches of some `most` characters, which are aligned together."""
    start, held = 0, 0
    for i, size in enumerate(sizes):
        held += size
        if held >= most:
            yield start, i + 1
            start, held = i + 1, 0
    if start < len(sizes):
        yield start, len(sizes)


def pair_counts(made: DataFrame) -> DataFrame:
    """From `blocks`: `pair` (a's id above b's) and `n`, how many documents hold it linked."""
    each = made.select(F.inline(F.arrays_zip("pairs", "documents"))).toDF("pair", "documents")
    return each.groupBy("pair").agg(F.sum("documents").alias("n"))


def link_counts(docs: DataFrame, one: str, other: str) -> DataFrame:
    """`a`, `b`, `documents`: how many documents hold each pair of ids linked."""
    return pair_counts(blocks(docs, one, other)).select(
        F.shiftright("pair", 32).cast("int").alias("a"),
        F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)).cast("int").alias("b"),
        F.col("n").alias("documents"),
    )


def align(docs: DataFrame, one: str, other: str) -> DataFrame:
    """doc_id, the ids `a` and `b` of each text, and how many of them have passed at each group's end.

    Odd input as in `alignment`.
    """

    def work():
        tokenizers = _tokenizers(one, other)

        def each(batch: pa.RecordBatch) -> dict:
            made = Aligned(texts(batch, "text"), tokenizers)
            counts = np.diff(made.of, prepend=0)
            a_ends = made.a_ends - np.repeat(_starts(made.of_a), counts)
            b_ends = made.b_ends - np.repeat(_starts(made.of_b), counts)
            return {
                "doc_id": batch.column("doc_id"),
                "a": _lists(made.a, made.of_a),
                "b": _lists(made.b, made.of_b),
                "a_ends": _lists(a_ends, made.of),
                "b_ends": _lists(b_ends, made.of),
            }

        return each

    return arrow_pass(_narrow(docs), work, GROUPS)


def _lists(values: np.ndarray, ends: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(np.append(0, ends).astype("int32"), values.astype("int32"))


def alignment(docs: DataFrame, one: str, other: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """What the corpus says about each document's links: rows of `SUMMARY`.

    `one` is a byte-level `tokenizers` file and reads a space and the text, `other` a `sentencepiece`
    model that adds this space. Null and empty texts, and texts that either one does not spell byte
    by byte, have no tokens: zeros, and an empty digest. Every pair of tokens of a group is a link;
    n_best counts links whose pair is in as many documents as any with the same id of `one`,
    count_sum adds up these document counts over the links. Rows that are equal or share a doc_id
    count as documents of their own; a null doc_id stays null; an empty table gives no rows; other
    columns are not read.
    """
    made = blocks(docs, one, other, block_bytes)
    counts = stage(pair_counts(made), "pair-counts")
    a = F.shiftright("pair", 32).alias("a")
    # At most one row for each id of the first vocabulary.
    most = counts.groupBy(a).agg(F.max("n").alias("most"))
    # The count, and in its lowest bit whether it is the highest.
    told = counts.select("pair", "n", a).join(most, "a").select(
        "pair", (F.col("n") * 2 + (F.col("n") == F.col("most")).cast("int")).alias("told")
    )
    back = (
        made.select("block", F.explode("pairs").alias("pair"))
        .join(told, "pair")
        .groupBy("block")
        .agg(F.transform(F.sort_array(F.collect_list(F.struct("pair", "told"))), lambda x: x["told"]).alias("told"))
    )
    whole = made.drop("pairs", "documents").join(back, "block", "left")

    def work():
        def each(batch: pa.RecordBatch) -> dict:
            made = {c: [] for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")}
            best, total = [], []
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i] for c in batch.schema.names}
                for name, values in made.items():
                    values += row[name].as_py()
                told = row["told"].values
                told = told.to_numpy() if told is not None else np.zeros(0, "int64")
                ends = _unpacked(row["group_ends"].as_py())
                pair, times = _unpacked(row["group_pairs"].as_py()), _unpacked(row["group_links"].as_py())
                groups = np.append(0, ends)
                to = np.append(0, np.cumsum(row["n_groups"].values.to_numpy()))
                sequence = _unpacked(row["sequence"].as_py())
                for bit, sums in ((told[pair] & 1, best), (told[pair] >> 1, total)):
                    upto = np.append(0, np.cumsum(bit * times))
                    of_group = upto[groups[1:]] - upto[groups[:-1]]
                    upto = np.append(0, np.cumsum(of_group[sequence]))
                    sums += (upto[to[1:]] - upto[to[:-1]]).tolist()
            return {**made, "n_best": best, "count_sum": total}

        return each

    return arrow_pass(whole, work, SUMMARY)
