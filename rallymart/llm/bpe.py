"""Byte-level BPE by two tiers: a minimal perfect hash, and merges with a heap over linked bytes.

A pre-token that is a token as it stands is found by the hash, which has exactly one slot for each
token. Every other one is merged: its bytes are a linked list, the heap gives the pair with the
lowest rank and of equals the first, and a merge links the pair's neighbours to the new part.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import arrow_pass, kept, sent, small, texts

#: Bytes of text chunks and ids that a worker remembers.
MOST_REMEMBERED = 128 * 2**20
_CHUNK = re.compile("[ \t\n\r\f\v]*[^ \t\n\r\f\v]+|[ \t\n\r\f\v]+")
#: White space that is none of the six above: it could be cut off from the white space around it.
_OTHER_SPACE = re.compile("[\x1c-\x1f\x85\xa0  -     　]")


def read_ranks(path: str) -> list[bytes]:
    """Tokens in order of their rank from a file of lines `base64 rank`."""
    with open(path, "rb") as lines:
        ranked = sorted((int(n), base64.b64decode(t)) for t, n in map(bytes.split, lines))
    if [n for n, _ in ranked] != list(range(len(ranked))):
        raise ValueError("ranks must be gapless from 0")
    return [t for _, t in ranked]


class PerfectHash:
    """A minimal perfect hash of byte strings: n keys, n slots, and a number for each bucket.

    Keys fall into buckets; buckets are placed from large to small, each by the first seed that
    sends its keys to free slots. A bucket of one key just takes a free slot, written as -slot - 1.
    """

    def __init__(self, keys: list[bytes]) -> None:
        self.n = len(keys)
        self.seeds = [0] * max(1, self.n // 3)
        buckets: dict[int, list[int]] = {}
        for i, key in enumerate(keys):
            buckets.setdefault(self._bucket(key), []).append(i)
        self.slots = [-1] * self.n
        single = []
        for bucket, members in sorted(buckets.items(), key=lambda x: -len(x[1])):
            if len(members) == 1:
                single.append((bucket, members[0]))
                continue
            seed = 1
            while True:
                at = [self._slot(keys[i], seed) for i in members]
                if len(set(at)) == len(at) and all(self.slots[s] < 0 for s in at):
                    break
                seed += 1
            self.seeds[bucket] = seed
            for i, s in zip(members, at, strict=True):
                self.slots[s] = i
        free = (s for s in range(self.n) if self.slots[s] < 0)
        for bucket, i in single:
            s = next(free)
            self.slots[s], self.seeds[bucket] = i, -s - 1
        self.keys = [keys[i] for i in self.slots]

    def _bucket(self, key: bytes) -> int:
        return xxhash.xxh3_64_intdigest(key) % len(self.seeds)

    def _slot(self, key: bytes, seed: int) -> int:
        return xxhash.xxh3_64_intdigest(key, seed) % self.n

    def find(self, key: bytes) -> int:
        """The key's place in the list it was made from, or -1."""
        if not self.n:
            return -1
        seed = self.seeds[self._bucket(key)]
        slot = -seed - 1 if seed < 0 else self._slot(key, seed)
        return self.slots[slot] if self.keys[slot] == key else -1


class Encoder(dict):
    """Ids of chunks and pre-tokens, as little-endian bytes; what is missing is encoded and kept."""

    def __init__(self, tokens: list[bytes], whole: PerfectHash, pattern: str) -> None:
        ranks = {t: n for n, t in enumerate(tokens)}
        self.tokens = tokens
        self.single = [ranks[bytes([b])] for b in range(256)]
        #: The rank of two neighbours that make a token, by both ranks.
        self.pairs = {
            ranks[t[:i]] << 32 | ranks[t[i:]]: n
            for n, t in enumerate(tokens)
            for i in range(1, len(t))
            if t[:i] in ranks and t[i:] in ranks
        }
        self.raw = [n.to_bytes(4, "little") for n in range(len(tokens))]
        self.whole = whole
        self.pattern = regex.compile(pattern)
        self.size = 0

    def merge(self, word: bytes) -> list[int]:
        """The ids of a pre-token that is no token itself."""
        rank_of, pop, push = self.pairs.get, heapq.heappop, heapq.heappush
        ids = [self.single[b] for b in word]
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        #: The rank of each part with the one after it, or -1.
        ranks = [rank_of(a << 32 | b, -1) for a, b in zip(ids, ids[1:], strict=False)]
        heap = [rank << 32 | i for i, rank in enumerate(ranks) if rank >= 0]
        heapq.heapify(heap)
        while heap:
            top = pop(heap)
            i, rank = top & 0xFFFFFFFF, top >> 32
            if ranks[i] != rank:  # the pair has changed since
                continue
            j = after[i]
            k = after[i] = after[j]
            ids[i], ids[j], new = rank, -1, -1
            if j < n - 1:
                ranks[j] = -1
            if k < n:
                before[k] = i
                new = rank_of(rank << 32 | ids[k], -1)
                if new >= 0:
                    push(heap, new << 32 | i)
            ranks[i] = new
            h = before[i]
            if h >= 0:
                new = ranks[h] = rank_of(ids[h] << 32 | rank, -1)
                if new >= 0:
                    push(heap, new << 32 | h)
        return [x for x in ids if x >= 0]

    def _word(self, word: str) -> bytes:
        raw = word.encode()
        found = self.whole.find(raw)
        if found >= 0:
            return self.raw[found]
        return b"".join([self.raw[x] for x in self.merge(raw)])

    def __missing__(self, chunk: str) -> bytes:
        words = self.pattern.findall(chunk)
        if len(words) == 1:
            ids = self._word(chunk)
        else:
            ids = b"".join([self.get(w) or self._keep(w, self._word(w)) for w in words])
        return self._keep(chunk, ids)

    def _keep(self, chunk: str, ids: bytes) -> bytes:
        self.size += 2 * len(chunk) + len(ids) + 160
        if self.size > MOST_REMEMBERED:
            self.clear()
            self.size = 0
        self[chunk] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """Pre-tokens end where white space begins, so chunks can be encoded one by one."""
        odd = _odd_control(text) if text.isascii() else _OTHER_SPACE.search(text)
        cut = self.pattern if odd else _CHUNK
        return b"".join(map(self.__getitem__, cut.findall(text)))


def _odd_control(text: str) -> bool:
    return "\x1c" in text or "\x1d" in text or "\x1e" in text or "\x1f" in text


def encode(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """doc_id and `ids` of every whole text, null as empty; each match of `pattern` by itself.

    Empty texts have no ids. Repeated rows are encoded each; an empty table gives no rows; other
    columns are not read. The vocabulary and its hash are broadcast: their size is the file's.
    """
    tokens = read_ranks(ranks)
    shared = sent(docs.sparkSession, (tokens, PerfectHash(tokens)))

    def work():
        encoder = kept(f"{ranks} {pattern}", lambda: Encoder(*shared(), pattern))

        def each(batch: pa.RecordBatch) -> dict:
            made = [encoder.encode(x) for x in texts(batch, "text")]
            ends = np.cumsum([0, *map(len, made)]) // 4
            flat = np.frombuffer(b"".join(made), "<i4")
            ids = pa.ListArray.from_arrays(pa.array(ends.astype("int32")), pa.array(flat))
            return {"doc_id": batch.column("doc_id"), "ids": ids}

        return each

    return arrow_pass(docs.select(F.col("doc_id").cast("long"), "text"), work, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, ranks: str) -> DataFrame:
    """The rows with `bytes`, what their `ids` stand for."""
    shared = sent(encoded.sparkSession, read_ranks(ranks))
    schema = T.StructType([*encoded.schema.fields, T.StructField("bytes", T.BinaryType())])

    def run(batches):
        token = shared().__getitem__
        for batch in small(batches):
            ids = batch.column("ids")
            # The offsets of a slice are into the whole array of values.
            ends, flat = ids.offsets.to_pylist(), ids.values.to_numpy()
            cut = (flat[a:b].tolist() for a, b in zip(ends, ends[1:], strict=False))
            made = [b"".join(map(token, x)) for x in cut]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(made, pa.binary())], names=[*batch.schema.names, "bytes"]
            )

    return encoded.mapInArrow(run, schema)


def round_trip(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens and the digests of what `encode` and then `decode` give, in one pass.

    ids_sha256 is of the decimal ids joined by one space, decoded_sha256 of the bytes that the ids
    stand for; both in lowercase hex. Rows as in `encode`, but no ids leave the task.
    """
    tokens = read_ranks(ranks)
    shared = sent(docs.sparkSession, (tokens, PerfectHash(tokens)))

    def work():
        encoder = kept(f"{ranks} {pattern}", lambda: Encoder(*shared(), pattern))
        token = encoder.tokens.__getitem__
        decimal = kept(f"decimals {len(encoder.tokens)}", lambda: [b"%d" % n for n in range(len(encoder.tokens))])
        decimal = decimal.__getitem__

        def each(batch: pa.RecordBatch) -> dict:
            sizes, listed, decoded = [], [], []
            for text in texts(batch, "text"):
                ids = np.frombuffer(encoder.encode(text), "<i4").tolist()
                sizes.append(len(ids))
                listed.append(hashlib.sha256(b" ".join(map(decimal, ids))).hexdigest())
                decoded.append(hashlib.sha256(b"".join(map(token, ids))).hexdigest())
            doc_ids = batch.column("doc_id")
            return {"doc_id": doc_ids, "n_tokens": sizes, "ids_sha256": listed, "decoded_sha256": decoded}

        return each

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return arrow_pass(docs.select(F.col("doc_id").cast("long"), "text"), work, schema)
