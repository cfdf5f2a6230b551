"""Near-duplicates by SimHash: 64-bit fingerprints of word shingles, linked through BK-trees.

A BK-tree holds fingerprints; a node's children are keyed by their Hamming distance to it. A
search within radius r that is d away from a node only follows the edges d - r to d + r.

One tree over all fingerprints would grow with the corpus and could be neither sent to every task
nor searched in one. So the fingerprints are cut into shards that hold a tree each: of four
16-bit blocks, two fingerprints with at most two differing bits agree in at least two, and every
pair of blocks with its 32 bits names a shard. A shard with more than `MOST_IN_SHARD`
fingerprints is cut again, by pairs of the four 8-bit blocks that are left; what has the
same 48 bits is at most 2**16 fingerprints, so that is the bound of every tree. Each tree meets
all queries it can answer, the fingerprints of its own shard.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import arrow_pass, components, small, stage, texts, unused

SHINGLE = 3
SEED = 42
RADIUS = 2
MOST_IN_SHARD = 4096
#: The bits of every byte value, lowest bit first.
_BITS = (np.arange(256)[:, None] >> np.arange(8) & 1).astype("int64")


def fingerprint(text: str) -> int:
    """The SimHash of a text's lower-cased word shingles, as unsigned 64 bits."""
    words = text.encode().lower().split()
    if not words:
        return 0
    if len(words) < SHINGLE:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(SHINGLE)), strict=False))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(s, SEED) for s in shingles), "<u8")
    if len(hashes) < 256:
        places = hashes.view("u1").reshape(-1, 8)
        set_in = _BITS[places].sum(axis=0).ravel()
    else:
        places = hashes.view("u1").reshape(-1, 8)
        set_in = np.concatenate([np.bincount(places[:, i], minlength=256) @ _BITS for i in range(8)])
    return int(np.packbits(set_in * 2 > len(hashes), bitorder="little").view("<u8")[0])


class BKTree:
    """Fingerprints as unsigned whole numbers; children by Hamming distance."""

    def __init__(self) -> None:
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def within(self, value: int, radius: int) -> Iterator[int]:
        """The places of all values at most `radius` bits away."""
        waiting = [0] if self.values else []
        while waiting:
            node = waiting.pop()
            distance = (self.values[node] ^ value).bit_count()
            if distance <= radius:
                yield node
            below = self.children[node]
            for edge in range(distance - radius, distance + radius + 1):
                if edge in below:
                    waiting.append(below[edge])

    def add(self, value: int) -> None:
        place = len(self.values)
        node, last = 0 if self.values else None, None
        while node is not None:
            last, edge = node, (self.values[node] ^ value).bit_count()
            node = self.children[node].get(edge)
        self.values.append(value)
        self.children.append({})
        if last is not None:
            self.children[last][edge] = place


def linked(values: list[int], radius: int = RADIUS) -> list[tuple[int, int]]:
    """Each value but the first of its group, with that first one; groups by links in one tree."""
    tree, first = BKTree(), list(range(len(values)))

    def top(i: int) -> int:
        while first[i] != i:
            first[i] = first[first[i]]
            i = first[i]
        return i

    for i, value in enumerate(values):
        for j in tree.within(value, radius):
            a, b = top(i), top(j)
            if a != b:
                first[max(a, b)] = min(a, b)
        tree.add(value)
    return [(value, values[top(i)]) for i, value in enumerate(values) if top(i) != i]


def _blocks(value: Column, base: int, width: int) -> list[Column]:
    """For each pair of the four blocks of `width` bits above bit `base`, a name and their bits."""
    mask = F.lit(2**width - 1)
    cut = [F.shiftrightunsigned(value, base + width * i).bitwiseAND(mask) for i in range(4)]
    return [
        F.struct(
            F.lit(10 * i + j).alias("pair"),
            F.shiftleft(cut[i], width).bitwiseOR(cut[j]).alias("bits"),
        )
        for i, j in combinations(range(4), 2)
    ]


def _fine(pair: int) -> list[Column]:
    """The second cut: pairs of 8-bit blocks of the two 16-bit blocks that `pair` does not name."""
    low, high = (i for i in range(4) if i not in divmod(pair, 10))
    rest = F.shiftleft(F.shiftrightunsigned("fp", 16 * high).bitwiseAND(F.lit(0xFFFF)), 16).bitwiseOR(
        F.shiftrightunsigned("fp", 16 * low).bitwiseAND(F.lit(0xFFFF))
    )
    return _blocks(rest, 0, 8)


def link_fingerprints(prints: DataFrame, most: int = MOST_IN_SHARD) -> DataFrame:
    """From distinct `fp` (long): links `a`, `b` that connect what lies within the radius."""
    coarse = prints.select("fp", F.inline(F.array(*_blocks(F.col("fp"), 0, 16))))
    sizes = coarse.groupBy("pair", "bits").count().where("count > 1")
    shards = stage(coarse.join(sizes, ["pair", "bits"]), "shards")
    small = shards.where(F.col("count") <= most).select("*", F.lit(-1).alias("fine"), F.lit(0).cast("long").alias("more"))
    pairs = [10 * i + j for i, j in combinations(range(4), 2)]
    cuts = F.coalesce(*[F.when(F.col("pair") == p, F.array(*_fine(p))) for p in pairs])
    large = shards.where(F.col("count") > most).select("*", F.inline(cuts).alias("fine", "more"))
    trees = (
        small.union(large)
        .groupBy("pair", "bits", "fine", "more")
        .agg(F.sort_array(F.collect_list("fp")).alias("fps"))
        .where(F.size("fps") > 1)
    )

    def work():
        def each(batch: pa.RecordBatch) -> dict:
            found = [
                link
                for fps in batch.column("fps").to_pylist()
                for link in linked([x % 2**64 for x in fps])
            ]
            both = np.array(found, "uint64").reshape(-1, 2).view("int64")
            return {"a": both[:, 0], "b": both[:, 1]}

        return each

    return arrow_pass(trees.select("fps"), work, "a long, b long").distinct()


def fingerprinted(docs: DataFrame, name: str = "fp") -> DataFrame:
    """`docs` with the fingerprint of its texts, as a signed long."""
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            prints = np.array([fingerprint(x) for x in texts(batch, "text")], "uint64").view("int64")
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(prints)], names=[*batch.schema.names, name]
            )

    return docs.mapInArrow(run, schema)


def classes(rows: DataFrame) -> DataFrame:
    """For each fp of `rows` (doc_id, fp): the root of its class and its own smallest doc_id."""
    prints = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "prints")
    roots = components(link_fingerprints(prints.select("fp")))
    return prints.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint and component_id, the smallest doc_id that links lead to, of every row.

    Null and empty texts have the fingerprint zero, which links like any other. Rows with equal
    texts, or the same doc_id, stay rows of their own. A component whose doc_ids are all null has
    a null component_id. An empty table gives no rows; other columns are not read.
    """
    source = docs.select(F.col("doc_id").cast("long"), "text")
    rows = stage(fingerprinted(source).select("doc_id", "fp"), "simhash")
    rooted = classes(rows)
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rows.join(rooted.join(smallest, "root").select("fp", "component_id"), "fp").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def deduplicated(docs: DataFrame) -> DataFrame:
    """One row of each component, that with the smallest doc_id (null only where all are null).

    Of rows that share this doc_id, one of those with the smallest fingerprint stays. Texts are
    moved once, by doc_id and fingerprint, so a large group of copies is spread.
    """
    fp, key = unused(docs, "fp"), unused(docs, "id_key")
    rows = stage(fingerprinted(docs, fp), "fingerprinted")
    first = F.min(F.struct(F.col("least").isNull(), "least", "fp"))
    prints = rows.select("doc_id", F.col(fp).alias("fp"))
    kept = classes(prints).groupBy("root").agg(first.alias("first"))
    kept = kept.select(F.col("first.fp").alias(fp), _id_key(F.col("first.least")).alias(key))
    one = rows.withColumn(key, _id_key(F.col("doc_id"))).join(kept, [fp, key], "left_semi")
    return one.dropDuplicates([fp, key]).select(*docs.columns)


def _id_key(doc_id: Column) -> Column:
    return F.coalesce(doc_id.cast("string"), F.lit("none"))
