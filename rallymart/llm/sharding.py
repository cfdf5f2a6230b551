"""Sharding by a weighted hash tree: region, rack and shard are drawn one after the other.

At every node each child draws `ln(u) / weight`, where u in (0, 1] comes from a hash of the key and
the child's name, and the largest draw takes the row. A child gets its share by weight, and a
changed weight alters only that child's draw: rows move between it and its siblings, never among
siblings whose weights stay. So below a node whose children keep their weights nothing moves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import numbered, stage

ROOT = "top"
#: Leaves are named by their shard number; other nodes by any text.
Tree = dict[str, list[tuple[str, float]]]
LEVELS = 3


def topology(weights: dict[int, float], racks: int = 2, shards: int = 3) -> Tree:
    """A tree with `shards` shards in a rack and `racks` racks in a region, in order of number.

    Every node weighs what its shards weigh together.
    """
    tree: Tree = {ROOT: []}
    for shard, weight in sorted(weights.items()):
        region, rack = f"region{shard // (racks * shards)}", f"rack{shard // shards}"
        for parent, child in ((ROOT, region), (region, rack), (rack, str(shard))):
            tree.setdefault(parent, [])
            known = dict(tree[parent])
            known[child] = known.get(child, 0.0) + weight
            tree[parent] = list(known.items())
    return tree


def grown(tree: Tree, shard: int, weight: float = 1.0) -> Tree:
    """The tree with one more shard, in a region and rack of its own.

    So only the root gets a new child, and rows move into the new shard or stay.
    """
    region, rack = f"region-of-{shard}", f"rack-of-{shard}"
    more = {region: [(rack, weight)], rack: [(str(shard), weight)]}
    return {**tree, ROOT: [*tree[ROOT], (region, weight)], **more}


def _drawn(parent: Column, key: Column, tree: Tree) -> Column:
    """The child of `parent` with the largest draw; `parent` holds names of one level."""
    children = F.create_map(
        *[
            x
            for node, below in tree.items()
            for x in (
                F.lit(node),
                F.array(
                    *[
                        F.struct(F.lit(name).alias("name"), F.lit(float(weight)).alias("weight"))
                        for name, weight in below
                        if weight > 0
                    ]
                ),
            )
        ]
    )

    def draw(child: Column) -> Column:
        bits = F.shiftrightunsigned(F.xxhash64(F.concat_ws(":", key, child["name"])), 11)
        return F.struct(
            (F.log((bits + F.lit(1)) / F.lit(2.0**53)) / child["weight"]).alias("draw"),
            child["name"].alias("name"),
        )

    return F.array_max(F.transform(children[parent], draw))["name"]


def shard_of(key: Column, tree: Tree) -> Column:
    """The shard for a key given as text; a null key counts as empty text."""
    levels = [{ROOT: tree[ROOT]}]
    for _ in range(LEVELS - 1):
        levels.append({name: tree[name] for below in levels[-1].values() for name, _ in below})
    node = F.lit(ROOT)
    for level in levels:
        node = _drawn(node, key, level)
    return node.cast("int")


def shard_documents(docs: DataFrame, shards: int = 24) -> DataFrame:
    """All documents in `shards` shards of equal weight, and where one more shard would put them.

    Law `key`: doc_id and the number of shards decide, and one more shard takes rows only into
    itself. `slot` numbers a shard's rows by doc_id. Null text has no bytes (size 8, checksum 0),
    a null doc_id is drawn as empty text, repeated rows get slots of their own, an empty table
    gives no rows, other columns are not read.
    """
    tree = topology({n: 1.0 for n in range(shards)})
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    text = F.coalesce(F.col("text"), F.lit(""))
    placed = docs.select(
        "doc_id",
        (F.octet_length(text).cast("long") + F.lit(8)).alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        shard_of(key, tree).alias("shard"),
        shard_of(key, grown(tree, shards)).alias("grown_shard"),
    )
    rows = numbered(stage(placed, "shards"), "shard", ["doc_id", "text_crc32", "size"], "slot")
    return rows.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )
