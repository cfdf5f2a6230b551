"""What several operators need: tables, Arrow passes, numbering in groups, linked components."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterable, Iterator
from types import ModuleType

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rallymart.sources.staging import stage


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows that a task holds at once, with what it makes of them.
ROWS_AT_ONCE = 1024


def small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in pieces, one of no rows for an empty one."""
    for batch in batches:
        for at in range(0, max(1, batch.num_rows), ROWS_AT_ONCE):
            yield batch.slice(at, ROWS_AT_ONCE)


def arrow_pass(
    df: DataFrame,
    work: Callable[[], Callable[[pa.RecordBatch], dict[str, list | np.ndarray | pa.Array]]],
    schema: str,
) -> DataFrame:
    """Batches of `df` through a function; `work` is called once per task and gives that function.

    The function returns a column for every name in `schema`.
    """
    kinds = T._parse_datatype_string(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        shape = to_arrow_schema(kinds)
        each = work()
        for batch in small(batches):
            columns = each(batch)
            yield pa.record_batch(
                [
                    columns[f.name].cast(f.type)
                    if isinstance(columns[f.name], pa.Array)
                    else pa.array(columns[f.name], type=f.type)
                    for f in shape
                ],
                schema=shape,
            )

    return df.mapInArrow(run, kinds)


def sent(spark: SparkSession, value) -> Callable[[], object]:
    """Broadcasts a value with the code of its class; the result gives it inside a task."""
    shared = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: cloudpickle.loads(shared.value)


def kept(name: str, make: Callable[[], object]):
    """What `make` gives, once for each Python worker and kept from task to task."""
    place = sys.modules.setdefault("_kept_by_this_worker", ModuleType("_kept_by_this_worker"))
    if name not in place.__dict__:
        setattr(place, name, make())
    return getattr(place, name)


def texts(batch: pa.RecordBatch, name: str) -> list[str]:
    """The column's texts, null as empty."""
    return [x or "" for x in batch.column(name).to_pylist()]


def unused(df: DataFrame, name: str) -> str:
    """`name`, made longer until `df` has no such column."""
    known = {c.lower() for c in df.columns}
    while name in known:
        name += "_"
    return name


def numbered(df: DataFrame, group: str, order: Iterable[str], name: str) -> DataFrame:
    """`df` with a number from 0, without gaps, in each `group` (a whole number), by `order`.

    Groups of any size: rows are range-partitioned and sorted on group and order, each partition
    numbers its own rows, and what earlier partitions hold of a group is added afterwards. That
    small table has at most one row for each partition and group boundary, so it is broadcast.
    Rows that are equal in group and order are interchangeable. `df` is read twice (once for the
    range bounds), so it should be a narrow, written table.
    """
    keys = [group, *order]
    ranged = df.repartitionByRange(*[F.col(k).asc_nulls_first() for k in keys])
    ranged = ranged.sortWithinPartitions(*[F.col(k).asc_nulls_first() for k in keys])
    schema = T.StructType(
        [*df.schema.fields, T.StructField("_part", T.LongType()), T.StructField("_at", T.LongType())]
    )

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, seen = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            groups = batch.column(group).to_numpy(zero_copy_only=False)
            starts = np.concatenate([[0], np.flatnonzero(groups[1:] != groups[:-1]) + 1])
            lengths = np.diff(np.append(starts, n))
            at = np.arange(n) - np.repeat(starts, lengths)
            if groups[0] == last:
                at[: lengths[0]] += seen
            last, seen = groups[-1], int(at[-1]) + 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(n, part, "int64")), pa.array(at.astype("int64"))],
                names=[*batch.schema.names, "_part", "_at"],
            )

    local = stage(ranged.mapInArrow(number, schema), "numbered")
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        local.groupBy(group, "_part")
        .agg(F.count("*").alias("_rows"))
        .select(group, "_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    )
    return local.join(F.broadcast(offsets), [group, "_part"]).select(
        *df.columns, (F.col("_at") + F.col("_before")).alias(name)
    )


def components(edges: DataFrame) -> DataFrame:
    """Of links `a`, `b` (long): `node`, `root` with the smallest node that can be reached.

    Alternating large-star and small-star steps (Kiveris et al., Connected Components in
    MapReduce and Beyond, 2014): every step replaces links by links to smaller nodes, until
    each node is linked to its root alone. Steps are written to the shared folder. A hot node
    is only ever aggregated by minimum and joined, which Spark combines early and can split.
    """
    links = edges.where("a <> b").select(
        F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")
    )
    links = stage(links.distinct(), "links")
    seen = None
    while True:
        state = links.agg(
            F.count("*").alias("n"),
            F.coalesce(F.sum(F.xxhash64("hi", "lo").cast("decimal(20,0)")), F.lit(0)).alias("mark"),
        ).first()
        if state.n == 0 or state == seen:
            return links.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
        seen = state
        both = links.union(links.select("lo", "hi")).toDF("u", "v")
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = (
            both.where("v > u")
            .join(least, "u")
            .select(F.col("v").alias("hi"), F.least("u", "m").alias("lo"))
            .distinct()
        )
        smallest = large.groupBy("hi").agg(F.min("lo").alias("m"))
        moved = large.join(smallest, "hi")
        small = moved.select(
            F.inline(
                F.array(
                    F.struct(F.col("hi").alias("hi"), F.col("m").alias("lo")),
                    F.struct(F.col("lo").alias("hi"), F.col("m").alias("lo")),
                )
            )
        )
        links = stage(small.where("hi <> lo").distinct(), "links")


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
