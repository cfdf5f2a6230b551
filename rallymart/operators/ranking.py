"""Row numbers and group totals that hold when one group has most of the rows.

A window function sends each group to one task. That is the cheapest plan for small groups, so
groups of more than `spark.rallymart.hotGroupRows` rows are found first, from counts made before
any shuffle, and only their rows take another way: they are range-partitioned on group and order
into blocks of about that size, so a large group spreads over many tasks and its row numbers
are put together from per-block counts. All other rows go through the plain window. Both give the
same numbers.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rallymart.sources.staging import stage

HOT_ROWS_SETTING = "spark.rallymart.hotGroupRows"
HOT_ROWS_DEFAULT = 5_000_000
MOST_BLOCKS = 20_000  # blocks only grow beyond this
PARTITION_ROWS = 500_000  # of ordinary groups in one task, near enough
MOST_SENT = 100_000  # rows of keys or offsets that are sent to every task

_BLOCK = "_block"
_ROWS = "_rows"


def hot_limit(spark: SparkSession) -> int:
    """Most rows that a window group may have."""
    return int(spark.conf.get(HOT_ROWS_SETTING, str(HOT_ROWS_DEFAULT)))


@dataclass(frozen=True)
class HotGroups:
    """The keys of the groups that outgrow a task, how many they are, and blocks for their rows."""

    keys: DataFrame
    groups: int
    blocks: int


def hot_groups(df: DataFrame, keys: list[str]) -> HotGroups | None:
    """The groups with more than the allowed rows, counted exactly; None if there are none.

    Counts are made before the shuffle, and two numbers reach the driver. There are at most as many
    hot groups as the rows hold times the limit.
    """
    limit = hot_limit(df.sparkSession)
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(_ROWS)).filter(F.col(_ROWS) > limit)
    groups, rows = sizes.agg(F.count(F.lit(1)), F.sum(_ROWS)).first()
    if not groups:
        return None
    blocks = min(max(2, math.ceil(rows / limit)), MOST_BLOCKS)
    return HotGroups(stage(sizes.drop(_ROWS), "hot-groups"), groups, blocks)


def by_group_size(
    df: DataFrame, keys: list[str], hot: HotGroups | None, work: Callable[[DataFrame, int], DataFrame]
) -> DataFrame:
    """`work(rows, blocks)` on the rows of ordinary groups with no blocks, and on those of hot groups.

    `work` must treat each group of `keys` by itself.
    """
    if hot is None:
        return work(df, 0)
    ordinary, large = without_and_with(df, keys, hot)
    return work(ordinary, 0).unionByName(work(large, hot.blocks))


def without_and_with(df: DataFrame, keys: list[str], hot: HotGroups) -> tuple[DataFrame, DataFrame]:
    """The rows of ordinary groups, and those of hot ones."""
    sent = _sent(hot.keys, hot.groups)
    return join_null_safe(df, sent, keys, "left_anti"), join_null_safe(df, sent, keys, "left_semi")


def _sent(df: DataFrame, rows: int) -> DataFrame:
    """With a hint to send it to every task, if it is known to be small."""
    return F.broadcast(df) if rows <= MOST_SENT else df


def spread(df: DataFrame, keys: list[str], most: int) -> DataFrame:
    """The rows by keys, in partitions that fit a task's sorts where `most` rows would need several.

    Spark joins small partitions by their bytes in the shuffle. Rows that repeat few values are much
    larger in a sort, and windows of several orders hold two sorts at a time.
    """
    if most <= PARTITION_ROWS:
        return df
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(min(max(least, math.ceil(most / PARTITION_ROWS)), MOST_BLOCKS), *keys)


def row_numbers(
    df: DataFrame,
    order: list[Column],
    numbers: dict[str, list[str]],
    within: list[str],
    blocks: int,
) -> DataFrame:
    """Add row numbers that share one order.

    `numbers` maps each new column to the columns it is numbered within; every such list
    contains the columns of `within`, so one exchange on `within` serves them all. `order`
    must be a total order inside each group. `blocks` comes from `blocks_needed`.
    """
    if blocks:
        return _numbers_by_range(df, order, numbers, within, blocks)
    for name, keys in numbers.items():
        window = Window.partitionBy(*keys).orderBy(*order)
        df = df.withColumn(name, F.row_number().over(window).cast("bigint"))
    return df


def group_totals(
    df: DataFrame, keys: list[str], totals: dict[str, str], blocks: int
) -> DataFrame:
    """Add group sums of SQL expressions to every row of the group."""
    if not blocks:
        over = f"OVER (PARTITION BY {', '.join(keys)})"
        return df.selectExpr("*", *[f"sum({text}) {over} AS {n}" for n, text in totals.items()])
    sums = df.groupBy(*keys).agg(*[F.expr(f"sum({text}) AS {n}") for n, text in totals.items()])
    return join_null_safe(df, sums, keys)


def join_null_safe(df: DataFrame, other: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on keys where a missing key meets a missing key; keys come from the left side."""
    renamed = other.withColumnsRenamed({key: f"_right_{key}" for key in keys})
    same = reduce(and_, [F.col(key).eqNullSafe(F.col(f"_right_{key}")) for key in keys])
    return df.join(renamed, same, how).drop(*[f"_right_{key}" for key in keys])


def _numbers_by_range(
    df: DataFrame,
    order: list[Column],
    numbers: dict[str, list[str]],
    within: list[str],
    blocks: int,
) -> DataFrame:
    """Rows are placed in blocks once and one table of offsets serves all numbers."""
    columns = df.columns
    ranges = df.repartitionByRange(blocks, *[F.col(key) for key in within], *order)
    # The block ids must be the same for everyone who reads them, hence the written table.
    placed = stage(ranges.withColumn(_BLOCK, F.spark_partition_id()), "rank-blocks")
    finest = list(dict.fromkeys(key for keys in numbers.values() for key in keys))
    # One row per block and group, far fewer than the rows: what earlier blocks hold of its groups.
    offsets = placed.groupBy(*finest, _BLOCK).agg(F.count(F.lit(1)).alias(_ROWS))
    for name, keys in numbers.items():
        of_group = Window.partitionBy(*keys).orderBy(_BLOCK)
        # All rows of the group up to this block, less those of the block itself.
        upto = F.sum(_ROWS).over(of_group.rangeBetween(Window.unboundedPreceding, Window.currentRow))
        own = F.sum(_ROWS).over(Window.partitionBy(*keys, _BLOCK))
        offsets = offsets.withColumn(f"_before_{name}", upto - own)
    known = stage(offsets.drop(_ROWS), "rank-offsets")
    result = placed.repartition(_BLOCK)
    for name, keys in numbers.items():
        local = Window.partitionBy(_BLOCK, *keys).orderBy(*order)
        result = result.withColumn(name, F.row_number().over(local).cast("bigint"))
    result = join_null_safe(result, _sent(known, known.count()), [*finest, _BLOCK])
    totals = {name: F.col(name) + F.col(f"_before_{name}") for name in numbers}
    return result.withColumns(totals).select(*columns, *numbers)


def with_ordinals(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Add each row's place, from 1, in a total order over all rows; no task holds them all.

    Rows are range-partitioned and sorted, numbered within their partition, and shifted by what
    earlier partitions hold: one small row for each partition.
    """
    places = F.monotonically_increasing_id()
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(name, places)
    placed = stage(ranged, "ordinals").withColumn(_BLOCK, F.shiftright(name, 33))
    sizes = placed.groupBy(_BLOCK).agg(F.count(F.lit(1)).alias(_ROWS))
    earlier = Window.orderBy(_BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(_BLOCK, F.coalesce(F.sum(_ROWS).over(earlier), F.lit(0)).alias("_before"))
    local = F.col(name).bitwiseAND(F.lit(2**33 - 1))
    return placed.join(offsets, _BLOCK).withColumn(name, local + F.col("_before") + 1).drop(_BLOCK, "_before")
