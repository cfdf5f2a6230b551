"""Stored tables: Parquet folders under one root per layer."""

from __future__ import annotations

from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Layout:
    """How a table lies in files.

    A folder for each value of `partition_by`. Rows with the same `cluster_by` lie together, in as
    many files as they need, and files are sorted by `cluster_by` and `sort_by`, so that row groups
    hold few values of each and filters skip the others. Row groups have Bloom filters for `lookups`.
    """

    partition_by: tuple[str, ...] = ()
    cluster_by: tuple[str, ...] = ()
    sort_by: tuple[str, ...] = ()
    lookups: tuple[str, ...] = ()
    row_group_bytes: int | None = None

    def arranged(self, df: DataFrame) -> DataFrame:
        """The rows in place for writing, by one exchange and a sort of each partition.

        The rebalance hint lets Spark even out file sizes: small partitions are merged and a
        large one is split, also one of a single skewed value.
        """
        placed = df.hint("rebalance", *self.partition_by, *self.cluster_by)
        order = [*self.partition_by, *self.cluster_by, *self.sort_by]
        return placed.sortWithinPartitions(*order) if self.cluster_by or self.sort_by else placed

    def options(self) -> dict[str, str]:
        """What the Parquet writer is told; Bloom filters get the size their values need."""
        options = {f"parquet.bloom.filter.enabled#{name}": "true" for name in self.lookups}
        if self.lookups:
            options["parquet.bloom.filter.adaptive.enabled"] = "true"
        if self.row_group_bytes:
            options["parquet.block.size"] = str(self.row_group_bytes)
        return options


# Matches are read by season, and by scopes: finished ones of some countries. Loads and lookups
# ask for single matches and teams.
SILVER_LAYOUT = {
    "matches": Layout(
        partition_by=("league_season",),
        cluster_by=("description", "country_name"),
        sort_by=("match_id",),
        lookups=("match_id", "homeTeam_id", "awayTeam_id"),
    )
}


def table_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}.parquet"


def read_table(
    spark: SparkSession, root: str, name: str, schema: T.StructType | str | None = None
) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(table_path(root, name))


def write_table(
    df: DataFrame,
    root: str,
    name: str,
    partition_by: tuple[str, ...] = (),
    layout: Layout | None = None,
) -> int:
    """Replace a table and return its row count, counted by the write itself."""
    layout = layout or Layout(partition_by)
    rows = Observation()
    counted = layout.arranged(df.observe(rows, F.count(F.lit(1)).alias("rows")))
    writer = counted.write.mode("overwrite").options(**layout.options())
    if layout.partition_by:
        writer = writer.partitionBy(*layout.partition_by)
    writer.parquet(table_path(root, name))
    try:
        return rows.get["rows"]
    except Py4JJavaError:
        # An empty plan observes nothing; then the written files say so.
        return df.sparkSession.read.schema(df.schema).parquet(table_path(root, name)).count()


def export_tables(
    spark: SparkSession, root: str, target: str, names: tuple[str, ...]
) -> dict[str, int]:
    """Copy tables to a hand-off folder, with their row counts."""
    return {name: write_table(read_table(spark, root, name), target, name) for name in names}
