"""The stored table of sides that a full run of the marts reads in place of the matches.

One pass over the matches writes a row for each side, bucketed by team. Recency windows, sums of a
team and joins with other tables of teams then start from files that lie right already, without an
exchange. Teams that would outgrow a task are kept in a table of their own, without buckets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from rallymart.functions import rules
from rallymart.operators.ranking import without_and_with
from rallymart.operators.sides import SIDE, TEAM, StoredSides, melt_sides, side_name, team_id
from rallymart.plans.matches import hot_teams
from rallymart.sources.schemas import SILVER_SCHEMAS
from rallymart.sources.staging import stage, stage_bucketed

# Marts that work on the sides of single teams.
READERS = (
    "fct_intern_matches_melted_by_team",
    "fct_national_matches_melted_by_team",
    "fct_intern_team_stats",
    "fct_national_team_stats",
    "fct_intern_standings",
    "fct_national_standings",
)

BUCKET_ROWS_SETTING = "spark.rallymart.sideBucketRows"
BUCKET_ROWS_DEFAULT = 2_000_000  # rows of some 30 narrow columns, a few 100 MB unpacked
MOST_BUCKETS = 20_000  # buckets only grow beyond this
CO_PARTITION = "spark.sql.requireAllClusterKeysForCoPartition"


def buckets_for(spark: SparkSession, rows: int) -> int:
    """As many buckets as keep them near the wanted rows, and every core of a stage at work."""
    wanted = int(spark.conf.get(BUCKET_ROWS_SETTING, str(BUCKET_ROWS_DEFAULT)))
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return min(max(least, math.ceil(rows / wanted)), MOST_BUCKETS)


def store_sides(matches: DataFrame) -> StoredSides:
    """Both sides of every match, finished or not, with the columns the marts read.

    The matches are read once; where they have more sides than a task should, their team ids are
    read before that, to know which teams are hot.
    """
    spark = matches.sparkSession
    rows = 2 * matches.count()
    known = [f.name for f in T.StructType.fromDDL(SILVER_SCHEMAS["matches"]) if f.name in matches.columns]
    sides = melt_sides(matches, {name: name for name in known}, {TEAM: team_id, SIDE: side_name})
    hot = hot_teams(matches)
    ordinary, large = (sides, None) if hot is None else without_and_with(sides, [TEAM], hot)
    return StoredSides(
        stage_bucketed(ordinary, TEAM, buckets_for(spark, rows), ("country_name",), "sides"),
        None if large is None else stage(large, "sides-of-hot-teams"),
        rows,
        0 if hot is None else hot.blocks,
    )


def buckets_of(sides: StoredSides) -> int:
    return buckets_for(sides.sparkSession, sides.rows)


def beside(sides: StoredSides, df: DataFrame) -> DataFrame:
    """A table with a team_id, stored in buckets that match those of the sides."""
    if sides.hot is not None:
        return df
    return stage_bucketed(df, TEAM, buckets_of(sides), (), "beside-sides")


@contextmanager
def placed_by_team(spark: SparkSession, source: object) -> Iterator[None]:
    """While planning on stored sides, joins on the team and more keys may stay in its buckets.

    By default Spark shuffles both inputs of a join by all of its keys, as one of them alone may be
    skewed. That no team is too large for a task is known here, unless there are hot ones.
    """
    if not isinstance(source, StoredSides) or source.hot is not None:
        yield
        return
    before = spark.conf.get(CO_PARTITION, None)
    spark.conf.set(CO_PARTITION, "false")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CO_PARTITION)
        else:
            spark.conf.set(CO_PARTITION, before)
