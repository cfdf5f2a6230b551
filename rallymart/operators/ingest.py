"""Keyed upserts and incremental selection over landed documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rallymart.operators.reshape import column

# Key columns of each upserted entity.
UPSERT_KEYS = {
    "countries": ("code",),
    "matches": ("id",),
    "teams": ("id",),
    "team_stats": ("team_id", "leagueId", "season"),
    "standings": ("leagueId", "season"),
}


def upsert(
    old: DataFrame, new: DataFrame, keys: tuple[str, ...], load_order: tuple[str, ...] = ()
) -> DataFrame:
    """One document per key: the new one where there is one, the last of several.

    `load_order` names columns whose largest value is the latest document of a load; it is needed
    where a load can hold a key twice. Columns that only one side has are NULL on the other. A
    document without a key is an error. Only the first of each key is asked for, so Spark cuts
    every key down before the shuffle and a frequent key stays small.
    """
    both = old.withColumn("_load", F.lit(0)).unionByName(
        new.withColumn("_load", F.lit(1)), allowMissingColumns=True
    )
    given = [
        F.coalesce(column(k), F.raise_error(F.lit(f"a document without {k}")).cast(both.schema[k].dataType))
        for k in keys
    ]
    latest = Window.partitionBy(*given).orderBy(
        F.col("_load").desc(),
        *[column(c).desc() for c in load_order],
        F.xxhash64(*[column(c) for c in both.columns]).desc(),
    )
    return (
        both.withColumn("_place", F.row_number().over(latest))
        .filter(F.col("_place") == 1)
        .drop("_load", "_place")
    )


def pending_seasons(
    catalogue: DataFrame, saved: DataFrame, league: str = "league_id", season: str = "league_season"
) -> DataFrame:
    """League-seasons still to fetch: those not saved, and each league's latest in any case."""
    wanted = catalogue.select(league, season).distinct()
    # Distinct before the join: the saved documents are many, their seasons few.
    done = saved.select(league, season).distinct()
    newest = wanted.groupBy(league).agg(F.max(season).alias(season))
    return wanted.join(done, [league, season], "left_anti").union(
        newest.join(done, [league, season], "left_semi")
    )


def pending_leagues(catalogue: DataFrame, saved: DataFrame, league: str = "league_id") -> DataFrame:
    """Leagues with no saved document at all."""
    done = saved.select(league).distinct()
    return catalogue.select(league).distinct().join(done, league, "left_anti")


def first_match(df: DataFrame, condition: Column) -> DataFrame:
    """A document that meets the condition, as a frame of one row or none."""
    return df.filter(condition).limit(1)


def require_match(df: DataFrame, condition: Column, what: str) -> DataFrame:
    """Like `first_match`, but an error where there is none."""
    found = first_match(df, condition)
    if found.isEmpty():
        raise ValueError(f"no {what} found")
    return found


def stamp(df: DataFrame, **constants) -> DataFrame:
    """Constant columns that tell which request a batch came from."""
    return df.withColumns({name: F.lit(value) for name, value in constants.items()})


def of_league(df: DataFrame, league: Column | str | int, name: str = "league.id") -> DataFrame:
    """Only the documents of the league that was asked for; a feed may add those of others."""
    return df.filter(F.col(name) == (league if isinstance(league, Column) else F.lit(league)))


def distinct_team_ids(matches: DataFrame, home: str = "homeTeam.id", away: str = "awayTeam.id") -> DataFrame:
    """Ids on either side of the matches that have both sides."""
    return (
        matches.filter(F.col(home).isNotNull() & F.col(away).isNotNull())
        .select(F.explode(F.array(F.col(home), F.col(away))).alias("team_id"))
        .distinct()
    )


def first_day(df: DataFrame, date: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """Earliest date as `yyyy-MM-dd` text, per key if keys are given."""
    earliest = F.substring(F.min(F.col(date)).cast("string"), 1, 10).alias("first_day")
    return df.groupBy(*keys).agg(earliest)
