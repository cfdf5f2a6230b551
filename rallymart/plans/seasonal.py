"""Marts that are kept by season: a load only computes and writes the seasons it changes.

The rows of these marts depend on the matches of their own league-season alone. The others do not:
recency orders number all matches of a team, world standings have a row for every team that any
match makes eligible, and dimensions look at all seasons, so those are always built whole.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rallymart.plans.parts import season_of
from rallymart.plans.registry import build
from rallymart.sources.tables import SILVER_LAYOUT, Layout, read_table, table_path, write_table
from rallymart.sources.versions import Files

# Mart -> the column that ends in the season.
SEASONAL = {
    "fct_intern_matches": "league_season_id",
    "fct_national_matches": "league_season_id",
    "fct_national_standings": "League_season_id",
}


def changed_seasons(stored: DataFrame, loaded: DataFrame) -> list[int]:
    """Seasons that a load of matches changes: those it names, and those its matches were in before.

    Both have match_id and league_season. The driver gets one number for each season.
    """
    before = stored.join(loaded.select("match_id").distinct(), "match_id", "left_semi")
    both = before.select("league_season").union(loaded.select("league_season")).distinct()
    return sorted(r[0] for r in both.collect() if r[0] is not None)


def write_seasons(
    silver: DataFrame, root: str, name: str, seasons: Iterable[int] | None = None
) -> None:
    """Write the rows of these seasons, all if none are named, into a table laid out by league_season."""
    _replace(silver, root, name, SILVER_LAYOUT.get(name, Layout(("league_season",))), seasons)


def _replace(df: DataFrame, root: str, name: str, layout: Layout, seasons: Iterable[int] | None) -> None:
    spark, path = df.sparkSession, table_path(root, name)
    (column,) = layout.partition_by
    if seasons is None:
        write_table(df, root, name, layout=layout)
        return
    rows = layout.arranged(df).write.mode("overwrite").options(**layout.options())
    rows.option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path)
    # A season that has lost all its rows is not written, so its folder is still the old one.
    wanted = [str(s) for s in seasons]
    kept = {str(r[0]) for r in df.select(column).distinct().collect()}
    files = Files(spark, path)
    for season in set(wanted) - kept:
        files.delete(f"{path}/{column}={season}")


def refresh_marts(
    spark: SparkSession, silver: Mapping[str, DataFrame], root: str, seasons: Iterable[int] | None = None
) -> None:
    """Compute the seasonal marts for these seasons, all if none are named, and write them in place.

    Only the folders of these seasons are read from matches that are laid out by season.
    """
    seasons = None if seasons is None else list(seasons)
    if seasons == []:
        return
    tables = dict(silver)
    if seasons is not None:
        tables["matches"] = silver["matches"].filter(F.col("league_season").isin(seasons))
    for name, key in SEASONAL.items():
        mart = build(spark, name, tables)
        _replace(mart.select("*", season_of(key)), root, name, Layout(("season",)), seasons)


def stored_mart(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A seasonal mart with the columns of the mart."""
    return read_table(spark, root, name).drop("season")
