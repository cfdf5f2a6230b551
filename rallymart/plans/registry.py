"""The gold marts by name, what each reads, and a run in dependency order."""

from __future__ import annotations

import inspect
from collections.abc import Callable, Iterable, Mapping
from graphlib import TopologicalSorter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rallymart.operators.ranking import with_ordinals
from rallymart.plans import aggregation, dims, matches, side_table, standings, team_stats
from rallymart.sources.tables import read_table, write_table

SILVER = ("leagues", "matches", "teams", "team_stats", "standings", "countries")

MARTS: dict[str, Callable[..., DataFrame]] = {
    mart.__name__: mart
    for mart in (
        dims.dim_naipe,
        dims.dim_countries,
        dims.dim_leagues,
        dims.dim_logos,
        dims.dim_season,
        dims.dim_teams,
        dims.dim_team_by_season,
        matches.fct_intern_matches,
        matches.fct_national_matches,
        matches.fct_intern_matches_melted_by_team,
        matches.fct_national_matches_melted_by_team,
        team_stats.fct_intern_team_stats,
        team_stats.fct_national_team_stats,
        standings.fct_intern_standings,
        standings.fct_national_standings,
        aggregation.fct_aggregation,
    )
}

# Order in which each mart is shown; a leading minus is descending.
DISPLAY_ORDER = {
    "dim_leagues": ("League_id",),
    "dim_season": ("league_id", "league_season"),
    "dim_teams": ("country_id",),
    "fct_intern_matches": ("Match_id",),
    "fct_national_matches": ("Match_id",),
    "fct_intern_matches_melted_by_team": ("league_season_id", "match_id", "Team_id"),
    "fct_national_matches_melted_by_team": ("match_id", "Team_id"),
    "fct_intern_team_stats": ("Team_id", "league_season_id"),
    "fct_national_team_stats": ("Team_id", "league_season_id"),
    "fct_intern_standings": ("League_season_id", "strength_level", "rank_position"),
    "fct_national_standings": ("League_season_id", "final_rank"),
    "fct_aggregation": ("league_naipe", "nat_team_strenght", "-avg_tight_sets", "-qtd_clubs"),
}


def _display_keys(name: str) -> list[Column]:
    """Missing values first where a key ascends and last where it descends, as Spark sorts."""
    keys = DISPLAY_ORDER.get(name, ())
    return [F.desc(k[1:]) if k.startswith("-") else F.asc(k) for k in keys]


def in_display_order(name: str, mart: DataFrame) -> DataFrame:
    """A mart sorted for showing. Stored tables are not sorted; a reader that cares sorts."""
    keys = _display_keys(name)
    return mart.orderBy(*keys) if keys else mart


def with_display_place(name: str, mart: DataFrame) -> DataFrame:
    """A mart with each row's place in its display order; rows equal in that by their other columns.

    The place is stored with the rows, so any reader can page through a mart without sorting it.
    """
    keys = _display_keys(name)
    return with_ordinals(mart, [*keys, *[F.asc(c) for c in mart.columns]], "display_place")


def export_in_display_order(
    spark: SparkSession, root: str, target: str, names: Iterable[str] | None = None
) -> dict[str, int]:
    """Copy marts to a hand-off folder with their display places; returns their row counts."""
    return {
        name: write_table(with_display_place(name, read_table(spark, root, name)), target, name)
        for name in (MARTS if names is None else names)
    }


def inputs_of(name: str) -> tuple[str, ...]:
    """Tables a mart reads: its parameters that name a silver table or another mart."""
    parameters = inspect.signature(MARTS[name]).parameters
    return tuple(p for p in parameters if p in SILVER or p in MARTS)


def run_order(names: Iterable[str] | None = None) -> list[str]:
    """The named marts and all they need, each after its inputs."""
    wanted, graph = list(MARTS if names is None else names), {}
    while wanted:
        name = wanted.pop()
        if name not in MARTS:
            raise KeyError(f"no mart {name}")
        if name not in graph:
            graph[name] = [i for i in inputs_of(name) if i in MARTS]
            wanted += graph[name]
    return list(TopologicalSorter(graph).static_order())


def build(spark: SparkSession, name: str, tables: Mapping[str, DataFrame]) -> DataFrame:
    """A mart over the given tables; marts it needs that are not given are built first."""
    built: dict[str, DataFrame] = {}
    for step in run_order([name]):
        if step in tables and step != name:
            built[step] = tables[step]
            continue
        given = {i: built[i] if i in built else tables[i] for i in inputs_of(step)}
        if "spark" in inspect.signature(MARTS[step]).parameters:
            given["spark"] = spark
        built[step] = MARTS[step](**given)
    return built[name]


def run_gold(
    spark: SparkSession,
    silver: Mapping[str, DataFrame],
    root: str,
    names: Iterable[str] | None = None,
) -> dict[str, int]:
    """Write the marts in dependency order; a mart on marts reads the stored ones.

    Matches are read once, to store their sides by team; every mart reads those.
    """
    tables, rows, order = dict(silver), {}, run_order(names)
    of_sides: dict[str, object] = {}
    if any("matches" in inputs_of(name) for name in order):
        sides = side_table.store_sides(silver["matches"])
        tables["matches"], of_sides["matches"] = sides.matches(), sides
        if any("team_stats" in inputs_of(name) for name in order):
            of_sides["team_stats"] = side_table.beside(sides, silver["team_stats"])
    for name in order:
        given = {**tables, **of_sides} if name in side_table.READERS else tables
        with side_table.placed_by_team(spark, given.get("matches")):
            rows[name] = write_table(build(spark, name, given), root, name)
        tables[name] = read_table(spark, root, name)
    return rows
