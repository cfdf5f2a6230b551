"""One row per country and category, over the finished marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rallymart.functions import rules


def mean_of(kind: str) -> str:
    """Mean of the pre-summed parts of one kind, exact for whole numbers."""
    of_kind = f"FILTER (WHERE kind = '{kind}')"
    return f"CAST(sum(part_total) {of_kind} AS DOUBLE) / nullif(sum(part_rows) {of_kind}, 0L)"


def mean_in_group(kind: str) -> str:
    """The same; a missing country or category equals no other, so it takes nothing from other facts."""
    return f"if(country_id IS NULL OR league_naipe IS NULL, NULL, {mean_of(kind)})"


def _parts(column: str) -> list:
    return [F.expr(f"sum({column}) AS part_total"), F.expr(f"count({column}) AS part_rows")]


def fct_aggregation(
    dim_leagues: DataFrame,
    dim_season: DataFrame,
    dim_teams: DataFrame,
    fct_national_matches: DataFrame,
    fct_intern_standings: DataFrame,
    fct_national_standings: DataFrame,
) -> DataFrame:
    leagues = dim_leagues.selectExpr(
        "League_id AS league_id", "league_naipe", "country_id AS league_country"
    )
    # Left, as everywhere here: a season without a known league keeps its row.
    season_league = dim_season.selectExpr("League_season_id AS season_key", "league_id").join(
        leagues, "league_id", "left"
    )
    # The facts are put on top of each other, so that all three meet the league-seasons in one join.
    strength = fct_intern_standings.join(dim_teams.select("Team_id", "country_id"), "Team_id", "left").selectExpr(
        "'strength' AS kind",
        "League_season_id AS season_key",
        "country_id AS team_country",
        "CAST(NULL AS STRING) AS club",
        "CAST(strength_level AS BIGINT) AS part_total",
        "if(strength_level IS NULL, 0L, 1L) AS part_rows",
    )
    clubs = fct_national_standings.selectExpr(
        "'club' AS kind",
        "League_season_id AS season_key",
        "CAST(NULL AS STRING) AS team_country",
        "Team_id AS club",
        "0L AS part_total",
        "0L AS part_rows",
    )
    tight = (
        fct_national_matches.groupBy(F.expr("league_season_id AS season_key"))
        .agg(*_parts("n_tight_sets"))
        .selectExpr(
            "'tight' AS kind",
            "season_key",
            "CAST(NULL AS STRING) AS team_country",
            "CAST(NULL AS STRING) AS club",
            "part_total",
            "part_rows",
        )
    )
    # Parts are summed before the distinct counts, which read each row several times.
    parts = (
        strength.unionByName(clubs)
        .unionByName(tight)
        .join(season_league, "season_key", "left")
        .groupBy(
            F.expr("if(kind = 'strength', team_country, league_country) AS country_id"),
            "league_naipe",
            "kind",
            F.expr("if(kind = 'club', league_id, NULL) AS club_league"),
            "club",
        )
        .agg(F.sum("part_total").alias("part_total"), F.sum("part_rows").alias("part_rows"))
    )
    return (
        parts.groupBy("country_id", "league_naipe")
        .agg(
            F.expr("count_if(kind = 'club') AS club_rows"),
            F.countDistinct("club_league").alias("qtd_national_leagues"),
            F.countDistinct("club").alias("qtd_clubs"),
            F.expr(f"{mean_in_group('strength')} AS strength"),
            F.expr(f"{mean_in_group('tight')} AS avg_tight_sets"),
        )
        .filter("club_rows > 0")
        .selectExpr(
            f"{rules.key_of('country_id', 'league_naipe')} AS country_naipe_id",
            "country_id",
            "league_naipe",
            "coalesce(strength, 8D) AS nat_team_strenght",
            "qtd_national_leagues",
            "qtd_clubs",
            "avg_tight_sets",
        )
    )
