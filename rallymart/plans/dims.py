"""Dimensions. Matches are reduced to their distinct keys before any join."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rallymart.functions import rules
from rallymart.operators.reshape import distinct_rows
from rallymart.operators.sides import melt_sides, team_id

# The two sex categories and their numbers.
NAIPES = ((1, "Men"), (2, "Women"))


def dim_naipe(spark: SparkSession) -> DataFrame:
    rows = ", ".join(f"({number}L, '{name}')" for number, name in NAIPES)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS naipes(naipe_id, team_naipe)")


def dim_countries(countries: DataFrame) -> DataFrame:
    naipes = ", ".join(f"'{name}'" for _, name in NAIPES)
    return (
        countries.filter(rules.real_country("country_name"))
        .selectExpr("country_code", "country_name", "country_logo", f"explode(array({naipes})) AS naipe")
        .selectExpr(
            f"{rules.key_of('country_code', 'naipe')} AS country_naipe_id",
            "country_code AS Country_id",
            "country_name",
            "country_logo",
        )
    )


def dim_leagues(leagues: DataFrame, matches: DataFrame) -> DataFrame:
    domestic = matches.filter(rules.real_country("country_name"))
    home_country = (
        distinct_rows(domestic, "league_id", "country_code")
        .groupBy("league_id")
        .agg(F.max("country_code").alias("home_code"))
    )
    catalogue = leagues.selectExpr(
        "league_id",
        f"{rules.without_women('league_name')} AS league_name",
        f"{rules.naipe_of('league_name')} AS league_naipe",
    ).distinct()
    return (
        catalogue.join(home_country, "league_id", "left")
        .selectExpr("*", "coalesce(home_code, 'World') AS country_id")
        .filter(f"country_id <> 'World' OR {rules.in_world_leagues('league_name')}")
        .selectExpr(
            "league_id AS League_id",
            "league_name",
            "if(country_id = 'World', 'International', 'National') AS geo_aggreg",
            "league_naipe",
            "country_id",
        )
    )


def dim_logos(teams: DataFrame, countries: DataFrame) -> DataFrame:
    cleaned = teams.selectExpr(
        "team_id", "team_logo", f"{rules.without_category('team_name')} AS country_name"
    ).distinct()
    logos = countries.select("country_name", "country_logo")
    return cleaned.join(logos, "country_name", "left").selectExpr(
        "team_id AS Team_id", "coalesce(country_logo, team_logo) AS logo_final"
    )


def league_seasons(leagues: DataFrame, matches: DataFrame) -> DataFrame:
    """First and last date and real-final flag per known league and season."""
    played = matches.groupBy("league_id", "league_season").agg(
        F.min("match_date").alias("season_start_date"),
        F.max("match_date").alias("last_match_date"),
        F.expr(f"max({rules.flag(rules.is_real_final('match_week'))}) AS has_final"),
    )
    return played.join(leagues, ["league_id", "league_season"], "left_semi")


def dim_season(leagues: DataFrame, matches: DataFrame) -> DataFrame:
    seasons = league_seasons(leagues, matches)
    # Being older than the league's newest season implies being older than the newest season
    # of all, so the second test covers both and no per-league window is needed.
    newest = seasons.agg(F.max("league_season")).scalar()
    return (
        seasons.withColumn("newest", newest)
        .selectExpr(
            f"{rules.key_of('league_id', 'league_season')} AS League_season_id",
            "league_id",
            "league_season",
            "season_start_date",
            "if(has_final = 1 OR league_season < newest, last_match_date, NULL) AS season_end_date",
        )
        .selectExpr(
            "*", "if(season_end_date IS NULL, 'Not Finished', 'Finished') AS season_status"
        )
    )


def team_countries(matches: DataFrame, countries: DataFrame, leagues: DataFrame) -> DataFrame:
    """Largest domestic country code per team, and the league name that goes with it."""
    sides = melt_sides(
        matches,
        keep={"league_id": "league_id", "country_code": "country_code"},
        per_side={"team_id": team_id},
    )
    presences = distinct_rows(sides, "league_id", "country_code", "team_id")
    real_codes = (
        countries.filter(rules.real_country("country_name"))
        .selectExpr("country_code", "country_code AS real_code")
        .distinct()
    )
    names = (
        distinct_rows(leagues, "league_id", "league_name")
        .groupBy("league_id")
        .agg(F.max("league_name").alias("league_name"))
    )
    return (
        presences.join(real_codes, "country_code", "left")
        .join(names, "league_id", "left")
        .groupBy("team_id")
        .agg(
            # The coalesce ranks a missing code lowest; plain max_by would skip it.
            F.expr("max_by(league_name, struct(coalesce(real_code, ''), league_name)) AS league_name"),
            F.max("real_code").alias("country_code"),
        )
    )


def dim_teams(
    matches: DataFrame, countries: DataFrame, leagues: DataFrame, teams: DataFrame
) -> DataFrame:
    own_country = countries.filter(rules.real_country("country_name")).selectExpr(
        "country_name AS team_name", "country_code AS own_code"
    )
    return (
        teams.selectExpr("team_id", f"{rules.without_women('team_name')} AS team_name")
        .join(team_countries(matches, countries, leagues), "team_id", "left")
        .join(own_country, "team_name", "left")
        .selectExpr(
            "team_id AS Team_id",
            "team_name",
            f"{rules.naipe_of('league_name')} AS team_naipe",
            "if(own_code IS NOT NULL, 'National Team', 'Club') AS team_type",
            "coalesce(own_code, country_code) AS country_id",
        )
        .filter("country_id IS NOT NULL")
        .selectExpr(f"{rules.key_of('country_id', 'team_naipe')} AS country_naipe_id", "*")
    )


def dim_team_by_season(
    fct_intern_matches_melted_by_team: DataFrame, fct_national_matches_melted_by_team: DataFrame
) -> DataFrame:
    pair = ("league_season_id", "Team_id AS team_id")
    return (
        fct_intern_matches_melted_by_team.selectExpr(*pair)
        .union(fct_national_matches_melted_by_team.selectExpr(*pair))
        .distinct()
    )
