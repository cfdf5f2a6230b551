"""League tables, final series and strength levels.

Both standings start from one aggregate per team and league-season, small next to the matches.
All rankings of a league-season then share one exchange. Where there are enough matches for a
league-season to outgrow a task, the aggregate is written once and its group sizes decide how
it is ranked.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rallymart.functions import rules
from rallymart.operators.ranking import by_group_size, group_totals, hot_groups, hot_limit, row_numbers
from rallymart.operators.sides import (
    StoredSides,
    has_few_sides,
    melt_sides,
    of_teams,
    team_id,
    team_name,
    with_gaps,
)
from rallymart.sources.staging import stage

SEASON = "league_season_id"
GRID_SLOTS = 200

DOMESTIC_NAMES = {
    **{level: rules.STRENGTH_NAMES[level] for level in range(1, 6)},
    6: "regular_season",
}


def standing_sides(matches: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Result, points and sets of each side, with the stage flags of the match."""
    return melt_sides(
        with_gaps(matches),
        keep={
            SEASON: rules.season_key(),
            **{name: name for name in keep},
            "in_finals": rules.holds(rules.in_broad_finals("match_week")),
            "real_final": rules.holds(rules.is_real_final("match_week")),
            "for_bronze": rules.holds(rules.mentions("match_week", "3rd place")),
            "quarter": rules.holds(rules.mentions("match_week", "Quarter")),
        },
        per_side={
            "team_id": team_id,
            "has_won": lambda side: rules.flag(rules.won_match(side)),
            "points": rules.match_points,
            "won": rules.sets_won,
            "lost": rules.sets_lost,
        },
    )


def _sum_where(condition: str, value: str) -> str:
    return f"sum(if({condition}, {value}, 0L))"


# Aggregates over group-stage rows, on the columns of `standing_sides`.
GROUP_STAGE = {
    "group_games": "count_if(NOT in_finals)",
    "games_won": _sum_where("NOT in_finals", "has_won"),
    "match_points": _sum_where("NOT in_finals", "points"),
    "sets_won": _sum_where("NOT in_finals", "won"),
    "sets_lost": _sum_where("NOT in_finals", "lost"),
}


def _series(name: str, played: str) -> dict[str, str]:
    return {
        f"{name}_games": f"count_if({played})",
        f"{name}_wins": _sum_where(played, "has_won"),
        f"{name}_points": _sum_where(played, "points"),
        f"{name}_balance": _sum_where(played, "won - lost"),
    }


FINALS_STAGE = {
    **_series("final", "real_final"),
    **_series("bronze", "for_bronze"),
    "quarter_games": "count_if(quarter)",
}


def _ranked(
    teams: DataFrame,
    matches: DataFrame | StoredSides,
    name: str,
    rank: Callable[[DataFrame, int], DataFrame],
) -> DataFrame:
    """The team rows ranked per league-season; where these could outgrow a task, by their sizes."""
    if has_few_sides(matches, hot_limit(matches.sparkSession)):
        return rank(teams, 0)
    written = stage(teams, name)
    return by_group_size(written, [SEASON], hot_groups(written, [SEASON]), rank)


def _aggregates(columns: dict[str, str]) -> list[Column]:
    return [F.expr(f"{text} AS {name}") for name, text in columns.items()]


def table_order(names: tuple[str, ...] = ()) -> list[Column]:
    """League-table order; the team id settles full ties, and names those of one team."""
    order = [F.desc("games_won"), F.desc("match_points"), F.desc("set_ratio"), F.asc("team_id")]
    return order + [F.asc(name) for name in names]


# --- domestic leagues -------------------------------------------------------------------

# What tells the rows of a team apart that plays one league-season under several names.
TEAM_NAMES = ("league_id", "league_name", "country_code")

def domestic_teams(matches: DataFrame | StoredSides) -> DataFrame:
    """Group-stage and series totals per team, league-season and league and country name."""
    league = ("league_id", "league_name", "country_code", "league_season")
    series = {f"own_{name}": text for name, text in FINALS_STAGE.items()}
    totals = {**GROUP_STAGE, **series, "side_rows": "count(1)"}

    def per_team(part: DataFrame) -> DataFrame:
        sides = standing_sides(part.filter(rules.country_scope()), league)
        return sides.groupBy("team_id", *league, SEASON).agg(*_aggregates(totals))

    return of_teams(matches, per_team).withColumn("set_ratio", F.expr(rules.ratio("sets_won", "sets_lost")))


def _series_order(name: str) -> list[Column]:
    return [
        F.desc(f"{name}_wins"),
        F.desc(f"{name}_points"),
        F.desc(f"{name}_balance"),
        F.asc("prelim_position"),
        F.asc("team_id"),
    ]


def rank_domestic(teams: DataFrame, blocks: int) -> DataFrame:
    """Positions in the group table, in both series and overall."""
    teams = group_totals(
        teams,
        [SEASON],
        {"season_sides": "side_rows", "total_teams_this_season": rules.flag("group_games > 0")},
        blocks,
    )
    # Two side rows make one match, and a season with one match is no league.
    teams = teams.filter("season_sides <> 2").withColumn("in_table", F.expr("group_games > 0"))
    # A series counts for the team under whatever name it was played, once per team.
    of_team = [SEASON, "team_id"]
    shared = {name: f"own_{name}" for name in FINALS_STAGE}
    teams = group_totals(teams, of_team, {**shared, "table_rows": rules.flag("in_table")}, blocks)
    names = [F.desc("in_table"), *[F.asc(name) for name in TEAM_NAMES]]
    teams = (
        row_numbers(teams, names, {"row_of_team": of_team}, [SEASON], blocks)
        .filter("in_table OR (table_rows = 0 AND row_of_team = 1)")
        .selectExpr(
            "*",
            "final_games > 0 AS in_final",
            "bronze_games > 0 AS in_bronze",
            "row_of_team = 1 AS first_row",
        )
    )
    teams = row_numbers(
        teams, table_order(TEAM_NAMES), {"table_place": [SEASON, "in_table"]}, [SEASON], blocks
    ).withColumn("prelim_position", F.expr("if(in_table, table_place, NULL)"))
    # Teams are ranked, not their names: one row per team takes part, and its place holds for all.
    places = {}
    for name in ("final", "bronze"):
        place = {f"own_{name}_place": [SEASON, f"in_{name}", "first_row"]}
        teams = row_numbers(teams, _series_order(name), place, [SEASON], blocks)
        places[f"{name}_place"] = f"if(first_row, own_{name}_place, 0)"
    teams = group_totals(teams, of_team, places, blocks)
    bucket = (
        "CASE WHEN in_final AND final_place <= 2 THEN final_place "
        "WHEN in_bronze AND bronze_place <= 2 THEN bronze_place + 2 "
        "WHEN quarter_games > 0 THEN 5L END"
    )
    teams = teams.filter("in_table").selectExpr(
        "*", f"{bucket} AS finalist_bucket", f"coalesce({bucket}, 6L) AS strength_level"
    )
    order = [F.asc("strength_level"), F.asc("prelim_position")]
    return row_numbers(teams, order, {"final_rank": [SEASON]}, [SEASON], blocks)


def ranked_domestic(matches: DataFrame | StoredSides) -> DataFrame:
    return _ranked(domestic_teams(matches), matches, "domestic-teams", rank_domestic)


def fct_national_standings(matches: DataFrame | StoredSides) -> DataFrame:
    return ranked_domestic(matches).selectExpr(
        f"{SEASON} AS League_season_id",
        "league_id",
        "country_code AS Country_id",
        "team_id AS Team_id",
        f"{rules.season_text()} AS league_season",
        "prelim_position",
        "total_teams_this_season",
        "games_won",
        "group_games - games_won AS games_lost",
        "match_points",
        "sets_won",
        "sets_lost",
        "set_ratio",
        "final_rank",
        "finalist_bucket",
        "strength_level",
        f"{rules.strength_name('strength_level', DOMESTIC_NAMES)} AS strength_cluster",
    )


# --- world competitions -----------------------------------------------------------------


def world_teams(matches: DataFrame | StoredSides) -> DataFrame:
    """Group-stage totals and medal counts per team and edition."""
    totals = {
        **GROUP_STAGE,
        "finals_games": "count_if(in_finals)",
        "finals_won": "count_if(real_final AND has_won = 1)",
        "finals_lost": "count_if(real_final AND has_won = 0)",
        "bronzes_won": "count_if(for_bronze AND has_won = 1)",
        "bronzes_lost": "count_if(for_bronze AND has_won = 0)",
        "quarter_games": "count_if(quarter)",
    }

    def per_team(part: DataFrame) -> DataFrame:
        sides = standing_sides(part.filter(rules.world_scope()))
        return sides.groupBy(SEASON, "team_id").agg(*_aggregates(totals))

    return of_teams(matches, per_team).withColumn("set_ratio", F.expr(rules.ratio("sets_won", "sets_lost")))


# 1 gold to 7, on the columns of `rank_world`. The top half of n teams is the integer half.
MEDAL_LEVEL = (
    "CASE WHEN finals_won > 0 THEN 1L WHEN finals_lost > 0 THEN 2L "
    "WHEN bronzes_won > 0 THEN 3L WHEN bronzes_lost > 0 THEN 4L WHEN quarter_games > 0 THEN 5L "
    "WHEN eliminated AND elim_rank <= n_elim div 2 THEN 6L ELSE 7L END"
)


def rank_world(teams: DataFrame, blocks: int) -> DataFrame:
    """Group-table position and strength level of the teams that played group matches."""
    teams = teams.filter("group_games > 0").selectExpr("*", "finals_games = 0 AS eliminated")
    teams = group_totals(teams, [SEASON], {"n_elim": rules.flag("eliminated")}, blocks)
    teams = row_numbers(
        teams,
        table_order(),
        {"prelim_position": [SEASON], "elim_rank": [SEASON, "eliminated"]},
        [SEASON],
        blocks,
    )
    return teams.withColumn("strength_level", F.expr(MEDAL_LEVEL))


def ranked_world(matches: DataFrame | StoredSides) -> DataFrame:
    return _ranked(world_teams(matches), matches, "world-teams", rank_world)


def eligible_teams(matches: DataFrame, countries: DataFrame) -> DataFrame:
    """National teams whose country has a domestic league of the same category."""
    league_homes = (
        matches.filter(rules.real_country("country_name"))
        .selectExpr("country_code", f"{rules.narrow_naipe_of('league_name')} AS naipe")
        .distinct()
    )
    names = melt_sides(matches, {}, {"team_id": team_id, "name": team_name}).distinct()
    real = countries.filter(rules.real_country("country_name")).selectExpr(
        "country_name AS plain_name", "country_code"
    )
    return (
        names.selectExpr(
            "team_id",
            f"{rules.narrow_naipe_of('name')} AS naipe",
            f"{rules.without_women('name')} AS plain_name",
        )
        .join(real, "plain_name")
        .join(league_homes, ["country_code", "naipe"], "left_semi")
        .select("team_id", "naipe")
        .distinct()
    )


def editions(matches: DataFrame) -> DataFrame:
    return (
        matches.filter(rules.world_scope())
        .selectExpr(
            f"{rules.season_key()} AS {SEASON}", f"{rules.naipe_of('league_name')} AS naipe"
        )
        .distinct()
    )


def expected_entries(teams: DataFrame, tournaments: DataFrame) -> DataFrame:
    """Every eligible team with every edition of its category: the rows of the result.

    There are only two categories, so the teams are spread over slots and the editions, few
    next to them, are repeated per slot; no task holds a whole category.
    """
    spread = teams.selectExpr("*", f"CAST(pmod(xxhash64(team_id), {GRID_SLOTS}) AS INT) AS slot")
    repeated = tournaments.selectExpr("*", f"explode(sequence(0, {GRID_SLOTS - 1})) AS slot")
    return spread.join(repeated, ["naipe", "slot"]).select("team_id", SEASON)


def fct_intern_standings(matches: DataFrame | StoredSides, countries: DataFrame) -> DataFrame:
    ranked = ranked_world(matches)
    if isinstance(matches, StoredSides):
        matches = matches.matches()
    entries = expected_entries(eligible_teams(matches, countries), editions(matches))
    level = "coalesce(strength_level, 8L)"
    return entries.join(ranked, ["team_id", SEASON], "left").selectExpr(
        f"{SEASON} AS League_season_id",
        "team_id AS Team_id",
        "prelim_position AS rank_position",
        *[
            f"coalesce({name}, 0L) AS {name}"
            for name in ("games_won", "match_points", "sets_won", "sets_lost")
        ],
        "set_ratio",
        f"{level} AS strength_level",
        f"{rules.strength_name(level)} AS strength_cluster",
    )
