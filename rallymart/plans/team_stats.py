"""Season statistics per team, league and season."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rallymart.functions import rules
from rallymart.operators.sides import StoredSides, melt_sides, of_teams, team_id, with_gaps

# Stage counted by exact name -> output column.
STAGE_COLUMNS = {
    "Final": "total_finals",
    "Semi-finals": "total_semi_finals",
    "3rd place": "total_3rd_place_dispute",
    "Quarter-finals": "total_4r_finals_appearances",
}
MIN_TIGHT_SETS = 3

# What one match adds to its team's season, over the columns of `_team_sides`.
SIDE_COUNTS = {
    **{name: rules.flag(f"match_week = '{stage}'") for stage, name in STAGE_COLUMNS.items()},
    "total_games_5_sets": rules.flag("fifth_score IS NOT NULL"),
    "n_3_x_0_wins": rules.flag("won AND fourth_score IS NULL"),
    **{f"set_{i}_win": f"took_{i}" for i in range(1, len(rules.SETS) + 1)},
    "n_tight_games_won": rules.flag(f"won AND n_tight >= {MIN_TIGHT_SETS}"),
}


def _team_sides(matches: DataFrame) -> DataFrame:
    fourth, fifth = rules.SETS[3], rules.SETS[4]
    return melt_sides(
        with_gaps(matches),
        keep={
            "league_id": "league_id",
            "league_season": rules.season_text(),
            "match_week": "match_week",
            "n_tight": rules.tight_sets(),
        },
        per_side={
            "team_id": team_id,
            "won": rules.won_match,
            "fourth_score": lambda side: rules.set_score(fourth, side),
            "fifth_score": lambda side: rules.set_score(fifth, side),
            **{
                f"took_{i}": (lambda side, gap=gap: rules.flag(rules.took_set(gap, side)))
                for i, gap in enumerate(rules.GAPS, start=1)
            },
        },
    )


def _team_stats(
    in_scope: DataFrame | StoredSides, leagues: DataFrame, team_stats: DataFrame, scope_join: str
) -> DataFrame:
    if scope_join not in ("inner", "semi"):
        raise ValueError(f"scope_join is inner or semi, not {scope_join!r}")
    counts = [F.expr(f"sum({text}) AS {name}") for name, text in SIDE_COUNTS.items()]
    key = ("league_id", "team_id", "league_season")
    per_league = of_teams(in_scope, lambda matches: _team_sides(matches).groupBy(*key).agg(*counts))
    # A match meets every catalogue row of its league. Multiplying sums by the number of
    # rows gives the same counts without repeating the matches.
    times = "count(1)" if scope_join == "inner" else "1L"
    repeats = leagues.groupBy("league_id").agg(F.expr(f"{times} AS repeats"))
    per_team = (
        per_league.join(repeats, "league_id")
        .groupBy("team_id", "league_season")
        .agg(*[F.expr(f"sum({name} * repeats) AS {name}") for name in SIDE_COUNTS])
    )
    stats = team_stats.withColumn("league_season", F.expr(rules.season_text()))
    return stats.join(per_team, ["team_id", "league_season"], "left").selectExpr(
        "team_id AS Team_id",
        f"{rules.key_of('league_id', 'league_season')} AS league_season_id",
        "league_id",
        "league_season",
        "total_games_played AS season_games_played",
        "total_games_wins AS season_games_won",
        "total_games_loses AS season_games_lost",
        "total_points_scored AS points_scored",
        "total_points_received AS points_received",
        "total_points_scored - total_points_received AS points_delta",
        *[f"coalesce({name}, 0L) AS {name}" for name in SIDE_COUNTS],
    )


def fct_intern_team_stats(
    matches: DataFrame | StoredSides, leagues: DataFrame, team_stats: DataFrame, scope_join: str = "inner"
) -> DataFrame:
    """World-competition counts beside every row of `team_stats`.

    `scope_join="inner"` counts a match once per catalogue row of its league, `"semi"` once.
    """
    in_scope = matches.filter(rules.world_leagues_scope())
    return _team_stats(in_scope, leagues, team_stats, scope_join)


def fct_national_team_stats(
    matches: DataFrame | StoredSides, leagues: DataFrame, team_stats: DataFrame, scope_join: str = "inner"
) -> DataFrame:
    """As above, with the scope tested on the country of the catalogue row."""
    domestic = leagues.filter(rules.real_country("country_name"))
    return _team_stats(matches.filter(rules.is_finished()), domestic, team_stats, scope_join)
