"""Schemas of the silver tables, as far as the marts read them."""

from __future__ import annotations

from rallymart.functions.rules import SETS, SIDES

_scores = ", ".join(
    f"{prefix}_{side}_team_score BIGINT" for prefix in ("current", *SETS) for side in SIDES
)

# Table -> schema text, as spark.read.schema and createDataFrame take it.
SILVER_SCHEMAS = {
    "matches": (
        "match_id STRING, league_id STRING, league_name STRING, league_season BIGINT, "
        "country_code STRING, country_name STRING, match_week STRING, match_date TIMESTAMP_NTZ, "
        "description STRING, homeTeam_id STRING, awayTeam_id STRING, homeTeam_name STRING, "
        f"awayTeam_name STRING, {_scores}"
    ),
    "leagues": (
        "league_id STRING, league_name STRING, league_season BIGINT, country_code STRING, "
        "country_name STRING"
    ),
    "teams": "team_id STRING, team_name STRING, team_logo STRING",
    "countries": "country_code STRING, country_name STRING, country_logo STRING",
    "team_stats": (
        "league_id STRING, team_id STRING, league_season BIGINT, total_games_played BIGINT, "
        "total_games_wins BIGINT, total_games_loses BIGINT, total_points_scored BIGINT, "
        "total_points_received BIGINT"
    ),
    "standings": (
        "leagueId STRING, league_season BIGINT, season_name STRING, standing_position BIGINT, "
        "games_played BIGINT, scored_points BIGINT, received_points BIGINT"
    ),
}
