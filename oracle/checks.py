"""DuckDB statements for the single rules and operators."""

from __future__ import annotations

from oracle.marts import (
    MART_SQL,
    CONTINENTS,
    DOMESTIC,
    DOMESTIC_TABLE,
    EDITIONS,
    ELIGIBLE,
    LEVELS,
    NOT_REAL,
    SEASON_DIM,
    TEAM_DIM,
    WORLD,
    WORLD_TABLE,
    naipe,
    narrow,
    plain,
)
from oracle.views import SETS, with_views

HOME_B = f"description = 'Finished' AND country_name NOT IN {NOT_REAL}"
KEY = "concat(league_id, '_', league_season)"

_set_flags = ", ".join(
    f"count(*) FILTER (WHERE set_no = {i} AND {test}) AS {side}_set_{i}"
    for i in range(1, 6)
    for side, test in (("home", "h > a"), ("away", "a > h"))
)
_score_text = {
    "current": "current",
    "firstSet": "firstSet",
    "secondSet": "second_set",
    "thirdSet": "third_set",
    "fourthSet": "fourth_set",
    "fifthSet": "fifth_set",
}
_score_columns = ",\n  ".join(
    f"{prefix}_home_team_score::VARCHAR || ' - ' || {prefix}_away_team_score::VARCHAR AS state_score_{text}"
    for text, prefix in _score_text.items()
)

CHECK_SQL = {
    "rule_points": with_views(
        """SELECT match_id, side AS team_side,
  CASE WHEN own > other THEN 3 - fifth WHEN own < other THEN fifth ELSE 0 END AS match_points FROM sides""",
        "sides",
    ),
    "rule_set_flags": with_views(
        f"""SELECT match_id, {_set_flags}, count(*) FILTER (WHERE h > a) AS home_sets,
  count(*) FILTER (WHERE a > h) AS away_sets FROM set_rows GROUP BY match_id""",
        "set_rows",
    ),
    "rule_tight_sets": with_views(
        """SELECT match_id, tight AS n_tight_sets, home_tight AS home_tight_sets, away_tight AS away_tight_sets
FROM set_totals""",
        "set_totals",
    ),
    "rule_winner": with_views(
        """SELECT match_id, if(current_home_team_score > current_away_team_score, homeTeam_id, awayTeam_id) AS match_winner
FROM matches""",
        "matches",
    ),
    "rule_total_sets": with_views("SELECT match_id, played AS total_sets FROM set_totals", "set_totals"),
    "rule_phase": with_views(
        """SELECT match_id,
  if(regexp_matches(match_week, 'final|3rd place', 'i'), 'Finals', 'Preliminary') AS phase,
  if(regexp_matches(match_week, 'final|3rd place|quarter|semi', 'i'), 'Finals', 'Preliminary') AS broad_phase,
  if(regexp_matches(match_week, 'final', 'i') AND NOT regexp_matches(match_week, 'semi|quarter', 'i'), 1, 0)::BIGINT
    AS real_final FROM matches""",
        "matches",
    ),
    "rule_category": with_views(
        f"""SELECT match_id, {naipe('league_name')} AS naipe, {narrow('league_name')} AS narrow_naipe,
  {plain('league_name')} AS plain_name FROM matches""",
        "matches",
    ),
    "rule_strength": with_views(
        f"""WITH {WORLD_TABLE}
SELECT league_season_id, team_id, pos AS prelim_position, strength_level,
  {LEVELS}[strength_level] AS strength_cluster FROM world_strength""",
        "standing_rows",
    ),
    "rule_series_rank": with_views(
        f"""WITH {DOMESTIC_TABLE}
SELECT league_season_id, team_id, final_pos, bronze_pos, bucket AS finalist_bucket FROM home_strength""",
        "standing_rows",
    ),
    "rule_eligible": with_views(
        f"WITH {ELIGIBLE} SELECT team_id, naipe FROM eligible", "sides", "countries"
    ),
    "rule_single_match_seasons": with_views(
        f"""SELECT {KEY} AS league_season_id, count(*) AS n_matches FROM matches WHERE {HOME_B}
GROUP BY ALL HAVING count(*) = 1""",
        "matches",
    ),
    "scope_world": with_views(f"SELECT match_id, league_name FROM matches WHERE {WORLD}", "matches"),
    "scope_national_a": with_views(
        f"SELECT match_id, country_code FROM matches WHERE {DOMESTIC}", "matches"
    ),
    "scope_national_b": with_views(
        f"SELECT match_id, country_name FROM matches WHERE {HOME_B}", "matches"
    ),
    "scope_national_c": with_views(
        f"""SELECT match_id, league_id, count(*) AS catalogue_rows FROM matches m JOIN leagues l USING (league_id)
WHERE m.description = 'Finished' AND l.country_name NOT IN {CONTINENTS} AND l.country_name <> 'World'
GROUP BY ALL""",
        "leagues",
    ),
    "const_rows": with_views(
        f"""WITH {TEAM_DIM}
SELECT naipe_id, v.team_naipe, count(team_id) AS n_teams
FROM (VALUES (1::BIGINT, 'Men'), (2::BIGINT, 'Women')) v(naipe_id, team_naipe)
LEFT JOIN team_dim d ON d.team_naipe = v.team_naipe GROUP BY ALL""",
        "sides",
        "leagues",
        "teams",
        "countries",
    ),
    "join_grid": with_views(
        f"WITH {ELIGIBLE}, {EDITIONS} SELECT team_id, league_season_id FROM eligible JOIN editions USING (naipe)",
        "sides",
        "countries",
    ),
    "join_anti": with_views(
        f"""SELECT match_id, {KEY} AS league_season_id FROM matches WHERE {HOME_B} AND {KEY} NOT IN
  (SELECT {KEY} FROM matches WHERE {HOME_B} GROUP BY ALL HAVING count(*) = 1)""",
        "matches",
    ),
    "join_two_keys": with_views(
        """SELECT match_id, m.league_id, m.league_season, l.league_name AS catalogue_name
FROM matches m JOIN leagues l ON m.league_id = l.league_id AND m.league_season = l.league_season""",
        "leagues",
    ),
    "join_left_filtered": with_views(
        f"""SELECT team_id, {plain('team_name')} AS plain_name, country_code FROM teams
LEFT JOIN countries ON country_name = {plain('team_name')} AND country_name NOT IN {NOT_REAL}""",
        "teams",
        "countries",
    ),
    "agg_any_flag": with_views(
        f"""WITH {SEASON_DIM}
SELECT league_id, league_season, first_date AS season_start_date, last_date AS last_match_date,
  has_final::BIGINT AS has_final FROM season_dim""",
        "leagues",
    ),
    "agg_ratio": with_views(
        f"""SELECT {KEY} AS league_season_id, team_id, sum(won_sets)::BIGINT AS sets_won,
  sum(lost_sets)::BIGINT AS sets_lost,
  sum(won_sets)::DOUBLE / nullif(sum(lost_sets), 0)::DOUBLE AS set_ratio FROM sides GROUP BY 1, 2""",
        "sides",
    ),
    "agg_max_by": with_views(
        f"WITH {TEAM_DIM} SELECT team_id, best_league AS league_name, code AS country_code FROM team_best",
        "sides",
        "leagues",
        "teams",
        "countries",
    ),
    "agg_count_distinct": with_views(
        """SELECT country_code, count(DISTINCT league_id) AS n_leagues, count(DISTINCT homeTeam_id) AS n_home_teams
FROM matches GROUP BY country_code""",
        "matches",
    ),
    "win_recency": with_views(
        """SELECT team_id, match_id, side AS team_side,
  row_number() OVER (PARTITION BY team_id ORDER BY match_date DESC, match_id, side) AS order_general,
  row_number() OVER (PARTITION BY team_id, league_id, league_season
                     ORDER BY match_date DESC, match_id, side) AS order_season FROM sides""",
        "sides",
    ),
    "win_partition_max": with_views(
        """SELECT DISTINCT league_id, league_season, max(league_season) OVER (PARTITION BY league_id) AS max_season
FROM matches""",
        "matches",
    ),
    "win_global_max": with_views(
        "SELECT DISTINCT league_id, league_season, max(league_season) OVER () AS global_max_season FROM matches",
        "matches",
    ),
    "win_group_count": with_views(
        f"""SELECT league_season_id, team_id, count(*) OVER (PARTITION BY league_season_id) AS n_teams
FROM (SELECT DISTINCT {KEY} AS league_season_id, team_id FROM sides)""",
        "sides",
    ),
    "set_union_distinct": with_views(
        f"""SELECT {KEY} AS league_season_id, team_id FROM sides WHERE match_week = 'Final'
UNION SELECT {KEY} AS league_season_id, team_id FROM sides WHERE {DOMESTIC}""",
        "sides",
    ),
    "melt_sides": with_views("SELECT match_id, team_id, side AS team_side, own AS score FROM sides", "sides"),
    "key_concat_nulls": with_views(
        "SELECT match_id, coalesce(match_week, '') || '_' || league_season::VARCHAR AS week_key FROM matches",
        "matches",
    ),
    "bronze_flatten": with_views(
        f"""SELECT match_id AS id, strftime(match_date, '%Y-%m-%dT%H:%M:%S') AS date, match_week AS week,
  league_id AS leagueId, league_season AS season, country_code, country_name, league_id, league_name,
  homeTeam_id, homeTeam_name, awayTeam_id, awayTeam_name, description AS state_description,
  {_score_columns} FROM matches""",
        "matches",
    ),
    "bronze_json_text": with_views(
        f"""SELECT match_id, '[' || array_to_string(list_transform(
  [{', '.join(f'{name}_home_team_score' for name in SETS)}], lambda x: coalesce(x::VARCHAR, 'null')), ',') || ']'
  AS home_sets FROM matches""",
        "matches",
    ),
    "bronze_event_props": "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS props_k FROM events",
    "silver_matches": with_views("SELECT * FROM matches", "matches"),
    "silver_split_scores": with_views(
        """SELECT match_id, current_home_team_score AS home_score, current_away_team_score AS away_score
FROM matches""",
        "matches",
    ),
    "silver_explode_seasons": with_views(
        "SELECT DISTINCT league_id, league_name, league_season AS season FROM leagues", "leagues"
    ),
    "silver_cast_rules": """SELECT l_orderkey::VARCHAR AS order_id, l_linenumber::BIGINT AS line_number,
  if(l_quantity = floor(l_quantity), l_quantity::BIGINT, NULL) AS quantity_score,
  if(l_discount = floor(l_discount), l_discount::BIGINT, NULL) AS discount_score,
  NULL::BIGINT AS flag_score, l_linestatus AS status_type,
  date_trunc('day', l_shipdate)::TIMESTAMP AS ship_date, NULL::TIMESTAMP AS bad_date FROM lineitem""",
    "upsert_last_wins": with_views(
        """SELECT homeTeam_id, league_id, league_season, match_id, match_date, description FROM matches
QUALIFY row_number() OVER (PARTITION BY homeTeam_id, league_id, league_season
  ORDER BY description = 'Finished' DESC, match_date DESC, match_id DESC) = 1""",
        "matches",
    ),
    "incremental_pending": with_views(
        """SELECT DISTINCT league_id, league_season FROM leagues
WHERE (league_id, league_season) NOT IN
  (SELECT (league_id, league_season) FROM matches WHERE description = 'Finished')
  OR (league_id, league_season) IN (SELECT (league_id, max(league_season)) FROM leagues GROUP BY league_id)""",
        "leagues",
    ),
    "incremental_leagues": with_views(
        """SELECT DISTINCT league_id FROM leagues
WHERE league_id NOT IN (SELECT league_id FROM matches WHERE match_week = 'Final')""",
        "leagues",
    ),
    "distinct_ids_two_cols": with_views(
        "SELECT homeTeam_id AS team_id FROM matches UNION SELECT awayTeam_id FROM matches", "matches"
    ),
    "first_day_by_league": with_views(
        "SELECT league_id, strftime(min(match_date), '%Y-%m-%d') AS first_day FROM matches GROUP BY league_id",
        "matches",
    ),
    "stamp_batch": with_views(
        "SELECT team_id, league_id, league_season, 'results' AS source, 1 AS batch_no FROM team_stats",
        "team_stats",
    ),
    "latest_match": with_views(
        """SELECT match_id, league_id, league_name FROM matches ORDER BY match_date DESC, matches.match_id DESC LIMIT 1""",
        "matches",
    ),
}

CHECK_SQL |= {
    "landed_round_trip": CHECK_SQL["silver_matches"],
    "read_pages": with_views(
        """SELECT match_id AS id, league_id AS "leagueId", league_season AS season, homeTeam_id AS home,
  description FROM matches""",
        "matches",
    ),
    "upsert_landed": with_views(
        """SELECT league_id AS "leagueId", league_season AS season,
  strftime(match_date, '%Y-%m-%dT%H:%M:%S') AS date, match_id, description FROM matches
QUALIFY row_number() OVER (PARTITION BY league_id, league_season
  ORDER BY description = 'Finished' DESC, match_date DESC, match_id DESC) = 1""",
        "matches",
    ),
    "upsert_small_load": with_views(
        """SELECT match_id AS id, league_id AS "leagueId", league_season AS season, homeTeam_id AS home,
  if(description = 'Finished', 'Finished', 'Corrected') AS description FROM matches""",
        "matches",
    ),
    "ledger_loads": with_views(
        """SELECT match_id AS id, league_id AS "leagueId",
  if(description = 'Finished', 'Finished', 'Corrected') AS description,
  (SELECT count(DISTINCT CAST(match_id AS BIGINT) // 400) FROM matches
    WHERE CAST(match_id AS BIGINT) // 400 % 2 = 0) AS files_0,
  (SELECT count(DISTINCT CAST(match_id AS BIGINT) // 400) FROM matches
    WHERE CAST(match_id AS BIGINT) // 400 % 2 = 1) AS files_1,
  (SELECT count(DISTINCT CAST(match_id AS BIGINT) // 400) FROM matches
    WHERE description IS DISTINCT FROM 'Finished') AS files_2,
  0::BIGINT AS files_3
FROM matches""",
        "matches",
    ),
    "page_faults": with_views(
        """WITH pages AS (
  SELECT CAST(match_id AS BIGINT) // 400 AS page, count(*) AS size FROM matches GROUP BY ALL),
ends AS (SELECT page, size, sum(size) OVER (ORDER BY page) AS stop FROM pages),
kept AS (SELECT *, lag(stop, 1, 0) OVER (ORDER BY page) AS expected FROM ends WHERE page % 5 <> 2)
SELECT 'broken' AS request, expected::BIGINT AS expected, (stop - size)::BIGINT AS found, 'missing' AS fault
FROM kept WHERE stop - size > expected
UNION ALL SELECT 'broken', max(stop)::BIGINT, NULL, 'no end' FROM kept""",
        "matches",
    ),
    "seasonal_standings": MART_SQL["fct_national_standings"],
    "recency_from_sides": MART_SQL["fct_national_matches_melted_by_team"],
    "team_stats_from_sides": MART_SQL["fct_national_team_stats"],
    "world_standings_from_sides": MART_SQL["fct_intern_standings"],
    "aggregation_from_parts": MART_SQL["fct_aggregation"],
    "display_places": f"""
WITH seasons AS ({MART_SQL["dim_season"]}), facts AS ({MART_SQL["fct_national_matches"]}),
tables AS ({MART_SQL["fct_national_standings"]}), nations AS ({MART_SQL["fct_aggregation"]})
SELECT 'dim_season' AS mart, "League_season_id" AS row_key,
  row_number() OVER (ORDER BY league_id NULLS FIRST, league_season NULLS FIRST) AS display_place FROM seasons
UNION ALL SELECT 'fct_national_matches', "Match_id", row_number() OVER (ORDER BY "Match_id") FROM facts
UNION ALL SELECT 'fct_national_standings', concat_ws('|', "League_season_id", "Team_id", league_id, "Country_id"),
  row_number() OVER (ORDER BY "League_season_id", final_rank) FROM tables
UNION ALL SELECT 'fct_aggregation', country_naipe_id, row_number() OVER (ORDER BY league_naipe NULLS FIRST,
  nat_team_strenght, avg_tight_sets DESC NULLS LAST, qtd_clubs DESC, country_naipe_id) FROM nations""",
    "silver_leagues": with_views(
        """SELECT league_id, league_name, country_code, country_name, league_season,
  league_season || '-01-01' AS start FROM leagues""",
        "leagues",
    ),
    "silver_standings": with_views(
        """SELECT league_id AS "leagueId", league_season, 'all' AS season_name, team_id,
  total_games_played AS games_played FROM team_stats""",
        "team_stats",
    ),
    "silver_teams": with_views("SELECT team_id, team_name, team_logo FROM teams", "teams"),
    "silver_countries": with_views(
        "SELECT country_code, country_name, country_logo FROM countries", "countries"
    ),
    "silver_team_stats": with_views("SELECT * FROM team_stats", "team_stats"),
    "clustered_matches": with_views(
        f"""SELECT country_name, league_season, count(*) AS n_matches, min(match_id) AS first_id,
  max(match_id) AS last_id, sum(current_home_team_score)::BIGINT AS home_sets
FROM matches WHERE {DOMESTIC} GROUP BY ALL""",
        "matches",
    ),
    "export": MART_SQL["dim_teams"],
    "stats_of_league": with_views(
        """SELECT team_id, league_id, league_season, '2' AS asked_league FROM team_stats
WHERE league_id = '2'""",
        "team_stats",
    ),
}
