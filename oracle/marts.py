"""DuckDB statements for the marts, written apart from the Spark plans."""

from __future__ import annotations

from oracle.views import with_views

# Fixed values, as the source data has them; spelled out apart from the code under test.
SETS = ("firstSet", "second_set", "third_set", "fourth_set", "fifth_set")
CONTINENT_NAMES = ("Europe", "South America", "North America", "Africa", "Oceania")
WORLD_NAMES = ("Nations League", "World Championship", "Olympic Games")
LEVEL_NAMES = (
    "gold",
    "silver",
    "bronze",
    "4th_place",
    "quarter_finalist",
    "preliminary_top",
    "preliminary_bottom",
    "not_present",
)


def _list(words) -> str:
    return "(" + ", ".join(f"'{word}'" for word in words) + ")"


NOT_REAL = _list(("World", *CONTINENT_NAMES))
CONTINENTS = _list(CONTINENT_NAMES)
WORLD_LEAGUES = _list(WORLD_NAMES)
SCORES = ", ".join(
    f"{name}_{side}_team_score" for name in SETS for side in ("home", "away")
)


def naipe(name: str) -> str:
    return f"if(regexp_matches({name}, 'women|femenina|female|feminina', 'i'), 'Women', 'Men')"


def narrow(name: str) -> str:
    return f"if({name} ILIKE '%women%', 'Women', 'Men')"


def plain(name: str) -> str:
    return f"trim(replace({name}, 'Women', ''))"


WORLD = f"description = 'Finished' AND country_name = 'World' AND {plain('league_name')} IN {WORLD_LEAGUES}"
WORLD_ANY_FLAG = f"description = 'Finished' AND {plain('league_name')} IN {WORLD_LEAGUES}"
DOMESTIC = f"description = 'Finished' AND country_name NOT IN {CONTINENTS} AND country_code <> 'World'"

LEVELS = "[" + ", ".join(f"'{n}'" for n in LEVEL_NAMES) + "]"


def _match_facts(scope: str, country: str) -> str:
    return with_views(
        f"""
SELECT match_id AS "Match_id", concat(league_id, '_', league_season) AS league_season_id, match_week,
  {country} strftime(match_date, '%Y-%m-%d %H:%M') AS match_date, homeTeam_id, awayTeam_id,
  if(current_home_team_score > current_away_team_score, homeTeam_id, awayTeam_id) AS match_winner,
  description AS match_status, current_home_team_score, current_away_team_score, {SCORES},
  played AS total_sets, tight AS n_tight_sets
FROM matches JOIN set_totals USING (match_id) WHERE {scope}""",
        "matches",
        "set_totals",
    )


_side_scores = ",\n  ".join(
    f"if(side = 'home', {name}_home_team_score, {name}_away_team_score) AS {short}_set_score"
    for name, short in zip(SETS, ("first", "second", "third", "fourth", "fifth"))
)


def _side_facts(scope: str, tight_name: str, country: str) -> str:
    return with_views(
        f"""
WITH placed AS (
  SELECT *, if(match_week ILIKE '%final%' OR match_week ILIKE '%3rd place%', 'Finals', 'Preliminary') AS phase
  FROM sides WHERE {scope})
SELECT team_id AS "Team_id", concat(league_id, '_', league_season) AS league_season_id, {country} match_id,
  side AS team_side, match_week, phase AS champ_phase, strftime(match_date, '%Y-%m-%d %H:%M') AS match_date,
  own AS current_score, {_side_scores}, description AS match_status,
  if(own > other, 'W', 'L') AS team_result,
  row_number() OVER (PARTITION BY team_id ORDER BY match_date DESC, match_id, side) AS match_order_general,
  row_number() OVER (PARTITION BY team_id, league_id, league_season
                     ORDER BY match_date DESC, match_id, side) AS match_order_champ,
  if(phase = 'Finals', row_number() OVER (PARTITION BY team_id, league_id, league_season, phase
                                          ORDER BY match_date DESC, match_id, side), NULL) AS match_order_finals,
  won_sets AS sets_won, lost_sets AS sets_lost, own_tight AS {tight_name}
FROM placed""",
        "sides",
    )


def _team_stats(scope_from: str) -> str:
    wins = ", ".join(
        f"count(*) FILTER (WHERE set_no = {i} AND mine > theirs) AS s{i}" for i in range(1, 6)
    )
    won = ", ".join(f"coalesce(s{i}, 0) AS set_{i}_win" for i in range(1, 6))
    return with_views(
        f"""
WITH repeated AS (SELECT s.* FROM {scope_from}),
games AS (
  SELECT team_id, league_season,
    count(*) FILTER (WHERE match_week = 'Final') AS f, count(*) FILTER (WHERE match_week = 'Semi-finals') AS s,
    count(*) FILTER (WHERE match_week = '3rd place') AS b, count(*) FILTER (WHERE match_week = 'Quarter-finals') AS q,
    count(if(side = 'home', fifth_set_home_team_score, fifth_set_away_team_score)) AS five,
    count(*) FILTER (WHERE own > other
      AND if(side = 'home', fourth_set_home_team_score, fourth_set_away_team_score) IS NULL) AS straight,
    count(*) FILTER (WHERE own > other AND tight >= 3) AS close_wins
  FROM repeated GROUP BY ALL),
set_wins AS (
  SELECT team_id, league_season, {wins}
  FROM (SELECT r.team_id, r.league_season, x.set_no, if(side = 'home', h, a) AS mine, if(side = 'home', a, h) AS theirs
        FROM repeated r JOIN set_rows x USING (match_id))
  GROUP BY ALL)
SELECT t.team_id AS "Team_id", concat(t.league_id, '_', t.league_season) AS league_season_id, t.league_id,
  CAST(t.league_season AS VARCHAR) AS league_season, total_games_played AS season_games_played,
  total_games_wins AS season_games_won, total_games_loses AS season_games_lost,
  total_points_scored AS points_scored, total_points_received AS points_received,
  total_points_scored - total_points_received AS points_delta,
  coalesce(f, 0) AS total_finals, coalesce(s, 0) AS total_semi_finals, coalesce(b, 0) AS total_3rd_place_dispute,
  coalesce(q, 0) AS total_4r_finals_appearances, coalesce(five, 0) AS total_games_5_sets,
  coalesce(straight, 0) AS n_3_x_0_wins, {won}, coalesce(close_wins, 0) AS n_tight_games_won
FROM team_stats t LEFT JOIN games USING (team_id, league_season) LEFT JOIN set_wins USING (team_id, league_season)""",
        "sides",
        "leagues",
        "team_stats",
    )


ELIGIBLE = f"""
homes AS (SELECT DISTINCT country_code, {narrow('league_name')} AS naipe FROM matches
          WHERE country_name NOT IN {NOT_REAL}),
eligible AS (
  SELECT DISTINCT s.team_id, {narrow('s.team_name')} AS naipe
  FROM sides s JOIN countries c ON {plain('s.team_name')} = c.country_name AND c.country_name NOT IN {NOT_REAL}
  JOIN homes h ON h.country_code = c.country_code AND h.naipe = {narrow('s.team_name')})"""

EDITIONS = f"""
editions AS (SELECT DISTINCT concat(league_id, '_', league_season) AS league_season_id, {naipe('league_name')} AS naipe
             FROM matches WHERE {WORLD})"""

WORLD_TABLE = f"""
world_rows AS (SELECT * FROM standing_rows WHERE match_id IN (SELECT match_id FROM matches WHERE {WORLD})),
world_table AS (
  SELECT *, row_number() OVER (PARTITION BY league_season_id
      ORDER BY games_won DESC NULLS LAST, match_points DESC, set_ratio DESC NULLS LAST, team_id) AS pos
  FROM (SELECT league_season_id, team_id, sum(has_won)::BIGINT AS games_won, sum(points)::BIGINT AS match_points,
          sum(won_sets)::BIGINT AS sets_won, sum(lost_sets)::BIGINT AS sets_lost,
          sum(won_sets)::DOUBLE / nullif(sum(lost_sets), 0)::DOUBLE AS set_ratio
        FROM world_rows WHERE NOT in_finals GROUP BY ALL)),
medals AS (
  SELECT league_season_id, team_id,
    min(CASE WHEN real_final AND has_won = 1 THEN 1 WHEN real_final THEN 2
             WHEN bronze AND has_won = 1 THEN 3 WHEN bronze THEN 4 WHEN quarter THEN 5 ELSE 7 END) AS medal
  FROM world_rows WHERE in_finals GROUP BY ALL),
eliminated AS (
  SELECT league_season_id, team_id, row_number() OVER (PARTITION BY league_season_id ORDER BY pos) AS place,
    count(*) OVER (PARTITION BY league_season_id) AS n
  FROM world_table ANTI JOIN medals USING (league_season_id, team_id)),
world_strength AS (
  SELECT w.*, CAST(coalesce(medal, if(place <= n // 2, 6, 7)) AS BIGINT) AS strength_level
  FROM world_table w LEFT JOIN medals USING (league_season_id, team_id)
  LEFT JOIN eliminated USING (league_season_id, team_id))"""

DOMESTIC_TABLE = f"""
single AS (
  SELECT concat(league_id, '_', league_season) AS league_season_id FROM matches
  WHERE description = 'Finished' AND country_name NOT IN {NOT_REAL} GROUP BY ALL HAVING count(*) = 1),
home_rows AS (
  SELECT * FROM standing_rows ANTI JOIN single USING (league_season_id) WHERE country_name NOT IN {NOT_REAL}),
home_table AS (
  SELECT *, row_number() OVER (PARTITION BY league_season_id
      ORDER BY games_won DESC, match_points DESC, set_ratio DESC NULLS LAST, team_id,
        league_id, league_name NULLS FIRST, country_code NULLS FIRST) AS pos,
    count(*) OVER (PARTITION BY league_season_id) AS n_teams
  FROM (SELECT league_season_id, league_id, league_name, country_code, season, team_id,
          sum(has_won)::BIGINT AS games_won, sum(1 - has_won)::BIGINT AS games_lost,
          sum(points)::BIGINT AS match_points, sum(won_sets)::BIGINT AS sets_won, sum(lost_sets)::BIGINT AS sets_lost,
          sum(won_sets)::DOUBLE / nullif(sum(lost_sets), 0)::DOUBLE AS set_ratio
        FROM home_rows WHERE NOT in_finals GROUP BY ALL)),
team_places AS (
  SELECT league_season_id, team_id, pos FROM home_table
  QUALIFY row_number() OVER (PARTITION BY league_season_id, team_id
      ORDER BY league_id, league_name NULLS FIRST, country_code NULLS FIRST) = 1),
series AS (
  SELECT r.league_season_id, r.team_id, kind, t.pos,
    sum(has_won) AS wins, sum(points) AS pts, sum(won_sets - lost_sets) AS balance
  FROM (SELECT *, 'final' AS kind FROM home_rows WHERE real_final
        UNION ALL SELECT *, 'bronze' AS kind FROM home_rows WHERE bronze) r
  LEFT JOIN team_places t USING (league_season_id, team_id) GROUP BY ALL),
series_places AS (
  SELECT *, row_number() OVER (PARTITION BY league_season_id, kind
      ORDER BY wins DESC, pts DESC, balance DESC, pos ASC NULLS FIRST, team_id) AS place
  FROM series),
series_teams AS (
  SELECT league_season_id, team_id,
    max(if(kind = 'final', place, NULL)) AS final_pos, max(if(kind = 'bronze', place, NULL)) AS bronze_pos
  FROM series_places GROUP BY ALL),
quarters AS (SELECT DISTINCT league_season_id, team_id, 5 AS quarter FROM home_rows WHERE quarter),
home_strength AS (
  SELECT t.*, final_pos, bronze_pos,
    CAST(CASE WHEN final_pos <= 2 THEN final_pos WHEN bronze_pos <= 2 THEN bronze_pos + 2 ELSE quarter END AS BIGINT) AS bucket
  FROM home_table t LEFT JOIN series_teams USING (league_season_id, team_id)
  LEFT JOIN quarters USING (league_season_id, team_id))"""

LEAGUE_DIM = f"""
league_dim AS (
  SELECT DISTINCT l.league_id, {plain('l.league_name')} AS league_name, {naipe('l.league_name')} AS league_naipe,
    coalesce(code, 'World') AS country_id
  FROM leagues l LEFT JOIN (SELECT league_id, max(country_code) AS code FROM matches
    WHERE country_name NOT IN {NOT_REAL} GROUP BY league_id) USING (league_id)
  WHERE code <> 'World' OR {plain('l.league_name')} IN {WORLD_LEAGUES})"""

SEASON_DIM = """
season_spans AS (
  SELECT m.league_id, m.league_season, min(match_date) AS first_date, max(match_date) AS last_date,
    bool_or(coalesce(regexp_matches(match_week, 'final', 'i')
            AND NOT regexp_matches(match_week, 'semi|quarter', 'i'), false)) AS has_final
  FROM leagues l JOIN matches m USING (league_id, league_season) GROUP BY ALL),
season_dim AS (
  SELECT *, if(has_final OR league_season < max(league_season) OVER (PARTITION BY league_id)
               OR league_season < max(league_season) OVER (), last_date, NULL) AS end_date
  FROM season_spans)"""

TEAM_DIM = f"""
team_best AS (
  SELECT team_id, max(c.country_code) AS code,
    arg_max(coalesce(l.league_name, ''), struct_pack(c := coalesce(c.country_code, ''), n := coalesce(l.league_name, ''))) AS best_league
  FROM sides s LEFT JOIN countries c ON s.country_code = c.country_code AND c.country_name NOT IN {NOT_REAL}
  LEFT JOIN leagues l ON l.league_id = s.league_id GROUP BY team_id),
team_dim AS (
  SELECT t.team_id, {plain('t.team_name')} AS team_name, {naipe('best_league')} AS team_naipe,
    if(c.country_code IS NULL, 'Club', 'National Team') AS team_type, coalesce(c.country_code, code) AS country_id
  FROM teams t LEFT JOIN team_best USING (team_id)
  LEFT JOIN countries c ON c.country_name = {plain('t.team_name')} AND c.country_name NOT IN {NOT_REAL}
  WHERE coalesce(c.country_code, code) IS NOT NULL)"""

DIM_COUNTRIES = with_views(
    f"""
SELECT concat(country_code, '_', naipe) AS country_naipe_id, country_code AS "Country_id", country_name, country_logo
FROM countries CROSS JOIN (VALUES ('Men'), ('Women')) v(naipe) WHERE country_name NOT IN {NOT_REAL}""",
    "countries",
)

DIM_LEAGUES = with_views(
    f"""
WITH {LEAGUE_DIM}
SELECT league_id AS "League_id", league_name, if(country_id = 'World', 'International', 'National') AS geo_aggreg,
  league_naipe, country_id FROM league_dim""",
    "leagues",
)

DIM_LOGOS = with_views(
    """
SELECT team_id AS "Team_id", coalesce(country_logo, team_logo) AS logo_final
FROM (SELECT DISTINCT team_id, team_logo, trim(replace(replace(team_name, 'Women', ''), 'Men', '')) AS name FROM teams)
LEFT JOIN countries ON country_name = name""",
    "teams",
    "countries",
)

DIM_SEASON = with_views(
    f"""
WITH {SEASON_DIM}
SELECT concat(league_id, '_', league_season) AS "League_season_id", league_id, league_season,
  first_date AS season_start_date, end_date AS season_end_date,
  if(end_date IS NULL, 'Not Finished', 'Finished') AS season_status FROM season_dim""",
    "leagues",
)

DIM_TEAMS = with_views(
    f"""
WITH {TEAM_DIM}
SELECT concat(country_id, '_', team_naipe) AS country_naipe_id, team_id AS "Team_id", team_name, team_naipe,
  team_type, country_id FROM team_dim""",
    "sides",
    "leagues",
    "teams",
    "countries",
)

DIM_TEAM_BY_SEASON = with_views(
    f"""
SELECT DISTINCT concat(league_id, '_', league_season) AS league_season_id, team_id FROM sides
WHERE ({WORLD}) OR ({DOMESTIC})""",
    "sides",
)

INTERN_STANDINGS = with_views(
    f"""
WITH {ELIGIBLE}, {EDITIONS}, {WORLD_TABLE}
SELECT e.league_season_id AS "League_season_id", t.team_id AS "Team_id", pos AS rank_position,
  coalesce(games_won, 0) AS games_won, coalesce(match_points, 0) AS match_points, coalesce(sets_won, 0) AS sets_won,
  coalesce(sets_lost, 0) AS sets_lost, set_ratio, coalesce(strength_level, 8) AS strength_level,
  {LEVELS}[coalesce(strength_level, 8)] AS strength_cluster
FROM eligible t JOIN editions e USING (naipe)
LEFT JOIN world_strength w ON w.team_id = t.team_id AND w.league_season_id = e.league_season_id""",
    "standing_rows",
    "countries",
)

NATIONAL_STANDINGS = with_views(
    f"""
WITH {DOMESTIC_TABLE}
SELECT league_season_id AS "League_season_id", league_id, country_code AS "Country_id", team_id AS "Team_id",
  season AS league_season, pos AS prelim_position, n_teams AS total_teams_this_season, games_won, games_lost,
  match_points, sets_won, sets_lost, set_ratio,
  row_number() OVER (PARTITION BY league_season_id ORDER BY bucket ASC NULLS LAST, pos) AS final_rank,
  bucket AS finalist_bucket, coalesce(bucket, 6) AS strength_level,
  if(bucket IS NULL, 'regular_season', {LEVELS}[bucket]) AS strength_cluster
FROM home_strength""",
    "standing_rows",
)

AGGREGATION = with_views(
    f"""
WITH {LEAGUE_DIM}, {SEASON_DIM}, {TEAM_DIM}, {ELIGIBLE}, {EDITIONS}, {WORLD_TABLE}, {DOMESTIC_TABLE},
season_leagues AS (
  SELECT concat(s.league_id, '_', s.league_season) AS league_season_id, s.league_id, l.league_naipe, l.country_id
  FROM season_dim s LEFT JOIN league_dim l USING (league_id)),
selections AS (
  SELECT d.country_id, sl.league_naipe, avg(coalesce(w.strength_level, 8)) AS strength
  FROM eligible t JOIN editions e USING (naipe)
  LEFT JOIN world_strength w ON w.team_id = t.team_id AND w.league_season_id = e.league_season_id
  LEFT JOIN season_leagues sl ON sl.league_season_id = e.league_season_id
  LEFT JOIN team_dim d ON d.team_id = t.team_id GROUP BY ALL),
domestic AS (
  SELECT sl.country_id, sl.league_naipe, count(DISTINCT sl.league_id) AS qtd_national_leagues,
    count(DISTINCT h.team_id) AS qtd_clubs
  FROM home_strength h LEFT JOIN season_leagues sl USING (league_season_id) GROUP BY ALL),
tension AS (
  SELECT sl.country_id, sl.league_naipe, avg(tight) AS avg_tight_sets
  FROM (SELECT concat(league_id, '_', league_season) AS league_season_id, tight
        FROM matches JOIN set_totals USING (match_id) WHERE {DOMESTIC})
  LEFT JOIN season_leagues sl USING (league_season_id) GROUP BY ALL)
SELECT concat(d.country_id, '_', d.league_naipe) AS country_naipe_id, d.country_id, d.league_naipe,
  coalesce(strength, 8.0) AS nat_team_strenght, qtd_national_leagues, qtd_clubs, avg_tight_sets
FROM domestic d LEFT JOIN tension USING (country_id, league_naipe)
LEFT JOIN selections USING (country_id, league_naipe)""",
    "standing_rows",
    "leagues",
    "teams",
    "countries",
)

MART_SQL = {
    "dim_countries": DIM_COUNTRIES,
    "dim_leagues": DIM_LEAGUES,
    "dim_logos": DIM_LOGOS,
    "dim_season": DIM_SEASON,
    "dim_teams": DIM_TEAMS,
    "dim_team_by_season": DIM_TEAM_BY_SEASON,
    "fct_intern_matches": _match_facts(WORLD_ANY_FLAG, ""),
    "fct_national_matches": _match_facts(DOMESTIC, "country_name, country_code,"),
    "fct_intern_matches_melted_by_team": _side_facts(WORLD, "n_tight_sets", ""),
    "fct_national_matches_melted_by_team": _side_facts(
        DOMESTIC, "n_tight_sets_won", "country_name, country_code,"
    ),
    "fct_intern_team_stats": _team_stats(
        f"sides s JOIN leagues l ON s.league_id = l.league_id WHERE s.description = 'Finished' "
        f"AND {plain('s.league_name')} IN {WORLD_LEAGUES}"
    ),
    "fct_national_team_stats": _team_stats(
        f"sides s JOIN leagues l ON s.league_id = l.league_id WHERE s.description = 'Finished' "
        f"AND l.country_name NOT IN {NOT_REAL}"
    ),
    "fct_intern_standings": INTERN_STANDINGS,
    "fct_national_standings": NATIONAL_STANDINGS,
    "fct_aggregation": AGGREGATION,
}
