"""The silver views as DuckDB common table expressions."""

from __future__ import annotations

from rallymart.sources import derived

SETS = ("firstSet", "second_set", "third_set", "fourth_set", "fifth_set")

SILVER = {
    name: text.format(**{source: source for source in sources})
    for name, (text, sources) in derived.VIEWS.items()
}

_homes = ", ".join(f"{name}_home_team_score" for name in SETS)
_aways = ", ".join(f"{name}_away_team_score" for name in SETS)

# Shared building blocks: one row per set, totals per match, one row per side.
BLOCKS = {
    "set_rows": f"""
SELECT match_id, unnest([1, 2, 3, 4, 5]) AS set_no, unnest([{_homes}]) AS h, unnest([{_aways}]) AS a
FROM matches""",
    "set_totals": """
SELECT match_id,
  count(*) FILTER (WHERE h > a) AS home_sets,
  count(*) FILTER (WHERE a > h) AS away_sets,
  count(h) AS played,
  count(*) FILTER (WHERE abs(h - a) <= 3) AS tight,
  count(*) FILTER (WHERE h - a BETWEEN 1 AND 3) AS home_tight,
  count(*) FILTER (WHERE a - h BETWEEN 1 AND 3) AS away_tight,
  count(h) FILTER (WHERE set_no = 5) AS fifth
FROM set_rows GROUP BY match_id""",
    "sides": """
SELECT m.*, t.tight, t.fifth, v.side,
  if(v.side = 'home', homeTeam_id, awayTeam_id) AS team_id,
  if(v.side = 'home', homeTeam_name, awayTeam_name) AS team_name,
  if(v.side = 'home', current_home_team_score, current_away_team_score) AS own,
  if(v.side = 'home', current_away_team_score, current_home_team_score) AS other,
  if(v.side = 'home', home_sets, away_sets) AS won_sets,
  if(v.side = 'home', away_sets, home_sets) AS lost_sets,
  if(v.side = 'home', home_tight, away_tight) AS own_tight
FROM matches m JOIN set_totals t USING (match_id) CROSS JOIN (VALUES ('home'), ('away')) v(side)""",
    "standing_rows": """
SELECT league_season_key AS league_season_id, team_id, league_id, league_name, country_code,
  country_name, CAST(league_season AS VARCHAR) AS season, match_week, match_id, won_sets, lost_sets,
  (coalesce(own > other, false))::BIGINT AS has_won,
  CASE WHEN own > other THEN 3 - fifth WHEN own < other THEN fifth ELSE 0 END AS points,
  coalesce(regexp_matches(match_week, 'final|3rd place|quarter|semi', 'i'), false) AS in_finals,
  coalesce(regexp_matches(match_week, 'final', 'i')
           AND NOT regexp_matches(match_week, 'semi|quarter', 'i'), false) AS real_final,
  coalesce(match_week ILIKE '%3rd place%', false) AS bronze,
  coalesce(match_week ILIKE '%quarter%', false) AS quarter
FROM (SELECT *, concat(league_id, '_', league_season) AS league_season_key FROM sides)
WHERE description = 'Finished'""",
}

_NEEDS = {
    "matches": (),
    "leagues": ("matches",),
    "teams": ("matches",),
    "countries": (),
    "team_stats": ("matches",),
    "set_rows": ("matches",),
    "set_totals": ("set_rows",),
    "sides": ("matches", "set_totals"),
    "standing_rows": ("sides",),
}


def with_views(body: str, *names: str) -> str:
    """`body` behind a WITH list of the named views and all they need.

    A body that starts with further expressions joins the same list.
    """
    ordered: list[str] = []

    def add(name: str) -> None:
        for need in _NEEDS[name]:
            add(need)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    texts = {**SILVER, **BLOCKS}
    listed = [f"{name} AS MATERIALIZED ({texts[name].strip()})" for name in ordered]
    body = body.strip()
    if body.upper().startswith("WITH "):
        listed_body = body[5:]
        return "WITH " + ",\n".join(listed) + ",\n" + listed_body
    return "WITH " + ",\n".join(listed) + "\n" + body
