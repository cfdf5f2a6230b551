"""Silver-shaped views over the generic order tables, one match per order.

The order tables hold no sports data. These statements give every order a league, two teams
and set scores by arithmetic on its keys, so that the marts have whole tables of any size to
run on. The text is shared with the comparison SQL: `{orders}` and the like are filled with
DataFrames here and with view names there.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from functools import lru_cache

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from rallymart.functions.rules import SETS
from rallymart.sources.staging import staging_path


_TOPS = (25, 25, 25, 25, 15)


def _set_numbers() -> str:
    """Per set: the loser's score, and whether the home side takes it."""
    columns = []
    for number, top in enumerate(_TOPS, start=1):
        columns.append(f"coalesce({top} - (2 + (k * {number + 2}) % 7), 0) AS low_{number}")
        columns.append(f"(hw = 1) = ({number} > p - 3) AS home_{number}")
    return ",\n    ".join(columns)


def _set_columns() -> str:
    columns = []
    for number, (name, top) in enumerate(zip(SETS, _TOPS), start=1):
        for side, takes in (("home", f"home_{number}"), ("away", f"NOT home_{number}")):
            columns.append(
                f"CASE WHEN {number} > played THEN NULL WHEN {takes} THEN CAST({top} AS BIGINT)"
                f" ELSE low_{number} END AS {name}_{side}_team_score"
            )
    return ",\n  ".join(columns)


# Built in layers so that no one expression grows large: scope is 0 world, 1 continent,
# 2 national; `played` is 0 for an abandoned match.
MATCHES = f"""
SELECT
  CAST(k AS STRING) AS match_id,
  CAST(league AS STRING) AS league_id,
  CASE WHEN scope = 0 THEN
         CASE cup WHEN 0 THEN 'Nations League' WHEN 1 THEN 'World Championship' ELSE 'Olympic Games' END
         || women
       WHEN scope = 1 THEN 'Champions League'
       ELSE 'Liga ' || CAST(n AS STRING)
         || CASE WHEN g = 0 THEN '' WHEN n4 = 0 THEN ' Women' WHEN n4 = 1 THEN ' Femenina'
                 WHEN n4 = 2 THEN ' Female' ELSE ' Feminina' END
         -- A league that changed its name during a season.
         || CASE WHEN y = 1995 AND n % 3 = 1 AND k % 2 = 1 THEN ' Cup' ELSE '' END
       END AS league_name,
  y AS league_season,
  CASE scope WHEN 0 THEN 'World' WHEN 1 THEN 'Europe' ELSE 'C' || CAST(n AS STRING) END AS country_code,
  CASE scope WHEN 0 THEN 'World' WHEN 1 THEN 'Europe' ELSE home_nation END AS country_name,
  CASE week WHEN 0 THEN 'Final' WHEN 1 THEN 'Semi-finals' WHEN 2 THEN 'Quarter-finals'
            WHEN 3 THEN '3rd place' WHEN 4 THEN NULL ELSE CAST(week AS STRING) END AS match_week,
  d AS match_date,
  CASE WHEN st = 'O' THEN 'Not started' ELSE 'Finished' END AS description,
  CAST(home_id AS STRING) AS homeTeam_id,
  CAST(away_id AS STRING) AS awayTeam_id,
  CASE WHEN scope = 0 THEN home_nation || women ELSE 'Club ' || CAST(home_id AS STRING) END AS homeTeam_name,
  CASE WHEN scope = 0 THEN away_nation || women ELSE 'Club ' || CAST(away_id AS STRING) END AS awayTeam_name,
  CASE WHEN played = 0 THEN CAST(0 AS BIGINT) WHEN hw = 1 THEN CAST(3 AS BIGINT) ELSE p - 3 END
    AS current_home_team_score,
  CASE WHEN played = 0 THEN CAST(0 AS BIGINT) WHEN hw = 1 THEN p - 3 ELSE CAST(3 AS BIGINT) END
    AS current_away_team_score,
  {_set_columns()}
FROM (
  SELECT
    k, n, g, y, d, st, p, hw, scope, week, home_nation, m.n_name AS away_nation,
    coalesce(k % 3, 0) AS cup,
    coalesce(n % 4, 0) AS n4,
    CASE WHEN g = 1 THEN ' Women' ELSE '' END AS women,
    CASE WHEN k % 97 = 0 THEN 0 ELSE p END AS played,
    coalesce(CASE WHEN scope = 0 THEN 900 + 2 * (k % 3) + g WHEN scope = 1 THEN 990
                  WHEN k % 499 = 7 THEN 10000 + k ELSE 2 * n + g END, 0) AS league,
    CASE WHEN scope = 0 THEN 5000 + 2 * n + g ELSE 1000 + 16 * n + 8 * g + a END AS home_id,
    coalesce(CASE WHEN scope = 0 THEN 5000 + 2 * n2 + g
                  ELSE 1000 + 16 * n + 8 * g + (a + 1 + k % 7) % 8 END, 0) AS away_id,
    {_set_numbers()}
  FROM (
    SELECT
      o.o_orderkey AS k,
      CAST(c.c_nationkey AS BIGINT) AS n,
      h.n_name AS home_nation,
      CAST(year(o.o_orderdate) AS BIGINT) AS y,
      o.o_orderdate AS d,
      o.o_orderstatus AS st,
      coalesce(o.o_custkey % 2, 0) AS g,
      CASE WHEN o.o_orderkey % 4 = 0 THEN 0 WHEN o.o_orderkey % 17 = 1 THEN 1 ELSE 2 END AS scope,
      coalesce(o.o_orderkey % 11, 0) AS week,
      coalesce(CAST(floor(o.o_custkey / 2) AS BIGINT) % 8, 0) AS a,
      coalesce((c.c_nationkey + 1 + o.o_orderkey % 24) % 25, 0) AS n2,
      coalesce(3 + (o.o_custkey + o.o_orderkey) % 3, 3) AS p,
      coalesce(CAST(floor((o.o_orderkey + o.o_custkey) / 3) AS BIGINT) % 2, 0) AS hw
    FROM {{orders}} o
    JOIN {{customer}} c ON o.o_custkey = c.c_custkey
    JOIN {{nation}} h ON c.c_nationkey = h.n_nationkey
    WHERE o.o_orderkey IS NOT NULL
  ) b
  JOIN {{nation}} m ON b.n2 = m.n_nationkey
) s
"""

# HAVING keeps the distinct step: Spark would drop a plain DISTINCT below max() and then sort
# every match for the text maximum.
LEAGUES = """
SELECT league_id, league_name, league_season, country_code, country_name
FROM {matches} m
GROUP BY league_id, league_name, league_season, country_code, country_name
HAVING count(*) > 0
"""

TEAMS = """
SELECT team_id, max(team_name) AS team_name, 'logo/' || team_id AS team_logo
FROM (
  SELECT team_id, team_name
  FROM (
    SELECT homeTeam_id AS team_id, homeTeam_name AS team_name FROM {matches} m
    UNION ALL
    SELECT awayTeam_id AS team_id, awayTeam_name AS team_name FROM {matches} m
  ) b
  GROUP BY team_id, team_name
  HAVING count(*) > 0
) s
GROUP BY team_id
"""

COUNTRIES = """
SELECT 'C' || CAST(n_nationkey AS STRING) AS country_code, n_name AS country_name,
       'logo/C' || CAST(n_nationkey AS STRING) AS country_logo
FROM {nation} n
UNION ALL SELECT 'World', 'World', 'logo/World'
UNION ALL SELECT 'Europe', 'Europe', 'logo/Europe'
"""


def _points(side: str) -> str:
    return " + ".join(f"coalesce({name}_{side}_team_score, 0)" for name in SETS)


TEAM_STATS = f"""
SELECT league_id, team_id, league_season,
       count(*) AS total_games_played,
       CAST(sum(CASE WHEN own > other THEN 1 ELSE 0 END) AS BIGINT) AS total_games_wins,
       CAST(sum(CASE WHEN own < other THEN 1 ELSE 0 END) AS BIGINT) AS total_games_loses,
       CAST(sum(scored) AS BIGINT) AS total_points_scored,
       CAST(sum(received) AS BIGINT) AS total_points_received
FROM (
  SELECT league_id, homeTeam_id AS team_id, league_season, current_home_team_score AS own,
         current_away_team_score AS other, {_points('home')} AS scored, {_points('away')} AS received
  FROM {{matches}} m WHERE description = 'Finished'
  UNION ALL
  SELECT league_id, awayTeam_id AS team_id, league_season, current_away_team_score AS own,
         current_home_team_score AS other, {_points('away')} AS scored, {_points('home')} AS received
  FROM {{matches}} m WHERE description = 'Finished'
) s
GROUP BY league_id, team_id, league_season
"""


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


class SilverViews(Mapping):
    """The silver tables by name, each planned when first asked for."""

    def __init__(
        self, spark: SparkSession, sf_dir: str, given: dict[str, DataFrame] | None = None
    ) -> None:
        self._spark, self._sf_dir = spark, sf_dir
        self._planned: dict[str, DataFrame] = dict(given or {})

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._planned:
            text, sources = VIEWS[name]
            inputs = {
                source: self[source] if source in VIEWS else self._read(source)
                for source in sources
            }
            self._planned[name] = self._spark.sql(text, **inputs)
        return self._planned[name]

    def _read(self, table: str) -> DataFrame:
        return read(self._spark, self._sf_dir, table)

    def __iter__(self) -> Iterator[str]:
        return iter(VIEWS)

    def __len__(self) -> int:
        return len(VIEWS)


VIEWS: dict[str, tuple[str, tuple[str, ...]]] = {
    "matches": (MATCHES, ("orders", "customer", "nation")),
    "leagues": (LEAGUES, ("matches",)),
    "teams": (TEAMS, ("matches",)),
    "countries": (COUNTRIES, ("nation",)),
    "team_stats": (TEAM_STATS, ("matches",)),
}


@lru_cache(maxsize=32)
def silver_views(spark: SparkSession, sf_dir: str) -> SilverViews:
    """Views computed from the order tables whenever they are read. Holds plans, no data."""
    return SilverViews(spark, sf_dir)


_stored_matches: dict[tuple[str, str], str] = {}


def stored_views(spark: SparkSession, sf_dir: str) -> SilverViews:
    """The same over a match table written once per session, for jobs that read it often.

    Each read of the view joins orders with customers; each read of the table is a pruned
    Parquet scan.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    matches = silver_views(spark, sf_dir)["matches"]
    if key in _stored_matches:
        try:
            stored = spark.read.schema(matches.schema).parquet(_stored_matches[key])
            return SilverViews(spark, sf_dir, {"matches": stored})
        except AnalysisException:  # the folder was cleared meanwhile
            del _stored_matches[key]
    path = staging_path(spark, "matches")
    matches.write.parquet(path)
    _stored_matches[key] = path
    return stored_views(spark, sf_dir)
