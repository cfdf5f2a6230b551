"""Landed documents to bronze, bronze to silver, and the full run."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rallymart.functions.rules import SIDES
from rallymart.operators import reshape
from rallymart.plans.registry import MARTS, run_gold
from rallymart.sources.landing import ENTITIES, landed_entities, read_landed
from rallymart.sources.schemas import SILVER_SCHEMAS
from rallymart.sources.staging import discard_staged
from rallymart.sources.tables import SILVER_LAYOUT, export_tables, read_table, write_table

# Names before -> names after, where the general renaming is not enough.
RENAMES = {
    "countries": {"code": "country_code", "name": "country_name", "logo": "country_logo"},
    "leagues": {"id": "league_id", "logo": "league_logo", "name": "league_name"},
    "matches": {
        "id": "match_id",
        "logo": "league_logo",
        "week": "match_week",
        "date": "match_date",
    },
    "teams": {"id": "team_id", "logo": "team_logo", "name": "team_name"},
    "team_stats": {"leagueId": "league_id", "leagueName": "league_name"},
    "standings": {
        "name": "season_name",
        "leagueName": "league_name",
        "gamesPlayed": "games_played",
        "scoredPoints": "scored_points",
        "receivedPoints": "received_points",
        "position": "standing_position",
    },
}

# Score text column -> prefix of its two number columns.
SCORE_COLUMNS = {
    "current": "current",
    "firstSet": "firstSet",
    "secondSet": "second_set",
    "thirdSet": "third_set",
    "fourthSet": "fourth_set",
    "fifthSet": "fifth_set",
}
MATCH_LEFTOVERS = (*SCORE_COLUMNS, "leagueId", "season")

def to_bronze(documents: DataFrame) -> DataFrame:
    return reshape.nested_to_text(reshape.flatten_structs(documents))


def silver_matches(bronze: DataFrame) -> DataFrame:
    table = reshape.rename_columns(bronze, RENAMES["matches"])
    missing = [text for text in SCORE_COLUMNS if text not in table.columns]
    table = table.withColumns({text: F.lit(None).cast("string") for text in missing})
    halves = {
        text: tuple(f"{prefix}_{side}_team_score" for side in SIDES)
        for text, prefix in SCORE_COLUMNS.items()
    }
    table = reshape.split_columns(table, halves)
    return reshape.cast_by_name(reshape.drop_columns(table, MATCH_LEFTOVERS))


def silver_leagues(bronze: DataFrame, schema: T.DataType | None = None) -> DataFrame:
    """One row per league and season, with all fields of the season.

    Without a schema it is read off the text. A season that is no whole number is an error, as
    every join on seasons would lose it.
    """
    seasons = reshape.explode_json(bronze, "seasons", schema)
    table = reshape.cast_by_name(reshape.rename_columns(seasons, RENAMES["leagues"]))
    text = F.col("league_season").cast("string")
    bad = F.raise_error(F.concat(F.lit("not a season: "), text)).cast("bigint")
    number = F.when(text.isNotNull(), F.coalesce(F.expr("try_cast(trim(CAST(league_season AS STRING)) AS BIGINT)"), bad))
    return table.withColumn("league_season", number)


def silver_standings(
    bronze: DataFrame, schema: T.DataType | None = None
) -> DataFrame:
    """One row per league, season, group and team. Without a schema it is read off the text."""
    groups = reshape.explode_json(bronze, "data.groups", schema)
    rows = reshape.explode_json(groups, "standings")
    return reshape.cast_by_name(reshape.rename_columns(rows, RENAMES["standings"]))


def _plain(entity: str) -> Callable[[DataFrame], DataFrame]:
    def silver(bronze: DataFrame) -> DataFrame:
        return reshape.cast_by_name(reshape.rename_columns(bronze, RENAMES[entity]))

    return silver


TO_SILVER: dict[str, Callable[[DataFrame], DataFrame]] = {
    "leagues": silver_leagues,
    "matches": silver_matches,
    "teams": _plain("teams"),
    "team_stats": _plain("team_stats"),
    "standings": silver_standings,
    "countries": _plain("countries"),
}

def run_bronze(
    spark: SparkSession,
    landed: str,
    root: str,
    lines: bool = True,
    schemas: Mapping[str, T.StructType] | None = None,
    entities: tuple[str, ...] | None = None,
) -> dict[str, int]:
    """Flatten landed entities, all that lie in the folder if none are named, into stored tables.

    Schemas given per entity save the pass over the documents that infers them.
    """
    rows = {}
    for entity in entities or landed_entities(spark, landed):
        documents = read_landed(spark, landed, entity, (schemas or {}).get(entity), lines)
        rows[entity] = write_table(to_bronze(documents), root, entity)
    return rows


def run_silver(
    spark: SparkSession, bronze: str, root: str, entities: tuple[str, ...] = ENTITIES
) -> dict[str, int]:
    rows = {}
    for entity in entities:
        table = TO_SILVER[entity](read_table(spark, bronze, entity))
        needed = T._parse_datatype_string(SILVER_SCHEMAS[entity]).names if entity != "standings" else []
        if missing := set(needed) - set(table.columns):
            raise ValueError(f"{entity} lacks {', '.join(sorted(missing))}, which the marts read")
        rows[entity] = write_table(table, root, entity, layout=SILVER_LAYOUT.get(entity))
    return rows


def stored_silver(
    spark: SparkSession, root: str, schemas: Mapping[str, str] = SILVER_SCHEMAS
) -> dict[str, DataFrame]:
    """The silver tables with the columns and types the marts rely on.

    The layout by season would else turn seasons into INT, and an empty table has no file to
    take a schema from. Standings are read by no mart and keep the types they were stored with.
    """
    given = {name: schemas.get(name) for name in ENTITIES if name != "standings"}
    return {name: read_table(spark, root, name, schema) for name, schema in given.items()}


def run_all(
    spark: SparkSession,
    landed: str,
    root: str,
    lines: bool = True,
    entities: tuple[str, ...] | None = None,
) -> dict[str, int]:
    """Landed JSON to exported marts; returns the rows of each exported table."""
    run_bronze(spark, landed, f"{root}/bronze", lines, entities=entities)
    run_silver(spark, f"{root}/bronze", f"{root}/silver")
    run_gold(spark, stored_silver(spark, f"{root}/silver"), f"{root}/gold")
    rows = export_tables(spark, f"{root}/gold", f"{root}/export", tuple(MARTS))
    discard_staged(spark)
    return rows
