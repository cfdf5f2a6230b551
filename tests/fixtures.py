"""Hand-made silver frames."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from rallymart.functions.rules import SETS
from rallymart.sources.schemas import SILVER_SCHEMAS

STRAIGHT = ["25-20", "25-20", "25-20"]
FIVE = ["25-20", "20-25", "25-20", "20-25", "15-10"]


def match(match_id, home, away, sets, week="1", day=1, **over) -> dict:
    """A finished national match; `sets` are texts such as `25-20` seen from the home side."""
    row = {
        "match_id": str(match_id),
        "league_id": "10",
        "league_name": "Liga",
        "league_season": 2020,
        "country_code": "AA",
        "country_name": "Aland",
        "match_week": week,
        "match_date": datetime(2020, 1, day),
        "description": "Finished",
        "homeTeam_id": home,
        "awayTeam_id": away,
        "homeTeam_name": home,
        "awayTeam_name": away,
    }
    points = [tuple(int(p) for p in text.split("-")) for text in sets]
    row["current_home_team_score"] = sum(h > a for h, a in points)
    row["current_away_team_score"] = sum(h < a for h, a in points)
    for i, name in enumerate(SETS):
        played = points[i] if i < len(points) else (None, None)
        row[f"{name}_home_team_score"], row[f"{name}_away_team_score"] = played
    return {**row, **over}


def world(match_id, home, away, sets, week="1", day=1, **over) -> dict:
    return match(
        match_id, home, away, sets, week, day,
        **{
            "league_id": "900",
            "league_name": "Nations League",
            "country_code": "World",
            "country_name": "World",
            **over,
        },
    )


def table(spark: SparkSession, name: str, rows: list[dict]) -> DataFrame:
    schema = T.StructType.fromDDL(SILVER_SCHEMAS[name])
    return spark.createDataFrame([[row.get(f.name) for f in schema] for row in rows], schema)


def matches(spark: SparkSession, *rows: dict) -> DataFrame:
    return table(spark, "matches", list(rows))


def keyed(df: DataFrame, *keys: str) -> dict:
    rows = [row.asDict() for row in df.collect()]
    found = {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r for r in rows}
    assert len(found) == len(rows), "keys are not unique"
    return found
