"""Parts of the aggregation are merged exactly, season by season."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from rallymart.plans import aggregation, parts

SCHEMAS = {
    "dim_leagues": "League_id string, league_naipe string, country_id string",
    "dim_season": "League_season_id string, league_id string",
    "dim_teams": "Team_id string, country_id string",
    "fct_national_matches": "league_season_id string, n_tight_sets bigint",
    "fct_intern_standings": "League_season_id string, Team_id string, strength_level bigint",
    "fct_national_standings": "League_season_id string, Team_id string",
}


def marts(spark, seasons):
    """Two countries; clubs and leagues come back every season, one season has no known league."""
    rows = {name: [] for name in SCHEMAS}
    rows["dim_leagues"] = [("1", "Men", "A"), ("2", "Men", "A"), ("3", "Women", "B"), ("w", "Men", "World")]
    rows["dim_teams"] = [("t1", "A"), ("t2", "B")]
    for s in seasons:
        for league in ("1", "2", "3", "w"):
            rows["dim_season"].append((f"{league}_{s}", league))
            rows["fct_national_matches"] += [(f"{league}_{s}", s % 3), (f"{league}_{s}", None)]
        for club in range(40_000 if s == 2000 else 50):
            rows["fct_national_standings"].append((f"{1 + club % 3}_{s}", f"c{club + s % 2}"))
        rows["fct_national_standings"].append((f"x_{s}", "c1"))
        rows["fct_national_matches"].append((f"x_{s}", 9))
        rows["fct_intern_standings"] += [(f"w_{s}", "t1", 1 + s % 5), (f"w_{s}", "t2", 8), (f"w_{s}", "none", 3)]
    return {name: spark.createDataFrame(rows[name], schema) for name, schema in SCHEMAS.items()}


def expected(found):
    return sorted(map(str, aggregation.fct_aggregation(**found).collect()))


def test_parts_equal_the_mart(spark, tmp_path):
    found = marts(spark, [2000, 2001, 2002])
    root = str(tmp_path)
    parts.refresh_parts(spark, root, found, F.col("season") == "2001")
    parts.refresh_parts(spark, root, found, F.col("season") != "2001")
    assert sorted(map(str, parts.merged_parts(spark, root).collect())) == expected(found)
    plan = parts.merged_parts(spark, root)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and "Join" not in plan


def test_a_season_written_again_takes_the_place_of_its_parts(spark, tmp_path):
    root = str(tmp_path)
    parts.refresh_parts(spark, root, marts(spark, [2001, 2002]))
    numbers = {tuple(r) for r in spark.read.parquet(f"{root}/id_numbers.parquet").collect()}
    changed = marts(spark, [2001, 2002, 2003])
    changed["fct_national_standings"] = changed["fct_national_standings"].filter("NOT (League_season_id = '2_2002')").union(
        spark.createDataFrame([("3_2002", "new"), ("3_2003", "newer")], "a string, b string")
    )
    parts.refresh_parts(spark, root, changed, F.col("season") >= "2002")
    assert sorted(map(str, parts.merged_parts(spark, root).collect())) == expected(changed)
    after = [tuple(r) for r in spark.read.parquet(f"{root}/id_numbers.parquet").collect()]
    assert numbers < set(after)
    for kind in parts.COUNTED:
        given = sorted(n for k, _, n in after if k == kind)
        assert given == list(range(1, len(given) + 1))


@pytest.mark.parametrize("seasons", [[], [2001]])
def test_nothing_is_an_empty_mart(spark, tmp_path, seasons):
    found = marts(spark, seasons)
    found["fct_national_standings"] = found["fct_national_standings"].limit(0)
    parts.refresh_parts(spark, str(tmp_path), found)
    assert parts.merged_parts(spark, str(tmp_path)).count() == 0 == aggregation.fct_aggregation(**found).count()
