"""Marts from stored sides: the same rows, no exchange by team, and one read of the matches."""

from __future__ import annotations

import re

import pytest

import fixtures as fx
from rallymart.plans import side_table, standings
from rallymart.plans.registry import MARTS, SILVER, build, run_gold
from rallymart.sources import derived, staging, tables

SF_DIR = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted(str(r) for r in df.select(*sorted(df.columns)).collect())


@pytest.fixture
def views(spark):
    return derived.stored_views(spark, SF_DIR)


HOT = ("fct_national_matches_melted_by_team", "fct_national_team_stats", "fct_intern_standings")


@pytest.mark.parametrize("name, limit", [*[(n, None) for n in side_table.READERS], *[(n, 15) for n in HOT]])
def test_same_rows(spark, views, hot_limit, name, limit):
    whole = rows(build(spark, name, views))
    if limit:
        hot_limit(limit)
    sides = side_table.store_sides(views["matches"])
    assert (sides.hot is not None) == bool(limit)
    given = {**views, "matches": sides, "team_stats": side_table.beside(sides, views["team_stats"])}
    with side_table.placed_by_team(spark, sides):
        assert rows(build(spark, name, given)) == whole


def test_only_teams_beyond_the_limit_are_hot(spark, views, hot_limit):
    sizes = {}
    for row in side_table.store_sides(views["matches"]).ordinary.groupBy("team_id").count().collect():
        sizes[row[0]] = row[1]
    limit = sorted(sizes.values())[-3]
    hot_limit(limit)
    sides = side_table.store_sides(views["matches"])
    assert {r[0] for r in sides.hot.select("team_id").distinct().collect()} == {t for t in sizes if sizes[t] > limit}
    assert sides.ordinary.count() + sides.hot.count() == sides.rows == 2 * views["matches"].count()


def test_matches_come_back(spark, views, hot_limit):
    hot_limit(5)
    back = side_table.store_sides(views["matches"]).matches()
    assert rows(back) == rows(views["matches"].select(*back.columns))


def test_no_exchange_by_team(spark, views):
    """Joins as with large tables: sorted merges. Leagues alone are sent to every task."""
    sides = side_table.store_sides(views["matches"])
    stats = side_table.beside(sides, views["team_stats"])
    leagues = staging.stage(views["leagues"], "leagues")
    for name in ("fct_national_matches_melted_by_team", "fct_intern_matches_melted_by_team"):
        assert "Exchange" not in plan_of(build(spark, name, {**views, "matches": sides}))
    for name in ("fct_national_team_stats", "fct_intern_team_stats"):
        given = {**views, "matches": sides, "team_stats": stats.hint("merge"), "leagues": leagues}
        with side_table.placed_by_team(spark, sides):
            plan = plan_of(build(spark, name, given))
        assert "SortMergeJoin [team_id" in plan
        assert not re.search(r"Exchange hashpartitioning\(team_id", plan)
    assert plan_of(standings.domestic_teams(sides)).count("Exchange") == 0


def test_setting_is_put_back(spark, views):
    before = spark.conf.get(side_table.CO_PARTITION, None)
    sides = side_table.store_sides(views["matches"])
    with pytest.raises(ValueError), side_table.placed_by_team(spark, sides):
        assert spark.conf.get(side_table.CO_PARTITION) == "false"
        raise ValueError
    assert spark.conf.get(side_table.CO_PARTITION, None) == before


def test_a_full_run_reads_the_matches_once(spark, views, tmp_path, monkeypatch):
    silver = {}
    for name in SILVER:
        if name in derived.VIEWS:
            tables.write_table(views[name], str(tmp_path / "silver"), name)
            silver[name] = tables.read_table(spark, str(tmp_path / "silver"), name)
    read = {}

    def noted(given_spark, name, given):
        mart = build(given_spark, name, given)
        read[name] = any("silver/matches.parquet" in path for path in mart.inputFiles())
        return mart

    monkeypatch.setattr("rallymart.plans.registry.build", noted)
    run_gold(spark, silver, str(tmp_path / "gold"))
    assert set(read) == set(MARTS) and not any(read.values())
    for name in MARTS:
        if name != "dim_naipe":
            stored = tables.read_table(spark, str(tmp_path / "gold"), name)
            assert rows(stored) == rows(build(spark, name, silver).select(*stored.columns))


def test_no_matches_and_missing_teams(spark):
    empty = side_table.store_sides(fx.matches(spark))
    assert build(spark, "fct_national_matches_melted_by_team", {"matches": empty}).count() == 0
    few = fx.matches(spark, fx.match(1, None, "B", fx.FIVE), fx.match(2, "B", "B", fx.STRAIGHT))
    for name in ("fct_national_matches_melted_by_team", "fct_national_standings"):
        found = build(spark, name, {"matches": side_table.store_sides(few)})
        assert rows(found) == rows(build(spark, name, {"matches": few}))


def test_staged_buckets_are_dropped(spark, views):
    kept, names = list(staging._staged), list(staging._bucketed)
    staging._staged.clear(), staging._bucketed.clear()
    try:
        side_table.store_sides(views["matches"])
        table = staging._bucketed[0]
        assert spark.catalog.tableExists(table)
        staging.discard_staged(spark)
        assert not spark.catalog.tableExists(table)
    finally:
        staging._staged[:], staging._bucketed[:] = kept, names


@pytest.mark.parametrize("rows_of_bucket, buckets", [("1000", 10), ("10000000", 8)])
def test_buckets_grow_with_the_rows(spark, rows_of_bucket, buckets):
    spark.conf.set(side_table.BUCKET_ROWS_SETTING, rows_of_bucket)
    try:
        assert side_table.buckets_for(spark, 9_500) == buckets
    finally:
        spark.conf.unset(side_table.BUCKET_ROWS_SETTING)
