"""Shape of the plans: what reaches the scan, what is shuffled, and that joins do without broadcasts."""

from __future__ import annotations

import contextlib
import io
import re

import pytest

import __spark_entry__ as entry
from compare import differences, duck
from rallymart.functions import rules
from rallymart.operators import ranking
from rallymart.plans.matches import hot_teams, team_seasons
from rallymart.plans.registry import build, inputs_of
from rallymart.sources import derived, staging
from rallymart.sources.tables import read_table, write_table

SF_DIR = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.LLM_QUERIES)))
def test_no_python_and_no_all_pairs(spark, name):
    plan = plan_of(entry.queries()[name](spark, SF_DIR))
    for node in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEval"):
        assert node not in plan


def test_filters_and_columns_reach_the_scan(spark):
    stored = derived.stored_views(spark, SF_DIR)["matches"]
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        team_seasons(stored, rules.domestic_scope()).explain("formatted")
    plan = text.getvalue()
    pushed = re.search(r"PushedFilters: \[(.*?)\]", plan).group(1)
    assert "EqualTo(description,Finished)" in pushed and "Not(In(country_name" in pushed
    schema = re.search(r"ReadSchema: struct<(.*?)>", plan).group(1)
    assert {part.split(":")[0] for part in schema.split(",")} == {
        "league_id", "league_season", "country_code", "country_name", "description", "homeTeam_id", "awayTeam_id",
    }
    assert hot_teams(stored) is None


@pytest.mark.parametrize(
    "name, exchanges",
    [
        ("fct_national_matches_melted_by_team", 1),
        ("fct_national_standings", 2),
        ("dim_team_by_season", 1),
        ("fct_intern_matches", 0),
    ],
)
def test_number_of_shuffles(spark, name, exchanges):
    plan = plan_of(entry.queries()[name](spark, SF_DIR))
    assert plan.count("Exchange hashpartitioning") == exchanges


def test_aggregation_reads_each_mart_once(spark, tmp_path):
    views, marts = derived.stored_views(spark, SF_DIR), {}
    for name in inputs_of("fct_aggregation"):
        write_table(build(spark, name, views), str(tmp_path), name)
        marts[name] = read_table(spark, str(tmp_path), name)
    before = list(staging._staged)
    plan = plan_of(build(spark, "fct_aggregation", marts))
    assert plan.count("FileScan") == 6 and staging._staged == before


@pytest.mark.parametrize("name", ["dim_leagues", "dim_teams"])
def test_text_maxima_sort_distinct_rows_only(spark, name):
    plan = plan_of(entry.queries()[name](spark, SF_DIR))
    for below in plan.split("SortAggregate")[1:]:
        nodes = re.findall(r"SortAggregate|HashAggregate|FileScan", below)
        assert nodes[:1] != ["FileScan"]


@pytest.mark.parametrize(
    "name", ["fct_aggregation", "fct_intern_standings", "fct_intern_team_stats", "dim_teams", "incremental_pending"]
)
def test_results_hold_without_broadcasts(spark, name):
    setting = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(setting, "-1")
    try:
        result = entry.queries()[name](spark, SF_DIR)
        assert "BroadcastHashJoin" not in plan_of(result)
        assert differences(result, duck(SF_DIR), entry.oracle_sql()[name]) is None
    finally:
        spark.conf.unset(setting)


@pytest.mark.parametrize("name", ["fct_national_matches_melted_by_team", "win_recency"])
def test_many_sides_lie_in_many_partitions(spark, monkeypatch, name):
    monkeypatch.setattr(ranking, "PARTITION_ROWS", 100)
    result = entry.queries()[name](spark, SF_DIR)
    plan = plan_of(result)
    assert "REPARTITION_BY_NUM" in plan and plan.count("Exchange hashpartitioning") == 1
    assert differences(result, duck(SF_DIR), entry.oracle_sql()[name]) is None


@pytest.mark.parametrize("name", ["fct_national_matches_melted_by_team", "fct_intern_matches_melted_by_team"])
def test_hot_teams_move_once(spark, hot_limit, name):
    """Without broadcasts by size: one exchange of all sides and one of those of hot teams."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        hot_limit(3)
        plan = plan_of(entry.queries()[name](spark, SF_DIR))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") <= 3 and "SortMergeJoin" not in plan
