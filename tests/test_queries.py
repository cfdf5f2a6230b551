"""Every registered query against its DuckDB statement, over whole tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from compare import differences, duck

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return duck(SF_DIR)


OWN = sorted(set(entry.queries()) - set(entry.LLM_QUERIES))


def test_every_query_has_a_statement():
    assert set(OWN) == set(entry.oracle_sql()) - set(entry.LLM_SQL)


@pytest.mark.parametrize("name", OWN)
def test_query_equals_statement(spark, connection, name):
    result = entry.queries()[name](spark, SF_DIR)
    assert differences(result, connection, entry.oracle_sql()[name]) is None


def test_entry_gives_rows(spark):
    assert entry.entry(spark).count() > 0


RANKED = [
    "fct_intern_matches_melted_by_team",
    "fct_national_matches_melted_by_team",
    "fct_intern_standings",
    "fct_national_standings",
    "rule_series_rank",
    "win_recency",
]


@pytest.mark.parametrize("name", RANKED)
def test_hot_groups_give_the_same_rows(spark, connection, hot_limit, name):
    hot_limit(3)
    result = entry.queries()[name](spark, SF_DIR)
    assert differences(result, connection, entry.oracle_sql()[name]) is None


@pytest.mark.parametrize("threads", [1, 4, 8])
def test_standings_are_in_a_total_order(spark, threads):
    """Teams under two names can be equal in all results; both sides must still agree."""
    sf_dir, name = "/root/testdata/sf0.01", "fct_national_standings"
    by_threads = duck(sf_dir)
    by_threads.execute(f"SET threads = {threads}")
    assert differences(entry.queries()[name](spark, sf_dir), by_threads, entry.oracle_sql()[name]) is None
