from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from rallymart.operators import ranking
from rallymart.operators.ranking import (
    by_group_size,
    group_totals,
    hot_groups,
    join_null_safe,
    row_numbers,
    with_ordinals,
)

KEYS = {"place": ["team"], "place_in_season": ["team", "season"]}

def order():
    return [F.desc("day"), F.asc("id")]


def skewed_rows(n=3000):
    """A third of the rows belong to one team, some to none; days repeat or are missing."""
    rng = random.Random(7)
    rows = []
    for i in range(n):
        team = "hot" if i % 3 == 0 else rng.choice([None, "a", "b", "c", "d"])
        day = rng.choice([None, *range(20)])
        rows.append((team, rng.choice([None, 2019, 2020]), day, f"m{i:05d}"))
    return rows


def brute_force(rows):
    def place(row, keys):
        group = [r for r in rows if all(r[k] == row[k] for k in keys)]
        # Descending days put missing ones last.
        ordered = sorted(group, key=lambda r: (r[2] is None, -(r[2] or 0), r[3]))
        return ordered.index(row) + 1

    return {r[3]: (place(r, [0]), place(r, [0, 1])) for r in rows}


@pytest.mark.parametrize("blocks", [0, 7])
def test_row_numbers_against_brute_force(spark, blocks):
    rows = skewed_rows(900)
    df = spark.createDataFrame(rows, "team string, season int, day int, id string").repartition(5)
    result = row_numbers(df, order(), KEYS, ["team"], blocks)
    assert result.columns == ["team", "season", "day", "id", "place", "place_in_season"]
    found = {r["id"]: (r["place"], r["place_in_season"]) for r in result.collect()}
    assert found == brute_force(rows)


def test_a_hot_group_is_spread_over_blocks(spark):
    seen = []
    plain_stage = ranking.stage
    try:
        ranking.stage = lambda df, name: seen.append(plain_stage(df, name)) or seen[-1]
        df = spark.createDataFrame(skewed_rows(), "team string, season int, day int, id string")
        row_numbers(df.repartition(8), order(), KEYS, ["team"], blocks=8).collect()
    finally:
        ranking.stage = plain_stage
    blocks = seen[0].filter("team = 'hot'").groupBy("_block").count().collect()
    assert len(blocks) >= 2
    assert max(r["count"] for r in blocks) < 1000


def test_hot_groups_are_those_above_the_setting(spark, hot_limit):
    df = spark.createDataFrame(skewed_rows(300), "team string, season int, day int, id string")
    assert hot_groups(df, ["team"]) is None
    hot_limit(99)
    hot = hot_groups(df, ["team"])
    assert [r.team for r in hot.keys.collect()] == ["hot"] and (hot.groups, hot.blocks) == (1, 2)
    hot_limit(100)
    assert hot_groups(df, ["team"]) is None
    assert hot_groups(df.limit(0), ["team"]) is None


@pytest.mark.parametrize("limit", [20, 99, 10_000])
@pytest.mark.parametrize("sent", [100_000, 0])
def test_only_hot_groups_take_the_other_way(spark, hot_limit, monkeypatch, limit, sent):
    monkeypatch.setattr(ranking, "MOST_SENT", sent)
    hot_limit(limit)
    rows = skewed_rows(300)
    df = spark.createDataFrame(rows, "team string, season int, day int, id string").repartition(5)
    ways = []

    def work(part, blocks):
        ways.append(blocks)
        return row_numbers(part, order(), KEYS, ["team"], blocks)

    result = by_group_size(df, ["team"], hot_groups(df, ["team"]), work)
    assert {r["id"]: (r["place"], r["place_in_season"]) for r in result.collect()} == brute_force(rows)
    assert len(ways) == (1 if limit == 10_000 else 2) and ways[0] == 0


def test_ordinals(spark):
    rows = skewed_rows(500)
    df = spark.createDataFrame(rows, "team string, season int, day int, id string").repartition(6)
    found = with_ordinals(df, [F.asc("team"), *order()], "place").collect()
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[2] is None, -(r[2] or 0), r[3]))
    assert [r["id"] for r in sorted(found, key=lambda r: r["place"])] == [r[3] for r in ordered]
    assert sorted(r["place"] for r in found) == list(range(1, 501))
    assert with_ordinals(df.limit(0), order(), "place").count() == 0


@pytest.mark.parametrize("blocks", [0, 7])
def test_group_totals(spark, blocks):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 5), ("b", None)], "k string, v int")
    rows = group_totals(df, ["k"], {"total": "v", "n": "1"}, blocks).collect()
    assert sorted(map(str, ((r.k, r.v, r.total, r.n) for r in rows))) == sorted(
        map(str, [("a", 1, 3, 2), ("a", 2, 3, 2), (None, 5, 5, 1), ("b", None, None, 1)])
    )


def test_join_null_safe_meets_missing_keys(spark):
    left = spark.createDataFrame([(None, 1), ("a", 2)], "k string, v int")
    right = spark.createDataFrame([(None, 10), ("b", 20)], "k string, w int")
    assert [tuple(r) for r in join_null_safe(left, right, ["k"]).collect()] == [(None, 1, 10)]
