"""Documents to typed tables, upserts, incremental selection, and the full run."""

from __future__ import annotations

import json
import math
from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fixtures import keyed
from rallymart.operators import ingest, reshape
from rallymart.plans import layers
from rallymart.plans.registry import MARTS
from rallymart.sources import landing, staging, tables


def land(folder, entity, documents):
    path = folder / f"{entity}.json"
    path.write_text(json.dumps(documents, ensure_ascii=False, indent=2), encoding="utf-8")


# --- reshaping --------------------------------------------------------------------------


def test_flatten_and_json_text(spark, tmp_path):
    land(tmp_path, "x", [{"id": 1, "a": {"b": {"c": "ü"}, "l": [1, 2]}, "m": []}, {"id": 2}])
    bronze = layers.to_bronze(landing.read_landed(spark, str(tmp_path), "x"))
    assert sorted(bronze.columns) == ["a.b.c", "a.l", "id", "m"]
    rows = {r["id"]: r for r in bronze.collect()}
    assert rows[1]["a.b.c"] == "ü" and rows[1]["a.l"] == "[1,2]" and rows[1]["m"] == "[]"
    assert rows[2]["a.b.c"] is None and rows[2]["a.l"] is None


def test_explode_json_drops_empty_lists_and_nulls(spark):
    texts = ['[{"season": 2020}, null, {"season": 2021}]', "[]", None]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, seasons string")
    for schema in ("array<struct<season bigint>>", None):
        rows = reshape.explode_json(df, "seasons", schema)
        assert rows.columns == ["id", "season"]
        assert sorted(map(tuple, rows.collect())) == [(0, 2020), (0, 2021)]


def test_explode_json_flattens_elements_and_marks_clashes(spark):
    df = spark.createDataFrame([("g", '[{"name": "n", "team": {"id": 4}}]')], "name string, `d.x` string")
    rows = reshape.explode_json(df, "d.x")
    assert rows.columns == ["name", "d.x_name", "team.id"]
    assert tuple(rows.first()) == ("g", "n", 4)


def test_whole_numbers(spark):
    texts = ["25", " 7 ", "2.0", "2.5", "x", "", None, "-3", "1e3", "9007199254740993", "99999999999999999999"]
    df = spark.createDataFrame([(t,) for t in texts], "home_score string")
    assert [r[0] for r in reshape.cast_by_name(df).collect()] == [
        25, 7, 2, None, None, None, None, -3, 1000, 9007199254740993, None,
    ]
    numbers = spark.createDataFrame([(2.0,), (2.5,), (None,)], "set_number double")
    assert [r[0] for r in reshape.cast_by_name(numbers).collect()] == [2, None, None]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.integers(-(2**62), 2**62).map(str), st.floats(allow_nan=False).map(str), st.text("0123456789.+-e ", max_size=6)), min_size=20, max_size=20))
def test_whole_numbers_against_python(spark, texts):
    def expected(text):
        text = text.strip(" ")
        try:
            return int(text) if "_" not in text and abs(int(text)) < 2**63 else None
        except ValueError:
            pass
        try:
            number = float(text)
        except ValueError:
            return None
        whole = math.isfinite(number) and number == math.floor(number) and abs(number) < 2**63
        return int(number) if whole else None

    df = spark.createDataFrame(list(enumerate(texts)), "i int, home_score string")
    found = {r.i: r.home_score for r in reshape.cast_by_name(df).collect()}
    assert found == {i: expected(t) for i, t in enumerate(texts)}


def test_cast_by_name_order_of_rules(spark):
    df = spark.createDataFrame(
        [(1, 2.0, "3", "2020-05-01T10:20:00", "no date", 5, 0.5, "k")],
        "team_id bigint, league_name double, score_type string, match_date string, end_date string, "
        "week bigint, win_percent double, avg_score string",
    )
    row = reshape.cast_by_name(df).first().asDict()
    assert row == {
        "team_id": "1", "league_name": "2.0", "score_type": 3, "match_date": datetime(2020, 5, 1, 10, 20),
        "end_date": None, "week": 5,
    }
    assert "win_percent" in reshape.cast_by_name(df, keep_averages=True).columns


@pytest.mark.parametrize("zone", ["UTC", "America/Sao_Paulo"])
def test_wall_clock_does_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    texts = ["2023-05-30T18:00:00.000Z", "2023-05-30", "2023-05-30T18:00:00+02:00", "1999-10-03T00:00:00", "x", None]
    df = spark.createDataFrame([(t,) for t in texts], "match_date string")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert [r[0] for r in reshape.cast_by_name(df).collect()] == [
            datetime(2023, 5, 30, 18), datetime(2023, 5, 30), datetime(2023, 5, 30, 16), datetime(1999, 10, 3), None, None,
        ]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_names(spark):
    names = {
        "state.score.current": "current",
        "state.description": "description",
        "homeTeam.id": "homeTeam_id",
        "data_x.period": "x_set",
        "season": "league_season",
        "id": "match_id",
    }
    assert {n: reshape.renamed(n, {"id": "match_id", "current": "c"}) for n in names} == names


def test_drop_columns_and_split(spark):
    df = spark.createDataFrame(
        [("3 - 1", "i"), ("7", "i"), (None, "i"), ("1-2-3", "i")], "s string, team_image string"
    )
    assert reshape.drop_columns(df, ("nothing",)).columns == ["s"]
    halves = reshape.split_column(df, "s", "a", "b")
    assert halves.columns == ["s", "team_image", "a", "b"]
    assert [(r.a, r.b) for r in halves.collect()] == [("3 ", " 1"), ("7", None), (None, None), (None, None)]
    dotted = reshape.split_column(spark.createDataFrame([("1.2",)], "s string"), "s", "a", "b", ".")
    assert tuple(dotted.first())[1:] == ("1", "2")


# --- upserts and increments -------------------------------------------------------------


def test_upsert_takes_the_last_document_of_a_key(spark):
    old = spark.createDataFrame([("1", "old", 9), ("2", "old", 9)], "id string, v string, n int")
    new = spark.createDataFrame(
        [("1", "first", 1, "x"), ("1", "last", 2, "x"), ("3", "new", 1, None)],
        "id string, v string, n int, extra string",
    )
    rows = keyed(ingest.upsert(old, new, ingest.UPSERT_KEYS["matches"], ("n",)), "id")
    assert {k: (r["v"], r["extra"]) for k, r in rows.items()} == {
        "1": ("last", "x"), "2": ("old", None), "3": ("new", None),
    }


def test_upsert_cuts_keys_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("'k' AS id", "id AS n")
    plan = ingest.upsert(df, df, ("id",), ("n",))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_upsert_again_changes_nothing(spark):
    df = spark.createDataFrame([("1", 1, 2020, "a"), ("1", 2, 2020, "b")], "team_id string, leagueId int, season int, v string")
    keys = ingest.UPSERT_KEYS["team_stats"]
    once = ingest.upsert(df, df, keys)
    assert sorted(map(tuple, ingest.upsert(once, df, keys).collect())) == sorted(map(tuple, df.collect()))


def test_pending_seasons_and_leagues(spark):
    catalogue = spark.createDataFrame(
        [("a", 2019), ("a", 2020), ("a", 2021), ("b", 2020)], "league_id string, league_season int"
    )
    saved = spark.createDataFrame([("a", 2019), ("a", 2021), ("b", 2020)], catalogue.schema)
    pending = sorted(map(tuple, ingest.pending_seasons(catalogue, saved).collect()))
    assert pending == [("a", 2020), ("a", 2021), ("b", 2020)]
    only_a = saved.filter("league_id = 'a'")
    assert [r[0] for r in ingest.pending_leagues(catalogue, only_a).collect()] == ["b"]


def test_lookups_stamps_ids_and_days(spark):
    df = spark.createDataFrame([(1, "x"), (2, "y")], "id int, v string")
    assert ingest.first_match(df, F.col("id") == 2).first().v == "y"
    assert ingest.first_match(df, F.col("id") == 3).isEmpty()
    assert ingest.require_match(df, F.col("id") > 0, "league").count() == 1
    with pytest.raises(ValueError):
        ingest.require_match(df, F.col("id") == 3, "league")
    assert tuple(ingest.stamp(df, leagueId=7, season=2020).orderBy("id").first()) == (1, "x", 7, 2020)
    sides = spark.createDataFrame(
        [((1,), (2,)), ((2,), (3,)), ((9,), None)], "homeTeam struct<id:int>, awayTeam struct<id:int>"
    )
    assert sorted(r[0] for r in ingest.distinct_team_ids(sides).collect()) == [1, 2, 3]
    dates = spark.createDataFrame([("2021-02-03T10:00:00Z",), ("2020-12-31T23:00:00Z",)], "date string")
    assert ingest.first_day(dates, "date").first()[0] == "2020-12-31"


# --- landing and tables -----------------------------------------------------------------


def test_pages_are_joined_and_keep_their_place(spark, tmp_path):
    for i, page in enumerate([[{"id": 1}, {"id": 2}], [{"id": 3}], []]):
        (tmp_path / f"page-{i}.json").write_text(json.dumps({"data": page}))
    rows = landing.read_pages(spark, str(tmp_path)).collect()
    assert {(r["_page"].rsplit("/", 1)[1], r["_place"], r["id"]) for r in rows} == {
        ("page-0.json", 0, 1), ("page-0.json", 1, 2), ("page-1.json", 0, 3),
    }


def test_landed_documents_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, "ä"), (2, None)], "id bigint, name string")
    for _ in range(2):
        landing.write_landed(df, str(tmp_path), "teams")
    back = landing.read_landed(spark, str(tmp_path), "teams", lines=True)
    assert sorted(map(tuple, back.collect())) == [(1, "ä"), (2, None)]


def test_write_table_counts_and_replaces(spark, tmp_path):
    df = spark.range(100).selectExpr("id", "id % 3 AS league_season")
    assert tables.write_table(df, str(tmp_path), "t", ("league_season",)) == 100
    assert tables.write_table(df.filter("id < 10"), str(tmp_path), "t", ("league_season",)) == 10
    assert tables.read_table(spark, str(tmp_path), "t").count() == 10
    assert {p.name for p in (tmp_path / "t.parquet").iterdir() if p.is_dir()} == {
        f"league_season={i}" for i in range(3)
    }


def test_shared_folder_comes_from_the_session(spark, monkeypatch):
    asked = spark.conf.get(staging.SHARED_FOLDER, None)
    folder = staging.shared_folder(spark)
    assert folder == asked.rstrip("/") if asked else "rallymart-" in folder
    assert staging.stage(spark.range(5), "five").count() == 5


# --- the full run -----------------------------------------------------------------------


def landed_world(folder):
    def team(name):
        return {"id": sum(map(ord, name)), "name": name, "logo": f"t/{name}"}

    def score(sets):
        names = ("firstSet", "secondSet", "thirdSet", "fourthSet", "fifthSet")
        texts = dict.fromkeys(names)
        texts |= dict(zip(names, (f"{h} - {a}" for h, a in sets)))
        won = [h > a for h, a in sets]
        return {**texts, "current": f"{sum(won)} - {len(won) - sum(won)}"}

    def document(i, league, season, home, away, week, sets, country):
        return {
            "id": i, "date": f"{season}-03-{i % 28 + 1:02d}T18:00:00.000Z", "week": week,
            "leagueId": league["id"], "season": season, "country": country,
            "league": {"id": league["id"], "name": league["name"], "image": "x"},
            "homeTeam": team(home), "awayTeam": team(away) if away else None,
            "state": {"description": "Finished", "score": score(sets)},
        }

    straight, tight = [(25, 20)] * 3, [(25, 23), (23, 25), (25, 22), (25, 23)]
    aland, world = {"code": "AL", "name": "Åland"}, {"code": "World", "name": "World"}
    liga, cup = {"id": 1, "name": "Liga"}, {"id": 2, "name": "Nations League"}
    documents = [
        document(1, liga, 2020, "A", "B", "1", straight, aland),
        document(2, liga, 2020, "B", "A", "2", tight, aland),
        document(3, liga, 2020, "A", "B", "Final", tight, aland),
        document(4, cup, 2020, "Åland", "Cuba", "1", straight, world),
        document(5, cup, 2020, "Åland", "Cuba", "Final", tight, world),
        document(6, cup, 2021, "Cuba", None, "1", straight, world),
    ]
    land(folder, "matches", documents)
    land(folder, "leagues", [
        {"id": 1, "logo": "l", "name": "Liga", "country": aland, "seasons": [{"season": 2020}]},
        {"id": 2, "logo": "l", "name": "Nations League", "country": world,
         "seasons": [{"season": 2020}, {"season": 2021}]},
        {"id": 3, "logo": "l", "name": "Empty", "country": world, "seasons": []},
    ])
    land(folder, "teams", [team(n) for n in ("A", "B", "Åland", "Cuba")])
    land(folder, "countries", [
        {"code": "AL", "name": "Åland", "logo": "c/AL"}, {"code": "World", "name": "World", "logo": "c/W"},
        {"code": "CU", "name": "Cuba", "logo": "c/CU"},
    ])
    land(folder, "team_stats", [
        {"team_id": sum(map(ord, n)), "leagueId": 1, "leagueName": "Liga", "season": 2020, "avg_points": 1.5,
         "total": {"games": {"played": 3, "wins": 2, "loses": 1}, "points": {"scored": 200, "received": 190}}}
        for n in ("A", "B")
    ])
    land(folder, "standings", [
        {"leagueId": 1, "season": 2020, "data": {"groups": [
            {"name": "G1", "standings": [{"position": 1, "gamesPlayed": 2, "scoredPoints": 5, "receivedPoints": 3,
                                          "team": {"id": 65, "name": "A"}}, None]},
            {"name": "G2", "standings": []}]}},
    ])


def snapshot(spark, root):
    return {
        name: sorted(map(str, tables.read_table(spark, root, name).collect())) for name in MARTS
    }


def test_full_run_twice_gives_the_same_tables(spark, tmp_path):
    landed = tmp_path / "landed"
    landed.mkdir()
    landed_world(landed)
    root = str(tmp_path / "lake")
    rows = layers.run_all(spark, str(landed), root, lines=False)
    assert set(rows) == set(MARTS)
    assert rows["fct_national_matches"] == 3 and rows["fct_intern_matches"] == 3
    assert rows["fct_national_standings"] == 2 and rows["dim_countries"] == 4
    first = snapshot(spark, f"{root}/export")
    assert all(len(first[name]) == rows[name] for name in MARTS)

    silver = tables.read_table(spark, f"{root}/silver", "matches")
    assert {"current", "leagueId", "league_image"}.isdisjoint(silver.columns)
    row = silver.filter("match_id = '3'").first()
    assert (row.current_home_team_score, row.fourth_set_away_team_score, row.fifth_set_home_team_score) == (3, 23, None)
    assert row.match_date == datetime(2020, 3, 4, 18) and row.league_season == 2020
    catalogue = tables.read_table(spark, f"{root}/silver", "leagues")
    assert sorted((r.league_id, r.league_season) for r in catalogue.collect()) == [("1", 2020), ("2", 2020), ("2", 2021)]
    table = tables.read_table(spark, f"{root}/silver", "standings").collect()
    assert [(r.season_name, r.standing_position, r.games_played) for r in table] == [("G1", 1, 2)]
    assert "avg_points" not in tables.read_table(spark, f"{root}/silver", "team_stats").columns

    standings = keyed(tables.read_table(spark, f"{root}/export", "fct_national_standings"), "Team_id")
    assert standings["65"]["strength_cluster"] == "gold"
    summary = tables.read_table(spark, f"{root}/export", "fct_aggregation").collect()
    assert [(r.country_naipe_id, r.qtd_clubs) for r in summary] == [("AL_Men", 2)]

    layers.run_all(spark, str(landed), root, lines=False)
    assert snapshot(spark, f"{root}/export") == first


def test_landed_documents_are_merged_by_key(spark, tmp_path):
    land(tmp_path, "matches", [{"id": 1, "week": "1"}, {"id": 2, "week": "1"}])
    loads = [[(2, "late", 2), (2, "early", 1), (3, "new", 3)], [(3, "newer", 1)]]
    expected = [[(1, "1"), (2, "late"), (3, "new")], [(1, "1"), (2, "late"), (3, "newer")]]
    for i, rows in enumerate(loads):
        new = spark.createDataFrame(rows, "id bigint, week string, _place int")
        landing.upsert_landed(spark, str(tmp_path), "matches", new, ("_place",), lines=i > 0)
        back = landing.read_landed(spark, str(tmp_path), "matches", lines=True)
        assert sorted((r.id, r.week) for r in back.collect()) == expected[i]
    landing.upsert_landed(spark, str(tmp_path), "teams", spark.createDataFrame([(7, "t")], "id bigint, name string"))
    assert landing.read_landed(spark, str(tmp_path), "teams", lines=True).count() == 1
