"""Ingestion keeps what was landed, or fails; it never drops documents or fields silently."""

from __future__ import annotations

import json

import pytest

from rallymart.operators import ingest, reshape
from rallymart.plans import layers, standings
from rallymart.sources import landing, tables
from rallymart.sources.schemas import SILVER_SCHEMAS


def test_a_reader_error_does_not_wipe_the_landed_documents(spark, tmp_path):
    folder = tmp_path / "teams.json"
    folder.mkdir()
    text = json.dumps({"id": "1", "Name": "a"}) + "\n" + json.dumps({"id": "2", "Name": "b", "name": "c"})
    (folder / "part-0.json").write_text(text)
    new = spark.createDataFrame([("3", "d")], "id string, name string")
    with pytest.raises(Exception, match="COLUMN_ALREADY_EXISTS"):
        landing.upsert_landed(spark, str(tmp_path), "teams", new)
    assert (folder / "part-0.json").read_text() == text


def test_malformed_documents_are_an_error(spark, tmp_path):
    (tmp_path / "teams.json").write_text('{"id": "1"}\n{"id": \n')
    with pytest.raises(Exception, match="MALFORMED_RECORD|Malformed"):
        landing.read_landed(spark, str(tmp_path), "teams", lines=True).collect()


def test_a_field_that_gives_the_load_order_stays(spark, tmp_path):
    for day in ("2020-01-01", "2020-02-01"):
        new = spark.createDataFrame([("1", day), ("1", day[:-1] + "0")], "id string, date string")
        landing.upsert_landed(spark, str(tmp_path), "matches", new, ("date",))
    rows = landing.read_landed(spark, str(tmp_path), "matches", lines=True).collect()
    assert [(r.id, r.date) for r in rows] == [("1", "2020-02-01")]


def test_a_repeated_key_needs_a_load_order(spark, tmp_path):
    new = spark.createDataFrame([("1", "a"), ("1", "b")], "id string, name string")
    with pytest.raises(ValueError, match="load_order"):
        landing.upsert_landed(spark, str(tmp_path), "teams", new)


def test_a_missing_key_is_an_error(spark):
    new = spark.createDataFrame([(None, 1), (None, 2)], "id string, n int")
    with pytest.raises(Exception, match="without id"):
        ingest.upsert(new.limit(0), new, ("id",), ("n",)).collect()


def test_seasons_keep_their_fields_and_their_numbers(spark):
    rows = [("1", '[{"season": "2020", "start": "x"}, {"season": 2021, "start": null}]'), ("2", "[]"), ("3", None)]
    bronze = spark.createDataFrame(rows, "id string, seasons string")
    found = layers.silver_leagues(bronze).collect()
    assert sorted((r.league_id, r.league_season, r.start) for r in found) == [("1", 2020, "x"), ("1", 2021, None)]
    bad = spark.createDataFrame([("1", '[{"season": "2020/21"}, {"season": 2021}]')], "id string, seasons string")
    with pytest.raises(Exception, match="not a season: 2020/21"):
        layers.silver_leagues(bad).collect()
    broken = spark.createDataFrame([("1", "[{")], "id string, seasons string")
    with pytest.raises(Exception, match="MALFORMED|Malformed|malformed"):
        layers.silver_leagues(broken, "array<struct<season bigint>>").collect()


def test_null_fields_stay_in_json_text(spark):
    df = spark.sql("SELECT array(named_struct('start', 1, 'end', CAST(NULL AS INT))) AS seasons")
    assert reshape.nested_to_text(df).first()[0] == '[{"start":1,"end":null}]'


def test_all_json_of_a_folder_is_loaded(spark, tmp_path):
    for name in ("venues", "teams"):
        landing.write_landed(spark.range(2), str(tmp_path / "landed"), name)
    (tmp_path / "landed" / "notes.txt").write_text("no table")
    assert landing.landed_entities(spark, str(tmp_path / "landed")) == ["teams", "venues"]
    rows = layers.run_bronze(spark, str(tmp_path / "landed"), str(tmp_path / "bronze"))
    assert rows == {"teams": 2, "venues": 2}


def test_an_empty_layout_table_can_be_written_and_read(spark, tmp_path):
    schema = SILVER_SCHEMAS["matches"]
    empty = spark.createDataFrame([], schema)
    assert tables.write_table(empty, str(tmp_path), "matches", ("league_season",)) == 0
    back = tables.read_table(spark, str(tmp_path), "matches", schema)
    assert back.count() == 0 and dict(back.dtypes)["league_season"] == "bigint"


def test_other_leagues_are_left_out(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "league_id int, v string")
    assert [r.v for r in ingest.of_league(df, 1, "league_id").collect()] == ["a"]


def test_a_team_with_two_names_takes_one_place_in_a_series(spark):
    """A plays under two league names and wins the only final over B."""
    score = {"firstSet": (25, 20), "second_set": (25, 20), "third_set": (25, 20)}
    names = [f.name for f in spark.createDataFrame([], SILVER_SCHEMAS["matches"]).schema]

    def match(number, league, week, home, away):
        row = dict.fromkeys(names)
        row |= {"match_id": str(number), "league_id": "1", "league_name": league, "league_season": 2020}
        row |= {"country_code": "C", "country_name": "Land", "match_week": week, "description": "Finished"}
        row |= {"homeTeam_id": home, "awayTeam_id": away, "homeTeam_name": home, "awayTeam_name": away}
        row |= {"current_home_team_score": 3, "current_away_team_score": 0}
        for name, (h, a) in score.items():
            row |= {f"{name}_home_team_score": h, f"{name}_away_team_score": a}
        return tuple(row[n] for n in names)

    rows = [match(1, "Liga", "1", "A", "B"), match(2, "Cup", "2", "A", "C"), match(3, "Liga", "3", "B", "C")]
    rows.append(match(4, "Liga", "Final", "A", "B"))
    found = standings.fct_national_standings(spark.createDataFrame(rows, SILVER_SCHEMAS["matches"]))
    levels = {(r.Team_id, r.strength_cluster) for r in found.collect()}
    assert {("A", "gold"), ("B", "silver")} <= levels
    assert not {("A", "silver"), ("B", "gold")} & levels
