"""The marts over hand-made tables, one case per rule that is easy to get wrong."""

from __future__ import annotations

from datetime import datetime

import pytest

from fixtures import FIVE, STRAIGHT, keyed, match, matches, table, world
from rallymart.plans import aggregation, dims, standings, team_stats
from rallymart.plans import matches as facts
from rallymart.plans.registry import DISPLAY_ORDER, MARTS, in_display_order, inputs_of, run_order

FOUR = ["25-20", "20-25", "25-20", "25-20"]


def flip(sets):
    return ["-".join(reversed(text.split("-"))) for text in sets]


def countries(spark, *names):
    rows = [{"country_code": n[:2].upper(), "country_name": n, "country_logo": f"l/{n}"} for n in names]
    return table(spark, "countries", rows)


def leagues(spark, *rows):
    keys = ("league_id", "league_name", "league_season", "country_code", "country_name")
    return table(spark, "leagues", [dict(zip(keys, row)) for row in rows])


# --- national standings -----------------------------------------------------------------


def test_two_leg_final_is_ranked_as_a_series(spark):
    df = matches(
        spark,
        match(1, "A", "B", STRAIGHT),
        match(2, "B", "A", STRAIGHT),
        match(3, "A", "B", STRAIGHT, "Final"),
        match(4, "B", "A", FIVE, "Final"),
    )
    rows = keyed(standings.fct_national_standings(df), "Team_id")
    assert (rows["A"]["finalist_bucket"], rows["B"]["finalist_bucket"]) == (1, 2)
    assert rows["A"]["strength_cluster"] == "gold"
    assert rows["B"]["final_rank"] == 2


def test_sweeping_team_has_no_ratio_and_loses_ties(spark):
    df = matches(
        spark,
        match(1, "A", "X", STRAIGHT),
        match(2, "B", "Y", FOUR),
        match(3, "C", "Z", FOUR),
    )
    rows = keyed(standings.fct_national_standings(df), "Team_id")
    assert rows["A"]["set_ratio"] is None
    assert [rows[t]["prelim_position"] for t in "BCA"] == [1, 2, 3]


def test_one_match_seasons_are_dropped(spark):
    df = matches(
        spark,
        match(1, "A", "B", STRAIGHT),
        match(2, "A", "B", STRAIGHT, league_id="11"),
        match(3, "B", "A", STRAIGHT, league_id="11"),
    )
    rows = standings.fct_national_standings(df).collect()
    assert {r.League_season_id for r in rows} == {"11_2020"}


def test_final_rank_counts_up_per_season(spark):
    teams = [f"t{i}" for i in range(6)]
    rounds = [
        match(10 * i + j, teams[i], teams[j], FIVE if (i + j) % 2 else STRAIGHT)
        for i in range(6)
        for j in range(6)
        if i != j
    ]
    finals = [
        match(101, "t5", "t4", STRAIGHT, "Final"),
        match(102, "t3", "t2", STRAIGHT, "3rd place"),
        match(103, "t1", "t0", STRAIGHT, "Quarter-finals"),
    ]
    rows = keyed(standings.fct_national_standings(matches(spark, *rounds, *finals)), "Team_id")
    assert sorted(r["final_rank"] for r in rows.values()) == [1, 2, 3, 4, 5, 6]
    assert [rows[t]["final_rank"] for t in ("t5", "t4", "t3", "t2")] == [1, 2, 3, 4]
    assert {rows[t]["strength_level"] for t in ("t1", "t0")} == {5}
    assert all(r["games_won"] + r["games_lost"] == 10 for r in rows.values())


def test_team_with_finals_only_is_absent_but_takes_its_place(spark):
    df = matches(
        spark,
        match(1, "A", "B", STRAIGHT),
        match(2, "B", "A", STRAIGHT),
        match(3, "Z", "A", STRAIGHT, "Final"),
    )
    rows = keyed(standings.fct_national_standings(df), "Team_id")
    assert set(rows) == {"A", "B"}
    assert rows["A"]["finalist_bucket"] == 2


def test_series_counts_across_league_names(spark):
    playoff = {"league_name": "Liga Playoff"}
    df = matches(
        spark,
        match(1, "A", "B", STRAIGHT),
        match(2, "A", "C", STRAIGHT),
        match(3, "C", "B", STRAIGHT),
        match(4, "B", "A", STRAIGHT, "Final", **playoff),
        match(5, "C", "D", STRAIGHT, "3rd place", **playoff),
        match(6, "D", "C", STRAIGHT, "3rd place"),
        match(7, "D", "C", STRAIGHT, "3rd place", **playoff),
    )
    rows = keyed(standings.fct_national_standings(df), "Team_id")
    assert {t: r["finalist_bucket"] for t, r in rows.items()} == {"B": 1, "A": 2, "C": 4}
    assert [rows[t]["final_rank"] for t in "BAC"] == [1, 2, 3]


# --- world standings --------------------------------------------------------------------


def world_case(spark):
    home = {"league_id": "1", "league_name": "Liga"}
    df = matches(
        spark,
        match(1, "c1", "c2", STRAIGHT, country_code="AL", country_name="Aland", **home),
        match(2, "c3", "c4", STRAIGHT, country_code="BR", country_name="Brasil", **home),
        match(3, "c5", "c6", STRAIGHT, country_code="CU", country_name="Cuba", **home),
        match(4, "f1", "f2", STRAIGHT, country_code="DI", country_name="Dinamo",
              league_id="2", league_name="Liga Femenina"),
        world(11, "AL", "BR", STRAIGHT, homeTeam_name="Aland", awayTeam_name="Brasil"),
        world(12, "AL", "DI", STRAIGHT, homeTeam_name="Aland", awayTeam_name="Dinamo"),
        world(13, "AL", "BR", STRAIGHT, "Final", homeTeam_name="Aland", awayTeam_name="Brasil"),
        world(14, "CU", "AL", STRAIGHT, league_season=2021, homeTeam_name="Cuba", awayTeam_name="Aland"),
        world(15, "DW", "AL", STRAIGHT, homeTeam_name="Dinamo Women", awayTeam_name="Aland"),
    )
    return df, countries(spark, "Aland", "Brasil", "Cuba", "Dinamo", "World")


def test_world_grid_and_absent_teams(spark):
    rows = keyed(standings.fct_intern_standings(*world_case(spark)), "League_season_id", "Team_id")
    teams, editions = {"AL", "BR", "CU", "DI"}, {"900_2020", "900_2021"}
    assert set(rows) == {(e, t) for e in editions for t in teams}
    absent = rows["900_2020", "CU"]
    assert (absent["strength_level"], absent["strength_cluster"]) == (8, "not_present")
    assert absent["rank_position"] is None and absent["games_won"] == 0
    assert rows["900_2020", "AL"]["strength_cluster"] == "gold"
    assert rows["900_2020", "BR"]["strength_cluster"] == "silver"


def test_eligibility_knows_the_english_word_only(spark):
    eligible = {tuple(r) for r in standings.eligible_teams(*world_case(spark)).collect()}
    # A league named `Femenina` counts as men's here, so the women's team has no league.
    assert eligible == {("AL", "Men"), ("BR", "Men"), ("CU", "Men"), ("DI", "Men")}


def test_top_half_of_the_eliminated_is_the_integer_half(spark):
    teams = [f"e{i}" for i in range(5)]
    rows = [world(10 * i + j, teams[i], teams[j], STRAIGHT) for i in range(5) for j in range(i + 1, 5)]
    ranked = standings.rank_world(standings.world_teams(matches(spark, *rows)), 0)
    levels = {r.team_id: r.strength_level for r in ranked.collect()}
    assert levels == {"e0": 6, "e1": 6, "e2": 7, "e3": 7, "e4": 7}


# --- match facts ------------------------------------------------------------------------


def test_match_facts_and_scopes(spark):
    df = matches(
        spark,
        match(1, "A", "B", FIVE),
        world(2, "A", "B", STRAIGHT, country_name="Elsewhere", country_code="E"),
        match(3, "A", "B", STRAIGHT, description="Not started"),
    )
    national = keyed(facts.fct_national_matches(df), "Match_id")
    assert set(national) == {"1", "2"}
    assert national["1"]["total_sets"] == 5 and national["1"]["match_winner"] == "A"
    assert national["1"]["match_date"] == "2020-01-01 00:00"
    # The match table takes the competition names alone, the side table asks for World too.
    assert set(keyed(facts.fct_intern_matches(df), "Match_id")) == {"2"}
    assert facts.fct_intern_matches_melted_by_team(df).count() == 0


def test_recency_orders(spark):
    df = matches(
        spark,
        match(1, "A", "B", STRAIGHT, day=1),
        match(2, "B", "A", STRAIGHT, "Semi-finals", day=2),
        match(3, "A", "B", STRAIGHT, "Final", day=3),
        match(4, "A", "C", STRAIGHT, day=3, league_season=2021),
    )
    rows = keyed(facts.fct_national_matches_melted_by_team(df), "Team_id", "match_id")
    assert len(rows) == 8
    order = {m: rows["A", m] for m in "1234"}
    assert [order[m]["match_order_general"] for m in "3421"] == [1, 2, 3, 4]
    assert [order[m]["match_order_champ"] for m in "3214"] == [1, 2, 3, 1]
    assert [order[m]["match_order_finals"] for m in "3214"] == [1, 2, None, None]
    assert order["2"]["champ_phase"] == "Finals"


# --- team statistics --------------------------------------------------------------------


def stats_case(spark):
    df = matches(
        spark,
        world(1, "A", "B", STRAIGHT, "Final"),
        world(2, "A", "B", ["25-23", "23-25", "25-23", "23-25", "15-13"], "Semi-finals"),
    )
    catalogue = leagues(
        spark, ("900", "Nations League", 2020, "World", "World"), ("900", "Nations League", 2021, "World", "World")
    )
    stats = table(
        spark,
        "team_stats",
        [
            {"league_id": "900", "team_id": "A", "league_season": 2020, "total_points_scored": 9, "total_points_received": 4},
            {"league_id": "77", "team_id": "A", "league_season": 2020},
            {"league_id": "900", "team_id": "Q", "league_season": 2020},
        ],
    )
    return df, catalogue, stats


@pytest.mark.parametrize("scope_join, times", [("inner", 2), ("semi", 1)])
def test_counts_repeat_per_catalogue_row(spark, scope_join, times):
    mart = team_stats.fct_intern_team_stats(*stats_case(spark), scope_join=scope_join)
    rows = keyed(mart, "Team_id", "league_id")
    for league in ("900", "77"):
        row = rows["A", league]
        assert row["total_finals"] == times and row["total_semi_finals"] == times
        assert row["n_3_x_0_wins"] == times and row["total_games_5_sets"] == times
        assert row["set_1_win"] == 2 * times and row["set_4_win"] == 0
        assert row["n_tight_games_won"] == times
    assert rows["A", "900"]["points_delta"] == 5
    assert rows["Q", "900"]["total_finals"] == 0


def test_national_scope_is_tested_on_the_catalogue(spark):
    df, catalogue, stats = stats_case(spark)
    assert all(r.total_finals == 0 for r in team_stats.fct_national_team_stats(df, catalogue, stats).collect())
    with pytest.raises(ValueError):
        team_stats.fct_intern_team_stats(df, catalogue, stats, scope_join="left")


# --- dimensions -------------------------------------------------------------------------


def test_dim_naipe(spark):
    assert [tuple(r) for r in dims.dim_naipe(spark).orderBy("naipe_id").collect()] == [(1, "Men"), (2, "Women")]


def test_dim_countries(spark):
    rows = dims.dim_countries(countries(spark, "Aland", "World", "Europe")).collect()
    assert {r.country_naipe_id for r in rows} == {"AL_Men", "AL_Women"}


def test_dim_season_end_dates(spark):
    df = matches(
        spark,
        match(1, "A", "B", STRAIGHT, "Semi-finals", day=5, league_season=2020),
        match(2, "A", "B", STRAIGHT, "3", day=7, league_season=2021),
        match(3, "A", "B", STRAIGHT, "Final", day=9, league_season=2021, league_id="11"),
        match(4, "A", "B", STRAIGHT, "Final", day=9, league_season=2022, league_id="99"),
    )
    catalogue = leagues(
        spark, ("10", "L", 2020, "AA", "Aland"), ("10", "L", 2021, "AA", "Aland"), ("11", "M", 2021, "AA", "Aland")
    )
    rows = keyed(dims.dim_season(catalogue, df), "League_season_id")
    assert set(rows) == {"10_2020", "10_2021", "11_2021"}
    assert rows["10_2020"]["season_end_date"] == datetime(2020, 1, 5)
    assert rows["10_2021"]["season_end_date"] is None
    assert rows["10_2021"]["season_status"] == "Not Finished"
    assert rows["11_2021"]["season_status"] == "Finished"


def test_dim_leagues(spark):
    df = matches(spark, match(1, "A", "B", STRAIGHT))
    catalogue = leagues(
        spark,
        ("10", "Liga Women", 2020, "AA", "Aland"),
        ("900", "Olympic Games", 2020, "World", "World"),
        ("990", "Champions League", 2020, "Europe", "Europe"),
    )
    rows = keyed(dims.dim_leagues(catalogue, df), "League_id")
    assert set(rows) == {"10", "900"}
    assert rows["10"] == {
        "League_id": "10", "league_name": "Liga", "geo_aggreg": "National", "league_naipe": "Women", "country_id": "AA",
    }
    assert rows["900"]["geo_aggreg"] == "International"


def test_dim_logos_and_teams(spark):
    teams = table(
        spark,
        "teams",
        [
            {"team_id": "1", "team_name": "Aland Women", "team_logo": "t/1"},
            {"team_id": "2", "team_name": "Club", "team_logo": "t/2"},
            {"team_id": "3", "team_name": "Nowhere", "team_logo": "t/3"},
        ],
    )
    where = countries(spark, "Aland", "Brasil", "World")
    assert {k: r["logo_final"] for k, r in keyed(dims.dim_logos(teams, where), "Team_id").items()} == {
        "1": "l/Aland", "2": "t/2", "3": "t/3",
    }
    df = matches(
        spark,
        match(1, "1", "2", STRAIGHT, country_code="BR", country_name="Brasil"),
        match(2, "2", "9", STRAIGHT, country_code="World", country_name="World", league_id="900"),
        match(3, "3", "9", STRAIGHT, country_code="World", country_name="World", league_id="900"),
    )
    catalogue = leagues(
        spark, ("10", "Liga Feminina", 2020, "BR", "Brasil"), ("900", "Z Cup", 2020, "World", "World")
    )
    rows = keyed(dims.dim_teams(df, where, catalogue, teams), "Team_id")
    assert set(rows) == {"1", "2"}
    assert rows["1"]["team_type"] == "National Team" and rows["1"]["country_id"] == "AL"
    # The league name goes with the largest code, not with the largest name.
    assert rows["2"]["country_naipe_id"] == "BR_Women" and rows["2"]["team_type"] == "Club"


def test_registry_runs_inputs_first():
    order = run_order()
    assert sorted(order) == sorted(MARTS) and len(order) == 16
    for name in order:
        assert all(order.index(i) < order.index(name) for i in inputs_of(name) if i in MARTS)
    assert run_order(["dim_logos"]) == ["dim_logos"]
    with pytest.raises(KeyError):
        run_order(["dim_nothing"])


def test_display_order(spark):
    df = spark.createDataFrame(
        [("Women", 1.0, 2.0, 1), ("Men", 8.0, None, 1), ("Men", 8.0, 1.0, 1), ("Men", 8.0, 1.0, 3), ("Men", 2.0, 0.5, 1)],
        "league_naipe string, nat_team_strenght double, avg_tight_sets double, qtd_clubs bigint",
    )
    rows = [tuple(r)[1:] for r in in_display_order("fct_aggregation", df).collect()]
    assert rows == [(2.0, 0.5, 1), (8.0, 1.0, 3), (8.0, 1.0, 1), (8.0, None, 1), (1.0, 2.0, 1)]
    assert set(DISPLAY_ORDER) <= set(MARTS)
    assert in_display_order("dim_logos", df) is df


def test_aggregation_defaults_strength_to_eight(spark):
    season = spark.createDataFrame([("10_2020", "10")], "League_season_id string, league_id string")
    league = spark.createDataFrame([("10", "Men", "AL")], "League_id string, league_naipe string, country_id string")
    team = spark.createDataFrame([("A", "AL")], "Team_id string, country_id string")
    national = spark.createDataFrame([("10_2020", 2), ("10_2020", 1)], "league_season_id string, n_tight_sets bigint")
    table_ = spark.createDataFrame(
        [("10_2020", "A"), ("10_2020", "B"), ("x", "C")], "League_season_id string, Team_id string"
    )
    world_ = spark.createDataFrame([], "League_season_id string, Team_id string, strength_level bigint")
    rows = keyed(aggregation.fct_aggregation(league, season, team, national, world_, table_), "country_naipe_id")
    assert rows["AL_Men"] == {
        "country_naipe_id": "AL_Men", "country_id": "AL", "league_naipe": "Men", "nat_team_strenght": 8.0,
        "qtd_national_leagues": 1, "qtd_clubs": 2, "avg_tight_sets": 1.5,
    }
    # Teams of a season that no table knows keep a row of their own.
    assert rows["_"]["qtd_clubs"] == 1 and rows["_"]["avg_tight_sets"] is None
