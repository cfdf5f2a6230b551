"""Golden values of the domain rules."""

from __future__ import annotations

import pytest

from fixtures import FIVE, STRAIGHT, match, matches
from rallymart.functions import rules
from rallymart.operators.sides import melt_sides, team_id, with_gaps

FOUR = ["25-20", "20-25", "25-20", "25-20"]


def flip(sets):
    return ["-".join(reversed(text.split("-"))) for text in sets]


def values(spark, expression, texts):
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    return [r[0] for r in df.selectExpr(expression).collect()]


def per_match(spark, expression, *rows):
    df = with_gaps(matches(spark, *rows)).selectExpr("match_id", f"{expression} AS v")
    return [r.v for r in df.orderBy("match_id").collect()]


def test_points_of_both_sides(spark):
    rows = [
        match(1, "h", "a", STRAIGHT),
        match(2, "h", "a", FOUR),
        match(3, "h", "a", FIVE),
        match(4, "h", "a", flip(FIVE)),
        match(5, "h", "a", flip(FOUR)),
        match(6, "h", "a", [], current_home_team_score=0, current_away_team_score=0),
        match(7, "h", "a", [], current_home_team_score=None, current_away_team_score=None),
    ]
    assert per_match(spark, rules.match_points("home"), *rows) == [3, 3, 2, 1, 0, 0, 0]
    assert per_match(spark, rules.match_points("away"), *rows) == [0, 0, 1, 2, 3, 0, 0]


def test_points_of_a_decided_match_add_up_to_three(spark):
    rows = [match(i, "h", "a", s) for i, s in enumerate([STRAIGHT, FOUR, FIVE, flip(FIVE)])]
    both = f"{rules.match_points('home')} + {rules.match_points('away')}"
    assert per_match(spark, both, *rows) == [3, 3, 3, 3]


def test_tight_sets(spark):
    row = match(1, "h", "a", ["25-23", "22-25", "25-21", "24-26"])
    assert per_match(spark, rules.tight_sets(), row) == [3]
    assert per_match(spark, rules.tight_sets_won("home"), row) == [1]
    assert per_match(spark, rules.tight_sets_won("away"), row) == [2]


def test_winner_is_away_on_tie_or_missing_score(spark):
    rows = [
        match(1, "h", "a", STRAIGHT),
        match(2, "h", "a", [], current_home_team_score=0, current_away_team_score=0),
        match(3, "h", "a", [], current_home_team_score=None),
    ]
    assert per_match(spark, rules.winner_id(), *rows) == ["h", "a", "a"]
    assert per_match(spark, rules.result_letter("away"), *rows) == ["L", "L", "L"]


def test_sets_won_and_played(spark):
    row = match(1, "h", "a", FIVE)
    assert per_match(spark, rules.sets_won("home"), row) == [3]
    assert per_match(spark, rules.sets_lost("home"), row) == [2]
    assert per_match(spark, rules.sets_played(), row) == [5]
    half = match(1, "h", "a", ["25-20"], second_set_home_team_score=7)
    assert per_match(spark, rules.sets_played(), half) == [2]
    assert per_match(spark, rules.sets_won("home"), half) == [1]


WEEKS = ["Semi-finals", "Final", "3rd place", "Quarter-finals", "7", None, "Quarter", "FINAL 1"]


def test_phases_ignore_case(spark):
    F, P = "Finals", "Preliminary"
    assert values(spark, rules.phase_of("x"), WEEKS) == [F, F, F, F, P, P, P, F]
    broad = rules.holds(rules.in_broad_finals("x"))
    assert values(spark, broad, WEEKS) == [True, True, True, True, False, False, True, True]
    final = rules.flag(rules.is_real_final("x"))
    assert values(spark, final, WEEKS) == [0, 1, 0, 0, 0, 0, 0, 1]


def test_categories(spark):
    names = ["Liga Femenina", "Serie A women", "Liga", "X Female", "Y FEMININA", None]
    W, M = "Women", "Men"
    assert values(spark, rules.naipe_of("x"), names) == [W, W, M, W, W, M]
    assert values(spark, rules.narrow_naipe_of("x"), names) == [M, W, M, M, M, M]


def test_name_cleaning_keeps_case_and_plain_substrings(spark):
    assert values(spark, rules.without_women("x"), ["Brazil Women", "women Cup", " A "]) == [
        "Brazil",
        "women Cup",
        "A",
    ]
    assert values(spark, rules.without_category("x"), ["Yemen", "Women Men A", "Menorca"]) == [
        "Yemen",
        "A",
        "orca",
    ]


def test_key_of_takes_missing_parts_as_empty(spark):
    df = spark.createDataFrame([(None, 2020), ("7", None)], "a string, b bigint")
    assert [r[0] for r in df.selectExpr(rules.key_of("a", "b")).collect()] == ["_2020", "7_"]


@pytest.mark.parametrize(
    "scope, expected",
    [
        (rules.world_leagues_scope(), {"w", "flag"}),
        (rules.world_scope(), {"w"}),
        (rules.domestic_scope(), {"n", "flag", "named"}),
        (rules.country_scope(), {"n", "flag", "coded"}),
    ],
)
def test_scopes(spark, scope, expected):
    world = {"league_name": "Nations League Women", "country_code": "World", "country_name": "World"}
    df = matches(
        spark,
        match("n", "h", "a", STRAIGHT),
        match("w", "h", "a", STRAIGHT, **world),
        match("flag", "h", "a", STRAIGHT, league_name="Olympic Games"),
        match("open", "h", "a", STRAIGHT, description="Not started", **world),
        match("europe", "h", "a", STRAIGHT, country_code="Europe", country_name="Europe"),
        match("named", "h", "a", STRAIGHT, country_name="World"),
        match("coded", "h", "a", STRAIGHT, country_code="World"),
        match("none", "h", "a", STRAIGHT, country_name=None),
    )
    assert {r.match_id for r in df.filter(scope).collect()} == expected


def test_melting_gives_two_rows_per_match(spark):
    df = matches(spark, match(1, "h", "a", FIVE), match(2, "a", "h", STRAIGHT))
    sides = melt_sides(
        with_gaps(df),
        {"match_id": "match_id"},
        {"team": team_id, "won": rules.sets_won, "lost": rules.sets_lost},
    )
    assert sorted(map(tuple, sides.collect())) == [
        ("1", "a", 2, 3),
        ("1", "h", 3, 2),
        ("2", "a", 3, 0),
        ("2", "h", 0, 3),
    ]


def test_ratio_is_null_without_losses(spark):
    df = spark.createDataFrame([(9, 0), (9, 6)], "w bigint, l bigint")
    assert [r[0] for r in df.selectExpr(rules.ratio("w", "l")).collect()] == [None, 1.5]
