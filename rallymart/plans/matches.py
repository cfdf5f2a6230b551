"""Match facts: one row per match, and one row per match and side."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rallymart.functions import rules
from rallymart.operators.ranking import HotGroups, by_group_size, hot_groups, hot_limit, row_numbers, spread
from rallymart.operators.sides import (
    StoredSides,
    has_few_sides,
    melt_sides,
    side_name,
    team_id,
    with_gaps,
)

COUNTRY = ("country_name", "country_code")


def _match_facts(matches: DataFrame, scope: str, country: tuple[str, ...] = ()) -> DataFrame:
    return with_gaps(matches.filter(scope)).selectExpr(
        "match_id AS Match_id",
        f"{rules.season_key()} AS league_season_id",
        "match_week",
        *country,
        f"{rules.minute_text('match_date')} AS match_date",
        "homeTeam_id",
        "awayTeam_id",
        f"{rules.winner_id()} AS match_winner",
        "description AS match_status",
        *[rules.current_score(side) for side in rules.SIDES],
        *[rules.set_score(name, side) for name in rules.SETS for side in rules.SIDES],
        f"{rules.sets_played()} AS total_sets",
        f"{rules.tight_sets()} AS n_tight_sets",
    )


def fct_intern_matches(matches: DataFrame) -> DataFrame:
    return _match_facts(matches, rules.world_leagues_scope())


def fct_national_matches(matches: DataFrame) -> DataFrame:
    return _match_facts(matches, rules.domestic_scope(), COUNTRY)


# Names of the per-side set scores, in the order of rules.SETS.
SIDE_SET_SCORES = ("first", "second", "third", "fourth", "fifth")


def recency_order() -> list:
    """Newest match first, then match id; the side settles a team meeting itself."""
    return [F.desc("match_date"), F.asc("match_id"), F.asc("team_side")]


def hot_teams(matches: DataFrame, scope: str = "true") -> HotGroups | None:
    """The teams whose sides in scope outgrow a task; at most the team ids are read."""
    if has_few_sides(matches, hot_limit(matches.sparkSession)):
        return None
    return hot_groups(melt_sides(matches.filter(scope), {}, {"team_id": team_id}), ["team_id"])


def numbered_sides(
    sides: DataFrame, numbers: dict[str, list[str]], hot: HotGroups | None, most: int = 0
) -> DataFrame:
    """Recency orders of the sides of each team, and within what else `numbers` names.

    `most` is what the sides are at most; with it they lie in enough partitions for the sorts.
    """
    def work(rows: DataFrame, blocks: int) -> DataFrame:
        if not blocks:
            rows = spread(rows, ["team_id"], most)
        return row_numbers(rows, recency_order(), numbers, ["team_id"], blocks)

    return by_group_size(sides, ["team_id"], hot, work)


def team_seasons(matches: DataFrame, scope: str) -> DataFrame:
    """Team and league-season of every side in scope, repeats included."""
    return melt_sides(
        matches.filter(scope), {"league_season_id": rules.season_key()}, {"team_id": team_id}
    )


def _side_facts(
    matches: DataFrame | StoredSides, scope: str, tight_name: str, country: tuple[str, ...] = ()
) -> DataFrame:
    set_scores = {
        f"{short}_set_score": (lambda side, name=name: rules.set_score(name, side))
        for short, name in zip(SIDE_SET_SCORES, rules.SETS)
    }
    keep = {
        "match_id": "match_id",
        "league_id": "league_id",
        "league_season": "league_season",
        "match_week": "match_week",
        **{name: name for name in country},
        "champ_phase": rules.phase_of("match_week"),
        "match_date": rules.minute_text("match_date"),
        "match_status": "description",
    }
    per_side = {
        "team_id": team_id,
        "team_side": side_name,
        "current_score": rules.current_score,
        **set_scores,
        "team_result": rules.result_letter,
        "sets_won": rules.sets_won,
        "sets_lost": rules.sets_lost,
        tight_name: rules.tight_sets_won,
    }
    season = ["team_id", "league_id", "league_season"]
    numbers = {
        "match_order_general": ["team_id"],
        "match_order_champ": season,
        "order_in_phase": [*season, "champ_phase"],
    }
    if isinstance(matches, StoredSides):
        parts = [
            row_numbers(
                melt_sides(with_gaps(part), keep, per_side), recency_order(), numbers, ["team_id"], blocks
            )
            for part, blocks in matches.filter(scope).parts()
        ]
        ranked = reduce(DataFrame.unionByName, parts)
    else:
        sides = melt_sides(with_gaps(matches.filter(scope)), keep, per_side)
        ranked = numbered_sides(sides, numbers, hot_teams(matches, scope), 2 * matches.count())
    return ranked.selectExpr(
        "team_id AS Team_id",
        f"{rules.key_of('league_id', 'league_season')} AS league_season_id",
        *country,
        "match_id",
        "team_side",
        "match_week",
        "champ_phase",
        "match_date",
        "current_score",
        *set_scores,
        "match_status",
        "team_result",
        "match_order_general",
        "match_order_champ",
        "if(champ_phase = 'Finals', order_in_phase, NULL) AS match_order_finals",
        "sets_won",
        "sets_lost",
        tight_name,
    )


def fct_intern_matches_melted_by_team(matches: DataFrame | StoredSides) -> DataFrame:
    return _side_facts(matches, rules.world_scope(), "n_tight_sets")


def fct_national_matches_melted_by_team(matches: DataFrame | StoredSides) -> DataFrame:
    return _side_facts(matches, rules.domestic_scope(), "n_tight_sets_won", COUNTRY)
