"""SQL expressions for the domain rules shared by the marts.

Every rule is the text of a Spark SQL expression, for `selectExpr`, `filter` and `F.expr`. The
text is parsed once by Spark, folds into whatever scan or aggregate uses it and stays inside
whole-stage codegen.
"""

from __future__ import annotations

# Names and words the source data uses.
SETS = ("firstSet", "second_set", "third_set", "fourth_set", "fifth_set")
CONTINENTS = ("Europe", "South America", "North America", "Africa", "Oceania")
NOT_COUNTRIES = ("World", *CONTINENTS)
WORLD_LEAGUES = ("Nations League", "World Championship", "Olympic Games")
WOMEN_WORDS = ("Women", "Femenina", "Female", "Feminina")
FINISHED = "Finished"
TIGHT_MARGIN = 3
STRENGTH_NAMES = {
    1: "gold",
    2: "silver",
    3: "bronze",
    4: "4th_place",
    5: "quarter_finalist",
    6: "preliminary_top",
    7: "preliminary_bottom",
    8: "not_present",
}

HOME, AWAY = "home", "away"
SIDES = (HOME, AWAY)


def rival(side: str) -> str:
    return AWAY if side == HOME else HOME


def named(columns: dict[str, str]) -> list[str]:
    return [f"{text} AS {name}" for name, text in columns.items()]


def _words(words: tuple[str, ...]) -> str:
    return ", ".join(f"'{word}'" for word in words)


def flag(condition: str) -> str:
    """1 where the condition holds, 0 where it is false or unknown."""
    return f"if({condition}, 1L, 0L)"


def holds(condition: str) -> str:
    """The condition as a boolean that is never NULL."""
    return f"coalesce({condition}, false)"


def key_of(*parts: str) -> str:
    """Surrogate key `a_b`; a missing part counts as the empty string."""
    texts = [f"coalesce(CAST({part} AS STRING), '')" for part in parts]
    return "concat(" + ", '_', ".join(texts) + ")"


def season_text(season: str = "league_season") -> str:
    return f"trim(CAST({season} AS STRING))"


def season_key() -> str:
    return key_of("league_id", season_text())


def minute_text(time: str) -> str:
    """`yyyy-MM-dd HH:mm`, as the clock on the wall showed it."""
    return f"substring(CAST({time} AS STRING), 1, 16)"


def mentions(text: str, *words: str) -> str:
    """Case-blind "contains any of" test."""
    return "(" + " OR ".join(f"{text} ILIKE '%{word}%'" for word in words) + ")"


def without_women(name: str) -> str:
    return f"trim(replace({name}, 'Women', ''))"


def without_category(name: str) -> str:
    return f"trim(replace(replace({name}, 'Women', ''), 'Men', ''))"


def naipe_of(name: str, words: tuple[str, ...] = WOMEN_WORDS) -> str:
    """Sex category read off a league or team name."""
    return f"if({mentions(name, *words)}, 'Women', 'Men')"


def narrow_naipe_of(name: str) -> str:
    """The two-way variant that knows the English word only."""
    return naipe_of(name, WOMEN_WORDS[:1])


# --- scopes -----------------------------------------------------------------------------


def is_finished() -> str:
    return f"description = '{FINISHED}'"


def in_world_leagues(name: str) -> str:
    return f"{without_women(name)} IN ({_words(WORLD_LEAGUES)})"


def real_country(name: str) -> str:
    return f"{name} NOT IN ({_words(NOT_COUNTRIES)})"


def world_leagues_scope() -> str:
    """Finished matches of the three world competitions."""
    return f"{is_finished()} AND {in_world_leagues('league_name')}"


def world_scope() -> str:
    """The same, played under the World flag."""
    return f"{world_leagues_scope()} AND country_name = 'World'"


def domestic_scope() -> str:
    """Finished matches outside the continents whose country code is not World."""
    return (
        f"{is_finished()} AND country_name NOT IN ({_words(CONTINENTS)}) "
        "AND country_code <> 'World'"
    )


def country_scope() -> str:
    """Finished matches in real countries."""
    return f"{is_finished()} AND {real_country('country_name')}"


# --- phases -----------------------------------------------------------------------------


def phase_of(week: str) -> str:
    """`Finals` for finals of any kind and third-place matches.

    The test ignores case, so semi-finals and quarter-finals are inside too.
    """
    return f"if({mentions(week, 'Final', '3rd place')}, 'Finals', 'Preliminary')"


def in_broad_finals(week: str) -> str:
    return mentions(week, "Final", "3rd place", "Quarter", "Semi")


def is_real_final(week: str) -> str:
    return f"({mentions(week, 'Final')} AND NOT {mentions(week, 'Semi', 'Quarter')})"


# --- scores -----------------------------------------------------------------------------
# The set rules read `gap_1` to `gap_5`, home minus away points, see sides.with_gaps.

GAPS = tuple(f"gap_{number}" for number in range(1, len(SETS) + 1))


def current_score(side: str) -> str:
    return f"current_{side}_team_score"


def set_score(name: str, side: str) -> str:
    return f"{name}_{side}_team_score"


def won_match(side: str) -> str:
    return f"{current_score(side)} > {current_score(rival(side))}"


def lost_match(side: str) -> str:
    return f"{current_score(side)} < {current_score(rival(side))}"


def result_letter(side: str) -> str:
    """`W` only for a strict win: a tie or a missing score is `L` for both sides."""
    return f"if({won_match(side)}, 'W', 'L')"


def winner_id() -> str:
    """The home team on a strict home win, the away team in every other case."""
    return f"if({won_match(HOME)}, homeTeam_id, awayTeam_id)"


def took_set(gap: str, side: str) -> str:
    return f"{gap} > 0" if side == HOME else f"{gap} < 0"


def sets_won(side: str) -> str:
    return "(" + " + ".join(flag(took_set(gap, side)) for gap in GAPS) + ")"


def sets_lost(side: str) -> str:
    return sets_won(rival(side))


def sets_played() -> str:
    return "(" + " + ".join(flag(f"{set_score(name, HOME)} IS NOT NULL") for name in SETS) + ")"


def tight_sets() -> str:
    tests = [f"{gap} BETWEEN -{TIGHT_MARGIN} AND {TIGHT_MARGIN}" for gap in GAPS]
    return "(" + " + ".join(flag(test) for test in tests) + ")"


def tight_sets_won(side: str) -> str:
    low, high = (1, TIGHT_MARGIN) if side == HOME else (-TIGHT_MARGIN, -1)
    return "(" + " + ".join(flag(f"{gap} BETWEEN {low} AND {high}") for gap in GAPS) + ")"


def match_points(side: str) -> str:
    """3 for a win in fewer than five sets, 2 for one in five, 1 for a loss in five, else 0."""
    five = f"{set_score(SETS[-1], HOME)} IS NOT NULL"
    return (
        f"CASE WHEN {won_match(side)} THEN if({five}, 2L, 3L) "
        f"WHEN {lost_match(side)} AND {five} THEN 1L ELSE 0L END"
    )


def ratio(won: str, lost: str) -> str:
    """Double-precision quotient, NULL when nothing was lost."""
    return f"CAST({won} AS DOUBLE) / nullif(CAST({lost} AS DOUBLE), 0D)"


def strength_name(level: str, names: dict[int, str] = STRENGTH_NAMES) -> str:
    cases = " ".join(f"WHEN {number} THEN '{name}'" for number, name in names.items())
    return f"CASE {level} {cases} END"
