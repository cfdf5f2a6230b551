"""One row per match and side, from one read of the matches."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame

from rallymart.functions.rules import AWAY, GAPS, HOME, SETS, SIDES, named, set_score

SideColumns = dict[str, Callable[[str], str]]

TEAM, SIDE = "team_id", "team_side"


@dataclass(frozen=True)
class StoredSides:
    """Matches stored as two rows each, one for either side, with all columns of the match.

    All rows of a team lie in one part: `ordinary` is bucketed by team, so that work on single teams
    needs no exchange; `hot` holds the teams that would outgrow a task, in no order, if there are any.
    """

    ordinary: DataFrame
    hot: DataFrame | None
    rows: int
    blocks: int

    @property
    def sparkSession(self):  # noqa: N802, as a DataFrame has it
        return self.ordinary.sparkSession

    def filter(self, condition: str) -> StoredSides:
        hot = None if self.hot is None else self.hot.filter(condition)
        return replace(self, ordinary=self.ordinary.filter(condition), hot=hot)

    def parts(self) -> list[tuple[DataFrame, int]]:
        """Each part with the blocks its teams are numbered in, 0 where a team fits a task."""
        hot = [] if self.hot is None else [(self.hot, self.blocks)]
        return [(self.ordinary, 0), *hot]

    def matches(self) -> DataFrame:
        """One row per match again: the home sides."""
        homes = [part.filter(f"{SIDE} = '{HOME}'").drop(TEAM, SIDE) for part, _ in self.parts()]
        return reduce(DataFrame.unionByName, homes)


def of_teams(source: DataFrame | StoredSides, work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """`work` on matches, or on each part of stored sides; it must treat every team by itself."""
    if isinstance(source, StoredSides):
        return reduce(DataFrame.unionByName, [work(part) for part, _ in source.parts()])
    return work(source)


def team_id(side: str) -> str:
    return f"{side}Team_id"


def team_name(side: str) -> str:
    return f"{side}Team_name"


def side_name(side: str) -> str:
    return f"'{side}'"


def with_gaps(matches: DataFrame) -> DataFrame:
    """Add home minus away points of each set, NULL where the set was not played.

    All set rules read these five numbers, which keeps the generated code of a mart small.
    """
    gaps = {gap: f"{set_score(s, HOME)} - {set_score(s, AWAY)}" for gap, s in zip(GAPS, SETS)}
    return matches.selectExpr("*", *named(gaps))


def melt_sides(matches: DataFrame, keep: dict[str, str], per_side: SideColumns) -> DataFrame:
    """Turn each match into a home row and an away row.

    `keep` is repeated on both rows; `per_side` maps a column name to a function of the side.
    Both give SQL expressions. Only what is named here is computed and carried. Rows of
    `StoredSides` are sides already, and each gets the value of its own.
    """
    if SIDE in matches.columns:
        own = {
            name: name if name == TEAM else f"if({SIDE} = '{HOME}', {build(HOME)}, {build(AWAY)})"
            for name, build in per_side.items()
        }
        return matches.selectExpr(*named(keep | own))
    rows = []
    for side in SIDES:
        fields = ", ".join(f"'{name}', {build(side)}" for name, build in per_side.items())
        rows.append(f"named_struct({fields})")
    return matches.selectExpr(*named(keep), f"inline(array({', '.join(rows)}))")


def has_few_sides(matches: DataFrame | StoredSides, limit: int) -> bool:
    """Whether all sides of the matches together stay within the limit.

    Over a stored table the count comes from the file footers and reads no column.
    """
    if isinstance(matches, StoredSides):
        return matches.rows <= limit
    return 2 * matches.count() <= limit
