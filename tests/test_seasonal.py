"""Marts kept by season equal a full rebuild, and only read and write the seasons that change."""

from __future__ import annotations

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from rallymart.plans import seasonal
from rallymart.plans.registry import build
from rallymart.sources import derived, tables

SF_DIR = "/root/testdata/sf0.001"


def rows(df):
    return sorted(str(r) for r in df.select(*sorted(df.columns)).collect())


@pytest.fixture
def views(spark):
    return derived.stored_views(spark, SF_DIR)


def changes(matches, seasons):
    """Two matches get a result, one moves to another season, and one season loses its matches."""
    first, second, third = seasons[-1], seasons[-2], seasons[0]
    ids = [r[0] for r in matches.filter(F.col("league_season") == first).orderBy("match_id").limit(3).collect()]
    moved = F.when(F.col("match_id") == ids[2], F.lit(second)).otherwise(F.col("league_season"))
    state = F.when(F.col("match_id").isin(ids[:2]), "Finished").otherwise(
        F.when(F.col("league_season") == third, "Cancelled").otherwise(F.col("description"))
    )
    after = matches.withColumn("description", state).withColumn("league_season", moved)
    touched = F.col("match_id").isin(ids) | (F.col("league_season") == third)
    return after, after.filter(touched), {first, second, third}


def test_refreshed_marts_equal_a_rebuild(spark, views, tmp_path):
    matches, root = views["matches"], str(tmp_path)
    seasons = sorted(r[0] for r in matches.select("league_season").distinct().collect())

    def stored():
        return {**views, "matches": tables.read_table(spark, root, "matches", matches.schema)}

    seasonal.write_seasons(matches, root, "matches")
    seasonal.refresh_marts(spark, stored(), root)
    names = list(seasonal.SEASONAL)
    written = {p: p.stat().st_mtime_ns for n in names for p in (tmp_path / f"{n}.parquet").glob("*/*.parquet")}
    after, load, expected = changes(matches, seasons)
    changed = seasonal.changed_seasons(stored()["matches"], load)
    assert set(changed) == expected
    seasonal.write_seasons(after.filter(F.col("league_season").isin(changed)), root, "matches", changed)
    seasonal.refresh_marts(spark, stored(), root, changed)
    for name in names:
        whole = build(spark, name, {**views, "matches": after})
        assert rows(seasonal.stored_mart(spark, root, name)) == rows(whole)
        here = tmp_path / f"{name}.parquet"
        # The season without finished matches is gone, the others are as they were.
        assert not (here / f"season={seasons[0]}").exists()
        for path, time in written.items():
            if here in path.parents and int(path.parent.name.split("=")[1]) not in changed:
                assert path.exists() and path.stat().st_mtime_ns == time
    seasonal.refresh_marts(spark, stored(), root, [])


def test_only_changed_seasons_are_read(spark, views, tmp_path):
    seasonal.write_seasons(views["matches"], str(tmp_path), "matches")
    stored = tables.read_table(spark, str(tmp_path), "matches", views["matches"].schema)
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        part = stored.filter(F.col("league_season").isin([2001]))
        build(spark, "fct_national_matches", {"matches": part}).explain("formatted")
    assert re.search(r"PartitionFilters: \[.*league_season#\d+L? = 2001", text.getvalue())
