"""The layout of stored matches: what filters skip, and what a hot country does to it."""

from __future__ import annotations

from dataclasses import replace

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from rallymart.functions import rules
from rallymart.plans import seasonal
from rallymart.sources import tables

SMALL = replace(tables.SILVER_LAYOUT["matches"], row_group_bytes=16 * 1024)


@pytest.fixture(scope="module")
def matches(spark):
    """24,000 matches in 4 seasons and 24 countries, half of them of one, a third of them unfinished."""
    number = F.xxhash64("id") % 1000
    country = F.when(number < 0, "Hotland").otherwise(F.concat(F.lit("Land"), number % 22))
    country = F.when(number % 37 == 5, "World").otherwise(country)
    return spark.range(24_000).select(
        F.col("id").cast("string").alias("match_id"),
        (F.col("id") % 4 + 2020).alias("league_season"),
        F.when(F.col("id") % 3 == 0, "Postponed").otherwise("Finished").alias("description"),
        country.alias("country_name"),
        country.alias("country_code"),
        F.lit("World Championship").alias("league_name"),
        (F.col("id") % 500).cast("string").alias("homeTeam_id"),
        (F.col("id") % 499).cast("string").alias("awayTeam_id"),
    )


def _scanned(df):
    """The rows of a query and how many the scan gave to it, once row groups were skipped."""
    rows = df.collect()
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    return rows, leaf.metrics().apply("numOutputRows").value()


def _row_groups(folder):
    return [
        (pq.ParquetFile(path).metadata.row_group(i), path)
        for path in folder.rglob("*.parquet")
        if path.is_file()
        for i in range(pq.ParquetFile(path).metadata.num_row_groups)
    ]


@pytest.fixture(scope="module")
def stored(spark, matches, tmp_path_factory):
    folder = tmp_path_factory.mktemp("layout")
    assert tables.write_table(matches, str(folder), "matches", layout=SMALL) == 24_000
    return folder, tables.read_table(spark, str(folder), "matches", matches.schema)


@pytest.mark.parametrize(
    ("scope", "part"),
    [
        (f"{rules.is_finished()} AND country_name = 'World'", 0.2),
        (f"{rules.is_finished()} AND country_name = 'World' AND league_season = 2021", 0.05),
        (rules.domestic_scope(), 0.8),
        ("match_id = '12345'", 0.1),
        ("match_id = 'x'", 0.02),
    ],
)
def test_filters_skip_row_groups(matches, stored, scope, part):
    kept, scanned = _scanned(stored[1].filter(scope).select("match_id", "country_name", "league_season"))
    expected = matches.filter(scope).select("match_id", "country_name", "league_season").collect()
    assert sorted(kept) == sorted(expected)
    assert len(kept) <= scanned <= part * 24_000


@pytest.mark.parametrize("name", ["match_id", "homeTeam_id", "awayTeam_id"])
def test_lookups_skip_row_groups(spark, matches, stored, name):
    """An id within the bounds of many row groups that none of them has.

    Columns of few values in a row group have a dictionary, which serves as well as a Bloom filter;
    Parquet writes the filter where there is none.
    """
    def scanned(*without):
        reader = spark.read.schema(matches.schema)
        for kind in without:
            reader = reader.option(f"parquet.filter.{kind}.enabled", "false")
        table = reader.parquet(tables.table_path(str(stored[0]), "matches"))
        return _scanned(table.filter(F.col(name) == "123x").select("match_id"))

    assert scanned("bloom", "dictionary")[1] > 1000
    assert scanned() == ([], 0)


def test_row_groups_hold_few_values(stored):
    groups = _row_groups(stored[0])
    assert len(groups) > 40
    single = 0
    for group, _ in groups:
        columns = {group.column(i).path_in_schema: group.column(i).statistics for i in range(group.num_columns)}
        single += all(columns[n].min == columns[n].max for n in ("description", "country_name"))
    assert single >= len(groups) / 3


def test_a_hot_country_is_split(spark, matches, tmp_path):
    settings = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        tables.write_table(matches.repartition(8), str(tmp_path), "matches", layout=SMALL)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value) if value is not None else spark.conf.unset(name)
    files = {}
    for group, path in _row_groups(tmp_path):
        names = [group.column(i) for i in range(group.num_columns) if group.column(i).path_in_schema == "country_name"]
        if names[0].statistics.min <= "Hotland" <= names[0].statistics.max:
            files.setdefault(path.parent.name, set()).add(path.name)
    assert all(len(found) > 1 for found in files.values()) and len(files) == 4


def test_a_season_written_again_keeps_the_layout(spark, matches, tmp_path):
    root = str(tmp_path)
    seasonal.write_seasons(matches.filter("league_season < 2023"), root, "matches")
    seasonal.write_seasons(matches.filter("league_season = 2023"), root, "matches", [2023])
    stored = tables.read_table(spark, root, "matches", matches.schema)
    assert stored.count() == 24_000
    for group, path in _row_groups(tmp_path):
        columns = {group.column(i).path_in_schema: i for i in range(group.num_columns)}
        assert "league_season" not in columns
        table = pq.ParquetFile(path).read(["description", "country_name", "match_id"]).to_pylist()
        order = [(r["description"], r["country_name"], r["match_id"]) for r in table]
        assert order == sorted(order)
