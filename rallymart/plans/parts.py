"""The aggregation mart from stored parts of each season, which are merged exactly.

Distinct counts do not add up, so a part holds bitmaps: every league and club has a number, kept
in a table and never given twice, and a part has one bit for each that it has seen. Parts are OR-ed
and their bits counted; sums and row counts add up as they are. A load only writes the parts of the
seasons it changes, and no row is expanded for each distinct count.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rallymart.functions import rules
from rallymart.operators.ranking import with_ordinals
from rallymart.plans.aggregation import mean_of
from rallymart.sources.staging import stage
from rallymart.sources.tables import table_path
from rallymart.sources.versions import Files

KEY = ("country_id", "league_naipe")
COUNTED = {"league": "league_id", "club": "club"}

PARTS = (
    "kind string, country_id string, league_naipe string, bucket bigint, bits binary, "
    "part_total bigint, part_rows bigint, season string"
)
NUMBERS = "kind string, id string, number bigint"


def season_of(key: str) -> Column:
    return F.substring_index(key, "_", -1).alias("season")


def _stored(spark: SparkSession, root: str, name: str, schema: str) -> DataFrame:
    """A table, empty as long as nothing has been written."""
    if Files(spark, root).exists(table_path(root, name)):
        return spark.read.schema(schema).parquet(table_path(root, name))
    return spark.createDataFrame([], schema)


def number_ids(spark: SparkSession, root: str, ids: DataFrame) -> DataFrame:
    """kind, id and number of all ids met so far; new ones of `ids` (kind, id) get the next numbers."""
    known = _stored(spark, root, "id_numbers", NUMBERS)
    new = stage(ids.distinct().join(known, ["kind", "id"], "left_anti"), "new-ids")
    given = {r.kind: r.n for r in known.groupBy("kind").agg(F.max("number").alias("n")).collect()}
    for kind in COUNTED:
        # Ids without gaps keep the bitmaps dense.
        placed = with_ordinals(new.filter(F.col("kind") == kind), [F.asc("id")], "number")
        numbered = placed.select("kind", "id", (F.col("number") + given.get(kind, 0)).alias("number"))
        numbered.write.mode("append").parquet(table_path(root, "id_numbers"))
    return _stored(spark, root, "id_numbers", NUMBERS)


def _sums(facts: DataFrame, kind: str, column: str) -> DataFrame:
    return facts.groupBy("season", *KEY).agg(
        F.lit(kind).alias("kind"),
        F.expr(f"sum({column}) AS part_total"),
        F.expr(f"count({column}) AS part_rows"),
    )


def season_parts(
    spark: SparkSession, root: str, marts: Mapping[str, DataFrame], seasons: Column | None = None
) -> DataFrame:
    """Parts of the seasons that meet the condition on `season`, all if none is given.

    `marts` are the dimensions and facts that the aggregation reads, by name.
    """
    wanted = F.lit(True) if seasons is None else seasons
    leagues = marts["dim_leagues"].selectExpr(
        "League_id AS league_id", "league_naipe", "country_id"
    )
    # Left: a season without a known league keeps its rows, without country and category.
    known = marts["dim_season"].selectExpr("League_season_id AS season_key", "league_id").join(leagues, "league_id", "left")

    def of_seasons(name: str, key: str, *columns: str) -> DataFrame:
        facts = marts[name].select(F.col(key).alias("season_key"), season_of(key), *columns)
        return facts.filter(wanted).join(known, "season_key", "left")

    clubs = of_seasons("fct_national_standings", "League_season_id", F.col("Team_id").alias("club"))
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(c).alias("id")) for k, c in COUNTED.items()]))
    # Once per season and key: clubs are few next to the facts.
    seen = stage(clubs.select("season", *KEY, each.alias("seen")).select("season", *KEY, "seen.*").distinct(), "seen-ids")
    numbers = number_ids(spark, root, seen.filter("id IS NOT NULL").select("kind", "id"))
    bits = (
        seen.join(numbers, ["kind", "id"], "left")
        .groupBy("season", *KEY, "kind", F.expr("bitmap_bucket_number(coalesce(number, 1)) AS bucket"))
        .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(number)) AS bits"))
    )
    teams = marts["dim_teams"].selectExpr("Team_id", "country_id AS team_country")
    strength = (
        of_seasons("fct_intern_standings", "League_season_id", "Team_id", "strength_level")
        .drop("country_id")
        .join(teams, "Team_id", "left")
        .withColumnRenamed("team_country", "country_id")
    )
    tight = of_seasons("fct_national_matches", "league_season_id", "n_tight_sets")
    parts = bits.unionByName(_sums(strength, "strength", "strength_level"), allowMissingColumns=True).unionByName(
        _sums(tight, "tight", "n_tight_sets"), allowMissingColumns=True
    )
    return parts.selectExpr(*[c.split(" ")[0] for c in PARTS.split(", ")])


def refresh_parts(
    spark: SparkSession, root: str, marts: Mapping[str, DataFrame], seasons: Column | None = None
) -> None:
    """Write the parts of these seasons anew; those of other seasons stay as they are."""
    parts = season_parts(spark, root, marts, seasons)
    writer = parts.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("season").parquet(table_path(root, "aggregation_parts"))


def merged_parts(spark: SparkSession, root: str) -> DataFrame:
    """The rows of `fct_aggregation` from the stored parts."""
    parts = _stored(spark, root, "aggregation_parts", PARTS)
    merged = parts.groupBy(*KEY, "kind", "bucket").agg(
        F.expr("bitmap_count(bitmap_or_agg(bits)) AS seen"),
        F.expr("sum(part_total) AS part_total"),
        F.expr("sum(part_rows) AS part_rows"),
    )

    # What has no country or category meets nothing of the other facts.
    met = " AND ".join(f"{k} IS NOT NULL" for k in KEY)
    return (
        merged.groupBy(*KEY)
        .agg(
            F.expr("count_if(kind = 'club') AS club_rows"),
            F.expr(f"{mean_of('strength')} AS strength"),
            F.expr("sum(seen) FILTER (WHERE kind = 'league') AS qtd_national_leagues"),
            F.expr("sum(seen) FILTER (WHERE kind = 'club') AS qtd_clubs"),
            F.expr(f"{mean_of('tight')} AS tight"),
        )
        .filter("club_rows > 0")
        .selectExpr(
            f"{rules.key_of('country_id', 'league_naipe')} AS country_naipe_id",
            "country_id",
            "league_naipe",
            f"coalesce(if({met}, strength, NULL), 8D) AS nat_team_strenght",
            "qtd_national_leagues",
            "qtd_clubs",
            f"if({met}, tight, NULL) AS avg_tight_sets",
        )
    )
