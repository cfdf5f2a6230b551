"""Single rules and operators as whole-table queries, so each can be compared by itself.

Every function takes the silver views as a dict and returns one row per match, side, team or
league-season of the full tables.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rallymart.functions import rules
from rallymart.operators import ingest, reshape
from rallymart.operators.sides import melt_sides, side_name, team_id, team_name, with_gaps
from rallymart.plans import dims, layers, parts, registry, seasonal, side_table, standings
from rallymart.sources import landing, tables
from rallymart.sources.staging import staging_path
from rallymart.plans.matches import hot_teams, numbered_sides, team_seasons

Views = dict[str, DataFrame]


# --- rules ------------------------------------------------------------------------------


def rule_points(views: Views) -> DataFrame:
    per_side = {"team_side": side_name, "match_points": rules.match_points}
    return melt_sides(views["matches"], {"match_id": "match_id"}, per_side)


def rule_set_flags(views: Views) -> DataFrame:
    flags = {
        f"{side}_set_{i}": rules.flag(rules.took_set(gap, side))
        for i, gap in enumerate(rules.GAPS, start=1)
        for side in rules.SIDES
    }
    counts = {f"{side}_sets": rules.sets_won(side) for side in rules.SIDES}
    return with_gaps(views["matches"]).selectExpr("match_id", *rules.named(flags | counts))


def rule_tight_sets(views: Views) -> DataFrame:
    counts = {f"{side}_tight_sets": rules.tight_sets_won(side) for side in rules.SIDES}
    return with_gaps(views["matches"]).selectExpr(
        "match_id", f"{rules.tight_sets()} AS n_tight_sets", *rules.named(counts)
    )


def rule_winner(views: Views) -> DataFrame:
    return views["matches"].selectExpr("match_id", f"{rules.winner_id()} AS match_winner")


def rule_total_sets(views: Views) -> DataFrame:
    return views["matches"].selectExpr("match_id", f"{rules.sets_played()} AS total_sets")


def rule_phase(views: Views) -> DataFrame:
    return views["matches"].selectExpr(
        "match_id",
        f"{rules.phase_of('match_week')} AS phase",
        f"if({rules.in_broad_finals('match_week')}, 'Finals', 'Preliminary') AS broad_phase",
        f"{rules.flag(rules.is_real_final('match_week'))} AS real_final",
    )


def rule_category(views: Views) -> DataFrame:
    return views["matches"].selectExpr(
        "match_id",
        f"{rules.naipe_of('league_name')} AS naipe",
        f"{rules.narrow_naipe_of('league_name')} AS narrow_naipe",
        f"{rules.without_women('league_name')} AS plain_name",
    )


def rule_strength(views: Views) -> DataFrame:
    return standings.ranked_world(views["matches"]).selectExpr(
        standings.SEASON,
        "team_id",
        "prelim_position",
        "strength_level",
        f"{rules.strength_name('strength_level')} AS strength_cluster",
    )


def rule_series_rank(views: Views) -> DataFrame:
    return standings.ranked_domestic(views["matches"]).selectExpr(
        standings.SEASON,
        "team_id",
        "if(in_final, final_place, NULL) AS final_pos",
        "if(in_bronze, bronze_place, NULL) AS bronze_pos",
        "finalist_bucket",
    )


def rule_eligible(views: Views) -> DataFrame:
    return standings.eligible_teams(views["matches"], views["countries"])


def rule_single_match_seasons(views: Views) -> DataFrame:
    return (
        views["matches"]
        .filter(rules.country_scope())
        .groupBy(F.expr(f"{rules.season_key()} AS league_season_id"))
        .agg(F.count(F.lit(1)).alias("n_matches"))
        .filter("n_matches = 1")
    )


def scope_world(views: Views) -> DataFrame:
    return views["matches"].filter(rules.world_scope()).select("match_id", "league_name")


def scope_national_a(views: Views) -> DataFrame:
    return views["matches"].filter(rules.domestic_scope()).select("match_id", "country_code")


def scope_national_b(views: Views) -> DataFrame:
    return views["matches"].filter(rules.country_scope()).select("match_id", "country_name")


def scope_national_c(views: Views) -> DataFrame:
    """Finished matches with the number of domestic catalogue rows of their league."""
    repeats = (
        views["leagues"]
        .filter(rules.real_country("country_name"))
        .groupBy("league_id")
        .agg(F.count(F.lit(1)).alias("catalogue_rows"))
    )
    finished = views["matches"].filter(rules.is_finished()).select("match_id", "league_id")
    return finished.join(repeats, "league_id")


# --- operators --------------------------------------------------------------------------


def const_rows(views: Views) -> DataFrame:
    """The constant category table beside the number of teams of each category."""
    teams = dims.dim_teams(
        views["matches"], views["countries"], views["leagues"], views["teams"]
    )
    counts = teams.groupBy("team_naipe").agg(F.count(F.lit(1)).alias("n_teams"))
    return (
        dims.dim_naipe(teams.sparkSession)
        .join(counts, "team_naipe", "left")
        .selectExpr("naipe_id", "team_naipe", "coalesce(n_teams, 0L) AS n_teams")
    )


def join_grid(views: Views) -> DataFrame:
    return standings.expected_entries(
        standings.eligible_teams(views["matches"], views["countries"]),
        standings.editions(views["matches"]),
    )


def join_anti(views: Views) -> DataFrame:
    single = rule_single_match_seasons(views).select("league_season_id")
    return (
        views["matches"]
        .filter(rules.country_scope())
        .selectExpr("match_id", f"{rules.season_key()} AS league_season_id")
        .join(single, "league_season_id", "left_anti")
    )


def join_two_keys(views: Views) -> DataFrame:
    """Matches with the name their league has in the catalogue of that season."""
    catalogue = views["leagues"].selectExpr(
        "league_id", "league_season", "league_name AS catalogue_name"
    )
    return (
        views["matches"]
        .select("match_id", "league_id", "league_season")
        .join(catalogue, ["league_id", "league_season"])
    )


def join_left_filtered(views: Views) -> DataFrame:
    """Teams with the real country of their name, NULL where there is none."""
    real = (
        views["countries"]
        .filter(rules.real_country("country_name"))
        .selectExpr("country_name AS plain_name", "country_code")
    )
    return (
        views["teams"]
        .selectExpr("team_id", f"{rules.without_women('team_name')} AS plain_name")
        .join(real, "plain_name", "left")
    )


def agg_any_flag(views: Views) -> DataFrame:
    return dims.league_seasons(views["leagues"], views["matches"])


def agg_ratio(views: Views) -> DataFrame:
    sides = melt_sides(
        with_gaps(views["matches"]),
        {"league_season_id": rules.season_key()},
        {"team_id": team_id, "won": rules.sets_won, "lost": rules.sets_lost},
    )
    return sides.groupBy("league_season_id", "team_id").agg(
        F.expr("sum(won) AS sets_won"),
        F.expr("sum(lost) AS sets_lost"),
        F.expr(f"{rules.ratio('sum(won)', 'sum(lost)')} AS set_ratio"),
    )


def agg_max_by(views: Views) -> DataFrame:
    return dims.team_countries(views["matches"], views["countries"], views["leagues"])


def agg_count_distinct(views: Views) -> DataFrame:
    return (
        views["matches"]
        .groupBy("country_code")
        .agg(
            F.countDistinct("league_id").alias("n_leagues"),
            F.countDistinct("homeTeam_id").alias("n_home_teams"),
        )
    )


def win_recency(views: Views) -> DataFrame:
    keep = ("match_id", "league_id", "league_season", "match_date")
    sides = melt_sides(
        views["matches"],
        {name: name for name in keep},
        {"team_id": team_id, "team_side": side_name},
    )
    numbers = {
        "order_general": ["team_id"],
        "order_season": ["team_id", "league_id", "league_season"],
    }
    ranked = numbered_sides(sides, numbers, hot_teams(views["matches"]), 2 * views["matches"].count())
    return ranked.select("team_id", "match_id", "team_side", *numbers)


def win_partition_max(views: Views) -> DataFrame:
    """Each league-season beside the newest of its league; seasons of a league are few."""
    seasons = views["matches"].select("league_id", "league_season").distinct()
    return seasons.selectExpr(
        "*", "max(league_season) OVER (PARTITION BY league_id) AS max_season"
    )


def win_global_max(views: Views) -> DataFrame:
    seasons = views["matches"].select("league_id", "league_season").distinct()
    newest = views["matches"].agg(F.max("league_season")).scalar()
    return seasons.withColumn("global_max_season", newest)


def win_group_count(views: Views) -> DataFrame:
    """Teams of each league-season beside their number."""
    teams = melt_sides(
        views["matches"], {"league_season_id": rules.season_key()}, {"team_id": team_id}
    ).distinct()
    sizes = teams.groupBy("league_season_id").agg(F.count(F.lit(1)).alias("n_teams"))
    return teams.join(sizes, "league_season_id")


def set_union_distinct(views: Views) -> DataFrame:
    """Distinct team and season pairs of two match sets, each of which has some of its own."""
    finals = team_seasons(views["matches"], "match_week = 'Final'")
    return finals.union(team_seasons(views["matches"], rules.domestic_scope())).distinct()


def melt(views: Views) -> DataFrame:
    per_side = {"team_id": team_id, "team_side": side_name, "score": rules.current_score}
    return melt_sides(views["matches"], {"match_id": "match_id"}, per_side)


def key_concat_nulls(views: Views) -> DataFrame:
    return views["matches"].selectExpr(
        "match_id", f"{rules.key_of('match_week', 'league_season')} AS week_key"
    )


# --- ingestion --------------------------------------------------------------------------


def match_documents(views: Views) -> DataFrame:
    """The matches as the nested documents a results feed delivers."""

    def struct(**fields: str) -> str:
        return "named_struct(" + ", ".join(f"'{n}', {text}" for n, text in fields.items()) + ")"

    def score(prefix: str) -> str:
        home, away = (f"{prefix}_{side}_team_score" for side in rules.SIDES)
        return f"if({home} IS NOT NULL, concat_ws(' - ', {home}, {away}), NULL)"

    scores = struct(**{text: score(prefix) for text, prefix in layers.SCORE_COLUMNS.items()})
    teams = {
        f"{side}Team": struct(id=team_id(side), name=team_name(side)) for side in rules.SIDES
    }
    documents = {
        "id": "match_id",
        "date": "replace(CAST(match_date AS STRING), ' ', 'T')",
        "week": "match_week",
        "leagueId": "league_id",
        "season": "league_season",
        "country": struct(code="country_code", name="country_name"),
        "league": struct(id="league_id", name="league_name"),
        **teams,
        "state": struct(description="description", score=scores),
    }
    return views["matches"].selectExpr(*rules.named(documents))


def bronze_flatten(views: Views) -> DataFrame:
    """Flattened documents; dots become underscores so that plain SQL can name the columns."""
    flat = reshape.flatten_structs(match_documents(views))
    return flat.toDF(*[name.replace(".", "_") for name in flat.columns])


def bronze_json_text(views: Views) -> DataFrame:
    """Set scores as a list, written as JSON text."""
    scores = ", ".join(rules.set_score(name, rules.HOME) for name in rules.SETS)
    listed = views["matches"].selectExpr("match_id", f"array({scores}) AS home_sets")
    return reshape.nested_to_text(listed)


def bronze_event_props(events: DataFrame) -> DataFrame:
    """JSON text of the events, parsed and flattened to dotted paths."""
    parsed = events.selectExpr("event_id", "from_json(props, 'k BIGINT') AS props")
    flat = reshape.flatten_structs(parsed)
    return flat.toDF(*[name.replace(".", "_") for name in flat.columns])


def silver_matches(views: Views) -> DataFrame:
    """Documents through bronze and silver: the typed match table comes back."""
    table = layers.silver_matches(layers.to_bronze(match_documents(views)))
    return table.select(*views["matches"].columns)


def silver_split_scores(views: Views) -> DataFrame:
    texts = views["matches"].selectExpr(
        "match_id",
        "concat_ws(' - ', current_home_team_score, current_away_team_score) AS current",
    )
    halves = reshape.split_column(texts, "current", "home_score", "away_score")
    return reshape.cast_by_name(reshape.drop_columns(halves, ("current",)))


def silver_explode_seasons(views: Views) -> DataFrame:
    """Season lists per league as JSON text, and back to one row per season."""
    # A league has few seasons, and the set is built before and after the shuffle.
    seasons = F.expr("collect_set(named_struct('season', league_season)) AS seasons")
    listed = views["leagues"].groupBy("league_id", "league_name").agg(seasons)
    return reshape.explode_json(
        reshape.nested_to_text(listed), "seasons", "array<struct<season bigint>>"
    )


def silver_cast_rules(lineitem: DataFrame) -> DataFrame:
    """Text columns typed by name: numbers, ids, dates, and averages that are dropped."""
    texts = lineitem.selectExpr(
        "l_orderkey AS order_id",
        "CAST(l_linenumber AS STRING) AS line_number",
        "concat(' ', CAST(l_quantity AS STRING)) AS quantity_score",
        "CAST(l_discount AS STRING) AS discount_score",
        "l_returnflag AS flag_score",
        "l_linestatus AS status_type",
        "substring(CAST(l_shipdate AS STRING), 1, 10) AS ship_date",
        "l_linestatus AS bad_date",
        "l_tax AS avg_tax",
        "l_tax AS tax_percent",
    )
    return reshape.cast_by_name(texts)


def upsert_last_wins(views: Views) -> DataFrame:
    """Last match per team, league and season, finished ones landing after the others."""
    documents = views["matches"].select(
        "homeTeam_id", "league_id", "league_season", "match_id", "match_date", "description"
    )
    return ingest.upsert(
        documents.filter(f"NOT {rules.is_finished()}"),
        documents.filter(rules.is_finished()),
        ("homeTeam_id", "league_id", "league_season"),
        ("match_date", "match_id"),
    )


def incremental_pending(views: Views) -> DataFrame:
    """League-seasons without a finished match, and the newest season of each league."""
    return ingest.pending_seasons(
        views["leagues"], views["matches"].filter(rules.is_finished())
    )


def incremental_leagues(views: Views) -> DataFrame:
    """Leagues that have no final among their matches."""
    return ingest.pending_leagues(
        views["leagues"], views["matches"].filter("match_week = 'Final'")
    )


def distinct_ids_two_cols(views: Views) -> DataFrame:
    return ingest.distinct_team_ids(views["matches"], "homeTeam_id", "awayTeam_id")


def first_day_by_league(views: Views) -> DataFrame:
    return ingest.first_day(views["matches"], "match_date", ("league_id",))


def stamp_batch(views: Views) -> DataFrame:
    """Team statistics stamped with the constants of a load."""
    return ingest.stamp(
        views["team_stats"].select("team_id", "league_id", "league_season"),
        source="results",
        batch_no=1,
    )


def latest_match(views: Views) -> DataFrame:
    """First-match lookup: the match whose id belongs to the newest date of all matches."""
    newest = views["matches"].agg(F.expr("max(struct(match_date, match_id)).match_id")).scalar()
    return ingest.first_match(
        views["matches"].select("match_id", "league_id", "league_name"), F.col("match_id") == newest
    )


# --- through files ----------------------------------------------------------------------


def through_files(documents: DataFrame, entity: str) -> DataFrame:
    """Documents landed as JSON, loaded from the folder, flattened, typed, stored and read back."""
    spark = documents.sparkSession
    folder = staging_path(spark, f"through-files-{entity}")
    landing.write_landed(documents, f"{folder}/landed", entity)
    layers.run_bronze(spark, f"{folder}/landed", f"{folder}/bronze")
    layers.run_silver(spark, f"{folder}/bronze", f"{folder}/silver", (entity,))
    return tables.read_table(spark, f"{folder}/silver", entity)


def landed_round_trip(views: Views) -> DataFrame:
    """All matches through every layer up to silver."""
    table = through_files(match_documents(views), "matches")
    return table.withColumn("league_season", F.col("league_season").cast("bigint")).select(
        *views["matches"].columns
    )


def read_pages(views: Views) -> DataFrame:
    """All matches from page files of about a hundred documents each."""
    documents = match_documents(views).select(
        F.struct("*").alias("document"), F.expr("CAST(id AS BIGINT) DIV 400").alias("page")
    )
    pages = documents.groupBy("page").agg(F.collect_list("document").alias("data"))
    folder = staging_path(pages.sparkSession, "pages")
    pages.select("data").write.option("maxRecordsPerFile", 1).json(folder)
    found = landing.read_pages(pages.sparkSession, folder)
    return found.selectExpr("id", "leagueId", "season", "homeTeam.id AS home", "state.description")


def upsert_landed(views: Views) -> DataFrame:
    """Two loads into a landed entity, with dates of the documents as load order."""
    documents = views["matches"].selectExpr(
        "league_id AS leagueId",
        "league_season AS season",
        "replace(CAST(match_date AS STRING), ' ', 'T') AS date",
        "match_id",
        "description",
    )
    spark, folder = documents.sparkSession, staging_path(documents.sparkSession, "upsert")
    for load in (f"NOT {rules.is_finished()}", rules.is_finished()):
        landing.upsert_landed(
            spark, folder, "standings", documents.filter(load), ("date", "match_id")
        )
    return landing.read_landed(spark, folder, "standings", lines=True)


def upsert_small_load(views: Views) -> DataFrame:
    """All matches landed in buckets, then a load of those that were not finished, with a new state."""
    documents = match_documents(views)
    spark, folder = documents.sparkSession, staging_path(documents.sparkSession, "small-load")
    landing.write_landed(documents, folder, "matches")
    late = documents.filter("NOT state.description <=> 'Finished'").withColumn(
        "state", F.col("state").withField("description", F.lit("Corrected"))
    )
    landing.upsert_landed(spark, folder, "matches", late)
    found = landing.read_landed(spark, folder, "matches")
    return found.selectExpr("id", "leagueId", "season", "homeTeam.id AS home", "state.description")


def _pages(documents: DataFrame) -> DataFrame:
    """Pages of about a hundred documents each, by the numbers of the matches."""
    return documents.groupBy(F.expr("CAST(id AS BIGINT) DIV 400").alias("page")).agg(
        F.collect_list(F.struct("*")).alias("data")
    )


def _write_pages(pages: DataFrame, folder: str) -> None:
    pages.write.option("maxRecordsPerFile", 1).json(folder)


def ledger_loads(views: Views) -> DataFrame:
    """Page files that arrive in three batches, each loaded once, beside what the ledger notes."""
    documents = match_documents(views)
    spark, folder = documents.sparkSession, staging_path(documents.sparkSession, "ledger")
    pages = _pages(documents)
    late = documents.filter("NOT state.description <=> 'Finished'").withColumn(
        "state", F.col("state").withField("description", F.lit("Corrected"))
    )
    batches = [pages.filter("page % 2 = 0"), pages.filter("page % 2 = 1"), _pages(late)]
    files = []
    for number, batch in enumerate(batches):
        _write_pages(batch.select("data"), f"{folder}/pages/{number}")
        files.append(landing.load_new_pages(spark, f"{folder}/pages", folder, "matches", f"{folder}/lake"))
    again = landing.load_new_pages(spark, f"{folder}/pages", folder, "matches", f"{folder}/lake")
    found = landing.read_landed(spark, folder, "matches")
    return found.selectExpr(
        "id",
        "leagueId",
        "state.description",
        *[f"{n}L AS files_{i}" for i, n in enumerate([*files, again])],
    )


def _placed(documents: DataFrame, block: int = 1000) -> DataFrame:
    """The pages with their offsets, from the sizes of the pages and of blocks of them before."""
    pages = _pages(documents)
    sizes = documents.groupBy(F.expr("CAST(id AS BIGINT) DIV 400").alias("page")).count()
    sizes = sizes.withColumn("block", F.expr(f"page DIV {block}"))
    earlier = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = sizes.groupBy("block").agg(F.sum("count").alias("size"))
    before = blocks.select("block", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("before"))
    within = Window.partitionBy("block").orderBy("page").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.col("before") + F.coalesce(F.sum("count").over(within), F.lit(0))
    return pages.join(sizes.join(before, "block").select("page", offset.alias("offset")), "page")


def page_faults(views: Views) -> DataFrame:
    """Faults of two requests over the matches: one whole, one without some pages and without an end."""
    documents = match_documents(views).select("id")
    placed = _placed(documents).withColumn("data", F.transform("data", lambda d: d["id"]))
    end = documents.agg(F.count("*").alias("offset"))
    ended = end.select("offset", F.array().cast("array<string>").alias("data"))
    whole = placed.select("offset", "data").unionByName(ended).withColumn("request", F.lit("whole"))
    broken = placed.filter("page % 5 <> 2").select("offset", "data").withColumn("request", F.lit("broken"))
    folder = staging_path(documents.sparkSession, "page-faults")
    # Many files of little data: not as few tasks as the data alone would ask for.
    tasks = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    _write_pages(whole.unionByName(broken).repartition(tasks, "offset"), folder)
    return landing.page_faults(documents.sparkSession, folder, ("request",))


def aggregation_from_parts(views: Views) -> DataFrame:
    """The aggregation from parts of each season, those of the newest season written by a second load."""
    spark = views["matches"].sparkSession
    folder, marts = staging_path(spark, "parts"), {}
    for name in registry.inputs_of("fct_aggregation"):
        tables.write_table(registry.build(spark, name, views), folder, name)
        marts[name] = tables.read_table(spark, folder, name)
    newest = views["matches"].agg(F.max("league_season").cast("string")).scalar()
    parts.refresh_parts(spark, folder, marts, F.col("season") != newest)
    parts.refresh_parts(spark, folder, marts, F.col("season") == newest)
    return parts.merged_parts(spark, folder)


def seasonal_standings(views: Views) -> DataFrame:
    """Domestic standings kept by season, after a second load that brings the newest season."""
    matches = views["matches"]
    spark, folder = matches.sparkSession, staging_path(matches.sparkSession, "seasonal")
    newest = matches.agg(F.max("league_season")).scalar()

    def stored() -> DataFrame:
        return tables.read_table(spark, folder, "matches", matches.schema)

    seasonal.write_seasons(matches.filter(F.col("league_season") < newest), folder, "matches")
    seasonal.refresh_marts(spark, {**views, "matches": stored()}, folder)
    load = matches.filter(F.col("league_season") == newest)
    changed = seasonal.changed_seasons(stored(), load)
    seasonal.write_seasons(load, folder, "matches", changed)
    seasonal.refresh_marts(spark, {**views, "matches": stored()}, folder, changed)
    return seasonal.stored_mart(spark, folder, "fct_national_standings")


def _from_sides(views: Views, name: str) -> DataFrame:
    """A mart on the sides of all matches, stored in buckets by team beside the team statistics."""
    sides = side_table.store_sides(views["matches"])
    given = {**views, "matches": sides}
    if "team_stats" in registry.inputs_of(name):
        given["team_stats"] = side_table.beside(sides, views["team_stats"])
    return registry.build(views["matches"].sparkSession, name, given)


def recency_from_sides(views: Views) -> DataFrame:
    """Recency orders of all teams from stored sides."""
    return _from_sides(views, "fct_national_matches_melted_by_team")


def team_stats_from_sides(views: Views) -> DataFrame:
    """Statistics of all teams from stored sides."""
    return _from_sides(views, "fct_national_team_stats")


def world_standings_from_sides(views: Views) -> DataFrame:
    """World standings from stored sides, and from the matches that these give back."""
    return _from_sides(views, "fct_intern_standings")


def display_places(views: Views) -> DataFrame:
    """Rows of four marts with their places in the orders they are shown in."""
    spark = views["matches"].sparkSession
    keys = {
        "dim_season": "League_season_id",
        "fct_national_matches": "Match_id",
        "fct_national_standings": "concat_ws('|', League_season_id, Team_id, league_id, Country_id)",
        "fct_aggregation": "country_naipe_id",
    }
    shown = [
        registry.with_display_place(name, registry.build(spark, name, views)).selectExpr(
            f"'{name}' AS mart", f"{key} AS row_key", "display_place"
        )
        for name, key in keys.items()
    ]
    return reduce(DataFrame.union, shown)


def silver_leagues(views: Views) -> DataFrame:
    """Leagues with their seasons, each season with more fields than its number."""
    season = "named_struct('season', league_season, 'start', concat(league_season, '-01-01'))"
    # A league has few seasons.
    documents = (
        views["leagues"]
        .groupBy("league_id", "league_name", "country_code", "country_name")
        .agg(F.expr(f"collect_list({season}) AS seasons"))
        .selectExpr(
            "league_id AS id",
            "league_name AS name",
            "named_struct('code', country_code, 'name', country_name) AS country",
            "seasons",
        )
    )
    return through_files(documents, "leagues").select(
        "league_id", "league_name", "country_code", "country_name", "league_season", "start"
    )


def silver_standings(views: Views) -> DataFrame:
    """Standings of each league-season as one group of teams, exploded twice."""
    # A league-season has few teams.
    team = "named_struct('team_id', team_id, 'gamesPlayed', total_games_played, 'logo', NULL)"
    documents = (
        views["team_stats"]
        .groupBy("league_id", "league_season")
        .agg(F.expr(f"collect_list({team}) AS standings"))
        .selectExpr(
            "league_id AS leagueId",
            "league_season AS season",
            "named_struct('groups', array(named_struct('name', 'all', 'standings', standings))) AS data",
        )
    )
    return through_files(documents, "standings").select(
        "leagueId", "league_season", "season_name", "team_id", "games_played"
    )


def silver_teams(views: Views) -> DataFrame:
    documents = views["teams"].selectExpr("team_id AS id", "team_name AS name", "team_logo AS logo")
    return through_files(documents, "teams").select("team_id", "team_name", "team_logo")


def silver_countries(views: Views) -> DataFrame:
    documents = views["countries"].selectExpr(
        "country_code AS code", "country_name AS name", "country_logo AS logo"
    )
    return through_files(documents, "countries").select(
        "country_code", "country_name", "country_logo"
    )


def silver_team_stats(views: Views) -> DataFrame:
    documents = views["team_stats"].selectExpr(
        "team_id",
        "league_id AS leagueId",
        "league_season AS season",
        "named_struct('games', named_struct('played', total_games_played, 'wins', total_games_wins, "
        "'loses', total_games_loses), 'points', named_struct('scored', total_points_scored, "
        "'received', total_points_received)) AS total",
    )
    return through_files(documents, "team_stats").select(*views["team_stats"].columns)


def clustered_matches(views: Views) -> DataFrame:
    """Domestic matches of each country and season, from the silver layout written and read back."""
    matches = views["matches"]
    spark, folder = matches.sparkSession, staging_path(matches.sparkSession, "clustered")
    tables.write_table(matches, folder, "matches", layout=tables.SILVER_LAYOUT["matches"])
    stored = tables.read_table(spark, folder, "matches", matches.schema)
    return (
        stored.filter(rules.domestic_scope())
        .groupBy("country_name", "league_season")
        .agg(
            F.count("*").alias("n_matches"),
            F.min("match_id").alias("first_id"),
            F.max("match_id").alias("last_id"),
            F.sum("current_home_team_score").alias("home_sets"),
        )
    )


def export(views: Views) -> DataFrame:
    """A mart stored, exported and read back."""
    mart = registry.build(views["matches"].sparkSession, "dim_teams", views)
    folder = staging_path(mart.sparkSession, "export")
    tables.write_table(mart, f"{folder}/gold", "dim_teams")
    tables.export_tables(mart.sparkSession, f"{folder}/gold", f"{folder}/export", ("dim_teams",))
    return tables.read_table(mart.sparkSession, f"{folder}/export", "dim_teams")


def stats_of_league(views: Views) -> DataFrame:
    """Statistics that came for one league, those of others left out, stamped with the request."""
    stats = views["team_stats"].select("team_id", "league_id", "league_season")
    return ingest.stamp(ingest.of_league(stats, "2", "league_id"), asked_league="2")
