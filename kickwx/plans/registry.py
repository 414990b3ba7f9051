"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Each entry builds the marts as one lazy plan over the given test tables and
runs one operator or analytical question on them. Floating results that are
averages, standard deviations or unrounded percentages are rounded to six
places here (not in the library), because summation order differs between
engines.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kickwx.plans import analytics as A
from kickwx.plans import legacy as L
from kickwx.plans.marts import Marts, published_dim, published_fact, v_matches_full, v_matches_limited
from kickwx.plans.warehouse import PAYLOAD_WEATHER_METHOD, fresh_path, marts_from_tables

QueryFn = Callable[[SparkSession, str], DataFrame]

# Parameters of the reference's queries (fixed values of the reference).
MATCH_TEAMS = (1, 2)
FOCUS_TEAM = 100
DASHBOARD_COUNTRY = "EUROPE"


def round6(df: DataFrame, cols) -> DataFrame:
    return df.select([F.round(F.col(c), 6).alias(c) if c in cols else F.col(c) for c in df.columns])


def _on_marts(fn: Callable[[Marts], DataFrame], rounded=(), method: str = PAYLOAD_WEATHER_METHOD) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return round6(fn(marts_from_tables(spark, sf_dir, weather_method=method)), set(rounded))
    run.__doc__ = fn.__doc__
    return run


_VAR = ("avg_goal_difference", "stddev_goal_difference")


def _weather_kept(method: str) -> QueryFn:
    from kickwx.plans import staging as stg
    from kickwx.operators.asof import select_kickoff_weather
    from kickwx.plans.warehouse import bronze_from_tables

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        b = bronze_from_tables(spark, sf_dir)
        kick = stg.stg_fixtures(b.fixtures).select("event_id", "match_datetime")
        kept = select_kickoff_weather(stg.latest_observations(b.weather), kick, method=method)
        return kept.select("event_id", "weather_datetime", "match_datetime")
    run.__doc__ = f"Weather observations kept around each kick-off ({method} form of the as-of selection)."
    return run


def registry() -> dict[str, QueryFn]:
    q: dict[str, QueryFn] = {
        # analytical questions over the current marts
        "attendance_rain": _on_marts(A.attendance_rain),
        "fouls_rain": _on_marts(A.fouls_rain, ("average_total_fouls", "average_home_fouls", "average_away_fouls")),
        "home_win_rain": _on_marts(A.home_win_rain),
        "bq1_temp": _on_marts(A.home_win_temperature),
        "bq1_wind": _on_marts(A.home_win_wind),
        "variability_rain": _on_marts(A.variability_rain, _VAR),
        "variability_temp": _on_marts(A.variability_temp, _VAR),
        "variability_wind": _on_marts(A.variability_wind, _VAR),
        "bq2_by_country": _on_marts(lambda m: A.variability_rain_in_country(m, DASHBOARD_COUNTRY), _VAR),
        "penalty_weather": _on_marts(A.penalty_weather),
        "team_resilience": _on_marts(A.team_resilience, ("win_percentage",)),
        "unpivot_home_away": _on_marts(
            lambda m: A.team_rows(m).select(
                published_key_col("team_key"), "weather_temp_category", "is_win")),
        "role_full_top20": _on_marts(lambda m: A.role_top20(m, limited=False)),
        "role_limited_top20": _on_marts(lambda m: A.role_top20(m, limited=True)),
        # questions over the older schema
        "rain_and_venue": _on_marts(lambda m: L.rain_and_venue(L.legacy_star(m)), ("AvgFouls_Rainy", "AvgFouls_Otherwise")),
        "matches_temperature": _on_marts(lambda m: L.matches_temperature(L.legacy_star(m), *MATCH_TEAMS)),
        "team_hottest5": _on_marts(lambda m: L.team_extreme_temperature(L.legacy_star(m), FOCUS_TEAM, hottest=True)),
        "team_coldest5": _on_marts(lambda m: L.team_extreme_temperature(L.legacy_star(m), FOCUS_TEAM, hottest=False)),
        "team_precipitation": _on_marts(lambda m: L.team_precipitation(L.legacy_star(m))),
        # models and marts as published tables
        "stg_fixtures": _stg_fixtures,
        "dim_date": _on_marts(lambda m: published_dim(m.dim_date, "date_key")),
        "dim_team": _on_marts(lambda m: published_dim(m.dim_team, "team_key")),
        "dim_venue": _on_marts(lambda m: published_dim(m.dim_venue, "venue_key")),
        "stg_dim_weather": _on_marts(lambda m: published_dim(m.stg_dim_weather, "weather_key")),
        "dim_weather": _on_marts(lambda m: published_dim(m.dim_weather, "weather_key")),
        "fact_match": _on_marts(lambda m: published_fact(m.fact_match)),
        "v_matches_full": _on_marts(lambda m: v_matches_full(m.fact_match)),
        "v_matches_limited": _on_marts(lambda m: v_matches_limited(m.fact_match)),
        "team_stats_agg": _team_stats_agg,
        "stg_team_stats": _stg_team_stats,
        "weather_nearest": _weather_kept("window"),
        "asof_grid": _weather_kept("grid"),
        "weather_ranks": _weather_kept("ranks"),
        "weather_aggregate": _weather_kept("aggregate"),
        "weather_topk": _weather_kept("topk"),
    }
    q.update(EXTRA)
    return q


def published_key_col(name: str):
    from kickwx.functions.keys import published_key
    return published_key(F.col(name)).alias(name)


def _stg_fixtures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed fixtures after last-write-wins."""
    from kickwx.plans import staging as stg
    from kickwx.plans.warehouse import bronze_from_tables
    return stg.stg_fixtures(bronze_from_tables(spark, sf_dir).fixtures)


def _stg_team_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed per-team statistics: '6.0'-style counts truncated, possession truncated to decimal(5,2)."""
    from kickwx.plans import staging as stg
    from kickwx.plans.warehouse import bronze_from_tables
    return stg.stg_team_stats(bronze_from_tables(spark, sf_dir).team_stats)


def _team_stats_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Home and away statistics per event (conditional-max pivot over the left join)."""
    from kickwx.plans import staging as stg
    from kickwx.plans.warehouse import bronze_from_tables
    b = bronze_from_tables(spark, sf_dir)
    fx = stg.stg_fixtures(b.fixtures)
    agg = stg.team_stats_agg(fx, stg.stg_team_stats(b.team_stats))
    # events without statistics keep a row of NULLs, as in the reference's left join
    return fx.select("event_id").join(agg, "event_id", "left")


# --- ingest, work lists, enrichment, upsert, quality -------------------------

def _bronze(spark: SparkSession, sf_dir: str, latest: bool = True):
    from kickwx.plans.warehouse import bronze_from_stand_in
    from kickwx.sources.testdata import stand_in
    s = stand_in(spark, sf_dir)
    b = bronze_from_stand_in(s)
    return replace(b, weather=s.weather_by_event).latest() if latest else b


def _latest_by_key(spark, sf_dir):
    """Newest version of every fixture (K5)."""
    return _bronze(spark, sf_dir).fixtures


def _surrogate_keys(spark, sf_dir):
    """Match and date keys of every typed fixture, as published unsigned values."""
    from kickwx.functions.keys import hash_key, published_key
    from kickwx.plans import staging as stg
    fx = stg.stg_fixtures(_bronze(spark, sf_dir, latest=False).fixtures)
    return fx.select(
        "event_id",
        published_key(hash_key(F.col("event_id"))).alias("match_id"),
        published_key(stg.date_key(F.col("match_datetime"), F.col("venue_id"))).alias("date_key"),
    )


def _weather_hourly_unnest(spark, sf_dir):
    """Landed hourly payloads unnested to one typed row per hour (S7 + K4)."""
    from kickwx.sources.testdata import stand_in
    return stand_in(spark, sf_dir).weather


def _bronze_null_normalize(spark, sf_dir):
    """NA tokens to NULL on every text column of the venue rows (S3)."""
    from kickwx.sources.bronze import normalize_na
    from kickwx.sources.testdata import stand_in
    return normalize_na(stand_in(spark, sf_dir).venues)


def _bronze_stringify(spark, sf_dir):
    """Lake fixtures re-inserted as text with a NULL weather flag and the load time (K3)."""
    from kickwx.sources.bronze import stringify_fixtures
    from kickwx.sources.testdata import SECOND_LOAD
    lake = _bronze(spark, sf_dir).fixtures.drop("hasWeather", "_ingestion_time")
    return stringify_fixtures(lake, F.lit(SECOND_LOAD).cast("timestamp_ntz"))


def _bronze_row_counts(spark, sf_dir):
    """Row count of every deduplicated bronze table."""
    b = _bronze(spark, sf_dir)
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"), "row_count")
             for n, df in [("fixtures", b.fixtures), ("teams", b.teams), ("venues", b.venues),
                           ("teamStats", b.team_stats), ("weather", b.weather)]]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _scan_parquet(spark, sf_dir):
    """Parquet table read through a read-only temp view."""
    from kickwx.sources.bronze import scan_parquet
    scan_parquet(spark, f"{sf_dir.rstrip('/')}/orders.parquet", view="orders_readonly")
    return spark.table("orders_readonly")


def _geocode_query_text(spark, sf_dir):
    """Geocoder query text of every venue."""
    from kickwx.operators.enrich import geocode_query_text
    v = _bronze(spark, sf_dir).venues
    return v.select("venueId", geocode_query_text(F.col("city"), F.col("country")).alias("query"))


def _pending_geocode(spark, sf_dir):
    """Next batch of venues to geocode: no coordinates, most matches first (Q16)."""
    from kickwx.operators.enrich import VENUE_BATCH, pending_geocode
    b = _bronze(spark, sf_dir)
    return pending_geocode(b.venues, b.fixtures, VENUE_BATCH)


def _venue_coord_enrich(spark, sf_dir):
    """Venues with missing coordinates filled from the gazetteer (K6)."""
    from kickwx.operators.enrich import venue_coord_enrich
    from kickwx.sources.testdata import gazetteer, stand_in
    s = stand_in(spark, sf_dir)
    return venue_coord_enrich(_bronze(spark, sf_dir).venues, gazetteer(s.nation, s.region))


def _pending_weather(spark, sf_dir):
    """Next batch of matches to fetch weather for: none yet, venue located, oldest first (Q17)."""
    from kickwx.operators.enrich import MATCH_BATCH, pending_weather
    b = _bronze(spark, sf_dir)
    return pending_weather(b.fixtures, b.venues, b.weather, MATCH_BATCH)


def _mark_has_weather(spark, sf_dir):
    """Fixtures with the weather flag set where weather rows exist (K7)."""
    from kickwx.operators.enrich import mark_has_weather
    b = _bronze(spark, sf_dir)
    return mark_has_weather(b.fixtures, b.weather)


def _weather_latest(spark, sf_dir):
    """Hourly weather rows of the last fetch of every (event, hour) (K5)."""
    return _bronze(spark, sf_dir).weather


def _weather_stream_latest(spark, sf_dir):
    """Payloads streamed into the hourly table, which keeps the last fetch of every (event, hour): the second load lands first (K4, K5)."""
    from kickwx.operators.upsert import read_upserted
    from kickwx.sources.schemas import INGESTION_TIME
    from kickwx.sources.testdata import FIRST_LOAD, SECOND_LOAD, stand_in
    from kickwx.streaming.payload_ingest import upsert_available_payloads
    s, landing, table = stand_in(spark, sf_dir), fresh_path(spark, "payloads"), fresh_path(spark, "weather-latest")
    for load in (SECOND_LOAD, FIRST_LOAD):
        s.payload.filter(F.col(INGESTION_TIME) == F.lit(load).cast("timestamp_ntz")).write.mode("append").parquet(landing)
        upsert_available_payloads(spark, landing, table, schema=s.payload.schema)
    return read_upserted(spark, table, s.weather.schema)


def _csv_ingest(spark, sf_dir):
    """Venue rows exported as CSV (quotes, commas, line breaks, NA tokens) and loaded back as bronze."""
    from kickwx.sources.bronze import read_bronze_csv
    from kickwx.sources.testdata import FIRST_LOAD, stand_in
    path = _write_csv(stand_in(spark, sf_dir).venues.drop("_ingestion_time"), fresh_path(spark, "venues-csv"))
    return read_bronze_csv(spark, path, "venues", F.lit(FIRST_LOAD).cast("timestamp_ntz"), multi_line=True)


def _write_csv(df, path):
    (df.write.option("header", True).option("quote", '"').option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    return path


def _csv_export(spark, sf_dir):
    """Venue CSV exported to a text parquet table and read back (K1)."""
    from kickwx.sources.bronze import export_csv_to_parquet
    from kickwx.sources.testdata import stand_in
    path = _write_csv(stand_in(spark, sf_dir).venues.drop("_ingestion_time"), fresh_path(spark, "venues-csv"))
    return spark.read.parquet(export_csv_to_parquet(spark, path, fresh_path(spark, "venues-lake"), multi_line=True))


def _drop_ingest(spark, sf_dir):
    """A data drop with three of its four files appended to bronze, and the fourth table from the lake: rows per table."""
    from kickwx.sources.bronze import append_drop, read_lake_or_csv
    from kickwx.sources.testdata import stand_in
    s, drop, lake = stand_in(spark, sf_dir), fresh_path(spark, "drop"), fresh_path(spark, "lake-teams")
    for name, df in (("fixtures", s.fixtures), ("venues", s.venues), ("teamStats", s.team_stats)):
        _write_csv(df.drop("_ingestion_time"), f"{drop}/{name}.csv")
    s.teams.write.parquet(lake)
    tables = append_drop(spark, drop, fresh_path(spark, "bronze"), multi_line=True)
    tables["teams"] = read_lake_or_csv(spark, "teams", lake, f"{drop}/teams.csv")
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"), "row_count") for n, df in sorted(tables.items())]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _lake_table(spark, sf_dir):
    """Venue rows inserted into a declared catalog table, created where it was absent."""
    from kickwx.sources.bronze import load_or_create_lake_table
    from kickwx.sources.testdata import stand_in
    name = "kickwx_lake_venues_" + fresh_path(spark, "t").rsplit("-", 1)[1]
    empty = load_or_create_lake_table(spark, name, "venues")
    stand_in(spark, sf_dir).venues.select(*empty.columns).write.insertInto(name)
    return load_or_create_lake_table(spark, name, "venues")


def _sql_views(spark, sf_dir):
    """Home matches per team, asked in SQL of the registered views (K8)."""
    from kickwx.plans.views import register_views
    register_views(spark, marts_from_tables(spark, sf_dir), prefix="kickwx_")
    return spark.sql("""
        SELECT t.team_name, count(*) AS home_matches, sum(f.home_goals) AS home_goals
        FROM kickwx_fact_match f JOIN kickwx_dim_team t ON f.home_team_key = t.team_key GROUP BY t.team_name""")


def _marts_tables(spark, sf_dir):
    """The fact read from marts written as bucketed catalog tables (K9)."""
    from kickwx.plans.warehouse import bronze_from_tables, materialize_tables, read_tables
    database = "kickwx_" + fresh_path(spark, "m").rsplit("-", 1)[1]
    materialize_tables(spark, bronze_from_tables(spark, sf_dir), database, weather_method=PAYLOAD_WEATHER_METHOD)
    return published_fact(read_tables(spark, database).fact_match)


def _bronze_append(spark, sf_dir):
    """Bronze fixtures after two appended loads: every version of every row."""
    from kickwx.sources.bronze import append_bronze
    path = fresh_path(spark, "bronze-fixtures")
    rows = _bronze(spark, sf_dir, latest=False).fixtures
    first, second = _by_load(rows)
    append_bronze(first, path, "fixtures")
    return append_bronze(second, path, "fixtures")


def _by_load(fixtures):
    from kickwx.sources.testdata import FIRST_LOAD
    first = F.col("_ingestion_time") <= F.lit(FIRST_LOAD).cast("timestamp_ntz")
    return fixtures.filter(first), fixtures.filter(~first)


def _incremental_upsert(spark, sf_dir):
    """Written fact after the first load, the second load's matches replaced by key, and that batch again."""
    from kickwx.functions.casts import to_id
    from kickwx.operators.upsert import upsert_table
    from kickwx.plans.refresh import of_matches
    from kickwx.plans.warehouse import MartsInSteps, written
    b = _bronze(spark, sf_dir, latest=False)
    root = fresh_path(spark, "fact_match")
    for rows in _by_load(b.fixtures):
        # a batch is built once, from the statistics and weather of its own matches
        ids = written(rows.select(to_id("eventId").alias("event_id")).filter("event_id IS NOT NULL").distinct(), "batch-ids")
        batch = replace(of_matches(b, ids), fixtures=rows)
        path = fresh_path(spark, "fact_match_batch")
        MartsInSteps(batch, PAYLOAD_WEATHER_METHOD).fact_match.write.parquet(path)
        upsert_table(spark, root, spark.read.parquet(path), ["match_id"], F.date_format("match_datetime", "yyyy-MM"))
    return published_fact(upsert_table(spark, root, spark.read.parquet(path), ["match_id"], F.date_format("match_datetime", "yyyy-MM")))


def _marts_refresh(spark, sf_dir):
    """Written marts after a first load, after one that brings only statistics and weather, and after one with fixtures: the fact."""
    from kickwx.plans.refresh import refresh_tables
    from kickwx.plans.staging import Bronze
    from kickwx.sources.testdata import FIRST_LOAD
    b, root = _bronze(spark, sf_dir, latest=False), fresh_path(spark, "marts")
    # statistics of the first load come a minute apart; the later ones, and later versions of weather and fixtures, are change sets
    until = FIRST_LOAD.replace(":00:00", ":03:00")
    old = lambda df: df.filter(F.col("_ingestion_time") <= F.lit(until).cast("timestamp_ntz"))
    refresh_tables(spark, root, Bronze(old(b.fixtures), b.teams, b.venues, old(b.team_stats), old(b.weather)), None, PAYLOAD_WEATHER_METHOD)
    refresh_tables(spark, root, Bronze(old(b.fixtures), b.teams, b.venues, b.team_stats, b.weather), until, PAYLOAD_WEATHER_METHOD)
    return published_fact(refresh_tables(spark, root, b, until, PAYLOAD_WEATHER_METHOD).fact_match)


def _marts(spark, sf_dir):
    return marts_from_tables(spark, sf_dir)


def _dq_unique(spark, sf_dir):
    """Keys that occur more than once: match_id of the fact, date_key of the dates, event id of the bronze
    fixtures (several versions) (D1)."""
    from kickwx.functions.keys import published_key
    from kickwx.operators.quality import unique_violations
    from kickwx.plans import staging as stg
    m = _marts(spark, sf_dir)
    versions = stg.typed_fixtures(_bronze(spark, sf_dir, latest=False).fixtures)
    parts = [
        unique_violations(df, key).select(F.lit(f"{name}.{key}").alias("check"), value(F.col(key)).alias("key_value"), "n_rows")
        for name, df, key, value in [
            ("fact_match", m.fact_match, "match_id", published_key), ("dim_date", m.dim_date, "date_key", published_key),
            ("bronze_fixtures", versions, "event_id", lambda c: c.cast("decimal(20,0)")),
        ]
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _dq_not_null(spark, sf_dir):
    """NULL counts of the fact's required columns in one pass."""
    from kickwx.operators.quality import null_counts
    return null_counts(_marts(spark, sf_dir).fact_match, ["match_id", "home_team_key", "away_team_key"])


TEAM_SIDES = ("home_team_id", "away_team_id")


def _team_orphans(spark, sf_dir):
    from kickwx.operators.quality import orphan_sides
    from kickwx.plans import staging as stg
    b = _bronze(spark, sf_dir, latest=False)
    return orphan_sides(stg.stg_fixtures(b.fixtures), "event_id", TEAM_SIDES, stg.stg_dim_team(b.teams), "team_id")


def _dq_relationships(spark, sf_dir):
    """Typed fixtures whose home or away team id has no team (D3)."""
    return _team_orphans(spark, sf_dir)


def _dq_non_negative(spark, sf_dir):
    """Fact rows with negative away goals."""
    from kickwx.operators.quality import negative_values
    return published_fact(negative_values(_marts(spark, sf_dir).fact_match, "away_goals"))


def _dq_summary(spark, sf_dir):
    """All checks as (check, failing_rows): one pass over the fact by match, one over the dates, one over the
    fixtures' team ids, one over the bronze ids that can't be typed."""
    from kickwx.operators.quality import unique_violations
    from kickwx.plans import staging as stg
    m = _marts(spark, sf_dir)
    count = lambda c: F.coalesce(F.sum(F.when(c, 1).otherwise(0)), F.lit(0)).cast("bigint")
    nulls = {k: F.col(k).isNull() for k in ("home_team_key", "away_team_key")}
    by_match = m.fact_match.groupBy("match_id").agg(
        F.count(F.lit(1)).alias("n"), count(F.col("away_goals") < 0).alias("negative"),
        *[count(c).alias(k) for k, c in nulls.items()],
    )
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    wide = by_match.agg(
        count(F.col("match_id").isNotNull() & (F.col("n") > 1)).alias("unique_match_id"),
        total(F.when(F.col("match_id").isNull(), F.col("n"))).alias("not_null_match_id"),
        *[total(k).alias(f"not_null_{k}") for k in nulls],
        total("negative").alias("non_negative_away_goals"),
    )
    checks = wide.select(F.inline(F.array(*[F.struct(F.lit(c).alias("check"), F.col(c).alias("failing_rows")) for c in wide.columns])))
    orphans = _team_orphans(spark, sf_dir).agg(*[count(F.col("check") == k).alias(f"relationships_{k}") for k in TEAM_SIDES])
    orphans = orphans.select(F.inline(F.array(*[F.struct(F.lit(c).alias("check"), F.col(c).alias("failing_rows")) for c in orphans.columns])))
    rows = lambda name, df: df.agg(F.count(F.lit(1)).alias("failing_rows")).select(F.lit(name).alias("check"), "failing_rows")
    return (
        checks.unionByName(orphans)
        .unionByName(rows("unique_date_key", unique_violations(m.dim_date, "date_key")))
        .unionByName(rows("untypable_event_id", stg.unusable_ids(_bronze(spark, sf_dir, latest=False).fixtures, "eventId")))
    )


def _dq_profile(spark, sf_dir):
    """Column profile of the published fact (D5): rows, NULLs, smallest and largest value."""
    from kickwx.operators.quality import profile
    return profile(published_fact(_marts(spark, sf_dir).fact_match)).drop("approx_distinct")


EXTRA = {
    "latest_by_key": _latest_by_key,
    "weather_latest": _weather_latest,
    "weather_stream_latest": _weather_stream_latest,
    "csv_ingest": _csv_ingest,
    "bronze_append": _bronze_append,
    "csv_export": _csv_export,
    "drop_ingest": _drop_ingest,
    "lake_table": _lake_table,
    "sql_views": _sql_views,
    "marts_tables": _marts_tables,
    "surrogate_keys": _surrogate_keys,
    "weather_hourly_unnest": _weather_hourly_unnest,
    "bronze_null_normalize": _bronze_null_normalize,
    "bronze_stringify": _bronze_stringify,
    "bronze_row_counts": _bronze_row_counts,
    "scan_parquet": _scan_parquet,
    "geocode_query_text": _geocode_query_text,
    "pending_geocode": _pending_geocode,
    "venue_coord_enrich": _venue_coord_enrich,
    "pending_weather": _pending_weather,
    "mark_has_weather": _mark_has_weather,
    "incremental_upsert": _incremental_upsert,
    "marts_refresh": _marts_refresh,
    "dq_unique": _dq_unique,
    "dq_not_null": _dq_not_null,
    "dq_relationships": _dq_relationships,
    "dq_non_negative": _dq_non_negative,
    "dq_summary": _dq_summary,
    "dq_profile": _dq_profile,
}
