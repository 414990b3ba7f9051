"""Wiring: bronze inputs -> marts, lazily or written as catalog tables.

``marts_from_tables`` gives the marts in steps: typed fixtures and weather dimension are written when a mart first needs them,
the rest is one lazy plan on these, so that the driver never holds (and plans anew after every stage) the whole star.
``materialize_tables`` writes the marts in dependency order, each step reading the written
upstream, so no step recomputes another and a lost executor redoes only its own step.
"""

from __future__ import annotations

import uuid
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from kickwx.operators.asof import DEFAULT_WEATHER_METHOD
from kickwx.operators.dedup import latest_by_key
from kickwx.plans import staging as stg
from kickwx.plans.marts import Marts, dim_weather, fact_match
from kickwx.plans.staging import Bronze
from kickwx.session import output_root
from kickwx.sources.schemas import BRONZE_KEYS
from kickwx.sources.testdata import StandIn, stand_in

# The hourly payload should deliver every full hour of the kick-off date; matches where it does not take the window path.
PAYLOAD_WEATHER_METHOD = "guarded"


def bronze_from_stand_in(s: StandIn) -> Bronze:
    return Bronze(fixtures=s.fixtures, teams=s.teams, venues=s.venues, team_stats=s.team_stats, weather=s.weather)


def bronze_from_tables(spark: SparkSession, sf_dir: str) -> Bronze:
    return bronze_from_stand_in(stand_in(spark, sf_dir))


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{output_root(spark)}/kickwx/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written into a fresh folder and reread."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class MartsInSteps(Marts):
    """The marts of :func:`build_marts`, with what several of them need written once, at its first use.

    As one plan the star reads fixtures and weather again for each of them, and after every stage the driver optimises
    all that is left of it. The written steps have one row per match; lookups and the marts that nothing else reads stay lazy.
    """

    def __init__(self, bronze: Bronze, weather_method: str = DEFAULT_WEATHER_METHOD):
        self.bronze, self.weather_method = bronze, weather_method

    @cached_property
    def fixtures(self) -> DataFrame:
        return written(stg.stg_fixtures(self.bronze.fixtures), "typed-fixtures")

    @cached_property
    def stg_dim_weather(self) -> DataFrame:
        return stg.stg_dim_weather(self.bronze.weather, self.fixtures, method=self.weather_method, step=written)

    @cached_property
    def dim_weather(self) -> DataFrame:
        return written(dim_weather(self.stg_dim_weather), "dim-weather")

    @cached_property
    def dim_date(self) -> DataFrame:
        return stg.stg_dim_date(self.fixtures)

    @cached_property
    def dim_team(self) -> DataFrame:
        return stg.stg_dim_team(latest_by_key(self.bronze.teams, BRONZE_KEYS["teams"]))

    @cached_property
    def dim_venue(self) -> DataFrame:
        return stg.stg_dim_venue(latest_by_key(self.bronze.venues, BRONZE_KEYS["venues"]))

    @cached_property
    def fact_match(self) -> DataFrame:
        return fact_match(self.fixtures, stg.stg_team_stats(self.bronze.team_stats), self.dim_venue, self.dim_weather, self.dim_team)


def marts_from_tables(spark: SparkSession, sf_dir: str, weather_method: str = PAYLOAD_WEATHER_METHOD) -> Marts:
    return MartsInSteps(bronze_from_tables(spark, sf_dir), weather_method)


BRONZE_TABLES = ["fixtures", "teams", "venues", "team_stats", "weather"]


def write_bronze(spark: SparkSession, bronze: Bronze, root: str | None = None) -> str:
    """Persist the bronze tables (the ingest step) into a fresh folder."""
    root = root or fresh_path(spark, "bronze")
    for name in BRONZE_TABLES:
        getattr(bronze, name).write.mode("errorifexists").parquet(f"{root}/{name}")
    return root


def read_bronze(spark: SparkSession, root: str) -> Bronze:
    return Bronze(**{n: spark.read.parquet(f"{root}/{n}") for n in BRONZE_TABLES})


# --- catalog tables: fact and weather dimension bucketed on the match ---

BUCKETED = {"fact_match": "event_id", "dim_weather": "event_id"}
MART_NAMES = ["dim_date", "dim_team", "dim_venue", "stg_dim_weather", "dim_weather", "fact_match"]


def materialize_tables(spark: SparkSession, bronze: Bronze, database: str = "kickwx_marts",
                       buckets: int | None = None, weather_method: str = DEFAULT_WEATHER_METHOD,
                       bucket: bool = True) -> str:
    """Build the marts into catalog tables; fact and weather dimension bucketed on ``event_id``.

    Every analytical question joins the fact to the weather dimension, one row per match on either side; with both
    tables hash-bucketed on the match (same count), that join reads bucket against bucket with no
    exchange. Every row has a match, so no bucket collects the matches without weather. ``bucket=False``
    leaves the layout to the writer (for marts whose weather dimension is known to be broadcast).
    Each build writes tables with a fresh version suffix and then points the plain names
    (views) at them, so readers of the previous build are never disturbed.
    Returns the version suffix.
    """
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    version = f"v{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    t = lambda name: f"{database}.{name}_{version}"

    def save(df, name):
        if bucket and name in BUCKETED:
            # one task per bucket: one file per bucket instead of one per (task, bucket)
            key = BUCKETED[name]
            df.repartition(n, key).write.format("parquet").mode("errorifexists").bucketBy(n, key).saveAsTable(t(name))
        else:
            df.write.format("parquet").mode("errorifexists").saveAsTable(t(name))
        return spark.table(t(name))

    fixtures = stg.stg_fixtures(bronze.fixtures)
    chosen = save(stg.stg_dim_weather(bronze.weather, fixtures, method=weather_method), "stg_dim_weather")
    weather = save(dim_weather(chosen), "dim_weather")
    team = save(stg.stg_dim_team(latest_by_key(bronze.teams, BRONZE_KEYS["teams"])), "dim_team")
    venue = save(stg.stg_dim_venue(latest_by_key(bronze.venues, BRONZE_KEYS["venues"])), "dim_venue")
    save(stg.stg_dim_date(fixtures), "dim_date")
    save(fact_match(fixtures, stg.stg_team_stats(bronze.team_stats), venue, weather, team), "fact_match")
    for name in MART_NAMES:
        spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} AS SELECT * FROM {t(name)}")
    return version


def read_tables(spark: SparkSession, database: str = "kickwx_marts") -> Marts:
    return Marts(**{name: spark.table(f"{database}.{name}") for name in MART_NAMES})
