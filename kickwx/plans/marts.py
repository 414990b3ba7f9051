"""Marts: the star schema (four dimensions, one match fact) and the analytics views.

Inside the marts every surrogate key is the signed 64-bit form (``bigint``);
``published_*`` projections turn keys into the reference's unsigned
``decimal(20,0)``. The fact also keeps the natural ids it was built from
(``event_id``, ``venue_id``, ``home_team_id``, ``away_team_id``) for the older
schema's adapter, and the kick-off, by whose month written facts are laid out; the published fact has the reference's 21 columns.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kickwx.functions.casts import start_of_hour
from kickwx.functions.keys import hash_key, published_key
from kickwx.functions.masks import attendance_band, goal_range
from kickwx.plans import staging as stg
from kickwx.operators.asof import DEFAULT_WEATHER_METHOD
from kickwx.operators.dedup import latest_by_key
from kickwx.sources.schemas import BRONZE_KEYS

KEY_COLUMNS = ["match_id", "date_key", "venue_key", "weather_key", "home_team_key", "away_team_key"]
MEASURES = [
    "home_goals", "away_goals", "home_shootout_score", "away_shootout_score", "attendance",
    "home_fouls", "away_fouls", "home_yellow_cards", "home_red_cards", "away_yellow_cards",
    "away_red_cards", "home_possession_pct", "away_possession_pct", "home_corners", "away_corners",
]
NATURAL_IDS = ["event_id", "venue_id", "home_team_id", "away_team_id"]
FACT_COLUMNS = KEY_COLUMNS + MEASURES


@dataclass
class Marts:
    dim_date: DataFrame
    dim_team: DataFrame
    dim_venue: DataFrame
    stg_dim_weather: DataFrame
    dim_weather: DataFrame
    fact_match: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        return {
            "dim_date": self.dim_date, "dim_team": self.dim_team, "dim_venue": self.dim_venue,
            "stg_dim_weather": self.stg_dim_weather, "dim_weather": self.dim_weather,
            "fact_match": self.fact_match,
        }


def dim_weather(stg_weather: DataFrame) -> DataFrame:
    """One row per match: mean over its kept hours, first and last hour used."""
    return (
        stg_weather.groupBy("event_id")
        .agg(
            F.min("match_datetime").alias("__ko"),
            F.min("latitude").alias("latitude"),
            F.min("longitude").alias("longitude"),
            F.min("timestamp_hour").alias("first_weather_hour"),
            F.max("timestamp_hour").alias("second_weather_hour"),
            *[F.bround(F.avg(m), 3).alias(f"avg_{m}") for m in stg.WEATHER_MEASURES],
        )
        .select(
            hash_key(F.col("event_id"), start_of_hour(F.col("__ko"))).alias("weather_key"),
            "event_id", "latitude", "longitude", "first_weather_hour", "second_weather_hour",
            *[f"avg_{m}" for m in stg.WEATHER_MEASURES],
        )
    )


def fact_match(fixtures: DataFrame, team_stats: DataFrame, dim_venue: DataFrame,
               dim_weather_: DataFrame, dim_team: DataFrame) -> DataFrame:
    """Match fact at one row per match.

    ``fixtures`` and ``team_stats`` are the typed models (newest versions). Plan:
      * fixtures LEFT JOIN per-team statistics on ``event_id`` and the
        home/away pivot as conditional MAX grouped by the fixture row: the
        statistics side by side and their join back to fixtures in one step;
      * the weather key joins on ``event_id``, the same partitioning;
      * the grain aggregation (MAX of the measures per match) follows there, still on
        ``event_id``, before any lookup: fixtures are exchanged once up to here;
      * venue and team are looked up on the aggregated rows, venue and away team
        after it; the planner broadcasts them when their measured size is under the
        broadcast threshold and falls back to a shuffle join (split if skewed) otherwise;
      * the date key is computed with the same key function ``dim_date``
        applies to the same rows, so its lookup is the key itself (NULL when
        kick-off or venue is NULL).
    """
    j = fixtures.join(team_stats.select("event_id", "team_id", *stg.STATS).hint("merge"), "event_id", "left")
    per_match = j.groupBy(*fixtures.columns).agg(*stg.side_pivot())
    ids = [*NATURAL_IDS, "match_datetime", "weather_key"]
    grain = (
        per_match.join(dim_weather_.select("event_id", "weather_key").hint("merge"), "event_id", "left")
        .groupBy(*ids).agg(*[F.max(m).alias(m) for m in MEASURES])
    )
    dv = dim_venue.select("venue_id", "venue_key")
    th = dim_team.select(F.col("team_id").alias("home_team_id"), F.col("team_key").alias("home_team_key"))
    ta = dim_team.select(F.col("team_id").alias("away_team_id"), F.col("team_key").alias("away_team_key"))
    return (
        grain.join(dv, "venue_id", "left").join(th, "home_team_id", "left").join(ta, "away_team_id", "left")
        .withColumn("match_id", hash_key(F.col("event_id")))
        .withColumn("date_key", stg.date_key(F.col("match_datetime"), F.col("venue_id")))
        .select(*KEY_COLUMNS, *MEASURES, *NATURAL_IDS, "match_datetime")
    )


def build_marts(bronze: stg.Bronze, weather_method: str = DEFAULT_WEATHER_METHOD) -> Marts:
    """All marts from bronze rows of any version, as one lazy plan."""
    fixtures = stg.stg_fixtures(bronze.fixtures)
    d_team = stg.stg_dim_team(latest_by_key(bronze.teams, BRONZE_KEYS["teams"]))
    d_venue = stg.stg_dim_venue(latest_by_key(bronze.venues, BRONZE_KEYS["venues"]))
    s_weather = stg.stg_dim_weather(bronze.weather, fixtures, method=weather_method)
    d_weather = dim_weather(s_weather)
    fact = fact_match(fixtures, stg.stg_team_stats(bronze.team_stats), d_venue, d_weather, d_team)
    return Marts(
        dim_date=stg.stg_dim_date(fixtures),
        dim_team=d_team,
        dim_venue=d_venue,
        stg_dim_weather=s_weather,
        dim_weather=d_weather,
        fact_match=fact,
    )


# --- published forms (unsigned decimal keys) and the analytics views ---

def _publish(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.select([published_key(F.col(c)).alias(c) if c in keys else F.col(c) for c in df.columns])


def published_fact(fact: DataFrame) -> DataFrame:
    return _publish(fact.select(*FACT_COLUMNS), KEY_COLUMNS)


def published_dim(df: DataFrame, key: str) -> DataFrame:
    return _publish(df, [key])


def v_matches_full(fact: DataFrame) -> DataFrame:
    """Full analytics view: the published fact as is."""
    return published_fact(fact)


def v_matches_limited(fact: DataFrame) -> DataFrame:
    """Pseudonymised view: goals as 2-wide ranges, attendance as power-of-ten bands."""
    p = published_fact(fact)
    masked = {
        "home_goals": goal_range(F.col("home_goals")),
        "away_goals": goal_range(F.col("away_goals")),
        "attendance": attendance_band(F.col("attendance")),
    }
    return p.select([masked[c].alias(c) if c in masked else F.col(c) for c in FACT_COLUMNS])
