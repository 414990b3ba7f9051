"""Staging models: typed, cleaned views over the (deduplicated) bronze tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kickwx.functions.casts import (
    start_of_hour,
    to_decimal_5_2_trunc,
    to_id,
    to_int,
    to_int_via_double,
    to_timestamp_ntz,
    trimmed_or_null,
)
from kickwx.functions.keys import hash_key
from kickwx.operators.asof import (
    DEFAULT_WEATHER_METHOD,
    irregular_matches,
    may_be_among,
    select_grid,
    select_kickoff_weather,
    select_window,
    union_of_picks,
)
from kickwx.operators.dedup import latest_by_key
from kickwx.sources.schemas import BRONZE_KEYS, INGESTION_TIME


@dataclass
class Bronze:
    """Raw bronze tables as appended (several versions per key possible)."""

    fixtures: DataFrame
    teams: DataFrame
    venues: DataFrame
    team_stats: DataFrame
    weather: DataFrame

    def latest(self) -> "Bronze":
        """Last write per key on every table (the reference's FINAL read)."""
        return Bronze(
            fixtures=latest_by_key(self.fixtures, BRONZE_KEYS["fixtures"]),
            teams=latest_by_key(self.teams, BRONZE_KEYS["teams"]),
            venues=latest_by_key(self.venues, BRONZE_KEYS["venues"]),
            team_stats=latest_by_key(self.team_stats, BRONZE_KEYS["teamStats"]),
            weather=latest_by_key(self.weather, BRONZE_KEYS["weather"]),
        )


def _version(df: DataFrame) -> list[str]:
    return [INGESTION_TIME] if INGESTION_TIME in df.columns else []


def typed_fixtures(fixtures: DataFrame) -> DataFrame:
    """Typed fixtures, with their load time; rows without a usable event id are dropped."""
    return fixtures.select(
        to_id("eventId").alias("event_id"),
        to_timestamp_ntz("date").alias("match_datetime"),
        to_id("venueId").alias("venue_id"),
        to_id("homeTeamId").alias("home_team_id"),
        to_id("awayTeamId").alias("away_team_id"),
        to_int("attendance").alias("attendance"),
        to_int("homeTeamScore").alias("home_goals"),
        to_int("awayTeamScore").alias("away_goals"),
        to_int("homeTeamShootoutScore").alias("home_shootout_score"),
        to_int("awayTeamShootoutScore").alias("away_shootout_score"),
        *_version(fixtures),
    ).filter(F.col("event_id").isNotNull())


def stg_fixtures(fixtures: DataFrame) -> DataFrame:
    """Newest typed version of every fixture: cast first, so that one exchange on the typed id serves the
    version choice and every later join and aggregation of a match."""
    return latest_by_key(typed_fixtures(fixtures), ["event_id"]).drop(INGESTION_TIME)


def unusable_ids(bronze: DataFrame, column: str) -> DataFrame:
    """Bronze rows whose id is not a number (they can't enter the models)."""
    return bronze.filter(to_id(column).isNull())


def date_key(match_datetime, venue_id):
    """Key of a (kick-off, venue) pair; one function for the dimension and the fact."""
    return hash_key(match_datetime, venue_id)


def stg_dim_date(fixtures: DataFrame) -> DataFrame:
    """Distinct (kick-off, venue) pairs of the typed fixtures."""
    ts, venue = F.col("match_datetime"), F.col("venue_id")
    return fixtures.select(
        date_key(ts, venue).alias("date_key"),
        ts.cast("date").alias("match_date"),
        # 'HH:mm:ss' of the text form: no time-zone conversion of the wall clock
        F.substring(ts.cast("string"), 12, 8).alias("match_time"),
    ).distinct()


def stg_dim_team(teams: DataFrame) -> DataFrame:
    return teams.select(
        hash_key(F.col("teamId")).alias("team_key"),
        to_id("teamId").alias("team_id"),
        trimmed_or_null("name").alias("team_name"),
        trimmed_or_null("location").alias("team_location"),
    )


def stg_dim_venue(venues: DataFrame) -> DataFrame:
    return venues.select(
        hash_key(F.col("venueId")).alias("venue_key"),
        to_id("venueId").alias("venue_id"),
        trimmed_or_null("fullName").alias("venue_name"),
        trimmed_or_null("city").alias("city"),
        trimmed_or_null("country").alias("country"),
    )


def stg_team_stats(team_stats: DataFrame) -> DataFrame:
    """Newest per (event, team) statistics; counts arrive as '6.0'-style text. Rows without usable ids are dropped."""
    typed = team_stats.select(
        to_id("eventId").alias("event_id"),
        to_id("teamId").alias("team_id"),
        to_int_via_double("foulsCommitted").alias("fouls_committed"),
        to_int_via_double("yellowCards").alias("yellow_cards"),
        to_int_via_double("redCards").alias("red_cards"),
        to_decimal_5_2_trunc("possessionPct").alias("possession_pct"),
        to_int_via_double("wonCorners").alias("corners"),
        *_version(team_stats),
    ).filter(F.col("event_id").isNotNull() & F.col("team_id").isNotNull())
    return latest_by_key(typed, ["event_id", "team_id"]).drop(INGESTION_TIME)


# statistic -> its name in the home_/away_ columns
STATS = {
    "fouls_committed": "fouls", "yellow_cards": "yellow_cards", "red_cards": "red_cards",
    "possession_pct": "possession_pct", "corners": "corners",
}


def side_pivot() -> list:
    """Home and away statistics side by side: conditional MAX over rows of fixture x team."""
    return [
        F.max(F.when(F.col("team_id") == F.col(f"{side}_team_id"), F.col(c))).alias(f"{side}_{name}")
        for side in ("home", "away") for c, name in STATS.items()
    ]


def team_stats_agg(fixtures: DataFrame, stats: DataFrame) -> DataFrame:
    """Home and away statistics, one row per event that has any."""
    f = fixtures.select("event_id", "home_team_id", "away_team_id")
    return stats.join(f.hint("merge"), "event_id", "inner").groupBy("event_id").agg(*side_pivot())


# writes a frame under a name and rereads it, or leaves it in the plan
Step = Callable[[DataFrame, str], DataFrame]


def lazily(df: DataFrame, name: str) -> DataFrame:
    return df


def weather_observations(weather: DataFrame) -> DataFrame:
    """Typed hourly observations (one match's rows are keyed by its event id), with their load time."""
    return weather.select(
        to_id("eventId").alias("event_id"),
        F.col("timestamp_utc").cast("timestamp_ntz").alias("weather_datetime"),
        F.col("latitude").cast("float").alias("latitude"),
        F.col("longitude").cast("float").alias("longitude"),
        F.col("temperature_2m").cast("float").alias("temperature"),
        F.col("precipitation").cast("float").alias("precipitation"),
        F.col("rain").cast("float").alias("rainfall"),
        F.col("snowfall").cast("float").alias("snowfall"),
        F.col("wind_speed_10m").cast("float").alias("wind_speed"),
        *_version(weather),
    ).filter(F.col("event_id").isNotNull())


def latest_observations(weather: DataFrame) -> DataFrame:
    """The observation loaded last for every (match, time), dealt out by match.

    Cast and exchanged on the match before the version choice: its exchange is the only one of the weather rows, and no task sorts
    (and spills) its share of them before it is exchanged.
    """
    typed = weather_observations(weather).repartition("event_id")
    return latest_by_key(typed, ["event_id", "weather_datetime"]).drop(INGESTION_TIME)


def kickoff_weather(weather: DataFrame, kickoffs: DataFrame, method: str, step: Step = lazily) -> DataFrame:
    """The newest versions of the observations kept around each kick-off, from bronze rows of any version.

    ``guarded``: the grid's equi-join for the matches that have just the full hours of their date, the window for all others. Which these are
    is told by one row per match; a bitmap of 4 KB of them filters the scan of the second path, so that the weather
    is exchanged once, and only the rows of irregular matches a second time. The grid looks at a row's match and time alone, as the version
    choice does, so it comes first: only the few rows that it keeps are sorted. The irregular matches, asked for
    three times, and the picks of either path are each a ``step``: few rows a match, and no plan holds more than one of them.
    """
    if method != "guarded":
        return select_kickoff_weather(latest_observations(weather), kickoffs, method=method)
    typed = weather_observations(weather)
    odd = step(irregular_matches(typed, kickoffs), "irregular-matches")
    version = lambda df: latest_by_key(df, ["event_id", "weather_datetime"]).drop(INGESTION_TIME)
    picked = select_grid(typed.repartition("event_id"), kickoffs.join(odd.hint("merge"), "event_id", "left_anti"))
    grid = latest_by_key(picked, ["event_id", "weather_datetime", "match_datetime"]).drop(INGESTION_TIME)
    rest = typed.filter(may_be_among(odd)).repartition("event_id").join(odd.hint("merge"), "event_id", "left_semi")
    return union_of_picks(step(grid, "grid-picks"), step(select_window(version(rest), kickoffs), "window-picks"))


WEATHER_MEASURES = ["temperature", "precipitation", "rainfall", "snowfall", "wind_speed"]


def stg_dim_weather(
    weather: DataFrame, fixtures: DataFrame, method: str = DEFAULT_WEATHER_METHOD, step: Step = lazily,
) -> DataFrame:
    """Kept observations around kick-off, averaged per (match, hour) and rounded half-even to 3 places.

    ``weather`` are bronze rows of any version, ``fixtures`` the typed fixtures; ``step`` as in :func:`kickoff_weather`.
    """
    kick = fixtures.select("event_id", "match_datetime")
    kept = kickoff_weather(weather, kick, method, step)
    hour = start_of_hour(F.col("weather_datetime"))
    return (
        kept.groupBy("event_id", hour.alias("timestamp_hour"))
        .agg(
            F.min("latitude").alias("latitude"),
            F.min("longitude").alias("longitude"),
            F.max("match_datetime").alias("match_datetime"),
            *[F.bround(F.avg(m), 3).alias(m) for m in WEATHER_MEASURES],
        )
        .select(
            hash_key(F.col("event_id"), F.col("timestamp_hour")).alias("weather_key"),
            "event_id", "latitude", "longitude", "timestamp_hour", "match_datetime", *WEATHER_MEASURES,
        )
    )
