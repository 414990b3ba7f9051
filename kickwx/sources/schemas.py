"""Bronze table schemas: every source field is nullable text, the key is non-null.

Fixed values: column names and order of the source files (the football data
drop and the weather API rows), as the reference declares them.
"""

from __future__ import annotations

from pyspark.sql import types as T

INGESTION_TIME = "_ingestion_time"

FIXTURES_COLUMNS = [
    "Rn", "seasonType", "leagueId", "eventId", "date", "venueId", "attendance",
    "homeTeamId", "awayTeamId", "homeTeamWinner", "awayTeamWinner",
    "homeTeamScore", "awayTeamScore", "homeTeamShootoutScore",
    "awayTeamShootoutScore", "statusId", "updateTime", "hasWeather",
]

TEAMS_COLUMNS = [
    "teamId", "location", "name", "abbreviation", "displayName",
    "shortDisplayName", "color", "alternateColor", "logoURL", "venueId", "slug",
]

VENUES_COLUMNS = [
    "venueId", "fullName", "shortName", "capacity", "city", "country",
    "latitude", "longitude",
]

TEAM_STATS_COLUMNS = [
    "seasonType", "eventId", "teamId", "teamOrder", "possessionPct",
    "foulsCommitted", "yellowCards", "redCards", "offsides", "wonCorners",
    "saves", "totalShots", "shotsOnTarget", "shotPct", "penaltyKickGoals",
    "penaltyKickShots", "accuratePasses", "totalPasses", "passPct",
    "accurateCrosses", "totalCrosses", "crossPct", "totalLongBalls",
    "accurateLongBalls", "longballPct", "blockedShots", "effectiveTackles",
    "totalTackles", "tacklePct", "interceptions", "effectiveClearance",
    "totalClearance", "updateTime",
]

# Keys of the last-write-wins tables.
BRONZE_KEYS = {
    "fixtures": ["eventId"],
    "teams": ["teamId"],
    "venues": ["venueId"],
    "teamStats": ["eventId", "teamId"],
    "weather": ["eventId", "timestamp_utc"],
}

BRONZE_COLUMNS = {
    "fixtures": FIXTURES_COLUMNS,
    "teams": TEAMS_COLUMNS,
    "venues": VENUES_COLUMNS,
    "teamStats": TEAM_STATS_COLUMNS,
}

# File of each table in a data drop. leagues.csv and keyEventDescription.csv
# are kept by the download but never loaded.
DROP_FILES = {
    "fixtures": "fixtures.csv",
    "teams": "teams.csv",
    "venues": "venues.csv",
    "teamStats": "teamStats.csv",
}


def bronze_schema(table: str) -> T.StructType:
    """Declared schema of a bronze table: typed for weather, text for the tables of a drop."""
    if table == "weather":
        return WEATHER_SCHEMA
    keys = set(BRONZE_KEYS[table])
    fields = [T.StructField(c, T.StringType(), c not in keys) for c in BRONZE_COLUMNS[table]]
    fields.append(T.StructField(INGESTION_TIME, T.TimestampNTZType(), False))
    return T.StructType(fields)


WEATHER_SCHEMA = T.StructType([
    T.StructField("eventId", T.StringType(), False),
    T.StructField("date", T.DateType(), True),
    T.StructField("timestamp_utc", T.TimestampNTZType(), False),
    T.StructField("latitude", T.DoubleType(), True),
    T.StructField("longitude", T.DoubleType(), True),
    T.StructField("temperature_2m", T.FloatType(), True),
    T.StructField("precipitation", T.FloatType(), True),
    T.StructField("rain", T.FloatType(), True),
    T.StructField("snowfall", T.FloatType(), True),
    T.StructField("wind_speed_10m", T.FloatType(), True),
    T.StructField(INGESTION_TIME, T.TimestampNTZType(), False),
])

# Hourly variables requested from the weather API, in payload order.
WEATHER_VARIABLES = ["temperature_2m", "precipitation", "rain", "snowfall", "wind_speed_10m"]

# Landed API payload: one row per (event, date) with per-variable arrays.
PAYLOAD_SCHEMA = T.StructType(
    [
        T.StructField("eventId", T.StringType(), False),
        T.StructField("date", T.DateType(), True),
        T.StructField("latitude", T.DoubleType(), True),
        T.StructField("longitude", T.DoubleType(), True),
        T.StructField("start_ts", T.TimestampNTZType(), True),
        T.StructField("end_ts", T.TimestampNTZType(), True),
        T.StructField("interval_s", T.IntegerType(), True),
    ]
    + [T.StructField(v, T.ArrayType(T.FloatType()), True) for v in WEATHER_VARIABLES]
)
