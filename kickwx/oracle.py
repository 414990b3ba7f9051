"""DuckDB SQL for the parity check of every registered query.

Written from the stated semantics, apart from the Spark plans: the weather
picks are numbered by distance and, on either side of kick-off, by time, home and away statistics are two lookups, and
team perspectives are a lateral pair of rows. Categories come from the tables of fixed values in
``kickwx.functions``. The stand-in recipe is repeated in SQL (see ``kickwx.sources.testdata``); the test tables
are pre-registered views.
"""

from __future__ import annotations

from kickwx.functions import buckets as B
from kickwx.functions.masks import ATTENDANCE_LABELS, ATTENDANCE_TOP
from kickwx.plans.marts import FACT_COLUMNS


def hk(text: str) -> str:
    """Unsigned half-MD5 key of a text expression, as decimal(20,0)."""
    return f"CAST(('0x' || substr(md5({text}), 1, 16))::UBIGINT AS DECIMAL(20,0))"


def s(x: str) -> str:
    return f"CAST({x} AS VARCHAR)"


def tb(x: str) -> str:
    """NULLIF(x,'') -> bigint id, NULL on malformed text."""
    return f"TRY_CAST(NULLIF({x}, '') AS BIGINT)"


def ti(x: str) -> str:
    """NULLIF(x,'') -> int, NULL on malformed text."""
    return f"TRY_CAST(NULLIF({x}, '') AS INTEGER)"


def tid(x: str) -> str:
    """'6.0' -> 6: through double, truncated."""
    return f"TRY_CAST(trunc(TRY_CAST(NULLIF({x}, '') AS DOUBLE)) AS INTEGER)"


def tenths(mult: int, hmult: int, mod: int, shift: int = 0) -> str:
    return f"(CAST((kk*{mult} + h*{hmult}) % {mod} - {shift} AS DOUBLE) / 10.0)"


def eid(k: str) -> str:
    return f"CASE WHEN {k} % 101 = 9 THEN {k} + 3000000000 ELSE {k} END"


LAT = "(CAST(((({v}) * 37) % 180) - 90 AS DOUBLE) + 0.5)"
LON = "(CAST(((({v}) * 53) % 360) - 180 AS DOUBLE) + 0.25)"

# --- stand-in bronze tables -------------------------------------------------

BRONZE = f"""
params AS (
  SELECT (SELECT max(s_suppkey) + 1 FROM supplier) AS ns, (SELECT max(c_custkey) + 1 FROM customer) AS nc
),
fx_src AS (
  SELECT o.*, p.ns, p.nc, v.version,
         o.o_orderdate + to_minutes(CAST(((o.o_orderkey * 7) % 96) * 15 AS INTEGER)) AS kick,
         (o.o_orderkey * 7 + o.o_custkey) % 6 + (v.version - 1) AS hsc,
         CASE WHEN o.o_orderkey % 83 = 7 THEN -1 ELSE (o.o_orderkey * 3 + o.o_custkey * 5) % 5 END AS asc_,
         CASE o.o_orderkey % 6 WHEN 0 THEN 1 WHEN 1 THEN 10 WHEN 2 THEN 100 WHEN 3 THEN 1000
              WHEN 4 THEN 10000 ELSE 100000 END AS pw
  FROM orders o CROSS JOIN params p CROSS JOIN (VALUES (1), (2)) v(version)
  WHERE v.version = 1 OR o.o_orderkey % 7 = 0
),
bronze_fixtures AS (
  SELECT {s('o_orderkey + 1')} AS "Rn", '1' AS "seasonType", {s('o_custkey % 10 + 700')} AS "leagueId",
         {s(eid('o_orderkey'))} AS "eventId", {s('kick')} AS "date", {s('o_orderkey % ns')} AS "venueId",
         CASE WHEN o_orderkey % 10 = 0 THEN '' ELSE {s('CAST(floor(o_totalprice / pw) AS BIGINT)')} END AS attendance,
         {s('CASE WHEN o_orderkey % 97 = 5 THEN o_custkey + 900000000 ELSE o_custkey END')} AS "homeTeamId",
         CASE WHEN o_orderkey % 89 = 3 THEN '' ELSE {s('(o_custkey + 1 + o_orderkey % 7) % nc')} END AS "awayTeamId",
         {s('hsc > asc_')} AS "homeTeamWinner", {s('asc_ > hsc')} AS "awayTeamWinner",
         CASE WHEN o_orderkey % 50 = 0 THEN '' ELSE {s('hsc')} END AS "homeTeamScore",
         {s('asc_')} AS "awayTeamScore",
         CASE WHEN o_orderkey % 20 = 1 THEN {s('o_orderkey % 5 + 1')} ELSE '' END AS "homeTeamShootoutScore",
         CASE WHEN o_orderkey % 20 = 1 THEN {s('(o_orderkey + 2) % 5 + 1')} ELSE '' END AS "awayTeamShootoutScore",
         '28' AS "statusId", {s('kick')} AS "updateTime", CAST(NULL AS VARCHAR) AS "hasWeather",
         CASE WHEN version = 1 THEN TIMESTAMP '2025-10-28 06:00:00' ELSE TIMESTAMP '2025-10-29 06:00:00' END
           AS _ingestion_time
  FROM fx_src
),
bronze_teams AS (
  SELECT {s('c.c_custkey')} AS "teamId",
         CASE WHEN c.c_custkey % 9 = 0 THEN '' ELSE n.n_name END AS location,
         '  ' || c.c_name || ' ' AS name, substr(c.c_name, 1, 3) AS abbreviation,
         c.c_name AS "displayName", c.c_name AS "shortDisplayName", 'ffffff' AS color,
         '000000' AS "alternateColor", CAST(NULL AS VARCHAR) AS "logoURL",
         {s('c.c_custkey % (SELECT ns FROM params)')} AS "venueId", lower(c.c_name) AS slug,
         TIMESTAMP '2025-10-28 06:00:00' AS _ingestion_time
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
),
bronze_venues AS (
  SELECT {s('s.s_suppkey')} AS "venueId",
         CASE WHEN s.s_suppkey % 5 = 1 THEN 'The "' || s.s_name || '" Park, North'
              WHEN s.s_suppkey % 7 = 2 THEN s.s_name || chr(10) || 'Annex' ELSE s.s_name END AS "fullName",
         s.s_name AS "shortName",
         {s('s.s_suppkey * 10 + 1000')} AS capacity,
         CASE WHEN s.s_suppkey % 11 = 0 THEN 'None' ELSE n.n_name END AS city, r.r_name AS country,
         CASE WHEN s.s_suppkey % 4 <> 0 THEN {s(LAT.format(v='s.s_suppkey'))} END AS latitude,
         CASE WHEN s.s_suppkey % 4 <> 0 THEN {s(LON.format(v='s.s_suppkey'))} END AS longitude,
         TIMESTAMP '2025-10-28 06:00:00' AS _ingestion_time
  FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
       LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
),
bronze_teamStats AS (
  SELECT '1' AS "seasonType", {s(eid('l.l_orderkey'))} AS "eventId",
         {s('CASE WHEN l.l_linenumber % 2 = 1 THEN o.o_custkey ELSE (o.o_custkey + 1 + l.l_orderkey % 7) % (SELECT nc FROM params) END')} AS "teamId",
         {s('l.l_linenumber')} AS "teamOrder", {s('round(l.l_discount * 100 + 40, 2)')} AS "possessionPct",
         {s('l.l_quantity')} AS "foulsCommitted", {s('l.l_quantity % 5')} AS "yellowCards",
         {s('l.l_quantity % 2')} AS "redCards", {s('l.l_quantity % 12')} AS "wonCorners",
         TIMESTAMP '2025-10-28 06:00:00' + to_minutes(CAST(l.l_linenumber AS INTEGER)) AS _ingestion_time
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
),
fetches AS (
  SELECT orders.*, ns, version, o_orderkey + 5 * (version - 1) AS kk
  FROM orders CROSS JOIN params CROSS JOIN (VALUES (1), (2)) v(version)
  WHERE (o_orderkey % ns) % 4 <> 0 AND o_orderkey % 13 <> 0 AND (version = 1 OR o_orderkey % 9 = 4)
),
bronze_weather AS (
  SELECT {s(eid('o_orderkey'))} AS "eventId", CAST(o_orderdate AS DATE) AS date,
         o_orderdate + to_hours(CAST(h AS INTEGER)) AS timestamp_utc,
         {LAT.format(v='o_orderkey % ns')} AS latitude, {LON.format(v='o_orderkey % ns')} AS longitude,
         CASE WHEN (kk + h) % 29 = 0 THEN NULL ELSE CAST({tenths(11, 3, 500, 100)} AS FLOAT) END
           AS temperature_2m,
         CAST({tenths(13, 7, 100)} AS FLOAT) AS precipitation,
         CAST({tenths(13, 7, 100)} AS FLOAT) AS rain,
         CAST(CASE WHEN {tenths(11, 3, 500, 100)} < 0 THEN {tenths(13, 7, 100)} ELSE 0.0 END AS FLOAT) AS snowfall,
         CAST({tenths(17, 5, 600)} AS FLOAT) AS wind_speed_10m,
         CASE WHEN version = 1 THEN TIMESTAMP '2025-10-28 06:00:00' ELSE TIMESTAMP '2025-10-29 06:00:00' END
           AS _ingestion_time
  FROM fetches CROSS JOIN range(24) t(h)
),
gazetteer AS (
  SELECT n.n_name || ', ' || r.r_name AS query, CAST(n.n_nationkey * 3 - 40 AS DOUBLE) AS latitude,
         CAST(n.n_nationkey * 7 - 90 AS DOUBLE) AS longitude
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
  UNION ALL
  SELECT r_name, CAST(r_regionkey * 10 - 20 AS DOUBLE), CAST(r_regionkey * 30 - 60 AS DOUBLE) FROM region
)"""

# --- last write per key, staging models, marts -------------------------------


def newest(source: str, keys: list[str], ties: list[str]) -> str:
    """Newest row per key; of one load's rows the smallest in the tie-break columns, NULLs last."""
    key = ", ".join(f'"{k}"' for k in keys)
    order = ", ".join(["_ingestion_time DESC", *(f'"{t}" ASC NULLS LAST' for t in ties)])
    return f"SELECT * FROM {source} QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY {order}) = 1"


KICK = "TRY_CAST(NULLIF(date, '') AS TIMESTAMP)"
_STATS = ["fouls_committed", "yellow_cards", "red_cards", "possession_pct", "corners"]
_STAT_NAMES = {"fouls_committed": "fouls"}


def _side(side: str) -> str:
    alias = side[0]
    return ", ".join(f"{alias}.{c} AS {side}_{_STAT_NAMES.get(c, c)}" for c in _STATS)


MODELS = f"""
fixtures_latest AS ({newest('bronze_fixtures', ['eventId'], [])}),
teams_latest AS ({newest('bronze_teams', ['teamId'], [])}),
venues_latest AS ({newest('bronze_venues', ['venueId'], [])}),
weather_latest AS ({newest('bronze_weather', ['eventId', 'timestamp_utc'], [])}),
stats_latest AS (SELECT DISTINCT "eventId", "teamId" FROM "bronze_teamStats"),
fx AS (
  SELECT {tb('"eventId"')} AS event_id, {KICK} AS match_datetime,
         {tb('"venueId"')} AS venue_id, {tb('"homeTeamId"')} AS home_team_id, {tb('"awayTeamId"')} AS away_team_id,
         {ti('attendance')} AS attendance, {ti('"homeTeamScore"')} AS home_goals,
         {ti('"awayTeamScore"')} AS away_goals, {ti('"homeTeamShootoutScore"')} AS home_shootout_score,
         {ti('"awayTeamShootoutScore"')} AS away_shootout_score
  FROM fixtures_latest
),
dim_date AS (
  SELECT {hk(s('match_datetime') + " || '|' || " + s('venue_id'))} AS date_key,
         CAST(match_datetime AS DATE) AS match_date, strftime(match_datetime, '%H:%M:%S') AS match_time
  FROM fx GROUP BY ALL
),
dim_team AS (
  SELECT {hk('"teamId"')} AS team_key, {tb('"teamId"')} AS team_id,
         NULLIF(trim(name), '') AS team_name, NULLIF(trim(location), '') AS team_location
  FROM teams_latest
),
dim_venue AS (
  SELECT {hk('"venueId"')} AS venue_key, {tb('"venueId"')} AS venue_id,
         NULLIF(trim("fullName", ' '), '') AS venue_name, NULLIF(trim(city), '') AS city,
         NULLIF(trim(country), '') AS country
  FROM venues_latest
),
typed_stats AS (
  SELECT {tb('"eventId"')} AS event_id, {tb('"teamId"')} AS team_id,
         {tid('"foulsCommitted"')} AS fouls_committed, {tid('"yellowCards"')} AS yellow_cards,
         {tid('"redCards"')} AS red_cards,
         TRY_CAST(floor(TRY_CAST(NULLIF("possessionPct", '') AS DECIMAL(20,6)) * 100) / 100 AS DECIMAL(5,2))
           AS possession_pct,
         {tid('"wonCorners"')} AS corners, _ingestion_time
  FROM "bronze_teamStats"
),
raw_stats AS (SELECT * EXCLUDE (_ingestion_time) FROM ({newest('typed_stats', ['event_id', 'team_id'], _STATS)})),
both_sides AS (
  SELECT f.event_id, {_side('home')}, {_side('away')}
  FROM fx f
  LEFT JOIN raw_stats h ON (h.event_id, h.team_id) = (f.event_id, f.home_team_id)
  LEFT JOIN raw_stats a ON (a.event_id, a.team_id) = (f.event_id, f.away_team_id)
),
wobs AS (
  SELECT {tb('"eventId"')} AS event_id, timestamp_utc AS weather_datetime,
         CAST(latitude AS FLOAT) AS latitude, CAST(longitude AS FLOAT) AS longitude, temperature_2m AS temperature,
         precipitation, rain AS rainfall, snowfall, wind_speed_10m AS wind_speed
  FROM weather_latest
),
timed AS (
  SELECT event_id, weather_datetime, match_datetime,
         row_number() OVER (PARTITION BY event_id ORDER BY abs(epoch(weather_datetime) - epoch(match_datetime)), weather_datetime) AS by_distance,
         weather_datetime >= match_datetime AS is_after,
         row_number() OVER (PARTITION BY event_id, weather_datetime >= match_datetime ORDER BY weather_datetime) AS in_part
  FROM wobs JOIN fx USING (event_id) WHERE match_datetime IS NOT NULL
),
picks AS (
  SELECT event_id, match_datetime, weather_datetime FROM timed
  WHERE by_distance = 1 OR (is_after AND in_part = 1)
     OR (is_after AND in_part = 2 AND extract(minute FROM match_datetime) = 0 AND extract(second FROM match_datetime) = 0)
),
kept_weather AS (
  SELECT wobs.*, match_datetime FROM picks JOIN wobs USING (event_id, weather_datetime)
),
stg_dim_weather AS (
  SELECT {hk(s('event_id') + " || '|' || " + s("date_trunc('hour', weather_datetime)"))} AS weather_key,
         event_id, min(latitude) AS latitude, min(longitude) AS longitude,
         date_trunc('hour', weather_datetime) AS timestamp_hour, max(match_datetime) AS match_datetime,
         {", ".join(f"round_even(avg({m}), 3) AS {m}" for m in ["temperature", "precipitation", "rainfall", "snowfall", "wind_speed"])}
  FROM kept_weather GROUP BY event_id, date_trunc('hour', weather_datetime)
),
dim_weather AS (
  SELECT {hk(s('event_id') + " || '|' || " + s("date_trunc('hour', min(match_datetime))"))} AS weather_key,
         event_id, min(latitude) AS latitude, min(longitude) AS longitude,
         min(timestamp_hour) AS first_weather_hour, max(timestamp_hour) AS second_weather_hour,
         {", ".join(f"round_even(avg({m}), 3) AS avg_{m}" for m in ["temperature", "precipitation", "rainfall", "snowfall", "wind_speed"])}
  FROM stg_dim_weather GROUP BY event_id
),
fact_wide AS (
  SELECT {hk(s('fx.event_id'))} AS match_id, {hk(s('match_datetime') + " || '|' || " + s('venue_id'))} AS date_key,
         (SELECT venue_key FROM dim_venue d WHERE d.venue_id = fx.venue_id) AS venue_key,
         (SELECT weather_key FROM dim_weather d WHERE d.event_id = fx.event_id) AS weather_key,
         (SELECT team_key FROM dim_team d WHERE d.team_id = fx.home_team_id) AS home_team_key,
         (SELECT team_key FROM dim_team d WHERE d.team_id = fx.away_team_id) AS away_team_key,
         both_sides.* EXCLUDE (event_id), home_goals, away_goals, home_shootout_score, away_shootout_score, attendance,
         fx.event_id, venue_id, home_team_id, away_team_id
  FROM fx JOIN both_sides USING (event_id)
),
fact_match AS (SELECT * EXCLUDE (event_id, venue_id, home_team_id, away_team_id) FROM fact_wide),
weathered AS (
  SELECT f.*, w.avg_precipitation AS precip, w.avg_temperature AS temp, w.avg_wind_speed AS wind
  FROM fact_wide f JOIN dim_weather w ON w.weather_key = f.weather_key
),
sides AS (
  SELECT match_id, weather_key, temp, precip, date_key, p.*
  FROM weathered, LATERAL (VALUES
    (home_team_key, home_team_id, away_team_id, home_goals, away_goals, home_team_id = away_team_id),
    (away_team_key, away_team_id, home_team_id, away_goals, home_goals, false)
  ) p(team_key, team_id, opponent_id, goals_for, goals_against, mirrored)
)"""


def _case(value: str, table: list[tuple[float, str]], rest: str) -> str:
    """Category of a value from a table of lower bounds (see ``kickwx.functions.buckets``)."""
    return "CASE " + " ".join(f"WHEN {value} >= {bound} THEN '{label}'" for bound, label in table) + f" ELSE '{rest}' END"


RAIN = _case("precip", B.RAIN, B.RAIN_DRY)
WIND = _case("wind", B.WIND, B.WIND_LIGHT)
# cold below its bound: read from the top, so a NULL is normal like any other value between
TEMP = (f"CASE WHEN temp >= {B.TEMP_HOT_FROM} THEN '{B.TEMP_HOT}' WHEN temp >= {B.TEMP_COLD_BELOW} OR temp IS NULL "
        f"THEN '{B.TEMP_NORMAL}' ELSE '{B.TEMP_COLD}' END")


def _band(value: str) -> str:
    steps = " ".join(f"WHEN {value} < {bound} THEN '{label}'" for bound, label in ATTENDANCE_LABELS)
    return f"CASE WHEN {value} IS NOT NULL THEN CASE {steps} ELSE '{ATTENDANCE_TOP}' END END"


def _goal_range(value: str) -> str:
    return f"CAST({value} // 2 * 2 AS VARCHAR) || '-' || CAST({value} // 2 * 2 + 1 AS VARCHAR)"


def with_models(select: str) -> str:
    return f"WITH {BRONZE.strip()},\n{MODELS.strip()}\n{select.strip()}"


def _variability(category: str, name: str, source: str = "weathered") -> str:
    return f"""
SELECT {category} AS {name}, count(match_id) AS total_matches,
       round(avg(abs(home_goals - away_goals)), 6) AS avg_goal_difference,
       round(stddev_samp(home_goals - away_goals), 6) AS stddev_goal_difference
FROM {source} GROUP BY ALL"""


def _home_win(category: str, name: str) -> str:
    share = "round_even(100.0::DOUBLE * count(*) FILTER ({}) / count(match_id), 2)"
    return f"""
SELECT {category} AS {name}, count(match_id) AS total_matches,
       {share.format('home_goals > away_goals')} AS home_win_percentage,
       {share.format('home_goals < away_goals')} AS home_loss_percentage
FROM weathered GROUP BY ALL"""


def _extreme(direction: str) -> str:
    # a match of the team against itself counts once
    return f"""
SELECT match_id AS "MatchID", temp AS temperature, goals_for AS "GoalsFor", goals_against AS "GoalsAgainst"
FROM sides WHERE team_id = 100 QUALIFY row_number() OVER (PARTITION BY match_id ORDER BY mirrored DESC) = 1
ORDER BY temp {direction} NULLS LAST, match_id LIMIT 5"""


QUERIES: dict[str, str] = {
    "attendance_rain": f"""
SELECT venue_name, city, {RAIN} AS rain_category, count(match_id) AS total_matches,
       round_even(avg(attendance), 0) AS average_attendance
FROM (SELECT * FROM weathered WHERE attendance > 0) JOIN dim_venue USING (venue_key) GROUP BY ALL""",
    "fouls_rain": f"""
SELECT {RAIN} AS rain_category, count(match_id) AS total_matches,
       round(avg(home_fouls + away_fouls), 6) AS average_total_fouls,
       round(avg(home_fouls), 6) AS average_home_fouls, round(avg(away_fouls), 6) AS average_away_fouls
FROM weathered WHERE home_fouls + away_fouls IS NOT NULL GROUP BY ALL""",
    "home_win_rain": _home_win(RAIN, "rain_category"),
    "bq1_temp": _home_win(TEMP, "temperature_category"),
    "bq1_wind": _home_win(WIND, "wind_category"),
    "variability_rain": _variability(RAIN, "rain_category"),
    "variability_temp": _variability(TEMP, "temperature_category"),
    "variability_wind": _variability(WIND, "wind_category"),
    "bq2_by_country": _variability(
        RAIN, "rain_category", "weathered SEMI JOIN (FROM dim_venue WHERE country = 'EUROPE') v USING (venue_key)"),
    "penalty_weather": f"""
SELECT if(coalesce(precip > {B.SHOOTOUT_RAIN_ABOVE}, false) OR coalesce(temp < {B.SHOOTOUT_COLD_BELOW}, false)
          OR coalesce(temp >= {B.SHOOTOUT_HOT_FROM}, false), '{B.SHOOTOUT_EXTREME}', '{B.SHOOTOUT_NORMAL}') AS weather_category,
       count(match_id) AS total_shootouts,
       round_even(avg(home_shootout_score + away_shootout_score), 2) AS average_shootout_goals_per_match
FROM weathered WHERE greatest(home_shootout_score, away_shootout_score) > 0 GROUP BY ALL""",
    "team_resilience": f"""
SELECT team_name, {TEMP} AS weather_temp_category, count(*) AS total_games_played,
       round(100.0::DOUBLE * count(*) FILTER (goals_for > goals_against) / count(*), 6) AS win_percentage
FROM sides JOIN dim_team USING (team_key) GROUP BY ALL""",
    "unpivot_home_away": f"""
SELECT team_key, {TEMP} AS weather_temp_category, coalesce(CAST(goals_for > goals_against AS INTEGER), 0) AS is_win
FROM sides""",
    "role_full_top20": "SELECT match_id, home_goals, away_goals, attendance FROM fact_match ORDER BY match_id LIMIT 20",
    "role_limited_top20": f"""
SELECT match_id, {_goal_range('home_goals')} AS home_goals, {_goal_range('away_goals')} AS away_goals,
       {_band('attendance')} AS attendance
FROM fact_match ORDER BY match_id LIMIT 20""",
    "rain_and_venue": """
SELECT venue_name AS "VenueName", city AS "City", count(match_id) AS "TotalMatches",
       round(avg(home_fouls + away_fouls) FILTER (precip > 2), 6) AS "AvgFouls_Rainy",
       round(avg(home_fouls + away_fouls) FILTER (precip <= 2), 6) AS "AvgFouls_Otherwise"
FROM weathered JOIN dim_venue USING (venue_id) GROUP BY ALL""",
    "matches_temperature": """
SELECT match_id AS "MatchID", match_date AS "Date", temp AS "Temperature", one.team_name AS "Team1_Name",
       two.team_name AS "Team2_Name", goals_for AS "Team1_Goals", goals_against AS "Team2_Goals",
       goals_for - goals_against AS "GoalDifference_Team1"
FROM sides JOIN dim_date USING (date_key)
JOIN dim_team one ON one.team_id = sides.team_id JOIN dim_team two ON two.team_id = opponent_id
WHERE (sides.team_id, opponent_id) = (1, 2)""",
    "team_hottest5": _extreme("DESC"),
    "team_coldest5": _extreme("ASC"),
    "team_precipitation": """
SELECT match_id AS "MatchID", match_date AS "Date", one.team_id AS "TeamID", one.team_name AS "TeamName",
       two.team_id AS "OpponentID", two.team_name AS "OpponentName", goals_for AS "TeamGoals",
       goals_against AS "OpponentGoals", goals_for - goals_against AS "GoalDifference", precip AS "Precipitation"
FROM (FROM sides QUALIFY row_number() OVER (PARTITION BY match_id, team_id ORDER BY mirrored DESC) = 1) s
JOIN dim_date USING (date_key)
JOIN dim_team one ON one.team_id = s.team_id JOIN dim_team two ON two.team_id = opponent_id""",
    # marts and models as published tables
    "stg_fixtures": "SELECT * FROM fx",
    "dim_date": "SELECT * FROM dim_date",
    "dim_team": "SELECT * FROM dim_team",
    "dim_venue": "SELECT * FROM dim_venue",
    "stg_dim_weather": "SELECT * FROM stg_dim_weather",
    "dim_weather": "SELECT * FROM dim_weather",
    "fact_match": "SELECT * FROM fact_match",
    "v_matches_full": "SELECT * FROM fact_match",
    "v_matches_limited": f"""
SELECT * REPLACE ({_goal_range('home_goals')} AS home_goals, {_goal_range('away_goals')} AS away_goals,
                  {_band('attendance')} AS attendance) FROM fact_match""",
    "team_stats_agg": "SELECT * FROM both_sides",
    "stg_team_stats": "SELECT * FROM raw_stats",
    "weather_nearest": "SELECT event_id, weather_datetime, match_datetime FROM kept_weather",
    "asof_grid": "SELECT event_id, weather_datetime, match_datetime FROM kept_weather",
    "weather_ranks": "SELECT event_id, weather_datetime, match_datetime FROM kept_weather",
    "weather_aggregate": "SELECT event_id, weather_datetime, match_datetime FROM kept_weather",
    "weather_topk": "SELECT event_id, weather_datetime, match_datetime FROM kept_weather",
}


def oracle_queries() -> dict[str, str]:
    return {k: with_models(v) for k, v in QUERIES.items()}


# --- ingest, work lists, enrichment, upsert, quality ---------------------------

_NA = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
       "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]
_NA_SQL = ", ".join("'" + t.replace("'", "''") + "'" for t in _NA)
_VENUE_COLS = ["venueId", "fullName", "shortName", "capacity", "city", "country", "latitude", "longitude"]
_FIXTURE_COLS = ["Rn", "seasonType", "leagueId", "eventId", "date", "venueId", "attendance", "homeTeamId",
                 "awayTeamId", "homeTeamWinner", "awayTeamWinner", "homeTeamScore", "awayTeamScore",
                 "homeTeamShootoutScore", "awayTeamShootoutScore", "statusId", "updateTime"]


def _part(x: str) -> str:
    return f"CASE WHEN lower({x}) <> 'none' THEN NULLIF(regexp_replace({x}, '^\\s+|\\s+$', '', 'g'), '') END"


_QTEXT = f"concat_ws(', ', {_part('city')}, {_part('country')})"

QUERIES.update({
    "latest_by_key": "SELECT * FROM fixtures_latest",
    "surrogate_keys": f"""
SELECT event_id, {hk(s('event_id'))} AS match_id,
       {hk(s('match_datetime') + " || '|' || " + s('venue_id'))} AS date_key
FROM fx""",
    "weather_hourly_unnest": "SELECT * FROM bronze_weather",
    "bronze_null_normalize": "SELECT " + ", ".join(
        f'CASE WHEN "{c}" IN ({_NA_SQL}) THEN NULL ELSE "{c}" END AS "{c}"' for c in _VENUE_COLS
    ) + ", _ingestion_time FROM bronze_venues",
    "bronze_stringify": "SELECT " + ", ".join(f'"{c}"' for c in _FIXTURE_COLS)
    + ", CAST(NULL AS VARCHAR) AS \"hasWeather\", TIMESTAMP '2025-10-29 06:00:00' AS _ingestion_time"
    + " FROM fixtures_latest",
    "bronze_row_counts": """
SELECT 'fixtures' AS table_name, count(*) AS row_count FROM fixtures_latest
UNION ALL SELECT 'teams', count(*) FROM teams_latest
UNION ALL SELECT 'venues', count(*) FROM venues_latest
UNION ALL SELECT 'teamStats', count(*) FROM stats_latest
UNION ALL SELECT 'weather', count(*) FROM weather_latest""",
    "scan_parquet": "SELECT * FROM orders",
    "geocode_query_text": f'SELECT "venueId", {_QTEXT} AS query FROM venues_latest',
    "pending_geocode": """
SELECT v."venueId", v."fullName", v.city, v.country
FROM venues_latest v JOIN fixtures_latest f ON v."venueId" = f."venueId"
WHERE v.latitude IS NULL
GROUP BY v."venueId", v."fullName", v.city, v.country
ORDER BY count(*) DESC, v."venueId" LIMIT 200""",
    "venue_coord_enrich": f"""
SELECT v.* REPLACE (coalesce(v.latitude, CAST(g.latitude AS VARCHAR)) AS latitude,
                    coalesce(v.longitude, CAST(g.longitude AS VARCHAR)) AS longitude)
FROM venues_latest v LEFT JOIN gazetteer g ON v.latitude IS NULL AND {_QTEXT.replace('city', 'v.city').replace('country', 'v.country')} = g.query""",
    "pending_weather": """
SELECT f."eventId", f.date, v.latitude, v.longitude
FROM fixtures_latest f JOIN venues_latest v ON f."venueId" = v."venueId"
WHERE v.latitude IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM bronze_weather w WHERE w."eventId" = f."eventId")
ORDER BY f.date, f."eventId" LIMIT 500""",
    "mark_has_weather": """
SELECT f.* REPLACE (CASE WHEN EXISTS (SELECT 1 FROM bronze_weather w WHERE w."eventId" = f."eventId")
                         THEN '1' ELSE f."hasWeather" END AS "hasWeather")
FROM fixtures_latest f""",
    "incremental_upsert": "SELECT * FROM fact_match",
    "marts_refresh": "SELECT * FROM fact_match",
    "weather_latest": "SELECT * FROM weather_latest",
    "weather_stream_latest": "SELECT * FROM weather_latest",
    "csv_ingest": "SELECT " + ", ".join(
        f'CASE WHEN "{c}" NOT IN ({_NA_SQL}) THEN "{c}" END AS "{c}"' for c in _VENUE_COLS
    ) + ", _ingestion_time FROM bronze_venues",
    "bronze_append": "SELECT * FROM bronze_fixtures",
    "csv_export": "SELECT " + ", ".join(
        f'CASE WHEN "{c}" NOT IN ({_NA_SQL}) THEN "{c}" END AS "{c}"' for c in _VENUE_COLS
    ) + " FROM bronze_venues",
    "drop_ingest": " UNION ALL ".join(
        f"""SELECT '{t}' AS table_name, count(*) AS row_count FROM "bronze_{t}\""""
        for t in ["fixtures", "teams", "venues", "teamStats"]),
    "lake_table": "SELECT * FROM bronze_venues",
    "sql_views": """
SELECT team_name, count(*) AS home_matches, CAST(sum(home_goals) AS BIGINT) AS home_goals
FROM fact_match JOIN dim_team ON home_team_key = team_key GROUP BY team_name""",
    "marts_tables": "SELECT * FROM fact_match",
    "dq_unique": f"""
FROM (SELECT 'fact_match.match_id' AS "check", match_id AS key_value FROM fact_match
      UNION ALL SELECT 'dim_date.date_key', date_key FROM dim_date
      UNION ALL SELECT 'bronze_fixtures.event_id', CAST({tb('"eventId"')} AS DECIMAL(20,0)) FROM bronze_fixtures)
SELECT "check", key_value, count(*) AS n_rows WHERE key_value IS NOT NULL GROUP BY ALL HAVING count(*) > 1""",
    "dq_not_null": """
SELECT count(*) - count(match_id) AS match_id, count(*) - count(home_team_key) AS home_team_key,
       count(*) - count(away_team_key) AS away_team_key
FROM fact_match""",
    "dq_relationships": """
SELECT "check", event_id
FROM (UNPIVOT (SELECT event_id, home_team_id, away_team_id FROM fx) ON home_team_id, away_team_id
      INTO NAME "check" VALUE team_id)
ANTI JOIN dim_team USING (team_id)""",
    "dq_non_negative": "SELECT * FROM fact_match WHERE away_goals < 0",
    "dq_summary": f"""
, orphans AS (
  SELECT home_team_id NOT IN (SELECT team_id FROM dim_team) AS home, away_team_id NOT IN (SELECT team_id FROM dim_team) AS away
  FROM fx),
one AS (
  SELECT (SELECT count(match_id) - count(DISTINCT match_id) FROM fact_match) AS unique_match_id,
         (SELECT count(date_key) - count(DISTINCT date_key) FROM dim_date) AS unique_date_key,
         (SELECT count(*) FILTER (match_id IS NULL) FROM fact_match) AS not_null_match_id,
         (SELECT count(*) FILTER (home_team_key IS NULL) FROM fact_match) AS not_null_home_team_key,
         (SELECT count(*) FILTER (away_team_key IS NULL) FROM fact_match) AS not_null_away_team_key,
         (SELECT count(*) FILTER (home) FROM orphans) AS relationships_home_team_id,
         (SELECT count(*) FILTER (away) FROM orphans) AS relationships_away_team_id,
         (SELECT count(*) FILTER (away_goals < 0) FROM fact_match) AS non_negative_away_goals,
         (SELECT count(*) FILTER ({tb('"eventId"')} IS NULL) FROM bronze_fixtures) AS untypable_event_id)
SELECT "check", failing_rows FROM (UNPIVOT one ON COLUMNS(*) INTO NAME "check" VALUE failing_rows)""",
    "dq_profile": " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(*) AS row_count, count(*) - count({c}) AS null_count,
        CAST(min({c}) AS VARCHAR) AS min_value, CAST(max({c}) AS VARCHAR) AS max_value FROM fact_match"""
        for c in FACT_COLUMNS),
})
