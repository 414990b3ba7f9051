"""Stand-in bronze inputs derived from the driver's TPC-H-style test tables.

The test data has no football tables, so each bronze table is given rows in
the bronze layout by plain arithmetic over ``orders``, ``lineitem``,
``customer``, ``supplier``, ``nation`` and ``region``. This module only makes
input rows; all pipeline work (dedup, casts, weather selection, keys, joins,
aggregation) happens in the library on whatever rows it is handed. The same
recipe is written in DuckDB SQL in ``kickwx.oracle`` for the parity check.

Recipe (k = o_orderkey, NS = max(s_suppkey)+1, NC = max(c_custkey)+1):
  event id   k, or k + 3,000,000,000 (beyond 32 bits) for k mod 101 = 9
  fixtures   one row per order, kick-off = order date + ((7k) mod 96) * 15 min;
             a second, newer version (loaded a day later, home score + 1) for k mod 7 = 0;
             faulty rows: unknown home team (k mod 97 = 5), no away team (k mod 89 = 3),
             away score -1 (k mod 83 = 7)
  teamStats  every lineitem row: odd lines are the home team's, even lines the away team's,
             each loaded l_linenumber minutes after the first load (so teams have several versions)
  teams      customers (padded names, some empty locations)
  venues     suppliers with nation and region (some without coordinates, some names with
             quotes, commas or line breaks)
  payload    one API payload (24 hourly readings) per order whose venue has
             coordinates, except k mod 13 = 0 (not fetched yet: the pending work list needs some);
             fetched again a day later with other readings for k mod 9 = 4
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kickwx.sources.bronze import unnest_hourly
from kickwx.sources.schemas import INGESTION_TIME

# Fixed load times of the two stand-in loads.
FIRST_LOAD = "2025-10-28 06:00:00"
SECOND_LOAD = "2025-10-29 06:00:00"

VERSION = "__version"


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _max_plus_one(df: DataFrame, col: str) -> Column:
    """A scalar parameter of the recipe (table cardinality), read once: as a scalar subquery, every mention of it would be planned anew."""
    top = df.agg((F.max(col) + 1).alias("n"))
    return F.lit(top.first()["n"]).cast(top.schema["n"].dataType)


def _versioned(df: DataFrame, again: Column) -> DataFrame:
    """Every row as version 1, and as version 2 too where ``again`` holds: one scan for both loads."""
    return df.withColumn(VERSION, F.explode(F.when(again, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))))


def _load_time() -> Column:
    """The load that brought a row's version."""
    return F.when(F.col(VERSION) == 1, F.lit(FIRST_LOAD)).otherwise(F.lit(SECOND_LOAD)).cast("timestamp_ntz")


def event_id(k: Column) -> Column:
    return F.when(k % 101 == 9, k + 3_000_000_000).otherwise(k)


def _s(x: Column) -> Column:
    return x.cast("string")


def venue_latitude(venue_id: Column) -> Column:
    return (((venue_id * 37) % 180) - 90).cast("double") + F.lit(0.5)


def venue_longitude(venue_id: Column) -> Column:
    return (((venue_id * 53) % 360) - 180).cast("double") + F.lit(0.25)


def venue_has_coordinates(venue_id: Column) -> Column:
    return venue_id % 4 != 0


@dataclass
class StandIn:
    fixtures: DataFrame
    teams: DataFrame
    venues: DataFrame
    team_stats: DataFrame
    payload: DataFrame
    nation: DataFrame
    region: DataFrame

    @property
    def weather(self) -> DataFrame:
        """Typed hourly weather rows, produced by the library's payload unnest."""
        return unnest_hourly(self.payload)

    @property
    def weather_by_event(self) -> DataFrame:
        """The same rows, dealt out by event as payloads: a version choice per (event, hour) then needs no exchange of the
        24 rows of each, nor a sort of them before one."""
        return unnest_hourly(self.payload.repartition("eventId"))


def stand_in(spark: SparkSession, sf_dir: str) -> StandIn:
    orders = _t(spark, sf_dir, "orders")
    customer = _t(spark, sf_dir, "customer")
    supplier = _t(spark, sf_dir, "supplier")
    nation = _t(spark, sf_dir, "nation")
    region = _t(spark, sf_dir, "region")
    lineitem = _t(spark, sf_dir, "lineitem")
    ns = _max_plus_one(supplier, "s_suppkey")
    nc = _max_plus_one(customer, "c_custkey")
    return StandIn(
        fixtures=_fixtures(orders, ns, nc),
        teams=_teams(customer, nation, ns),
        venues=_venues(supplier, nation, region),
        team_stats=_team_stats(lineitem, orders, nc),
        payload=_payload(orders, ns),
        nation=nation,
        region=region,
    )


def _fixtures(orders: DataFrame, ns: Column, nc: Column) -> DataFrame:
    k = F.col("o_orderkey")
    cust = F.col("o_custkey")
    kick = F.timestamp_add("MINUTE", ((k * 7) % 96) * 15, F.col("o_orderdate"))
    pow10 = (
        F.when(k % 6 == 0, 1).when(k % 6 == 1, 10).when(k % 6 == 2, 100)
        .when(k % 6 == 3, 1000).when(k % 6 == 4, 10000).otherwise(100000)
    )
    home_score = (k * 7 + cust) % 6
    away_score = (k * 3 + cust * 5) % 5
    shootout = k % 20 == 1

    h = home_score + (F.col(VERSION) - 1)
    a = F.when(k % 83 == 7, -1).otherwise(away_score)
    return _versioned(orders, k % 7 == 0).select(
        _s(k + 1).alias("Rn"),
        F.lit("1").alias("seasonType"),
        _s(cust % 10 + 700).alias("leagueId"),
        _s(event_id(k)).alias("eventId"),
        _s(kick).alias("date"),
        _s(k % ns).alias("venueId"),
        F.when(k % 10 == 0, F.lit("")).otherwise(_s(F.floor(F.col("o_totalprice") / pow10))).alias("attendance"),
        _s(F.when(k % 97 == 5, cust + 900_000_000).otherwise(cust)).alias("homeTeamId"),
        F.when(k % 89 == 3, F.lit("")).otherwise(_s((cust + 1 + k % 7) % nc)).alias("awayTeamId"),
        _s(h > a).alias("homeTeamWinner"),
        _s(a > h).alias("awayTeamWinner"),
        F.when(k % 50 == 0, F.lit("")).otherwise(_s(h)).alias("homeTeamScore"),
        _s(a).alias("awayTeamScore"),
        F.when(shootout, _s(k % 5 + 1)).otherwise(F.lit("")).alias("homeTeamShootoutScore"),
        F.when(shootout, _s((k + 2) % 5 + 1)).otherwise(F.lit("")).alias("awayTeamShootoutScore"),
        F.lit("28").alias("statusId"),
        _s(kick).alias("updateTime"),
        F.lit(None).cast("string").alias("hasWeather"),
        _load_time().alias(INGESTION_TIME),
    )


def _teams(customer: DataFrame, nation: DataFrame, ns: Column) -> DataFrame:
    c = F.col("c_custkey")
    j = customer.join(nation, customer.c_nationkey == nation.n_nationkey, "left")
    return j.select(
        _s(c).alias("teamId"),
        F.when(c % 9 == 0, F.lit("")).otherwise(F.col("n_name")).alias("location"),
        F.concat(F.lit("  "), F.col("c_name"), F.lit(" ")).alias("name"),
        F.substring("c_name", 1, 3).alias("abbreviation"),
        F.col("c_name").alias("displayName"),
        F.col("c_name").alias("shortDisplayName"),
        F.lit("ffffff").alias("color"),
        F.lit("000000").alias("alternateColor"),
        F.lit(None).cast("string").alias("logoURL"),
        _s(c % ns).alias("venueId"),
        F.lower(F.col("c_name")).alias("slug"),
        F.lit(FIRST_LOAD).cast("timestamp_ntz").alias(INGESTION_TIME),
    )


def _venues(supplier: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    s = F.col("s_suppkey")
    j = supplier.join(nation, supplier.s_nationkey == nation.n_nationkey, "left").join(
        region, F.col("n_regionkey") == region.r_regionkey, "left"
    )
    has = venue_has_coordinates(s)
    return j.select(
        _s(s).alias("venueId"),
        F.when(s % 5 == 1, F.concat(F.lit('The "'), F.col("s_name"), F.lit('" Park, North')))
        .when(s % 7 == 2, F.concat(F.col("s_name"), F.lit("\nAnnex"))).otherwise(F.col("s_name")).alias("fullName"),
        F.col("s_name").alias("shortName"),
        _s(s * 10 + 1000).alias("capacity"),
        F.when(s % 11 == 0, F.lit("None")).otherwise(F.col("n_name")).alias("city"),
        F.col("r_name").alias("country"),
        F.when(has, _s(venue_latitude(s))).alias("latitude"),
        F.when(has, _s(venue_longitude(s))).alias("longitude"),
        F.lit(FIRST_LOAD).cast("timestamp_ntz").alias(INGESTION_TIME),
    )


def _team_stats(lineitem: DataFrame, orders: DataFrame, nc: Column) -> DataFrame:
    j = lineitem.join(orders.select("o_orderkey", "o_custkey").hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
    k = F.col("l_orderkey")
    cust = F.col("o_custkey")
    line = F.col("l_linenumber")
    team = F.when(line % 2 == 1, cust).otherwise((cust + 1 + k % 7) % nc)
    q = F.col("l_quantity")
    nulls = {c: F.lit(None).cast("string") for c in [
        "offsides", "saves", "totalShots", "shotsOnTarget", "shotPct", "penaltyKickGoals",
        "penaltyKickShots", "accuratePasses", "totalPasses", "passPct", "accurateCrosses",
        "totalCrosses", "crossPct", "totalLongBalls", "accurateLongBalls", "longballPct",
        "blockedShots", "effectiveTackles", "totalTackles", "tacklePct", "interceptions",
        "effectiveClearance", "totalClearance", "updateTime"]}
    return j.select(
        F.lit("1").alias("seasonType"),
        _s(event_id(k)).alias("eventId"),
        _s(team).alias("teamId"),
        _s(line).alias("teamOrder"),
        _s(F.round(F.col("l_discount") * 100 + 40, 2)).alias("possessionPct"),
        _s(q).alias("foulsCommitted"),
        _s(q % 5).alias("yellowCards"),
        _s(q % 2).alias("redCards"),
        _s(q % 12).alias("wonCorners"),
        *[v.alias(n) for n, v in nulls.items()],
        F.timestamp_add("MINUTE", line, F.lit(FIRST_LOAD).cast("timestamp_ntz")).alias(INGESTION_TIME),
    )


def _reading(expr_of_h, nan_when=None):
    def f(h: Column) -> Column:
        v = expr_of_h(h)
        if nan_when is not None:
            v = F.when(nan_when(h), F.lit(float("nan"))).otherwise(v)
        return v.cast("float")
    return f


def _payload(orders: DataFrame, ns: Column) -> DataFrame:
    key = F.col("o_orderkey")
    venue = key % ns
    k = key + 5 * (F.col(VERSION) - 1)  # readings of a later fetch differ
    hours = F.sequence(F.lit(0), F.lit(23))

    def tenths(mult: int, hmult: int, mod: int, shift: int = 0):
        return lambda h: ((k * mult + h * hmult) % mod - shift).cast("double") / F.lit(10.0)

    temp = _reading(tenths(11, 3, 500, 100), nan_when=lambda h: (k + h) % 29 == 0)
    precip = _reading(tenths(13, 7, 100))
    wind = _reading(tenths(17, 5, 600))

    def snow(h: Column) -> Column:
        t = tenths(11, 3, 500, 100)(h)
        return F.when(t < 0, tenths(13, 7, 100)(h)).otherwise(F.lit(0.0)).cast("float")

    fetched = venue_has_coordinates(venue) & (key % 13 != 0)
    day = F.col("o_orderdate")
    return _versioned(orders.filter(fetched), key % 9 == 4).select(
        _s(event_id(key)).alias("eventId"),
        day.cast("date").alias("date"),
        venue_latitude(venue).alias("latitude"),
        venue_longitude(venue).alias("longitude"),
        day.cast("timestamp_ntz").alias("start_ts"),
        F.timestamp_add("HOUR", F.lit(24), day).cast("timestamp_ntz").alias("end_ts"),
        F.lit(3600).alias("interval_s"),
        F.transform(hours, temp).alias("temperature_2m"),
        F.transform(hours, precip).alias("precipitation"),
        F.transform(hours, precip).alias("rain"),
        F.transform(hours, snow).alias("snowfall"),
        F.transform(hours, wind).alias("wind_speed_10m"),
        _load_time().alias(INGESTION_TIME),
    )


def gazetteer(nation: DataFrame, region: DataFrame) -> DataFrame:
    """Stand-in place-name table for geocoding: 'nation, region' and 'region' entries."""
    j = nation.join(region, nation.n_regionkey == region.r_regionkey)
    by_city = j.select(
        F.concat_ws(", ", F.col("n_name"), F.col("r_name")).alias("query"),
        (F.col("n_nationkey") * 3 - 40).cast("double").alias("latitude"),
        (F.col("n_nationkey") * 7 - 90).cast("double").alias("longitude"),
    )
    by_country = region.select(
        F.col("r_name").alias("query"),
        (F.col("r_regionkey") * 10 - 20).cast("double").alias("latitude"),
        (F.col("r_regionkey") * 30 - 60).cast("double").alias("longitude"),
    )
    return by_city.unionByName(by_country)
