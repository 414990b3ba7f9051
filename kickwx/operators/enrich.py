"""Weather-enrichment work: work lists, geocoding by lookup, flags.

The reference calls a geocoder and a weather API row by row from the driver
and patches rows with per-id UPDATE statements. Here the network calls are
out of scope (their results arrive as tables: a place-name gazetteer and
landed API payloads), and every patch is one join over all rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_WS = r"^\s+|\s+$"

# Work batch sizes of the reference (geocoder courtesy limit,
# weather API quota per run).
VENUE_BATCH = 200
MATCH_BATCH = 500


def _place_part(x: Column) -> Column:
    """Python's ``x.strip() if x and x.lower() != 'none' else None``; empty after strip drops."""
    return F.when(F.lower(x) != F.lit("none"), F.nullif(F.regexp_replace(x, _WS, ""), F.lit("")))


def geocode_query_text(city: Column, country: Column) -> Column:
    """'city, country' from the usable parts (NULL, empty and 'none' parts are left out)."""
    return F.concat_ws(", ", _place_part(city), _place_part(country))


def pending_geocode(venues: DataFrame, fixtures: DataFrame, n: int | None = None) -> DataFrame:
    """Venues without coordinates that host matches, most-used first (ties by venue id).

    Fixtures are counted per venue id first (partial aggregation before the
    shuffle), then joined to the few venues lacking coordinates.
    """
    uses = fixtures.groupBy("venueId").agg(F.count(F.lit(1)).alias("__uses"))
    todo = venues.filter(F.col("latitude").isNull()).select("venueId", "fullName", "city", "country")
    j = todo.join(uses, "venueId", "inner")
    # the reference groups by the venue's columns; ids are unique after dedup, so this is the same grouping
    g = j.groupBy("venueId", "fullName", "city", "country").agg(F.sum("__uses").alias("__uses"))
    out = g.orderBy(F.col("__uses").desc(), F.col("venueId").asc())
    if n is not None:
        out = out.limit(n)
    return out.select("venueId", "fullName", "city", "country")


def venue_coord_enrich(venues: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """Fill missing venue coordinates from the gazetteer, matched on the geocode query text.

    One left join for all venues replaces the per-venue UPDATE; venues that
    already have coordinates keep them. Coordinates stay text, like the
    bronze column they update.
    """
    g = gazetteer.select(
        F.col("query").alias("__q"),
        F.col("latitude").cast("string").alias("__lat"),
        F.col("longitude").cast("string").alias("__lon"),
    ).groupBy("__q").agg(F.min(F.struct("__lat", "__lon")).alias("__c")).select("__q", "__c.*")
    need = F.col("latitude").isNull()
    v = venues.withColumn("__q", F.when(need, geocode_query_text(F.col("city"), F.col("country"))))
    j = v.join(g, "__q", "left")
    return j.select(
        *[
            (F.coalesce(F.col("latitude"), F.col("__lat")).alias("latitude") if c == "latitude"
             else F.coalesce(F.col("longitude"), F.col("__lon")).alias("longitude") if c == "longitude"
             else F.col(c))
            for c in venues.columns
        ]
    )


def pending_weather(fixtures: DataFrame, venues: DataFrame, weather: DataFrame | None,
                    n: int | None = None, by_flag: bool = False) -> DataFrame:
    """Matches still without weather whose venue has coordinates, oldest first (ties by event id).

    "Without weather" is an anti-join against the weather rows, so a failed
    fetch stays pending (the reference flags the whole request batch).
    ``by_flag=True`` selects by ``hasWeather IS NULL`` instead, as the
    reference does (``weather`` is then not read).
    """
    if by_flag:
        todo = fixtures.filter(F.col("hasWeather").isNull())
    else:
        have = weather.select("eventId").distinct()  # combined map-side: one row per match leaves each task
        todo = fixtures.join(have.hint("merge"), "eventId", "left_anti")  # as many as matches: never a broadcast
    v = venues.filter(F.col("latitude").isNotNull()).select("venueId", "latitude", "longitude")
    j = todo.select("eventId", "date", "venueId").join(v, "venueId", "inner")
    out = j.orderBy(F.col("date").asc_nulls_last(), F.col("eventId").asc())
    if n is not None:
        out = out.limit(n)
    return out.select("eventId", "date", "latitude", "longitude")


def mark_has_weather(fixtures: DataFrame, weather: DataFrame) -> DataFrame:
    """Set ``hasWeather = '1'`` on fixtures that have weather rows; others keep their flag.

    The ids are found by a distinct over the weather rows (combined map-side,
    so 24 hourly rows per match leave each task as one), then one left join.
    """
    done = weather.select("eventId").distinct().withColumn("__done", F.lit(True))
    j = fixtures.join(done.hint("merge"), "eventId", "left")
    return j.select(
        *[
            F.when(F.col("__done"), F.lit("1")).otherwise(F.col("hasWeather")).alias("hasWeather")
            if c == "hasWeather" else F.col(c)
            for c in fixtures.columns
        ]
    )
