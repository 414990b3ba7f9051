"""The analytical questions, each a DataFrame over the marts.

Library functions return unrounded values; the registered queries round
floating results for cross-engine comparison. Orderings follow the reference
(NULLs last in both directions).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kickwx.functions import buckets as B
from kickwx.functions.keys import published_key
from kickwx.plans.marts import Marts, v_matches_full, v_matches_limited

def _hundred():
    return F.lit(100.0)  # double, as the reference's float literal


def _with_weather(m: Marts, fact: DataFrame | None = None, cols=("avg_precipitation",)) -> DataFrame:
    """Fact rows that have a weather record.

    A fact row's weather key is that of its match's one row of the weather dimension, so the join is on the match,
    on which both tables are bucketed; its one row per match is not to be broadcast.
    """
    f = m.fact_match if fact is None else fact
    return f.filter(F.col("weather_key").isNotNull()).join(m.dim_weather.select("event_id", *cols).hint("merge"), "event_id", "inner")


def attendance_rain(m: Marts) -> DataFrame:
    """Q1: matches and mean attendance per venue, city and rain category."""
    f = m.fact_match.filter(F.col("attendance").isNotNull() & (F.col("attendance") > 0))
    j = _with_weather(m, f).join(m.dim_venue.select("venue_key", "venue_name", "city"), "venue_key", "inner")
    return (
        j.groupBy("venue_name", "city", B.rain_category(F.col("avg_precipitation")).alias("rain_category"))
        .agg(F.count("match_id").alias("total_matches"), F.bround(F.avg("attendance"), 0).alias("average_attendance"))
        .orderBy(F.col("venue_name").asc_nulls_last(), F.col("rain_category").desc_nulls_last())
    )


def fouls_rain(m: Marts) -> DataFrame:
    """Q2: mean fouls (total, home, away) per rain category."""
    f = m.fact_match.filter(F.col("home_fouls").isNotNull() & F.col("away_fouls").isNotNull())
    return (
        _with_weather(m, f)
        .groupBy(B.rain_category(F.col("avg_precipitation")).alias("rain_category"))
        .agg(
            F.count("match_id").alias("total_matches"),
            F.avg(F.col("home_fouls") + F.col("away_fouls")).alias("average_total_fouls"),
            F.avg("home_fouls").alias("average_home_fouls"),
            F.avg("away_fouls").alias("average_away_fouls"),
        )
        .orderBy("rain_category")
    )


def _home_win_loss(m: Marts, category, name: str, weather_col: str) -> DataFrame:
    j = _with_weather(m, cols=(weather_col,))
    hg, ag = F.col("home_goals"), F.col("away_goals")
    n = F.count("match_id")
    return (
        j.groupBy(category(F.col(weather_col)).alias(name))
        .agg(
            n.alias("total_matches"),
            F.bround(F.sum(F.when(hg > ag, 1).otherwise(0)) * _hundred() / n, 2).alias("home_win_percentage"),
            F.bround(F.sum(F.when(hg < ag, 1).otherwise(0)) * _hundred() / n, 2).alias("home_loss_percentage"),
        )
        .orderBy(name)
    )


def home_win_rain(m: Marts) -> DataFrame:
    """Q3: home win and loss percentage per rain category."""
    return _home_win_loss(m, B.rain_category, "rain_category", "avg_precipitation")


def home_win_temperature(m: Marts) -> DataFrame:
    """Q14 (dashboard): home win and loss percentage per temperature category."""
    return _home_win_loss(m, B.temperature_category, "temperature_category", "avg_temperature")


def home_win_wind(m: Marts) -> DataFrame:
    """Q14 (dashboard): home win and loss percentage per wind category."""
    return _home_win_loss(m, B.wind_category, "wind_category", "avg_wind_speed")


def _variability(j: DataFrame, category_col, name: str) -> DataFrame:
    d = F.col("home_goals") - F.col("away_goals")
    return (
        j.groupBy(category_col.alias(name))
        .agg(
            F.count("match_id").alias("total_matches"),
            F.avg(F.abs(d)).alias("avg_goal_difference"),
            F.stddev_samp(d).alias("stddev_goal_difference"),
        )
        .orderBy(F.col("stddev_goal_difference").desc_nulls_last())
    )


def variability_rain(m: Marts) -> DataFrame:
    """Q4: mean absolute goal difference and its sample stddev per rain category."""
    j = _with_weather(m)
    return _variability(j, B.rain_category(F.col("avg_precipitation")), "rain_category")


def variability_temp(m: Marts) -> DataFrame:
    """Q5: outcome variability per temperature category."""
    j = _with_weather(m, cols=("avg_temperature",))
    return _variability(j, B.temperature_category(F.col("avg_temperature")), "temperature_category")


def variability_wind(m: Marts) -> DataFrame:
    """Q6: outcome variability per wind category."""
    j = _with_weather(m, cols=("avg_wind_speed",))
    return _variability(j, B.wind_category(F.col("avg_wind_speed")), "wind_category")


def variability_rain_in_country(m: Marts, country: str) -> DataFrame:
    """Q15 (dashboard with country filter): Q4 restricted to venues of one country."""
    venues = m.dim_venue.filter(F.col("country") == F.lit(country)).select("venue_key")
    f = m.fact_match.join(venues, "venue_key", "left_semi")
    j = _with_weather(m, f)
    return _variability(j, B.rain_category(F.col("avg_precipitation")), "rain_category")


def penalty_weather(m: Marts) -> DataFrame:
    """Q7: shootouts and mean shootout goals in extreme versus normal weather."""
    hs, as_ = F.col("home_shootout_score"), F.col("away_shootout_score")
    f = m.fact_match.filter((hs.isNotNull() | as_.isNotNull()) & ((hs > 0) | (as_ > 0)))
    j = _with_weather(m, f, cols=("avg_precipitation", "avg_temperature"))
    cat = B.shootout_weather_category(F.col("avg_precipitation"), F.col("avg_temperature"))
    return (
        j.groupBy(cat.alias("weather_category"))
        .agg(F.count("match_id").alias("total_shootouts"), F.bround(F.avg(hs + as_), 2).alias("average_shootout_goals_per_match"))
        .orderBy("weather_category")
    )


def team_rows(m: Marts) -> DataFrame:
    """One row per (match, side): team key, temperature category, win flag.

    Home and away are unpivoted by one ``explode`` over the single scan of
    the fact (the reference unions two scans of the same subquery).
    """
    j = _with_weather(m, cols=("avg_temperature",))
    hg, ag = F.col("home_goals"), F.col("away_goals")
    sides = F.array(
        F.struct(F.col("home_team_key").alias("team_key"), F.when(hg > ag, 1).otherwise(0).alias("is_win")),
        F.struct(F.col("away_team_key").alias("team_key"), F.when(ag > hg, 1).otherwise(0).alias("is_win")),
    )
    return j.select(
        B.temperature_category(F.col("avg_temperature")).alias("weather_temp_category"),
        F.inline(sides),
    )


def team_resilience(m: Marts) -> DataFrame:
    """Q8: games and win percentage per team name and temperature category.

    Team rows are pre-aggregated per (team key, category) before the lookup
    of names, so the join sees one row per team and category.
    """
    per_key = team_rows(m).groupBy("team_key", "weather_temp_category").agg(
        F.sum("is_win").alias("wins"), F.count(F.lit(1)).alias("played"))
    j = per_key.join(m.dim_team.select("team_key", "team_name"), "team_key", "inner")
    return (
        j.groupBy("team_name", "weather_temp_category")
        .agg(F.sum("played").alias("total_games_played"), F.sum("wins").alias("__wins"))
        .select(
            "team_name", "weather_temp_category", "total_games_played",
            (F.col("__wins") * _hundred() / F.col("total_games_played")).alias("win_percentage"),
        )
        .orderBy(F.col("team_name").asc_nulls_last(), F.col("weather_temp_category").desc_nulls_last())
    )


def role_top20(m: Marts, limited: bool) -> DataFrame:
    """Q13: first 20 matches by key of the full or the pseudonymised view."""
    v = v_matches_limited(m.fact_match) if limited else v_matches_full(m.fact_match)
    return v.select("match_id", "home_goals", "away_goals", "attendance").orderBy("match_id").limit(20)


__all__ = [
    "attendance_rain", "fouls_rain", "home_win_rain", "home_win_temperature", "home_win_wind",
    "variability_rain", "variability_temp", "variability_wind", "variability_rain_in_country",
    "penalty_weather", "team_resilience", "team_rows", "role_top20", "published_key",
]
