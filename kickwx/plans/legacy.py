"""The older star schema (MatchFact, DimTeam, DimWeather, DimDate, DimVenue) and its queries.

The older schema has no DDL in the reference; it is known from the queries
that read it. It is a projection of the current marts: the match fact keeps
the natural team and venue ids it was built from.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kickwx.functions.keys import published_key
from kickwx.plans.marts import Marts


@dataclass
class LegacyStar:
    match_fact: DataFrame
    dim_team: DataFrame
    dim_weather: DataFrame
    dim_date: DataFrame
    dim_venue: DataFrame


def legacy_star(m: Marts) -> LegacyStar:
    f = m.fact_match
    return LegacyStar(
        match_fact=f.select(
            published_key(F.col("match_id")).alias("MatchID"),
            F.col("date_key").alias("DateID"),
            F.col("weather_key").alias("WeatherID"),
            F.col("venue_id").alias("VenuneID"),
            F.col("home_team_id").alias("TeamID_home"),
            F.col("away_team_id").alias("TeamID_away"),
            F.col("home_goals").alias("HomeGoals"),
            F.col("away_goals").alias("AwayGoals"),
            F.col("home_fouls").alias("HomeFouls"),
            F.col("away_fouls").alias("AwayFouls"),
        ),
        dim_team=m.dim_team.select(F.col("team_id").alias("TeamHomeID"), F.col("team_name").alias("TeamName")),
        dim_weather=m.dim_weather.select(
            F.col("weather_key").alias("WeatherID"),
            F.col("avg_temperature").alias("Temperature"),
            F.col("avg_precipitation").alias("Precipitation"),
        ),
        dim_date=m.dim_date.select(F.col("date_key").alias("DateID"), F.col("match_date").alias("Date")),
        dim_venue=m.dim_venue.select(
            F.col("venue_id").alias("VenueID"), F.col("venue_name").alias("VenueName"), F.col("city").alias("City")),
    )


def rain_and_venue(s: LegacyStar) -> DataFrame:
    """Q9: per venue, mean fouls in rain (> 2 mm) and otherwise, side by side."""
    j = s.match_fact.join(s.dim_weather.hint("merge"), "WeatherID").join(
        s.dim_venue, F.col("VenuneID") == F.col("VenueID"))
    fouls = F.col("HomeFouls") + F.col("AwayFouls")
    return (
        j.groupBy("VenueName", "City")
        .agg(
            F.count("MatchID").alias("TotalMatches"),
            F.avg(F.when(F.col("Precipitation") > 2, fouls)).alias("AvgFouls_Rainy"),
            F.avg(F.when(F.col("Precipitation") <= 2, fouls)).alias("AvgFouls_Otherwise"),
        )
        .orderBy(F.col("AvgFouls_Rainy").desc_nulls_last())
    )


def matches_temperature(s: LegacyStar, team1: int = 1, team2: int = 2) -> DataFrame:
    """Q10: matches between two teams, coldest first, from team 1's side.

    The reference looks both names up with constant join conditions
    (``t1.TeamHomeID = 1``). Every kept match has team 1 on one side and team
    2 on the other, so the lookups are equi-joins on the side that holds the
    team: no cartesian product.
    """
    home, away = F.col("TeamID_home"), F.col("TeamID_away")
    m = s.match_fact.filter(((home == team1) & (away == team2)) | ((home == team2) & (away == team1)))
    m = m.withColumn("__t1", F.when(home == team1, home).otherwise(away)).withColumn(
        "__t2", F.when(home == team2, home).otherwise(away))
    t1 = s.dim_team.select(F.col("TeamHomeID").alias("__t1"), F.col("TeamName").alias("Team1_Name"))
    t2 = s.dim_team.select(F.col("TeamHomeID").alias("__t2"), F.col("TeamName").alias("Team2_Name"))
    j = m.join(t1, "__t1").join(t2, "__t2").join(s.dim_weather.hint("merge"), "WeatherID").join(s.dim_date.hint("merge"), "DateID")
    hg, ag = F.col("HomeGoals"), F.col("AwayGoals")
    return j.select(
        "MatchID", "Date", "Temperature", "Team1_Name", "Team2_Name",
        F.when(home == team1, hg).otherwise(ag).alias("Team1_Goals"),
        F.when(home == team2, hg).otherwise(ag).alias("Team2_Goals"),
        F.when(home == team1, hg - ag).otherwise(ag - hg).alias("GoalDifference_Team1"),
    ).orderBy(F.col("Temperature").asc_nulls_last())


def team_extreme_temperature(s: LegacyStar, team: int = 100, hottest: bool = True, n: int = 5) -> DataFrame:
    """Q11: one team's n hottest (or coldest) matches; ties broken by match id."""
    home = F.col("TeamID_home")
    m = s.match_fact.filter((home == team) | (F.col("TeamID_away") == team))
    j = m.join(s.dim_weather.hint("merge"), "WeatherID")
    hg, ag = F.col("HomeGoals"), F.col("AwayGoals")
    t = F.col("temperature")
    return (
        j.select(
            "MatchID", F.col("Temperature").alias("temperature"),
            F.when(home == team, hg).otherwise(ag).alias("GoalsFor"),
            F.when(home == team, ag).otherwise(hg).alias("GoalsAgainst"),
        )
        .orderBy(t.desc_nulls_last() if hottest else t.asc_nulls_last(), F.col("MatchID"))
        .limit(n)
    )


def team_precipitation(s: LegacyStar) -> DataFrame:
    """Q12: two rows per match (one per side), the team's goals against the opponent's.

    The reference joins teams with ``IN`` and an OR of two conjunctions
    (theta joins). Here each match emits one row per distinct side with the
    opponent id attached, and both lookups are equi-joins.
    """
    home, away = F.col("TeamID_home"), F.col("TeamID_away")
    hg, ag = F.col("HomeGoals"), F.col("AwayGoals")
    sides = F.array(
        F.struct(home.alias("TeamID"), away.alias("OpponentID"), hg.alias("TeamGoals"), ag.alias("OpponentGoals")),
        F.when(~home.eqNullSafe(away), F.struct(
            away.alias("TeamID"), home.alias("OpponentID"), ag.alias("TeamGoals"), hg.alias("OpponentGoals"))),
    )
    # weather and date are looked up once per match, before the rows double
    m = s.match_fact.join(s.dim_weather.hint("merge"), "WeatherID").join(s.dim_date.hint("merge"), "DateID")
    per_side = m.select("MatchID", "Date", "Precipitation", F.explode(sides).alias("x")).filter(
        F.col("x").isNotNull()).select("MatchID", "Date", "Precipitation", "x.*")
    t = s.dim_team.select(F.col("TeamHomeID").alias("TeamID"), "TeamName")
    opp = s.dim_team.select(F.col("TeamHomeID").alias("OpponentID"), F.col("TeamName").alias("OpponentName"))
    j = per_side.join(t, "TeamID").join(opp, "OpponentID")
    return j.select(
        "MatchID", "Date", "TeamID", "TeamName", "OpponentID", "OpponentName", "TeamGoals", "OpponentGoals",
        (F.col("TeamGoals") - F.col("OpponentGoals")).alias("GoalDifference"), "Precipitation",
    ).orderBy(F.col("TeamID").asc_nulls_last(), F.col("Precipitation").asc_nulls_last())
