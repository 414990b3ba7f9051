"""Plan shape and properties of the marts and queries on the smallest test tables."""

from contextlib import contextmanager

from pyspark.sql import functions as F

from kickwx.plans import analytics as A
from kickwx.plans import legacy as L
from kickwx.plans.marts import v_matches_full, v_matches_limited


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_theta_joins_are_equi_joins(marts_small):
    s = L.legacy_star(marts_small)
    for df in (L.team_precipitation(s), L.matches_temperature(s, 1, 2)):
        p = plan(df)
        assert "CartesianProduct" not in p and "NestedLoopJoin" not in p


def test_top_k_plans_take_ordered(marts_small):
    s = L.legacy_star(marts_small)
    assert "TakeOrderedAndProject" in plan(L.team_extreme_temperature(s, 100, hottest=True))
    assert "TakeOrderedAndProject" in plan(A.role_top20(marts_small, limited=True))


def test_resilience_games_equal_team_sides_with_weather(marts_small):
    m = marts_small
    total = A.team_resilience(m).agg(F.sum("total_games_played")).first()[0]
    f = m.fact_match.join(m.dim_weather.select("weather_key"), "weather_key")
    keys = m.dim_team.select("team_key")
    sides = (f.join(keys.withColumnRenamed("team_key", "home_team_key"), "home_team_key").count()
             + f.join(keys.withColumnRenamed("team_key", "away_team_key"), "away_team_key").count())
    assert total == sides


def test_home_win_total_is_inner_join_count(marts_small):
    m = marts_small
    total = A.home_win_rain(m).agg(F.sum("total_matches")).first()[0]
    assert total == m.fact_match.join(m.dim_weather, "weather_key").count()


def test_masked_view_has_same_matches(marts_small):
    full = v_matches_full(marts_small.fact_match).select("match_id")
    lim = v_matches_limited(marts_small.fact_match).select("match_id")
    assert full.exceptAll(lim).count() == 0 and lim.exceptAll(full).count() == 0


def test_fact_is_one_row_per_match(marts_small):
    f = marts_small.fact_match
    assert f.count() == f.select("match_id").distinct().count()


@contextmanager
def without_broadcast_or_aqe(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        yield
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_bucketed_marts_join_without_exchange_and_without_a_hot_bucket(spark):
    from kickwx.plans.warehouse import bronze_from_tables, materialize_tables, read_tables
    materialize_tables(spark, bronze_from_tables(spark, "/root/testdata/sf0.001"), "kickwx_test_marts", buckets=4)
    m = read_tables(spark, "kickwx_test_marts")
    with without_broadcast_or_aqe(spark):
        p = plan(A.variability_rain(m))
        assert "SortMergeJoin" in p  # a shuffle-free join of the two bucketed tables
        assert "Exchange hashpartitioning(event_id" not in p and "Exchange hashpartitioning(weather_key" not in p
        assert A.variability_rain(m).count() == A.variability_rain(marts_of(spark)).count()
    sizes = [r["count"] for r in m.fact_match.groupBy(F.pmod(F.hash("event_id"), F.lit(4))).count().collect()]
    assert max(sizes) <= 2 * sum(sizes) / 4


def marts_of(spark):
    from kickwx.plans.warehouse import marts_from_tables
    return marts_from_tables(spark, "/root/testdata/sf0.001")


def test_team_perspective_rows_follow_in_join_semantics(spark):
    """Same team on both sides: the reference's IN join yields one row; a NULL side yields none for it."""
    from datetime import date
    from kickwx.plans.legacy import LegacyStar, team_precipitation
    mf = spark.createDataFrame(
        [(1, 10, 20, 7, 7, 2, 1), (2, 11, 21, 7, 8, 0, 3), (3, 12, 22, 7, None, 1, 1)],
        "MatchID long, DateID long, WeatherID long, TeamID_home int, TeamID_away int, HomeGoals int, AwayGoals int")
    star = LegacyStar(
        match_fact=mf,
        dim_team=spark.createDataFrame([(7, "A"), (8, "B")], "TeamHomeID int, TeamName string"),
        dim_weather=spark.createDataFrame([(20, 1.0, 0.5), (21, 2.0, 1.5), (22, 3.0, 2.5)],
                                          "WeatherID long, Temperature double, Precipitation double"),
        dim_date=spark.createDataFrame([(10, date(2001, 1, 1)), (11, date(2001, 1, 2)), (12, date(2001, 1, 3))],
                                       "DateID long, Date date"),
        dim_venue=None,
    )
    rows = sorted((r.MatchID, r.TeamID, r.OpponentID, r.GoalDifference) for r in team_precipitation(star).collect())
    assert rows == [(1, 7, 7, 1), (2, 7, 8, -3), (2, 8, 7, 3)]


def test_fact_grain_sits_on_the_event_partitioning_below_every_lookup(spark, marts_small):
    with without_broadcast_or_aqe(spark):
        lines = plan(marts_small.fact_match).splitlines()
    tree = [line for line in lines if "Aggregate" in line or "Exchange" in line]
    # from the top down: the lookups' exchanges come first, and no aggregate above them
    first_agg = next(i for i, line in enumerate(tree) if "Aggregate" in line)
    assert any("hashpartitioning(away_team_id" in line for line in tree[:first_agg])
    assert any("hashpartitioning(venue_id" in line for line in tree[:first_agg])
    # the grain and pivot aggregates run on what the event exchanges delivered
    below = next(line for line in tree[first_agg:] if "Exchange" in line)
    assert "hashpartitioning(event_id" in below


def exchanges_of_the_weather(spark, method):
    from kickwx.plans import staging as stg
    from kickwx.plans.warehouse import bronze_from_tables, read_bronze, write_bronze
    b = read_bronze(spark, write_bronze(spark, bronze_from_tables(spark, "/root/testdata/sf0.001")))
    with without_broadcast_or_aqe(spark):
        kick = stg.stg_fixtures(b.fixtures).select("event_id", "match_datetime")
        lines = plan(stg.kickoff_weather(b.weather, kick, method)).splitlines()
    # exchanges on the path from the weather scan to the root
    scan = next(i for i, line in enumerate(lines) if "FileScan" in line and "timestamp_utc" in line)
    depth = lambda line: len(line) - len(line.lstrip(" :+-*()0123456789"))
    path, at = [], depth(lines[scan])
    for line in lines[scan::-1]:
        if depth(line) < at:
            path.append(line)
            at = depth(line)
    return [line for line in path if "Exchange" in line]


def test_weather_is_exchanged_once(spark):
    for method in ("window", "grid"):
        assert len(exchanges_of_the_weather(spark, method)) == 1, method
