"""Joins and exchanges that grow with the matches: nothing of theirs is broadcast, and weather is exchanged once."""

import re

import pytest

from pyspark.sql import functions as F

from kickwx.operators.asof import irregular_matches, select_kickoff_weather
from kickwx.operators.enrich import mark_has_weather, pending_weather
from kickwx.plans import legacy, staging
from kickwx.plans.registry import registry
from kickwx.sources.testdata import _team_stats


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def small(spark, n, **columns):
    """Rows whose size the planner knows to be small."""
    return spark.range(n).select(*[F.expr(e).alias(c) for c, e in columns.items()])


@pytest.fixture()
def weather(spark):
    return small(spark, 48, event_id="id div 24", weather_datetime="timestampadd(HOUR, id % 24, timestamp_ntz'2001-05-06 00:00:00')", v="id")


@pytest.fixture()
def kickoffs(spark):
    return small(spark, 2, event_id="id", match_datetime="timestampadd(MINUTE, 615 + 30 * id, timestamp_ntz'2001-05-06 00:00:00')")


@pytest.mark.parametrize("method", ["window", "grid", "ranks", "aggregate", "topk"])
def test_kickoffs_are_not_broadcast(weather, kickoffs, method):
    kept = select_kickoff_weather(weather, kickoffs, method=method)
    assert "BroadcastHashJoin" not in plan(kept)
    assert sorted((r.event_id, r.weather_datetime.hour) for r in kept.collect()) == [(0, 10), (0, 11), (1, 11)]


def test_hours_wanted_are_not_broadcast(weather, kickoffs):
    assert "BroadcastHashJoin" not in plan(irregular_matches(weather, kickoffs))


def test_rows_per_match_are_not_broadcast(spark):
    fixtures = small(spark, 3, eventId="string(id)", date="string(id)", venueId="string(id)", hasWeather="cast(null as string)")
    venues = small(spark, 3, venueId="string(id)", latitude="'1'", longitude="'1'")
    weather = small(spark, 2, eventId="string(id)")
    marked = mark_has_weather(fixtures, weather)
    assert "BroadcastHashJoin" not in plan(marked)
    assert sorted((r.eventId, r.hasWeather) for r in marked.collect()) == [("0", "1"), ("1", "1"), ("2", None)]
    todo = pending_weather(fixtures, venues, weather)
    assert not re.search(r"BroadcastHashJoin \[eventId", plan(todo))
    assert [r.eventId for r in todo.collect()] == ["2"]


def test_statistics_are_not_joined_by_broadcast(spark):
    orders = small(spark, 3, o_orderkey="id", o_custkey="id")
    lines = small(spark, 6, l_orderkey="id % 3", l_linenumber="id", l_quantity="1.0D", l_discount="0.1D")
    rows = _team_stats(lines, orders, F.lit(5))
    assert "BroadcastHashJoin" not in plan(rows) and rows.count() == 6
    fixtures = small(spark, 3, event_id="id", home_team_id="id", away_team_id="id + 1")
    stats = small(spark, 6, event_id="id % 3", team_id="id", **{c: "id" for c in staging.STATS})
    assert "BroadcastHashJoin" not in plan(staging.team_stats_agg(fixtures, stats))


def test_dates_are_not_broadcast(spark):
    fact = small(spark, 3, MatchID="id", DateID="id", WeatherID="id", VenuneID="id", TeamID_home="id", TeamID_away="id + 1", HomeGoals="1", AwayGoals="0")
    star = legacy.LegacyStar(
        fact, small(spark, 4, TeamHomeID="id", TeamName="string(id)"), small(spark, 3, WeatherID="id", Temperature="1.0", Precipitation="1.0"),
        small(spark, 3, DateID="id", Date="date'2001-05-06'"), small(spark, 3, VenueID="id", VenueName="'v'", City="'c'"),
    )
    for rows in (legacy.team_precipitation(star), legacy.matches_temperature(star)):
        assert not re.search(r"BroadcastHashJoin \[DateID", plan(rows))
    assert legacy.team_precipitation(star).count() == 6


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """A few rows of the tables that the stand-in bronze is made of."""
    root = str(tmp_path_factory.mktemp("tables"))
    rows = {
        "orders": small(spark, 40, o_orderkey="id", o_custkey="id % 4", o_totalprice="100.0D * id", o_orderdate="timestamp_ntz'2001-05-06 00:00:00'"),
        "lineitem": small(spark, 80, l_orderkey="id % 40", l_linenumber="1 + id div 40", l_quantity="double(id % 9)", l_discount="0.05D"),
        "customer": small(spark, 4, c_custkey="id", c_name="concat('c', id)", c_nationkey="0L"),
        "supplier": small(spark, 5, s_suppkey="id", s_name="concat('s', id)", s_nationkey="0L"),
        "nation": small(spark, 1, n_nationkey="id", n_name="'N'", n_regionkey="0L"),
        "region": small(spark, 1, r_regionkey="id", r_name="'EUROPE'"),
    }
    for name, df in rows.items():
        df.coalesce(1).write.parquet(f"{root}/{name}.parquet")
    return root


def exchanges(df, column):
    """Hash exchanges that deal rows out by this column, with what else they are dealt by."""
    return re.findall(rf"Exchange hashpartitioning\(({column}#\d+L?[^)]*)\)", plan(df))


@pytest.mark.parametrize("name", ["weather_latest", "bronze_row_counts"])
def test_payloads_not_hours_are_exchanged_for_the_version_choice(spark, tables, name):
    found = registry()[name](spark, tables)
    assert not any("timestamp_utc" in e for e in exchanges(found, "eventId"))
    if name == "weather_latest":
        assert len(exchanges(found, "eventId")) == 1
        text = plan(found)
        assert text.index("Generate inline") < text.index("Exchange hashpartitioning(eventId")
        fetched = sum(1 for k in range(40) if (k % 5) % 4 != 0 and k % 13 != 0)
        assert found.count() == 24 * fetched
        assert found.filter("_ingestion_time > timestamp_ntz'2025-10-28 12:00:00'").count() == 24 * sum(
            1 for k in range(40) if (k % 5) % 4 != 0 and k % 13 != 0 and k % 9 == 4)


@pytest.mark.parametrize("name", ["asof_grid", "weather_aggregate", "stg_dim_weather"])
def test_observations_are_exchanged_by_match_alone(spark, tables, name):
    assert not any("weather_datetime" in e for e in exchanges(registry()[name](spark, tables), "event_id") if "match_datetime" not in e)


def test_the_three_readings_of_aggregate_share_one_exchange(spark, tables):
    found = registry()["weather_aggregate"](spark, tables)
    assert found.count() > 0
    readings = re.findall(r"Exchange hashpartitioning\(event_id#\d+L[^)]*\), REPARTITION_BY_COL.*?\n((?:.*\n){6})", plan(found))
    assert len(readings) == 3
    assert len({re.sub(r"#\d+L?|^[\s:|+-]*|, \[plan_id=\d+\]", "", r, flags=re.M) for r in readings}) == 1


@pytest.mark.parametrize("name", ["attendance_rain", "matches_temperature", "dq_summary", "sql_views"])
def test_questions_plan_the_star_in_steps(spark, tables, name):
    """Weather and typed fixtures are read back, and no row per match is broadcast."""
    found = registry()[name](spark, tables)
    files = " ".join(found.inputFiles())
    assert "/dim-weather-" in files and "/typed-fixtures-" in files
    assert not re.search(r"BroadcastHashJoin \[(event_id|WeatherID|DateID)", plan(found))


def test_refresh_and_upsert_do_not_broadcast_matches(spark, tables):
    from kickwx.plans.refresh import of_matches
    from kickwx.plans.warehouse import bronze_from_tables
    some = of_matches(bronze_from_tables(spark, tables), small(spark, 3, event_id="id"))
    for rows in (some.fixtures, some.team_stats, some.weather):
        assert not re.search(r"BroadcastHashJoin \[.*eventId", plan(rows))
    assert some.fixtures.select("eventId").distinct().count() == 3


def test_weather_of_a_batch_is_not_joined_before_it_meets_the_kickoffs(spark, tables):
    from dataclasses import replace
    from kickwx.plans.refresh import of_matches
    from kickwx.plans.warehouse import MartsInSteps, bronze_from_tables
    b, ids = bronze_from_tables(spark, tables), small(spark, 3, event_id="id")
    some = of_matches(b, ids)
    assert "Join" not in plan(some.weather)
    exact = b.weather.join(ids, b.weather["eventId"].cast("long") == ids["event_id"], "left_semi")
    got, want = (MartsInSteps(replace(some, weather=w), "guarded").stg_dim_weather.collect() for w in (some.weather, exact))
    assert sorted(map(str, got)) == sorted(map(str, want)) and got


def test_weather_is_chosen_in_steps(spark, tables):
    """Irregular matches and picks are read back: the dimension's plan holds no as-of join, and its rows are those of one plan."""
    from kickwx.plans.warehouse import MartsInSteps, bronze_from_tables
    b = bronze_from_tables(spark, tables)
    hourly = F.hour("timestamp_utc") == 9  # matches 1 and 2 lack hours, so both paths have picks
    b.weather = b.weather.filter(~(F.col("eventId").isin("1", "2") & hourly))
    marts = MartsInSteps(b, "guarded")
    assert not re.search(r"Window|Join|bitmap", plan(marts.stg_dim_weather))
    whole = staging.stg_dim_weather(b.weather, marts.fixtures, method="guarded")
    assert sorted(map(str, marts.stg_dim_weather.collect())) == sorted(map(str, whole.collect()))
    exact = staging.stg_dim_weather(b.weather, marts.fixtures, method="window")
    assert whole.count() == exact.count() > 0


def test_both_loads_come_from_one_scan(spark, tables):
    from kickwx.sources.testdata import stand_in
    s = stand_in(spark, tables)
    for rows, again in ((s.fixtures, lambda k: k % 7 == 0), (s.payload, lambda k: k % 9 == 4)):
        text = plan(rows)
        assert text.count("FileScan") == 1 and "Subquery" not in text
        found = [(int(r.eventId) % 3_000_000_000, str(r._ingestion_time)) for r in rows.select("eventId", "_ingestion_time").collect()]
        first = [k for k, t in found if t == "2025-10-28 06:00:00"]
        assert len(found) > len(first) == len(set(first))
        assert sorted(k for k, t in found if t == "2025-10-29 06:00:00") == sorted(k for k in first if again(k))
