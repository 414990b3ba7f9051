"""Incremental marts equal a full build from the same bronze rows."""

from pyspark.sql import functions as F

from kickwx.plans.marts import build_marts
from kickwx.plans.refresh import affected_matches, refresh_tables
from kickwx.plans.staging import Bronze
from kickwx.plans.warehouse import bronze_from_tables, read_bronze, write_bronze

TABLES = ["dim_date", "dim_team", "dim_venue", "stg_dim_weather", "dim_weather", "fact_match"]
FIRST, LATER = "2025-10-28 06:00:00", "2026-01-01 00:00:00"


def small_bronze(spark):
    """The first versions of some matches of the stand-in, without their later loads."""
    b = read_bronze(spark, write_bronze(spark, bronze_from_tables(spark, "/root/testdata/sf0.001")))
    old = lambda df: df.filter(F.col("_ingestion_time") <= F.lit(FIRST).cast("timestamp_ntz") + F.expr("INTERVAL 3 MINUTES"))
    return Bronze(**{n: old(getattr(b, n)) for n in ("fixtures", "teams", "venues", "team_stats", "weather")})


def later(df, **changes):
    return df.withColumns({**{c: F.lit(v) if not hasattr(v, "alias") else v for c, v in changes.items()}, "_ingestion_time": F.lit(LATER).cast("timestamp_ntz")})


def assert_equal_to_a_build(got, bronze):
    want = build_marts(bronze)
    for name in TABLES:
        a, b = getattr(got, name), getattr(want, name)
        a = a.select(*b.columns)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, name


def test_refresh_equals_a_full_build(spark, tmp_path):
    b, root = small_bronze(spark), str(tmp_path / "marts")
    hidden_team, hidden_venue = b.teams.first()["teamId"], b.venues.first()["venueId"]
    base = Bronze(b.fixtures, b.teams.filter(F.col("teamId") != hidden_team), b.venues.filter(F.col("venueId") != hidden_venue), b.team_stats, b.weather)
    assert_equal_to_a_build(refresh_tables(spark, root, base, None), base)
    files = lambda: {f: f.stat().st_mtime_ns for f in (tmp_path / "marts" / "fact_match").rglob("part-*")}
    built = files()

    # only weather and statistics of one old match
    some = sorted(r[0] for r in b.weather.select("eventId").distinct().collect())[:3]
    weather = later(b.weather.filter(F.col("eventId") == some[0]), rain=F.lit(77.0).cast("float"), precipitation=F.lit(77.0).cast("float"))
    stats = later(b.team_stats.filter(F.col("eventId") == some[0]), foulsCommitted="99.0")
    one = Bronze(base.fixtures, base.teams, base.venues, base.team_stats.unionByName(stats), base.weather.unionByName(weather))
    since = F.lit("2025-12-31").cast("timestamp_ntz")
    assert [str(r[0]) for r in affected_matches(one, since).collect()] == [some[0]]
    assert_equal_to_a_build(refresh_tables(spark, root, one, "2025-12-31"), one)
    assert len(built) == len(files()) and len(set(built.items()) - set(files().items())) == 1

    # a match moves to another month, one loses its kick-off, one is new; a team and a venue turn up
    moved = later(b.fixtures.filter(F.col("eventId") == some[1]), date="2031-05-05 15:00:00")
    undated = later(b.fixtures.filter(F.col("eventId") == some[2]), date="")
    new = later(b.fixtures.filter(F.col("eventId") == some[0]), eventId="987654321", date="2031-06-05 15:00:00")
    rest = Bronze(
        one.fixtures.unionByName(moved).unionByName(undated).unionByName(new),
        base.teams.unionByName(later(b.teams.filter(F.col("teamId") == hidden_team))),
        base.venues.unionByName(later(b.venues.filter(F.col("venueId") == hidden_venue))), one.team_stats, one.weather,
    )
    for _ in range(2):
        assert_equal_to_a_build(refresh_tables(spark, root, rest, "2025-12-31"), rest)
