from decimal import Decimal

from pyspark.sql import functions as F

from kickwx.functions import buckets as B
from kickwx.functions.casts import start_of_hour, to_decimal_5_2_trunc, to_int, to_int_via_double, trimmed_or_null
from kickwx.functions.keys import hash_key, published_key
from kickwx.functions.masks import attendance_band, goal_range


def one(spark, expr, value, ddl="x string"):
    return spark.createDataFrame([(value,)], ddl).select(expr.alias("y")).first()["y"]


def test_half_md5_key(spark):
    assert one(spark, published_key(hash_key(F.col("x"))), "1234") == Decimal(9357525492058574274)
    assert one(spark, hash_key(F.col("x")), "1234") == -9089218581650977342
    assert one(spark, hash_key(F.col("x"), F.lit("a")), None) is None


def test_key_parts_joined_by_bar(spark):
    a = one(spark, hash_key(F.col("x"), F.lit(7)), "2001-01-01 15:00:00")
    b = one(spark, hash_key(F.lit("2001-01-01 15:00:00|7")), "ignored")
    assert a == b


def test_casts(spark):
    assert one(spark, to_int_via_double(F.col("x")), "6.0") == 6
    assert one(spark, to_int_via_double(F.col("x")), "6.9") == 6
    assert one(spark, to_int_via_double(F.col("x")), "") is None
    assert one(spark, to_int(F.col("x")), "abc") is None
    assert one(spark, to_decimal_5_2_trunc(F.col("x")), "55.345") == Decimal("55.34")
    assert one(spark, trimmed_or_null(F.col("x")), "   ") is None
    assert one(spark, trimmed_or_null(F.col("x")), "  ab ") == "ab"


def test_half_even_rounding(spark):
    assert one(spark, F.bround(F.col("x"), 0), 2.5, "x double") == 2.0
    assert one(spark, F.bround(F.col("x"), 3), 0.0125, "x double") == 0.012


def test_masks(spark):
    for g, label in [(0, "0-1"), (1, "0-1"), (2, "2-3"), (5, "4-5"), (None, None)]:
        assert one(spark, goal_range(F.col("x")), g, "x int") == label
    for a, label in [(9, "0-10"), (10, "10-100"), (999, "100-1000"), (1000, "1000-10 000"),
                     (10000, "10 000-100 000"), (100000, "100 000+"), (None, None)]:
        assert one(spark, attendance_band(F.col("x")), a, "x int") == label


def test_bucket_edges(spark):
    lead = lambda e, v: one(spark, e(F.col("x")), v, "x double")[0]
    for v, d in [(0.19, "1"), (0.2, "2"), (2.5, "3"), (7.6, "4"), (None, "1")]:
        assert lead(B.rain_category, v) == d
    for v, d in [(4.9, "1"), (5.0, "2"), (29.9, "2"), (30.0, "3"), (None, "2")]:
        assert lead(B.temperature_category, v) == d
    for v, d in [(19.9, "3"), (20.0, "2"), (36.0, "1"), (None, "3")]:
        assert lead(B.wind_category, v) == d


def test_shootout_category(spark):
    df = spark.createDataFrame([(7.6, 10.0), (7.7, 10.0), (1.0, 25.0), (1.0, 5.0)], "p double, t double")
    got = [r[0] for r in df.select(B.shootout_weather_category(F.col("p"), F.col("t"))).collect()]
    assert got == [B.SHOOTOUT_NORMAL, B.SHOOTOUT_EXTREME, B.SHOOTOUT_EXTREME, B.SHOOTOUT_NORMAL]


def test_start_of_hour_ignores_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
        df = spark.sql("select timestamp_ntz'2001-03-04 15:45:10' as ts")
        assert str(df.select(start_of_hour(F.col("ts"))).first()[0]) == "2001-03-04 15:00:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
