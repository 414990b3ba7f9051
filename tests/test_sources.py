import math
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from kickwx.operators.dedup import latest_by_key
from kickwx.sources.bronze import (
    UnknownColumnError, append_bronze, append_drop, ensure_bronze_table, read_bronze_csv, read_lake_or_csv, stringify_fixtures, unnest_hourly)
from kickwx.sources.schemas import FIXTURES_COLUMNS, INGESTION_TIME, PAYLOAD_SCHEMA, WEATHER_VARIABLES


def test_csv_bronze_na_tokens_and_missing_columns(spark, tmp_path):
    p = tmp_path / "venues.csv"
    p.write_text("venueId,fullName,city,latitude\n1,Arena,NA,\n2,Park,None,1.5\n3,null,Lima,n/a\n")
    df = read_bronze_csv(spark, str(p), "venues", F.lit("2025-01-01 00:00:00").cast("timestamp_ntz"))
    rows = {r.venueId: r for r in df.collect()}
    assert rows["1"].city is None and rows["1"].latitude is None
    assert rows["2"].city is None and rows["2"].latitude == "1.5"
    assert rows["3"].fullName is None and rows["3"].latitude is None
    assert rows["1"].country is None  # column absent from the file
    assert df.columns[-1] == "_ingestion_time"


def test_csv_unknown_column_fails(spark, tmp_path):
    p = tmp_path / "teams.csv"
    p.write_text("teamId,bogus\n1,x\n")
    with pytest.raises(UnknownColumnError):
        read_bronze_csv(spark, str(p), "teams")


def test_unnest_hourly_left_inclusive_and_nan(spark):
    start, end = datetime(2001, 1, 1), datetime(2001, 1, 2)
    arrays = {v: [float(h) for h in range(24)] for v in WEATHER_VARIABLES}
    arrays["temperature_2m"][3] = math.nan
    row = ("7", date(2001, 1, 1), 1.0, 2.0, start, end, 3600, *[arrays[v] for v in WEATHER_VARIABLES])
    out = unnest_hourly(spark.createDataFrame([row], PAYLOAD_SCHEMA)).orderBy("timestamp_utc").collect()
    assert len(out) == 24
    assert out[0].timestamp_utc == start and out[-1].timestamp_utc == datetime(2001, 1, 1, 23)
    assert out[3].temperature_2m is None and out[4].temperature_2m == 4.0


def test_unnest_hourly_refuses_arrays_of_another_length(spark):
    start, end = datetime(2001, 1, 1), datetime(2001, 1, 2)
    arrays = [[0.0] * (25 if v == "rain" else 24) for v in WEATHER_VARIABLES]
    row = ("7", date(2001, 1, 1), 1.0, 2.0, start, end, 3600, *arrays)
    with pytest.raises(Exception, match="rain does not have one reading per hour"):
        unnest_hourly(spark.createDataFrame([row], PAYLOAD_SCHEMA)).collect()


def test_csv_quotes_commas_and_line_breaks(spark, tmp_path):
    p = tmp_path / "venues.csv"
    p.write_text('venueId,fullName,city\n1,"The ""Den"" Park, North",London\n2,"Two\nLines",Paris\n')
    rows = {r.venueId: (r.fullName, r.city) for r in read_bronze_csv(spark, str(p), "venues", multi_line=True).collect()}
    assert rows == {"1": ('The "Den" Park, North', "London"), "2": ("Two\nLines", "Paris")}


def test_malformed_csv_row_fails(spark, tmp_path):
    p = tmp_path / "venues.csv"
    p.write_text("venueId,fullName\n1,A\n2,B,extra\n")
    with pytest.raises(Exception):
        read_bronze_csv(spark, str(p), "venues").collect()


def test_two_drops_appended_to_bronze(spark, tmp_path):
    for day, name in ((1, "Old"), (2, "New")):
        drop = tmp_path / f"drop{day}"
        drop.mkdir()
        (drop / "venues.csv").write_text(f"venueId,fullName\n1,{name}\n{day + 1},Other\n")
        tables = append_drop(spark, str(drop), str(tmp_path / "bronze"), F.lit(f"2025-01-0{day}").cast("timestamp_ntz"))
    assert list(tables) == ["venues"] and tables["venues"].count() == 4
    latest = {r.venueId: r.fullName for r in latest_by_key(tables["venues"], ["venueId"]).collect()}
    assert latest == {"1": "New", "2": "Other", "3": "Other"}


def test_weather_bronze_table(spark, tmp_path):
    path = str(tmp_path / "weather")
    assert ensure_bronze_table(spark, path, "weather").count() == 0
    start, end = datetime(2001, 1, 1), datetime(2001, 1, 2)
    row = ("7", date(2001, 1, 1), 1.0, 2.0, start, end, 3600, *[[0.0] * 24 for _ in WEATHER_VARIABLES])
    hourly = unnest_hourly(spark.createDataFrame([row], PAYLOAD_SCHEMA))
    assert append_bronze(hourly, path, "weather").count() == 24
    assert append_bronze(hourly, path, "weather").count() == 48  # fetched again: another version
    assert latest_by_key(spark.read.parquet(path), ["eventId", "timestamp_utc"]).count() == 24


def test_stringify_fixtures(spark):
    lake = spark.createDataFrame([tuple(range(len(FIXTURES_COLUMNS) - 1))],
                                 ", ".join(f"{c} int" for c in FIXTURES_COLUMNS if c != "hasWeather"))
    out = stringify_fixtures(lake, datetime(2025, 1, 1)).first()
    assert out.eventId == "3" and out.hasWeather is None and out._ingestion_time == datetime(2025, 1, 1)


def test_csv_fallback_takes_quoted_line_breaks(spark, tmp_path):
    path = tmp_path / "venues.csv"
    path.write_text('venueId,fullName\n1,"North\nStand"\n2,South\n')
    rows = read_lake_or_csv(spark, "venues", str(tmp_path / "absent"), str(path), multi_line=True)
    assert {(r.venueId, r.fullName) for r in rows.collect()} == {("1", "North\nStand"), ("2", "South")}


def test_default_stamp_is_the_time_of_the_read(spark, tmp_path):
    path = tmp_path / "venues.csv"
    path.write_text("venueId,fullName\n1,North\n")
    clock = lambda: spark.sql("SELECT current_timestamp()::timestamp_ntz AS t").first().t
    before = clock()
    stamp = read_bronze_csv(spark, str(path), "venues").first()[INGESTION_TIME]
    assert before <= stamp <= clock()
