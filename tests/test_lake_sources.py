from pyspark.sql import functions as F

from kickwx.sources.bronze import load_or_create_lake_table, read_lake_or_csv, select_drop_files


def test_drop_files_skip_missing(spark, tmp_path):
    (tmp_path / "fixtures.csv").write_text("eventId\n1\n")
    (tmp_path / "teams.csv").write_text("teamId\n1\n")
    found = select_drop_files(spark, str(tmp_path))
    assert set(found) == {"fixtures", "teams"}


def test_lake_table_created_with_text_schema(spark):
    t = load_or_create_lake_table(spark, "lake_venues_test", "venues")
    assert t.count() == 0 and dict(t.dtypes)["latitude"] == "string"
    spark.createDataFrame([("9", "X")], "venueId string, fullName string").select(
        "venueId", "fullName", *[F.lit(None).cast("string").alias(c) for c in
                                 ["shortName", "capacity", "city", "country", "latitude", "longitude"]],
        F.current_timestamp().cast("timestamp_ntz").alias("_ingestion_time"),
    ).write.insertInto("lake_venues_test")
    assert load_or_create_lake_table(spark, "lake_venues_test", "venues").count() == 1


def test_lake_or_csv_fallback(spark, tmp_path):
    csv = tmp_path / "venues.csv"
    csv.write_text("venueId,city\n1,Lima\n")
    lake = str(tmp_path / "lake_venues")
    from_csv = read_lake_or_csv(spark, "venues", lake, str(csv))
    assert [r.city for r in from_csv.collect()] == ["Lima"]
    from_csv.write.parquet(lake)
    spark.read.parquet(lake).filter("false").write.mode("append").parquet(lake)
    from_lake = read_lake_or_csv(spark, "venues", lake, None)
    assert [r.venueId for r in from_lake.collect()] == ["1"]
    assert read_lake_or_csv(spark, "venues", str(tmp_path / "nope"), str(tmp_path / "nope.csv")) is None
