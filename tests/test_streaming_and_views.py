import subprocess
import sys
from datetime import date, datetime, timedelta

from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, TimestampNTZType

from kickwx.operators.asof import select_ranks, select_window
from kickwx.plans import analytics as A
from kickwx.plans.views import register_views
from kickwx.sources.bronze import ensure_bronze_table, export_csv_to_parquet
from kickwx.sources.schemas import PAYLOAD_SCHEMA, WEATHER_VARIABLES
from kickwx.streaming.payload_ingest import ingest_available_payloads, upsert_available_payloads, upsert_payloads


def payload_rows(ids, day=datetime(2001, 1, 1)):
    vals = [[float(h) for h in range(24)] for _ in WEATHER_VARIABLES]
    return [(str(i), day.date(), 1.0, 2.0, day, day + timedelta(days=1), 3600, *vals) for i in ids]


def test_stream_ingests_each_payload_file_once(spark, tmp_path):
    landing, out, ckpt = str(tmp_path / "landing"), str(tmp_path / "weather"), str(tmp_path / "ckpt")
    spark.createDataFrame(payload_rows([1, 2]), PAYLOAD_SCHEMA).write.mode("append").parquet(landing)
    ingest_available_payloads(spark, landing, out, ckpt)
    assert spark.read.parquet(out).count() == 48
    spark.createDataFrame(payload_rows([3]), PAYLOAD_SCHEMA).write.mode("append").parquet(landing)
    ingest_available_payloads(spark, landing, out, ckpt)
    w = spark.read.parquet(out)
    assert w.count() == 72 and w.select("eventId").distinct().count() == 3


def loaded(rows, hour, shift=0.0):
    """Payload rows with a load time and readings moved by ``shift``."""
    rows = [(*r[:7], *[[v + shift for v in values] for values in r[7:]]) for r in rows]
    return [(*r, datetime(2001, 6, 1, hour)) for r in rows]


def test_stream_keeps_the_last_fetch_of_every_hour(spark, tmp_path):
    landing, out = str(tmp_path / "landing"), str(tmp_path / "weather")
    schema = StructType([*PAYLOAD_SCHEMA.fields, StructField("_ingestion_time", TimestampNTZType())])
    february = datetime(2001, 2, 3)

    def land(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(landing)
        upsert_available_payloads(spark, landing, out, schema=schema)
        files = {p: p.stat().st_mtime_ns for p in (tmp_path / "weather").rglob("*.parquet")}
        return {(r.eventId, r.timestamp_utc.hour): r.rain for r in read(spark, out).collect()}, files

    read = lambda s, path: s.read.parquet(path)
    got, _ = land(loaded(payload_rows([1, 2]), 5) + loaded(payload_rows([3], february), 5) + loaded(payload_rows([2]), 4, 70.0))
    assert len(got) == 72 and read(spark, out).count() == 72 and got["2", 7] == 7.0
    got, before = land(loaded(payload_rows([1]), 8, 100.0))  # fetched again
    assert len(got) == 72 and read(spark, out).count() == 72 and got["1", 7] == 107.0 and got["2", 7] == 7.0
    got, after = land(loaded(payload_rows([1]), 6, 50.0))  # an older fetch that lands late
    assert len(got) == 72 and read(spark, out).count() == 72 and got["1", 7] == 107.0
    assert len(before) == len(after) == 2
    untouched = [p for p in before if before[p] == after.get(p)]
    assert len(untouched) == 1 and "2001-02" in str(untouched[0])  # only the batch's month is written
    again = spark.createDataFrame(loaded(payload_rows([1]), 8, 100.0) + loaded(payload_rows([2]), 9, 1.0), schema)
    for _ in range(2):  # a batch that a failure repeats
        table = upsert_payloads(again, out, str(tmp_path / "staging"))
        rows = {(r.eventId, r.timestamp_utc.hour): r.rain for r in table.collect()}
        assert table.count() == 72 and rows["1", 7] == 107.0 and rows["2", 7] == 8.0
    assert upsert_payloads(again.limit(0), out, str(tmp_path / "staging")).count() == 72


def test_applied_payloads_leave_no_staged_rows_and_are_exchanged_once_with_the_table(spark, tmp_path, monkeypatch):
    from pyspark.sql import DataFrame, DataFrameWriter
    writes, joins = [], []
    plain_write, plain_join = DataFrameWriter.parquet, DataFrame.join
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, path, *a, **k: (writes.append(path), plain_write(self, path, *a, **k))[1])
    monkeypatch.setattr(DataFrame, "join", lambda self, *a, **k: (joins.append(a), plain_join(self, *a, **k))[1])
    schema = StructType([*PAYLOAD_SCHEMA.fields, StructField("_ingestion_time", TimestampNTZType())])
    out, staging = str(tmp_path / "weather"), tmp_path / "staging"
    for day, extra, rain in ((5, 0.0, 7.0), (8, 100.0, 107.0), (6, 50.0, 107.0)):  # an older fetch comes last
        table = upsert_payloads(spark.createDataFrame(loaded(payload_rows([1]), day, extra), schema), out, str(staging))
        assert {r.timestamp_utc.hour: r.rain for r in table.collect()}[7] == rain and table.count() == 24
    assert len(writes) == 6 and not joins and not staging.exists()  # of each batch its hours, and the folders they change


SESSION = """
import sys
from pyspark.sql import SparkSession
sys.path[:0] = {path!r}
from kickwx.sources.schemas import PAYLOAD_SCHEMA
from kickwx.streaming.payload_ingest import ingest_available_payloads
from tests.test_streaming_and_views import payload_rows
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.checkpoint.dir", {root!r} + "/shared").getOrCreate())
spark.createDataFrame(payload_rows([{match}]), PAYLOAD_SCHEMA).write.mode("append").parquet({root!r} + "/landing")
ingest_available_payloads(spark, {root!r} + "/landing", {root!r} + "/weather")
"""


def test_payloads_landed_between_two_sessions_are_all_ingested(spark, tmp_path):
    for match in (1, 2):  # a Spark context of its own for each
        code = SESSION.format(path=sys.path, root=str(tmp_path), match=match)
        subprocess.run([sys.executable, "-c", code], check=True, timeout=240, capture_output=True)
    assert spark.read.parquet(str(tmp_path / "weather")).count() == 48


def test_views_answer_sql_like_dataframes(spark, marts_small):
    register_views(spark, marts_small, prefix="t_")
    sql = spark.sql("""
        SELECT CASE WHEN w.avg_precipitation >= 7.6 THEN '4' WHEN w.avg_precipitation >= 2.5 THEN '3'
                    WHEN w.avg_precipitation >= 0.2 THEN '2' ELSE '1' END AS c, count(fm.match_id) AS n
        FROM t_fact_match fm JOIN t_dim_weather w ON fm.weather_key = w.weather_key GROUP BY 1""")
    got = {r.c: r.n for r in sql.collect()}
    df = {r.rain_category[0]: r.total_matches for r in A.home_win_rain(marts_small).collect()}
    assert got == df


def test_ranks_form_equals_window_form(spark):
    from tests.test_asof import DAY
    import random
    rnd = random.Random(11)
    obs, kicks = [], []
    for e in range(150):
        base = DAY + timedelta(minutes=rnd.randint(0, 300))
        times = sorted({base + timedelta(minutes=30 * rnd.randint(0, 30)) for _ in range(rnd.randint(1, 10))})
        kicks.append((e, DAY + timedelta(minutes=15 * rnd.randint(0, 90))))
        obs += [(e, t, 0.0) for t in times]
    w = spark.createDataFrame(obs, "event_id int, weather_datetime timestamp_ntz, v double")
    k = spark.createDataFrame(kicks, "event_id int, match_datetime timestamp_ntz")
    key = lambda df: sorted((r.event_id, r.weather_datetime) for r in df.collect())
    assert key(select_ranks(w, k)) == key(select_window(w, k))


def test_csv_export_and_empty_bronze(spark, tmp_path):
    p = tmp_path / "fixtures.csv"
    p.write_text("eventId,date\n1,2001-01-01 15:00:00\n2,NA\n")
    out = export_csv_to_parquet(spark, str(p), str(tmp_path / "lake"))
    rows = {r.eventId: r.date for r in spark.read.parquet(out).collect()}
    assert rows == {"1": "2001-01-01 15:00:00", "2": None}
    t = ensure_bronze_table(spark, str(tmp_path / "bronze_teams"), "teams")
    assert t.count() == 0 and t.columns[0] == "teamId" and t.columns[-1] == "_ingestion_time"
