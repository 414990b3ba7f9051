"""Bronze readers and loaders (ingest side of the pipeline).

Every function returns a lazy DataFrame; writes are separate calls in
``kickwx.plans.warehouse``. Nothing is collected to the driver.
"""

from __future__ import annotations

import logging
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kickwx.functions.casts import na_to_null
from kickwx.sources.schemas import (
    BRONZE_COLUMNS,
    DROP_FILES,
    INGESTION_TIME,
    WEATHER_VARIABLES,
    bronze_schema,
)

log = logging.getLogger(__name__)


class UnknownColumnError(ValueError):
    """A source file carries a column its bronze table does not declare."""


# --- file-system helpers (Hadoop FS: works for local, HDFS and object stores) ---

def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p))


def select_drop_files(spark: SparkSession, drop_dir: str, tables=None) -> dict[str, str]:
    """Table -> file path of a data drop; absent files are skipped with a warning."""
    out = {}
    for table, fname in DROP_FILES.items():
        if tables is not None and table not in tables:
            continue
        path = f"{drop_dir.rstrip('/')}/{fname}"
        if path_exists(spark, path):
            out[table] = path
        else:
            log.warning("skipping %s (not found)", fname)
    return out


# --- S1 / S3 / K11: CSV scan into the declared all-text bronze layout ---

def normalize_na(df: DataFrame, columns=None) -> DataFrame:
    """NA tokens -> NULL on every (or the given) text column, in one projection (S3)."""
    cols = set(columns or [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"])
    return df.select([na_to_null(F.col(c)).alias(c) if c in cols else F.col(c) for c in df.columns])


def conform_to_bronze(df: DataFrame, table: str, ingestion_time: Column | None = None) -> DataFrame:
    """Fit a text frame to the bronze table: unknown columns fail, missing ones are NULL.

    Stamps ``_ingestion_time`` (K2) unless the frame already carries it.
    """
    declared = BRONZE_COLUMNS[table]
    unknown = [c for c in df.columns if c not in declared and c != INGESTION_TIME]
    if unknown:
        raise UnknownColumnError(f"bronze_{table} has no column(s) {unknown}")
    present = set(df.columns)
    cols = [
        (F.col(c).cast("string") if c in present else F.lit(None).cast("string")).alias(c)
        for c in declared
    ]
    if INGESTION_TIME in present:
        ts = F.col(INGESTION_TIME).cast("timestamp_ntz")
    else:
        ts = ingestion_time if ingestion_time is not None else F.current_timestamp().cast("timestamp_ntz")
    return df.select(*cols, ts.alias(INGESTION_TIME))


def scan_csv(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """CSV with header, every field text, quotes doubled inside quoted fields; a malformed row fails the job.

    ``multi_line=True`` admits line breaks inside quoted fields. Such a file can't be split, so one task reads
    it whole; leave it off for files known to have none.
    """
    return (
        spark.read.option("header", True).option("inferSchema", False)
        .option("quote", '"').option("escape", '"')
        .option("multiLine", multi_line)
        .option("mode", "FAILFAST")
        .csv(path)
    )


def read_bronze_csv(spark: SparkSession, path: str, table: str, ingestion_time: Column | None = None,
                    multi_line: bool = False) -> DataFrame:
    """CSV drop file as bronze rows: text fields, NA tokens as NULL, stamped for append (S1+S3+K2)."""
    return conform_to_bronze(normalize_na(scan_csv(spark, path, multi_line)), table, ingestion_time)


def read_drop(spark: SparkSession, drop_dir: str, ingestion_time: Column | None = None,
              multi_line: bool = False) -> dict[str, DataFrame]:
    """All bronze tables of one data drop (S2 + S1)."""
    return {
        t: read_bronze_csv(spark, p, t, ingestion_time, multi_line)
        for t, p in select_drop_files(spark, drop_dir).items()
    }


def append_bronze(df: DataFrame, path: str, table: str, ingestion_time: Column | None = None) -> DataFrame:
    """Append rows to the bronze table at ``path``, created if absent, and return the table (K2, K3, K4).

    Rows are fitted to the declared layout and stamped unless they carry a load time. Appending a drop twice
    leaves two versions of its rows, which last-write-wins merges on read.
    """
    spark = df.sparkSession
    ensure_bronze_table(spark, path, table)
    if table == "weather":
        rows = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in bronze_schema(table)])
    else:
        rows = conform_to_bronze(df, table, ingestion_time)
    rows.write.mode("append").parquet(path)
    return spark.read.schema(bronze_schema(table)).parquet(path)


def append_drop(spark: SparkSession, drop_dir: str, bronze_root: str, ingestion_time: Column | None = None,
                multi_line: bool = False) -> dict[str, DataFrame]:
    """Append every file of a data drop to its bronze table under ``bronze_root`` (S2 + S1 + K2)."""
    drop = read_drop(spark, drop_dir, ingestion_time, multi_line)
    return {t: append_bronze(df, f"{bronze_root.rstrip('/')}/{t}", t) for t, df in drop.items()}


# --- K3: typed lake table -> text bronze rows ---

def stringify_fixtures(lake: DataFrame, load_time: datetime | Column | None = None) -> DataFrame:
    """``SELECT toString(c)..., NULL AS hasWeather, now()`` over the lake export of fixtures."""
    cols = BRONZE_COLUMNS["fixtures"]
    src = [c for c in cols if c != "hasWeather"]
    missing = [c for c in src if c not in lake.columns]
    if missing:
        raise UnknownColumnError(f"lake fixtures lack column(s) {missing}")
    if load_time is None:
        ts = F.current_timestamp().cast("timestamp_ntz")
    elif isinstance(load_time, Column):
        ts = load_time
    else:
        ts = F.lit(load_time).cast("timestamp_ntz")
    out = [F.col(c).cast("string").alias(c) for c in src]
    out.insert(cols.index("hasWeather"), F.lit(None).cast("string").alias("hasWeather"))
    return lake.select(*out, ts.alias(INGESTION_TIME))


# --- S4 / S5 / S6: lake reads ---

def scan_parquet(spark: SparkSession, path: str, view: str | None = None) -> DataFrame:
    """Parquet scan, optionally registered as a read-only temp view."""
    df = spark.read.parquet(path)
    if view:
        df.createOrReplaceTempView(view)
    return df


def table_exists(spark: SparkSession, name: str) -> bool:
    try:
        return bool(spark.catalog.tableExists(name))
    except Exception:  # catalog not configured
        return False


def load_or_create_lake_table(spark: SparkSession, name: str, table: str) -> DataFrame:
    """Catalog table with the all-text schema; created empty when absent."""
    if not table_exists(spark, name):
        schema = bronze_schema(table)
        spark.createDataFrame([], schema).write.format("parquet").mode("ignore").saveAsTable(name)
    return spark.table(name)


def read_lake_or_csv(spark: SparkSession, table: str, lake: str | None, csv_path: str | None,
                     ingestion_time: Column | None = None, multi_line: bool = False) -> DataFrame | None:
    """Prefer the lake table/path, fall back to the CSV file (``multi_line`` as in ``scan_csv``), else None."""
    if lake:
        if table_exists(spark, lake):
            return conform_to_bronze(spark.table(lake), table, ingestion_time)
        if path_exists(spark, lake):
            return conform_to_bronze(spark.read.parquet(lake), table, ingestion_time)
    if csv_path and path_exists(spark, csv_path):
        return read_bronze_csv(spark, csv_path, table, ingestion_time, multi_line)
    log.warning("no source for bronze_%s", table)
    return None


# --- S7 + K4: weather API payload -> typed hourly bronze rows ---

def _nan_to_null(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def unnest_hourly(payload: DataFrame) -> DataFrame:
    """One row per hour of each payload: [start, end) stepped by interval (S7), typed as K4.

    The hourly timestamps come from ``sequence``; value arrays are zipped
    positionally and NaN readings become NULL. An array that is not as long as the
    hours fails the job; a NULL array gives NULL readings. Rows carry the payload's
    ``_ingestion_time``, or the present time. Pure per-row work: no shuffle.
    """
    stamp = F.col(INGESTION_TIME) if INGESTION_TIME in payload.columns else F.current_timestamp()
    hours = F.sequence(
        F.col("start_ts"),
        F.timestamp_add("SECOND", -F.col("interval_s"), F.col("end_ts")),
        F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("interval_s")),
    )
    def fitting(v: str) -> Column:
        wrong = F.size(v) != F.size(hours)
        text = F.concat(F.lit("payload of event "), F.col("eventId"), F.lit(f": {v} does not have one reading per hour"))
        return F.when(F.col(v).isNotNull() & wrong, F.raise_error(text)).otherwise(F.col(v)).alias(v)

    zipped = F.arrays_zip(hours.alias("timestamp_utc"), *[fitting(v) for v in WEATHER_VARIABLES])
    exploded = payload.select(
        "eventId", "date", "latitude", "longitude", stamp.cast("timestamp_ntz").alias(INGESTION_TIME), F.inline(zipped)
    )
    return exploded.select(
        F.col("eventId").cast("string").alias("eventId"),
        F.col("date").cast("date").alias("date"),
        F.col("timestamp_utc").cast("timestamp_ntz").alias("timestamp_utc"),
        F.col("latitude").cast("double").alias("latitude"),
        F.col("longitude").cast("double").alias("longitude"),
        *[_nan_to_null(F.col(v)).cast("float").alias(v) for v in WEATHER_VARIABLES],
        INGESTION_TIME,
    )


# --- K1 / K11: lake export and declared empty tables ---

def export_csv_to_parquet(spark: SparkSession, csv_path: str, out_path: str, multi_line: bool = False) -> str:
    """CSV drop file -> parquet with one text field per CSV column (K1), written as a whole."""
    normalize_na(scan_csv(spark, csv_path, multi_line)).write.mode("overwrite").parquet(out_path)
    return out_path


def ensure_bronze_table(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Create the bronze table at ``path`` with its declared schema when absent (K11); return it."""
    if not path_exists(spark, path):
        spark.createDataFrame([], bronze_schema(table)).write.parquet(path)
    return spark.read.schema(bronze_schema(table)).parquet(path)
