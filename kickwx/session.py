"""Session helpers: the configuration the jobs are written against."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the plans rely on. AQE re-plans joins from runtime sizes, coalesces
# small shuffle partitions and splits skewed join partitions.
SESSION_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "kickwx") -> SparkSession:
    """Local session for tests and the bench; on a cluster the launcher owns these."""
    scratch = tempfile.mkdtemp(prefix="kickwx-local-")
    builder = (
        SparkSession.builder.master(master)
        .config("spark.sql.warehouse.dir", f"{scratch}/warehouse")
        .config("spark.checkpoint.dir", f"{scratch}/shared")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("KICKWX_DRIVER_MEMORY", "16g"))
    )
    for k, v in SESSION_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def output_root(spark: SparkSession) -> str:
    """Folder for written tables and stream state, the same in every session of a cluster.

    ``spark.kickwx.root`` if set, else the shared folder named in ``spark.checkpoint.dir`` itself (not the
    per-session folder that Spark makes below it). Only a local master may do without: it gets a
    private scratch folder.
    """
    root = spark.conf.get("spark.kickwx.root", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.kickwx.root or spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="kickwx-local-")
        spark.conf.set("spark.kickwx.root", root)
    return root.rstrip("/")
