"""Last-write-wins by key (the reference's replacing merge tables, read as FINAL)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kickwx.sources.schemas import INGESTION_TIME


def latest_by_key(
    df: DataFrame,
    keys: Sequence[str],
    version: str | None = INGESTION_TIME,
    tie_break: Sequence[str] | None = None,
) -> DataFrame:
    """Keep the newest row per key.

    ``row_number() = 1`` over (keys, version DESC) plans a partial
    ``WindowGroupLimit`` before the shuffle, so every map task forwards at
    most one row per key: a key holding a large share of the rows is cut down
    before it is shuffled. Ties on the version (rows of one load) go to the
    smallest values of the ``tie_break`` columns in order, NULLs last; by default
    these are all other columns, so equal rows are the only ties left.
    """
    versioned = version is not None and version in df.columns
    others = [c for c in df.columns if c not in keys and c != version] if tie_break is None else tie_break
    order = ([F.col(version).desc_nulls_last()] if versioned else []) + [F.col(c).asc_nulls_last() for c in others]
    w = Window.partitionBy(*[F.col(k) for k in keys]).orderBy(*(order or [F.lit(1)]))
    rn = "__rn"
    return df.withColumn(rn, F.row_number().over(w)).filter(F.col(rn) == 1).drop(rn)
