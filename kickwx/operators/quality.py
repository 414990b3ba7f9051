"""Data-quality checks over the marts: each returns failing rows or counts (zero = pass)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unique_violations(df: DataFrame, key: str) -> DataFrame:
    """Key values that occur more than once, with their count (NULL keys are not checked)."""
    return (
        df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))
        .filter(F.col("n_rows") > 1)
    )


def null_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row: NULL count of every listed column, all in a single pass."""
    return df.agg(*[F.sum(F.when(F.col(c).isNull(), 1).otherwise(0)).cast("bigint").alias(c) for c in cols])


def relationship_violations(df: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Rows whose non-NULL foreign key has no parent row."""
    p = parent.select(F.col(pk).alias(fk)).distinct()
    return df.filter(F.col(fk).isNotNull()).join(p, fk, "left_anti")


def negative_values(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col) < 0)


def orphan_sides(rows: DataFrame, id_col: str, fks: Sequence[str], parent: DataFrame, pk: str) -> DataFrame:
    """Rows (``check, <id_col>``) whose non-NULL foreign key, in any of ``fks``, has no parent row.

    The keys are unpivoted, so that one anti-join answers for all of them.
    """
    sides = F.array(*[F.struct(F.lit(fk).alias("check"), F.col(fk).alias("__fk")) for fk in fks])
    long = rows.select(id_col, F.inline(sides)).filter(F.col("__fk").isNotNull())
    p = parent.select(F.col(pk).alias("__fk")).distinct()
    return long.join(p, "__fk", "left_anti").select("check", id_col)


def summary(checks: dict[str, DataFrame]) -> DataFrame:
    """(check, failing_rows) for several row-returning checks."""
    parts = [d.agg(F.count(F.lit(1)).alias("failing_rows")).select(F.lit(n).alias("check"), "failing_rows")
             for n, d in checks.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Column profile in one aggregation: rows, NULLs, min, max (as text) and approximate distinct count
    (relative standard deviation 5 %)."""
    cols = list(cols or df.columns)
    aggs = [F.count(F.lit(1)).alias("__rows")]
    for i, c in enumerate(cols):
        x = F.col(c)
        aggs += [
            F.sum(F.when(x.isNull(), 1).otherwise(0)).cast("bigint").alias(f"n{i}"),
            F.min(x).cast("string").alias(f"lo{i}"),
            F.max(x).cast("string").alias(f"hi{i}"),
            F.approx_count_distinct(x).alias(f"d{i}"),
        ]
    wide = df.agg(*aggs)
    rows = F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col("__rows").alias("row_count"), F.col(f"n{i}").alias("null_count"),
                 F.col(f"lo{i}").alias("min_value"), F.col(f"hi{i}").alias("max_value"),
                 F.col(f"d{i}").alias("approx_distinct"))
        for i, c in enumerate(cols)
    ])
    return wide.select(F.inline(rows))
