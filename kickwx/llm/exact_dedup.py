"""Exact deduplication by distributed MSD radix partitioning."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kickwx.llm.scratch import written

TO_END = 2**31 - 1


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    first_digit: int = 128,
    growth: int = 8,
) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Documents are split by successive bytes of their UTF-8 text. The first digit is ``first_digit``
    bytes wide and each next one ``growth`` times wider, so a text of n bytes takes O(log n) rounds.
    A group is done when it is a singleton or all its texts have ended; equality follows from the bytes
    themselves (the SHA-256 is only reported). Only documents that share a first digit carry their
    text into later rounds, each of which is one written table.

    Groups are counted with map-side combining, written, and joined back to the rows by joins whose
    row side adaptive execution may split, so a hot group never meets in one task.

    Defined cases: a null text counts as empty; all empty texts are equal. Of equal texts the largest
    id stays (a null id is smaller than any other); of repeated rows with that same id exactly one has
    ``kept``. Empty input gives no rows. Other columns are ignored.
    """
    body = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    base = docs.select(F.col(id_col).alias("doc_id"), body.alias("rest"))
    heads = base.select(
        "doc_id", "rest",
        F.sha2("rest", 256).alias("text_sha256"),
        F.substring("rest", 1, first_digit).alias("digit"),
        (F.length("rest") <= first_digit).alias("ended"),
    )
    crowded = written(
        heads.groupBy("digit", "ended").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("digit", "ended"),
        "radix-heads",
    )
    alone = heads.join(crowded, ["digit", "ended"], "left_anti").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), "text_sha256",
    )
    active = written(
        heads.join(crowded, ["digit", "ended"], "left_semi").select(
            F.monotonically_increasing_id().alias("row"), "doc_id", "text_sha256",
            F.col("digit").alias("node"), F.substring("rest", first_digit + 1, TO_END).alias("rest"),
        ),
        "radix-0",
    )
    done, width, level = [alone], first_digit * growth, 1
    while not active.isEmpty():
        split = active.select(
            "row", "doc_id", "text_sha256", "node",
            F.substring("rest", 1, width).alias("digit"),
            (F.length("rest") <= width).alias("ended"),
            F.substring("rest", width + 1, TO_END).alias("rest"),
        )
        groups = written(
            split.groupBy("node", "digit", "ended").agg(
                F.count(F.lit(1)).alias("group_size"),
                F.max("doc_id").alias("keep_id"),
                F.coalesce(F.max_by("row", "doc_id"), F.min("row")).alias("keep_row"),
                F.min("row").alias("child"),
            ),
            f"radix-groups-{level}",
        )
        open_ = ~F.col("ended") & (F.col("group_size") > 1)
        parted = written(
            split.join(groups, ["node", "digit", "ended"]).select(
                "row", "doc_id", "text_sha256", "keep_id", "group_size", "keep_row",
                open_.alias("open"),
                F.when(open_, F.col("child").cast("string").cast("binary")).alias("node"),
                F.when(open_, F.col("rest")).alias("rest"),
            ),
            f"radix-{level}",
        )
        done.append(
            parted.filter(~F.col("open")).select(
                "doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), "text_sha256"
            )
        )
        active = parted.filter("open").select("row", "doc_id", "text_sha256", "node", "rest")
        width, level = min(width * growth, TO_END // growth), level + 1
    return reduce(DataFrame.unionByName, done)
