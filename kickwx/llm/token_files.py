"""Token-id files: one wavelet matrix per shard, in ascending document order."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from kickwx.llm import wavelet
from kickwx.llm.batches import slices
from kickwx.llm.encode import encoder


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = 2,
    shard_tokens: int = 1_000_000,
) -> None:
    """Encode every text, append ``end_id`` and write the ids as wavelet files in ascending id order.

    Rows are range-partitioned by (id, hash of the text), sorted within each partition and cut into shards
    of about ``shard_tokens`` ids (a longer document is a shard of its own). A shard is one row of the
    Parquet table at ``path``: ``part, shard, n_tokens, doc_ids, file``, where ``file`` is the compressed
    wavelet file (see :mod:`kickwx.llm.wavelet`), so any store that Spark writes to can hold it.

    Defined cases: a null text is empty, so has ``end_id`` alone; null ids come first; rows that repeat
    an id stand side by side, in the order of their texts' hashes; empty input writes an empty table.
    """
    schema = T.StructType([
        T.StructField("part", T.IntegerType()), T.StructField("shard", T.IntegerType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("doc_ids", T.ArrayType(docs.schema[id_col].dataType)), T.StructField("file", T.BinaryType()),
    ])
    out = to_arrow_schema(schema)

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, part = encoder(tokenizer_path), TaskContext.get().partitionId()
        doc_ids: list = []
        tokens: list[np.ndarray] = []
        sizes: list[int] = []
        total = made = 0

        def shard() -> pa.RecordBatch:
            file = wavelet.dump(np.concatenate(tokens), np.cumsum(sizes))
            row = [[part], [made], [total], [doc_ids], [file]]
            return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(row, out)], schema=out)

        for some in slices(batches, "text", 8 << 20, keeps=True):
            ids, n = code.encode(some.column("text"))
            ids = np.insert(ids, np.cumsum(n), end_id)
            names, n = some.column("doc_id").to_pylist(), n + 1
            ends = np.cumsum(n)
            first = 0
            while first < len(n):  # documents up to the one that fills the shard
                start = int(ends[first - 1]) if first else 0
                stop = min(len(n), 1 + int(np.searchsorted(ends, start + shard_tokens - total)))
                end = int(ends[stop - 1])
                doc_ids += names[first:stop]
                tokens.append(ids[start:end])
                sizes += n[first:stop].tolist()
                total += end - start
                first = stop
                if total >= shard_tokens:
                    yield shard()
                    doc_ids, tokens, sizes, total, made = [], [], [], 0, made + 1
        if sizes:
            yield shard()

    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    order = ["doc_id", F.xxhash64("text")]
    rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(shards, schema).write.parquet(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per document, read back from the files: ``doc_id, start, n_tokens, ids``.

    ``start`` is the number of ids before the document in ascending order; ``ids`` are little-endian unsigned
    32-bit integers. Starts come from the shards' sizes alone: a running sum within each part
    and one over the parts.
    """
    files = spark.read.parquet(path)
    sizes = files.select("part", "shard", "n_tokens")
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("part_tokens"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per output task
    parts = parts.select("part", F.coalesce(F.sum("part_tokens").over(before), F.lit(0)).alias("part_start"))
    within = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("shard_start", F.coalesce(F.sum("n_tokens").over(within), F.lit(0))).join(parts, "part").select(
        "part", "shard", (F.col("part_start") + F.col("shard_start")).alias("shard_start")
    )
    schema = T.StructType([
        T.StructField("doc_id", files.schema["doc_ids"].dataType.elementType), T.StructField("start", T.LongType()),
        T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType()),
    ])
    out = to_arrow_schema(schema)

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                matrix, ends = wavelet.load(batch.column("file")[i].as_py())
                raw = pa.py_buffer(matrix.all().astype("<u4").tobytes())
                ends = ends.astype(np.int64)
                starts = np.concatenate(([0], ends[:-1]))
                ids = pa.Array.from_buffers(
                    pa.large_binary(), len(ends),
                    [None, pa.py_buffer(np.concatenate(([0], 4 * ends)).astype(np.int64).tobytes()), raw],
                ).cast(pa.binary())
                columns = [
                    batch.column("doc_ids")[i].values, pa.array(starts + batch.column("shard_start")[i].as_py()),
                    pa.array(ends - starts), ids,
                ]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, out)], schema=out)

    return files.join(starts, ["part", "shard"]).select("doc_ids", "file", "shard_start").mapInArrow(documents, schema)

