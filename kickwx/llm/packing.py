"""Sum-of-squares packing of tokenized documents into fixed-length sequences."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from kickwx.llm.batches import slices
from kickwx.llm.encode import encoder
from kickwx.llm.scratch import written

Piece = tuple[object, int, int, np.ndarray]  # id, piece number, start, token ids


def place(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length, longest first.

    With N(g) open bins of residual gap g, a length s goes to the gap whose bin change makes the sum of
    N(g) squared smallest. That change is 2 (N(g - s) - N(g)) + 2 for an open bin, 1 - 2 N(s) where it fills up
    and 2 N(capacity - s) + 1 for a new one. Of equal changes the smallest gap is taken, an open bin before a new one.
    """
    counts = np.zeros(capacity + 1, np.int64)
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins, offsets, made = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64), 0
    never = np.iinfo(np.int64).max
    for i in np.argsort(-lengths, kind="stable").tolist():
        s = int(lengths[i])
        here = counts[s:capacity]
        change = np.where(here > 0, 2 * (counts[: capacity - s] - here) + 2, never)
        if s < capacity and here[0]:
            change[0] = 1 - 2 * here[0]  # the bin is full and no longer counted
        best = int(change.argmin()) if s < capacity else 0
        if s < capacity and change[best] <= 2 * counts[capacity - s] + 1:
            gap = s + best
            b = open_bins[gap].pop()
            counts[gap] -= 1
        else:
            gap, b, made = capacity, made, made + 1
        bins[i], offsets[i] = b, capacity - gap
        if gap > s:
            counts[gap - s] += 1
            open_bins[gap - s].append(b)
    return bins, offsets


def _packer(out: pa.Schema, capacity: int, buffer_tokens: int, close_at: float, last: bool, round_no: int) -> Callable:
    """Packs a task's pieces buffer by buffer. Bins filled to ``close_at`` are closed; the pieces of others
    go into the next buffer, and those of the last buffer leave open for the next round."""

    def batch(pieces: list[Piece], where: np.ndarray, offsets: np.ndarray, closed: bool) -> pa.RecordBatch:
        ids = [p[3] for p in pieces]
        columns = [
            [p[0] for p in pieces], [p[1] for p in pieces], [p[2] for p in pieces], [len(x) for x in ids],
            [x.astype("<u4", copy=False).tobytes() for x in ids], where, offsets, [closed] * len(pieces),
        ]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, out)], schema=out)

    def pack(pieces: Iterator[list[Piece]]) -> Iterator[pa.RecordBatch]:
        base = (round_no << 56) + (TaskContext.get().partitionId() << 28)
        held: list[Piece] = []
        tokens = 0

        def settle(final: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held, tokens, base
            lengths = np.array([len(p[3]) for p in held], np.int64)
            bins, offsets = place(lengths, capacity)
            fill = np.bincount(bins, lengths)
            shut = (fill >= close_at * capacity)[bins] | (final and last)
            order = np.lexsort((offsets, bins))
            for at in np.array_split(order[shut[order]], 1 + int(lengths.sum()) // (1 << 20)):
                if len(at):
                    yield batch([held[i] for i in at], base + bins[at], offsets[at], True)
            base += len(fill)
            held = [held[i] for i in np.flatnonzero(~shut)]
            tokens = sum(len(p[3]) for p in held)
            if final and held:
                yield batch(held, np.zeros(len(held), np.int64), np.zeros(len(held), np.int64), False)

        target = buffer_tokens
        for some in pieces:
            held += some
            tokens += sum(len(p[3]) for p in some)
            if tokens >= target:
                yield from settle(False)
                target = tokens + buffer_tokens  # what doesn't fit together is held, but sorted only once per buffer
        if held:
            yield from settle(True)

    return pack


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = 4096,
    end_id: int = 1,
    buffer_tokens: int = 4_000_000,
    close_at: float = 0.98,
) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids, sequence_id, offset``.

    A document is its token ids and ``end_id``; only one longer than ``capacity`` is cut, into pieces of that
    length (the last may be shorter). ``ids`` holds the piece's ids as little-endian unsigned 32-bit integers.
    Each task packs its own input partition in buffers of ``buffer_tokens`` ids, longest piece first, by the
    sum-of-squares rule (see :func:`place`). Pieces in bins filled below ``close_at`` at a task's end are pooled
    over all tasks and packed again, with one task per buffer, until they fit one buffer or a round closes less
    than half of them. Only pooled pieces are shuffled; each round is a written table.

    Memory: one buffer of ids per task, plus pieces that fill no bin in their task (none for usual
    lengths; at worst the partition's ids).

    Defined cases: a null or empty text is one piece of ``end_id`` alone; ids may be null or repeated (each row is
    a document of its own); empty input gives no rows; other columns are ignored. ``sequence_id`` is unique, not dense.
    """
    id_type = docs.schema[id_col].dataType
    schema = T.StructType([
        T.StructField("doc_id", id_type), T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
        T.StructField("ids", T.BinaryType()), T.StructField("sequence_id", T.LongType()),
        T.StructField("offset", T.LongType()), T.StructField("closed", T.BooleanType()),
    ])
    out = to_arrow_schema(schema)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = encoder(tokenizer_path)

        def pieces() -> Iterator[list[Piece]]:
            for part in slices(batches, "text", 4 << 20, keeps=True):
                ids, sizes = code.encode(part.column("text"))
                some, end = [], 0
                for doc, size in zip(part.column("doc_id").to_pylist(), sizes.tolist()):
                    own = np.append(ids[end:end + size], np.uint32(end_id))
                    end += size
                    some += [(doc, k, at, own[at:at + capacity]) for k, at in enumerate(range(0, len(own), capacity))]
                yield some

        yield from _packer(out, capacity, buffer_tokens, close_at, False, 0)(pieces())

    def again(round_no: int, last: bool) -> Callable:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def pieces() -> Iterator[list[Piece]]:
                for b in batches:
                    ids = [np.frombuffer(x, "<u4") for x in b.column("ids").to_pylist()]
                    yield list(zip(*(b.column(c).to_pylist() for c in ("doc_id", "piece", "start")), ids))

            yield from _packer(out, capacity, buffer_tokens, close_at, last, round_no)(pieces())

        return run

    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    result = written(texts.mapInArrow(first, schema), "packed-0")
    done, before, round_no = [result.filter("closed")], None, 0
    while True:
        pool = result.filter("NOT closed")
        tokens = pool.agg(F.sum("length")).first()[0] or 0
        if not tokens:
            break
        tasks, round_no = -(-tokens // buffer_tokens), round_no + 1
        last = tasks == 1 or (before is not None and tokens > before / 2)
        dealt = pool.repartition(tasks, F.xxhash64("doc_id", "piece", "start", "length", F.crc32("ids")))
        result = written(dealt.mapInArrow(again(round_no, last), schema), f"packed-{round_no}")
        done.append(result.filter("closed"))
        before = tokens
    return reduce(DataFrame.unionByName, done).drop("closed")
