"""Document fingerprints from prefix polynomial hashes."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from kickwx.llm.batches import slices

# Two primes below 2**31, so that products fit 64 bits, and a base for each.
MODULI = (2**31 - 1, 2**31 - 19)
BASES = (1_000_003, 777_767_777)
WINDOW = 8
SKETCH = 64


def _powers(base: int, modulus: int, size: int) -> np.ndarray:
    out = np.ones(1, np.int64)
    while len(out) < size:  # doubling
        out = np.concatenate((out, out * pow(base, len(out), modulus) % modulus))
    return out


class _Tables:
    """Powers of the bases and of their inverses, as far as any text of this worker needed them."""

    def __init__(self) -> None:
        self.size = 0

    def upto(self, size: int) -> "_Tables":
        if size > self.size:
            self.size = max(1 << 15, 1 << (size - 1).bit_length())
            self.up = [_powers(b, m, self.size) for b, m in zip(BASES, MODULI)]
            self.down = [_powers(pow(b, -1, m), m, self.size) for b, m in zip(BASES, MODULI)]
        return self


_tables = _Tables()


class PrefixHashes:
    """Prefix arrays of a text: ``sums[k][i]`` is the sum of (code + 1) * base**j over j < i, modulo a prime."""

    def __init__(self, text: str):
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64) + 1
        self.size = len(codes)
        up = _tables.upto(self.size + 1).up
        self.sums = []
        for power, m in zip(up, MODULI):
            sums = np.zeros(self.size + 1, np.int64)
            np.cumsum(codes * power[: self.size] % m, out=sums[1:])
            self.sums.append(sums % m)

    def spans(self, starts: np.ndarray, stops: np.ndarray, which: int = 0) -> np.ndarray:
        """Hash of each span under one modulus, wherever it stands: equal spans have equal hashes."""
        m, sums, down = MODULI[which], self.sums[which], _tables.upto(self.size + 1).down[which]
        return (sums[stops] - sums[starts]) % m * down[starts] % m

    def span(self, start: int, stop: int) -> tuple[int, ...]:
        at, to = np.array([start]), np.array([stop])
        return tuple(int(self.spans(at, to, k)[0]) for k in range(len(MODULI)))

    def extension(self, start: int, other: "PrefixHashes", at: int) -> int:
        """Length of the longest common extension of this text from ``start`` and the other from ``at``."""
        low, high = 0, min(self.size - start, other.size - at)
        while low < high:
            mid = (low + high + 1) // 2
            if self.span(start, start + mid) == other.span(at, at + mid):
                low = mid
            else:
                high = mid - 1
        return low

    def fingerprint(self) -> str:
        """16 hex digits for the whole text, its length, and the ``SKETCH`` smallest mixed hashes of its windows.

        Windows are all spans of ``WINDOW`` code points (the whole text if it is shorter).
        """
        whole = "".join(f"{x:08x}" for x in self.span(0, self.size))
        width = min(WINDOW, self.size)
        starts = np.arange(self.size - width + 1)
        mixed = (self.spans(starts, starts + width).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)
        if len(mixed) > 4 * SKETCH:  # distinct values repeat little: a few of the smallest are enough to start
            least = np.unique(np.partition(mixed, 2 * SKETCH)[: 2 * SKETCH])
            mixed = least if len(least) >= SKETCH else mixed
        sketch = np.unique(mixed)[:SKETCH]
        return f"{whole}-{self.size:x}-{sketch.astype('>u4').tobytes().hex()}"


def likeness(a: str, b: str) -> float:
    """Estimated Jaccard similarity of the window sets behind two fingerprints; 1 for equal texts."""
    if a == b:
        return 1.0
    x, y = (np.frombuffer(bytes.fromhex(f.rsplit("-", 1)[1]), ">u4") for f in (a, b))
    least = np.union1d(x, y)[:SKETCH]
    both = np.intersect1d(x, y, assume_unique=True)
    return float(np.isin(least, both, assume_unique=True).sum() / len(least))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_chars`` (code points), ``fingerprint``. No shuffle.

    Defined cases: a null text is empty; ids may be null or repeated; empty input gives no rows; other columns
    are ignored. Equal texts have equal fingerprints.
    """
    schema = T.StructType([
        T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("n_chars", T.LongType()),
        T.StructField("fingerprint", T.StringType()),
    ])
    out = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            hashed = [PrefixHashes(t) for t in part.column("text").to_pylist()]
            columns = [part.column("doc_id"), pa.array([h.size for h in hashed]), pa.array([h.fingerprint() for h in hashed])]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, out)], schema=out)

    texts = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return texts.mapInArrow(run, schema)


def spliced_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document against its text spliced with the next one's: ``doc_id, n_chars, edited, fingerprint,
    edited_fingerprint, near_edited, near_next, common_prefix``.

    The next document is that of ascending id (after the last: the first). ``edited`` has the last n_chars // 4
    code points replaced by the first as many of the next document (or all it has). ``common_prefix`` is the
    longest common extension of text and edited text from their starts.

    Rows are cut into key ranges, at keys of a sample of about 20 rows per shuffle partition; the row at which a range starts
    also goes to the range before it. So one shuffle of the texts brings neighbours together and each range is
    read as a sorted stream, one text ahead.

    Defined cases: the order is by (id, hash of the text), null ids first, so that rows repeating an id are
    ordered by their texts (rows equal in both are each other's neighbours in any order); a single document
    is its own next; a null text is empty; empty input gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    id_type = docs.schema[id_col].dataType
    body = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(body).alias("key"), body.alias("text"))
    keys = rows.select("doc_id", "key")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    total, first = keys.agg(F.count(F.lit(1)), F.min(F.struct("doc_id", "key"))).first()
    chosen = keys.filter(F.pmod(F.xxhash64("key", "doc_id"), F.lit(1_000_000)) < int(20e6 * parts / max(total, 1)) + 1)

    def order(doc_id, key) -> tuple:
        return (doc_id is not None, doc_id if doc_id is not None else 0, key)

    sampled = sorted({order(*r) for r in chosen.distinct().collect()})
    bounds = sorted({*sampled[:: max(1, len(sampled) // parts)], *([order(*first)] if total else [])})

    dealt_schema = T.StructType([
        T.StructField("part", T.IntegerType()), T.StructField("follows", T.BooleanType()),
        T.StructField("doc_id", id_type), T.StructField("key", T.LongType()), T.StructField("text", T.StringType()),
    ])
    dealt_out = to_arrow_schema(dealt_schema)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # the first row of each range, once: rows equal in id and key are the same document text
        starts = {b: (i - 1) % len(bounds) for i, b in enumerate(bounds)}
        sent: set[int] = set()
        for batch in slices(batches, "text", 16 << 20):
            place = [order(*r) for r in zip(batch.column("doc_id").to_pylist(), batch.column("key").to_pylist())]
            part = [bisect_right(bounds, p) - 1 for p in place]
            ahead = [i for i, p in enumerate(place) if p in starts and starts[p] not in sent and not sent.add(starts[p])]
            at = pa.array([*range(len(place)), *ahead], pa.int64())
            columns = [
                pa.array(part + [starts[place[i]] for i in ahead], pa.int32()),
                pa.array([False] * len(part) + [True] * len(ahead)),
                *(batch.column(c).take(at) for c in ("doc_id", "key", "text")),
            ]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, dealt_out)], schema=dealt_out)

    schema = T.StructType([
        T.StructField("doc_id", id_type), T.StructField("n_chars", T.LongType()), T.StructField("edited", T.StringType()),
        T.StructField("fingerprint", T.StringType()), T.StructField("edited_fingerprint", T.StringType()),
        T.StructField("near_edited", T.DoubleType()), T.StructField("near_next", T.DoubleType()),
        T.StructField("common_prefix", T.LongType()),
    ])
    out = to_arrow_schema(schema)

    def splice(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None  # part, id, text, hashes, fingerprint of the row before
        for batch in slices(batches, "text"):
            found = []
            columns = (batch.column(c).to_pylist() for c in ("part", "follows", "doc_id", "text"))
            for part, follows, doc_id, text in zip(*columns):
                if follows and (held is None or held[0] != part):
                    continue  # a second copy of the row that follows
                hashes = PrefixHashes(text)
                mark = hashes.fingerprint()
                if held is not None and held[0] == part:
                    _, own_id, own, own_hashes, own_mark = held
                    cut = len(own) // 4
                    edited = own[: len(own) - cut] + text[:cut]
                    edited_hashes = PrefixHashes(edited)
                    edited_mark = edited_hashes.fingerprint()
                    found.append((
                        own_id, len(own), edited, own_mark, edited_mark, likeness(own_mark, edited_mark),
                        likeness(own_mark, mark), own_hashes.extension(0, edited_hashes, 0),
                    ))
                held = None if follows else (part, doc_id, text, hashes, mark)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), out)], schema=out)

    dealt = rows.mapInArrow(deal, dealt_schema)
    together = dealt.repartitionById(max(1, len(bounds)), F.col("part"))
    return together.sortWithinPartitions("part", "follows", "doc_id", "key").mapInArrow(splice, schema)
