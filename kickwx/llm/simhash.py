"""SimHash near-deduplication with vantage-point trees over Hamming distance."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from kickwx.llm.batches import slices
from kickwx.llm.components import components
from kickwx.llm.scratch import written

SEED = 42
LEAF = 256
HALVES = (np.uint64(0xFFFFFFFF), np.uint64(0xFFFFFFFF00000000))


def fingerprint(text: str | None, ngram: int) -> int:
    """64-bit SimHash: a bit is set if it is set in over half the shingles' XXH64 hashes; 0 without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z, and ASCII white space
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= ngram:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = ([0, *ends.tolist()])[: len(words) - ngram + 1]
    stops = (ends - 1)[ngram - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts, stops)], np.uint64)
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        counts += np.unpackbits(hashes[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def simhash(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ngram: int = 3) -> DataFrame:
    """One row per document: ``doc_id, fp`` (the fingerprint's 64 bits as a signed long)."""
    schema = T.StructType([T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("fp", T.LongType())])
    out = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            prints = np.array([fingerprint(t, ngram) for t in part.column("text").to_pylist()], np.uint64)
            columns = [part.column("doc_id").cast(out.field(0).type), pa.array(prints.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, schema=out)

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)


def distance(x: np.ndarray, point: np.uint64, mask: np.uint64) -> np.ndarray:
    return np.bitwise_count((x ^ point) & mask)


def middle(far: np.ndarray) -> int | None:
    """The distance bound that splits best: ``far <= bound`` inside, the rest outside; None if all are equal."""
    counts = np.bincount(far)
    inside = np.cumsum(counts)[:-1]
    inside = np.where((inside > 0) & (inside < len(far)), np.minimum(inside, len(far) - inside), 0)
    return int(inside.argmax()) if len(inside) and inside.max() else None


def grow(sample: np.ndarray, mask: np.uint64, leaves: int, number: Iterator[int]) -> tuple | int:
    """A tree as (vantage point, bound, inside, outside) nodes and leaf numbers."""
    if leaves > 1 and len(sample) > 1:
        point = sample[0]
        far = distance(sample, point, mask)
        bound = middle(far)
        if bound is not None:
            near = far <= bound
            return (
                point, bound,
                grow(sample[near], mask, leaves // 2, number), grow(sample[~near], mask, leaves - leaves // 2, number),
            )
    return next(number)


def sides(home: np.ndarray, guests: np.ndarray, point: np.uint64, bound: int, mask: np.uint64, radius: int):
    """Members and guests of a node's two children.

    By the triangle inequality a partner within ``radius`` differs by no more in its distance to the vantage
    point. A member inside whose ball reaches over the bound is a guest outside (one direction is enough to meet
    every pair once); a guest goes wherever its ball reaches.
    """
    far, guest_far = distance(home, point, mask), distance(guests, point, mask).astype(np.int64)
    near = far <= bound
    over = home[near & (far.astype(np.int64) > bound - radius)]
    return (
        (home[near], guests[guest_far <= bound + radius]),
        (home[~near], np.concatenate((guests[guest_far > bound - radius], over))),
    )


def route(node: tuple | int, home: np.ndarray, guests: np.ndarray, mask: np.uint64, radius: int):
    """Yield (leaf, members, guests) below a node."""
    if isinstance(node, tuple):
        point, bound, inside, outside = node
        first, second = sides(home, guests, point, bound, mask, radius)
        yield from route(inside, *first, mask, radius)
        yield from route(outside, *second, mask, radius)
    elif len(home) or len(guests):
        yield node, home, guests


def links(home: np.ndarray, guests: np.ndarray, mask: np.uint64, radius: int, max_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Edges that connect what lies within ``max_bits`` of each other (members with members and guests).

    The tree goes on below the shard. A leaf compares all its members exactly and gives a star for each of
    its connected groups, not its pairs.
    """
    todo = [(home, guests)]
    while todo:
        home, guests = todo.pop()
        if len(home) > LEAF:
            point = home[0]
            bound = middle(distance(home, point, mask))
            if bound is not None:
                todo += sides(home, guests, point, bound, mask, radius)
                continue
        for at in range(0, len(home), LEAF):
            mine = home[at:at + LEAF]
            others = np.concatenate((home[at:], guests))  # members before were compared with these already
            for start in range(0, len(others), 4096):
                theirs = others[start:start + 4096]
                near = np.bitwise_count(mine[:, None] ^ theirs) <= max_bits
                near &= mine[:, None] != theirs
                if near.any():
                    yield star(mine, theirs, near)


def star(rows: np.ndarray, columns: np.ndarray, near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges from each row and column with a link to its group's smallest value."""
    r, c = np.flatnonzero(near.any(axis=1)), np.flatnonzero(near.any(axis=0))
    near, rows, columns = near[np.ix_(r, c)], rows[r], columns[c]
    top = np.iinfo(np.uint64).max
    label_r, label_c = rows.copy(), columns.copy()
    while True:
        new_r = np.minimum(label_r, np.where(near, label_c, top).min(axis=1))
        new_c = np.minimum(label_c, np.where(near, new_r[:, None], top).min(axis=0))
        if (new_r == label_r).all() and (new_c == label_c).all():
            return np.concatenate((rows, columns)), np.concatenate((label_r, label_c))
        label_r, label_c = new_r, new_c


def near_links(prints: DataFrame, max_bits: int, shard_rows: int, max_shards: int) -> DataFrame:
    """Edges ``a, b`` whose components are those of all pairs within ``max_bits``, of distinct fingerprints ``fp``.

    Two trees, one over each half of the bits: of two fingerprints within d bits, one half differs in at most
    d // 2, so each tree needs only that radius. The upper tree, of at most ``max_shards`` leaves, is grown on the driver
    from 16 fingerprints per leaf; all fingerprints are routed through it to their leaf's shard, and as guests to
    the shards that their ball overlaps.
    """
    spark = prints.sparkSession
    shards = max(1, min(max_shards, -(-prints.count() // shard_rows)))
    sample = [r[0] for r in prints.orderBy(F.xxhash64("fp")).limit(16 * shards).collect()] if shards > 1 else []
    sample = np.array(sample, np.int64).view(np.uint64)
    radius, numbers = max_bits // 2, iter(range(4 * max_shards))
    trees = [grow(sample, mask, shards, numbers) for mask in HALVES]
    leaf_tree = {}
    for tree, top in enumerate(trees):
        stack = [top]
        while stack:
            node = stack.pop()
            if isinstance(node, tuple):
                stack += node[2:]
            else:
                leaf_tree[node] = tree

    def deal(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            fps, none = frame["fp"].to_numpy().view(np.uint64), np.empty(0, np.uint64)
            for top, mask in zip(trees, HALVES):
                for leaf, home, guests in route(top, fps, none, mask, radius):
                    yield pd.DataFrame({
                        "shard": np.int32(leaf), "fp": np.concatenate((home, guests)).view(np.int64),
                        "home": np.repeat([True, False], [len(home), len(guests)]),
                    })

    def search(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        fps, home = frame["fp"].to_numpy().view(np.uint64), frame["home"].to_numpy()
        found = list(links(fps[home], fps[~home], HALVES[leaf_tree[int(key[0])]], radius, max_bits))
        if not found:
            return pd.DataFrame({"a": np.empty(0, np.int64), "b": np.empty(0, np.int64)})
        a, b = (np.concatenate(x).view(np.int64) for x in zip(*found))
        return pd.DataFrame({"a": a, "b": b}).drop_duplicates()

    dealt = prints.select("fp").mapInPandas(deal, "shard int, fp long, home boolean")
    return dealt.groupBy("shard").applyInPandas(search, "a long, b long")


def simhash_near_dups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    ngram: int = 3,
    max_bits: int = 3,
    shard_rows: int = 20_000,
    max_shards: int = 4096,
) -> DataFrame:
    """One row per document: ``doc_id, fingerprint`` (16 hex digits), ``component_id`` (the smallest id reachable).

    Texts are lower-cased (A-Z), cut at ASCII white space and hashed as ``ngram``-word shingles, repeats included.
    Documents with equal fingerprints meet once; distinct fingerprints are linked at ``max_bits`` differing bits
    or fewer by the search of :func:`near_links`, exactly, and chained into components.

    Defined cases: without words (null, empty, blank) the fingerprint is zero and links like any other; with
    fewer than ``ngram`` words it is the hash of the whole sequence; null ids get a component but never name one
    (it is null where all are); repeated rows are returned as often; empty input gives no rows; other columns are
    ignored.
    """
    prints = written(simhash(docs, id_col, text_col, ngram), "fingerprints")
    classes = written(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "fingerprint-classes")
    roots = components(near_links(classes.select("fp"), max_bits, shard_rows, max_shards))
    rooted = classes.join(roots, classes.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    of_print = written(rooted.join(least, "root").select("fp", "component_id"), "fingerprint-components")
    return prints.join(of_print, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
