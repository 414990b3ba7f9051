"""Near-duplicate documents by HyperMinHash: compressed registers, banding, corrected estimates, verification."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from kickwx.llm.batches import give_back, slices
from kickwx.llm.components import components
from kickwx.llm.scratch import written
from kickwx.llm.substring_dedup import ODD, mix, shingles, word_bounds

BUCKETS = 128
MANTISSA = 10  # bits kept behind the leading one
ROWS = 4  # registers of 16 bits in a band: one long
BANDS = BUCKETS // ROWS
EMPTY = 0xFFFF
BLOCK = 512  # members of a group in one block of comparisons
GATHERED = 20_000  # rows of small units compared by one call
GATHERED_BYTES = 8 << 20  # of their texts
WORDS = 1 << 20  # shingles in one block
SLIP = 1e-8  # chance that an estimate drops a pair that is a link
# Of each bucket, the order in which others lend it a register while it is empty.
LENDERS = np.argsort(mix(np.arange(1, BUCKETS * BUCKETS + 1, dtype=np.uint64) * ODD).reshape(BUCKETS, BUCKETS), axis=1)


def shingle_sets(texts: list[bytes], width: int) -> Iterator[np.ndarray]:
    """Of each text the distinct hashes of its shingles of ``width`` words, sorted; with fewer words, of the whole sequence."""
    hashed, owner, counts = shingles(texts, width)
    ends = np.searchsorted(owner, np.arange(len(texts) + 1))
    for i, text in enumerate(texts):
        if counts[i] == 0:
            yield np.empty(0, np.uint64)
        elif counts[i] < width:
            yield np.array([xxhash.xxh64_intdigest(b" ".join(text.lower().split()), int(counts[i]))], np.uint64)
        else:
            yield np.unique(hashed[ends[i]:ends[i + 1]])


def registers(hashes: np.ndarray) -> np.ndarray:
    """HyperMinHash of a set of sorted hashes: the top bits choose a bucket, and of a bucket's smallest rest the number of leading zeros (as the
    length of what follows) and the ``MANTISSA`` bits behind the leading one are kept, in 16 bits."""
    out = np.full(BUCKETS, EMPTY, np.uint16)
    bucket = (hashes >> np.uint64(57)).astype(np.int64)
    first = np.append(True, np.diff(bucket) > 0) if len(hashes) else np.empty(0, bool)
    rest = ((hashes[first] >> np.uint64(5)) & np.uint64((1 << 52) - 1)).astype(np.float64)  # exact below 2 ** 53
    fraction, length = np.frexp(rest)
    mantissa = ((2 * fraction - 1) * (1 << MANTISSA)).astype(np.int64)
    out[bucket[first]] = np.where(rest > 0, (length << MANTISSA) | mantissa, 0)
    return out


def lent(own: np.ndarray) -> np.ndarray:
    """Registers with empty ones borrowed from the first bucket of their order that has one, so that small sets band like large ones."""
    there = own != EMPTY
    gaps = np.flatnonzero(~there)
    if not len(gaps) or len(gaps) == BUCKETS:
        return own
    out = own.copy()
    order = LENDERS[gaps]
    out[gaps] = own[order[np.arange(len(gaps)), there[order].argmax(axis=1)]]
    return out


@lru_cache(4096)
def _coincidence(first: int, second: int) -> float:
    """The chance that a bucket of two unrelated sets holds equal registers, both there; sizes as half powers of two."""
    def spread(half: int) -> np.ndarray:
        size = 2.0 ** (half / 2)
        lengths = np.arange(1, 53)[:, None]
        low = (1 + np.arange(1 << MANTISSA) / (1 << MANTISSA)) * 2.0 ** (lengths - 53)
        high = low + 2.0 ** (lengths - 53 - MANTISSA)
        return np.exp(-size / BUCKETS * low) - np.exp(-size / BUCKETS * high)

    return float((spread(first) * spread(second)).sum())


def _half(size: int) -> int:
    return round(2 * np.log2(max(size, 1)))


def estimate(mine: np.ndarray, theirs: np.ndarray, n: int, m: int) -> tuple[np.ndarray, np.ndarray]:
    """Jaccard estimates of one set of registers against rows of others, chance coincidences taken off, and how many buckets
    each rests on (those that either set has)."""
    held = (mine != EMPTY) | (theirs != EMPTY)
    same = ((mine == theirs) & held).sum(axis=-1)
    used = np.maximum(held.sum(axis=-1), 1)
    both = np.minimum(_coincidence(_half(n), _half(m)) * BUCKETS / used, 0.5)
    return np.maximum(0.0, (same / used - both) / (1 - both)), used


def possible(estimates: np.ndarray, used: np.ndarray, n: int, m: np.ndarray | int, similarity: float) -> np.ndarray:
    """Whether an estimate is near enough to the threshold: a link falls below with a chance of ``SLIP`` at most.

    The smallest hashes of the buckets are drawn from the union without replacement (Serfling's bound); a union at the
    threshold has (n + m) / (1 + similarity) members.
    """
    union = np.maximum((n + m) / (1 + similarity), used)
    return estimates >= similarity - np.sqrt(np.log(1 / SLIP) / (2 * used) * (1 - (used - 1) / union)) - 1e-9


def sketched(docs: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """One row per document: ``row`` (a number), ``doc_id``, ``d1, d2`` (a 128-bit digest of its set), ``n``, ``own`` (registers), ``bands``, ``text``."""
    schema = T.StructType([
        T.StructField("row", T.LongType()), T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("d1", T.LongType()), T.StructField("d2", T.LongType()),
        T.StructField("n", T.LongType()), T.StructField("own", T.BinaryType()), T.StructField("bands", T.ArrayType(T.LongType())), T.StructField("text", T.StringType()),
    ])
    out = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        for part in slices(batches, "text"):
            texts = [(t or "").encode("utf-8", "surrogatepass") for t in part.column("text").to_pylist()]
            digests, sizes, own, bands = [], [], [], []
            for found in shingle_sets(texts, width):
                one = registers(found)
                digests.append(np.frombuffer(xxhash.xxh3_128_digest(found.tobytes()), np.int64))
                sizes.append(len(found))
                own.append(one.tobytes())
                bands.append(lent(one).view(np.int64) if len(found) else None)
            digests = np.array(digests, np.int64).reshape(-1, 2)
            columns = [np.arange(row, row + part.num_rows), part.column("doc_id"), digests[:, 0].copy(), digests[:, 1].copy(), sizes, own, bands, part.column("text")]
            row += part.num_rows
            yield pa.RecordBatch.from_arrays([(c if isinstance(c, pa.Array) else pa.array(c, f.type)).cast(f.type) for c, f in zip(columns, out)], schema=out)
        give_back()

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)


def verified(pairs: DataFrame, width: int, percent: int) -> DataFrame:
    """Of pairs ``a, b`` (with each side's ``n, own, text``) those that are links: the estimate first, then the full sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, its = None, None
        for part in slices(batches, "a_text", 1 << 20):
            a, b, n, m = (part.column(c).to_pylist() for c in ("a", "b", "a_n", "b_n"))
            regs = [np.frombuffer(b"".join(part.column(c).to_pylist()), np.uint16).reshape(-1, BUCKETS) for c in ("a_own", "b_own")]
            texts = [part.column(c).to_pylist() for c in ("a_text", "b_text")]
            found = []
            for i in range(part.num_rows):
                near, used = estimate(regs[0][i], regs[1][i], n[i], m[i])
                if 100 * min(n[i], m[i]) < percent * max(n[i], m[i]) or not possible(near, used, n[i], m[i], percent / 100):
                    continue
                if last != b[i]:
                    last, its = b[i], next(shingle_sets([texts[1][i].encode("utf-8", "surrogatepass")], width))
                mine = next(shingle_sets([texts[0][i].encode("utf-8", "surrogatepass")], width))
                both = len(np.intersect1d(mine, its, assume_unique=True))
                if 100 * both >= percent * (len(mine) + len(its) - both):
                    found.append((a[i], b[i]))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], names=["a", "b"])
        give_back()

    return pairs.mapInArrow(run, "a long, b long")


def _runs(changed: list[np.ndarray]) -> Iterator[tuple[int, int]]:
    """First and behind last of the runs of rows that are equal in all columns."""
    edges = np.flatnonzero(np.append(True, np.any([np.diff(c) != 0 for c in changed], axis=0))).tolist()
    yield from zip(edges, [*edges[1:], len(changed[0])])


def compared(units: DataFrame, percent: int) -> DataFrame:
    """The members of each unit (blocks ``x, y`` of a group) that may have a link to one of another root, by their registers alone: ``unit,
    node, root, partners``, where the partners of a member of the left are those of the right, likeliest first (null for a partner).

    A pair is looked at in the first band it shares only. Small units come many to a ``bucket``. One row per member and unit, not per pair.
    """

    def run(key: tuple, table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        place = [table.column(c).to_numpy() for c in ("band", "sig", "x", "y")]
        order = np.lexsort(place)
        unit, name, root, n, left, right = (table.column(c).to_numpy(zero_copy_only=False)[order] for c in ("unit", "node", "root", "n", "left", "right"))
        own = np.frombuffer(b"".join(table.column("own").to_pylist()), np.uint16).reshape(-1, BUCKETS)[order]
        full = np.asarray(table.column("bands").chunk(0).flatten()).reshape(-1, BANDS)[order]
        band = place[0][order]
        rows = []
        for start, stop in _runs([c[order] for c in place]):
            others = start + np.flatnonzero(right[start:stop])
            met: dict[int, bytes | None] = {}
            for i in (start + np.flatnonzero(left[start:stop])).tolist():
                # where a block meets itself, a pair comes from its smaller member
                with_ = others[(root[others] != root[i]) & (~left[others] | (name[others] > name[i]))]
                least, most = np.minimum(n[with_], n[i]), np.maximum(n[with_], n[i])
                with_ = with_[100 * least >= percent * most]
                if len(with_):
                    with_ = with_[(full[with_] == full[i]).argmax(axis=1) == band[i]]
                if len(with_):
                    near, used = estimate(own[i], own[with_], int(n[i]), int(n[i]))
                    able = possible(near, used, int(n[i]), n[with_], percent / 100)
                    with_ = with_[able][np.argsort(-near[able], kind="stable")]
                if len(with_):
                    met[i] = name[with_].tobytes()
                    for x in with_.tolist():
                        met.setdefault(x, None)
            rows += [(int(unit[i]), int(name[i]), int(root[i]), partners) for i, partners in met.items()]
        columns = list(zip(*rows)) if rows else [()] * 4
        return pa.table([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.binary()))], names=["unit", "node", "root", "partners"])

    return units.groupBy("bucket").applyInArrow(run, "unit long, node long, root long, partners binary")


def joined(members: DataFrame, width: int, percent: int) -> DataFrame:
    """Links ``a, b`` between the roots of each unit's ``members`` (as from :func:`compared`, with ``text``), verified on the full sets.

    A pair whose roots the unit has linked already is skipped, so a unit gives fewer links than it has members.
    """

    def run(key: tuple, table: pa.Table) -> pa.Table:
        order = np.argsort(table.column("unit").to_numpy(), kind="stable")
        unit, node, root = (table.column(c).to_numpy()[order] for c in ("unit", "node", "root"))
        partners, texts = table.column("partners"), table.column("text")
        found = []
        for start, stop in _runs([unit]):
            at = {x: i for i, x in enumerate(node[start:stop].tolist(), start)}
            top: dict[int, int] = {}
            sets: dict[int, np.ndarray] = {}

            def find(x: int) -> int:
                while x in top:
                    x = top[x]
                return x

            def members_of(i: int) -> np.ndarray:
                if i not in sets:
                    sets[i] = next(shingle_sets([texts[int(order[i])].as_py().encode("utf-8", "surrogatepass")], width))
                return sets[i]

            for i in range(start, stop):
                some = partners[int(order[i])].as_py()
                for other in np.frombuffer(some, np.int64).tolist() if some else []:
                    mine, its = find(int(root[i])), find(int(root[at[other]]))
                    if mine == its:
                        continue
                    one, two = members_of(i), members_of(at[other])
                    both = len(np.intersect1d(one, two, assume_unique=True))
                    if 100 * both >= percent * (len(one) + len(two) - both):
                        top[mine] = its
                        found.append((int(node[i]), other))
        a, b = zip(*found) if found else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return members.groupBy("bucket").applyInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, percent: int = 80) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id`` (the smallest id reachable over links), ``kept``.

    A document's set is its distinct ``width``-word shingles (A-Z lower-cased, words split at ASCII white space). Two
    documents are linked if 100 * intersection >= ``percent`` * union of their sets.

    1. Equal sets are one class (a 128-bit digest). Of each set 128 registers of 16 bits are kept.
    2. Bands of four registers make groups. Each group elects the member whose groups are largest in all, so the centre of a cluster,
       and the others are paired with it: no more pairs than members.
    3. Pairs are estimated from their registers, less the coincidences expected by chance, and verified on the full sets.
       Links give components.
    4. In groups that still hold several components, every member outside the largest one is compared with all members of other
       components, in blocks of registers. Members that may have a link meet again with their texts, block by block; pairs whose components the
       block has linked already are skipped, the others verified. Components are built anew.

    A pair of similarity s is in no common group with a chance of (1 - s**4)**32: below 5e-8 at 0.8. An estimate drops a link with a chance of
    1e-8 at most. Groups that are one component after step 3 (copies and edits of one text) cost no more than their size.

    Defined cases: null, empty and wordless texts have an empty set, n_shingles 0, and are linked with nothing: their component is their own
    id; fewer words than ``width`` are one shingle, the whole sequence; null ids get a component but never name one (it is null where all
    are; only then such a row is kept); repeated rows are returned as often; empty input gives no rows; other columns are ignored.
    """
    rows = written(sketched(docs, id_col, text_col, width), "sketches")
    filled = rows.filter("n > 0")
    classes = written(filled.groupBy("d1", "d2").agg(F.min("row").alias("node"), F.min("doc_id").alias("least")), "sketch-classes")
    firsts = filled.select(F.col("row").alias("node"), "n", "own", "bands").join(classes.select("node"), "node", "left_semi")
    nodes = written(firsts, "sketch-nodes")
    bands = nodes.select("node", "n", F.posexplode("bands").alias("band", "sig"))
    sizes = written(bands.groupBy("band", "sig").agg(F.count(F.lit(1)).alias("size")).filter("size > 1"), "band-sizes")
    groups = written(bands.join(sizes, ["band", "sig"]), "band-groups")
    degree = written(groups.groupBy("node").agg(F.sum("size").alias("degree")), "band-degrees")
    centres = groups.join(degree, "node").groupBy("band", "sig").agg(F.max(F.struct("degree", (-F.col("node")).alias("node"))).alias("top"))
    centres = written(centres.select("band", "sig", (-F.col("top.node")).alias("b")), "band-centres")
    members = groups.select("band", "sig", F.col("node").alias("a"))
    stars = written(members.join(centres, ["band", "sig"]).filter("a <> b").select("a", "b").distinct(), "band-stars")

    def checked(pairs: DataFrame) -> DataFrame:
        wanted = written(pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct(), "pair-members")
        held = written(filled.select(F.col("row").alias("node"), "n", "own", "text").join(wanted, "node", "left_semi"), "pair-texts")
        side = lambda s: held.select(F.col("node").alias(s), *[F.col(c).alias(f"{s}_{c}") for c in ("n", "own", "text")])
        return written(verified(pairs.join(side("a"), "a").join(side("b"), "b"), width, percent), "verified")

    links = checked(stars)
    roots = written(components(links), "star-components")
    rooted = written(groups.join(roots, "node", "left").select("band", "sig", "node", "n", F.coalesce("root", "node").alias("root")), "rooted-groups")
    by_root = rooted.groupBy("band", "sig", "root").agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("words"))
    mixed = by_root.groupBy("band", "sig").agg(
        F.max(F.struct("size", "root", "words")).alias("top"), F.sum("size").alias("size"), F.sum("words").alias("words"), F.count(F.lit(1)).alias("roots")
    ).filter("roots > 1")
    blocks = lambda size, words: F.ceil(F.greatest(size / F.lit(BLOCK), words / F.lit(WORDS))).cast("int")
    mixed = written(mixed.select(
        "band", "sig", F.col("top.root").alias("main_root"), F.col("top.size").alias("mains"), (F.col("size") - F.col("top.size")).alias("others"),
        blocks(F.col("top.size"), F.col("top.words")).alias("ys"), blocks(F.col("size") - F.col("top.size"), F.col("words") - F.col("top.words")).alias("xs"),
    ), "mixed-groups")
    more = written(compared(_units(rooted, mixed, nodes), percent), "candidates")
    texts = filled.select(F.col("row").alias("node"), "text").join(written(more.select("node").distinct(), "candidate-nodes"), "node", "left_semi")
    more = written(more.join(texts, "node"), "candidate-texts")
    buckets = -(-(more.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // GATHERED_BYTES) or 1
    links = links.unionByName(written(joined(more.withColumn("bucket", F.pmod("unit", F.lit(buckets))), width, percent), "verified"))

    rooted = classes.join(components(links), "node", "left").select("d1", "d2", "least", F.coalesce("root", "node").alias("root"))
    least = written(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "component-ids")
    of_class = written(rooted.join(least, "root").select("d1", "d2", "component_id"), "class-components")
    own = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    out = rows.select("doc_id", "n", "d1", "d2").join(of_class, ["d1", "d2"], "left").select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _units(members: DataFrame, mixed: DataFrame, nodes: DataFrame) -> DataFrame:
    """Members dealt to units of comparison: blocks of members outside the main root (``left``) against blocks of all (``right``).

    Both sides of a group are cut into blocks by a hash. A unit (x, y) has block x of the others on its left, and on its right block y
    of the main root (y >= 0) or block -1 - y of the others (y < 0, not below x: each two blocks once). ``bucket`` gathers small units to
    about ``GATHERED`` rows.
    """
    rows = F.col("mains") * F.col("xs") + F.col("others") * (F.col("ys") + F.col("xs"))
    buckets = -(-(mixed.agg(F.sum(rows)).first()[0] or 0) // GATHERED) or 1
    is_main = F.col("root") == F.col("main_root")
    dealt = members.join(mixed, ["band", "sig"]).select(
        "band", "sig", "node", "root", is_main.alias("main"), "xs", "ys",
        F.pmod(F.xxhash64("node"), F.when(is_main, F.col("ys")).otherwise(F.col("xs"))).cast("int").alias("block"),
    )
    block = F.col("block")

    def unit(x: Column, y: Column, left: bool, right: bool) -> Column:
        return F.struct(x.cast("int").alias("x"), y.cast("int").alias("y"), F.lit(left).alias("left"), F.lit(right).alias("right"))

    every = lambda count: F.sequence(F.lit(0), F.col(count) - 1)
    as_main = F.transform(every("xs"), lambda x: unit(x, block, False, True))
    with_mains = F.transform(every("ys"), lambda y: unit(block, y, True, False))
    inside = F.array(unit(block, -1 - block, True, True))
    lower = F.transform(F.filter(every("xs"), lambda x: x < block), lambda x: unit(x, -1 - block, False, True))
    upper = F.transform(F.filter(every("xs"), lambda x: x > block), lambda x: unit(block, -1 - x, True, False))
    units = dealt.select("band", "sig", "node", "root", F.explode(F.when(F.col("main"), as_main).otherwise(F.concat(with_mains, inside, lower, upper))).alias("u"))
    number = F.xxhash64("band", "sig", "u.x", "u.y")
    return units.select(number.alias("unit"), F.pmod(number, F.lit(buckets)).alias("bucket"), "band", "sig", "node", "root", "u.*").join(nodes, "node")
