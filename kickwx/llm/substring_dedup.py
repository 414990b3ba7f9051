"""Near-duplicate passages by compact windows over min-hashed word shingles."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from kickwx.llm.batches import slices
from kickwx.llm.scratch import discard, written

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
ODD = np.uint64(0x9E3779B97F4A7C15)
HIGH = np.uint64(0xFFFFFFFF00000000)
LOW = 0xFFFFFFFF
# Of each round: how many functions the members of a group agree in, and which texts of it (by id, from and to) they are compared with.
ROUNDS = ((2, 1, 1), (3, 1, 4))
SLACK = 0.85  # of the share of shingles in the other text, in the best window of a similar passage
FEW = 8  # seeds of a pair up to which its windows are looked at before its texts


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_bounds(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All texts, A-Z lower-cased, in one byte array; starts and ends of their words (split at ASCII white space); each word's text."""
    flat = np.frombuffer(b"\n".join([*(t.lower() for t in texts), b"\n" * 8]), np.uint8)
    blank = SPACE[flat]
    edge = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    if len(flat) and not blank[0]:
        edge = np.append(0, edge)
    starts, ends = edge[::2], edge[1::2]
    first = np.cumsum([0, *(len(t) + 1 for t in texts)])[:-1]
    return flat, starts, ends, np.searchsorted(first, starts, side="right") - 1


def shingles(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all shingles of ``width`` words, flat; each one's text; the number of words of each text."""
    flat, starts, ends, owner = word_bounds(texts)
    eights = np.lib.stride_tricks.sliding_window_view(flat, 8)
    words = mix((ends - starts).astype(np.uint64))
    rest, at, left = np.arange(len(starts)), starts, ends - starts
    while len(rest):  # eight bytes of every word that has more
        part = np.ascontiguousarray(eights[at]).view("<u8").reshape(-1)
        short = left < 8
        keep = np.where(short, (np.uint64(1) << (8 * np.minimum(left, 7)).astype(np.uint64)) - np.uint64(1), ~np.uint64(0))
        words[rest] = mix(words[rest] * ODD + (part & keep))
        more = left > 8
        rest, at, left = rest[more], at[more] + 8, left[more] - 8
    counts = np.bincount(owner, minlength=len(texts))
    if len(words) < width:
        return np.empty(0, np.uint64), np.empty(0, np.int64), counts
    total = np.zeros(len(words) - width + 1, np.uint64)
    for j in range(width):
        total = total * ODD + words[j: len(words) - width + 1 + j]
    whole = owner[: len(total)] == owner[width - 1:]
    return mix(total[whole]), owner[: len(total)][whole], counts


def sliding_argmin(values: np.ndarray, width: int) -> np.ndarray:
    """Position of the smallest of each ``width`` neighbours, by doubling."""
    best = (values & HIGH) | np.arange(len(values), dtype=np.uint64)
    size = 1
    while 2 * size <= width:
        best = np.minimum(best[:-size], best[size:])
        size *= 2
    if size < width:
        best = np.minimum(best[: len(best) - (width - size)], best[width - size:])
    return (best & ~HIGH).astype(np.int64)


def compact_windows(values: np.ndarray, owner: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Compact windows ``left, centre, right`` of at least ``width`` shingles: every passage that starts in
    [left, centre] and ends in [centre, right] has its smallest hash at the centre.

    They are the nodes of each text's Cartesian tree whose span has that width. A node is such a one if
    it is the smallest of some ``width`` neighbours, and then so are its ancestors; so the tree is built, by one stack,
    of those positions alone.
    """
    if len(values) < width:
        return (np.empty(0, np.int64),) * 3
    centres = sliding_argmin(values, width)
    centres = np.unique(centres[owner[: len(centres)] == owner[width - 1:]])
    whose = owner[centres]
    first, last = np.searchsorted(owner, whose), np.searchsorted(owner, whose, side="right") - 1
    order = ((values[centres] & HIGH) | centres.astype(np.uint64)).tolist()
    left, right, stack, at = first.copy(), last.copy(), [], centres.tolist()
    texts = whose.tolist()
    for i, value in enumerate(order):
        while stack and (texts[stack[-1]] != texts[i] or order[stack[-1]] > value):
            j = stack.pop()
            if texts[j] == texts[i]:
                right[j] = at[i] - 1
        if stack:
            left[i] = at[stack[-1]] + 1
        stack.append(i)
    return left, centres, right


def char_bounds(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of a text's words in code points."""
    flat, starts, ends, _ = word_bounds([text])
    chars = np.append(0, np.cumsum((flat & 0xC0) != 0x80))
    return chars[starts], chars[ends]


def _utf8(column: pa.Array) -> list[bytes]:
    return [(t or "").encode("utf-8", "surrogatepass") for t in column.to_pylist()]


def _records(columns: list, out: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([(c if isinstance(c, pa.Array) else pa.array(c)).cast(f.type) for c, f in zip(columns, out)], schema=out)


def _seed(number: int) -> np.uint64:
    return mix(np.array([number + 1], np.uint64) * ODD)[0]


def all_intervals(docs: DataFrame, hashes: int, width: int, shingle: int) -> DataFrame:
    """Intervals of starts of passages of exactly ``width`` shingles whose smallest hash under function ``k`` is the
    same: ``sig, text_key, k, first, last, n_words``. Under one function they tile each text's starts."""
    schema = T.StructType([T.StructField(n, T.LongType()) for n in ("sig", "text_key")] + [T.StructField(n, T.IntegerType()) for n in ("k", "first", "last", "n_words")])
    out = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            keys = np.asarray(part.column("text_key"))
            hashed, owner, words = shingles(_utf8(part.column("text")), shingle)
            origin = np.searchsorted(owner, np.arange(len(keys)))
            for k in range(hashes):
                values = mix(hashed ^ _seed(k))
                left, centre, right = compact_windows(values, owner, width)
                if len(centre):
                    first, last, whose = np.maximum(left, centre - width + 1), np.minimum(centre, right - width + 1), owner[centre]
                    yield _records([values[centre].view(np.int64), keys[whose], np.full(len(first), k), first - origin[whose], last - origin[whose], words[whose]], out)

    return docs.select("text", "text_key").mapInArrow(run, schema)


def signatures(texts: DataFrame, hashes: int, agree: int) -> DataFrame:
    """Joint signatures of each text's ``tiles`` (``k, first, last, sig``): ``sig, text_key, doc_id, first, last``.

    The tiles of each choice of ``agree`` functions are intersected; what is left has a ``sig`` of their smallest hashes. So
    passages that agree in any ``agree`` functions share one.
    """
    schema = T.StructType([
        T.StructField("sig", T.LongType()), T.StructField("text_key", T.LongType()), T.StructField("doc_id", texts.schema["doc_id"].dataType),
        T.StructField("first", T.IntegerType()), T.StructField("last", T.IntegerType()),
    ])
    out = to_arrow_schema(schema)
    choices = list(combinations(range(hashes), agree))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 256) for i in range(0, batch.num_rows, 256)):
                tiles = part.column("tiles")
                base = np.repeat(np.arange(part.num_rows), np.asarray(pc.list_value_length(tiles))) << 32  # texts one behind the other
                k, first, last, smallest = (np.asarray(tiles.flatten().field(f)) for f in ("k", "first", "last", "sig"))
                order = np.lexsort((first, base, k))
                k, first, last, smallest = k[order], (base + first)[order], (base + last)[order], smallest[order].view(np.uint64)
                tilings = [(first[k == n], last[k == n], smallest[k == n]) for n in range(hashes)]
                for choice in choices:
                    begins, stops, sig = joint([tilings[n] for n in choice], _seed(sum(1 << n for n in choice)))
                    if len(sig):
                        at = pa.array(begins >> 32)
                        yield _records([sig.view(np.int64), part.column("text_key").take(at), part.column("doc_id").take(at), begins & LOW, stops & LOW], out)

    return texts.select("text_key", "doc_id", "tiles").mapInArrow(run, schema)


def joint(tilings: list[tuple[np.ndarray, np.ndarray, np.ndarray]], seed: np.uint64) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where tiles (``first, last, smallest``; sorted, apart) of all tilings overlap, and a signature of their smallest hashes."""
    none = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
    if not all(len(first) for first, _, _ in tilings):
        return none
    firsts = np.unique(np.concatenate([first for first, _, _ in tilings]))
    tiles = [np.searchsorted(first, firsts, side="right") - 1 for first, _, _ in tilings]
    lasts = np.minimum.reduce([last[tile] for (_, last, _), tile in zip(tilings, tiles)])
    whole = (np.minimum.reduce(tiles) >= 0) & (lasts >= firsts)
    sig = np.full(int(whole.sum()), seed)
    for (_, _, smallest), tile in zip(tilings, tiles):
        sig = mix(sig * ODD + smallest[tile[whole]])
    return firsts[whole], lasts[whole], sig


def occurrences(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Positions by hash and then place, the hashes so, the distinct hashes, and for every position so a number that orders (hash, place)."""
    order = np.argsort(hashes, kind="stable")
    values, number = np.unique(hashes, return_inverse=True)
    return order, hashes[order], values, number[order] * (len(hashes) + 1) + order


def earlier(values: np.ndarray) -> np.ndarray:
    """Of each position, where its value stood last (-1: nowhere)."""
    by_value = np.argsort(values, kind="stable")
    before = np.full(len(values), -1, np.int64)
    same = values[by_value[1:]] == values[by_value[:-1]]
    before[by_value[1:][same]] = by_value[:-1][same]
    return before


def coverable(hit: np.ndarray, before: np.ndarray, width: int, share: float) -> np.ndarray:
    """Positions that may lie in a span of ``width`` or more of whose distinct values that ``share`` is ``hit``: all that do, and some others.

    ``before`` as from :func:`earlier`. Of a span from ``a``, the first ``width`` values are counted as they are. Behind them a value that the text
    has for the first time counts, and of those that it had before ``a`` only hits do.
    """
    size = len(hit)
    if size < width:
        return np.zeros(size, bool)
    at, weight = np.arange(size), np.where(hit, 1 - share, -share)
    starts = np.arange(size - width + 1)

    def by_start(first: np.ndarray, last: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Of each start the sum of the weights of all that count for starts from ``first`` to ``last``."""
        some = first <= last
        return np.cumsum(np.bincount(first[some], weight[some], size + 2) - np.bincount(last[some] + 1, weight[some], size + 2))[: len(starts)]

    sums = by_start(np.maximum(before + 1, np.maximum(at - width + 1, 0)), at, weight)
    again = np.flatnonzero(hit & (before >= 0))
    sums += by_start(before[again] + 1, again - width, weight[again])
    new = np.append(0, np.cumsum(np.where(before < 0, weight, 0)))
    top = np.maximum.accumulate(new[::-1])
    stops = size - np.searchsorted(top, new[starts + width] - sums - 1e-6)  # of each start the last end with enough
    whole = stops >= starts + width
    edge = np.bincount(starts[whole], minlength=size + 1) - np.bincount(stops[whole], minlength=size + 1)
    return np.cumsum(edge[:-1]) > 0


def matched_spans(
    mine: np.ndarray, theirs: np.ndarray, seeds: np.ndarray | list[tuple[int, int, int]], width: int, shingle: int, similarity: float, indexed: tuple | None = None,
):
    """Verified spans of shingles of one text that near-repeat a span of another, and the seeds that led to none.

    Around a seed, the text's shingles that the other text has form runs; runs closer than two shingle widths
    (an edited word or two) are one span. A span holds if it is at least ``width`` long and the Jaccard similarity of
    its shingles to those of the span they come from is at least ``similarity``. Where it doesn't, its unbroken runs
    are taken instead, then those that the other text has in one piece, and where none holds, the seed's own windows are
    compared. Of a shingle that stands in the other text more than once, the occurrence nearest to the seed's diagonal counts.
    """
    order, ordered, values, places = indexed or occurrences(theirs)
    low, high = np.searchsorted(ordered, mine), np.searchsorted(ordered, mine, side="right")
    hit = low < high
    spots = np.flatnonzero(hit)
    size = len(theirs) + 1
    value = np.searchsorted(values, mine)

    def nearest(shift: int) -> np.ndarray:
        """Of each hit, the occurrence nearest to the diagonal ``shift``."""
        goal = np.clip(spots + shift, 0, size - 1)
        after = np.searchsorted(places, value[spots] * size + goal)
        before, after = order[np.maximum(after - 1, low[spots])], order[np.minimum(after, high[spots] - 1)]
        return np.where(np.abs(before - goal) <= np.abs(after - goal), before, after)

    def diagonal(first: int, last: int, other: int) -> int:
        """The shift on which most shingles of the seed's windows stand (ties: the nearest to the seed's)."""
        some = spots[np.searchsorted(spots, first):np.searchsorted(spots, last + width)]
        counts = high[some] - low[some]
        if not len(some):
            return other - first
        ends = np.cumsum(counts)
        at = order[np.repeat(low[some] - (ends - counts), counts) + np.arange(ends[-1])]
        shifts = at - np.repeat(some, counts)
        base = int(shifts.min())
        votes = np.bincount(shifts - base)
        most = np.flatnonzero(votes == votes.max()) + base
        return int(most[np.argmin(np.abs(most - (other - first)))])

    def runs(gap: int) -> tuple[np.ndarray, np.ndarray]:
        breaks = np.flatnonzero(np.diff(spots) > gap)
        return spots[np.append(0, breaks + 1)], spots[np.append(breaks, len(spots) - 1)] + 1

    def aligned(where: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        breaks = np.flatnonzero((np.diff(spots) > 1) | (np.diff(where - spots) != 0))
        return spots[np.append(0, breaks + 1)], spots[np.append(breaks, len(spots) - 1)] + 1

    loose = [runs(2 * shingle), runs(1)] if len(spots) else []
    found: list[tuple[int, int, int, int, float]] = []
    failed = []

    def jaccard(a: int, b: int, c: int, d: int) -> float:
        one, two = set(mine[a:b].tolist()), set(theirs[c:d].tolist())
        both = len(one & two)
        return both / (len(one) + len(two) - both)

    def compare(a: int, b: int, c: int, d: int) -> bool:
        near = jaccard(a, b, c, d)
        if near >= similarity:
            found.append((a, b, c, d, near))
        return near >= similarity

    def holds(a: int, b: int, where: np.ndarray) -> bool:
        if any(x <= a and b <= y for x, y, *_ in found):
            return True
        if b - a < width:
            return False
        some = slice(*np.searchsorted(spots, (a, b)))
        shift = where[some] - spots[some]
        middle = np.sort(shift)[len(shift) // 2]
        held = where[some][np.abs(shift - middle) <= b - a]  # shingles that also stand elsewhere aside
        return compare(a, b, int(held.min()), int(held.max()) + 1)

    def on_diagonal(first: int, last: int, shift: int) -> bool:
        """Compare the window of the seed that has most shingles in place."""
        begin, stop = max(first, -shift), min(last, len(mine) - width, len(theirs) - width - shift)
        if begin > stop:
            return False
        at = np.arange(begin, stop + width)
        sums = np.append(0, np.cumsum(mine[at] == theirs[at + shift]))
        a = begin + int(np.argmax(sums[width:] - sums[:-width]))
        return compare(a, a + width, a + shift, a + shift + width)

    tried: dict[tuple[int, int, int], bool] = {}
    mapped: dict[int, tuple] = {}
    # as in likely(): no passage near a seed where no window without repeated shingles has enough that the other text has
    sums = np.append(0, np.cumsum(hit))
    windows = sums[width:] - sums[:-width] if len(mine) >= width else np.zeros(1, np.int64)
    before = earlier(mine)
    need = int(width * similarity * SLACK)
    reach = np.append(0, np.cumsum(coverable(hit, before, width, similarity)))

    def hopeless(first: int, last: int) -> bool:
        if reach[min(last + width, len(mine))] == reach[first]:  # no similar passage has any of its shingles
            return True
        low_, high_ = max(0, first - width), last + 2 * width
        return windows[low_:last + width + 1].max(initial=0) < need and before[low_:high_].max(initial=-1) < low_

    todo = np.asarray(seeds, np.int64).reshape(-1, 3)
    ends = len(mine) - width, len(theirs) - width
    if min(ends) < 0:
        return found, [(first, last) for first, last, _ in todo.tolist()]
    # a seed that stands on a shingle may start too late for a window: moved back, along its diagonal where the other text begins early enough
    late = np.maximum(0, np.maximum(todo[:, 0] - ends[0], todo[:, 2] - ends[1]))
    todo = np.stack([np.maximum(todo[:, 0] - late, 0), np.minimum(todo[:, 1], ends[0]), np.maximum(todo[:, 2] - late, 0)], axis=1)
    if len(todo):  # those near each other on one diagonal together
        shift, bucket = todo[:, 2] - todo[:, 0], todo[:, 0] // max(1, width // 2)
        line = np.lexsort((todo[:, 0], bucket, shift))
        edge = np.flatnonzero(np.append(True, (np.diff(shift[line]) != 0) | (np.diff(bucket[line]) != 0)))
        todo = np.stack([todo[line[edge], 0], np.maximum.reduceat(todo[line, 1], edge), todo[line[edge], 2]], axis=1)
    todo = todo[np.lexsort(todo.T[::-1])]
    seen = 0
    while len(todo):
        if len(found) > seen:
            for x, y, *_ in found[seen:]:
                todo = todo[(todo[:, 0] < x) | (todo[:, 1] + width > y)]
            seen = len(found)
            continue
        (first, last, other), todo = todo[0].tolist(), todo[1:]
        if hopeless(first, last):
            failed.append((first, last))
            continue
        good = False
        shift = diagonal(first, last, other)
        if shift not in mapped and len(spots):
            if len(mapped) == 64:
                mapped.clear()
            where = nearest(shift)
            mapped[shift] = where, [*loose, aligned(where)]
        for begins, stops in mapped[shift][1] if len(spots) else []:
            for i in np.flatnonzero((begins < last + width) & (stops > first)).tolist():
                span = int(begins[i]), int(stops[i])
                if (*span, shift) not in tried:
                    tried[(*span, shift)] = holds(*span, mapped[shift][0])
                good |= tried[(*span, shift)]
            if good:
                break
        if not good and not on_diagonal(first, last, shift) and not compare(first, first + width, other, other + width):
            failed.append((first, last))
    return found, failed


def verified(pairs: DataFrame, width: int, shingle: int, similarity: float) -> DataFrame:
    """Spans (in words) of each pair's text that near-repeat the kept text, and of pairs with failed seeds the first (``similarity`` null)."""
    schema = T.StructType([
        T.StructField("text_key", T.LongType()), T.StructField("doc_id", pairs.schema["doc_id"].dataType), T.StructField("first_word", T.IntegerType()),
        T.StructField("n_words", T.IntegerType()), T.StructField("first_char", T.IntegerType()), T.StructField("n_chars", T.IntegerType()), T.StructField("keep_id", pairs.schema["keep_id"].dataType), T.StructField("keep_first_word", T.IntegerType()),
        T.StructField("keep_n_words", T.IntegerType()), T.StructField("similarity", T.DoubleType()),
    ])
    out = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", 1 << 20):
            columns = {c: part.column(c).to_pylist() for c in ("text_key", "doc_id", "keep_id")}
            lists = part.column("seeds")
            seeds = np.stack([np.asarray(lists.flatten().field(f)) for f in ("first", "last", "keep_first")], axis=1).astype(np.int64)
            stops = np.cumsum(np.asarray(pc.list_value_length(lists)))
            texts, kept = _utf8(part.column("text")), _utf8(part.column("keep_text"))
            found = []
            other = {k: n for n, k in enumerate(dict.fromkeys(kept), len(texts))}
            hashed, owner, _ = shingles([*texts, *other], shingle)
            ends = np.searchsorted(owner, np.arange(len(texts) + len(other) + 1))
            last, indexed = -1, None
            for i, stop in enumerate(stops.tolist()):
                n = other[kept[i]]
                theirs = hashed[ends[n]:ends[n + 1]]
                if n != last:
                    last, indexed = n, occurrences(theirs)
                spans, failed = matched_spans(
                    hashed[ends[i]:ends[i + 1]], theirs, seeds[stops[i - 1] if i else 0:stop], width, shingle, similarity, indexed,
                )
                key, doc_id, keep_id = columns["text_key"][i], columns["doc_id"][i], columns["keep_id"][i]
                chars = char_bounds(texts[i]) if spans else None
                for a, b, c, d, near in spans:
                    first, last = chars[0][a], chars[1][b + shingle - 2]
                    found.append((key, doc_id, a, b - a + shingle - 1, first, last - first, keep_id, c, d - c + shingle - 1, near))
                found += [(key, doc_id, a, b, None, None, keep_id, None, None, None) for a, b in failed[:1]]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), out)], schema=out)

    return pairs.mapInArrow(run, schema)


def hash_prints(texts: DataFrame, shingle: int) -> DataFrame:
    """``text_key, prints``: 32 bits of the hash of every shingle of a text, in order."""
    out = pa.schema([("text_key", pa.int64()), ("prints", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            hashed, owner, _ = shingles(_utf8(part.column("text")), shingle)
            ends = np.searchsorted(owner, np.arange(part.num_rows + 1))
            short = hashed.astype(np.uint32)
            yield _records([part.column("text_key"), [short[a:b].tobytes() for a, b in zip(ends, ends[1:])]], out)

    return texts.select("text_key", "text").mapInArrow(run, "text_key long, prints binary")


def likely(windows: DataFrame, width: int, similarity: float) -> DataFrame:
    """Seeds with the hashes around them in both texts (``mine, theirs``), and ``ok``: whether a passage of ``width`` shingles there can be similar.

    A passage with that similarity has at least that share of its shingles in the other text, so some ``width`` neighbours have
    not much less (31 of 46 at 0.8, where all misses stand in the middle). Windows with repeated shingles are always ok.
    """
    fields = [f for f in windows.schema.fields if f.name not in ("mine", "theirs")]
    schema = T.StructType([*fields, T.StructField("ok", T.BooleanType())])
    out = to_arrow_schema(schema)
    need = int(width * similarity * SLACK)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                keys, rows = [], []
                for c in ("mine", "theirs"):
                    blobs = part.column(c).to_pylist()
                    row = np.repeat(np.arange(len(blobs)), [len(b) // 4 for b in blobs])
                    keys.append((row.astype(np.uint64) << np.uint64(32)) | np.frombuffer(b"".join(blobs), np.uint32))
                    rows.append(row)
                mine, row = keys[0], rows[0]
                sizes = np.bincount(row, minlength=part.num_rows)
                distinct = np.bincount((np.unique(mine) >> np.uint64(32)).astype(np.int64), minlength=part.num_rows) == sizes
                sums = np.append(0, np.cumsum(np.isin(mine, keys[1])))
                most = np.zeros(part.num_rows, np.int64)
                if len(mine) >= width:
                    inside = row[: len(mine) - width + 1] == row[width - 1:]
                    np.maximum.at(most, row[: len(inside)][inside], (sums[width:] - sums[:-width])[inside])
                ok = ~distinct | (most >= need) | (sizes < width)
                yield pa.RecordBatch.from_arrays([*[part.column(f.name) for f in fields], pa.array(ok)], schema=out)

    return windows.mapInArrow(run, schema)


def window_digests(texts: DataFrame, width: int, shingle: int) -> DataFrame:
    """Of every start within a text's ``spans`` (``first, last``) a digest of the passage of exactly ``width`` shingles there: ``digest, text_key, doc_id,
    first``."""
    schema = T.StructType([
        T.StructField("digest", T.LongType()), T.StructField("text_key", T.LongType()), T.StructField("doc_id", texts.schema["doc_id"].dataType), T.StructField("first", T.IntegerType()),
    ])
    out = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            hashed, owner, _ = shingles(_utf8(part.column("text")), shingle)
            ends = np.searchsorted(owner, np.arange(part.num_rows + 1))
            for i in range(part.num_rows):
                mine = hashed[ends[i]:ends[i + 1]]
                if len(mine) < width:
                    continue
                total = np.zeros(len(mine) - width + 1, np.uint64)
                for j in range(width):
                    total = total * ODD + mine[j: len(mine) - width + 1 + j]
                spans = part.column("spans")[i].values
                edge = np.zeros(len(total) + 1, np.int64)
                np.add.at(edge, np.asarray(spans.field("first")), 1)
                np.add.at(edge, np.asarray(spans.field("last")) + 1, -1)
                at = np.flatnonzero(np.cumsum(edge[:-1]) > 0)
                rows = pa.array(np.full(len(at), i))
                yield _records([mix(total[at]).view(np.int64), part.column("text_key").take(rows), part.column("doc_id").take(rows), at], out)

    return texts.select("text_key", "doc_id", "text", "spans").mapInArrow(run, schema)


def place_shingles(texts: DataFrame, width: int, shingle: int) -> DataFrame:
    """Of each text the shingles that a passage near one of its ``spans`` (``first, last``) may have: ``h, text_key, doc_id, first``."""
    schema = T.StructType([
        T.StructField("h", T.LongType()), T.StructField("text_key", T.LongType()), T.StructField("doc_id", texts.schema["doc_id"].dataType), T.StructField("first", T.IntegerType()),
    ])
    out = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            hashed, owner, _ = shingles(_utf8(part.column("text")), shingle)
            ends = np.searchsorted(owner, np.arange(part.num_rows + 1))
            spans = part.column("spans")
            whose = np.repeat(np.arange(part.num_rows), np.asarray(pc.list_value_length(spans)))
            first, last = (ends[whose] + np.asarray(spans.flatten().field(f)) for f in ("first", "last"))
            edge = np.zeros(len(hashed) + 1, np.int64)
            np.add.at(edge, np.clip(first - width, ends[whose], ends[whose + 1]), 1)
            np.add.at(edge, np.clip(last + 2 * width, ends[whose], ends[whose + 1]), -1)
            at = np.flatnonzero(np.cumsum(edge[:-1]) > 0)
            rows = pa.array(owner[at])
            yield _records([hashed[at].view(np.int64), part.column("text_key").take(rows), part.column("doc_id").take(rows), at - ends[owner[at]]], out)

    return texts.select("text_key", "doc_id", "text", "spans").mapInArrow(run, schema)


def rare_prefixes(texts: DataFrame, width: int, shingle: int, similarity: float) -> DataFrame:
    """Of each place of a text (``spans``: ``first, last``) the shingles of which a similar text has at least one: ``h, text_key, doc_id, first, last, at``.

    ``shared`` are the shingles (``h``) of the text that others have too, and their numbers (``n``). As in :func:`likely`, a similar passage has ``need`` of some
    ``width`` neighbours; so of these any ``width - need + 1`` hold one of them. The rarest are taken, and a window with fewer than ``need``
    shared shingles has no similar passage at all. Windows with repeated shingles give all that are shared, unless no span around them has
    that share of ``width`` among its distinct shingles.
    """
    schema = T.StructType([
        T.StructField("h", T.LongType()), T.StructField("text_key", T.LongType()), T.StructField("doc_id", texts.schema["doc_id"].dataType),
        T.StructField("first", T.IntegerType()), T.StructField("last", T.IntegerType()), T.StructField("at", T.IntegerType()),
    ])
    out = to_arrow_schema(schema)
    need = int(width * similarity * SLACK)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            hashed, owner, _ = shingles(_utf8(part.column("text")), shingle)
            ends = np.searchsorted(owner, np.arange(part.num_rows + 1))
            for i in range(part.num_rows):
                mine, shared = hashed[ends[i]:ends[i + 1]], part.column("shared")[i].values
                known, n = np.asarray(shared.field("h")).view(np.uint64), np.asarray(shared.field("n"))
                if len(mine) < width or not len(known):
                    continue
                order = np.argsort(known)
                known, rank = known[order], np.argsort(np.lexsort((known, n)))[order]  # rarest first
                spot = np.minimum(np.searchsorted(known, mine), len(known) - 1)
                rank = np.where(known[spot] == mine, rank[spot], len(known))
                before = earlier(mine)
                spans = part.column("spans")[i].values
                for first, last in zip(spans.field("first").to_pylist(), spans.field("last").to_pylist()):
                    low, high = max(0, first - width), min(len(mine), last + 2 * width)
                    if high - low < width:
                        continue
                    ranks = np.lib.stride_tricks.sliding_window_view(rank[low:high], width)
                    starts = np.arange(low, high - width + 1)
                    repeats = np.lib.stride_tricks.sliding_window_view(before[low:high], width).max(axis=1) >= starts
                    both = (ranks < len(known)).sum(axis=1)
                    within = np.append(0, np.cumsum(coverable(rank[low:high] < len(known), np.maximum(before[low:high] - low, -1), width, need / width)))
                    some = np.flatnonzero(np.where(repeats, (both > 0) & (within[width:] - within[:-width] == width), both >= need))
                    if not len(some):
                        continue
                    take = np.where(repeats[some], both[some], both[some] - need + 1)
                    places = starts[some][:, None] + np.argsort(ranks[some], axis=1, kind="stable")
                    at = np.unique(places[np.arange(width) < take[:, None]])
                    rows = pa.array(np.full(len(at), i))
                    yield _records([mine[at].view(np.int64), part.column("text_key").take(rows), part.column("doc_id").take(rows), np.full(len(at), first), np.full(len(at), last), at], out)

    return texts.select("text_key", "doc_id", "text", "spans", "shared").mapInArrow(run, schema)


def repeated_passages(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_words: int = 50,
    shingle: int = 5,
    similarity: float = 0.8,
    hashes: int = 4,
    agree: int = 2,
) -> DataFrame:
    """One row per repeated passage: ``doc_id, first_word, n_words, first_char, n_chars, keep_id, keep_first_word,
    keep_n_words, similarity``.

    The passage of ``n_words`` (at least ``min_words``) from ``first_word`` (``n_chars`` code points from ``first_char``) near-repeats that of the document ``keep_id``,
    which has a smaller id: the Jaccard similarity of their ``shingle``-word shingles is at least ``similarity``.
    Words are split at ASCII white space and compared with A-Z lower-cased.

    1. For every text, the compact windows under ``hashes`` hash functions give tiles of passage starts, written with
       their smallest hash. Tiles whose hash no other text has under that function are done with.
    2. Of what is left, the tiles of any ``agree`` functions are intersected; intervals that agree in those functions meet
       in a group. All of a group are linked to its document of smallest id.
    3. Each link is verified on the texts themselves and extended as far as the passages match. A member has one link to a text, whatever the number
       of its intervals there.
    4. In texts with a failed link, what no found passage holds meets by digests of the exact passages; what none holds by half then is linked to the first four
       texts of the smaller groups of members that agree in three functions. So each round makes links in
       proportion to its members, and none compares all pairs of a group. Pairs with few seeds ship the windows around them, not their texts, until these look alike.
    5. What is still open, and had more smaller texts in a group than these steps looked at, is compared with all the others: every text that has one of the rarest
       shingles of its windows, of which a similar text must have one, in slices of rising id that double until it is found or no text is left. Only shingles that
       several texts have count, so a common line among words of their own makes no pair. Families of texts that stay below ``similarity`` to each
       other cost comparisons by the square of their size, in slices in proportion to what is open.

    Verbatim passages of ``min_words`` words always meet, and a near repeat that meets another in a group is compared with it unless a passage is found at its place
    before. As with any min-hashing, edited ones meet with a chance: for
    similarity s and any two of four functions, 1 - (1 - s)**4 - 4 * s * (1 - s)**3 at each independent place (0.973 at 0.8,
    0.988 at 0.85, 0.996 at 0.9), so passages much longer than ``min_words`` are rarely missed.
    Exact copies of a text are one text in these steps; each copy is then one row, its whole text repeating the copy of
    smallest id. Counts are combined before they are shuffled; a hot signature's rows are split by the skew joins.

    Defined cases: null, empty and shorter texts have no passage; a null id counts as smallest; rows that repeat id
    and text are one document that doesn't repeat itself, a passage repeated within one text is not reported;
    empty input gives no rows; other columns are ignored.
    """
    width = min_words - shingle + 1
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).withColumn("text_key", F.xxhash64("text"))
    windows = written(all_intervals(rows, hashes, width, shingle), "windows")

    def shared(table: DataFrame, *by: str) -> DataFrame:
        ends = table.groupBy(*by).agg(F.min("text_key").alias("low"), F.max("text_key").alias("high"))
        return written(ends.filter("low <> high").select(*by), "shared")

    whole = written(windows.filter("first = 0").select("text_key", "n_words").distinct(), "lengths")
    met = shared(windows, "k", "sig")
    tiles = windows.join(met, ["k", "sig"]).groupBy("text_key").agg(F.collect_set(F.struct("k", "first", "last", "sig")).alias("tiles"))
    tiles = written(tiles.filter(F.size(F.array_distinct("tiles.k")) >= agree), "tiles")
    discard(windows, met)
    sources = written(
        rows.join(tiles, "text_key").groupBy("text_key").agg(
            F.min("doc_id").alias("doc_id"), F.first("text").alias("text"), F.first("tiles").alias("tiles")
        ),
        "passage-sources",
    )
    found: list[DataFrame] = []
    texts = sources.select("text_key", "doc_id", "text")
    kept = texts.toDF("keep_key", "keep_id", "keep_text")
    member, keeper = F.struct("doc_id", "text_key"), F.struct("keep.doc_id", "keep.text_key")

    prints = written(hash_prints(texts, shingle), "prints")

    def around(blob: str, first: Column, until: Column) -> Column:
        """The hashes from ``width`` before the first to ``width`` behind the last shingle of a passage that starts in [first, until]."""
        start = F.greatest(first - width, F.lit(0))
        return F.substring(blob, (4 * start + 1).cast("int"), (4 * (until + 2 * width - start)).cast("int"))

    def verify(links: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Found passages, and the texts that have a seed without one."""
        seeds = links.groupBy("text_key", F.col("keep.text_key").alias("keep_key")).agg(
            F.collect_set(F.struct("first", "last", F.col("keep.first").alias("keep_first"))).alias("seeds")
        )
        seeds = written(seeds, "seeds")
        few = seeds.filter(F.size("seeds") <= FEW).select("text_key", "keep_key", F.inline("seeds"))
        mine = few.join(prints, "text_key").select(*few.columns, around("prints", F.col("first"), F.col("last")).alias("mine"))
        both = mine.join(prints.toDF("keep_key", "prints"), "keep_key").select(*mine.columns, around("prints", F.col("keep_first"), F.col("keep_first") + F.col("last") - F.col("first")).alias("theirs"))
        judged = written(likely(both, width, similarity), "judged")
        again = judged.filter("ok").groupBy("text_key", "keep_key").agg(F.collect_set(F.struct("first", "last", "keep_first")).alias("seeds"))
        pairs = written(seeds.filter(F.size("seeds") > FEW).unionByName(again), "pairs")
        whole = pairs.join(texts, "text_key").join(kept, "keep_key").select("text_key", "doc_id", "text", "seeds", "keep_id", "keep_text")
        result = written(verified(whole, width, shingle, similarity), "passages")
        open_texts = judged.filter("NOT ok").select("text_key").union(result.filter("similarity IS NULL").select("text_key"))
        left = written(open_texts.distinct(), "failed")
        discard(seeds, judged, pairs)
        return result.filter("similarity IS NOT NULL"), left

    def without_held(pool: DataFrame, failed: DataFrame, words: int) -> DataFrame:
        """Of texts with a failed link, the members of which no found passage holds ``words`` words."""
        spans = reduce(DataFrame.unionByName, found).select("text_key", F.col("first_word").alias("a"), (F.col("first_word") + F.col("n_words")).alias("b")).distinct()
        overlap = F.least("b", F.col("first") + min_words) - F.greatest("a", "first")
        return written(pool.join(failed, "text_key", "left_semi").join(spans, [pool["text_key"] == spans["text_key"], overlap >= words], "left_anti"), "open")

    def keepers(groups: DataFrame, by: str, low: int, high: int) -> DataFrame:
        """Of each group the texts of the ``low``-th to ``high``-th smallest id, each with one interval: no products of intervals."""
        keep = F.struct("doc_id", "text_key", "first").alias("keep")
        if high == 1:
            return written(groups.groupBy(by).agg(F.min(keep).alias("keep")), "keepers")
        one = groups.groupBy(by, "doc_id", "text_key").agg(F.min("first").alias("first"))
        rank = F.row_number().over(Window.partitionBy(by).orderBy("doc_id", "text_key"))
        return written(one.withColumn("n", rank).filter(F.col("n").between(low, high)).select(by, keep), "keepers")

    smaller = (keeper < member) & (F.col("text_key") != F.col("keep.text_key"))

    def verbatim(pool: DataFrame, failed: DataFrame) -> DataFrame:
        """Passages from the exact repeats of what is open, and of the other members of its groups."""
        open_ = without_held(pool, failed, min_words)
        groups = pool.join(written(open_.select("sig").distinct(), "open-groups"), "sig", "left_semi")
        places = groups.groupBy("text_key").agg(F.collect_set(F.struct("first", "last")).alias("spans"))
        digests = written(window_digests(texts.join(places, "text_key"), width, shingle), "digests")
        same = digests.join(shared(digests, "digest"), "digest")
        still = same.join(written(open_.select("text_key").distinct(), "open-texts"), "text_key", "left_semi").withColumn("last", F.col("first"))
        passages, _ = verify(still.join(keepers(same, "digest", 1, 1), "digest").filter(smaller))
        discard(open_, digests)
        return passages

    def rest(pool: DataFrame, failed: DataFrame) -> None:
        """Passages from the texts of a group that no round has compared with its open members."""
        open_ = without_held(pool, failed, min_words // 2)
        groups = pool.join(written(open_.select("sig").distinct(), "open-groups"), "sig", "left_semi")
        others = groups.join(keepers(groups, "sig", 1, 1), "sig").filter(F.col("text_key") != F.col("keep.text_key"))
        second = written(others.groupBy("sig").agg(F.min(member).alias("second")), "second")
        late = written(open_.join(second, "sig").filter(F.col("second") < member), "late")
        if late.isEmpty():
            return
        spans = F.collect_set(F.struct("first", "last")).alias("spans")
        places = groups.join(written(late.select("sig").distinct(), "late-groups"), "sig", "left_semi").groupBy("text_key").agg(spans)
        own = written(place_shingles(texts.join(places, "text_key"), width, shingle), "place-shingles")
        ends = own.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.min("text_key").alias("low"), F.max("text_key").alias("high"))
        numbers = written(ends.filter("low <> high").select("h", "n"), "shared-shingles")
        asked = written(late.groupBy("text_key").agg(spans), "late-places")
        shared_ = own.select("h", "text_key").distinct().join(asked, "text_key", "left_semi").join(numbers, "h").groupBy("text_key").agg(F.collect_list(F.struct("h", "n")).alias("shared"))
        prefixes = rare_prefixes(texts.join(asked, "text_key").join(written(shared_, "shared-of-text"), "text_key"), width, shingle, similarity)
        open_ = written(prefixes, "prefixes")
        asked_for = own.join(written(open_.select("h").distinct(), "prefix-shingles"), "h", "left_semi")
        near = F.floor(F.col("first") / width)  # of a shingle that a text repeats, one place in every ``width``
        by_shingle = written(asked_for.groupBy("h", "text_key", "doc_id", near.alias("near")).agg(F.min("first").alias("first")), "by-shingle")
        places = by_shingle.select("h", F.col("text_key").alias("keep_key"), F.col("first").alias("keep_first"))
        discard(own)
        first = F.greatest(F.col("at") - width + 1, F.col("at") - F.col("keep_first"), F.lit(0))
        low, high = 1, 4
        while not open_.isEmpty():
            chosen = keepers(by_shingle, "h", low, high)
            if chosen.isEmpty():
                break
            links = open_.join(chosen, "h").filter(smaller).withColumn("keep_key", F.col("keep.text_key")).join(places, ["h", "keep_key"])
            links = links.select("text_key", "keep_key", "first", (F.col("keep_first") - F.col("at")).alias("shift"), first.alias("a"), "at")
            seeds = links.groupBy("text_key", "keep_key", "first", "shift").agg(F.min("a").alias("a"), F.max("at").alias("last"))
            keep = F.struct(F.col("keep_key").alias("text_key"), (F.col("a") + F.col("shift")).alias("first")).alias("keep")
            passages, _ = verify(seeds.select("text_key", F.col("a").alias("first"), "last", keep))
            found.append(passages)
            open_ = without_held(open_, failed, min_words // 2)
            low, high = high + 1, 3 * high - 2 * low + 2

    failed = None
    for agree_, low, high in ROUNDS:
        pool = written(signatures(sources, hashes, agree_), "intervals")
        open_, groups = pool, pool
        if failed is not None:
            open_ = without_held(pool, failed, min_words // 2)
            groups = pool.join(written(open_.select("sig").distinct(), "open-groups"), "sig", "left_semi")
        passages, left = verify(open_.join(keepers(groups, "sig", low, high), "sig").filter(smaller))
        found.append(passages)
        if failed is None:
            failed = left
            if failed.isEmpty():
                break
            found.append(verbatim(pool, failed))
            every = pool
        else:
            discard(pool)
    if failed is not None and len(found) > 1:
        rest(every, failed)
        discard(every)
    passages = reduce(DataFrame.unionByName, found).drop("text_key").distinct()

    classes = rows.groupBy("text_key").agg(F.min(F.struct("doc_id")).alias("keep"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    copies = (
        rows.select("doc_id", "text_key", F.length("text").alias("n_chars")).distinct().join(classes, "text_key").filter(~F.col("doc_id").eqNullSafe(F.col("keep.doc_id"))).join(whole, "text_key")
        .select("doc_id", F.lit(0).alias("first_word"), "n_words", F.lit(0).alias("first_char"), "n_chars", F.col("keep.doc_id").alias("keep_id"), F.lit(0).alias("keep_first_word"),
                F.col("n_words").alias("keep_n_words"), F.lit(1.0).alias("similarity"))
    )
    return passages.unionByName(copies)
