"""Phrase collocations by set-oriented (SETM) mining: relations of occurrences, joined by position, counted and thinned by length.

The relation of occurrences is kept per block of text, as one sorted column: an entry per word in the order of document,
piece and position, with a gap between pieces. An entry names its phrase by a number of the block. The block's distinct phrases with their counts
are dealt by a hash into parts; a part meets the same part of all other blocks, where they are counted, and tells each block which of
its numbers are frequent. So a phrase, however frequent, is one entry per block in every shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kickwx.llm.batches import give_back, slices
from kickwx.llm.scratch import written
from kickwx.llm.substring_dedup import ODD, mix

UNKNOWN = "und"
BLOCK_BYTES = 4 << 20
PART = 1 << 20  # occurrences whose phrases are counted by one task
RANKED = 50_000  # candidates of a language ranked by one task
# A-Z to lower case; the marks that end a piece, to a dot; a tab to a space.
FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ,;:!?\x0a\x0b\x0c\x0d\x09", b"abcdefghijklmnopqrstuvwxyz.........\x20")


def split_words(texts: list[bytes]) -> tuple[np.ndarray, list[bytes]]:
    """The words of all texts in order, as numbers into the list of distinct words; -1 between pieces."""
    tokens = b".".join(texts).translate(FOLD).replace(b".", b" . ").split()
    coded = pa.array(tokens, pa.large_binary()).dictionary_encode()
    numbers, words = np.asarray(coded.indices).astype(np.int64), coded.dictionary.to_pylist()
    if b"." in words:
        dot = words.index(b".")
        numbers = np.where(numbers == dot, -1, numbers - (numbers > dot))
        del words[dot]
    return numbers, words


RELATION = pa.schema([
    ("block", pa.int64()), ("at", pa.binary()), ("part", pa.int32()), ("base", pa.int32()), ("lang", pa.string()),
    ("head", pa.binary()), ("next", pa.binary()), ("count", pa.binary()),
])
RELATION_SQL = "block long, at binary, part int, base int, lang string, head binary, next binary, count binary"
COUNTED = pa.schema([
    ("block", pa.int64()), ("number", pa.binary()), ("ids", pa.binary()), ("lang", pa.string()), ("word", pa.string()),
    ("id", pa.int64()), ("head", pa.int64()), ("next", pa.int64()), ("a", pa.int64()), ("n", pa.int64()),
])
COUNTED_SQL = "block long, number binary, ids binary, lang string, word string, id long, head long, next long, a long, n long"


def _pack(values: bytes | np.ndarray) -> bytes:
    """Compressed, behind its length."""
    raw = values if isinstance(values, bytes) else values.tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _bytes(blob: bytes) -> bytes:
    return pa.decompress(blob[8:], decompressed_size=int.from_bytes(blob[:8], "little"), codec="zstd", asbytes=True)


def _numbers(blob: bytes, kind: type = np.int64) -> np.ndarray:
    return np.frombuffer(_bytes(blob), kind)


def _rows(schema: pa.Schema, rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=schema)


def word_relation(docs: DataFrame, parts: int) -> DataFrame:
    """Per block one row with ``at`` (its occurrences), and one row per language and part with the distinct words there (``head``),
    whose numbers follow from ``base``, and their ``count``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for piece in slices(batches, "text", BLOCK_BYTES):
            texts: dict[str, list[bytes]] = {}
            for lang, text in zip(piece.column("lang").to_pylist(), piece.column("text").to_pylist()):
                texts.setdefault(lang, []).append(text.encode("utf-8", "surrogatepass"))
            at, rows, seen = [], [], 0
            for lang, some in texts.items():
                numbers, words = split_words(some)
                part = np.array([xxhash.xxh32_intdigest(w) % parts for w in words], np.int64)
                order = np.argsort(part, kind="stable")
                place = np.append(np.argsort(order), -1)  # of each word's number; the last for a gap
                at += [np.where(numbers < 0, -1, place[numbers] + seen), np.array([-1])]
                count = np.bincount(numbers[numbers >= 0], minlength=len(words))[order].astype(np.int32)
                for first, last, of in _runs(part[order]):
                    rows.append({"block": block, "part": of, "base": seen + first, "lang": lang, "head": _pack(b" ".join(words[i] for i in order[first:last].tolist())), "count": _pack(count[first:last])})
                seen += len(words)
            if seen:
                yield _rows(RELATION, [*rows, {"block": block, "at": _pack(np.concatenate(at).astype(np.int32))}])
                block += 1
        give_back()

    return docs.mapInArrow(run, RELATION_SQL)


def _runs(values: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """First, behind last and value of the runs of equal values."""
    if len(values):
        edges = [0, *(np.flatnonzero(np.diff(values)) + 1).tolist(), len(values)]
        yield from ((a, b, int(values[a])) for a, b in zip(edges, edges[1:]))


def longer_relation(blocks: DataFrame, marks: DataFrame, parts: int) -> DataFrame:
    """The occurrences of phrases one word longer, from ``blocks`` (``block, at``) and ``marks`` (``block, number, ids``: which of a block's
    numbers are frequent, and their ids).

    An occurrence of a frequent phrase at a position meets, by a merge on position, that at the next one, which overlaps it in all words
    but the first and the last; both have to be frequent for the longer phrase to be. Gives rows of the same kind as
    :func:`word_relation`, with the ids of both phrases (``head, next``) as the name of the longer one.
    """

    def join(key: tuple, block: pa.Table, marks: pa.Table) -> pa.Table:
        if not block.num_rows or not marks.num_rows:
            return RELATION.empty_table()
        at = _numbers(block.column("at")[0].as_py(), np.int32)
        ids = np.full(int(at.max(initial=-1)) + 2, -1, np.int64)  # the last place answers for a gap
        for number, some in zip(marks.column("number").to_pylist(), marks.column("ids").to_pylist()):
            ids[_numbers(number, np.int32)] = _numbers(some)
        here = ids[at] >= 0
        starts = np.flatnonzero(here[:-1] & here[1:])
        if not len(starts):
            return RELATION.empty_table()
        pairs, numbers, counts = np.unique(at[starts].astype(np.int64) * len(ids) + at[starts + 1], return_inverse=True, return_counts=True)
        head, behind = ids[pairs // len(ids)], ids[pairs % len(ids)]
        part = (mix(head.astype(np.uint64) * ODD + behind.astype(np.uint64)) % np.uint64(parts)).astype(np.int64)
        order = np.lexsort((behind, head, part))
        place = np.argsort(order)
        found = np.full(len(at), -1, np.int32)
        found[starts] = place[numbers]
        head, behind, counts, name = head[order], behind[order], counts[order].astype(np.int32), key[0].as_py()
        rows = [{"block": name, "part": of, "base": a, "head": _pack(head[a:b]), "next": _pack(behind[a:b]), "count": _pack(counts[a:b])} for a, b, of in _runs(part[order])]
        return pa.Table.from_batches([_rows(RELATION, [*rows, {"block": name, "at": _pack(found)}])])

    marks = marks.select(F.col("block").alias("of"), "number", "ids")
    return blocks.groupBy("block").cogroup(marks.groupBy("of")).applyInArrow(join, RELATION_SQL)


def counted(relation: DataFrame, least: int) -> DataFrame:
    """A relation's phrases counted over all blocks: frequent ones (``id, lang, word`` or ``id, head, next``, with ``a``), per
    block the ``number`` and ``ids`` of its frequent ones, and of words each language's ``n``."""

    def count(key: tuple, table: pa.Table) -> pa.Table:
        part, words = key[0].as_py(), table.column("lang").null_count == 0
        blocks, base, langs = (table.column(c).to_pylist() for c in ("block", "base", "lang"))
        counts = [_numbers(c, np.int32) for c in table.column("count").to_pylist()]
        sizes = np.array([len(c) for c in counts])
        times = np.concatenate(counts).astype(np.int64)
        heads = [_bytes(h) for h in table.column("head").to_pylist()]
        if words:
            lang = pa.array(langs).dictionary_encode()
            second = np.repeat(np.asarray(lang.indices).astype(np.int64), sizes)
            coded = pa.array([w for h in heads for w in h.split(b" ")], pa.large_binary()).dictionary_encode()
            first = np.asarray(coded.indices).astype(np.int64)
        else:
            first, second = np.frombuffer(b"".join(heads), np.int64), np.concatenate([_numbers(h) for h in table.column("next").to_pylist()])
        del heads
        order = np.lexsort((second, first))
        new = np.append(True, (np.diff(first[order]) != 0) | (np.diff(second[order]) != 0))
        edge = np.flatnonzero(new)
        sums = np.add.reduceat(times[order], edge)
        often = np.flatnonzero(sums >= least)
        ids = np.full(len(edge), -1, np.int64)
        ids[often] = (part << 32) + np.arange(len(often))
        of = np.empty(len(order), np.int64)
        of[order] = ids[np.cumsum(new) - 1]
        out = []
        for block, zero, some in zip(blocks, base, np.split(of, np.cumsum(sizes)[:-1])):
            held = np.flatnonzero(some >= 0)
            if len(held):
                out.append({"block": block, "number": _pack((held + zero).astype(np.int32)), "ids": _pack(some[held])})
        x, y = first[order][edge[often]], second[order][edge[often]]
        phrases = {"id": ids[often], "a": sums[often]}
        if words:
            phrases |= {"lang": lang.dictionary.take(pa.array(y)), "word": pa.array([w.decode("utf-8", "replace") for w in coded.dictionary.take(pa.array(x)).to_pylist()], pa.string())}
            totals = np.bincount(second, weights=times)  # exact below 2 ** 53
            out += [{"lang": name, "n": int(n)} for name, n in zip(lang.dictionary.to_pylist(), totals)]
        else:
            phrases |= {"head": x, "next": y}
        columns = [pa.array(phrases[f.name], f.type) if f.name in phrases else pa.nulls(len(often), f.type) for f in COUNTED]
        return pa.Table.from_batches([_rows(COUNTED, out), pa.RecordBatch.from_arrays(columns, schema=COUNTED)])

    entries = relation.filter("part IS NOT NULL").select("block", "part", "base", "lang", "head", "next", "count")
    return entries.groupBy("part").applyInArrow(count, COUNTED_SQL)


def _decimal(column: Column) -> Column:
    return column.cast("decimal(20,0)")


def _first(rows: DataFrame, per: str, order: list[Column], spread: str, limit: int) -> DataFrame:
    """The first ``limit`` rows of each value of ``per`` with their ``rank``; no task ranks many more than ``RANKED``.

    Rows are dealt by a hash of ``spread`` and each share gives its first ones, until one share is left.
    """
    while True:
        most = rows.groupBy(per).count().agg(F.max("count")).first()[0] or 0
        shares = -(-most // max(RANKED, 2 * limit))
        if shares <= 1:
            rank = F.row_number().over(Window.partitionBy(per).orderBy(*order))
            return rows.withColumn("rank", rank.cast("long")).filter(F.col("rank") <= limit)
        share = F.pmod(F.xxhash64(spread), F.lit(shares))
        rank = F.row_number().over(Window.partitionBy(per, share).orderBy(*order))
        rows = written(rows.withColumn("rank", rank).filter(F.col("rank") <= limit).drop("rank"), "ranked")


def mine_phrases(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", longest: int = 4, least: int = 30, within: int = 80, limit: int = 2000,
) -> DataFrame:
    """Each language's first phrases: ``lang, rank, phrase, a, l, r, n, score``.

    Texts are lower-cased (A-Z), split at ``.,;:!?`` and line ends into pieces and those at spaces and tabs into words. Candidates are
    phrases of 2 to ``longest`` words that occur contiguously at least ``least`` times (``a``) in a language, of ``n`` word occurrences. A cut after
    k words gives l and r, the counts of both parts, and floor(2000000 * a / (l + r)); the lowest cut (ties: the smallest k) scores. A candidate is dropped if a longer candidate that holds
    it occurs at least ``within`` percent as often. The first ``limit`` by score, then ``a``, falling, then phrase are returned.

    Every length goes through the same steps: the relation of occurrences is written; its phrases are counted over all blocks, part by part;
    the frequent ones go back to their blocks; and in each block the thinned occurrences are merged with those at the next position.
    A phrase is named by the ids of the two shorter phrases it consists of, so counts are exact. A part holds about a million
    occurrences' phrases, whatever the size of the corpus, and one entry per block of a phrase that all blocks hold.

    Defined cases: a null language is ``und``; null, empty and wordless texts have no word; repeated rows count as often as they
    come; ties in all of the order can't occur; a language without candidates, and empty input, give no rows; other columns are ignored. A text
    longer than a block of 4 MB is a block of its own.
    """
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col(text_col).cast("string").alias("text")).filter("text IS NOT NULL")
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = lambda occurrences: max(32, -(-occurrences // PART))
    relation = written(word_relation(texts, parts(size // 8)), "words-relation")
    count = written(counted(relation, least), "words-counted")
    totals = written(count.filter("n IS NOT NULL").groupBy("lang").agg(F.sum("n").alias("n")), "word-totals")
    names = [written(count.filter("id IS NOT NULL").select("id", "lang", F.col("word").alias("phrase"), F.col("word").alias("last"), "a", F.lit(1).alias("words")), "phrases")]
    for length in range(2, longest + 1):
        occurrences = names[-1].agg(F.sum("a")).first()[0] or 0
        relation = written(longer_relation(relation.filter("at IS NOT NULL").select("block", "at"), count.filter("block IS NOT NULL"), parts(occurrences)), f"phrases-{length}-relation")
        count = written(counted(relation, least), f"phrases-{length}-counted")
        head = names[-1].select(F.col("id").alias("head"), "lang", "phrase")
        behind = names[-1].select(F.col("id").alias("next"), "last")
        spelled = count.filter("id IS NOT NULL").select("id", "head", "next", "a").join(head, "head").join(behind, "next")
        names.append(written(spelled.select("id", "lang", F.concat_ws(" ", "phrase", "last").alias("phrase"), "last", "a", F.lit(length).alias("words")), "phrases"))

    every = names[0]
    for more in names[1:]:
        every = every.unionByName(more)
    every = every.select("lang", "phrase", "a", "words")
    word = F.split("phrase", " ")
    part = lambda first, size: F.array_join(F.slice(word, first, size), " ")
    candidates = every.filter("words > 1")
    inner = (
        candidates.filter("words > 2").select("*", F.explode(F.sequence(F.lit(2), F.col("words") - 1)).alias("size"))
        .select("*", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("size") + 1)).alias("at"))
        .select("lang", part(F.col("at"), F.col("size")).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    )
    share = _decimal(F.col("longer")) * 100 >= _decimal(F.col("a")) * within
    stay = candidates.join(inner, ["lang", "phrase"], "left").filter(F.coalesce(~share, F.lit(True))).drop("longer")
    cuts = stay.select("*", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k")).select(
        "*", part(F.lit(1), F.col("k")).alias("left"), part(F.col("k") + 1, F.col("words") - F.col("k")).alias("right"))
    sides = every.select("lang", F.col("phrase").alias("left"), F.col("a").alias("l")), every.select("lang", F.col("phrase").alias("right"), F.col("a").alias("r"))
    scored = cuts.join(sides[0], ["lang", "left"]).join(sides[1], ["lang", "right"]).withColumn(
        "score", F.expr("(CAST(a AS DECIMAL(20,0)) * 2000000) div (CAST(l AS DECIMAL(20,0)) + CAST(r AS DECIMAL(20,0)))"))
    lowest = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut")).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    best = _first(written(lowest, "scored-phrases"), "lang", order, "phrase", limit)
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
