"""Toxicity by the nearest labelled examples: exact TF-IDF cosine over a block-max inverted index."""

from __future__ import annotations

import re
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from kickwx.llm.batches import slices
from kickwx.llm.scratch import written

WORD = re.compile(r"[^\W\d_]+")
ASCII_WORD = re.compile(r"[a-z]+")  # the same in lower-cased ASCII
STEMS = (4, 5)
BLOCK = 64
QUERIES = 64
CELLS = 4  # blocks from which on a term's maxima and places are full rows
MEMO_WORDS = 500_000


def words_of(text: str | None) -> list[str]:
    lower = (text or "").lower()
    return (ASCII_WORD if lower.isascii() else WORD).findall(lower)


def terms_of(word: str) -> list[str]:
    """A word and its opening stems, marked with a star."""
    return [word, *(f"{word[:n]}*" for n in STEMS if len(word) > n)]


class TermTable(dict):
    """Rows of term numbers (word, then stems; -1: not in the vocabulary), worked out once per word met."""

    def __init__(self, number: dict[str, int]):
        super().__init__()
        self.number, self.rows = number, array("i")
        self.clear()

    def clear(self) -> None:
        super().clear()
        self.rows = array("i", [-1] * (1 + len(STEMS)))  # the row of all words without a term

    def __missing__(self, word: str) -> int:
        known, size = self.number.get, len(word)
        own = [known(word, -1), *[known(f"{word[:n]}*", -1) if size > n else -1 for n in STEMS]]
        if max(own) < 0:
            self[word] = 0
            return 0
        at = self[word] = len(self.rows) // (1 + len(STEMS))
        self.rows.extend(own)
        return at

    def counts(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Term numbers of all texts, ascending within each, how often each occurs in its whole text, and the
        place of each text's first (and of the end)."""
        if len(self) >= MEMO_WORDS:
            self.clear()
        words = [Counter(words_of(t)) for t in texts]
        sizes = [len(w) for w in words]
        at = np.fromiter((self[w] for own in words for w in own), np.int64, sum(sizes))
        often = np.fromiter((n for own in words for n in own.values()), np.int64, sum(sizes))
        terms = np.array(self.rows, np.int32).reshape(-1, 1 + len(STEMS))[at]
        own = np.repeat(np.arange(len(texts)), sizes)[:, None] * max(1, len(self.number)) + terms
        there = terms >= 0
        places, often = own[there], np.broadcast_to(often[:, None], terms.shape)[there]
        most = int(often.max(initial=0)) + 1
        if len(texts) * max(1, len(self.number)) * most < 1 << 62:  # place and number in one value: a sort of values is cheaper than one of places
            places, often = np.divmod(np.sort(places * most + often), most)
        else:
            order = np.argsort(places, kind="stable")
            places, often = places[order], often[order]
        first = np.flatnonzero(np.append(True, places[1:] != places[:-1])) if len(places) else np.empty(0, np.int64)
        counts = np.add.reduceat(often, first) if len(first) else often
        owner, numbers = np.divmod(places[first], max(1, len(self.number)))
        return numbers, counts, np.searchsorted(owner, np.arange(len(texts) + 1))


def weigh(numbers: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Unit TF-IDF weights."""
    w = (1 + np.log(counts)) * idf[numbers]
    return w / np.sqrt((w * w).sum()) if len(w) else w


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All places of the given ranges, range by range."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


def alike_together(owner: np.ndarray, term: np.ndarray, weight: np.ndarray, size: int, width: int = 128) -> np.ndarray:
    """An order of the examples whose blocks hold similar ones, so that block maxima are tight: sketches of the
    vectors by hashed terms, halved along their main direction until a part fits a block."""
    mixed = (term.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)
    sketch = np.bincount(owner * width + (mixed % np.uint64(width)).astype(np.int64),
                         np.where(mixed >> np.uint64(20) & np.uint64(1), weight, -weight), minlength=size * width).reshape(size, width)
    parts, done = [np.arange(size)], []
    while parts:
        part = parts.pop()
        if len(part) <= BLOCK:
            done.append(part)
            continue
        own = sketch[part] - sketch[part].mean(axis=0)
        part = part[np.argsort(own @ np.linalg.eigh(own.T @ own)[1][:, -1], kind="stable")]
        half = BLOCK * -(-len(part) // (2 * BLOCK))
        parts += [part[half:], part[:half]]
    return np.concatenate(done)


class BlockMaxIndex:
    """Postings by term, cut at blocks of 64 similar examples, with the largest weight of each term in each block.

    Terms that a tenth of the examples have are full rows, multiplied for many queries at once. Their sums are
    lower bounds of the scores; a block's largest sum plus the query's other weights times the block's maxima is its
    upper bound. Blocks are read in falling order of these until the next is below the k-th best score, so the k nearest
    are exact: the first four, then all that can still hold one. Of terms in few blocks only the cells (term and block) that have postings are
    stored; for the others a row of block maxima (rounded up, for bounds alone) and one of the blocks' places.
    """

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], n_terms: int):
        self.size = len(vectors)
        self.n_blocks = max(1, -(-self.size // BLOCK))
        owner = np.repeat(np.arange(self.size), [len(t) for t, _ in vectors])
        term = np.concatenate([t for t, _ in vectors]) if vectors else np.empty(0, np.int64)
        weight = np.concatenate([w for _, w in vectors]) if vectors else np.empty(0)
        self.number = alike_together(owner, term, weight, self.size) if self.size else np.empty(0, np.int64)
        self.place = np.argsort(self.number)
        at = self.place[owner]
        often = np.bincount(term, minlength=n_terms) >= max(BLOCK, self.size / 10)
        self.row = np.where(often, np.cumsum(often) - 1, -1)
        self.rows = np.zeros((int(often.sum()), self.size))
        full = often[term]
        self.rows[self.row[term[full]], at[full]] = weight[full]
        term, at, weight = term[~full], at[~full], weight[~full]
        order = np.lexsort((at, term))
        self.at, self.weight = at[order], weight[order]
        cell, first = np.unique((term * self.n_blocks + at // BLOCK)[order], return_index=True)
        self.starts = np.append(first, len(order))
        self.block = (cell % self.n_blocks).astype(np.int32)
        self.most = np.maximum.reduceat(self.weight, first) if len(first) else np.empty(0)
        self.cells = np.searchsorted(cell, np.arange(n_terms + 1) * self.n_blocks)
        wide = np.diff(self.cells) >= CELLS
        self.wide = np.where(wide, np.cumsum(wide) - 1, -1)
        own = np.repeat(wide, np.diff(self.cells))
        row = np.repeat(self.wide, np.diff(self.cells))[own]
        self.maxima = np.zeros((int(wide.sum()), self.n_blocks), np.float32)
        self.maxima[row, self.block[own]] = np.nextafter(self.most[own].astype(np.float32), np.float32(np.inf))
        size = np.zeros((len(self.maxima), self.n_blocks + 1), np.int32)
        size[row, self.block[own] + 1] = np.diff(self.starts)[own]
        size[:, 0] = self.starts[self.cells[:-1][wide]]
        self.begins = np.cumsum(size, axis=1, dtype=np.int32)

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int, without: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """The k examples of largest positive cosine (ties: lower number), and the cosines."""
        return next(self.nearest_each([(terms, weights)], k, [without]))

    def nearest_each(
        self, queries: list[tuple[np.ndarray, np.ndarray]], k: int, without: list[int] | None = None
    ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """``nearest`` of every query, in order."""
        for first in range(0, len(queries), QUERIES):
            some = queries[first:first + QUERIES]
            full = np.zeros((len(some), len(self.rows)))
            for i, (terms, weights) in enumerate(some):
                row = self.row[terms]
                full[i, row[row >= 0]] = weights[row >= 0]
            for i, scores in enumerate(full @ self.rows):
                hidden = without[first + i] if without else -1
                yield self._finish(scores, *some[i], k, self.place[hidden] if hidden >= 0 else -1)

    def _finish(self, scores: np.ndarray, terms: np.ndarray, weights: np.ndarray, k: int, hidden: int) -> tuple[np.ndarray, np.ndarray]:
        if not len(terms) or not self.size:
            return np.empty(0, np.int64), np.empty(0)
        if hidden >= 0:
            scores[hidden] = 0
        row = self.wide[terms]
        wide, pull = row[row >= 0], weights[row >= 0]
        few, little = terms[row < 0], weights[row < 0]
        sizes = self.cells[few + 1] - self.cells[few]
        cells, light = spread(self.cells[few], sizes), np.repeat(little, sizes)
        block = self.block[cells]
        bound = np.maximum.reduceat(scores, np.arange(0, self.size, BLOCK)) + np.bincount(block, light * self.most[cells], self.n_blocks)
        bound += (pull.astype(np.float32) @ self.maxima[wide]) * (1 + 1e-4)  # more than single precision loses
        order = np.argsort(-bound, kind="stable")
        order = order[bound[order] > 0]
        begins = self.begins[wide]

        def read(blocks: np.ndarray) -> None:
            chosen = np.zeros(self.n_blocks, bool)
            chosen[blocks] = True
            if 2 * len(blocks) < self.n_blocks:  # cells, by term
                some = chosen[block]
                own = cells[some]
                by_term = np.argsort(np.append(np.repeat(np.flatnonzero(row >= 0), len(blocks)), np.repeat(np.flatnonzero(row < 0), sizes)[some]), kind="stable")
                first = np.append(begins[:, blocks], self.starts[own])[by_term]
                stop = np.append(begins[:, blocks + 1], self.starts[own + 1])[by_term]
                weight = np.append(np.repeat(pull, len(blocks)), light[some])[by_term]
            else:  # whole terms, of which the other blocks' part goes
                first, stop, weight = self.starts[self.cells[terms]], self.starts[self.cells[terms + 1]], weights
            at = spread(first, stop - first)
            more = np.bincount(self.at[at], np.repeat(weight, stop - first) * self.weight[at], self.size)
            scores[:] += np.where(np.repeat(chosen, BLOCK)[:self.size], more, 0)
            if hidden >= 0:
                scores[hidden] = 0

        least = np.partition(scores, -k)[-k] if self.size >= k else 0.0
        first, order = order[:4], order[4:]
        for blocks in (first, None):
            blocks = order[bound[order] >= least - 1e-12] if blocks is None else blocks[bound[blocks] >= least - 1e-12]
            if len(blocks):
                read(blocks)
                least = np.partition(scores, -k)[-k] if self.size >= k else 0.0
        found = np.flatnonzero(scores >= least) if least > 0 else np.flatnonzero(scores)
        best = found[np.lexsort((self.number[found], -scores[found]))][:k]
        return self.number[best], np.minimum(scores[best], 1.0)


@dataclass
class Model:
    """Examples, their index, the idf of the vocabulary, class weights and the calibration of votes."""

    idf: np.ndarray
    ids: list
    labels: np.ndarray
    votes: np.ndarray  # weight of an example's vote: its class's share of labelled rows over its share of examples
    index: BlockMaxIndex
    prior: float
    slope: float = 1.0
    shift: float = 0.0
    k: int = 16
    smoothing: float = 0.5

    def votes_of(
        self, queries: list[tuple[np.ndarray, np.ndarray]], without: list[int] | None = None
    ) -> Iterator[tuple[float, np.ndarray, np.ndarray]]:
        for best, cosine in self.index.nearest_each(queries, self.k, without):
            pull = cosine * self.votes[best]
            raw = (pull @ self.labels[best] + self.smoothing * self.prior) / (pull.sum() + self.smoothing)
            yield float(np.clip(raw, 1e-4, 1 - 1e-4)), best, cosine

    def calibrate(self, raw: np.ndarray, weight: np.ndarray) -> None:
        """Logistic fit of label on the log-odds of the vote, with smoothed targets and a ridge at slope 1, shift 0."""
        x = np.stack([np.log(raw / (1 - raw)), np.ones(len(raw))], axis=1)
        pos = (weight * self.labels).sum()
        neg = weight.sum() - pos
        target = np.where(self.labels == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
        beta = anchor = np.array([1.0, 0.0])
        for _ in range(30):
            p = 1 / (1 + np.exp(-x @ beta))
            slope = x.T @ (weight * (target - p)) - (beta - anchor)
            curve = (x * (weight * p * (1 - p))[:, None]).T @ x + np.eye(2)
            beta = beta + np.linalg.solve(curve, slope)
        if beta[0] > 0:
            self.slope, self.shift = float(beta[0]), float(beta[1])

    def score(self, raw: float) -> float:
        return float(1 / (1 + np.exp(-(self.slope * np.log(raw / (1 - raw)) + self.shift))))


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def class_examples(marks: DataFrame, label: int, max_examples: int) -> DataFrame:
    """The rows (``doc_id, label``) of a class with the smallest hashed ids; each task keeps its smallest only."""
    return marks.filter(F.col("label") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_examples)


def example_terms(examples: DataFrame) -> pa.Array:
    """All words and word stems of the examples' texts, in order; as Arrow, not as rows of Python strings."""
    schema = T.StructType([T.StructField("term", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            words = set().union(*(words_of(x) for x in part.column("text").to_pylist()))
            yield pa.RecordBatch.from_arrays([pa.array(list({t for w in words for t in terms_of(w)}), pa.string())], schema=to_arrow_schema(schema))

    terms = examples.select("text").mapInArrow(run, schema).distinct().toArrow().column("term").combine_chunks()
    return terms.take(pc.sort_indices(terms))


def toxicity_scores(
    docs: DataFrame,
    labelled: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    max_examples: int = 2000,
    k: int = 16,
) -> DataFrame:
    """One row per document: ``doc_id, score, evidence``.

    ``labelled`` (``id_col, label_col`` 0/1) is all that may be learned from. Of each class at most
    ``max_examples`` documents (smallest hashed ids) are the examples; every word and word stem of their whole texts
    is a term. Document frequencies are counted over all documents. A document's whole text becomes a unit TF-IDF
    vector over the terms (a word that no example has can match none, and has no weight); its ``k`` nearest examples
    by exact cosine vote with their cosine as weight, corrected for the classes' shares among all labelled rows;
    votes are calibrated by a logistic fit to the examples' own left-one-out votes. ``evidence`` lists the
    neighbours: ``doc_id, cosine, label``.

    The texts are read once: term counts go to a written table, from which frequencies, example vectors
    and scores come. Terms and index are broadcast; they are bounded by the examples' texts, whatever the corpus.

    Defined cases: null, empty and termless texts have no neighbour and get the calibrated score of the smoothed
    share of positives; rows with a null id or label teach nothing, of an id labelled twice the larger label
    counts; without labels of both classes all scores are that share; repeated rows are scored alike; empty
    input gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    id_type = docs.schema[id_col].dataType
    rows = _texts(docs, id_col, text_col)
    marks = labelled.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("label")).filter(
        "doc_id IS NOT NULL AND label IS NOT NULL"
    ).groupBy("doc_id").agg(F.max("label").alias("label"))
    shares = dict(marks.groupBy("label").count().collect())
    classes = (0, 1) if {0, 1} <= set(shares) else ()
    chosen = {r.doc_id: r.label for label in classes for r in class_examples(marks, label, max_examples).collect()}
    prior = (shares.get(1, 0) + 1) / (sum(shares.values()) + 2)

    # a repeated id is one example
    picked = rows.filter(F.col("doc_id").isin(list(chosen))).groupBy("doc_id").agg(F.min("text").alias("text"))
    vocabulary = example_terms(picked) if chosen else pa.array([], pa.string())
    n_terms = len(vocabulary)
    numbers = spark.sparkContext.broadcast(vocabulary)

    counts_schema = T.StructType([
        T.StructField("doc_id", id_type), T.StructField("terms", T.ArrayType(T.IntegerType())), T.StructField("counts", T.ArrayType(T.IntegerType())),
    ])
    counts_out = to_arrow_schema(counts_schema)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = TermTable({t: i for i, t in enumerate(numbers.value.to_pylist())})
        for part in slices(batches, "text"):
            terms, counts, starts = table.counts(part.column("text").to_pylist())
            lists = [pa.ListArray.from_arrays(starts.astype(np.int32), v.astype(np.int32)) for v in (terms, counts)]
            columns = [part.column("doc_id"), *lists]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, counts_out)], schema=counts_out)

    counted = written(rows.mapInArrow(count, counts_schema), "toxic-terms")
    n_docs = counted.count()
    frequency = np.zeros(n_terms)
    of_term = counted.select(F.explode("terms").alias("term")).groupBy("term").count().toArrow()
    frequency[np.asarray(of_term.column("term"))] = np.asarray(of_term.column("count"))
    idf = np.log((1 + n_docs) / (1 + frequency)) + 1
    examples = counted.filter(F.col("doc_id").isin(list(chosen))).groupBy("doc_id").agg(F.min(F.struct("terms", "counts")).alias("v")).select("doc_id", "v.*").toArrow()
    ids = examples.column("doc_id").to_pylist() if chosen else []
    order = sorted(range(len(ids)), key=lambda i: str(ids[i]))
    ids, examples = [ids[i] for i in order], examples.take(pa.array(order, pa.int64())).combine_chunks()
    lists = [examples.column(c).combine_chunks() for c in ("terms", "counts")]
    ends = np.cumsum(np.asarray(pc.list_value_length(lists[0])))
    terms, counts = (np.split(np.asarray(v.flatten()), ends[:-1]) if ids else [] for v in lists)
    vectors = [(t.astype(np.int64), weigh(t, c.astype(float), idf)) for t, c in zip(terms, counts)]
    labels = np.array([chosen[i] for i in ids], float)
    per_class = [max(1.0, shares.get(c, 0)) / max(1.0, (labels == c).sum()) for c in (0, 1)]
    votes = np.where(labels == 1, per_class[1], per_class[0]) / (max(per_class) or 1)
    model = Model(idf, ids, labels, votes, BlockMaxIndex(vectors, n_terms), prior, k=k)
    if 0 < labels.sum() < len(labels):
        raw = np.array([raw for raw, _, _ in model.votes_of(vectors, list(range(len(vectors))))])
        model.calibrate(raw, votes)

    schema = T.StructType([
        T.StructField("doc_id", id_type), T.StructField("score", T.DoubleType()),
        T.StructField("evidence", T.ArrayType(T.StructType([
            T.StructField("doc_id", id_type), T.StructField("cosine", T.DoubleType()), T.StructField("label", T.IntegerType()),
        ]))),
    ])
    out = to_arrow_schema(schema)
    shared = spark.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        ids = pa.array(model.ids, out.field(0).type)
        for batch in batches:
            lists = batch.column("terms"), batch.column("counts")
            starts = np.asarray(lists[0].offsets) - lists[0].offsets[0].as_py()
            terms, counts = (np.asarray(v.flatten()) for v in lists)
            queries = []
            for start, end in zip(starts[:-1].tolist(), starts[1:].tolist()):
                own = terms[start:end].astype(np.int64)
                queries.append((own, weigh(own, counts[start:end].astype(float), model.idf)))
            scores, near, likeness = [], [], []
            for raw, best, cosine in model.votes_of(queries):
                scores.append(model.score(raw))
                near.append(best)
                likeness.append(cosine)
            at, ends = np.concatenate([*near, np.empty(0, np.int64)]), np.cumsum([0, *map(len, near)])
            fields = [ids.take(pa.array(at)), pa.array(np.concatenate([*likeness, np.empty(0)])), pa.array(model.labels[at].astype(np.int32))]
            inner = out.field(2).type.value_type
            evidence = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays([x.cast(f.type) for x, f in zip(fields, inner)], fields=list(inner)))
            columns = [batch.column("doc_id"), pa.array(scores, pa.float64()), evidence]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, out)], schema=out)

    return counted.mapInArrow(score, schema)
