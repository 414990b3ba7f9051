"""Language identification of words and documents by a linear-chain conditional random field."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from kickwx.llm.batches import give_back, slices

UNDETERMINED = "und"
WORD = re.compile(r"[^\W\d_]+")
BUCKETS = 1 << 18
GRAMS = (1, 2, 3, 4)
BLOCK = 64
MEMO_WORDS = 200_000


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of words, flat, and how many each has: byte n-grams of ``<word>`` (those that touch a
    bracket are the affixes) and the whole word as lexicon entry."""
    raw = [b"<" + w.encode("utf-8", "surrogatepass") + b">" for w in words]
    sizes = np.fromiter(map(len, raw), np.int64, len(raw))
    codes = np.frombuffer(b"".join(raw), np.uint8).astype(np.uint64)
    word = np.repeat(np.arange(len(raw)), sizes)
    owners, hashes = [], []
    value = np.zeros(len(codes), np.uint64)
    for n in range(1, max(GRAMS) + 1):
        value = value[: len(codes) - n + 1] * np.uint64(257) + codes[n - 1:] + np.uint64(1)
        if n in GRAMS:
            whole = word[: len(value)] == word[n - 1:]
            owners.append(word[: len(value)][whole])
            hashes.append(value[whole] * np.uint64(16) + np.uint64(n))
    owners.append(np.arange(len(raw)))
    hashes.append(np.fromiter(map(zlib.crc32, raw), np.uint64, len(raw)) * np.uint64(16))
    owner, mixed = np.concatenate(owners), np.concatenate(hashes) * np.uint64(0x9E3779B97F4A7C15)
    order = np.argsort(owner, kind="stable")
    return (mixed[order] >> np.uint64(46)).astype(np.int64), np.bincount(owner, minlength=len(raw))


def word_scores(weights: np.ndarray, words: list[str]) -> np.ndarray:
    """Emission scores, a row per word."""
    if not words:
        return np.empty((0, weights.shape[1]))
    at, sizes = features(words)
    return np.add.reduceat(weights[at], np.cumsum(sizes) - sizes, axis=0, dtype=np.float64)


def forward_backward(scores: np.ndarray, sizes: np.ndarray, trans: np.ndarray, start: np.ndarray):
    """Scaled forward and backward vectors and emission factors of flat sequences (``sizes`` without zeros).

    Sequences are cut into blocks of 64 words. The blocks' transfer products are built side by side, chained
    along each sequence, and the vectors within blocks follow side by side: exact, in about 64 * 3 + 2 * length / 64
    numpy steps however many sequences there are.
    """
    labels = scores.shape[1]
    e = np.exp(scores - scores.max(axis=1, keepdims=True))
    a, pi = np.exp(trans), np.exp(start - start.max())
    n_blocks = -(-sizes // BLOCK)
    owner = np.repeat(np.arange(len(sizes)), n_blocks)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(n_blocks) - n_blocks, n_blocks)
    first = np.repeat(np.cumsum(sizes) - sizes, n_blocks) + nth * BLOCK
    length = np.minimum(BLOCK, np.repeat(sizes, n_blocks) - nth * BLOCK)
    by_length = np.argsort(-length, kind="stable")
    first_s, active = first[by_length], (length[:, None] > np.arange(BLOCK)).sum(axis=0)
    opening = (nth == 0)[by_length]

    product = np.broadcast_to(np.eye(labels), (len(owner), labels, labels)).copy()
    for t in range(BLOCK):
        m = active[t]
        if not m:
            break
        step = product[:m] @ a if t else np.where(opening[:m, None, None], product[:m], product[:m] @ a)
        step = step * e[first_s[:m] + t][:, None, :]
        product[:m] = step / step.max(axis=(1, 2), keepdims=True)
    products = np.empty_like(product)
    products[by_length] = product

    # vectors into each block from the left, out of each from the right
    heads, left, right = np.cumsum(n_blocks) - n_blocks, np.empty((len(owner), labels)), np.ones((len(owner), labels))
    longest = np.argsort(-n_blocks, kind="stable")
    left[heads] = pi
    many = [int(x) for x in (n_blocks[:, None] > np.arange(1, n_blocks.max())).sum(axis=0)] if len(sizes) else []
    for k, m in enumerate(many, 1):
        at = heads[longest[:m]] + k
        v = np.einsum("ni,nij->nj", left[at - 1], products[at - 1])
        left[at] = v / v.sum(axis=1, keepdims=True)
    for k in range(len(many), 0, -1):
        at = heads[longest[: many[k - 1]]] + k
        v = np.einsum("nij,nj->ni", products[at], right[at])
        right[at - 1] = v / v.sum(axis=1, keepdims=True)

    alpha, beta = np.empty_like(e), np.empty_like(e)
    v, w = left[by_length], right[by_length]
    for t in range(BLOCK):
        m = active[t]
        if not m:
            break
        step = v[:m] @ a if t else np.where(opening[:m, None], v[:m], v[:m] @ a)
        step = step * e[first_s[:m] + t]
        v[:m] = step / step.sum(axis=1, keepdims=True)
        alpha[first_s[:m] + t] = v[:m]
    for t in range(BLOCK - 1, -1, -1):
        m = active[t]
        if m:
            at = first_s[:m] + t
            beta[at] = w[:m]
            step = (w[:m] * e[at]) @ a.T
            w[:m] = step / step.sum(axis=1, keepdims=True)
    return alpha, beta, e


def marginals(scores: np.ndarray, sizes: np.ndarray, trans: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Posterior of each label at each word."""
    alpha, beta, _ = forward_backward(scores, sizes, trans, start)
    both = alpha * beta
    return both / both.sum(axis=1, keepdims=True)


@dataclass
class Model:
    labels: list[str]
    weights: np.ndarray  # BUCKETS x labels
    trans: np.ndarray  # labels x labels, from row to column
    start: np.ndarray


def fit(spans: list[tuple[str, list[str]]], epochs: int = 6, rate: float = 0.3, batch: int = 256, seed: int = 7) -> Model:
    """Maximum likelihood of the labels of word spans, by AdaGrad.

    Each training sequence is four spans drawn at random, so that the transitions are learned from text
    that switches language between spans as well as from text that doesn't.
    """
    labels = sorted({lang for lang, _ in spans})
    number = {lang: i for i, lang in enumerate(labels)}
    vocabulary: dict[str, int] = {}
    coded = [(number[lang], np.array([vocabulary.setdefault(w, len(vocabulary)) for w in words])) for lang, words in spans]
    at, counts = features(list(vocabulary)) if vocabulary else (np.empty(0, np.int64), np.empty(0, np.int64))
    begin = np.cumsum(counts) - counts
    k, rng = len(labels), np.random.default_rng(seed)
    weights, trans, start = np.zeros((BUCKETS, k), np.float32), np.zeros((k, k)), np.zeros(k)
    seen_w, seen_t = np.full((BUCKETS, k), 1e-6, np.float32), np.full((k, k), 1e-6)
    for _ in range(epochs if k > 1 else 0):
        order = rng.permutation(len(coded))
        order = order[: len(order) // 4 * 4].reshape(-1, 4) if len(order) >= 4 else order[None, :]
        for lot in np.array_split(order, max(1, len(order) // batch)):
            sequences = [np.concatenate([coded[i][1] for i in row]) for row in lot]
            truth = np.concatenate([np.repeat([coded[i][0] for i in row], [len(coded[i][1]) for i in row]) for row in lot])
            words, place = np.unique(np.concatenate(sequences), return_inverse=True)
            sizes = np.array([len(s) for s in sequences])
            lengths = counts[words]
            ends = np.cumsum(lengths)
            feats = at[np.repeat(begin[words] - (ends - lengths), lengths) + np.arange(ends[-1])]
            scores = np.add.reduceat(weights[feats], ends - lengths, axis=0, dtype=np.float64)[place]
            alpha, beta, e = forward_backward(scores, sizes, trans, start)
            both = alpha * beta
            slope = -both / both.sum(axis=1, keepdims=True)
            slope[np.arange(len(truth)), truth] += 1
            per_word = np.zeros((len(words), k))
            np.add.at(per_word, place, slope)
            g = np.zeros((BUCKETS, k), np.float32)
            np.add.at(g, feats, np.repeat(per_word, lengths, axis=0).astype(np.float32))
            g = g / len(sizes) - 1e-5 * weights
            seen_w += g * g
            weights += rate * g / np.sqrt(seen_w)
            inner = np.setdiff1d(np.arange(1, len(truth)), np.cumsum(sizes)[:-1])
            pair = alpha[inner - 1][:, :, None] * np.exp(trans) * (e[inner] * beta[inner])[:, None, :]
            pair = pair / pair.sum(axis=(1, 2), keepdims=True)
            gt = -pair.sum(axis=0)
            np.add.at(gt, (truth[inner - 1], truth[inner]), 1)
            gt = gt / len(sizes) - 1e-3 * trans
            seen_t += gt * gt
            trans = trans + 0.1 * rate * gt / np.sqrt(seen_t)
    return Model(labels, weights, trans, start)


def smallest_hashed(rows: DataFrame, per_language: int) -> list:
    """Ids (column ``doc_id``) of the ``per_language`` rows of each language with the smallest hashed ids.

    Languages are counted first (combined map-side; one row each, as the model's labels, reaches the driver). Only rows whose hash
    is below a bound that some eight times ``per_language`` rows should pass are ranked, so no task gets a whole language. Where
    fewer than needed pass (an id that much of a language repeats), that language is ranked without a bound.
    """
    counts = {r[0]: r[1] for r in rows.groupBy("lang").count().collect()}
    hashed = F.xxhash64("doc_id")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(hashed, "doc_id"))
    found: dict[str, list] = {lang: [] for lang in counts}
    for margin in (8, None):
        short = {lang: n for lang, n in counts.items() if len(found[lang]) < min(n, per_language)}
        if not short:
            break
        share = {lang: min(1.0, margin * per_language / n) if margin else 1.0 for lang, n in short.items()}
        bounds = F.create_map(*[F.lit(x) for lang, part in sorted(share.items()) for x in (lang, part * 2.0**64 - 2.0**63)])
        near = rows.filter(hashed.cast("double") <= F.element_at(bounds, F.col("lang")))  # no bound for the languages that are done
        for lang in short:
            found[lang] = []
        for r in near.withColumn("n", rank).filter(F.col("n") <= per_language).collect():
            found[r.lang].append(r.doc_id)
    return [doc_id for lang in sorted(found) for doc_id in found[lang]]


def training_spans(
    docs: DataFrame, id_col: str, text_col: str, lang_col: str, per_language: int, spans: int, span_words: int
) -> list[tuple[str, list[str]]]:
    """Word spans of at most ``per_language`` documents of each language, spread evenly over each whole text."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    rows = rows.filter("doc_id IS NOT NULL AND lang IS NOT NULL AND text IS NOT NULL")
    chosen = smallest_hashed(rows.select("doc_id", "lang"), per_language)
    if not chosen:
        return []
    schema = T.StructType([T.StructField("lang", T.StringType()), T.StructField("doc_id", docs.schema[id_col].dataType),
                           T.StructField("words", T.ArrayType(T.StringType()))])
    out = to_arrow_schema(schema)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            found = []
            for doc_id, lang, text in zip(*(part.column(c).to_pylist() for c in ("doc_id", "lang", "text"))):
                words = WORD.findall(text.lower())
                n = min(spans, -(-len(words) // span_words))
                for at in np.linspace(0, max(0, len(words) - span_words), n).astype(int).tolist():
                    found.append((lang, doc_id, words[at:at + span_words]))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), out)], schema=out)

    picked = rows.filter(F.col("doc_id").isin(chosen)).groupBy("doc_id").agg(F.min("lang").alias("lang"), F.min("text").alias("text"))
    return sorted((r.lang, r.words) for r in picked.mapInArrow(cut, schema).collect())


def train(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    per_language: int = 400, spans: int = 16, span_words: int = 16,
) -> Model:
    """Fit the field on the driver on a bounded sample: per language at most ``per_language`` documents (smallest
    hashed ids), of each at most ``spans`` spans of ``span_words`` words. Rows with a null id, text or language
    teach nothing. Without any such row the model has no label and everything is undetermined."""
    model = fit(training_spans(docs, id_col, text_col, lang_col, per_language, spans, span_words))
    give_back()
    return model


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, lang_pred, score, runs``.

    Every word of the whole text gets a posterior over languages by forward-backward. ``lang_pred`` has the largest
    mean posterior over the words, ``score`` is that mean; ``runs`` are the stretches of words with one most
    likely language: ``lang, first_word, n_words``.

    No shuffle; a task's memory follows a 1 MB slice of texts (or one longer text).

    Defined cases: a null text or one without a letter is ``und`` with score 0 and no runs; ids may be null or
    repeated; empty input gives no rows; other columns are ignored; ties go to the first label in order.
    """
    schema = T.StructType([
        T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
        T.StructField("runs", T.ArrayType(T.StructType([
            T.StructField("lang", T.StringType()), T.StructField("first_word", T.IntegerType()), T.StructField("n_words", T.IntegerType()),
        ]))),
    ])
    out = to_arrow_schema(schema)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        names = np.array(model.labels, object)
        memo: dict[str, int] = {}
        table = np.empty((0, len(names)))
        for part in slices(batches, "text", 1 << 20):
            words = [WORD.findall(t.lower()) if t and len(names) else [] for t in part.column("text").to_pylist()]
            sizes = np.array([len(w) for w in words], np.int64)
            full = np.flatnonzero(sizes)
            needed = set().union(*words)
            if len(memo) + len(needed) > MEMO_WORDS:
                memo, table = {}, table[:0]
            new = [w for w in needed if w not in memo]
            memo.update(zip(new, range(len(memo), len(memo) + len(new))))
            table = np.concatenate((table, word_scores(model.weights, new)))
            lang = np.full(len(words), UNDETERMINED, object)
            score = np.zeros(len(words))
            runs: list[list] = [[] for _ in words]
            if len(full):
                at = np.fromiter((memo[w] for i in full for w in words[i]), np.int64, int(sizes.sum()))
                begin = np.cumsum(sizes[full]) - sizes[full]
                posterior = marginals(table[at], sizes[full], model.trans, model.start)
                mean = np.add.reduceat(posterior, begin, axis=0) / sizes[full][:, None]
                lang[full], score[full] = names[mean.argmax(axis=1)], np.minimum(mean.max(axis=1), 1.0)
                best = posterior.argmax(axis=1)
                cuts = np.union1d(np.flatnonzero(np.diff(best)) + 1, begin)
                owner = np.searchsorted(begin, cuts, side="right") - 1
                spans = np.diff(np.append(cuts, len(best)))
                for doc, label, first, n in zip(full[owner].tolist(), names[best[cuts]], (cuts - begin[owner]).tolist(), spans.tolist()):
                    runs[doc].append({"lang": label, "first_word": first, "n_words": n})
            columns = [part.column("doc_id"), pa.array(lang, pa.string()), pa.array(score), pa.array(runs, out.field("runs").type)]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, out)], schema=out)

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)
