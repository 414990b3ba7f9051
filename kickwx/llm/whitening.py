"""Whitening of embeddings by spectrum slicing.

Entries become whole numbers, so the fit list (each distinct vector once), its size and its sums are exact. The
covariance is the only thing that leaves the tasks: d * d numbers, whatever the number of rows. Its leading
eigenvalues are isolated by the inertia of shifted LDL' factorisations and refined by Rayleigh quotient iteration.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from kickwx.llm.batches import give_back
from kickwx.llm.scratch import written

SCALE = 64
OFFSET = 1_000_000
CELLS = 1 << 19  # entries worked on at a time
FAN_IN = 64  # matrices summed by one task
LOW = 0xFFFFFFFF
LONGEST = (1 << 63) - 1
ALPHA = (1 + 17**0.5) / 8  # Bunch and Kaufman's bound on the growth of a pivot step


def _matrices(batches: Iterator[pa.RecordBatch], column: str, width: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Slices of batches with their vectors as rows of a matrix."""
    step = max(1, CELLS // width)
    for batch in batches:
        for at in range(0, batch.num_rows, step):
            part = batch.slice(at, step)
            yield part, np.asarray(part.column(column).flatten()).reshape(part.num_rows, width)
    give_back()


def whole_vectors(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``vec_id, x``: the vectors as whole numbers ``floor(64 * entry) + 1000000``, without vectors that are null or
    hold a null or non-finite entry. A number beyond 64 bits becomes the nearest long."""
    schema = T.StructType([T.StructField("vec_id", rows.schema[id_col].dataType), T.StructField("x", T.ArrayType(T.LongType(), False))])
    out = to_arrow_schema(schema)
    entries = pa.large_list(pa.float64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                part = part.filter(part.column("vector").is_valid())
                vectors = part.column("vector").cast(entries)
                values = vectors.flatten().to_numpy(zero_copy_only=False)  # null entries as NaN
                ends = np.cumsum([0, *vectors.value_lengths().to_pylist()])
                odd = np.append(0, np.cumsum(~np.isfinite(values)))
                good = np.flatnonzero(odd[ends[1:]] == odd[ends[:-1]])
                sizes = np.diff(ends)[good]
                held = values[np.repeat(np.isin(np.arange(len(ends) - 1), good), np.diff(ends))]
                with np.errstate(over="ignore"):
                    scaled = np.floor(held * SCALE)
                fits = np.abs(scaled) < 2.0**62
                x = np.where(fits, scaled, 0).astype(np.int64) + OFFSET
                x = np.where(fits, x, np.where(scaled > 0, LONGEST, -LONGEST - 1))
                lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)), pa.int32()), pa.array(x))
                yield pa.RecordBatch.from_arrays([part.column("vec_id").take(pa.array(good)).cast(out.field(0).type), lists.cast(out.field(1).type)], schema=out)

    return rows.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("vector")).mapInArrow(run, schema)


def _part() -> int:
    return TaskContext.get().partitionId()


def _summed(parts: DataFrame) -> np.ndarray:
    """The sum of one array per task (``part, sums``), by a tree of tasks that add ``FAN_IN`` arrays each; zero without any."""
    schema = "part int, sums array<double>"

    def add(key: tuple, table: pa.Table) -> pa.Table:
        total = None
        for sums in table.column("sums").chunks:
            for one in sums:
                one = one.values.to_numpy(zero_copy_only=False)
                total = one if total is None else total + one
        return pa.table({"part": pa.array([key[0].as_py()], pa.int32()), "sums": pa.array([total], pa.list_(pa.float64()))})

    parts = written(parts, "sums")
    while (count := parts.count()) > 1:
        fewer = -(-count // FAN_IN)
        numbered = parts.select((F.col("part") % fewer).alias("part"), "sums")
        parts = written(numbered.groupBy("part").applyInArrow(add, schema), "sums")
    rows = parts.collect()
    return np.array(rows[0]["sums"]) if rows else np.zeros(0)


def exact_sums(fit: DataFrame, width: int) -> list[int]:
    """The sum of every dimension, exact: halves of 32 bits are summed apart."""
    schema = "dim int, high long, low long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        high, low = np.zeros(width, np.int64), np.zeros(width, np.int64)
        for _, x in _matrices(batches, "x", width):
            high += (x >> 32).sum(axis=0)
            low += (x & LOW).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width, dtype=np.int32)), pa.array(high), pa.array(low)], names=["dim", "high", "low"])

    wide = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("high", "low")]
    rows = fit.select("x").mapInArrow(run, schema).groupBy("dim").agg(*wide).collect()
    return [(int(r["high"]) << 32) + int(r["low"]) for r in sorted(rows, key=lambda r: r["dim"])]


@dataclass
class Centre:
    """Whole and fractional parts of the mean, so that an entry is centred without loss."""

    n: int
    sums: list[int]

    def __post_init__(self):
        self.whole = np.array([s // self.n for s in self.sums], np.int64)
        self.rest = [s - self.n * (s // self.n) for s in self.sums]
        self.fraction = np.array([r / self.n for r in self.rest])

    def centred(self, x: np.ndarray) -> np.ndarray:
        far = x.astype(np.float64) - self.whole.astype(np.float64)
        with np.errstate(over="ignore"):
            near = (x - self.whole).astype(np.float64)
        return np.where(np.abs(far) < 2.0**62, near, far) - self.fraction

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Each row's sum of (n * x - S)^2, exact; None if it does not fit 64 bits."""
        apart = np.abs(x.astype(np.float64) - self.whole.astype(np.float64)).max(initial=0)
        if ((apart + 1.0) * self.n) ** 2 * x.shape[1] < 2.0**62:
            gaps = self.n * (x - self.whole) - np.array(self.rest, np.int64)
            return np.einsum("ij,ij->i", gaps, gaps).tolist()
        sums = [sum((self.n * v - s) ** 2 for v, s in zip(row, self.sums)) for row in x.tolist()]
        return [s if s <= LONGEST else None for s in sums]


def covariance(fit: DataFrame, centre: Centre) -> np.ndarray:
    """The covariance of the fit list's vectors, centred before they are multiplied, divisor n."""
    width = len(centre.sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, some = np.zeros((width, width)), False
        for _, x in _matrices(batches, "x", width):
            gaps = centre.centred(x)
            total += gaps.T @ gaps
            some = True
        if some:
            yield pa.RecordBatch.from_arrays([pa.array([_part()], pa.int32()), pa.array([total.ravel()], pa.list_(pa.float64()))], names=["part", "sums"])

    total = _summed(fit.select("x").mapInArrow(run, "part int, sums array<double>")).reshape(width, width)
    return (total + total.T) / (2 * centre.n)


def positive_inertia(matrix: np.ndarray) -> int:
    """The number of positive eigenvalues, by Sylvester's law: that of the blocks of a symmetric LDL' factorisation.

    Pivots of one or two rows, chosen so that entries can't grow much. A zero pivot counts as not positive.
    """
    a, positive, at, size = matrix.copy(), 0, 0, len(matrix)
    while at < size:
        below = np.abs(a[at + 1:, at])
        most = below.max(initial=0.0)
        one = True
        if abs(a[at, at]) < ALPHA * most:
            r = at + 1 + int(below.argmax())
            row = np.abs(a[r, at:])
            row[r - at] = 0
            widest = row.max()
            if abs(a[at, at]) * widest >= ALPHA * most * most:
                swap = at
            elif abs(a[r, r]) >= ALPHA * widest:
                swap = r
            else:
                one, swap = False, r
            place = at if one else at + 1
            if swap != place:
                a[[place, swap]] = a[[swap, place]]
                a[:, [place, swap]] = a[:, [swap, place]]
        if one:
            pivot = a[at, at]
            positive += pivot > 0
            if pivot != 0:
                column = a[at + 1:, at].copy()
                a[at + 1:, at + 1:] -= np.outer(column / pivot, column)
            at += 1
        else:
            positive += 1  # an indefinite block: one eigenvalue of each sign
            block, columns = a[at:at + 2, at:at + 2], a[at + 2:, at:at + 2].copy()
            a[at + 2:, at + 2:] -= columns @ np.linalg.solve(block, columns.T)
            at += 2
    return int(positive)


def _solved(matrix: np.ndarray, shift: float, vector: np.ndarray, tiny: float) -> np.ndarray:
    """The direction of (matrix - shift)^-1 vector; an exactly singular matrix is shifted by the rounding error."""
    eye = np.eye(len(matrix))
    for step in (0.0, tiny, 16 * tiny):
        try:
            found = np.linalg.solve(matrix - (shift + step) * eye, vector)
        except np.linalg.LinAlgError:
            continue
        size = np.linalg.norm(found)
        if np.isfinite(size) and size > 0:
            return found / size
    return vector


def leading_eigenpairs(matrix: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` largest eigenvalues, falling, and their unit eigenvectors as columns.

    The number of eigenvalues above a shift is the positive inertia of the shifted matrix. Bisection by that number
    isolates the k-th largest in an interval; Rayleigh quotient iteration from there converges cubically. A result is
    accepted only if it lies in its interval and the counts just above and below it certify its number; else the
    interval is halved again. Eigenvalues too close to be told apart give an orthonormal basis of their space.
    """
    size = len(matrix)
    norm = float(np.abs(matrix).sum(axis=1).max(initial=0.0))
    if not norm:
        return np.zeros(count), np.eye(size)[:, :count]
    tiny = np.finfo(float).eps * norm
    eye, rng = np.eye(size), np.random.default_rng(13)
    bounds = {-2 * norm: size, 2 * norm: 0}  # shift: eigenvalues above it

    def above(shift: float) -> int:
        if shift not in bounds:
            bounds[shift] = positive_inertia(matrix - shift * eye)
        return bounds[shift]

    values, vectors = np.zeros(count), np.zeros((size, count))
    for k in range(count):
        low = max(s for s, n in bounds.items() if n > k)
        high = min((s for s, n in bounds.items() if n <= k and s > low), default=2 * norm)
        known = vectors[:, :k]

        def apart(v: np.ndarray) -> np.ndarray:
            for _ in range(2):  # again, against what rounding leaves
                v = v - known @ (known.T @ v)
            return v / np.linalg.norm(v)

        start = apart(rng.standard_normal(size))
        while True:
            alone = above(low) == k + 1 and above(high) == k
            if alone or high - low <= 8 * tiny:
                middle = (low + high) / 2
                v = start
                for _ in range(2):
                    v = apart(_solved(matrix, middle, v, tiny))
                shift = float(v @ matrix @ v)
                for _ in range(12):
                    v = apart(_solved(matrix, shift, v, tiny))
                    shift = float(v @ matrix @ v)
                    if np.linalg.norm(matrix @ v - shift * v) <= 8 * tiny:
                        break
                margin = 64 * tiny
                inside = low - margin <= shift <= high + margin
                if high - low <= 8 * tiny or (inside and above(shift - margin) >= k + 1 and above(shift + margin) <= k):
                    values[k], vectors[:, k] = shift, v
                    break
            middle = (low + high) / 2
            if above(middle) > k:
                low = middle
            else:
                high = middle
    order = np.argsort(-values, kind="stable")
    return values[order], vectors[:, order]


@dataclass
class Whitening:
    """The fit: the centre, the leading components (columns), their eigenvalues and the trace of the covariance."""

    centre: Centre
    values: np.ndarray
    components: np.ndarray
    trace: float

    def __post_init__(self):
        floor = len(self.components) * np.finfo(float).eps * max(self.trace, 0.0)
        self.held = self.values > floor  # the others are zero but for rounding

    def apply(self, x: np.ndarray) -> np.ndarray:
        """Whitened rows; NaN for components without variance."""
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(self.held, (self.centre.centred(x) @ self.components) / np.sqrt(np.where(self.held, self.values, 1.0)), np.nan)


def fit_whitening(fit: DataFrame, components: int) -> Whitening | None:
    """Fit on a written table of distinct vectors ``x`` of one width; None without a vector or a dimension."""
    n = fit.count()
    first = fit.first()
    if not n or not len(first["x"]):
        return None
    centre = Centre(n, exact_sums(fit, len(first["x"])))
    matrix = covariance(fit, centre)
    values, vectors = leading_eigenpairs(matrix, min(components, len(matrix)))
    return Whitening(centre, values, vectors, float(np.trace(matrix)))


def identity_error(fit: DataFrame, model: Whitening) -> float | None:
    """The largest absolute entry of the whitened fit list's covariance minus the identity, over components with variance."""
    width, kept = len(model.centre.sums), np.flatnonzero(model.held)
    if not len(kept):
        return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, ones, some = np.zeros((len(kept), len(kept))), np.zeros(len(kept)), False
        for _, x in _matrices(batches, "x", width):
            white = model.apply(x)[:, kept]
            total += white.T @ white  # centred already but for rounding, which the means below take off
            ones += white.sum(axis=0)
            some = True
        if some:
            sums = np.concatenate((total.ravel(), ones))
            yield pa.RecordBatch.from_arrays([pa.array([_part()], pa.int32()), pa.array([sums], pa.list_(pa.float64()))], names=["part", "sums"])

    sums = _summed(fit.select("x").mapInArrow(run, "part int, sums array<double>")) / model.centre.n
    total, means = sums[: -len(kept)].reshape(len(kept), len(kept)), sums[-len(kept):]
    return float(np.abs(total - np.outer(means, means) - np.eye(len(kept))).max())


def whitened(vectors: DataFrame, model: Whitening, error: float | None) -> DataFrame:
    """One row per vector (``vec_id, x``) and component."""
    schema = T.StructType([
        T.StructField("vec_id", vectors.schema["vec_id"].dataType), T.StructField("component", T.IntegerType()), T.StructField("n", T.LongType()),
        T.StructField("deviation", T.LongType()), T.StructField("whitened", T.DoubleType()), T.StructField("explained", T.DoubleType()), T.StructField("identity_error", T.DoubleType()),
    ])
    out = to_arrow_schema(schema)
    width, count = model.components.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        explained = np.where(model.held, model.values / (model.trace or 1.0), 0.0)
        for part, x in _matrices(batches, "x", width):
            rows = len(x)
            ids = part.column("vec_id").take(pa.array(np.repeat(np.arange(rows), count)))
            deviation = pa.array(model.centre.deviations(x), pa.int64()).take(pa.array(np.repeat(np.arange(rows), count)))
            white = model.apply(x).ravel()
            columns = [
                ids.cast(out.field(0).type), pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), rows)),
                pa.array(np.full(rows * count, model.centre.n)), deviation, pa.array(white, mask=np.isnan(white)),
                pa.array(np.tile(explained, rows)), pa.array(np.full(rows * count, np.nan if error is None else error), mask=np.full(rows * count, error is None)),
            ]
            yield pa.RecordBatch.from_arrays(columns, schema=out)

    return vectors.mapInArrow(run, schema)


def whiten_embeddings(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 16) -> DataFrame:
    """One row per vector and leading component: ``vec_id, component, n, deviation, whitened, explained, identity_error``.

    Entries become whole numbers x = floor(64 * entry) + 1000000. The fit list is each distinct x vector once: n of them,
    sums S. Components are the unit eigenvectors of its covariance, numbered from 1 by falling eigenvalue. ``whitened`` is x - S/n projected
    on the component over the root of its eigenvalue, ``deviation`` the exact sum of (n * x - S)^2, ``explained``
    the component's share of the variance, ``identity_error`` how far the whitened fit list's covariance is from the identity.

    1. Distinct vectors are found by a hash aggregate that combines before the shuffle, so a vector that many
       rows repeat leaves each task once. The fit list is written.
    2. Three passes over it give the sums (exact), the covariance (a tree of sums of d * d numbers) and the check. The
       eigenproblem, whose size is that of one vector, is solved on the driver by spectrum slicing.
    3. One pass over all rows applies the fit.

    Defined cases: rows whose vector is null or holds a null or non-finite entry are left out, also of the fit. Where vectors differ in length, the
    length that most distinct vectors have counts (ties: the longer); others are left out. Null ids and repeated rows are returned as
    they come. A component without variance has ``whitened`` null and ``explained`` 0; where none has any, ``identity_error`` is null. A
    ``deviation`` beyond 64 bits is null; numbers x beyond 64 bits are the nearest long. Vectors of fewer dimensions than
    ``components`` give as many components as they have; empty vectors, or no rows left, give no rows. Other columns are ignored.
    """
    vectors = whole_vectors(rows, id_col, vector_col)
    fit = written(vectors.select("x").distinct(), "fit-list")
    widths = fit.groupBy(F.size("x").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).limit(2).collect()
    none = "component int, n long, deviation long, whitened double, explained double, identity_error double"
    nothing = vectors.filter("false").select("vec_id", *[F.lit(None).cast(t).alias(c) for c, t in (f.split() for f in none.split(", "))])
    if not widths:
        return nothing
    same = F.size("x") == widths[0]["width"]
    model = fit_whitening(fit.filter(same), components)
    if model is None:
        return nothing
    error = identity_error(fit.filter(same), model)
    return whitened(vectors.filter(same), model, error)
