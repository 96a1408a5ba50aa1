"""Embedding whitening by Chebyshev-filtered subspace iteration.

Vectors become integer rows x = floor(scale * c) + SHIFT. The eigenvectors of
their covariance V with the largest eigenvalues are found without forming V:

* one distributed pass turns a block Q of ``block`` columns into V Q: a task
  centres its rows (exactly, on integers) and adds up C^T (C Q), Spark sums the
  entries of all tasks, and the driver sees one (dimensions x block) matrix;
* such passes drive the three-term Chebyshev recurrence, which damps the part
  of the spectrum below the block and grows the rest;
* QR and Rayleigh-Ritz turn the filtered block into eigenvector estimates,
  whose product V Q is both the residual test and the next filter's first step;
* a Lanczos vector outside the block rides along in each pass. It gives the
  interval that the next filter damps, and shows that nothing outside the block
  has a larger eigenvalue than the components reported.

The iteration ends when every component's residual |V q - e q| is below ``TOL``
times the largest eigenvalue (or has stopped falling below ``FLOOR`` times it)
and the Lanczos bound agrees. One more pass measures the whitened rows'
covariance. The driver holds a few (dimensions x block) matrices, whatever the
number of rows; each pass reads the integer table written once.

Defined cases: a vector that is NULL, empty, or holds a NULL, a non-finite
entry or one beyond ``2**40`` takes no part; shorter vectors count as padded
with zeros; repeated rows and NULL ids take part like any other row; equal
eigenvalues give some orthonormal basis; directions without variance (an
eigenvalue below 1e-12 of the largest) are no components, so a table with one
distinct vector, or an empty one, gives no rows; a ``deviation`` beyond 64 bits
is NULL; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vialflow.llm.common import materialise, prepare, read, register

SCALE = 64
SHIFT = 1_000_000
COMPONENTS = 32
#: Columns of the block beside the wanted ones; they set the filter's contrast.
GUARD = 16
DEGREE = 8
TOL, FLOOR = 1e-14, 1e-12
LIFT = 25.0
MAX_ROUNDS = 60
_LARGEST = float(1 << 40)
_OUT = ("vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, "
        "identity_error double")


def _quantiser(scale: int):
    """(id, vector) batches to (id, x) of the rows that take part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pc.fill_null(pc.greater(pc.list_value_length(batch.column(1)), 0), False))
            if not batch.num_rows:
                continue
            lists = batch.column(1)
            values = lists.flatten().cast(pa.float64())
            v = values.fill_null(np.nan).to_numpy(zero_copy_only=False)
            ends = np.cumsum(pc.list_value_length(lists).to_numpy())
            starts = np.concatenate([[0], ends[:-1]])
            fine = np.logical_and.reduceat(np.isfinite(v) & (np.abs(v) < _LARGEST), starts)
            x = np.floor(np.where(np.repeat(fine, ends - starts), v, 0.0) * scale).astype(np.int64) + SHIFT
            offsets = np.concatenate([[0], ends]).astype(np.int32)
            out = pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(x))], ["id", "x"])
            yield out.filter(pa.array(fine))
    return run


def _rows(batch: pa.RecordBatch, column: str, dims: int) -> np.ndarray:
    """The batch's x-vectors as a matrix, short ones padded with zero entries."""
    lists = batch.column(batch.schema.get_field_index(column))
    sizes = pc.list_value_length(lists).to_numpy().astype(np.int64)
    flat = lists.flatten().to_numpy()
    if (sizes == dims).all():
        return flat.reshape(-1, dims)
    out = np.full((len(sizes), dims), SHIFT, np.int64)
    out[np.arange(dims) < sizes[:, None]] = flat
    return out


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task: rows that have a dimension, and the sum of their entries."""
    count, total = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for batch in batches:
        sizes = pc.list_value_length(batch.column(0)).to_numpy()
        dims = max(int(sizes.max(initial=0)), len(count))
        count, total = (np.pad(a, (0, dims - len(a))) for a in (count, total))
        count += (sizes[:, None] > np.arange(dims)).sum(0)
        total += (_rows(batch, "x", dims) - SHIFT).sum(0)
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(count)), pa.int32()), pa.array(count), pa.array(total)],
                                     ["dim", "n", "total"])


class _Fit:
    """The integer table with its exact centre, and passes over it."""

    def __init__(self, table: DataFrame):
        self.table = table
        sums = (table.select("x").mapInArrow(_sums, "dim int, n bigint, total bigint")
                .groupBy("dim").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect())
        self.dims = len(sums)
        self.n = max((r["n"] for r in sums), default=0)
        whole, rest = np.zeros(self.dims, np.int64), np.zeros(self.dims, np.int64)
        for r in sums:  # S = n * whole + rest, without rounding
            whole[r["dim"]], rest[r["dim"]] = divmod(r["total"], self.n)
        self.whole, self.rest = whole + SHIFT, rest

    def centred(self):
        whole, dims, part = self.whole, self.dims, self.rest / max(self.n, 1)
        return lambda batch: (_rows(batch, "x", dims) - whole) - part

    def total(self, of, width: int, columns=("x",)) -> np.ndarray:
        """Sum over all rows of ``of(batch)``, a vector of ``width`` numbers."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            acc = np.zeros(width)
            for batch in batches:
                acc += of(batch)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(width), pa.int32()), pa.array(acc)], ["i", "v"])
        out = np.zeros(width)
        for r in self.table.select(*columns).mapInArrow(run, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect():
            out[r["i"]] = r["v"]
        return out

    def apply(self, q: np.ndarray) -> np.ndarray:
        """V q for a block of columns: one pass over all rows."""
        centred = self.centred()

        def product(batch):
            c = centred(batch)
            return (c.T @ (c @ q)).ravel()
        return self.total(product, q.size).reshape(q.shape) / self.n


class _Probe:
    """Lanczos steps outside an orthonormal block, one per pass."""

    def __init__(self, q: np.ndarray, rng: np.random.Generator):
        self.q, self.basis, self.alpha, self.beta = q, [], [], []
        self._push(rng.standard_normal(len(q)))

    def _push(self, v: np.ndarray) -> None:
        size = np.linalg.norm(v)
        for _ in range(2):  # full reorthogonalisation; the complement is small or the steps are few
            v = v - self.q @ (self.q.T @ v)
            for b in self.basis:
                v = v - b * (b @ v)
        left = np.linalg.norm(v)
        self.open = left > 1e-10 * max(size, 1e-300) and len(self.basis) < len(v) - self.q.shape[1]
        if self.alpha:
            self.beta.append(left)
        if self.open:
            self.basis.append(v / left)

    def column(self) -> np.ndarray:
        return self.basis[-1] if self.open else np.zeros(len(self.q))

    def step(self, image: np.ndarray) -> None:
        if self.open:
            self.alpha.append(float(self.basis[-1] @ image))
            self._push(image)

    def range(self) -> tuple[float, float]:
        """Bounds of the spectrum outside the block, wider by the last residual."""
        if not self.alpha:
            return 0.0, 0.0
        k = len(self.alpha)
        value, vector = np.linalg.eigh(np.diag(self.alpha) + np.diag(self.beta[:k - 1], 1) + np.diag(self.beta[:k - 1], -1))
        slack = self.beta[k - 1] * np.abs(vector[-1]) if self.open else np.zeros(k)
        return max(0.0, float((value - slack).min())), float((value + slack).max())


def eigenpairs(apply, dims: int, components: int, guard: int = GUARD, degree: int = DEGREE,
               seed: int = 7) -> tuple[np.ndarray, np.ndarray, int]:
    """Largest eigenvalues and unit eigenvectors of the operator ``apply``
    (falling), and the number of passes it took."""
    rng = np.random.default_rng(seed)
    block, k = min(dims, components + guard), min(dims, components)
    q = np.eye(dims) if block == dims else np.linalg.qr(rng.standard_normal((dims, block)))[0]
    passes, before = 0, np.inf
    probe = _Probe(q, rng)
    for _ in range(MAX_ROUNDS):
        image = apply(np.column_stack([q, probe.column()]))
        passes += 1
        probe.step(image[:, -1])
        image = image[:, :-1]
        h = q.T @ image
        value, turn = np.linalg.eigh((h + h.T) / 2)
        value, turn = value[::-1], turn[:, ::-1]
        q, image = q @ turn, image @ turn
        top = max(value[0], 0.0)
        worst = np.linalg.norm(image[:, :k] - q[:, :k] * value[:k], axis=0).max()
        low, high = probe.range()
        if block == dims or top == 0.0:
            break
        settled = worst <= TOL * top or (worst <= FLOOR * top and worst > before / 2)
        if settled and high <= value[k - 1] + 1e-6 * top and before < np.inf:
            break
        before = worst
        # damp [low, cut]: everything outside the block, by a filter that is 1 at most there
        cut = max(value[-1], 1e-9 * top)
        low = low if low < cut * (1 - 1e-6) else 0.0  # the block lacks larger ones still: let them all grow
        centre, half = (cut + low) / 2, (cut - low) / 2
        scale = half / (top - centre)
        # a filter that lifts the top over the last wanted one by more than e**LIFT would drown it in rounding
        far, near = (np.arccosh(max(1.0, (e - centre) / half)) for e in (top, value[k - 1]))
        steps = max(1, min(degree, int(LIFT / max(far - near, 1e-9))))
        probe = _Probe(q, rng)
        past, now, s = q, (image - centre * q) * (scale / half), scale
        for _ in range(steps - 1):
            image = apply(np.column_stack([now, probe.column()]))
            passes += 1
            probe.step(image[:, -1])
            after = 1.0 / (2.0 / scale - s)
            past, now, s = now, (image[:, :-1] - centre * now) * (2 * after / half) - past * (s * after), after
        q = np.linalg.qr(now)[0]
    else:
        raise RuntimeError(f"no certified eigenvectors after {passes} passes")
    sign = np.sign(q[np.abs(q).argmax(0), np.arange(q.shape[1])])
    found = value[:k] > 1e-12 * top
    return value[:k][found], (q * sign)[:, :k][:, found], passes


def _deviations(x: np.ndarray, n: int, whole: np.ndarray, rest: np.ndarray) -> pa.Array:
    """Sum of (n x - S)^2 per row, exact; NULL beyond 64 bits."""
    far = x - whole
    reach = n * (int(np.abs(far).max(initial=0)) + 1)
    if reach ** 2 * x.shape[1] < 1 << 63:
        d = far * n - rest
        return pa.array((d * d).sum(1))
    d = far.astype(object) * n - rest.astype(object)
    return pa.array([t if t < 1 << 63 else None for t in (d * d).sum(1)], pa.int64())


def whiten(vectors: DataFrame, components: int = COMPONENTS, scale: int = SCALE, id_col: str = "vec_id",
           vec_col: str = "embedding", guard: int = GUARD) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``:
    a row per vector that takes part and component."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
    fit = _Fit(materialise(rows.mapInArrow(_quantiser(scale), "id bigint, x array<bigint>"), "whitening-rows"))
    if not fit.n:
        return spark.createDataFrame([], _OUT)
    centred = fit.centred()
    trace = fit.total(lambda batch: np.array([np.square(centred(batch)).sum()]), 1)[0] / fit.n
    value, vector, _ = eigenpairs(fit.apply, fit.dims, components, guard)
    if not len(value):
        return spark.createDataFrame([], _OUT)
    turn, k = vector / np.sqrt(value), len(value)

    def moments(batch):
        w = centred(batch) @ turn
        return np.concatenate([w.sum(0), (w.T @ w).ravel()])
    m = fit.total(moments, k + k * k) / fit.n
    cov = m[k:].reshape(k, k) - np.outer(m[:k], m[:k])
    error = float(np.abs(cov - np.eye(k)).max())
    share, n, whole, rest = value / trace, fit.n, fit.whole, fit.rest

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, w = _rows(batch, "x", len(whole)), centred(batch) @ turn
            each = np.repeat(np.arange(len(x)), k)
            size = len(each)
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                pa.array(np.full(size, n, np.int64)), _deviations(x, n, whole, rest).take(pa.array(each)),
                pa.array(w.ravel()), pa.array(np.tile(share, len(x))), pa.array(np.full(size, error))],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])
    return fit.table.mapInArrow(project, _OUT)


@register("op11_whitening")
def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings on their 32 largest principal components, whitened."""
    prepare(spark)
    return whiten(read(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
