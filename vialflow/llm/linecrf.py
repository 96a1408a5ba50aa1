"""Document quality from a linear-chain conditional random field over lines.

Every line of a document is labelled bad (0) or good (1). A line's score for
*good* is a weighted sum of its own measures and those of the lines before and
after it (``linefeatures``); a 2 x 2 table scores the step from one line's label
to the next. Forward-backward gives each line's marginal P(good | whole
document), and a document's quality is the mean of the marginals weighted by
line length. An affine map on the log-odds, fitted with the rest, makes that
mean the probability of label 1.

Forward and backward messages are products of 2 x 2 matrices, so they are
computed for all lines of a batch at once by doubling (a segmented scan: after
step s each line holds the product over 2**s lines); a document of a million
lines takes twenty array steps and no loop over lines.

Fitting. Labels are per document, so the training chains take the document's
label for each line. Numbers are scaled by their means and deviations over the
training lines. The penalised negative log-likelihood per line, in which each
document weighs the same, is minimised by limited-memory BFGS on the driver; value and gradient are sums over training documents computed by
Spark, one pass each, over a table of features written once. At most
``LABELLED`` labelled documents take part, those with the smallest hashes of
their ids; that bound is a parameter, everything else covers all rows.

Defined cases: a NULL text is empty; an empty text is one empty line and gets
the score of such a line; a NULL id is held out (its crc32 counts as 0);
repeated rows get a score each, and an id trains once, with its smallest text;
ids with a NULL label or with both labels train nothing; without training rows,
or with one label only, every score is the share of label 1 (0.5 without
labels); an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vialflow.llm.common import materialise, prepare, read, register, text_of
from vialflow.llm.linefeatures import N_ALL, chunks, emissions

#: Labelled documents that the fit reads at most.
LABELLED = 20_000
#: From this score on a document is predicted good.
CUT = 0.3
RIDGE = 1e-4
ROUNDS = 30
_STEPS = 4  # entries of the transition table
_WIDTH = N_ALL + _STEPS
_OUT = "doc_id bigint, held_out boolean, score double, predicted int"


def _scan(m: np.ndarray, scale: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Products of the matrices from each row's ``start`` up to the row, and the
    logarithms of the factors taken out to keep them near one."""
    at = np.arange(len(m))
    reach = 1
    while True:
        more = at - reach >= start
        if not more.any():
            return m, scale
        left = at[more] - reach
        product = np.einsum("nij,njk->nik", m[left], m[more])
        top = product.max((1, 2), keepdims=True)
        factor = scale[left] + scale[more] + np.log(top[:, 0, 0])
        m, scale = m.copy(), scale.copy()
        m[more], scale[more] = product / top, factor
        reach *= 2


def forward_backward(score: np.ndarray, step: np.ndarray, n_lines: np.ndarray):
    """Marginals P(good) per line, P(label, next label) per line that has a next
    one in its text, the index of those lines, and log Z per text.

    ``score``: log-weight of good per line; ``step``: 2 x 2 log-weights."""
    n, ends = len(score), np.cumsum(n_lines)
    start = np.repeat(ends - n_lines, n_lines)
    weight = np.zeros((n, 2))
    weight[:, 1] = score
    shift = np.maximum(weight[:, 1], 0.0)
    node = np.exp(weight - shift[:, None])
    edge = np.exp(step - step.max())
    m = edge[None] * node[:, None, :]
    first = ends - n_lines
    m[first] = np.eye(2) * node[first][:, None, :]
    taken = shift + step.max()
    taken[first] -= step.max()
    # forward: row sums of the prefix products; the first matrix is diagonal
    prefix, scale = _scan(m, taken, start)
    alpha = prefix.sum(1)
    log_z = (scale + np.log(alpha.sum(1)))[ends - 1]
    alpha /= alpha.sum(1, keepdims=True)
    # backward: the same scan over the reversed lines, of the next line's transposed matrix
    last = np.zeros(n, bool)
    last[ends - 1] = True
    following = np.empty_like(m)
    following[:-1] = m[1:]
    following[last] = np.eye(2)
    stop = np.repeat(ends - 1, n_lines)
    suffix, _ = _scan(following[::-1].transpose(0, 2, 1), np.zeros(n), (n - 1 - stop)[::-1])
    beta = suffix[::-1].transpose(0, 2, 1).sum(2)
    beta /= beta.sum(1, keepdims=True)
    joint = alpha * beta
    good = joint[:, 1] / joint.sum(1)
    here = np.flatnonzero(~last)
    pair = alpha[here][:, :, None] * m[here + 1] * beta[here + 1][:, None, :]
    return good, pair / pair.sum((1, 2), keepdims=True), here, log_z


def _mean_by_length(value: np.ndarray, size: np.ndarray, n_lines: np.ndarray) -> np.ndarray:
    starts = np.cumsum(n_lines) - n_lines
    w = size + 1.0  # an empty text still has a line that counts
    return np.add.reduceat(value * w, starts) / np.add.reduceat(w, starts)


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-9, 1 - 1e-9)
    return np.log(p) - np.log1p(-p)


class Model:
    """Weights on scaled numbers, the step table, and the final affine map."""

    def __init__(self, mean: np.ndarray, spread: np.ndarray, weights: np.ndarray, slope: float = 1.0, offset: float = 0.0):
        self.mean, self.spread, self.weights, self.slope, self.offset = mean, spread, weights, slope, offset

    def lines(self, numbers: np.ndarray, n_lines: np.ndarray):
        x = (numbers - self.mean) / self.spread
        return forward_backward(x @ self.weights[:N_ALL], self.weights[N_ALL:].reshape(2, 2), n_lines)

    def quality(self, numbers: np.ndarray, size: np.ndarray, n_lines: np.ndarray) -> np.ndarray:
        """P(label 1) of each text."""
        share = _mean_by_length(self.lines(numbers, n_lines)[0], size, n_lines)
        return 1 / (1 + np.exp(-(self.slope * _logit(share) + self.offset)))

    def likelihood(self, numbers, size, n_lines, label) -> np.ndarray:
        """(negative log-likelihood, gradient) of texts labelled 0 or 1, each
        text as one observation."""
        good, pair, here, log_z = self.lines(numbers, n_lines)
        x = (numbers - self.mean) / self.spread
        step = self.weights[N_ALL:].reshape(2, 2)
        starts = np.cumsum(n_lines) - n_lines
        y = np.repeat(label, n_lines).astype(float)
        each = 1.0 / np.repeat(n_lines, n_lines)
        path = np.add.reduceat(y * (x @ self.weights[:N_ALL]), starts) + (n_lines - 1) * step[label, label]
        moves = pair.copy()
        moves[np.arange(len(here)), y[here].astype(int), y[here].astype(int)] -= 1
        return np.concatenate([[((log_z - path) / n_lines).sum()], x.T @ ((good - y) * each),
                               (moves * each[here][:, None, None]).sum(0).ravel()])


def _crc(id_col: str) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")), F.lit(0))


def _training_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, label) to (label, lines, sizes, numbers) as 32-bit floats."""
    for batch in batches:
        label = batch.column(1).to_pylist()
        done = 0
        for run in chunks([t.as_py().encode("utf-8", "surrogatepass") for t in batch.column(0)]):
            numbers, size, n_lines = emissions(run)
            ends = np.cumsum(n_lines)
            cut = [slice(e - n, e) for e, n in zip(ends, n_lines)]
            yield pa.RecordBatch.from_arrays([
                pa.array(label[done:done + len(run)], pa.int32()), pa.array([size[c].astype("<f4").tobytes() for c in cut]),
                pa.array([numbers[c].astype("<f4").tobytes() for c in cut])], ["label", "size", "numbers"])
            done += len(run)


def _total(table: DataFrame, of, width: int) -> np.ndarray:
    """Sum of ``of(numbers, size, n_lines, label)`` over a table of training rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        acc = np.zeros(width)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                size = [np.frombuffer(b.as_py(), "<f4") for b in part.column(1)]
                numbers = np.concatenate([np.frombuffer(b.as_py(), "<f4") for b in part.column(2)]).astype(float)
                acc += of(numbers.reshape(-1, N_ALL), np.concatenate(size).astype(float), np.array([len(s) for s in size]),
                          part.column(0).to_numpy())
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width), pa.int32()), pa.array(acc)], ["i", "v"])
    out = np.zeros(width)
    for r in table.mapInArrow(run, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect():
        out[r["i"]] = r["v"]
    return out


def minimise(f, x: np.ndarray, rounds: int, memory: int = 8, tol: float = 1e-5) -> np.ndarray:
    """Limited-memory BFGS with step halving; ``f`` gives (value, gradient)."""
    value, grad = f(x)
    steps: list[tuple[np.ndarray, np.ndarray]] = []
    used = 1
    while used < rounds and np.abs(grad).max() > tol:
        d, left = grad.copy(), []
        for s, y in reversed(steps):
            left.append((s @ d) / (s @ y))
            d -= left[-1] * y
        if steps:
            s, y = steps[-1]
            d *= (s @ y) / (y @ y)
        else:
            d /= max(1.0, np.linalg.norm(d))
        for (s, y), a in zip(steps, reversed(left)):
            d += s * (a - (y @ d) / (s @ y))
        slope, size = grad @ d, 1.0
        while True:
            new = x - size * d
            new_value, new_grad = f(new)
            used += 1
            if new_value <= value - 1e-4 * size * slope or used >= rounds:
                break
            size /= 2
        if new_value > value:
            break
        s, y = new - x, new_grad - grad
        gain = value - new_value
        x, value, grad = new, new_value, new_grad
        if s @ y > 1e-12:
            steps = [*steps, (s, y)][-memory:]
        if gain < 1e-6 * max(value, 1e-3):
            break
    return x


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
        limit: int = LABELLED, rounds: int = ROUNDS) -> Model | float:
    """A model of label 1, or its share where no model can be fitted."""
    agreed = (labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("_id"))
              .agg(F.min(label_col).alias("label"), F.max(label_col).alias("_most"),
                   F.count(F.when(F.col(label_col).isNull(), 1)).alias("_none"))
              .where("label = _most and _none = 0 and label in (0, 1)").select("_id", F.col("label").cast("int").alias("label")))
    some = agreed.orderBy(F.xxhash64("_id"), "_id").limit(limit)
    known = docs.select(F.col(id_col).cast("long").alias("_id"), text_of(text_col).alias("text"))
    # ``limit`` ids at most: small enough for every task
    chosen = known.join(F.broadcast(some), "_id").groupBy("_id").agg(F.min("text").alias("text"), F.min("label").alias("label"))
    table = materialise(chosen.select("text", "label").repartition(16).mapInArrow(
        _training_rows, "label int, size binary, numbers binary"), "linecrf-training")
    by_label = {r["label"]: r["count"] for r in table.groupBy("label").count().collect()}
    n = sum(by_label.values())
    if len(by_label) < 2:
        return by_label.get(1, 0) / n if n else 0.5

    def moments(numbers, size, n_lines, label):
        each = (1.0 / np.repeat(n_lines, n_lines))[:, None]
        return np.concatenate([(numbers * each).sum(0), (numbers ** 2 * each).sum(0)])
    m = _total(table, moments, 2 * N_ALL) / n
    mean, spread = m[:N_ALL], np.sqrt(np.maximum(m[N_ALL:] - m[:N_ALL] ** 2, 0.0))
    flat = spread < 1e-6
    mean, spread = np.where(flat, 0.0, mean), np.where(flat, 1.0, spread)

    def loss(w: np.ndarray):
        model = Model(mean, spread, w)
        got = _total(table, model.likelihood, 1 + _WIDTH) / n
        return got[0] + RIDGE * (w @ w) / 2, got[1:] + RIDGE * w
    model = Model(mean, spread, minimise(loss, np.zeros(_WIDTH), rounds))

    # the affine map: a logistic fit of the label on the mean marginal's log-odds, by Newton steps
    def curvature(a: float, b: float):
        def of(numbers, size, n_lines, label):
            z = _logit(_mean_by_length(model.lines(numbers, n_lines)[0], size, n_lines))
            p = 1 / (1 + np.exp(-np.clip(a * z + b, -40, 40)))
            w = p * (1 - p)
            return np.array([((p - label) * z).sum(), (p - label).sum(), (w * z * z).sum(), (w * z).sum(), w.sum()])
        return of
    slope, offset = 1.0, 0.0
    for _ in range(6):
        g0, g1, h00, h01, h11 = _total(table, curvature(slope, offset), 5)
        # a weak pull to the identity keeps separable labels finite
        g0, g1, h00, h11 = g0 + (slope - 1.0), g1 + offset, h00 + 1.0, h11 + 1.0
        det = h00 * h11 - h01 * h01
        slope, offset = slope - (h11 * g0 - h01 * g1) / det, offset - (h00 * g1 - h01 * g0) / det
    model.slope, model.offset = max(float(slope), 1e-3), float(offset)
    return model


def score(docs: DataFrame, model: Model | float, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``_id, score``: P(label 1) of every row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for part in chunks([t.as_py().encode("utf-8", "surrogatepass") for t in batch.column(1)]):
                got = model.quality(*emissions(part)) if isinstance(model, Model) else np.full(len(part), float(model))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(done, len(part)), pa.array(got)], ["_id", "score"])
                done += len(part)
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), text_of(text_col).alias("_text"))
    return rows.mapInArrow(run, "_id bigint, score double")


@register("op13_line_crf")
def op13_line_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learned outside the held-out fifth."""
    prepare(spark)
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read(spark, sf_dir, "labels").select("doc_id", "quality")
    model = fit(docs, labels.where(_crc("doc_id") % 5 != 0))
    return score(docs, model).select(F.col("_id").alias("doc_id"), (_crc("_id") % 5 == 0).alias("held_out"), "score",
                                     (F.col("score") >= CUT).cast("int").alias("predicted"))
