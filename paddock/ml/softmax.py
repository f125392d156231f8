"""Multinomial logistic regression on rows that stay on storage, in narrow blocks.

The solver of ``pyspark.ml`` keeps the assembled rows, eight bytes an input, in memory
and what does not fit on the executors' disks. Here they are written once as blocks of
columns: of a column with few values in a block the values and a byte a row, so what
repeats costs next to nothing. Every step of the solver reads the blocks; a task holds
one of them at a time.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.common import _py2java
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseMatrix, DenseVector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paddock.session import discard, file_parts, materialize, settings

BLOCK_ROWS = 4096
BLOCK_BYTES = 8 << 20
ROW_GROUP = 4 << 20
BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
PARTS = "labels sizes values narrow wide plain".split()
STORED = ", ".join(f"{p} binary" for p in PARTS)
Loss = Callable[[np.ndarray], tuple[float, np.ndarray]]


# ---- blocks -----------------------------------------------------------------
def pack(labels: np.ndarray, inputs: np.ndarray) -> dict[str, bytes]:
    """A block of rows (``inputs`` by row) by column: ``sizes`` tells how many values a
    column has, with a byte or two a row for which it is, or 0 if it is stored as it is."""
    sizes, found = [], {p: [] for p in PARTS[2:]}
    for column in np.ascontiguousarray(inputs.T):
        values, codes = np.unique(column, return_inverse=True)
        if len(values) > min(0.7 * len(column), 1 << 16):
            sizes.append(0)
            found["plain"].append(column)
            continue
        sizes.append(len(values))
        found["values"].append(values)
        if len(values) > 256:
            found["wide"].append(codes.astype(np.uint16))
        elif len(values) > 1:
            found["narrow"].append(codes.astype(np.uint8))
    joined = {p: b"".join(a.tobytes() for a in arrays) for p, arrays in found.items()}
    return {"labels": labels.astype(np.int32).tobytes(), "sizes": np.array(sizes, np.int32).tobytes(), **joined}


def unpack(block: dict[str, bytes], means: np.ndarray = None, scales: np.ndarray = None):
    """(labels, inputs by column), the inputs less ``means`` and times ``scales``."""
    labels, sizes = np.frombuffer(block["labels"], np.int32), np.frombuffer(block["sizes"], np.int32)
    n = len(labels)
    values, plain = np.frombuffer(block["values"]), np.frombuffer(block["plain"]).reshape(-1, n)
    narrow, wide = np.frombuffer(block["narrow"], np.uint8).reshape(-1, n), np.frombuffer(block["wide"], np.uint16).reshape(-1, n)
    means, scales = np.zeros(len(sizes)) if means is None else means, np.ones(len(sizes)) if scales is None else scales
    out, at, i, j, k = np.empty((len(sizes), n)), 0, 0, 0, 0
    for c, size in enumerate(sizes.tolist()):
        own = plain[k] if not size else values[at : at + size]
        own, at = (own - means[c]) * scales[c], at + size
        if not size:
            out[c], k = own, k + 1
        elif size > 256:
            out[c], j = own[wide[j]], j + 1
        elif size > 1:
            out[c], i = own[narrow[i]], i + 1
        else:
            out[c] = own
    return labels, out


def stored_blocks(rows: DataFrame, label: str, features: str, width: int) -> DataFrame:
    """``rows`` written as blocks."""
    size = max(1, min(BLOCK_ROWS, BLOCK_BYTES // (8 * max(1, width))))

    def packed(batches):
        for batch in batches:
            inputs = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            if not np.isfinite(inputs).all():
                raise ValueError("an input is not a number or infinite")
            for first in range(0, batch.num_rows, size):
                part = slice(first, first + size)
                block = pack(batch.column(0).to_numpy(zero_copy_only=False)[part], inputs[part])
                yield pa.RecordBatch.from_pylist([block], pa.schema([(p, pa.binary()) for p in PARTS]))

    with settings(rows.sparkSession, {BATCH: size}):
        chosen = rows.select(F.col(label).cast("double"), vector_to_array(features))
        return materialize(chosen.mapInArrow(packed, STORED), "blocks", **{"parquet.block.size": ROW_GROUP})


def over_blocks(blocks: DataFrame, start: Callable, add: Callable) -> list:
    """What ``add(state, block)`` has made of ``start()`` in each task."""

    def folded(batches):
        state = start()
        for batch in batches:
            for row in range(batch.num_rows):
                state = add(state, {p: batch.column(p)[row].as_buffer() for p in PARTS})
        yield pa.RecordBatch.from_pylist([{f"s{i}": np.asarray(x, float).tobytes() for i, x in enumerate(state)}], pa.schema([(f"s{i}", pa.binary()) for i in range(len(state))]))

    shape = ", ".join(f"s{i} binary" for i in range(len(start())))
    with settings(blocks.sparkSession, {BATCH: 8}), file_parts(blocks.sparkSession, 1):
        rows = blocks.mapInArrow(folded, shape).collect()
    return [[np.frombuffer(x) for x in row] for row in rows]


# ---- the rows as a whole ----------------------------------------------------
def merged(a: tuple, b: tuple) -> tuple:
    """Label counts, means and sums of squared differences of two sets of rows."""
    (n_a, mean_a, m2_a), (n_b, mean_b, m2_b) = a, b
    if not n_a.sum():
        return b
    if not n_b.sum():
        return a
    share, apart = n_b.sum() / (n_a.sum() + n_b.sum()), mean_b - mean_a
    return n_a + n_b, mean_a + apart * share, m2_a + m2_b + apart * apart * n_a.sum() * share


def described(blocks: DataFrame, width: int, classes: int):
    """(rows by label, mean, standard deviation of the inputs)."""

    def start():
        return np.zeros(classes), np.zeros(width), np.zeros(width)

    def add(state, block):
        labels, inputs = unpack(block)
        # A column of one value has that very mean, so no deviation is made of rounding.
        means = np.where(np.frombuffer(block["sizes"], np.int32) == 1, inputs[:, 0], inputs.mean(axis=1))
        apart = inputs - means[:, None]
        return merged(state, (np.bincount(labels, minlength=classes).astype(float), means, (apart * apart).sum(axis=1)))

    whole = start()
    for part in over_blocks(blocks, start, add):
        whole = merged(whole, tuple(part))
    counts, means, squares = whole
    return counts, means, np.sqrt(squares / max(1.0, counts.sum() - 1))


def mean_loss(blocks: DataFrame, counts: np.ndarray, means: np.ndarray, scales: np.ndarray, l2: float) -> Loss:
    """The mean loss of weights (a row per class, the intercept last) on scaled inputs, with
    the penalty on all but the intercepts, and its slope."""
    shape = (len(counts), len(means) + 1)

    def loss(x: np.ndarray):
        weights = x.reshape(shape)

        def start():
            return np.zeros(1), np.zeros(shape)

        def add(state, block):
            labels, inputs = unpack(block, means, scales)
            z = weights[:, :-1] @ inputs + weights[:, -1:]
            z -= z.max(axis=0)
            own = z[labels, np.arange(len(labels))]
            np.exp(z, out=z)
            total = z.sum(axis=0)
            z /= total
            z[labels, np.arange(len(labels))] -= 1
            return state[0] + (np.log(total) - own).sum(), state[1] + np.column_stack([z @ inputs.T, z.sum(axis=1)])

        parts = over_blocks(blocks, start, add)
        n, plain = counts.sum(), weights[:, :-1]
        slope = sum(p[1] for p in parts).reshape(shape) / n
        slope[:, :-1] += l2 * plain
        return float(sum(p[0][0] for p in parts) / n + l2 / 2 * (plain * plain).sum()), slope.ravel()

    return loss


# ---- the solver -------------------------------------------------------------
def line_search(loss: Loss, x, value, slope, way, length, tries: int = 20):
    """(length, value, slope) of a step along ``way`` that meets the strong Wolfe
    conditions; after ``tries`` the best that made the loss less, or None."""
    steep = slope @ way
    low, high, best = (0.0, value, steep), None, None
    for _ in range(tries):
        at, there = loss(x + length * way)
        incline = there @ way
        less = np.isfinite(at) and at <= value + 1e-4 * length * steep
        if less and (best is None or at < best[1]):
            best = (length, at, there)
        if not less or at >= low[1] and low[0] > 0:
            high = (length, at, incline)
        elif abs(incline) <= 0.9 * -steep:
            return length, at, there
        else:
            if incline * ((high[0] if high else np.inf) - low[0]) >= 0:
                high = low
            low = (length, at, incline)
        if high is None:
            length *= 2
            continue
        # The least of the cubic through both ends, kept off them.
        (a, f_a, g_a), (b, f_b, g_b) = low, high
        d = g_a + g_b - 3 * (f_a - f_b) / (a - b)
        root = np.sqrt(max(0.0, d * d - g_a * g_b)) * np.sign(b - a)
        least = b - (b - a) * (g_b + root - d) / (g_b - g_a + 2 * root) if np.isfinite(f_b) and g_b - g_a + 2 * root else np.nan
        inner, outer = sorted((a + 0.1 * (b - a), a + 0.9 * (b - a)))
        length = float(np.clip(least, inner, outer)) if np.isfinite(least) else (a + b) / 2
    return best


def minimized(loss: Loss, x: np.ndarray, steps: int, tolerance: float, memory: int = 10) -> np.ndarray:
    """Where L-BFGS ends: after ``steps``, or once the loss or its slope hardly change."""
    value, slope = loss(x)
    first, seen, pairs = value, [value], []
    for _ in range(steps):
        if np.linalg.norm(slope) <= max(tolerance * abs(value), 1e-8):
            break
        way, factors = -slope, []
        for s, y in reversed(pairs):
            factors.append((s @ way) / (s @ y))
            way = way - factors[-1] * y
        if pairs:
            s, y = pairs[-1]
            way = way * (s @ y) / (y @ y)
        for (s, y), factor in zip(pairs, reversed(factors)):
            way = way + s * (factor - (y @ way) / (s @ y))
        found = line_search(loss, x, value, slope, way, 1.0 if pairs else 1 / np.linalg.norm(slope))
        if found is None:
            if not pairs:
                break
            pairs = []
            continue
        length, at, there = found
        s, y = length * way, there - slope
        if s @ y > 0:
            pairs = [*pairs, (s, y)][-memory:]
        x, value, slope = x + s, at, there
        seen = [*seen, value][-20:]
        if abs(value - max(seen)) <= tolerance * abs(first):
            break
    return x


class StoredLogisticRegression(LogisticRegression):
    """``LogisticRegression`` of the multinomial family with an L2 penalty: the same loss on
    the same standardized inputs, from the same start and to the same tolerance."""

    def _fit(self, dataset: DataFrame) -> LogisticRegressionModel:
        label, features = self.getLabelCol(), self.getFeaturesCol()
        one = dataset.select(features).first()
        spread = dataset.agg(F.min(label).alias("least"), F.max(label).alias("most")).first()
        if one is None or spread["least"] == spread["most"]:
            # Nothing to solve, which the given solver finds before it keeps any row.
            return super()._fit(dataset)
        width, classes = len(one[0]), int(spread["most"]) + 1
        blocks = stored_blocks(dataset, label, features, width)
        counts, means, deviations = described(blocks, width, classes)
        scales = np.divide(1.0, deviations, out=np.zeros(width), where=deviations > 0)
        weights = np.zeros((classes, width + 1))
        weights[:, -1] = np.log1p(counts) - np.log1p(counts).mean()
        loss = mean_loss(blocks, counts, means, scales, self.getRegParam())
        weights = minimized(loss, weights.ravel(), self.getMaxIter(), self.getTol()).reshape(weights.shape)
        discard(blocks)
        plain = weights[:, :-1] * scales
        intercepts = weights[:, -1] - plain @ means
        if not self.getRegParam():
            plain = plain - plain.mean(axis=0)
        return self._copyValues(fitted(dataset, self.uid, plain, intercepts - intercepts.mean()))


def fitted(dataset: DataFrame, uid: str, weights: np.ndarray, intercepts: np.ndarray) -> LogisticRegressionModel:
    sc = dataset.sparkSession.sparkContext
    matrix = _py2java(sc, DenseMatrix(*weights.shape, weights.ravel().tolist(), isTransposed=True))
    kind = sc._jvm.org.apache.spark.ml.classification.LogisticRegressionModel
    return LogisticRegressionModel(kind(uid, matrix, _py2java(sc, DenseVector(intercepts)), len(intercepts), True))
