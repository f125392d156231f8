"""Full-batch gradient descent with a constant rate, as the models were defined.

The rows are stored once, standardized, a column for each input. Each step is one
aggregate over them: every task sums up the gradient of its rows, the sums are added by
coordinate, and the driver gets one number for each weight. Nothing depends on how rows are dealt but the
last bits of the sums.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paddock.ml.metrics import classifier_metrics, macro_auc, regression_metrics
from paddock.ml.train import PLACE_V2_SKIPPED, held_out, number_columns
from paddock.session import materialize


@dataclass(frozen=True)
class Weights:
    """``values`` has a row for each label (one for a regression): an intercept, then a
    weight for each of ``names``, whose means and deviations standardize them. A column
    without variance has the deviation 1; a missing number counts as the mean."""

    names: list[str]
    means: list[float]
    deviations: list[float]
    labels: list[str]
    values: np.ndarray

    def scaled(self) -> list[Column]:
        return [F.coalesce((F.col(c).cast("double") - F.lit(m)) / F.lit(d), F.lit(0.0)) for c, m, d in zip(self.names, self.means, self.deviations)]

    def inputs(self) -> Column:
        return F.array(F.lit(1.0), *self.scaled())

    def linear(self, inputs: Column) -> list[Column]:
        """What each label's weights make of the inputs."""
        return [
            F.aggregate(F.zip_with(inputs, F.array(*[F.lit(float(w)) for w in row]), lambda x, w: x * w), F.lit(0.0), lambda a, p: a + p)
            for row in self.values
        ]


def standardized(rows: DataFrame, names: list[str]) -> tuple[list[float], list[float]]:
    """Means and population deviations of the columns."""
    if not names:
        return [], []
    found = rows.agg(*[F.avg(F.col(c).cast("double")) for c in names], *[F.stddev_pop(F.col(c).cast("double")) for c in names]).first()
    means = [0.0 if m is None else float(m) for m in found[: len(names)]]
    return means, [float(d) if d else 1.0 for d in found[len(names) :]]


def gradient(x: np.ndarray, y: np.ndarray, weights: np.ndarray, softmax: bool) -> np.ndarray:
    """Sum over the rows of the gradient of half the squared error, or of the cross
    entropy of the labels' numbers ``y``."""
    error = x @ weights.T
    if softmax:
        error = np.exp(error - error.max(1, keepdims=True))
        error /= error.sum(1, keepdims=True)
        error[np.arange(len(y)), y.astype(np.int64)] -= 1
    else:
        error -= y[:, None]
    return error.T @ x


def gradient_sums(rows: DataFrame, weights: np.ndarray, softmax: bool) -> np.ndarray:
    """The gradient over all rows (the inputs but the intercept's, then y), as one
    aggregate."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros_like(weights)
        for batch in batches:
            *inputs, y = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if len(y):
                total += gradient(np.column_stack([np.ones(len(y)), *inputs]), y, weights, softmax)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size), pa.int32()), pa.array(total.ravel())], names=["at", "part"])

    parts = rows.mapInArrow(summed, "at int, part double").groupBy("at").agg(F.sum("part").alias("total")).collect()
    out = np.zeros(weights.size)
    for r in parts:
        out[r["at"]] = r["total"]
    return out.reshape(weights.shape)


def descend(rows: DataFrame, label: str, names: list[str], rate: float, steps: int, l2: float = 0.0, labels: list[str] = None) -> Weights:
    """Weights after ``steps`` steps of ``rate`` from zero: a regression on ``label``, or
    with ``labels`` a softmax over them. The loss is the mean over the rows plus
    ``l2`` / 2 times the squares of the weights, the intercepts left out. Without rows
    all weights stay zero. Rows without a label have to be left out before.
    """
    means, deviations = standardized(rows, names)
    start = Weights(names, means, deviations, labels or [], np.zeros((len(labels) if labels else 1, len(names) + 1)))
    y = F.col(label).cast("double") if labels is None else (F.array_position(F.array(*[F.lit(x) for x in labels]), F.col(label).cast("string")) - 1).cast("double")
    stored = materialize(rows.select(*[c.alias(f"x{i}") for i, c in enumerate(start.scaled())], y.alias("y")), "descent")
    total, weights = stored.count(), start.values
    for _ in range(steps if total else 0):
        slope = gradient_sums(stored, weights, labels is not None) / total
        slope[:, 1:] += l2 * weights[:, 1:]
        weights = weights - rate * slope
    return Weights(names, means, deviations, labels or [], weights)


def regression_scores(rows: DataFrame, weights: Weights) -> DataFrame:
    """Rows with ``prediction``."""
    return rows.withColumn("prediction", weights.linear(weights.inputs())[0])


def class_scores(rows: DataFrame, weights: Weights, label: str) -> DataFrame:
    """Rows with the number of their label, the most probable one's, and probabilities."""
    scored = rows.withColumn("_z", F.array(*weights.linear(weights.inputs())))
    powers = F.transform("_z", lambda z: F.exp(z - F.array_max("_z")))
    scored = scored.withColumn("_e", powers)
    total = F.aggregate("_e", F.lit(0.0), lambda a, e: a + e)
    number = F.array_position(F.array(*[F.lit(x) for x in weights.labels]), F.col(label).cast("string")) - 1
    scored = scored.withColumns({"probs": F.transform("_e", lambda e: e / total), "label": number.cast("double")})
    best = (F.array_position("probs", F.array_max("probs")) - 1).cast("double")
    return scored.withColumns({"prediction": best, "label_prob": F.get("probs", F.col("label").cast("int"))}).drop("_z", "_e")


def train_rating(rows: DataFrame, names: list[str] = None, rate: float = 0.1, steps: int = 50, l2: float = 1.0, eval_fraction: float = 0.15):
    """The rating model as defined: constant rate 0.1, 50 steps, L2 1.0; the weights and
    the evaluation on the held-out rows."""
    names = names or number_columns(rows, {"horse_id", "rating_score"})
    base = materialize(rows.where("rating_score IS NOT NULL").select("horse_id", *names, "rating_score"), "training")
    held = held_out(["horse_id"], eval_fraction)
    weights = descend(base.where(~held), "rating_score", names, rate, steps, l2)
    return weights, regression_metrics(regression_scores(base.where(held), weights), "rating_score").first().asDict()


def train_place(rows: DataFrame, names: list[str] = None, rate: float = 0.05, steps: int = 30, l2: float = 1.0, eval_fraction: float = 0.15):
    """The second place model as defined: constant rate 0.05, 30 steps, L2 1.0; the
    weights and the evaluation on the held-out rows. Labels are those of the rows
    learned from, in the order of their texts."""
    names = names or number_columns(rows, PLACE_V2_SKIPPED)
    keys = ["race_id", "horse_id"]
    base = materialize(rows.where("finish_place IS NOT NULL").select(*keys, *names, "finish_place"), "training")
    held = held_out(keys, eval_fraction)
    fit = base.where(~held)
    labels = sorted(r[0] for r in fit.select(F.col("finish_place").cast("string")).distinct().collect())
    weights = descend(fit, "finish_place", names, rate, steps, l2, labels)
    judged = class_scores(base.where(held), weights, "finish_place").where("label >= 0")
    metrics = classifier_metrics(judged.select("label", "prediction", "probs", "label_prob")).first().asDict()
    return weights, {**metrics, "roc_auc": macro_auc(judged, len(labels))}
