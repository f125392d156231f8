"""Constant-rate descent against numpy on all rows, and its single steps."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from paddock.ml import descent
from paddock.ml.train import number_columns
from paddock.plans import assembly, horses


def plain(x, y, rate, steps, l2, n_labels=None):
    """The same descent with dense matrices; ``y`` holds numbers of labels with ``n_labels``."""
    x = np.array([[np.nan if v is None else float(v) for v in row] for row in x])
    means = np.nanmean(x, axis=0)
    means = np.where(np.isnan(means), 0, means)
    spread = np.nanstd(x, axis=0)
    z = np.nan_to_num((x - means) / np.where((spread == 0) | np.isnan(spread), 1, spread))
    z = np.hstack([np.ones((len(z), 1)), z])
    target = np.eye(n_labels)[np.array(y, int)] if n_labels else np.array(y, float)[:, None]
    w = np.zeros((z.shape[1], target.shape[1]))
    for _ in range(steps):
        out = z @ w
        if n_labels:
            out = np.exp(out - out.max(1, keepdims=True))
            out /= out.sum(1, keepdims=True)
        slope = z.T @ (out - target) / len(z)
        slope[1:] += l2 * w[1:]
        w -= rate * slope
    return w.T


@pytest.fixture(scope="module")
def numbers(spark):
    rng = np.random.default_rng(3)
    rows = [(int(i), float(a), None if i % 7 == 0 else float(b), 5.0, bool(i % 2), float(3 * a - b + rng.normal())) for i, (a, b) in enumerate(rng.normal(2, 3, (500, 2)))]
    return spark.createDataFrame(rows, "horse_id long, a double, b double, same double, flag boolean, rating_score double").repartition(5)


def test_regression(numbers):
    names = ["a", "b", "same", "flag"]
    found = descent.descend(numbers, "rating_score", names, 0.1, 50, 1.0)
    rows = numbers.collect()
    want = plain([[r[c] for c in names] for r in rows], [r["rating_score"] for r in rows], 0.1, 50, 1.0)
    assert np.allclose(found.values, want, rtol=1e-9) and found.deviations[2] == 1.0
    # Without a penalty and with enough steps it is the least squares line.
    fitted = descent.descend(numbers, "rating_score", ["a"], 0.5, 60)
    slope, intercept = np.polyfit([r["a"] for r in rows], [r["rating_score"] for r in rows], 1)
    scored = descent.regression_scores(numbers, fitted).collect()
    assert all(abs(r["prediction"] - (slope * r["a"] + intercept)) < 1e-6 for r in scored)


def test_softmax(spark, numbers):
    rows = numbers.withColumn("label", F.when(F.col("a") > 3, "x").when(F.col("rating_score") < 0, "z").otherwise("y"))
    names, labels = ["a", "b", "flag"], ["x", "y", "z"]
    found = descent.descend(rows, "label", names, 0.05, 30, 1.0, labels)
    held = rows.collect()
    want = plain([[r[c] for c in names] for r in held], [labels.index(r["label"]) for r in held], 0.05, 30, 1.0, 3)
    assert np.allclose(found.values, want, rtol=1e-9)
    scored = descent.class_scores(rows.withColumn("text", F.col("label")), found, "text").collect()
    assert all(abs(sum(r["probs"]) - 1) < 1e-9 and r["prediction"] == int(np.argmax(r["probs"])) and r["label_prob"] == r["probs"][int(r["label"])] for r in scored)


def test_dealing_does_not_matter(numbers):
    one = descent.descend(numbers.coalesce(1), "rating_score", ["a", "b"], 0.1, 20, 1.0).values
    many = descent.descend(numbers.repartition(9, "a"), "rating_score", ["a", "b"], 0.1, 20, 1.0).values
    assert np.allclose(one, many, rtol=1e-12)


def test_no_rows(numbers):
    none = descent.descend(numbers.limit(0), "rating_score", ["a"], 0.1, 50)
    assert none.values.tolist() == [[0.0, 0.0]] and none.deviations == [1.0]


def test_all_inputs(spark, tables):
    """Both models on all their inputs, against numpy."""
    rows = assembly.race_features(tables, "2001-06-30")
    names = number_columns(rows, descent.PLACE_V2_SKIPPED)
    weights, metrics = descent.train_place(rows, steps=5)
    assert weights.names == names and weights.values.shape == (len(weights.labels), len(names) + 1)
    fit = rows.where(~descent.held_out(["race_id", "horse_id"], 0.15)).collect()
    want = plain([[r[c] for c in names] for r in fit], [weights.labels.index(str(r["finish_place"])) for r in fit], 0.05, 5, 1.0, len(weights.labels))
    assert np.allclose(weights.values, want, rtol=1e-6, atol=1e-9) and 0 <= metrics["accuracy"] <= 1
    rated = horses.horse_features(tables, "2001-06-30").withColumn("rating_score", F.col("horse_id") % 50 + F.col("age_years"))
    weights, metrics = descent.train_rating(rated, steps=5)
    assert np.isfinite(weights.values).all() and metrics["mean_absolute_error"] > 0
