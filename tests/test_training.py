"""Training: dense blocks, parts of bounded size, ranges of scores."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from paddock.ml import metrics, train
from paddock.session import file_parts, materialize


def starters(spark, n=4000):
    draw = random.Random(7)
    rows = []
    for i in range(n):
        x = draw.random()
        rows.append((i, i % 97, 1 + int(3 * min(0.99, max(0.0, x + draw.uniform(-0.3, 0.3)))), x, float(i % 5), draw.choice(["a", "b", None])))
    return spark.createDataFrame(rows, "race_id long, horse_id long, finish_place long, x double, y double, kind string")


def fitted(rows, **options):
    return train.train_classifier(rows, "finish_place", ["race_id", "horse_id"], ["x", "y"], ["kind"], **options)


def test_centered_inputs_give_the_same_model(spark):
    rows = starters(spark)
    plain, centered = fitted(rows), fitted(rows, centered=True)
    assert plain.baseline == centered.baseline and plain.labels == centered.labels
    for name, value in plain.metrics.items():
        assert abs(value - centered.metrics[name]) < 1e-4, name


def test_solver_gets_parts_of_bounded_size(spark, monkeypatch):
    seen = []

    class Watched(train.Pipeline):
        def fit(self, rows, *rest):
            seen.append(rows.rdd.getNumPartitions())
            return super().fit(rows, *rest)

    monkeypatch.setattr(train, "Pipeline", Watched)
    # Neither files nor row groups may be too large to be dealt out.
    monkeypatch.setattr(train, "TASK_BYTES", 8_000)
    monkeypatch.setattr(train, "ROW_GROUP", 1_000)
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        trained = fitted(starters(spark).coalesce(1))
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", before)
    rows = trained.baseline["rows_train"]
    assert seen[0] >= rows * 8 * (2 + 8) / 8_000 * 0.8


def test_file_parts_puts_the_setting_back(spark):
    name = "spark.sql.files.minPartitionNum"
    before = spark.conf.get(name, None)
    with file_parts(spark, 321):
        assert spark.conf.get(name) == "321"
    assert spark.conf.get(name, None) == before


def test_ranges_of_scores(spark):
    cuts = sorted(random.Random(3).choices(range(40), k=63))
    rows = spark.createDataFrame([(float(v), [float(c) for c in cuts]) for v in range(-1, 42)] + [(None, [0.0] * 63), (1.0, None)], "p double, cuts array<double>")
    found = metrics._below(rows, "cuts", 64, "p", "range").withColumn("wanted", F.size(F.filter("cuts", lambda c: c < F.col("p")))).collect()
    assert len(found) == 45 and all(r["range"] == r.wanted for r in found if r.cuts)


def test_stored_results_are_compressed(spark):
    rows = spark.range(1000).toDF("n")
    files = materialize(rows, "squeezed").inputFiles()
    assert files and all(".zstd." in f for f in files)
