"""Run history: registry rows and metric histories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paddock import schema
from paddock.schema import with_schema
from paddock.sources.tables import append_history


def registry_row(
    metrics: DataFrame,
    model_name: str,
    model_type: str,
    label_column: str,
    training_window: str,
    at: Column,
    feature_snapshot=None,
    description: str = None,
) -> DataFrame:
    """Metric rows in the registry's layout; metrics it lacks are NULL."""
    facts = {
        "model_name": model_name,
        "model_type": model_type,
        "label_column": label_column,
        "training_window": training_window,
        "feature_snapshot": feature_snapshot,
        "description": description,
    }
    named = metrics.withColumns({n: F.lit(v) for n, v in facts.items()}).withColumn("run_timestamp", at)
    return with_schema(named, schema.MODEL_REGISTRY)


def register_run(row: DataFrame, path: str) -> None:
    append_history(row, path, schema.MODEL_REGISTRY)


def regression_history_row(metrics: DataFrame, model_name: str, at: Column) -> DataFrame:
    named = metrics.withColumn("model_name", F.lit(model_name)).withColumn("eval_timestamp", at)
    return with_schema(named, schema.MODEL_EVAL_HISTORY)


def classifier_history_row(metrics: DataFrame, model_name: str, at: Column) -> DataFrame:
    named = metrics.withColumn("model_name", F.lit(model_name)).withColumn("trained_at", at)
    return with_schema(named, schema.MODEL_METRICS_HISTORY)
