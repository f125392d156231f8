"""A merge as large as its table: same rows as the merge of a small batch, one shuffle."""

from __future__ import annotations

from conftest import rows
from pyspark.sql import functions as F

from paddock import schema
from paddock.operators.merge import one_per_key, one_per_key_beside
from paddock.session import scratch_path
from paddock.sources.tables import MergedTable

SHAPE = "horse_id long, race_year long, race_type string, race_count long, race_won_count long, prize_amounts string"
OLD = [(1, 2000, "a", 1, 0, "5"), (1, None, "a", 2, 0, None), (2, 2000, None, 3, 1, "7"), (2, 2000, None, 3, 1, "7")]
NEW = [(1, 2000, "a", 9, 9, "9"), (1, None, "a", 9, 9, "9"), (2, 2000, None, 9, 9, "9"), (3, None, None, 4, 2, "8"), (3, None, None, 4, 1, None)]


def test_same_table_and_counts(spark):
    outcomes = []
    for whole in (False, True):
        table = MergedTable(spark, scratch_path(spark, "whole"), schema.HORSE_CAREERS, schema.KEYS["horse_careers"])
        old, at = F.lit("2001-01-01").cast("timestamp"), F.lit("2001-06-30").cast("timestamp")
        table.write(spark.createDataFrame(OLD, SHAPE).withColumns({"created_date": old, "last_updated_date": old}))
        first = table.merge(spark.createDataFrame(NEW, SHAPE), at, whole=whole)
        once = rows(table.read())
        again = table.merge(spark.createDataFrame(NEW, SHAPE), F.lit("2002-01-01").cast("timestamp"), whole=whole)
        outcomes.append((first, once, again, rows(table.read())))
    assert outcomes[0] == outcomes[1]
    assert outcomes[1][0] == {"staged": 4, "updated": 3, "inserted": 1}
    assert outcomes[1][2] == {"staged": 4, "updated": 4, "inserted": 0}


def test_keys_alone(spark):
    batch = spark.createDataFrame([(1,), (None,), (1,), (3,)], "id long")
    old = spark.createDataFrame([(1,), (None,), (2,)], "id long")
    found = one_per_key_beside(batch, old, ["id"], "known")
    assert rows(found) == rows(one_per_key(batch, ["id"]).withColumn("known", F.coalesce("id", F.lit(0)) != 3))


def test_one_exchange(spark):
    batch = spark.range(100).withColumn("a", F.lit(1))
    found = one_per_key_beside(batch, spark.range(50), ["id"], "known")
    text = found._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange ") == 1 and "Join" not in text
