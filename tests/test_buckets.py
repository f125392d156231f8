"""Base tables stored in buckets: joins without a shuffle, before and after merges."""

from dataclasses import replace

import pytest
from conftest import rows
from pyspark.sql import functions as F

from paddock import schema
from paddock.plans import people
from paddock.plans.starts import asof_starts
from paddock.schema import BUCKETED_BY, KEYS, RacingTables, with_schema
from paddock.sources.tables import Buckets, MergedTable, base_table

AS_OF = "2001-06-30"


@pytest.fixture(scope="module", autouse=True)
def settings(spark):
    spark.conf.set("paddock.buckets", "4")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("paddock.buckets")
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def now(day):
    return F.lit(f"2025-08-0{day} 10:00:00").cast("timestamp")


def shaped(tables, name):
    df = getattr(tables, name)
    return with_schema(df.withColumns({"created_date": now(1), "last_updated_date": now(1)}), schema.BASE_TABLES[name])


@pytest.fixture(scope="module")
def lake(spark, tables, tmp_path_factory):
    """A table written at once, and two merges that touch and add rows."""
    root = str(tmp_path_factory.mktemp("lake"))
    for name in schema.BASE_TABLES:
        table = base_table(spark, root, name)
        if name in BUCKETED_BY:
            whole, key = shaped(tables, name), KEYS[name][0]
            table.write(whole.where(F.col(key) % 3 == 0))
            table.merge(whole.where(F.col(key) % 3 <= 1), now(2))
            table.merge(whole, now(3))
        else:
            table.write(shaped(tables, name))
    return root


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_starts_without_exchange(spark, tables, lake):
    stored = RacingTables.load(spark, lake, touched=False)
    assert "Exchange" not in plan_of(asof_starts(stored, AS_OF))
    assert rows(people.jockeys(stored, AS_OF)) == rows(people.jockeys(tables, AS_OF))
    # Whole, a table also tells when its rows were touched last.
    days = {r["d"]: r["n"] for r in base_table(spark, lake, "races").read().groupBy(F.dayofmonth("last_updated_date").alias("d")).agg(F.count("*").alias("n")).collect()}
    assert days == {3: tables.races.count()}


def test_compacted(spark, tables, lake):
    """A compacted table keeps its buckets, and so does an upsert after it."""
    for name in BUCKETED_BY:
        base_table(spark, lake, name).compact(keep=1)
    for again in range(2):
        stored = RacingTables.load(spark, lake, touched=False)
        assert "Exchange" not in plan_of(asof_starts(stored, AS_OF))
        horses = stored.horses.select("horse_id", "birth_year").join(stored.horse_careers, "horse_id")
        assert "Exchange" not in plan_of(horses)
        assert rows(people.trainers(stored, AS_OF)) == rows(people.trainers(tables, AS_OF))
        if not again:
            new = shaped(replace(tables, races=tables.races.limit(3).withColumn("race_id", -1 - F.col("race_id"))), "races")
            assert base_table(spark, lake, "races").merge(new, now(4)) == {"staged": 3, "updated": 0, "inserted": 3}


def test_other_sessions_read_the_buckets(spark, lake):
    other = spark.newSession()
    other.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    assert "Exchange" not in plan_of(asof_starts(RacingTables.load(other, lake, touched=False), AS_OF))


def test_null_keys_and_plain_tables(spark, tmp_path):
    """Null keys lie in a bucket as well; a plain table is dealt anew by ``compact``."""
    shape = schema.BREEDERS
    batch = lambda ids: with_schema(spark.createDataFrame([(i, "n", "c") for i in ids], "breeder_id long, name string, city string"), shape)
    plain = MergedTable(spark, f"{tmp_path}/t", shape, ["breeder_id"])
    plain.merge(batch([None, 1, 2]), now(1))
    bucketed = MergedTable(spark, f"{tmp_path}/t", shape, ["breeder_id"], Buckets("breeder_id", 3))
    assert bucketed.merge(batch([None, 2, 3]), now(2)) == {"staged": 3, "updated": 2, "inserted": 1}
    before = rows(bucketed.read().drop("last_updated_date"))
    bucketed.compact(keep=1)
    assert rows(bucketed.read().drop("last_updated_date")) == before == rows(plain.read(touched=False))
    assert len(before) == 4
    pair = bucketed.read(touched=False).alias("a").join(plain.read(touched=False).alias("b"), "breeder_id")
    assert "Exchange" not in plan_of(pair)
