"""Resolve typed names of a race card to ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paddock.functions import scalars as S
from paddock.schema import RacingTables


ENTRY = T.StructType(
    [
        T.StructField("horse_id", T.LongType()),
        T.StructField("start_pos", T.LongType()),
        T.StructField("jockey_id", T.LongType()),
        T.StructField("jockey_weight_kg", T.DoubleType()),
    ]
)


def inline_entries(cards: DataFrame, entries: str = "entries") -> DataFrame:
    """Race cards that hold their starters in an array -> one row per starter."""
    return cards.select(F.inline(F.col(entries).cast(T.ArrayType(ENTRY))))


def starter_names(tables: RacingTables) -> DataFrame:
    """Every start with the names of its horse, jockey, trainer and breeder; a name
    that is not known is NULL."""
    breeders = tables.breeders.select("breeder_id", F.col("name").alias("breeder_name"))
    horses = tables.horses.select("horse_id", "horse_name", "breeder_id").join(breeders, "breeder_id", "left")
    out = tables.race_records.select("race_record_id", "race_id", "horse_id", "jockey_id", "trainer_id")
    out = out.join(horses, "horse_id", "left")
    for person, df in (("jockey", tables.jockeys), ("trainer", tables.trainers)):
        known = df.select(f"{person}_id", F.col("last_name").alias(f"{person}_last_name"))
        out = out.join(known, f"{person}_id", "left")
    return out.select("race_record_id", "race_id", "horse_name", "jockey_last_name", "trainer_last_name", "breeder_name")


def _lookup(df: DataFrame, key: str, name: str, fold: bool, lenient: bool) -> DataFrame:
    return df.where(F.col(name).isNotNull()).select(
        S.name_key(F.col(name), fold=fold, lenient=lenient).alias("_name"), key
    )


def resolve_names(
    entries: DataFrame, tables: RacingTables, strip_initial: bool = False, fold: bool = False, lenient: bool = False
) -> DataFrame:
    """Left-join entries to horses, jockeys and trainers on normalized names.

    Ids stay NULL without a match; a name that several entities share gives one
    row per entity. ``strip_initial`` reads 'Surname I.' as the bare surname,
    ``fold`` ignores diacritics; ``lenient`` joins on collated names instead, which
    ignore case, accents and outer blanks without being rewritten.
    """
    out = entries
    for column, df, key, name in (
        ("horse_name", tables.horses, "horse_id", "horse_name"),
        ("jockey_last_name", tables.jockeys, "jockey_id", "last_name"),
        ("trainer_last_name", tables.trainers, "trainer_id", "last_name"),
    ):
        person = column != "horse_name"
        typed = S.name_key(F.col(column), strip_initial and person, fold, lenient)
        out = out.withColumn("_name", typed).join(_lookup(df, key, name, fold, lenient), "_name", "left").drop("_name")
    return out.withColumnRenamed("starting_pos", "starting_position")
