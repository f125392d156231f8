"""Fixed schemas: base tables, staged JSON, history tables, upcoming starters."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


_SCALARS = {
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def _struct(text: str, **nested: T.DataType) -> T.StructType:
    """Struct from ``name type`` pairs, plus nested fields; needs no session."""
    pairs = [item.split() for item in text.split(",") if item.strip()]
    flat = [T.StructField(name, _SCALARS[kind]) for name, kind in pairs]
    return T.StructType(flat + [T.StructField(n, t) for n, t in nested.items()])


AUDIT = "created_date timestamp, last_updated_date timestamp"

_HORSE = """horse_id bigint, horse_name string, horse_country string, birth_year bigint,
    horse_sex string, breed string, mother_id bigint, father_id bigint, trainer_id bigint,
    breeder_id bigint, color_name_pl string, color_name_en string, polish_breeding boolean,
    foreign_training boolean, owner_name string"""

_CAREER = """race_year bigint, race_type string, horse_age bigint, race_count bigint,
    race_won_count bigint, race_prize_count bigint, prize_amounts {amount}, prize_currencies string"""

HORSES = _struct(f"{_HORSE}, {AUDIT}")
HORSE_CAREERS = _struct(f"horse_id bigint, {_CAREER.format(amount='string')}, {AUDIT}")
RACES = _struct(
    f"""race_id bigint, race_number bigint, race_name string, race_date timestamp,
    currency_code string, currency_symbol string, duration_ms bigint, track_distance_m bigint,
    temperature_c double, weather string, race_group string, subtype string, category_id bigint,
    category_breed string, category_name string, country_code string, city_name string,
    track_type string, video_url string, race_rules string, payments string, race_style string,
    {AUDIT}"""
)
RACE_RECORDS = _struct(
    f"""race_record_id bigint, race_id bigint, horse_id bigint, start_order bigint,
    finish_place bigint, jockey_weight_kg double, prize_amount double, prize_currency string,
    jockey_id bigint, trainer_id bigint, {AUDIT}"""
)
JOCKEYS = _struct(
    f"jockey_id bigint, first_name string, last_name string, licence_country string, {AUDIT}"
)
TRAINERS = _struct(
    f"trainer_id bigint, first_name string, last_name string, licence_country string, {AUDIT}"
)
BREEDERS = _struct(f"breeder_id bigint, name string, city string, {AUDIT}")
INGESTION_METADATA = _struct("prefix string, last_processed_time timestamp")
INGESTED_UNITS = _struct("unit string, created timestamp")

# Staged documents as the normalizers emit them.
STAGED_RACE = _struct(
    """horse_id bigint, race_id bigint, start_order bigint, finish_place string,
    jockey_weight_kg double, prize_amount string, prize_currency string, jockey_id bigint,
    trainer_id bigint, race_number bigint, race_name string, video_url string, race_date bigint,
    track_distance_m bigint, temperature_c double, weather string, race_group string,
    subtype string, category_id bigint, category_breed string, category_name string,
    country_code string, city_name string, track_type string, race_rules string,
    payments string, race_style string"""
)
STAGED_CAREER = _struct(_CAREER.format(amount="double"))
STAGED_HORSE = T.StructType(
    [
        *_struct(_HORSE).fields,
        T.StructField("career", T.ArrayType(STAGED_CAREER)),
        T.StructField("races", T.ArrayType(STAGED_RACE)),
    ]
)
STAGED_JOCKEY = T.StructType(JOCKEYS.fields[:4])
STAGED_TRAINER = T.StructType(TRAINERS.fields[:4])
STAGED_BREEDER = T.StructType(BREEDERS.fields[:3])

# Raw documents as they arrive, before normalization.
RAW_CAREER = T.ArrayType(
    _struct(
        """raceYear bigint, raceType string, horseAge bigint, raceCount bigint,
        raceWonCount bigint, racePrizeCount bigint, prize string"""
    )
)
_ID = _struct("id bigint")
_NAME = _struct("name string")
RAW_RACE_EVENT = _struct(
    """id bigint, number bigint, name string, video string, date bigint, trackDistance bigint,
    temperature double, weather string, group string, subType string, fullConditions string,
    payments string""",
    currency=_struct("code string"),
    category=_struct("id bigint, horseBreed string, name string"),
    country=_struct("alfa3 string"),
    city=_NAME,
    trackType=_NAME,
    style=_NAME,
)
RAW_RACES = T.ArrayType(
    _struct(
        "order bigint, place double, jockeyWeight double",
        # A number or a text: the number 0.0 is no prize, the text "0" is one.
        prize=T.VariantType(),
        horse=_ID,
        jockey=_ID,
        trainer=_ID,
        race=RAW_RACE_EVENT,
    )
)
RAW_HORSE = _struct(
    """name string, suffix string, dateOfBirth bigint, sex string, breed string,
    horseFromPolishBreeding boolean, horseRanInForeignTraining boolean""",
    mother=_ID,
    father=_ID,
    trainer=_ID,
    breeders=T.ArrayType(_ID),
    color=_struct("polishName string, englishName string"),
    raceOwners=T.ArrayType(_NAME),
)
RAW_PERSON = _struct("firstName string, lastName string", licenceCountry=_struct("alfa3 string"))
RAW_BREEDER = _struct("name string, city string")

MODEL_REGISTRY = _struct(
    """model_name string, run_timestamp timestamp_ntz, model_type string, label_column string,
    training_window string, feature_snapshot date, mae double, rmse double, r2_score double,
    expl_variance double, log_loss double, accuracy double, top_k_accuracy double,
    precision double, recall double, f1_score double, description string"""
)
MODEL_EVAL_HISTORY = _struct(
    """model_name string, eval_timestamp timestamp_ntz, mean_absolute_error double,
    mean_squared_error double, mean_squared_log_error double, median_absolute_error double,
    r2_score double, explained_variance double"""
)
MODEL_METRICS_HISTORY = _struct(
    "model_name string, trained_at timestamp_ntz, accuracy double, log_loss double, roc_auc double"
)
HORSE_RATING_LABELS = _struct("horse_id string, snapshot_date date, rating_score double")

_FLAG_COLUMNS = """dist_l1200 dist_1200_1799 dist_1800_2399 dist_2400_3000 dist_m3000
    is_rainy is_cloudy is_sunny is_hot is_foggy group_I group_II group_III group_IV group_NONE
    group_SLED group_HURDLE group_STEEPLECHASE group_TRIAL race_breed_thoroughbred
    race_breed_arabian race_breed_standardbred race_breed_anglo_arabian country_PL city_Warsaw
    surface_lekko_elastyczny surface_elastyczny surface_mocno_elastyczny surface_lekki
    surface_dobry surface_miekki surface_ciezki""".split()
UPCOMING = _struct(
    """race_number bigint, horse_id bigint, trainer_id bigint, jockey_id bigint,
    jockey_weight_kg double, field_size bigint, start_order bigint, temperature_c double,
    distance_m bigint, """
    + ", ".join(f"{name} boolean" for name in _FLAG_COLUMNS)
)

BASE_TABLES = {
    "horses": HORSES,
    "horse_careers": HORSE_CAREERS,
    "races": RACES,
    "race_records": RACE_RECORDS,
    "jockeys": JOCKEYS,
    "trainers": TRAINERS,
    "breeders": BREEDERS,
}

# Tables that meet on one key: starts and races, horses and their careers.
BUCKETED_BY = {"races": "race_id", "race_records": "race_id", "horses": "horse_id", "horse_careers": "horse_id"}

# Merge key of every base table.
KEYS = {
    "horses": ["horse_id"],
    "horse_careers": ["horse_id", "race_year", "race_type"],
    "races": ["race_id"],
    "race_records": ["race_record_id"],
    "jockeys": ["jockey_id"],
    "trainers": ["trainer_id"],
    "breeders": ["breeder_id"],
}


def with_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project onto a fixed schema: cast what is there, NULL for what is not."""
    from pyspark.sql import functions as F

    have = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


@dataclass(frozen=True)
class RacingTables:
    """The seven entity tables as (lazy) DataFrames."""

    horses: DataFrame
    horse_careers: DataFrame
    races: DataFrame
    race_records: DataFrame
    jockeys: DataFrame = None
    trainers: DataFrame = None
    breeders: DataFrame = None

    @classmethod
    def load(cls, spark: SparkSession, root: str, touched: bool = True) -> "RacingTables":
        """Open every table under ``root`` with all its committed merges. Features need
        no update times: ``touched=False`` leaves them out, and a join with them."""
        from paddock.sources.tables import base_table

        return cls(**{name: base_table(spark, root, name).read(touched) for name in BASE_TABLES})
