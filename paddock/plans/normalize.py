"""Raw JSON documents -> staged rows and documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paddock.functions import scalars as S
from paddock.operators.ordered import ROWS_PER_TASK, over_recent_rows
from paddock.schema import RAW_CAREER, STAGED_RACE


# ---- career -----------------------------------------------------------------
CAREER_FACTS = ["race_type", "horse_age", "race_count", "race_won_count", "race_prize_count"]


def _career_facts(row) -> list[Column]:
    """Facts of a row that opens a season; ``row`` looks a raw field up."""
    count = {
        "race_count": "raceCount",
        "race_won_count": "raceWonCount",
        "race_prize_count": "racePrizeCount",
    }
    return [
        S.blank_to_null(row("raceType")).alias("race_type"),
        S.zero_to_null(row("horseAge")).alias("horse_age"),
        *[F.coalesce(row(raw), F.lit(0).cast("long")).alias(name) for name, raw in count.items()],
    ]


def _season_type(kind: Column) -> Column:
    return F.coalesce(S.blank_to_null(kind), F.lit("UNKNOWN"))


def normalize_career(raw: Column, compat_fx: bool = False) -> Column:
    """Fold one document's raw career array into seasons, inside its row.

    A row with a year opens the season (year, type); the first row of a season
    gives its facts and later ones add nothing. A row without a year adds its
    prize to the season opened last; prizes before any season are lost.
    """
    empty = F.array()

    def opening_places(rows: Column) -> Column:
        places = F.when(F.size(rows) > 0, F.sequence(F.lit(0), F.size(rows) - 1))
        return F.filter(
            F.coalesce(places, empty.cast("array<int>")),
            lambda i: F.get(rows, i)["raceYear"].isNotNull(),
        )

    def span(rows: Column, opens: Column, start: Column, nth: Column) -> Column:
        end = F.coalesce(F.get(opens, nth + 1), F.size(rows))
        prizes = F.slice(rows, start + 2, end - start - 1)
        won = F.aggregate(
            prizes, F.lit(0.0), lambda acc, r: acc + S.prize_in_pln(r["prize"], compat_fx)
        )
        year = F.get(rows, start)["raceYear"].alias("year")
        kind = _season_type(F.get(rows, start)["raceType"]).alias("kind")
        return F.struct(
            F.struct(year, kind).alias("season"),
            F.struct(*_career_facts(lambda f: F.get(rows, start)[f])).alias("facts"),
            won.alias("won"),
        )

    def entry(spans: Column, season: Column) -> Column:
        def fold(own: Column) -> Column:
            total = F.aggregate(own, F.lit(0.0), lambda acc, s: acc + s["won"])
            facts = F.get(own, F.lit(0))["facts"]
            return F.struct(
                season["year"].alias("race_year"),
                *[facts[c].alias(c) for c in CAREER_FACTS],
                total.alias("prize_amounts"),
                F.lit("PLN").alias("prize_currencies"),
            )

        return S.let(F.filter(spans, lambda s: s["season"] == season), fold)

    def seasons(spans: Column) -> Column:
        names = F.array_distinct(F.transform(spans, lambda s: s["season"]))
        return F.transform(names, lambda season: entry(spans, season))

    def folded(rows: Column) -> Column:
        return S.let(
            opening_places(rows),
            lambda opens: S.let(
                F.transform(opens, lambda start, nth: span(rows, opens, start, nth)), seasons
            ),
        )

    return S.let(F.coalesce(raw, empty.cast(RAW_CAREER)), folded)


def normalize_career_rows(
    rows: DataFrame,
    keys: list[str],
    order: list[str],
    compat_fx: bool = False,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """The same fold for raw career entries stored as rows of any number.

    The running "season opened last" is a look-back over one opening row, and
    the seasons are grouped aggregates, so one hot key stays parallel.
    """
    opens = F.col("raceYear").isNotNull()
    season = F.when(opens, F.struct("raceYear", _season_type(F.col("raceType")).alias("kind")))
    marked = rows.withColumn("_season", season)
    placed = over_recent_rows(
        marked,
        keys,
        order,
        1,
        ["_season"],
        lambda w: {"_in": F.last("_season", ignorenulls=True).over(w)},
        pick=F.col("_season").isNotNull(),
        rows_per_task=rows_per_task,
    ).where(F.col("_in").isNotNull())
    opening = F.when(opens, F.struct(*_career_facts(F.col)))
    first = F.min_by(opening, F.when(opens, F.struct(*order)))
    won = F.sum(F.when(~opens, S.prize_in_pln(F.col("prize"), compat_fx)).otherwise(F.lit(0.0)))
    grouped = placed.groupBy(*keys, "_in").agg(first.alias("_facts"), won.alias("prize_amounts"))
    return grouped.select(
        *keys,
        F.col("_in.raceYear").alias("race_year"),
        "_facts.*",
        "prize_amounts",
        F.lit("PLN").alias("prize_currencies"),
    )


# ---- races ------------------------------------------------------------------
def _finish_place(place: Column) -> Column:
    whole = place.cast("long")
    text = F.when(place == whole, whole.cast("string")).otherwise(place.cast("string"))
    return F.when(place > 0, text).otherwise("UNKNOWN")


def _prize_text(prize: Column) -> Column:
    """Text of a prize that is a JSON number or text; NULL for the number zero, an
    empty text, ``false`` and ``null``."""
    text, number = F.try_variant_get(prize, "$", "string"), F.try_variant_get(prize, "$", "double")
    quoted = F.to_json(prize).startswith('"')
    return F.when(quoted, S.blank_to_null(text)).when(number.isNull() | (number != 0), text)


def race_entry(r: Column) -> Column:
    """One raw race entry as a staged struct; zero and empty become NULL."""
    race = r["race"]
    number, text = S.zero_to_null, S.blank_to_null
    zero = lambda c: F.nullif(c, F.lit(0.0))
    parts = {
        "horse_id": number(r["horse"]["id"]),
        "race_id": number(race["id"]),
        "start_order": number(r["order"]),
        "finish_place": _finish_place(r["place"]),
        "jockey_weight_kg": zero(r["jockeyWeight"]),
        "prize_amount": _prize_text(r["prize"]),
        "prize_currency": text(race["currency"]["code"]),
        "jockey_id": number(r["jockey"]["id"]),
        "trainer_id": number(r["trainer"]["id"]),
        "race_number": number(race["number"]),
        "race_name": text(race["name"]),
        "video_url": text(race["video"]),
        "race_date": number(race["date"]),
        "track_distance_m": number(race["trackDistance"]),
        "temperature_c": zero(race["temperature"]),
        "weather": text(race["weather"]),
        "race_group": text(race["group"]),
        "subtype": text(race["subType"]),
        "category_id": number(race["category"]["id"]),
        "category_breed": text(race["category"]["horseBreed"]),
        "category_name": text(race["category"]["name"]),
        "country_code": text(race["country"]["alfa3"]),
        "city_name": text(race["city"]["name"]),
        "track_type": text(race["trackType"]["name"]),
        "race_rules": text(race["fullConditions"]),
        "payments": text(race["payments"]),
        "race_style": text(race["style"]["name"]),
    }
    return F.struct(*[c.alias(n) for n, c in parts.items()])


def normalize_races(raw: Column) -> Column:
    """Flatten every raw race entry of a document; no array gives an empty one."""
    return F.coalesce(F.transform(raw, race_entry), F.array().cast(T.ArrayType(STAGED_RACE)))


# ---- entities ---------------------------------------------------------------
def normalize_horse(raw: DataFrame, compat_fx: bool = False) -> DataFrame:
    """Raw horse documents -> staged horse documents.

    ``raw`` has ``horse_id`` and the raw structs ``horse``, ``career``, ``races``.
    """
    h = F.col("horse")
    text, number = S.blank_to_null, S.zero_to_null
    no = F.lit(False)
    return raw.select(
        "horse_id",
        text(h["name"]).alias("horse_name"),
        text(h["suffix"]).alias("horse_country"),
        number(h["dateOfBirth"]).alias("birth_year"),
        text(h["sex"]).alias("horse_sex"),
        text(h["breed"]).alias("breed"),
        number(h["mother"]["id"]).alias("mother_id"),
        number(h["father"]["id"]).alias("father_id"),
        number(h["trainer"]["id"]).alias("trainer_id"),
        number(F.get(h["breeders"], F.lit(0))["id"]).alias("breeder_id"),
        text(h["color"]["polishName"]).alias("color_name_pl"),
        text(h["color"]["englishName"]).alias("color_name_en"),
        F.coalesce(h["horseFromPolishBreeding"], no).alias("polish_breeding"),
        F.coalesce(h["horseRanInForeignTraining"], no).alias("foreign_training"),
        text(F.get(h["raceOwners"], F.lit(0))["name"]).alias("owner_name"),
        normalize_career(F.col("career"), compat_fx).alias("career"),
        normalize_races(F.col("races")).alias("races"),
    )


def normalize_person(raw: DataFrame, key: str) -> DataFrame:
    """Jockeys and trainers: ``key`` plus the raw struct ``person``."""
    p = F.col("person")
    return raw.select(
        key,
        S.blank_to_null(p["firstName"]).alias("first_name"),
        S.blank_to_null(p["lastName"]).alias("last_name"),
        S.blank_to_null(p["licenceCountry"]["alfa3"]).alias("licence_country"),
    )


def normalize_breeder(raw: DataFrame) -> DataFrame:
    b = F.col("breeder")
    return raw.select(
        "breeder_id", S.blank_to_null(b["name"]).alias("name"), S.blank_to_null(b["city"]).alias("city")
    )
