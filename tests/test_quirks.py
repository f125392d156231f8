"""Tiny hand-made tables, one per behaviour that is easy to get wrong."""

import datetime as dt
from dataclasses import replace

import pytest
from conftest import rows
from pyspark.sql import functions as F

from paddock import schema
from paddock.plans import assembly, first_version, horses, ingest, people, races
from paddock.plans.starts import asof_starts

DAY = dt.date(2025, 7, 31)


@pytest.fixture(scope="module")
def tiny(spark):
    """Two horses: one with two race types a year, one without any career."""

    def table(shape, names, data):
        kinds = {f.name: f.dataType.simpleString() for f in shape.fields}
        ddl = ", ".join(f"{n} {kinds[n]}" for n in names.split())
        return schema.with_schema(spark.createDataFrame(data, ddl), shape)

    return schema.RacingTables(
        horses=table(
            schema.HORSES,
            "horse_id birth_year father_id trainer_id breeder_id",
            [(1, 2020, 2, 7, 5), (2, 2000, None, 7, 5), (3, 2030, 99, None, None)],
        ),
        horse_careers=table(
            schema.HORSE_CAREERS,
            "horse_id race_year race_type race_count race_won_count prize_amounts",
            [
                (1, 2025, "a", 2, 1, "27800,175"),
                (1, 2025, None, 2, 0, "100"),
                (1, 2023, "a", 4, 1, "50.5"),
                (1, 2022, "a", 9, 9, "1"),
                (1, 2026, "a", 5, 5, "1"),
                (3, 2025, "a", 0, 0, "x"),
            ],
        ),
        races=table(
            schema.RACES,
            "race_id race_date track_distance_m temperature_c weather country_code",
            [
                (10, dt.datetime(2025, 7, 31, 23, 30), 1600, 22.5, "deszcz", "POL"),
                (11, dt.datetime(2025, 7, 30, 0, 30), 2000, 10.0, None, "CZE"),
                (12, dt.datetime(2025, 8, 1, 0, 0), 2000, 30.0, "pogodnie", None),
            ],
        ),
        race_records=table(
            schema.RACE_RECORDS,
            "race_record_id race_id horse_id start_order finish_place jockey_weight_kg prize_amount jockey_id trainer_id",
            [
                (1, 10, 1, 1, 1, 50.0, 0.0, 4, 7),
                (2, 10, 2, None, None, 60.0, 0.0, 4, 7),
                (3, 10, 1, 3, 2, 101.0, 0.0, None, 7),
                (4, 11, 1, 1, 1, None, 5.0, 4, 7),
                (5, 12, 1, 1, 1, 55.0, 0.0, 4, None),
            ],
        ),
    )


def test_whole_last_day_counts_and_the_next_does_not(tiny):
    assert sorted(r.race_id for r in asof_starts(tiny, DAY).collect()) == [10, 10, 10, 11]


def test_comma_lists_drop_out_of_earnings(tiny):
    got = {r.horse_id: r for r in horses.horses_career(tiny, DAY).collect()}
    assert (got[1].career_starts, got[1].career_wins, got[1].total_earnings) == (17, 11, 151.5)
    assert (got[3].career_win_pct, got[3].total_earnings, got[3].earnings_per_start) == (None, None, None)


def test_one_row_per_horse_with_several_race_types(tiny):
    got = {r.horse_id: r for r in horses.horses_recent(tiny, DAY).collect()}
    assert len(got) == 3
    one = got[1]
    assert (one.race_count_current_year, one.win_count_current_year, one.win_pct_current_year) == (4, 1, 0.25)
    assert (one.rolling_race_count_last_3yrs, one.rolling_win_count_last_3yrs) == (8, 2)
    assert (one.current_vs_last3yrs_win_pct, one.days_since_last_race) == (0.0, 0)
    assert got[3].days_since_last_race is None and got[3].win_pct_current_year == 0.0


def test_age_outliers(tiny):
    got = {r.horse_id: (r.age_years, r.is_age_outlier) for r in horses.horses_base(tiny, DAY).collect()}
    assert got == {1: (5, False), 2: (25, True), 3: (-5, True)}


def test_unknown_relatives_count_zero(tiny):
    got = {r.horse_id: r for r in horses.horses_perf(tiny, DAY).collect()}
    assert (got[1].sire_starts, got[1].sire_wins, got[1].sire_win_pct) == (1, 0, 0.0)
    assert (got[1].breeder_starts, got[1].trainer_wins) == (4, 2)
    assert (got[3].sire_starts, got[3].dam_win_pct, got[3].breeder_starts, got[3].trainer_starts) == (0, 0.0, 0, 0)


def test_horses_without_career_drop_out(tiny):
    assert {r.horse_id for r in horses.horse_features(tiny, DAY).collect()} == {1, 3}


def test_a_missing_place_is_a_start_without_a_win(tiny):
    jockey = people.jockeys(tiny, DAY).first()
    assert (jockey.jockey_total_starts, jockey.jockey_total_wins) == (3, 2)
    flags = {r.horse_id: r.is_place for r in races.records_outcomes(tiny).where("race_id = 10").collect()}
    assert flags[2] is False


def test_scratched_starters_belong_to_the_field(tiny):
    got = races.records_context(tiny).where("race_id = 10").collect()
    assert {(r.field_size, r.median_jockey_weight_kg) for r in got} == {(3, 60.0)}
    out = assembly.race_features(tiny, DAY).where("race_id = 10").collect()
    # The horse that is entered twice keeps two rows, each with its own weight.
    assert sorted((r.start_order, r.field_size, r.weight_diff) for r in out) == [(1, 3, -10.0), (3, 3, 41.0)]
    assert {r.country_PL for r in out} == {True}
    assert all(r.jockey_win_pct is None for r in out if r.jockey_id is None)


def test_windows_see_every_start_once(tiny):
    out = first_version.race_features_v1(tiny)
    got = {(r.race_id, r.finish_place): r for r in out.collect()}
    assert len(got) == out.count() == 4
    assert got[(11, 1)].rest_days is None and got[(11, 1)].rest_bucket == "other"
    assert (got[(10, 1)].rest_days, got[(10, 1)].won_last_race, got[(10, 1)].win_rate_last_2) == (1, 1, 1.0)
    assert (got[(10, 2)].rest_days, got[(12, 1)].won_last_race, got[(12, 1)].win_rate_last_2) == (0, 0, 0.5)
    assert (got[(10, 1)].horse_race_count, got[(10, 1)].horse_win_pct) == (4, 0.25)
    assert got[(10, 1)].temp_bucket == "temp_unknown" and got[(10, 2)].jockey_weight_kg is None
    assert (got[(10, 2)].jockey_race_count, got[(10, 2)].jockey_win_pct) == (0, None)
    # Whole-history rates include the current and later races.
    assert (got[(11, 1)].career_race_count, got[(11, 1)].win_pct_delta_rain) == (4, 0.5 - 1.0)
    assert got[(11, 1)].prize_amount_bucket == "p_1_1200"
    assert (got[(11, 1)].father_race_count, got[(11, 1)].breeder_race_count) == (4, 5)


def test_breeder_counts_progeny_with_a_career(tiny):
    got = people.breeders(tiny, DAY).collect()
    assert [(r.breeder_id, r.breeder_progeny_count, r.breeder_progeny_race_count_last_1yr) for r in got] == [(5, 1, 4)]


def test_two_versions_of_a_race_become_one(spark, tiny):
    staged = tiny.races.where("race_id = 10").drop("created_date", "last_updated_date")
    both = staged.unionByName(staged.withColumn("weather", F.lit("mgła")))
    merged = ingest.upsert(tiny.races.limit(0), both, "races", F.current_timestamp())
    assert merged.count() == 1


def test_empty_tables_give_empty_features(spark, tiny):
    empty = replace(tiny, race_records=tiny.race_records.limit(0), horse_careers=tiny.horse_careers.limit(0))
    assert rows(assembly.race_features(empty, DAY)) == []
    assert rows(first_version.race_features_v1(empty)) == []
