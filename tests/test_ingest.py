"""Quirks of cleaning, normalization, merging and file handling."""

import datetime as dt
import json
import os

import pytest
from conftest import rows
from pyspark.sql import functions as F

from paddock import flow, schema
from paddock.functions import scalars as S
from paddock.operators.merge import merge_counts, merge_touch_or_insert
from paddock.plans import day_counters, ingest, normalize, people
from paddock.plans.day_counters import DayCounters
from paddock.schema import RacingTables
from paddock.sources import files, ndjson, tables
from paddock.streaming.files import ingest_available, ingest_stream


def values(spark, expression, texts, kind="string"):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("x"))).collect()]


def test_prize_text(spark):
    texts = ["27800 PLN", "27 800 PLN", "12,5 Kč", "x", "", None, " 3,5,7 eur", "100"]
    assert values(spark, S.prize_value, texts)[:4] == [27800.0, 27.0, 12.5, 0.0]
    assert values(spark, S.prize_currency, texts)[:3] == ["pln", "800", "kč"]
    assert values(spark, S.prize_in_pln, texts) == [27800.0, 27.0, 2.25, 0.0, 0.0, 0.0, 14.875, 100.0]
    compat = lambda c: S.prize_in_pln(c, compat=True)
    assert values(spark, compat, ["10 Kč", "10 AED", "10 Ft"]) == [10.0, 11.6, 10.0]


def test_bins_at_their_edges(spark):
    temps = [22.5, -51.0, 51.0, 30.0, 6.0, 14.5, None]
    assert values(spark, S.temp_bucket, temps, "double") == [
        "temp_unknown", "temp_le_6", "temp_gt_30", "temp_23_30", "temp_le_6", "temp_unknown", "temp_unknown",
    ]
    assert values(spark, lambda c: S.clamp_to_null(c, -50, 50), temps[:3], "double") == [22.5, None, None]
    metres = [1099, 1100, 1699, 1700, 2300, 2900, 2901, None]
    assert values(spark, S.distance_bucket, metres, "bigint") == [
        "very_short", "short", "short", "medium", "long", "long", "very_long", "unknown",
    ]
    days = [0, 6, 7, 59, 60, 365, 366, None]
    assert values(spark, S.rest_bucket, days, "bigint") == [
        "rest_0_7", "rest_0_7", "rest_7_14", "rest_28_60", "rest_60_180", "rest_180_365", "other", "other",
    ]
    assert values(spark, S.prize_bucket, [0.0, 1.0, 1200.5, 16000.0, 16001.0], "double") == [
        "p_0", "p_1_1200", "p_1201_1800", "p_12001_16000", "p_16000+",
    ]


def test_text_functions(spark):
    words = ["Żółć Kamińska", "é", None, "á"]
    assert values(spark, S.unaccent, words) == ["Zołc Kaminska", "e", "", "a"]
    assert values(spark, lambda c: S.unaccent(c, lenient=True), words[:1]) == ["Zolc Kaminska"]
    assert values(spark, lambda c: S.payout(c, "ZWC"), ["ZWC 12,50 PDK 3,1", "PDK 3,1", None]) == [12.5, None, None]
    names = [" Grzybowski K.", "Marat Uulu B."]
    assert values(spark, lambda c: S.name_key(c, strip_initial=True), names) == ["grzybowski", "marat uulu"]
    tag = lambda c: S.file_tag(c, F.lit("none"))
    assert values(spark, tag, ["CLEANED_MASTERFILE_HORSEDATA_20250803T101530Z.ndjson", "CLEANED_x.ndjson"]) == [
        "20250803T101530Z", "none",
    ]


def test_short_probability_arrays(spark):
    df = spark.sql("SELECT array(named_struct('label', '2', 'prob', 0.3D), named_struct('label', '1', 'prob', 0.1D), named_struct('label', '9', 'prob', 0.6D)) AS p")
    got = df.select(S.normalize_probs(F.col("p")).alias("p")).select("p", S.prob_at(F.col("p"), 3)).first()
    assert [(x.label, round(x.prob, 9)) for x in got[0]] == [(1, 0.25), (2, 0.75)]
    assert got[1] is None


BAD_LINES = ["", "{", '{"a":1} x', '{"a":1}{"a":2}', "1],[2", '1},{"r":2', "a"]


def test_malformed_lines_are_dropped(spark):
    good = ['{"b":1,"a":2}', '{"a":2,"b":1}', "3", '{"a":"é\\n"}', "[1,2]"]
    lines = spark.createDataFrame([(x,) for x in [*BAD_LINES, *good]], "line string")
    parsed = lines.withColumn(ndjson.RECORD, ndjson.parse_line(F.col("line")))
    assert rows(ndjson.clean_dedupe(parsed)) == rows(
        spark.createDataFrame([('{"a":2,"b":1}',), ("3",), ('{"a":"é\\n"}',), ("[1,2]",)], "record string")
    )
    counts = ndjson.clean_stats(ndjson.record_counts(parsed)).first()
    assert (counts.initial_count, counts.removed_count, counts.final_count) == (12, 8, 4)
    assert ndjson.clean_dedupe(parsed, key="$.a").count() == 3


def test_bad_record_budget(spark, tmp_path):
    lines = ['{"jockey_id": 1}', '{"jockey_id": "x"}', "", "{", '{"jockey_id": 2}']
    (tmp_path / "j.ndjson").write_text("\n".join(lines))
    load = lambda n: ndjson.load_with_bad_budget(spark, str(tmp_path), schema.STAGED_JOCKEY, n)
    assert sorted(r.jockey_id for r in load(2).collect()) == [1, 2]
    with pytest.raises(ndjson.BadRecordBudgetExceeded):
        load(1)
    # The budget holds for each file, not for the batch.
    (tmp_path / "k.ndjson").write_text("{\n{")
    assert load(2).count() == 2


def test_career_fold_inside_a_row(spark):
    def row(year=None, kind=None, age=None, count=None, prize=None):
        return (year, kind, age, count, None, None, prize)

    career = [
        row(prize="5 PLN"),
        row(2020, "", 3, None),
        row(prize="10 PLN"),
        row(2021, "Sulki", 0, 4),
        row(2020, None, 9, 9),
        row(prize="1 EUR"),
    ]
    df = spark.createDataFrame(
        [(1, career), (2, []), (3, None)], f"id bigint, c {schema.RAW_CAREER.simpleString()}"
    )
    got = {r.id: r.s for r in df.select("id", normalize.normalize_career(F.col("c")).alias("s")).collect()}
    assert [(s.race_year, s.race_type, s.horse_age, s.race_count, s.prize_amounts) for s in got[1]] == [
        (2020, None, 3, 0, 14.25),
        (2021, "Sulki", None, 4, 0.0),
    ]
    assert got[2] == [] and got[3] == []


def now():
    return F.lit("2025-01-01 00:00:00").cast("timestamp")


def test_merge_twice_adds_nothing(spark):
    target = spark.createDataFrame([], schema.HORSE_CAREERS)
    source = spark.createDataFrame(
        [(1, 2020, None, 5), (1, 2020, None, 3), (1, 2021, "x", 1)],
        "horse_id bigint, race_year bigint, race_type string, race_count bigint",
    )
    keys = ingest.KEYS["horse_careers"]
    once = merge_touch_or_insert(target, source, keys, now())
    twice = merge_touch_or_insert(once, source, keys, F.lit("2026-01-01").cast("timestamp"))
    assert once.count() == twice.count() == 2
    assert {r.race_count for r in twice.collect()} == {3, 1}
    assert {r.created_date.year for r in twice.collect()} == {2025}
    assert {r.last_updated_date.year for r in twice.collect()} == {2026}
    counts = merge_counts(once, source, keys).first()
    assert (counts.staged, counts.updated, counts.inserted) == (2, 2, 0)


def test_record_key_of_scratched_starters(spark):
    df = spark.createDataFrame([(1, 2, None), (1, 3, None), (1, 2, 4)], "h bigint, r bigint, s bigint")
    keys = [x[0] for x in df.select(S.record_key(F.col("h"), F.col("r"), F.col("s"))).collect()]
    assert len(set(keys)) == 3


def test_watermark_never_moves_back(spark):
    meta = spark.createDataFrame([("a/", dt.datetime(2025, 1, 5))], schema.INGESTION_METADATA)
    seen = spark.createDataFrame([("a/", dt.datetime(2025, 1, 2)), ("b/", dt.datetime(2025, 1, 1))], "prefix string, created timestamp")
    got = {r.prefix: r.last_processed_time.day for r in ingest.advance_watermark(meta, seen).collect()}
    assert got == {"a/": 5, "b/": 1}


def test_versioned_table(spark, tmp_path):
    table = tables.VersionedTable(spark, str(tmp_path / "t"), schema.BREEDERS)
    assert table.read().count() == 0
    table.write(spark.createDataFrame([(1, "x", "y")], "breeder_id bigint, name string, city string"))
    table.write(table.read().unionByName(table.read()))
    assert table.version() == 2 and table.read().count() == 2
    os.makedirs(tmp_path / "t" / "v=3")  # an unfinished write does not count
    assert table.version() == 2


def horse_doc(horse, race, order):
    entry = {"race_id": race, "start_order": order, "finish_place": "1", "prize_amount": "237.5",
             "race_date": 1754179200000, "jockey_id": 5, "trainer_id": 6, "prize_currency": "PLN"}
    career = {"race_year": 2025, "race_count": 1, "race_won_count": 1, "prize_amounts": 10.0}
    return json.dumps({"horse_id": horse, "horse_name": f"h{horse}", "career": [career], "races": [entry]})


def test_feed_extends_counters(spark, tmp_path):
    """Counters follow a feed, and a repeated or failed run does not count twice."""
    landing, lake = tmp_path / "landing", tmp_path / "lake"
    shards = landing / "horse_data"
    shards.mkdir(parents=True)
    stored = DayCounters(spark, f"{tmp_path}/counters")
    for i, docs in enumerate([[(1, 10, 1), (2, 10, 2)], [(2, 10, 2), (3, 11, 1)]]):
        (shards / f"shard_{i}.ndjson").write_text("\n".join(horse_doc(*d) for d in docs) + "\n")
        flow.run_feed(spark, str(landing), str(lake), "horse_data/", f"2025-08-0{i + 3}T10_00_00_000Z", stored)
        flow.run_feed(spark, str(landing), str(lake), "horse_data/", f"2025-08-0{i + 3}T11_00_00_000Z", stored)
        known = RacingTables.load(spark, str(lake))
        for day in ("2025-08-02", "2025-08-03", "2025-09-01"):
            assert rows(day_counters.jockeys(stored, day)) == rows(people.jockeys(known, day))
    assert [r["jockey_total_starts"] for r in day_counters.jockeys(stored, "2025-08-03").collect()] == [3]


def test_shards_to_tables(spark, tmp_path):
    """Merge, clean and ingest one feed, then a second batch with an overlap."""
    landing, lake = tmp_path / "landing", tmp_path / "lake"
    shards = landing / "horse_data"
    shards.mkdir(parents=True)
    (shards / "shard_1.ndjson").write_text(horse_doc(1, 10, 1) + "\n" + horse_doc(2, 10, 2) + "\n{\n")
    (shards / "shard_2.ndjson").write_text(horse_doc(2, 10, 2) + "\n")
    (shards / "notes.txt").write_text("not a shard\n")
    first = flow.run_feed(spark, str(landing), str(lake), "horse_data/", "2025-08-03T10_00_00_000Z")
    assert first["merged"] == 2
    assert (first["clean"]["initial_count"], first["clean"]["final_count"]) == (4, 2)
    assert first["ingest"]["horses"] == {"staged": 2, "updated": 0, "inserted": 2}
    assert first["ingest"]["races"]["inserted"] == 1
    again = ingest.ingest_folder(spark, str(landing), str(lake), "horse_data/")
    assert again == {"processed_files": 0}
    for name in ("shard_1.ndjson", "shard_2.ndjson"):
        assert (shards / name).exists()
    records = tables.base_table(spark, str(lake), "race_records").read()
    assert {r.prize_amount for r in records.collect()} == {238.0}
    assert records.count() == 2
    with pytest.raises(ValueError):
        ingest.ingest_folder(spark, str(landing), str(lake), "goat_data/")


def test_stream_picks_every_file_up_once(spark, tmp_path):
    landing, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    os.makedirs(landing)
    seen = []

    def sink(batch, _):
        seen.append(batch.count())

    for n, lines in enumerate((["1", "2"], ["3"])):
        with open(f"{landing}/CLEANED_{n}.ndjson", "w") as f:
            f.write("\n".join(f'{{"jockey_id": {i}}}' for i in lines))
        ingest_available(spark, landing, schema.STAGED_JOCKEY, state, sink)
    ingest_available(spark, landing, schema.STAGED_JOCKEY, state, sink)
    assert seen == [2, 1]


def test_backlog_in_pages(spark, tmp_path):
    """More shards and cleaned files than a page: all of them are taken, each once."""
    landing, lake = tmp_path / "landing", str(tmp_path / "lake")
    folder = landing / "jockey_data"
    folder.mkdir(parents=True)
    for i in range(5):
        (folder / f"shard_{i}.ndjson").write_text(f'{{"jockey_id": {i}}}\n{{"jockey_id": 9}}\n')
    for i in range(3):
        (folder / f"CLEANED_{i}.ndjson").write_text(f'{{"jockey_id": {20 + i}}}\n')
    (folder / "CLEANED_0.5.ndjson").mkdir()
    (folder / "CLEANED_0.5.ndjson" / "part-0").write_text('{"jockey_id": 77}\n')  # not committed
    out = flow.run_feed(spark, str(landing), lake, "jockey_data/", "2025-08-03T10_00_00_000Z", page=2)
    assert out["merged"] == 5 and out["ingest"]["processed_files"] == 6
    assert sorted(r.jockey_id for r in tables.base_table(spark, lake, "jockeys").read().collect()) == [0, 1, 2, 3, 4, 9, 20, 21, 22]
    assert out["ingest"]["jockeys"]["inserted"] == 9
    again = flow.run_feed(spark, str(landing), lake, "jockey_data/", "2025-08-03T10_00_00_000Z", page=2)
    assert again["ingest"] == {"processed_files": 0} and again["clean"] == {}


def test_stream_into_tables_once(spark, tmp_path):
    """Batches of a stream are merged once each: handed over again, whole or when the
    writer died half-way, they leave counts, stamps and counters as after one."""
    landing, lake, state = tmp_path / "landing", str(tmp_path / "lake"), str(tmp_path / "state")
    (landing / "horse_data").mkdir(parents=True)
    stored = DayCounters(spark, f"{tmp_path}/counters")
    for i, docs in enumerate([[(1, 10, 1), (2, 10, 2)], [(2, 10, 2), (3, 11, 1)]]):
        (landing / "horse_data" / f"CLEANED_{i}.ndjson").write_text("\n".join(horse_doc(*d) for d in docs) + "\n{broken\n")
        counts = ingest_stream(spark, str(landing), lake, "horse_data/", state, counters=stored)
        assert [c["horses"]["inserted"] for c in counts] == [2 - i]
    assert ingest_stream(spark, str(landing), lake, "horse_data/", state, counters=stored) == []
    names = ("horses", "horse_careers", "races", "race_records")
    read = lambda: {n: rows(tables.base_table(spark, lake, n).read()) for n in names}
    before = read()
    # The checkpoint is lost: all files come again, in one batch numbered 0.
    staged = spark.read.schema(schema.STAGED_HORSE).json(f"{landing}/horse_data/CLEANED_1.ndjson").where("horse_id IS NOT NULL")
    again = ingest.merge_batch(spark, lake, "horse_data/", staged, 1, stored)
    assert all(c == {"staged": 0, "updated": 0, "inserted": 0} for c in again.values()) and read() == before
    known = RacingTables.load(spark, lake)
    assert rows(day_counters.jockeys(stored, "2025-09-01")) == rows(people.jockeys(known, "2025-09-01"))


def test_batch_of_a_dead_writer(spark, tmp_path):
    shape = schema.BREEDERS
    batch = lambda *ids: spark.createDataFrame([(i, "n", "c") for i in ids], "breeder_id long, name string, city string")
    table = tables.MergedTable(spark, str(tmp_path / "t"), shape, ["breeder_id"])
    assert table.merge(batch(1, 2), F.current_timestamp(), ("f", 0))["inserted"] == 2
    # One dies before its merge is committed, another right after.
    (tmp_path / "t" / "_claim=2").touch()
    (tmp_path / "t" / "_batch=f=1=2").touch()
    (tmp_path / "t" / "m=2").mkdir()
    assert table.merge(batch(2, 3), F.current_timestamp(), ("f", 1)) == {"staged": 2, "updated": 1, "inserted": 1}
    os.remove(tmp_path / "t" / "_done=f=1")
    before = rows(table.read())
    table.compact(keep=1)
    for number in (1, 0):
        assert table.merge(batch(2, 3), F.current_timestamp(), ("f", number))["staged"] == 0
    assert rows(table.read()) == before and table.merge(batch(4), F.current_timestamp(), ("g", 0))["inserted"] == 1


def test_stream_stops_over_budget(spark, tmp_path):
    folder = tmp_path / "landing" / "jockey_data"
    folder.mkdir(parents=True)
    (folder / "CLEANED_1.ndjson").write_text('{"jockey_id": 1}\n{broken\n')
    with pytest.raises(Exception, match="malformed"):
        ingest_stream(spark, str(tmp_path / "landing"), str(tmp_path / "lake"), "jockey_data/", str(tmp_path / "state"))
    assert tables.base_table(spark, str(tmp_path / "lake"), "jockeys").read().count() == 0


def test_replacing_one_date(spark, tmp_path):
    path = str(tmp_path / "p")
    df = lambda *days: spark.createDataFrame([(f"r{n}", dt.datetime(2025, 1, d)) for n, d in days], schema.INGESTION_METADATA)
    tables.write_by_date(df((1, 1), (2, 1), (3, 2), (4, 3)), path, "last_processed_time")
    files_of = lambda: {str(f): f.stat().st_mtime_ns for f in (tmp_path / "p").rglob("*.parquet")}
    before = files_of()
    tables.write_by_date(df((9, 2)), path, "last_processed_time", mode="replace")
    after = files_of()
    assert {f for f in before if "2025-01-02" not in f} == {f for f in after if f in before}
    assert all(before[f] == after[f] for f in after if f in before)
    assert sorted(r.prefix for r in tables.read_by_date(spark, path, schema.INGESTION_METADATA).collect()) == ["r1", "r2", "r4", "r9"]


def test_one_job_writes_and_counts(spark, tmp_path):
    """Cleaning and merging count while they write: no job reads the result back."""
    master = tmp_path / "m.ndjson"
    master.write_text('{"a":1}\n{"a":1}\n{"a":2}\n{\n')
    jobs = lambda: len(spark.sparkContext.statusTracker().getJobIdsForGroup("once"))
    spark.sparkContext.setJobGroup("once", "counted")
    try:
        assert ingest.clean_folder(spark, str(master), f"{tmp_path}/out") == {"initial_count": 4, "removed_count": 2, "final_count": 2}
        done = jobs()
        spark.read.text(f"{tmp_path}/out").count()
        assert done <= 2 < done + jobs()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_partitioned_write_prunes(spark, tmp_path):
    df = spark.createDataFrame([("a", dt.datetime(2025, 1, d)) for d in (1, 1, 2)], schema.INGESTION_METADATA)
    tables.write_by_date(df, str(tmp_path / "p"), "last_processed_time")
    back = tables.read_by_date(spark, str(tmp_path / "p"), schema.INGESTION_METADATA)
    one = back.where(F.col("dt") == dt.date(2025, 1, 1))
    assert one.count() == 2
    assert "PartitionFilters: [isnotnull(dt" in one._jdf.queryExecution().executedPlan().toString()


def test_master_name():
    assert files.master_name("horse_data/", "X") == "horse_data/MASTERFILE_HORSEDATA_X.ndjson"


def test_lines_the_variant_parser_refuses_are_kept(spark):
    lines = ['{"a":1,"a":2} ', '{"a":1}', "{'a':1}", "1] [2", "[1", "", '{"a":"it\'s"}', '{"b":"' + "x" * 20_000_000 + '"}', '{"a":1,"a":']
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, line string")
    got = {r.i: r.record for r in df.select("i", ndjson.parse_line(F.col("line")).alias("record")).collect()}
    assert got[0] == '{"a":1,"a":2}' and got[1] == '{"a":1}' and got[6] == lines[6] and got[7] == lines[7]
    assert [got[i] for i in (2, 3, 4, 5, 8)] == [None] * 5


def test_a_feed_may_be_repeated(spark, tmp_path):
    landing, lake = tmp_path / "landing", tmp_path / "lake"
    (landing / "jockey_data").mkdir(parents=True)
    (landing / "jockey_data" / "shard_1.ndjson").write_text('{"jockey_id": 1}\n{"jockey_id": 2}\n')
    run = lambda: flow.run_feed(spark, str(landing), str(lake), "jockey_data/", "2025-08-03T10_00_00_000Z")
    # What a job that died while cleaning leaves behind.
    (landing / "jockey_data" / "CLEANED_MASTERFILE_JOCKEYDATA_2025-08-03T10_00_00_000Z.ndjson").mkdir()
    assert run()["clean"]["final_count"] == 2
    assert run()["ingest"] == {"processed_files": 0}
    assert tables.base_table(spark, str(lake), "jockeys").read().count() == 2


def test_a_feed_takes_every_shard_once(spark, tmp_path):
    landing, lake = tmp_path / "landing", tmp_path / "lake"
    folder = landing / "jockey_data"
    folder.mkdir(parents=True)
    run = lambda stamp: flow.run_feed(spark, str(landing), str(lake), "jockey_data/", stamp)
    read = lambda: {r.jockey_id: r for r in tables.base_table(spark, str(lake), "jockeys").read().collect()}
    (folder / "shard_1.ndjson").write_text('{"jockey_id": 1}\n{"jockey_id": 2}\n')
    assert run("A")["merged"] == 2 - 1
    first = read()
    (folder / "shard_2.ndjson").write_text('{"jockey_id": 2}\n{"jockey_id": 3}\n')
    # A cleaned folder that is still being written waits.
    late = folder / "CLEANED_late.ndjson"
    late.mkdir()
    (late / "part-0.txt").write_text('{"jockey_id": 4}\n')
    second = run("B")
    assert second["merged"] == 1 and second["clean"]["initial_count"] == 2
    assert second["ingest"]["jockeys"] == {"staged": 2, "updated": 1, "inserted": 1}
    got = read()
    assert got[1] == first[1] and got[2].last_updated_date > first[2].last_updated_date
    assert got[2].created_date == first[2].created_date and set(got) == {1, 2, 3}
    # It is taken once it is finished, although its file is older than the last run.
    (late / "_SUCCESS").write_text("")
    third = run("C")
    assert third["merged"] == 0 and third["ingest"]["jockeys"]["inserted"] == 1
    assert run("C")["ingest"] == {"processed_files": 0}


def test_a_feed_goes_on_after_a_death(spark, tmp_path):
    landing, lake = tmp_path / "landing", tmp_path / "lake"
    (landing / "jockey_data").mkdir(parents=True)
    (landing / "jockey_data" / "shard_1.ndjson").write_text('{"jockey_id": 1}\n')
    master = files.master_name("jockey_data/", "A")
    ledger = f"{lake}/merged_shards/jockey_data"
    merge = lambda m: files.merge_shards(spark, f"{landing}/jockey_data/", f"{landing}/{m}", ledger=ledger)
    assert merge(master) == 1
    # Died before the note was marked: the finished master still counts, with any stamp.
    os.remove(f"{ledger}/{master.split('/')[1]}/_MERGED")
    assert merge(files.master_name("jockey_data/", "B")) == 0
    # Died before the master was finished: its shards go to the next one.
    (landing / "jockey_data" / "shard_2.ndjson").write_text('{"jockey_id": 2}\n')
    third = files.master_name("jockey_data/", "C")
    assert merge(third) == 1
    os.remove(f"{landing}/{third}/_SUCCESS")
    os.remove(f"{ledger}/{third.split('/')[1]}/_MERGED")
    out = flow.run_feed(spark, str(landing), str(lake), "jockey_data/", "D")
    assert out["merged"] == 1 and out["clean"]["final_count"] == 2
    assert out["ingest"]["jockeys"] == {"staged": 2, "updated": 0, "inserted": 2}


def test_merges_are_stored_beside_the_table(spark, tmp_path):
    table = tables.MergedTable(spark, str(tmp_path / "t"), schema.HORSE_CAREERS, schema.KEYS["horse_careers"])
    shape = "horse_id bigint, race_year bigint, race_type string, race_count bigint"
    at = lambda year: F.lit(f"{year}-01-01").cast("timestamp")
    whole = spark.range(50_000).select(F.col("id").alias("horse_id"), F.lit(2020).cast("long").alias("race_year"),
                                       F.lit(None).cast("string").alias("race_type"), F.lit(1).cast("long").alias("race_count"))
    assert table.merge(whole, at(2021)) == {"staged": 50_000, "updated": 0, "inserted": 50_000}
    assert table.compact() == table.version()
    batch = spark.createDataFrame([(7, 2020, None, 9), (7, 2020, "x", 3), (7, 2020, "x", 2)], shape)
    assert table.merge(batch, at(2022)) == {"staged": 2, "updated": 1, "inserted": 1}
    assert table.merge(batch, at(2023)) == {"staged": 2, "updated": 2, "inserted": 0}
    size = lambda kind: sum(f.stat().st_size for f in (tmp_path / "t").glob(f"{kind}=*/*.parquet") if int(f.parent.name[2:]) >= table.version())
    assert size("m") < size("v") / 2
    old = table.read()
    assert old.count() == 50_001
    seven = {r.race_type: r for r in old.where("horse_id = 7").collect()}
    assert (seven[None].race_count, seven[None].created_date.year, seven[None].last_updated_date.year) == (1, 2021, 2023)
    assert (seven["x"].race_count, seven["x"].created_date.year, seven["x"].last_updated_date.year) == (2, 2022, 2023)
    before = rows(old)
    table.compact(keep=1)
    assert table.merges() is None and rows(table.read()) == before
    assert len(list((tmp_path / "t").glob("v=*"))) == 1 and not list((tmp_path / "t").glob("m=*"))
    # Another writer's number is never taken.
    assert table._claim() < table._claim()
