"""Newline-delimited JSON: reading, loading with an error budget, cleaning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paddock.session import materialize

LINE, RECORD, CORRUPT = "line", "record", "_corrupt_record"


class BadRecordBudgetExceeded(RuntimeError):
    pass


def parse_line(line: Column) -> Column:
    """Canonical JSON text of a line, NULL unless it is exactly one JSON value.

    Keys are sorted, so records that differ only in key order compare equal.
    The parser ignores what follows a complete value. So the line is parsed as one of
    two fields of an object, the other of which comes after it and is named by the MD5
    of the line, which the line itself cannot hold: with text that closes the object,
    or adds fields, there are not just these two.

    The parser also refuses values over its size limit and objects with a repeated
    key. Such a line, if well formed, is kept as it stands, without outer blanks.
    """
    end = F.md5(line.cast("binary"))
    wrapped = F.try_parse_json(F.concat(F.lit('{"r":'), line, F.lit(',"'), end, F.lit('":0}')))
    fields = F.try_variant_get(wrapped, "$", "map<string,variant>")
    whole = (F.size(fields) == 2) & F.map_contains_key(fields, end)
    value = F.when(whole, F.to_json(F.try_element_at(fields, F.lit("r"))))
    return F.coalesce(value, F.when(wrapped.isNull() & well_formed(line), F.trim(line)))


# A JSON text without the characters in its strings; the quantifiers never go back.
STRINGS = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'


def well_formed(line: Column) -> Column:
    """Whether a line is exactly one JSON value, whatever its keys or size. These
    functions also take strings in single quotes, which JSON does not have."""
    one = F.json_array_length(F.concat(F.lit("["), line, F.lit("]"))) == 1
    closed = F.size(F.json_object_keys(F.concat(F.lit('{"r":'), line, F.lit("}")))) == 1
    single = F.contains(F.regexp_replace(line, STRINGS, ""), F.lit("'"))
    # The cheap test first: most lines that get here are broken and end there.
    return F.when(F.coalesce(one, F.lit(False)), F.coalesce(closed, F.lit(False)) & ~single).otherwise(F.lit(False))


def read_ndjson(spark: SparkSession, path, name_glob: str = None) -> DataFrame:
    """Lines with their canonical record; bad or blank lines keep a NULL record."""
    reader = spark.read
    if name_glob:
        reader = reader.option("pathGlobFilter", name_glob)
    lines = reader.text(path).withColumnRenamed("value", LINE)
    return lines.withColumn(RECORD, parse_line(F.col(LINE)))


def load_with_bad_budget(
    spark: SparkSession, path, schema: T.StructType, max_bad: int = 0
) -> DataFrame:
    """Typed rows of a JSON load, failing if a file has over ``max_bad`` bad ones.

    The bad rows are dropped, as a warehouse load with an error budget does.
    Part files count towards the directory they belong to. Lines are parsed once:
    the typed rows are stored, and the bad ones are counted while they are. Only if
    all files together have over ``max_bad`` is it looked up where they are.
    """
    marked = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    lines = spark.read.text(path).where(F.trim("value") != "")
    file = F.regexp_replace(F.col("_metadata.file_path"), r"/part-[^/]*$", "").alias("_file")
    parsed = lines.select(F.from_json("value", marked, options).alias("r"), file)
    broken = F.col(CORRUPT).isNotNull().alias("_bad")
    seen = Observation()
    typed = parsed.select("r.*", "_file").select(*schema.names, "_file", broken)
    staged = materialize(typed.observe(seen, F.count_if("_bad").alias("bad")), "staged")
    good = staged.where("NOT _bad").select(*schema.names)
    if (seen.get["bad"] or 0) <= max_bad:
        return good
    bad = staged.where("_bad").groupBy("_file").agg(F.count(F.lit(1)).alias("_n"))
    worst = bad.where(F.col("_n") > max_bad).first()
    if worst is not None:
        raise BadRecordBudgetExceeded(f"{worst._n} malformed records in {worst._file}, {max_bad} allowed")
    return good


def clean_dedupe(lines: DataFrame, key: str = None) -> DataFrame:
    """Distinct well-formed records. ``lines`` has the column ``record``.

    With ``key`` (a JSON path) one record per key is kept instead of one per
    whole record. Both forms combine copies before the shuffle.
    """
    good = lines.where(F.col(RECORD).isNotNull()).select(RECORD)
    if key is None:
        return good.distinct()
    keyed = good.withColumn("_key", F.get_json_object(RECORD, key))
    return keyed.groupBy("_key").agg(F.min(RECORD).alias(RECORD)).select(RECORD)


def record_counts(lines: DataFrame) -> DataFrame:
    """Lines per distinct record; malformed lines share the NULL record."""
    return lines.groupBy(RECORD).agg(F.count(F.lit(1)).alias("n"))


def stats_columns() -> list[Column]:
    """Aggregates over ``record_counts``: lines read, lines removed, records kept."""
    initial, final = F.coalesce(F.sum("n"), F.lit(0)), F.count(RECORD)
    return [initial.alias("initial_count"), (initial - final).alias("removed_count"), final.alias("final_count")]


def clean_stats(counted: DataFrame) -> DataFrame:
    """One row over ``record_counts``, as a query."""
    return counted.agg(*stats_columns())
