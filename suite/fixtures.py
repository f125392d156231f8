"""The racing schema derived from the given tables.

Every view is one SQL text that both engines run unchanged, so the engine under
test and the reference SQL start from the same rows.
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paddock.schema import RacingTables

AS_OF = dt.date(2001, 6, 30)

RACES = """
SELECT o_orderkey AS race_id, o_orderdate AS race_date,
       CAST(800 + (o_orderkey * 37) % 2800 AS BIGINT) AS track_distance_m,
       CAST(o_custkey % 70 - 10 AS DOUBLE) + CAST(o_orderkey % 2 AS DOUBLE) * CAST(0.5 AS DOUBLE) AS temperature_c,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'deszcz' WHEN '2-HIGH' THEN 'pochmurno'
            WHEN '3-MEDIUM' THEN 'upalnie' WHEN '5-LOW' THEN 'pogodnie' ELSE NULL END AS weather,
       CASE o_orderkey % 9 WHEN 0 THEN 'lekko elastyczny' WHEN 1 THEN 'elastyczny' WHEN 2 THEN 'mocno elastyczny'
            WHEN 3 THEN 'lekki' WHEN 4 THEN 'dobry' WHEN 5 THEN 'miękki' WHEN 6 THEN 'ciężki'
            WHEN 7 THEN 'twardy' ELSE NULL END AS track_type,
       CASE o_orderkey % 4 WHEN 0 THEN 'GROUP_I' WHEN 1 THEN 'GROUP_II' WHEN 2 THEN 'TRIAL' ELSE 'HURDLE' END AS race_group,
       CASE o_orderkey % 5 WHEN 0 THEN 'w walce' WHEN 1 THEN 'pewnie' WHEN 2 THEN 'dowolnie' WHEN 3 THEN 'inne' ELSE NULL END AS race_style,
       CASE o_custkey % 3 WHEN 0 THEN 'THOROUGHBRED' WHEN 1 THEN 'ARABIAN' ELSE NULL END AS category_breed,
       CASE o_custkey % 4 WHEN 0 THEN 'POL' WHEN 1 THEN 'PL' WHEN 2 THEN 'CZE' ELSE NULL END AS country_code,
       CASE o_orderstatus WHEN 'F' THEN 'Warsaw' WHEN 'O' THEN 'Sopot' ELSE NULL END AS city_name,
       CAST(o_custkey % 12 AS BIGINT) AS category_id,
       CASE o_orderstatus WHEN 'P' THEN NULL ELSE o_orderstatus END AS subtype,
       CAST(o_orderkey % 13 AS BIGINT) AS race_number,
       CONCAT('ZWC ', CAST(CAST(FLOOR(o_totalprice) AS BIGINT) % 97 AS VARCHAR(10)), ',5 PDK ', CAST(o_custkey % 31 AS VARCHAR(10)), ',10') AS payments
FROM orders
"""

RACE_RECORDS = """
SELECT l_orderkey AS race_id, l_partkey AS horse_id, l_suppkey AS jockey_id, l_suppkey % 25 AS trainer_id,
       CASE WHEN l_quantity = 50 THEN NULL ELSE CAST(l_quantity AS BIGINT) END AS start_order,
       CASE WHEN l_linenumber = 7 AND l_linestatus = 'F' THEN NULL ELSE CAST(l_linenumber AS BIGINT) END AS finish_place,
       l_quantity + 52 AS jockey_weight_kg, l_extendedprice AS prize_amount,
       CAST(l_linenumber AS BIGINT) * 10000000000 + CAST(ROUND(l_extendedprice * 100) AS BIGINT) AS race_record_id
FROM lineitem
"""

HORSES = """
SELECT p_partkey AS horse_id, p_name AS horse_name, CAST(1975 + p_size AS BIGINT) AS birth_year,
       CASE p_type WHEN 'PROMO' THEN 'STALLION' WHEN 'LARGE' THEN 'MARE' WHEN 'SMALL' THEN 'GELDING' ELSE NULL END AS horse_sex,
       CASE p_partkey % 3 WHEN 0 THEN 'THOROUGHBRED' WHEN 1 THEN 'ARABIAN' ELSE NULL END AS breed,
       CASE p_size % 7 WHEN 0 THEN 'gniada' WHEN 1 THEN 'siwa' WHEN 2 THEN 'kasztanowata' WHEN 3 THEN 'ciemnogniada'
            WHEN 4 THEN 'skarogniada' WHEN 5 THEN 'kara' ELSE NULL END AS color_name_pl,
       CASE WHEN p_size > 45 THEN NULL ELSE p_partkey % 40 END AS father_id,
       CASE WHEN p_size < 5 THEN NULL ELSE 40 + p_partkey % 60 END AS mother_id,
       p_partkey % 25 AS trainer_id,
       CASE WHEN p_size = 1 THEN NULL ELSE CAST(REPLACE(p_brand, 'Brand#', '') AS BIGINT) END AS breeder_id
FROM part
"""

HORSE_CAREERS = """
SELECT l_partkey AS horse_id, CAST(EXTRACT(YEAR FROM o_orderdate) AS BIGINT) AS race_year, l_returnflag AS race_type,
       COUNT(*) AS race_count, CAST(SUM(CASE WHEN l_linenumber = 1 THEN 1 ELSE 0 END) AS BIGINT) AS race_won_count,
       CASE WHEN l_partkey % 11 = 0 THEN '27800,175'
            ELSE CAST(CAST(SUM(CAST(ROUND(l_extendedprice) AS BIGINT)) AS BIGINT) AS VARCHAR(20)) END AS prize_amounts
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
GROUP BY l_partkey, EXTRACT(YEAR FROM o_orderdate), l_returnflag
"""

JOCKEYS = """
SELECT s_suppkey AS jockey_id, CONCAT('J', CAST(s_nationkey AS VARCHAR(10))) AS first_name, s_name AS last_name,
       CAST(s_nationkey AS VARCHAR(10)) AS licence_country
FROM supplier
"""

TRAINERS = """
SELECT s_suppkey % 25 AS trainer_id, MIN(CONCAT('T', CAST(s_nationkey AS VARCHAR(10)))) AS first_name,
       MIN(s_name) AS last_name, MIN(CAST(s_nationkey AS VARCHAR(10))) AS licence_country
FROM supplier GROUP BY s_suppkey % 25
"""

BREEDERS = """
SELECT DISTINCT CAST(REPLACE(p_brand, 'Brand#', '') AS BIGINT) AS breeder_id, p_brand AS name,
       CAST(NULL AS VARCHAR(10)) AS city
FROM part
"""

LABELS = """
SELECT CAST(p_partkey AS VARCHAR(20)) AS horse_id,
       CASE WHEN p_size % 2 = 0 THEN DATE '2001-06-30' ELSE DATE '2001-06-01' END AS snapshot_date,
       CASE WHEN p_size = 9 THEN NULL ELSE p_retailprice END AS rating_score
FROM part
"""

VIEWS = {
    "races": RACES,
    "race_records": RACE_RECORDS,
    "horses": HORSES,
    "horse_careers": HORSE_CAREERS,
    "jockeys": JOCKEYS,
    "trainers": TRAINERS,
    "breeders": BREEDERS,
    "horse_rating_labels": LABELS,
}
GIVEN = """region nation customer supplier part orders lineitem events documents embeddings pages
    benchmark labels conversations""".split()


def given(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One derived view as a lazy DataFrame."""
    return over(spark, sf_dir, VIEWS[name])


def over(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """Run SQL text over the given tables it names."""
    for name in GIVEN:
        if re.search(rf"\b{name}\b", sql):
            given(spark, sf_dir, name).createOrReplaceTempView(name)
    return spark.sql(sql)


def racing(spark: SparkSession, sf_dir: str) -> RacingTables:
    names = "races race_records horses horse_careers jockeys trainers breeders".split()
    return RacingTables(**{n: view(spark, sf_dir, n) for n in names})


def with_views(sql: str, *names: str) -> str:
    """Reference SQL with the derived views it names in front."""
    ctes = ",\n".join(f"{n} AS ({VIEWS[n].strip()})" for n in names)
    head, rest = ("WITH ", sql.strip())
    if rest.upper().startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {ctes},\n{rest[15:]}"
    if rest.upper().startswith("WITH "):
        return f"{head}{ctes},\n{rest[5:]}"
    return f"{head}{ctes}\n{rest}"


def text_of(df: DataFrame, *columns: str) -> DataFrame:
    """Dates and time stamps as text, so both engines print them alike."""
    return df.withColumns({c: F.col(c).cast("string") for c in columns})
