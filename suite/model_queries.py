"""Training, evaluation, registry and scoring."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from paddock import schema
from paddock.functions import scalars as S
from paddock.ml import descent, metrics, registry, score, train
from paddock.plans.first_version import race_features_v1
from paddock.plans.horses import horse_features, shared_counts
from paddock.plans.assembly import race_features
from paddock.plans.starts import after, asof_starts
from paddock.session import lookup, materialize, scratch_path
from paddock.sources import tables
from suite.feature_queries import D, HORSE_CTES, HORSE_FEATURES, RR
from suite.first_queries import FORM, STARTERS, rest_sql
from suite.fixtures import AS_OF, given, racing, view
from suite.registry import dbl, query, rnd

# ---- labels and metrics -----------------------------------------------------
@query(
    "label_join",
    f"""WITH {HORSE_CTES}, hf AS ({HORSE_FEATURES})
        SELECT h.horse_id, h.age_years, h.career_starts, h.sire_win_pct, l.rating_score FROM hf h
        JOIN horse_rating_labels l ON l.horse_id = CAST(h.horse_id AS VARCHAR) AND l.snapshot_date = {D}
        WHERE l.rating_score IS NOT NULL""",
    f"{RR} horses horse_careers horse_rating_labels",
)
def _(spark, sf):
    t = racing(spark, sf)
    features = horse_features(t, AS_OF, common=shared_counts(t, AS_OF, stored=("form",)))
    joined = train.join_labels(features, view(spark, sf, "horse_rating_labels"), AS_OF)
    return joined.select("horse_id", "age_years", "career_starts", "sire_win_pct", "rating_score")


def priced(spark, sf):
    """Line prices in thousands against a guess from quantity and discount."""
    price, guess = F.col("l_extendedprice") / 1000, F.col("l_quantity") * (2 - F.col("l_discount"))
    return given(spark, sf, "lineitem").select(price.alias("label"), guess.alias("prediction"))


ERRORS = """mean_absolute_error mean_squared_error mean_squared_log_error median_absolute_error r2_score
    explained_variance"""
PRICED = "p AS (SELECT l_extendedprice / 1000 AS y, l_quantity * (2 - l_discount) AS g FROM lineitem)"
REG_SQL = f"""{rnd("AVG(ABS(y - g))", "mean_absolute_error")}, {rnd("AVG((y - g) * (y - g))", "mean_squared_error")},
    {rnd("AVG(POWER(LN(1 + y) - LN(1 + g), 2))", "mean_squared_log_error")},
    {rnd("quantile_cont(ABS(y - g), 0.5)", "median_absolute_error")},
    {rnd("1 - AVG((y - g) * (y - g)) / VAR_POP(y)", "r2_score")},
    {rnd("1 - VAR_POP(y - g) / VAR_POP(y)", "explained_variance")}"""


@query("reg_metrics", f"WITH {PRICED} SELECT {REG_SQL} FROM p", rounds=ERRORS)
def _(spark, sf):
    return metrics.regression_metrics(priced(spark, sf))


@query(
    "register_run",
    f"""WITH {PRICED}, m AS (SELECT {REG_SQL} FROM p)
        SELECT 'global_horse_rating_v1' AS model_name, epoch_us(TIMESTAMP '2001-06-30 12:00:00') AS at_us,
               'linear_reg' AS model_type, 'rating_score' AS label_column, '{AS_OF}' AS feature_snapshot,
               mean_absolute_error AS mae, {rnd("SQRT((SELECT AVG((y - g) * (y - g)) FROM p))", "rmse")}, r2_score,
               explained_variance AS expl_variance, CAST(NULL AS DOUBLE) AS accuracy FROM m""",
    rounds="mae rmse r2_score expl_variance",
)
def _(spark, sf):
    path = scratch_path(spark, "registry")
    found = metrics.regression_metrics(priced(spark, sf)).withColumns(
        {
            "mae": F.col("mean_absolute_error"),
            "rmse": F.sqrt("mean_squared_error"),
            "expl_variance": F.col("explained_variance"),
        }
    )
    at = F.lit("2001-06-30 12:00:00").cast("timestamp_ntz")
    row = registry.registry_row(
        found, "global_horse_rating_v1", "linear_reg", "rating_score", "all", at, AS_OF, "line prices"
    )
    registry.register_run(row, path)
    back = tables.read_history(spark, path, schema.MODEL_REGISTRY)
    return back.select(
        "model_name",
        F.unix_micros(F.col("run_timestamp").cast("timestamp")).alias("at_us"),
        "model_type",
        "label_column",
        F.col("feature_snapshot").cast("string").alias("feature_snapshot"),
        "mae",
        "rmse",
        "r2_score",
        "expl_variance",
        "accuracy",
    )


GUESSED = """g AS (SELECT l_linenumber AS y, 1 + l_partkey % 8 AS p, (1 + l_suppkey % 9) / 10.0 AS q FROM lineitem)"""


@query(
    "eval_classifier",
    f"""WITH {GUESSED}, classes AS (SELECT y AS k FROM g UNION SELECT p FROM g),
        c AS (SELECT k, (SELECT COUNT(*) FROM g WHERE y = k) AS real, (SELECT COUNT(*) FROM g WHERE p = k) AS said,
                (SELECT COUNT(*) FROM g WHERE y = k AND p = k) AS hit FROM classes),
        s AS (SELECT *, COALESCE(1.0 * hit / NULLIF(said, 0), 0) AS pr, 1.0 * hit / NULLIF(real, 0) AS re FROM c WHERE real > 0)
        SELECT {rnd("(SELECT AVG(CASE WHEN y = p THEN 1.0 ELSE 0 END) FROM g)", "accuracy")},
               {rnd("(SELECT AVG(-LN(q)) FROM g)", "log_loss")}, {rnd("AVG(pr)", "precision")}, {rnd("AVG(re)", "recall")},
               {rnd("AVG(COALESCE(2 * pr * re / NULLIF(pr + re, 0), 0))", "f1_score")} FROM s""",
    rounds="accuracy log_loss precision recall f1_score",
)
def _(spark, sf):
    """Metrics of a guessed class per line, folded to the confusion counts."""
    guess = given(spark, sf, "lineitem").select(
        F.col("l_linenumber").cast("double").alias("label"),
        (1 + F.col("l_partkey") % 8).cast("double").alias("prediction"),
        ((1 + F.col("l_suppkey") % 9) / 10).alias("label_prob"),
    )
    return metrics.classifier_metrics(guess)


@query(
    "roc_auc",
    """WITH e AS (
            SELECT k, CAST((l_partkey * (k + 3) + l_suppkey) % 1000 AS DOUBLE) / 1000 AS p, CASE WHEN l_linenumber = k THEN 1 ELSE 0 END AS y
            FROM lineitem, (SELECT UNNEST(RANGE(0, 8)) AS k)),
        r AS (SELECT k, y, RANK() OVER (PARTITION BY k ORDER BY p) + (COUNT(*) OVER (PARTITION BY k, p) - 1) / 2.0 AS r FROM e),
        a AS (SELECT k, SUM(y) AS n, COUNT(*) - SUM(y) AS m, SUM(CASE WHEN y = 1 THEN r ELSE 0 END) AS s FROM r GROUP BY k)
        SELECT ROUND(AVG((s - n * (n + 1) / 2.0) / (n * m)), 6) AS roc_auc FROM a WHERE n > 0 AND m > 0""",
    rounds="roc_auc",
)
def _(spark, sf):
    """Mean area under the curve of eight classes with many tied scores."""
    probs = [((F.col("l_partkey") * (k + 3) + F.col("l_suppkey")) % 1000).cast("double") / 1000 for k in range(8)]
    scored = given(spark, sf, "lineitem").select(F.col("l_linenumber").cast("double").alias("label"), F.array(*probs).alias("probs"))
    return metrics.auc_table(scored, 8)


# ---- scoring ----------------------------------------------------------------
PROBS = [f"ABS(CAST(embedding[{i}] AS DOUBLE))" for i in range(1, 9)]


@query(
    "normalize_probs",
    f"""WITH k AS (SELECT vec_id, {", ".join(f"{p} AS p{i}" for i, p in enumerate(PROBS, 1))},
            {" + ".join(PROBS)} AS total FROM embeddings)
        SELECT vec_id, CAST(8 AS BIGINT) AS n, {", ".join(f"p{i} / total AS prob_{i}" for i in range(1, 5))},
               ROUND(100 * p1 / total, 2) AS score, CAST(NULL AS DOUBLE) AS prob_9 FROM k""",
)
def _(spark, sf):
    entries = F.transform(
        "embedding",
        lambda x, i: F.struct((i + 1).cast("string").alias("label"), F.abs(x.cast("double")).alias("prob")),
    )
    out = given(spark, sf, "embeddings").select("vec_id", S.normalize_probs(entries).alias("p"))
    at = lambda i: S.prob_at(F.col("p"), i)
    return out.select(
        "vec_id",
        F.size("p").cast("long").alias("n"),
        *[at(i).alias(f"prob_{i + 1}") for i in range(4)],
        F.round(at(0) * 100, 2).alias("score"),
        at(8).alias("prob_9"),
    )


def avg_if(condition: str, name: str) -> str:
    return dbl(f"AVG(CASE WHEN {condition} THEN 1.0 ELSE 0.0 END)", name)


def history_sql(key: str, prefix: str, podium: str = None) -> str:
    extra = f", {avg_if('finish_place <= 3', podium)}" if podium else ""
    return f"""SELECT {key}, COUNT(*) AS {prefix}_race_count, {avg_if("finish_place = 1", prefix + "_win_pct")}{extra}
        FROM race_records GROUP BY {key}"""


@query("avg_if_rates", history_sql("jockey_id", "jockey", "hj_podium_rate"), "race_records")
def _(spark, sf):
    return score.history_by(view(spark, sf, "race_records"), "jockey_id", "jockey", "hj_podium_rate")


NEW_RACE = score.NewRace(
    distance_m=1800, temp_c=22.0, race_group="GROUP_I", track_surface_cat="miękki", is_rainy=1
)
CONSTANTS = """CAST(1800 AS BIGINT) AS distance_m, CAST(22 AS DOUBLE) AS temp_c, 'GROUP_I' AS race_group,
    'miękki' AS track_surface_cat, CAST(NULL AS BIGINT) AS category_id, CAST(NULL AS VARCHAR) AS subtype,
    CAST(1 AS BIGINT) AS is_rainy, CAST(0 AS BIGINT) AS is_sunny, CAST(0 AS BIGINT) AS is_cloudy,
    CAST(0 AS BIGINT) AS is_hot, CAST(0 AS BIGINT) AS is_foggy, CAST(0 AS DOUBLE) AS prize_amount,
    'medium' AS distance_bucket, 'temp_15_22' AS temp_bucket, 'p_0' AS prize_amount_bucket"""
ENTRIES = f"""entries AS (SELECT r.horse_id, r.jockey_id, r.trainer_id, r.start_order AS start_pos, r.jockey_weight_kg
    FROM race_records r JOIN races a ON a.race_id = r.race_id WHERE CAST(a.race_date AS DATE) > {D})"""


def entries(t):
    """Starters of all races after the cut-off."""
    later = lookup(t.races.where(after(F.col("race_date"), AS_OF)).select("race_id"), "later")
    runs = t.race_records.select(
        "race_id", "horse_id", "jockey_id", "trainer_id", F.col("start_order").alias("start_pos"), "jockey_weight_kg"
    )
    return runs.join(later, "race_id").drop("race_id")


@query("scenario_overrides", f"WITH {ENTRIES} SELECT *, {CONSTANTS} FROM entries", RR)
def _(spark, sf):
    return entries(racing(spark, sf)).withColumns(NEW_RACE.columns())


@query(
    "prediction_input",
    f"""WITH {STARTERS}, {FORM}, {ENTRIES}, hm AS ({history_sql("horse_id", "horse")}),
        money AS (SELECT horse_id, SUM(prize_amount) AS total FROM race_records GROUP BY horse_id),
        latest AS (SELECT * FROM (SELECT horse_id, rest_days, {rest_sql("rest_days")} AS rest_bucket, ROW_NUMBER() OVER (
            PARTITION BY horse_id ORDER BY day DESC, race_id DESC, race_record_id DESC) AS rn FROM form) WHERE rn = 1),
        jm AS ({history_sql("jockey_id", "jockey", "hj_podium_rate")}),
        tm AS ({history_sql("trainer_id", "trainer", "ht_podium_rate")})
        SELECT e.*, h.horse_name, h.breeder_id, h.father_id, hm.horse_race_count, hm.horse_win_pct,
            hm.horse_race_count AS career_race_count, hm.horse_win_pct AS career_win_pct,
            {rnd("m.total", "career_prize_sum")}, l.rest_days, l.rest_bucket, j.last_name AS jockey_last_name,
            jm.* EXCLUDE (jockey_id), t.last_name AS trainer_last_name, tm.* EXCLUDE (trainer_id), {CONSTANTS},
            {", ".join(f"CAST(NULL AS DOUBLE) AS {c}" for c in score.OPEN)}
        FROM entries e JOIN hm ON hm.horse_id = e.horse_id JOIN money m ON m.horse_id = e.horse_id
        JOIN latest l ON l.horse_id = e.horse_id JOIN horses h ON h.horse_id = e.horse_id
        JOIN jockeys j ON j.jockey_id = e.jockey_id JOIN trainers t ON t.trainer_id = e.trainer_id
        LEFT JOIN jm ON jm.jockey_id = e.jockey_id LEFT JOIN tm ON tm.trainer_id = e.trainer_id""",
    f"{RR} horses horse_careers jockeys trainers",
    "career_prize_sum",
)
def _(spark, sf):
    t = racing(spark, sf)
    return score.prediction_input(t, entries(t), NEW_RACE)


# ---- training ---------------------------------------------------------------
# Fitted values depend on the optimizer. What does not is compared: the rows of
# both parts of the split, the labels, and the guess that a model has to beat.
V1_COLUMNS = ["race_id", "horse_id", "finish_place", *train.PLACE_V1_NUMBERS, *train.PLACE_V1_TEXTS]


def held_sql(keys: str, share: float) -> str:
    parts = ", ".join(f"COALESCE(CAST({k} AS VARCHAR), '-')" for k in keys.split())
    return f"CAST('0x' || substr(md5(concat_ws(':', '0', {parts})), 1, 8) AS BIGINT) % 10000 < {int(share * 10000)}"


def place_sql(rows: str, share: float) -> str:
    """Outcome of training a place model on ``rows`` (race_id, horse_id, finish_place)."""
    return f"""t AS (SELECT CAST(finish_place AS VARCHAR) AS label, {held_sql("race_id horse_id", share)} AS held FROM ({rows})
            WHERE finish_place IS NOT NULL),
        c AS (SELECT label, COUNT(*) FILTER (WHERE NOT held) AS fit, COUNT(*) FILTER (WHERE held) AS n FROM t GROUP BY label)
        SELECT CAST(SUM(fit) AS BIGINT) AS rows_train, CAST(SUM(n) AS BIGINT) AS rows_eval,
               string_agg(label, ',' ORDER BY label) FILTER (WHERE fit > 0) AS labels,
               {rnd("1.0 * (SELECT n FROM c ORDER BY fit DESC, label LIMIT 1) / SUM(n)", "majority_accuracy")},
               TRUE AS better FROM c"""


def place_row(spark, trained: train.Trained):
    """``better``: as many places are right as with the most frequent one, or they
    are given more probability than an even guess gives them."""
    b, m = trained.baseline, trained.metrics
    better = m["accuracy"] >= b["majority_accuracy"] or m["log_loss"] < math.log(len(trained.labels))
    row = (b["rows_train"], b["rows_eval"], ",".join(trained.labels), b["majority_accuracy"], better)
    return spark.createDataFrame([row], "rows_train long, rows_eval long, labels string, majority_accuracy double, better boolean")


@query(
    "train_place_v1",
    f"WITH {STARTERS}, {place_sql('SELECT race_id, horse_id, finish_place FROM base', 0.2)}",
    f"{RR} horses horse_careers",
    "majority_accuracy",
)
def _(spark, sf):
    rows = race_features_v1(racing(spark, sf), V1_COLUMNS)
    return place_row(spark, train.train_place_v1(rows))


RAN = """SELECT r.race_id, r.horse_id, r.finish_place FROM race_records r JOIN horses h ON h.horse_id = r.horse_id
    WHERE r.start_order IS NOT NULL AND r.finish_place IS NOT NULL
      AND EXISTS (SELECT 1 FROM horse_careers c WHERE c.horse_id = r.horse_id AND c.race_year <= 2001)"""


@query("train_place_v2", f"WITH {place_sql(RAN, 0.15)}", "race_records horses horse_careers", "majority_accuracy")
def _(spark, sf):
    t = racing(spark, sf)
    starts = materialize(asof_starts(t, AS_OF), "starts")
    common = shared_counts(t, AS_OF, starts, stored=("form", "careers"))
    return place_row(spark, train.train_place_v2(race_features(t, AS_OF, starts, common=common)))


# A line through one input has a closed form; all inputs are trained beside it.
LINE = f"""l AS (SELECT h.horse_id, CAST(h.age_years AS DOUBLE) AS x, l.rating_score AS y, {held_sql("h.horse_id", 0.15)} AS held
        FROM hf h JOIN horse_rating_labels l ON l.horse_id = CAST(h.horse_id AS VARCHAR) AND l.snapshot_date = {D}
        WHERE l.rating_score IS NOT NULL),
    f AS (SELECT regr_slope(y, x) AS a, regr_intercept(y, x) AS b, AVG(y) AS m FROM l WHERE NOT held),
    e AS (SELECT y, a * x + b AS p, m FROM l, f WHERE held)"""


@query(
    "train_rating",
    f"""WITH {HORSE_CTES}, hf AS ({HORSE_FEATURES}), {LINE}
        SELECT (SELECT COUNT(*) FROM l WHERE NOT held) AS rows_train, COUNT(*) AS rows_eval,
               {rnd("AVG(ABS(y - m))", "mean_only_error")}, {rnd("AVG(ABS(y - p))", "line_mean_error")},
               {rnd("quantile_cont(ABS(y - p), 0.5)", "line_median_error")},
               {rnd("1 - AVG((y - p) * (y - p)) / VAR_POP(y)", "line_r2")}, TRUE AS finite FROM e""",
    f"{RR} horses horse_careers horse_rating_labels",
    "mean_only_error line_mean_error line_median_error line_r2",
)
def _(spark, sf):
    t = racing(spark, sf)
    common = shared_counts(t, AS_OF, stored=("form",))
    labels = view(spark, sf, "horse_rating_labels")
    rows = materialize(train.join_labels(horse_features(t, AS_OF, common=common), labels, AS_OF), "rated")
    full = train.train_rating(rows)
    line = train.train_rating(rows.select("horse_id", "age_years", "rating_score"), l2=0.0).metrics
    b = full.baseline
    row = (
        b["rows_train"],
        b["rows_eval"],
        b["mean_only_error"],
        line["mean_absolute_error"],
        line["median_absolute_error"],
        line["r2_score"],
        all(v is None or math.isfinite(v) for v in full.metrics.values()),
    )
    shape = """rows_train long, rows_eval long, mean_only_error double, line_mean_error double, line_median_error double,
        line_r2 double, finite boolean"""
    return spark.createDataFrame([row], shape)


@query(
    "predict_race",
    f"""WITH {STARTERS}, {FORM}, {ENTRIES}, hm AS ({history_sql("horse_id", "horse")}),
        money AS (SELECT horse_id, SUM(prize_amount) AS total FROM race_records GROUP BY horse_id),
        latest AS (SELECT * FROM (SELECT horse_id, rest_days, ROW_NUMBER() OVER (
            PARTITION BY horse_id ORDER BY day DESC, race_id DESC, race_record_id DESC) AS rn FROM form) WHERE rn = 1),
        jm AS ({history_sql("jockey_id", "jockey", "hj_podium_rate")}),
        tm AS ({history_sql("trainer_id", "trainer", "ht_podium_rate")})
        SELECT e.horse_id, h.horse_name, e.start_pos, hm.horse_race_count, ROUND(100 * hm.horse_win_pct, 2) AS horse_win_pct,
            {rnd("m.total", "career_prize_sum")}, l.rest_days, j.last_name AS jockey_last_name, jm.jockey_race_count,
            ROUND(100 * jm.jockey_win_pct, 2) AS jockey_win_pct, ROUND(100 * jm.hj_podium_rate, 2) AS hj_podium_rate,
            e.jockey_weight_kg, t.last_name AS trainer_last_name, tm.trainer_race_count,
            ROUND(100 * tm.trainer_win_pct, 2) AS trainer_win_pct, CAST(1 AS DOUBLE) AS prob_total, TRUE AS score_fits
        FROM entries e JOIN hm ON hm.horse_id = e.horse_id JOIN money m ON m.horse_id = e.horse_id
        JOIN latest l ON l.horse_id = e.horse_id JOIN horses h ON h.horse_id = e.horse_id
        JOIN jockeys j ON j.jockey_id = e.jockey_id JOIN trainers t ON t.trainer_id = e.trainer_id
        LEFT JOIN jm ON jm.jockey_id = e.jockey_id LEFT JOIN tm ON tm.trainer_id = e.trainer_id""",
    f"{RR} horses horse_careers jockeys trainers",
    "career_prize_sum prob_total",
)
def _(spark, sf):
    """Every starter after the cut-off, ranked by a trained model. Of the fitted
    probabilities only the total (one) and their relation to the score are returned."""
    t = racing(spark, sf)
    trained = train.train_place_v1(race_features_v1(t, V1_COLUMNS))
    scored = score.label_probs(trained, score.prediction_input(t, entries(t), NEW_RACE))
    ranked = score.rank_starters(scored, keep=["probs"])
    total = F.aggregate(S.normalize_probs(F.col("probs")), F.lit(0.0), lambda a, p: a + p["prob"])
    fits = (F.col("score") == F.round(F.col("prob_1") * 100, 2)) & F.col("score").between(0, 100)
    checked = ranked.withColumns({"prob_total": total, "score_fits": fits})
    return checked.drop("score", "probs", *[f"prob_{i}" for i in range(1, 5)])


# ---- constant-rate descent --------------------------------------------------
# The same steps as recursion: the state is the list of weights, and a step is one
# aggregate over all rows.
RATING_INPUTS = ["age_years", "career_starts", "sire_win_pct"]
PLACE_INPUTS = ["start_order", "jockey_weight_kg"]


def scaled_sql(names: list[str], source: str) -> str:
    parts = [f"COALESCE((CAST({c} AS DOUBLE) - AVG({c}) OVER ()) / COALESCE(NULLIF(STDDEV_POP({c}) OVER (), 0), 1), 0) AS x{i + 1}" for i, c in enumerate(names)]
    return f"SELECT y, CAST(1 AS DOUBLE) AS x0, {', '.join(parts)} FROM {source} WHERE NOT held"


def descent_sql(n_inputs: int, n_labels: int, errors: list[str], rate: float, steps: int, l2: float) -> str:
    """CTEs ``state`` (step, w): weights of label k and input i at k * (n_inputs + 1) + i + 1."""
    width = n_inputs + 1
    slopes = [f"AVG(e{k} * x{i})" + (f" + {l2} * ANY_VALUE(w)[{k * width + i + 1}]" if i else "") for k in range(n_labels) for i in range(width)]
    updated = ", ".join(f"ANY_VALUE(w)[{j + 1}] - {rate} * ({s})" for j, s in enumerate(slopes))
    zeros = ", ".join(["CAST(0 AS DOUBLE)"] * (width * n_labels))
    return f"""state AS (
        SELECT 0 AS step, [{zeros}] AS w
        UNION ALL
        SELECT step + 1, [{updated}] FROM (SELECT step, w, xs.*, {", ".join(f"{e} AS e{k}" for k, e in enumerate(errors))} FROM state, xs WHERE step < {steps}) AS t
        GROUP BY step)"""


def linear_sql(width: int, label: int = 0) -> str:
    return " + ".join(f"w[{label * width + i + 1}] * x{i}" for i in range(width))


def softmax_errors(width: int, labels: list[str]) -> list[str]:
    z = [f"({linear_sql(width, k)})" for k in range(len(labels))]
    top = f"GREATEST({', '.join(z)})"
    total = " + ".join(f"EXP({x} - {top})" for x in z)
    return [f"EXP({x} - {top}) / ({total}) - CASE WHEN y = '{label}' THEN 1 ELSE 0 END" for x, label in zip(z, labels)]


def weights_sql(names: list[str], labels: list[str]) -> str:
    rows, width = [], len(names) + 1
    for k, label in enumerate(labels):
        for i, name in enumerate(["(intercept)", *names]):
            rows.append(f"SELECT '{label}' AS label, '{name}' AS input, {rnd(f'w[{k * width + i + 1}]', 'weight')} FROM last")
    return " UNION ALL ".join(rows)


def weight_rows(spark, weights: descent.Weights, labels: list[str]):
    names = ["(intercept)", *weights.names]
    rows = [(label, name, float(w)) for label, row in zip(labels, weights.values) for name, w in zip(names, row)]
    return spark.createDataFrame(rows, "label string, input string, weight double")


@query(
    "descent_rating",
    f"""WITH RECURSIVE {HORSE_CTES}, hf AS ({HORSE_FEATURES}),
        l AS (SELECT h.*, l.rating_score AS y, {held_sql("h.horse_id", 0.15)} AS held FROM hf h
              JOIN horse_rating_labels l ON l.horse_id = CAST(h.horse_id AS VARCHAR) AND l.snapshot_date = {D} WHERE l.rating_score IS NOT NULL),
        xs AS ({scaled_sql(RATING_INPUTS, "l")}),
        {descent_sql(3, 1, [f"{linear_sql(4)} - y"], 0.1, 50, 1.0)},
        last AS (SELECT w FROM state WHERE step = 50)
        {weights_sql(RATING_INPUTS, ["rating"])}""",
    f"{RR} horses horse_careers horse_rating_labels",
    "weight",
)
def _(spark, sf):
    """Weights of the rating model after 50 steps of rate 0.1; all inputs train beside."""
    t = racing(spark, sf)
    rows = train.join_labels(horse_features(t, AS_OF), view(spark, sf, "horse_rating_labels"), AS_OF)
    weights, metrics = descent.train_rating(rows, RATING_INPUTS)
    assert all(v is None or math.isfinite(v) for v in metrics.values())
    return weight_rows(spark, weights, ["rating"])


PLACES = [str(i) for i in range(1, 8)]


@query(
    "descent_place",
    f"""WITH RECURSIVE s AS (SELECT CAST(finish_place AS VARCHAR) AS y, start_order, jockey_weight_kg, {held_sql("race_id horse_id", 0.15)} AS held
              FROM race_records WHERE finish_place IS NOT NULL),
        xs AS ({scaled_sql(PLACE_INPUTS, "s")}),
        {descent_sql(2, 7, softmax_errors(3, PLACES), 0.05, 30, 1.0)},
        last AS (SELECT w FROM state WHERE step = 30)
        {weights_sql(PLACE_INPUTS, PLACES)}""",
    "race_records",
    "weight",
)
def _(spark, sf):
    """Weights of a place model after 30 steps of rate 0.05."""
    weights, metrics = descent.train_place(view(spark, sf, "race_records"), PLACE_INPUTS)
    assert weights.labels == PLACES and all(v is None or math.isfinite(v) for v in metrics.values())
    return weight_rows(spark, weights, weights.labels)
