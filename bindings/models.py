"""Naive forecasts, splits, folds, and boosted trees."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings.base import D, KEY, ROUNDED_SCORES, SCORES, TARGET, TS, TYPES, USERS, by_type, by_user, daily, query, r
from bindings.features import DOUBLES, INTS, features_sql
from bindings.tables import FOLDS, folds_sql
from hourloom.config import BoostSpec, FeatureSpec, JobSpec
from hourloom.operators import baseline
from hourloom.operators.features import build_features, lag_features, lag_name
from hourloom.plans import boosting, training
from hourloom.sources.files import SourceMissing
from hourloom.sources.workspace import fresh_folder, settle

LAGGED = """l AS (SELECT a.*, b.day_ahead_price AS lag FROM t a LEFT JOIN t b ON a.series_key = b.series_key AND b.ts = a.ts - INTERVAL 168 HOUR)"""


def _lagged(spark, sf_dir):
    return lag_features(by_type(spark, sf_dir), [TARGET], [168])


@query("naive_seasonal", f"WITH {TYPES}, {LAGGED} SELECT series_key, ts, {r('predicted=coalesce(lag, avg(lag) OVER (PARTITION BY series_key))')} FROM l")
def naive_seasonal(spark, sf_dir):
    return baseline.naive_seasonal(_lagged(spark, sf_dir)).select(KEY, TS, "predicted")


@query(
    "train_baseline",
    f"""WITH {USERS}, l AS (SELECT a.*, b.day_ahead_price AS lag FROM u a JOIN u b ON a.series_key = b.series_key AND b.ts = a.ts - INTERVAL 168 HOUR)
SELECT series_key, ts, {r('actual=day_ahead_price', 'predicted=lag', 'residual=day_ahead_price - lag')} FROM l WHERE day_ahead_price IS NOT NULL AND lag IS NOT NULL""",
)
def train_baseline(spark, sf_dir):
    return baseline.train_baseline(by_user(spark, sf_dir))


@query(
    "evaluate_baseline",
    f"""WITH {USERS}, l AS (SELECT a.*, b.day_ahead_price AS lag FROM u a JOIN u b ON a.series_key = b.series_key AND b.ts = a.ts - INTERVAL 168 HOUR)
SELECT series_key, ts, {r('actual=day_ahead_price', 'baseline_pred=lag')} FROM l WHERE lag IS NOT NULL""",
)
def evaluate_baseline(spark, sf_dir):
    return baseline.evaluate_baseline(by_user(spark, sf_dir))


@query(
    "split_ratio_time",
    f"""WITH {D} SELECT series_key, ts, {r(TARGET)},
  CASE WHEN row_number() OVER (PARTITION BY series_key ORDER BY ts) <= floor(count(*) OVER (PARTITION BY series_key) * 0.8::DOUBLE) THEN 'train' ELSE 'validation' END AS split FROM d""",
)
def split_ratio_time(spark, sf_dir):
    return baseline.split_ratio(daily(spark, sf_dir).select(KEY, TS, TARGET), 0.8, step="day")


@query(
    "split_last_days",
    f"""WITH {TYPES} SELECT series_key, ts, {r(TARGET)},
  CASE WHEN ts < max(ts) OVER (PARTITION BY series_key) - INTERVAL 7 DAY THEN 'train' ELSE 'validation' END AS split FROM t""",
)
def split_last_days(spark, sf_dir):
    return baseline.split_last_days(by_type(spark, sf_dir).select(KEY, TS, TARGET), 7)


@query(
    "cv_folds",
    f"WITH {D}, {folds_sql()} SELECT series_key, split, train_start, train_end, test_start, test_end, train_rows, test_rows FROM folds",
)
def cv_folds(spark, sf_dir):
    return baseline.cv_folds(daily(spark, sf_dir), FOLDS)


WEEK = 7
_FOLD_SCORES = f"""w AS (SELECT *, max(day_ahead_price) OVER (PARTITION BY series_key ORDER BY ts RANGE BETWEEN INTERVAL {WEEK} DAY PRECEDING AND INTERVAL {WEEK} DAY PRECEDING) AS lag FROM d),
tested AS (SELECT w.series_key, f.split, w.day_ahead_price AS actual, w.lag AS predicted FROM w JOIN folds f ON w.series_key = f.series_key AND w.ts >= f.test_start AND w.ts < f.test_end
  WHERE w.lag IS NOT NULL),
scores AS (SELECT series_key, split, {SCORES} FROM tested GROUP BY 1, 2)"""


def _daily_lagged(spark, sf_dir):
    return lag_features(daily(spark, sf_dir), [TARGET], [WEEK], step="day")


@query("cv_evaluate", f"WITH {D}, {folds_sql()}, {_FOLD_SCORES} SELECT series_key, split, {ROUNDED_SCORES} FROM scores")
def cv_evaluate(spark, sf_dir):
    rows = _daily_lagged(spark, sf_dir)
    return baseline.cv_baseline(rows, baseline.cv_folds(rows, FOLDS), lag=WEEK)


@query(
    "cv_mean_metrics",
    f"""WITH {D}, {folds_sql()}, {_FOLD_SCORES}
SELECT series_key, {r('mae=avg(mae)', 'rmse=avg(rmse)', 'smape=avg(smape)', 'r2=avg(r2)')}, count(*) AS n_folds FROM scores GROUP BY 1""",
)
def cv_mean_metrics(spark, sf_dir):
    rows = _daily_lagged(spark, sf_dir)
    return baseline.cv_mean_metrics(baseline.cv_baseline(rows, baseline.cv_folds(rows, FOLDS), lag=WEEK))


# --- boosted trees ---------------------------------------------------------------
# SQL cannot repeat the fit. It states which rows are predicted, how they are split, what the naive model scores on
# them; of the trees' numbers the queries return what must hold for any fit.

BOOST = BoostSpec()
FEATURES = FeatureSpec()
JOB = JobSpec(boost=BOOST, features=FEATURES, validation_days=7)


def features(spark, sf_dir):
    return build_features(by_type(spark, sf_dir), FEATURES)


def stored_features(spark, sf_dir):
    """Written once and read back: fitting reads its input several times."""
    path = fresh_folder(spark, "features")
    features(spark, sf_dir).write.parquet(path)
    return spark.read.parquet(path)


_INPUTS = [*INTS, *DOUBLES]
COMPLETE = f"""{TYPES}, {features_sql('t')}, c AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY series_key ORDER BY ts) <= floor(count(*) OVER (PARTITION BY series_key) * 0.8::DOUBLE)
  THEN 'train' ELSE 'validation' END AS split FROM f WHERE {' AND '.join(f'{c} IS NOT NULL' for c in _INPUTS)})"""


def checked(predictions, *columns):
    """Predicted rows with what must hold for any model."""
    agrees = F.abs(F.col("actual") - F.col("predicted") - F.col("residual")) < 1e-9
    return predictions.select(KEY, TS, "actual", *columns, F.coalesce(agrees, F.lit(False)).alias("residual_agrees"))


def with_flag(rows, name, first, second, where="true"):
    """Add to every row whether, over its series, the mean of ``first`` is below that of ``second``."""
    means = rows.filter(where).groupBy(KEY).agg(F.avg(first).alias("_a"), F.avg(second).alias("_b"))
    return rows.join(means.select(KEY, (F.col("_a") < F.col("_b")).alias(name)), KEY)


@query("gbt_fit_predict", f"WITH {COMPLETE} SELECT series_key, ts, {r('actual=day_ahead_price')}, true AS residual_agrees, true AS beats_level FROM c")
def gbt_fit_predict(spark, sf_dir):
    rows = stored_features(spark, sf_dir).na.drop("any")
    out = settle(boosting.predict(boosting.fit_boosted(rows, spec=BOOST), rows), "predicted")
    level = out.groupBy(KEY).agg(F.avg("actual").alias("_level"))
    judged = with_flag(out.join(level, KEY), "beats_level", F.abs("residual"), F.abs(F.col("actual") - F.col("_level")))
    return checked(judged, "beats_level")


NAIVE = lag_name(168, TARGET)


@query("train_improved", f"WITH {COMPLETE} SELECT series_key, ts, {r('actual=day_ahead_price')}, split, true AS residual_agrees, true AS beats_naive FROM c")
def train_improved(spark, sf_dir):
    _, out = boosting.train_improved(stored_features(spark, sf_dir), spec=BOOST, extra=[NAIVE])
    out = settle(out, "predicted")
    later = F.col("split") == "validation"
    return checked(with_flag(out, "beats_naive", F.abs("residual"), F.abs(F.col("actual") - F.col(NAIVE)), later), "split", "beats_naive")


_MODEL_INPUTS = [*[c for c in _INPUTS if c != TARGET], boosting.LEVEL]


@query(
    "feature_importance",
    "SELECT unnest([" + ", ".join(f"'{c}'" for c in _MODEL_INPUTS) + "]) AS feature, true AS is_share, true AS sums_to_one, true AS agrees_with_trees",
)
def feature_importance(spark, sf_dir):
    """Shares recomputed from the node table; stage by stage they must be those that the trees themselves report."""
    model = boosting.fit_boosted(stored_features(spark, sf_dir), spec=BOOST)
    nodes = boosting.tree_nodes(model, spark)
    rows = settle(boosting.importance_from_nodes(nodes, model.inputs), "importance")
    total = rows.agg(F.sum("importance")).scalar()
    reported = [(i, c, float(v)) for i, stage in enumerate(model.stages) for c, v in zip(model.inputs, stage.featureImportances.toArray(), strict=True)]
    reported = spark.createDataFrame(reported, "stage int, feature string, reported double")
    both = boosting.importance_from_nodes(nodes, model.inputs, ["stage"]).join(reported, ["stage", "feature"])
    agrees = both.groupBy("feature").agg(F.bool_and(F.abs(F.col("importance") - F.col("reported")) < 1e-9).alias("agrees_with_trees"))
    flags = rows.select("feature", F.col("importance").between(0, 1).alias("is_share"), (F.abs(total - 1) < 1e-6).alias("sums_to_one"))
    return flags.join(agrees, "feature")


@query(
    "importance_share",
    f"""WITH i AS (SELECT l_shipdate AS d, l_returnflag || l_linestatus || CAST(l_linenumber AS VARCHAR) AS feature, l_extendedprice FROM lineitem),
s AS (SELECT feature, sum(l_extendedprice) AS importance FROM i GROUP BY 1)
SELECT feature, {r('importance', 'importance_pct=importance_pct')} FROM (SELECT *, 100.0 * importance / sum(importance) OVER () AS importance_pct FROM s) ORDER BY importance DESC, feature LIMIT 10""",
)
def importance_share(spark, sf_dir):
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    name = F.concat("l_returnflag", "l_linestatus", F.col("l_linenumber").cast("string")).alias("feature")
    return boosting.importance_share(li.groupBy(name).agg(F.sum("l_extendedprice").alias("importance")))


@query(
    "model_save_load",
    f"WITH {COMPLETE} SELECT series_key, ts, {r('actual=day_ahead_price')}, true AS residual_agrees, true AS same_as_fitted, true AS nodes_agree, 'run1' AS run_id FROM c",
)
def model_save_load(spark, sf_dir):
    rows = stored_features(spark, sf_dir).na.drop("any")
    path = fresh_folder(spark, "model")
    fitted = boosting.fit_boosted(rows, spec=BOOST)
    boosting.save_model(fitted, path, {"run_id": "run1", "model_type": "gbt"}, spark)
    model, metadata = boosting.load_model(path, spark)
    before = boosting.predict(fitted, rows).select(KEY, TS, F.col("predicted").alias("fitted"))
    walked = boosting.predict_from_nodes(boosting.tree_nodes(model, spark), model, rows).select(KEY, TS, F.col("predicted").alias("walked"))
    both = boosting.predict(model, rows).join(before, [KEY, TS]).join(walked, [KEY, TS])
    same = (F.abs(F.col("predicted") - F.col("fitted")) < 1e-9).alias("same_as_fitted")
    nodes = (F.abs(F.col("predicted") - F.col("walked")) < 1e-9).alias("nodes_agree")
    return checked(both, same, nodes, F.lit(metadata["run_id"]).alias("run_id"))


@query(
    "run_training",
    f"""WITH {COMPLETE}, v AS (SELECT series_key, day_ahead_price AS actual, lag_168h_day_ahead_price AS predicted FROM c WHERE split = 'validation'),
s AS (SELECT series_key, {SCORES} FROM v GROUP BY 1)
SELECT series_key, 'baseline' AS model, n_samples, {r('mae')}, true AS ordered, true AS improved_beats_naive FROM s
UNION ALL SELECT series_key, 'improved', n_samples, NULL, true, true FROM s""",
)
def run_training(spark, sf_dir):
    cache, table = fresh_folder(spark, "features"), features(spark, sf_dir)
    table.limit(0).write.parquet(f"{cache}/run_id=2024-01-01")  # an older run that must not be taken
    table.write.parquet(f"{cache}/run_id=2024-02-01")

    def no_local_files():
        raise SourceMissing("no raw folder")

    source, outcomes = training.train_from_files(spark, cache, no_local_files, JOB)
    assert source == "cache"
    rows = settle(training.comparison(outcomes), "comparison")
    naive = F.when(F.col("model") == "baseline", F.col("mae")).alias("mae")
    mae = lambda name: F.max(F.when(F.col("model") == name, F.col("mae")))
    beats = rows.groupBy(KEY).agg((mae("improved") < mae("baseline")).alias("improved_beats_naive"))
    return rows.join(beats, KEY).select(KEY, "model", "n_samples", naive, (F.col("rmse") >= F.col("mae")).alias("ordered"), "improved_beats_naive")
