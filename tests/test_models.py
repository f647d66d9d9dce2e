"""Boosted trees, training, evaluation and validation end to end."""

import random

import pytest
from pyspark.sql import functions as F

from hourloom.config import DRIVERS, KEY, TARGET, TS, BoostSpec, FeatureSpec, FoldSpec, JobSpec
from hourloom.operators.features import build_features
from hourloom.plans import boosting, jobs, training, validation
from tests.helpers import at

SPEC = JobSpec(
    boost=BoostSpec(n_trees=8, learning_rate=0.3, max_depth=3, min_child_rows=2),
    features=FeatureSpec(lags=(24, 168), rolling_columns=(TARGET,), windows=(24,)),
    folds=FoldSpec(train_days=20, test_days=3, n_splits=5),
    validation_days=7,
)


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    """Prices driven by load and hour: trees should beat last week's price."""
    rng = random.Random(1)
    rows = []
    for h in range(24 * 40):
        load = 50000 + 8000 * rng.random()
        price = (load - 50000) / 200 + (h % 24) + rng.random()
        rows.append(("a", at(h), price, load, 10000.0 + h % 7, 5000.0 + h % 24))
    df = spark.createDataFrame(rows, f"{KEY} string, {TS} timestamp_ntz, " + ", ".join(f"{c} double" for c in (TARGET, *DRIVERS)))
    path = str(tmp_path_factory.mktemp("features"))
    build_features(df, SPEC.features).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def outcomes(table):
    return training.run_training(table, SPEC)


def test_model_beats_naive_on_the_same_rows(outcomes):
    rows = {r["model"]: r for r in training.comparison(outcomes).collect()}
    assert rows["baseline"]["n_samples"] == rows["improved"]["n_samples"] > 0
    for r in rows.values():
        assert r["rmse"] >= r["mae"] >= 0
    assert rows["improved"]["mae"] < rows["baseline"]["mae"]
    assert training.improvement(training.comparison(outcomes)).first()["mae_improvement_pct"] > 0


def test_predictions_cover_both_splits(outcomes):
    got = {r["split"]: r["count"] for r in outcomes["improved"].predictions.groupBy("split").count().collect()}
    assert got["train"] == int((got["train"] + got["validation"]) * 0.8)


def test_importance(outcomes):
    rows = {r["feature"]: r["importance"] for r in outcomes["improved"].importance.collect()}
    assert sum(rows.values()) == pytest.approx(1.0) and max(rows, key=rows.get) in {"forecast_load", "forecast_residual_load", "forecast_renewable_share"}
    share = boosting.importance_share(outcomes["improved"].importance, 3).collect()
    assert len(share) == 3 and share[0]["importance_pct"] >= share[-1]["importance_pct"]


def test_save_and_load(spark, table, outcomes, tmp_path):
    training.save_training(outcomes, "r1", str(tmp_path), spark)
    model, metadata = boosting.load_model(f"{tmp_path}/model/run_id=r1", spark)
    assert metadata["run_id"] == "r1"
    rows = table.na.drop("any")
    a, b = (boosting.predict(m, rows).agg(F.sum("predicted")).first()[0] for m in (model, outcomes["improved"].model))
    assert a == pytest.approx(b)
    assert spark.read.json(f"{tmp_path}/metrics_baseline").first()["metrics"]["mae"] > 0


def test_one_failing_model_does_not_stop_the_other(table, monkeypatch):
    def broken(*_args, **_kwargs):
        raise RuntimeError("boom")

    monkeypatch.setattr(training, "train_improved", broken)
    got = training.run_training(table, SPEC)
    assert got["baseline"].success and got["improved"].errors == ["boom"]
    assert training.comparison(got).first()["model"] == "baseline"
    with pytest.raises(ValueError, match="unknown"):
        training.run_training(table, SPEC, "other")


def test_eval_runs_every_fold_and_writes_a_record(spark, table, tmp_path):
    per_fold, means = training.run_eval(table, SPEC, folder=str(tmp_path), run_id="r7")
    rows = {r["model"]: r for r in means.collect()}
    assert set(rows) == {"baseline", "improved"} and rows["baseline"]["n_folds"] == SPEC.folds.n_splits == rows["improved"]["n_folds"]
    record = {r["model"]: r for r in spark.read.json(f"{tmp_path}/cv_record").collect()}
    assert len(record["improved"]["folds"]) == 5 and record["improved"]["mae"] == pytest.approx(rows["improved"]["mae"])
    written = spark.read.option("header", True).csv(f"{tmp_path}/cv_predictions")
    assert written.groupBy("model").count().count() == 2 and written.filter("predicted is null").isEmpty()
    assert rows["improved"]["mae"] < rows["baseline"]["mae"]


def test_validation_report(spark, table, tmp_path):
    numbered = table.withColumn("nr", -F.unix_micros(F.col(TS).cast("timestamp")))
    rows = validation.run_validation(table, SPEC, folder=str(tmp_path), run_id="r3").collect()
    record = spark.read.json(f"{tmp_path}/validation").first()
    assert record["leakage"] == "none" and len(record["metrics"]) == len(rows)
    assert not validation.arrival_order(numbered.select(KEY, TS, "nr"), "nr").first()["monotone"]
    value = {(r["section"], r["name"], r["metric"]): r["value"] for r in rows}
    assert value["overall", "improved", "mae"] < value["overall", "baseline", "mae"]
    assert value["overall", "improved", "n_samples"] == value["overall", "baseline", "n_samples"]
    assert value["improvement", "all", "mae_improvement_pct"] > 0
    assert value["missing_driver", "missing_forecast_load", "mae_degradation_pct"] > 0
    assert value["missing_driver", "baseline", "mae_degradation_pct"] == 0
    assert value["leakage", "all", "issues"] == 0
    assert len({n for s, n, _ in value if s == "hour_improved"}) == 24


def test_unknown_inputs_have_no_prediction(table, outcomes):
    rows = table.na.drop("any").limit(50).withColumn("forecast_load", F.when(F.hour(TS) < 12, F.col("forecast_load")))
    out = boosting.predict(outcomes["improved"].model, rows)
    assert out.count() == 50
    assert out.filter((F.hour(TS) < 12) == F.col("predicted").isNull()).isEmpty()


def test_leakage_findings():
    assert validation.leakage_findings(["lag_24h_x"], SPEC) == []
    found = validation.leakage_findings(["lag_3h_x", "future_x"], SPEC, ordered=False)
    assert len(found) == 3


def test_morning_signal_uses_the_last_week(spark, outcomes, tmp_path):
    record = jobs.morning_signal(outcomes["baseline"].predictions, SPEC, str(tmp_path))
    row = record.first()
    assert row["context"]["hours_analyzed"] == 168 and row["market"] == SPEC.market and row["strategy"].count("\n") == 2
    assert spark.read.json(f"{tmp_path}/morning_signal").count() == 1


def test_best_round_waits():
    assert boosting.best_round([5.0, 6.0, 4.0, 4.5, 4.4, 4.3, 1.0], 3) == (3, True)
    assert boosting.best_round([5.0, 6.0, 4.0, 4.5, 4.4], 3) == (3, False)
    assert boosting.best_round([3.0, 2.0, 1.0], 50) == (3, False)


def noisy(spark, tmp_path, n=900):
    """Written once, so that every fit sees the same partitions."""
    rng = random.Random(3)
    rows = []
    for h in range(n):
        x, y = rng.random(), rng.random()
        rows.append(("a", at(h), 20 * x + 10 * y + rng.gauss(0, 9), x, y))
    df = spark.createDataFrame(rows, f"{KEY} string, {TS} timestamp_ntz, {TARGET} double, x double, y double")
    df.write.parquet(str(tmp_path / "rows"))
    return spark.read.parquet(str(tmp_path / "rows"))


def test_fit_goes_on_after_a_round_without_gain(spark, tmp_path):
    spec = BoostSpec(n_trees=60, max_depth=3, patience=20)
    df = noisy(spark, tmp_path)
    model = boosting.fit_boosted(df, spec=spec)
    kept, settled = boosting.best_round(model.errors, spec.patience)
    assert model.n_trees == kept and (settled or len(model.errors) == spec.n_trees)
    first_rise = next(i for i in range(1, len(model.errors)) if model.errors[i] >= model.errors[i - 1])
    assert kept > first_rise
    stop = df.orderBy(F.desc(TS)).limit(90)
    error = boosting.predict(model, stop).agg(F.avg(F.abs("residual"))).first()[0]
    assert error == pytest.approx(min(model.errors), rel=0.02)  # but for the level, which stop rows see alike
    boosting.save_model(model, str(tmp_path / "m"), {"run_id": "a"}, spark)
    loaded, _ = boosting.load_model(str(tmp_path / "m"), spark)
    assert loaded.n_trees == kept and boosting.predict(loaded, stop).agg(F.avg(F.abs("residual"))).first()[0] == pytest.approx(error)


def test_stages_go_on_where_the_last_one_stopped(spark, tmp_path):
    """Rounds after the first stage are fitted to its residuals, and none is fitted twice but in a stage that is cut."""
    df = noisy(spark, tmp_path, 400)
    fits = []
    fit = boosting.GBTRegressor.fit

    def counted(self, rows):
        fits.append(self.getMaxIter())
        return fit(self, rows)

    spec = BoostSpec(n_trees=24, learning_rate=0.02, max_depth=2, patience=6)
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(boosting.GBTRegressor, "fit", counted)
        model = boosting.fit_boosted(df, spec=spec)
    tried = len(model.errors)
    assert tried <= spec.n_trees and fits[0] == 6 and sum(fits) - tried < max(fits) + 1
    out = boosting.predict(model, df)
    assert out.agg(F.avg(F.abs("residual"))).first()[0] < df.agg(F.avg(F.abs(F.col(TARGET) - 15))).first()[0]
    nodes = boosting.tree_nodes(model, spark)
    assert {r["stage"] for r in nodes.select("stage").distinct().collect()} == set(range(len(model.stages)))
    walked = boosting.predict_from_nodes(nodes, model, df).select(KEY, TS, F.col("predicted").alias("walked"))
    assert out.join(walked, [KEY, TS]).filter(F.abs(F.col("predicted") - F.col("walked")) > 1e-9).isEmpty()
    per_stage = boosting.importance_from_nodes(nodes, model.inputs, ["stage"]).collect()
    for i, stage in enumerate(model.stages):
        shares = {r["feature"]: r["importance"] for r in per_stage if r["stage"] == i}
        assert [shares[c] for c in model.inputs] == pytest.approx(list(stage.featureImportances.toArray()))


def test_series_of_different_scale_are_both_fitted(spark, tmp_path):
    """Without the level a shared model cannot tell the series apart: their inputs are alike."""
    rng = random.Random(8)
    rows = [(key, at(h), base * (1 + 0.2 * x) + rng.gauss(0, base / 100), x) for h in range(400) for key, base in (("small", 10.0), ("large", 1000.0)) for x in [rng.random()]]
    df = spark.createDataFrame(rows, f"{KEY} string, {TS} timestamp_ntz, {TARGET} double, x double")
    model, out = boosting.train_improved(df, spec=BoostSpec(n_trees=40, learning_rate=0.2, max_depth=4, min_child_rows=5))
    later = out.filter("split = 'validation'").groupBy(KEY).agg(F.avg(F.abs("residual")).alias("mae"), F.avg("actual").alias("level")).collect()
    assert len(later) == 2 and all(r["mae"] < 0.06 * r["level"] for r in later)
    assert model.inputs[-1] == boosting.LEVEL
    strange = df.filter(f"{KEY} = 'small'").limit(3).withColumn(KEY, F.lit("new"))
    assert boosting.predict(model, strange).filter("predicted is null").isEmpty()


def test_no_row_sees_its_own_outcome_in_its_level(spark):
    rows = [("a", at(h), float(h), 1.0) for h in range(50)]
    df = spark.createDataFrame(rows, f"{KEY} string, {TS} timestamp_ntz, {TARGET} double, x double")
    row = boosting.series_levels(df).first()
    fold = {r["f"]: r for r in df.groupBy(boosting._level_fold().alias("f")).agg(F.sum(TARGET).alias("s"), F.count("*").alias("n")).collect()}
    assert row[boosting.LEVEL] == pytest.approx(24.5)
    for f, r in fold.items():
        assert row["_others"][f] == pytest.approx((1225.0 - r["s"]) / (50 - r["n"]))


def test_unknown_inputs_have_no_walked_prediction(spark, table, outcomes):
    model = outcomes["improved"].model
    rows = table.na.drop("any").limit(50).withColumn("forecast_load", F.when(F.hour(TS) < 12, F.col("forecast_load")))
    out = boosting.predict_from_nodes(boosting.tree_nodes(model, spark), model, rows)
    assert out.count() == 50 and out.filter((F.hour(TS) < 12) == F.col("predicted").isNull()).isEmpty()
