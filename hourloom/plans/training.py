"""Train both models, compare them on the same rows, cross-validate them."""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourloom.config import KEY, TARGET, TS, BoostSpec, JobSpec
from hourloom.functions.scores import score_columns
from hourloom.operators.baseline import assign_folds, cv_baseline_predictions, cv_folds, cv_mean_metrics, ensure_lag, train_baseline
from hourloom.operators.evaluation import baseline_improvement, regression_metrics
from hourloom.operators.tables import drop_null_any, union_all
from hourloom.plans.boosting import (
    BoostedModel,
    feature_importance,
    fit_boosted,
    model_inputs,
    predict,
    save_model,
    train_improved,
)
from hourloom.sources.files import load_features
from hourloom.sources.sinks import write_csv, write_json, write_metrics
from hourloom.sources.workspace import settle

log = logging.getLogger(__name__)


@dataclass
class Outcome:
    """What training one model produced; ``errors`` is non-empty when it failed."""

    kind: str
    predictions: DataFrame | None = None
    metrics: DataFrame | None = None
    model: BoostedModel | None = None
    importance: DataFrame | None = None
    errors: list[str] = field(default_factory=list)

    @property
    def success(self) -> bool:
        return not self.errors


def _train_naive(features: DataFrame, spec: JobSpec, target: str, step: str) -> Outcome:
    predictions = settle(train_baseline(features, target, spec.baseline_lag, step=step), "predictions")
    return Outcome("baseline", predictions, regression_metrics(predictions))


def _train_trees(features: DataFrame, spec: JobSpec, target: str, step: str) -> Outcome:
    model, predictions = train_improved(features, target, spec=spec.boost, step=step)
    predictions = settle(predictions, "predictions")
    scores = regression_metrics(predictions.filter("split = 'validation'"))
    return Outcome("improved", predictions, scores, model, feature_importance(model, features.sparkSession))


def run_training(features: DataFrame, spec: JobSpec = JobSpec(), which: str = "both", target: str = TARGET, step: str = "hour") -> dict[str, Outcome]:
    """``baseline``, ``improved`` or ``both``; a failing model does not stop the other."""
    makers = {"baseline": _train_naive, "improved": _train_trees}
    if which != "both" and which not in makers:
        raise ValueError(f"unknown model {which!r}")
    out = {}
    for kind, make in makers.items():
        if which not in ("both", kind):
            continue
        try:
            out[kind] = make(features, spec, target, step)
        except Exception as problem:  # noqa: BLE001 - isolate models from each other
            log.error("%s model failed: %s", kind, problem)
            out[kind] = Outcome(kind, errors=[str(problem)])
    return out


def train_from_files(
    spark: SparkSession, cache: str, local: Callable[[], DataFrame] | None = None, spec: JobSpec = JobSpec(), which: str = "both", target: str = TARGET, step: str = "hour"
) -> tuple[str, dict[str, Outcome]]:
    """Train on the local feature table if its files are there, else on the newest cached run; the name of the source comes along.

    Raises ``SourceMissing`` where there is neither. The table is written once: models read it many times.
    """
    name, features = load_features(spark, local, cache, target)
    known = features.drop("run_id", "source")
    return name, run_training(settle(known, "features") if name == "local" else known, spec, which, target, step)


def comparison(outcomes: dict[str, Outcome]) -> DataFrame:
    """Both models on the stamps both have predicted in the validation split, one row per series and model."""
    done = {k: o for k, o in outcomes.items() if o.success}
    if len(done) < 2:
        only = next(iter(done.values()))
        return only.metrics.withColumn("model", F.lit(only.kind))
    base, trees = done["baseline"].predictions, done["improved"].predictions.filter("split = 'validation'")
    keys = [KEY, TS]
    shared_base = base.join(trees.select(*keys), keys, "left_semi")
    shared_trees = trees.join(base.select(*keys), keys, "left_semi")
    rows = {"baseline": shared_base, "improved": shared_trees}
    return union_all(
        df.select(KEY, "actual", "predicted").withColumn("model", F.lit(name)) for name, df in rows.items()
    ).groupBy(KEY, "model").agg(*score_columns(F.col("actual"), F.col("predicted")))


def improvement(compared: DataFrame) -> DataFrame:
    return baseline_improvement(compared.filter("model = 'baseline'"), compared.filter("model = 'improved'"))


def save_training(outcomes: dict[str, Outcome], run_id: str, folder: str, spark: SparkSession) -> None:
    """Predictions as CSV, metrics as JSON, the model and its importance next to them."""
    for kind, o in outcomes.items():
        if not o.success:
            continue
        write_csv(o.predictions, f"{folder}/predictions_{kind}/run_id={run_id}")
        write_metrics(o.metrics, kind, run_id, f"{folder}/metrics_{kind}/run_id={run_id}")
        if o.model is not None:
            save_model(o.model, f"{folder}/model/run_id={run_id}", {"run_id": run_id, "model_type": "gbt"}, spark)
            write_csv(o.importance, f"{folder}/importance/run_id={run_id}")


# --- cross-validation --------------------------------------------------------


def cv_boosted_predictions(features: DataFrame, folds: DataFrame, target: str = TARGET, spec: BoostSpec = BoostSpec(), step: str = "hour") -> DataFrame:
    """Test predictions per series and fold of a model refitted for every fold.

    The driver loops over fold numbers (at most ``n_splits``); each fit and each
    prediction is a distributed job. The rows are written by fold and role, so a
    fit reads just its own; its latest rows decide when it stops. Folds without train or test rows are skipped.
    """
    rows = settle(assign_folds(drop_null_any(features), folds), "folds", ("split", "role"))
    counts = rows.groupBy("split").agg(
        F.count(F.when(F.col("role") == "train", 1)).alias("train"), F.count(F.when(F.col("role") == "test", 1)).alias("test")
    )
    usable = sorted(r["split"] for r in counts.filter("train > 0 and test > 0").select("split").collect())
    if not usable:
        raise ValueError("no fold has both train and test rows")
    inputs = model_inputs(features, target)
    parts = []
    for split in usable:
        one = rows.filter(F.col("split") == split)
        model = fit_boosted(one.filter("role = 'train'"), target, inputs, spec, step=step)
        parts.append(predict(model, one.filter("role = 'test'"), target).withColumn("split", F.lit(split)))
    return settle(union_all(parts), "cv")


def fold_metrics(predictions: DataFrame) -> DataFrame:
    """Metrics per series and fold of test predictions."""
    return predictions.groupBy(KEY, "split").agg(*score_columns(F.col("actual"), F.col("predicted")))


def cv_boosted(features: DataFrame, folds: DataFrame, target: str = TARGET, spec: BoostSpec = BoostSpec(), step: str = "hour") -> DataFrame:
    return fold_metrics(cv_boosted_predictions(features, folds, target, spec, step))


@dataclass
class Evaluation:
    """Cross-validation of one or both models: test predictions, metrics per fold, their means."""

    predictions: DataFrame
    per_fold: DataFrame
    means: DataFrame


def evaluate(features: DataFrame, spec: JobSpec = JobSpec(), which: str = "both", target: str = TARGET, step: str = "hour", folder: str | None = None, run_id: str = "run") -> Evaluation:
    """Cross-validate on all ``n_splits`` folds; with a ``folder`` predictions and a JSON record are written."""
    ready = ensure_lag(features, target, spec.baseline_lag, step=step)
    folds = cv_folds(ready, spec.folds)
    parts = []
    if which in ("baseline", "both"):
        parts.append(cv_baseline_predictions(ready, folds, target, spec.baseline_lag).withColumn("model", F.lit("baseline")))
    if which in ("improved", "both"):
        parts.append(cv_boosted_predictions(ready, folds, target, spec.boost, step).withColumn("model", F.lit("improved")))
    predictions = union_all(p.select(KEY, TS, "split", "model", "actual", "predicted", "residual") for p in parts)
    per_fold = predictions.groupBy(KEY, "model", "split").agg(*score_columns(F.col("actual"), F.col("predicted")))
    per_fold = settle(per_fold, "fold_metrics")
    out = Evaluation(predictions, per_fold, cv_mean_metrics(per_fold, (KEY, "model")))
    if folder:
        write_csv(predictions, f"{folder}/cv_predictions/run_id={run_id}")
        names = [c for c in per_fold.columns if c not in (KEY, "model")]
        lists = per_fold.groupBy(KEY, "model").agg(F.sort_array(F.collect_list(F.struct(*names))).alias("folds"))  # n_splits entries
        write_json(lists.join(out.means, [KEY, "model"]).withColumn("run_id", F.lit(run_id)), f"{folder}/cv_record/run_id={run_id}")
    return out


def run_eval(features: DataFrame, spec: JobSpec = JobSpec(), which: str = "both", target: str = TARGET, step: str = "hour", folder: str | None = None, run_id: str = "run") -> tuple[DataFrame, DataFrame]:
    """(fold metrics, mean metrics), both with ``model``."""
    done = evaluate(features, spec, which, target, step, folder, run_id)
    return done.per_fold, done.means
