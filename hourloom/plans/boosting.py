"""Gradient-boosted trees on MLlib: fit, predict, importance, persistence, stress.

One model is trained over all series given, as histogram aggregation spreads
over the cluster. It knows a series by its level, the mean of the target in the
training rows. Filter to one series for a model of its own.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hourloom.config import DRIVERS, KEY, TARGET, TS, BoostSpec
from hourloom.functions.numbers import improvement_pct
from hourloom.functions.scores import score_columns
from hourloom.operators.baseline import split_ratio
from hourloom.operators.pieces import attach_summary
from hourloom.operators.quantiles import exact_percentiles
from hourloom.operators.tables import drop_null_any, union_all
from hourloom.sources.sinks import write_json
from hourloom.sources.workspace import ensure_checkpoints, fresh_folder, settle

#: Mean of the target over a series' training rows, an input of every model.
LEVEL = "series_level"
LEVEL_FOLDS = 5
HIDDEN = (KEY, TS, TARGET, "split", "role", "_stop", LEVEL)


def model_inputs(df: DataFrame, target: str = TARGET) -> list[str]:
    """Every column but keys, labels and the target."""
    return [c for c in df.columns if c not in HIDDEN and c != target]


# --- level of a series ---------------------------------------------------------


def series_levels(learned: DataFrame, target: str = TARGET) -> DataFrame:
    """Per series ``series_level`` and, by fold of the stamp, the level without that fold's rows.

    A row must not see its own outcome in an input, so training rows take the mean of the other folds.
    """
    folds = learned.groupBy(F.coalesce(KEY, F.lit("")).alias(KEY), _level_fold().alias("fold")).agg(F.sum(target).alias("s"), F.count(target).alias("n"))
    total = Window.partitionBy(KEY)  # at most LEVEL_FOLDS rows
    others = F.try_divide(F.sum("s").over(total) - F.col("s"), F.sum("n").over(total) - F.col("n"))
    return (
        folds.withColumn("others", others)
        .groupBy(KEY)
        .agg((F.sum("s") / F.sum("n")).alias(LEVEL), F.map_from_entries(F.collect_list(F.struct("fold", "others"))).alias("_others"))
    )


def _level_fold():
    return F.pmod(F.xxhash64(TS), F.lit(LEVEL_FOLDS))


def attach_level(df: DataFrame, levels: DataFrame, default: float) -> DataFrame:
    """Add the level of each row's series; a series without training rows has the level of all rows."""
    side = levels.select(F.col(KEY).alias("_level_key"), LEVEL)
    joined = df.drop(LEVEL).join(side, F.coalesce(KEY, F.lit("")) == F.col("_level_key"), "left")
    return joined.withColumn(LEVEL, F.coalesce(LEVEL, F.lit(default))).drop("_level_key")


# --- fit -----------------------------------------------------------------------


@dataclass(frozen=True)
class BoostedModel:
    """Trees in stages, each fitted to what the stages before it leave, with the levels of the series.

    ``errors``: mean absolute error of the stop rows after each round that was tried.
    """

    stages: tuple[GBTRegressionModel, ...]
    inputs: tuple[str, ...]
    levels: DataFrame
    default_level: float
    errors: tuple[float, ...] = ()

    @property
    def n_trees(self) -> int:
        return sum(s.getNumTrees for s in self.stages)


def assembler(inputs: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(inputs), outputCol="_features", handleInvalid="keep")


def boosted_trees(label: str, n_trees: int, stage: int = 0, spec: BoostSpec = BoostSpec()) -> GBTRegressor:
    return GBTRegressor(
        featuresCol="_features",
        labelCol=label,
        predictionCol=f"_part{stage}",
        maxIter=n_trees,
        stepSize=spec.learning_rate,
        maxDepth=spec.max_depth,
        minInstancesPerNode=spec.min_child_rows,
        subsamplingRate=spec.subsample,
        featureSubsetStrategy=str(spec.column_share),
        seed=spec.seed + stage,
        checkpointInterval=10,
    )


def best_round(errors: Sequence[float], patience: int) -> tuple[int, bool]:
    """Trees to keep by the error after each, and whether ``patience`` rounds without a lower one were seen after it."""
    best = 0
    for i, error in enumerate(errors):
        if error < errors[best]:
            best = i
        elif i - best >= patience:
            return best + 1, True
    return best + 1, False


def fit_boosted(train: DataFrame, target: str = TARGET, inputs: Sequence[str] | None = None, spec: BoostSpec = BoostSpec(), early_stop: bool = True, step: str = "hour") -> BoostedModel:
    """Fit on complete rows; the latest rows of each series only decide how many trees are kept.

    The trees kept end at the round of the least error of those rows that ``patience`` further rounds do not lower.
    Rounds come in stages. A stage goes on where the last one stopped: it is fitted to the residuals written after it and has just
    as many rounds as patience still asks for, so no tree is fitted again but those of a stage that is cut. As any MLlib fit,
    a stage begins with one tree of full weight; it counts, and is judged, like any other round. Small tables are written as one
    file, so a round is not made of tiny tasks.
    """
    columns = list(inputs or model_inputs(train, target))
    ensure_checkpoints(train.sparkSession)
    rows = drop_null_any(train.select(KEY, TS, target, *columns))
    stopping = early_stop and spec.stop_share > 0
    parts = split_ratio(rows, 1 - spec.stop_share, step).withColumn("_stop", F.col("split") == "validation").drop("split") if stopping else rows.withColumn("_stop", F.lit(False))
    parts = settle(parts, "train")
    levels = settle(series_levels(parts.filter("not _stop"), target), "levels")
    default = parts.filter("not _stop").agg(F.avg(target)).first()[0]
    if default is None:
        raise ValueError("no complete row to learn from")
    others = levels.select(F.col(KEY).alias("_level_key"), F.col(LEVEL).alias("_whole"), "_others")
    known = parts.join(others, F.coalesce(KEY, F.lit("")) == F.col("_level_key"), "left")
    own = F.coalesce(F.when(~F.col("_stop"), F.try_element_at("_others", _level_fold())), "_whole", F.lit(default))
    names = [*columns, LEVEL]
    known = known.withColumn(LEVEL, own).withColumn("_rest", F.col(target).cast("double"))
    tables = [settle(assembler(names).transform(known).select("_stop", "_features", "_rest").hint("rebalance"), "stage")]
    held = not tables[0].filter("_stop").isEmpty()

    stages, errors = [], []
    size = min(spec.patience, spec.n_trees) if held else spec.n_trees
    while True:
        table = tables[-1]
        stage = boosted_trees("_rest", max(1, size), len(stages), spec).fit(table.filter("not _stop"))
        stages.append(stage)
        if not held:
            break
        errors += stage.evaluateEachIteration(table.filter("_stop"), "absolute")
        kept, settled = best_round(errors, spec.patience)
        if settled or len(errors) >= spec.n_trees:
            stages = _cut(stages, tables, kept, spec)
            break
        rest = F.col("_rest") - F.col(stage.getPredictionCol())
        tables.append(settle(stage.transform(table).select("_stop", "_features", rest.alias("_rest")).hint("rebalance"), "stage"))
        size = min(kept + spec.patience, spec.n_trees) - len(errors)
    return BoostedModel(tuple(stages), tuple(names), levels, default, tuple(errors))


def _cut(stages: list[GBTRegressionModel], tables: list[DataFrame], kept: int, spec: BoostSpec) -> list[GBTRegressionModel]:
    """The stages of the first ``kept`` rounds. The last one is fitted again, shorter: a fit of fewer trees is the beginning of a longer one."""
    out = []
    for i, stage in enumerate(stages):
        if kept <= 0:
            break
        n = stage.getNumTrees
        out.append(stage if n <= kept else boosted_trees("_rest", kept, i, spec).fit(tables[i].filter("not _stop")))
        kept -= n
    return out


def predict(model: BoostedModel, df: DataFrame, target: str = TARGET, extra: Sequence[str] = ()) -> DataFrame:
    """``series_key, ts, actual, predicted, residual`` (plus ``extra`` columns), one row per row of ``df``.

    A row with an unknown input keeps a NULL prediction.
    """
    out = assembler(model.inputs).transform(attach_level(df, model.levels, model.default_level))
    for stage in model.stages:
        out = stage.transform(out)
    total = sum((F.col(s.getPredictionCol()) for s in model.stages[1:]), F.col(model.stages[0].getPredictionCol()))
    return _outcome(out.withColumn("predicted", F.when(_known(model), total)), target, extra)


def _known(model: BoostedModel):
    known = F.lit(True)
    for c in model.inputs:
        known = known & F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
    return known


def _outcome(scored: DataFrame, target: str, extra: Sequence[str]) -> DataFrame:
    residual = (F.col(target) - F.col("predicted")).alias("residual")
    return scored.select(KEY, TS, F.col(target).alias("actual"), "predicted", residual, *extra)


def train_improved(features: DataFrame, target: str = TARGET, ratio: float = 0.8, spec: BoostSpec = BoostSpec(), step: str = "hour", extra: Sequence[str] = ()) -> tuple[BoostedModel, DataFrame]:
    """Fit on the first ``ratio`` of complete rows; predictions of both parts carry their split."""
    inputs = model_inputs(features, target)
    parted = settle(split_ratio(drop_null_any(features), ratio, step), "parted", ("split",))
    model = fit_boosted(parted.filter("split = 'train'"), target, inputs, spec, step=step)
    return model, predict(model, parted, target, ["split", *extra])


# --- nodes ---------------------------------------------------------------------


def tree_nodes(model: BoostedModel, spark: SparkSession) -> DataFrame:
    """The model as rows ``stage, tree, weight, node, feature, threshold, left, right, value, gain, rows``; leaves have no feature.

    Read from the trees as MLlib writes them. Rows go left where the input is at most the threshold.
    """
    names, parts = F.array(*[F.lit(c) for c in model.inputs]), []
    for i, stage in enumerate(model.stages):
        path = fresh_folder(spark, "nodes")
        stage.write().overwrite().save(path)
        weights = spark.read.parquet(f"{path}/treesMetadata").toDF("tree", "about", "weight").select("tree", "weight")
        nodes = spark.read.parquet(f"{path}/data").select(F.col("treeID").alias("tree"), "nodeData.*").join(F.broadcast(weights), "tree")  # one row a tree
        inner = F.col("leftChild") >= 0
        parts.append(
            nodes.select(
                F.lit(i).alias("stage"), "tree", "weight", F.col("id").alias("node"),
                F.when(inner, F.get(names, F.col("split.featureIndex"))).alias("feature"),
                F.when(inner, F.get("split.leftCategoriesOrThreshold", F.lit(0))).alias("threshold"),
                F.when(inner, F.col("leftChild")).alias("left"), F.when(inner, F.col("rightChild")).alias("right"),
                F.col("prediction").alias("value"), F.when(inner, F.col("gain")).alias("gain"), F.get("impurityStats", F.lit(0)).alias("rows"),
            )
        )
    return settle(union_all(parts), "nodes")


def predict_from_nodes(nodes: DataFrame, model: BoostedModel, df: DataFrame, target: str = TARGET, extra: Sequence[str] = ()) -> DataFrame:
    """``predict`` by walking through the node table alone.

    The table goes to every task: at most ``n_trees`` times ``2 ** (max_depth + 1)`` rows, ten megabytes with the default parameters.
    """
    order = ["stage", "tree", "node"]
    table = nodes.orderBy(*order).select(*order, "weight", "feature", "threshold", "left", "right", "value").toArrow().combine_chunks()
    column = {c: table.column(c).to_numpy() for c in (*order, "weight", "value", "threshold")}
    place = {c: i for i, c in enumerate(model.inputs)}
    feature = np.array([place.get(x, -1) for x in table.column("feature").to_pylist()])
    first = np.flatnonzero(column["node"] == 0)
    base = np.repeat(first, np.diff(np.append(first, len(feature))))
    left, right = (np.nan_to_num(table.column(c).to_numpy().astype(float), nan=0).astype(np.int64) + base for c in ("left", "right"))
    kept = [KEY, TS, target, *extra]
    known = attach_level(df, model.levels, model.default_level)
    rows = known.select(*kept, F.when(_known(model), F.array(*[F.col(c).cast("double") for c in model.inputs])).alias("_x"))

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(len(kept))
            x = lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(place))
            total, every = np.zeros(len(x)), np.arange(len(x))
            for root in first:
                at = np.full(len(x), root)
                while True:
                    f = feature[at]
                    if (f < 0).all():
                        break
                    below = x[every, np.maximum(f, 0)] <= column["threshold"][at]
                    at = np.where(f < 0, at, np.where(below, left[at], right[at]))
                total += column["weight"][root] * column["value"][at]
            out = np.full(batch.num_rows, np.nan)
            has = ~np.asarray(lists.is_null())
            out[has] = total
            predicted = pa.array(out, mask=~has)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], predicted], names=[*kept, "predicted"])

    schema = rows.drop("_x").withColumn("predicted", F.lit(None).cast("double")).schema
    return _outcome(rows.mapInArrow(walk, schema), target, extra)


# --- importance --------------------------------------------------------------


def importance_from_nodes(nodes: DataFrame, inputs: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Share of each input in the gain of all splits, weighted by rows; inputs that split nothing have zero."""
    keys = list(by)
    gains = nodes.filter("feature is not null").groupBy(*keys, "feature").agg(F.sum(F.col("gain") * F.col("rows")).alias("gain"))
    groups = nodes.select(*keys).distinct() if keys else nodes.sparkSession.range(1).drop("id")
    every = groups.select(*keys, F.explode(F.array(*[F.lit(c) for c in inputs])).alias("feature"))
    total = Window.partitionBy(*(keys or [F.lit(1)]))  # some dozens of inputs
    share = F.coalesce(F.try_divide(F.col("gain"), F.sum("gain").over(total)), F.lit(0.0))
    return every.join(gains, [*keys, "feature"], "left").select(*keys, "feature", share.alias("importance"))


def feature_importance(model: BoostedModel, spark: SparkSession) -> DataFrame:
    """Normalised importance, one row per model input, over the nodes of all stages."""
    return importance_from_nodes(tree_nodes(model, spark), model.inputs)


def top_importance(importance: DataFrame, n: int = 10) -> DataFrame:
    return importance.orderBy(F.desc("importance"), "feature").limit(n)


def importance_share(importance: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` most important inputs as percentages of the total."""
    total = importance.agg(F.sum("importance")).scalar()
    return top_importance(importance.withColumn("importance_pct", F.col("importance") / total * 100), n)


# --- persistence -------------------------------------------------------------


def save_model(model: BoostedModel, path: str, metadata: dict[str, str], spark: SparkSession) -> None:
    """The trees, levels and, next to them, the metadata as JSON."""
    for i, stage in enumerate(model.stages):
        stage.write().overwrite().save(f"{path}/trees/{i}")
    model.levels.write.mode("overwrite").parquet(f"{path}/levels")
    about = {**metadata, "inputs": list(model.inputs), "stages": len(model.stages), "default_level": model.default_level, "errors": list(model.errors)}
    write_json(spark.createDataFrame([about], ", ".join([*(f"{c} string" for c in metadata), "inputs array<string>, stages int, default_level double, errors array<double>"])), f"{path}/metadata")


def load_model(path: str, spark: SparkSession) -> tuple[BoostedModel, dict]:
    about = spark.read.json(f"{path}/metadata").first().asDict()
    stages = tuple(GBTRegressionModel.load(f"{path}/trees/{i}") for i in range(about["stages"]))
    model = BoostedModel(stages, tuple(about["inputs"]), spark.read.parquet(f"{path}/levels"), about["default_level"], tuple(about.get("errors") or ()))
    return model, about


# --- stress ------------------------------------------------------------------


def missing_driver_stress(model: BoostedModel, test: DataFrame, target: str = TARGET, drivers: Sequence[str] = DRIVERS) -> DataFrame:
    """Metrics when one driver is replaced by its median (``replaced_by``), and the MAE change in percent.

    All scenarios are scored in one pass: each row appears once per scenario.
    """
    rows = drop_null_any(test)
    present = [d for d in drivers if d in rows.columns]
    cells = F.inline(F.array(*[F.struct(F.lit(d).alias("_driver"), F.col(d).alias("_value")) for d in present]))
    medians = exact_percentiles(rows.select(KEY, cells), "_value", [0.5], [KEY, "_driver"])
    stats = medians.groupBy(KEY).agg(*[F.max(F.when(F.col("_driver") == d, F.col("value"))).alias(f"_m_{d}") for d in present])
    names = ["baseline", *[f"missing_{d}" for d in present]]
    wide = attach_summary(rows, stats).withColumn("scenario", F.explode(F.array(*[F.lit(n) for n in names])))
    gone = {d: F.col("scenario") == f"missing_{d}" for d in present}
    wide = wide.withColumn("_median", F.coalesce(F.lit(None).cast("double"), *[F.when(gone[d], F.col(f"_m_{d}")) for d in present]))
    wide = wide.withColumns({d: F.when(gone[d], F.col("_median")).otherwise(F.col(d)) for d in present}).drop(*[f"_m_{d}" for d in present])
    scored = predict(model, wide, target, ["scenario", "_median"])
    metrics = scored.groupBy(KEY, "scenario").agg(*score_columns(F.col("actual"), F.col("predicted")), F.max("_median").alias("replaced_by"))
    # At most one row per scenario and series: the baseline is found inside the group.
    base = F.max(F.when(F.col("scenario") == "baseline", F.col("mae"))).over(Window.partitionBy(KEY))
    return metrics.withColumn("mae_degradation_pct", -improvement_pct(base, F.col("mae")))
