"""Price regressors with Spark ML: definitions, comparison, importance."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Model, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import fixed_values as fv
from ..functions.numbers import round_half_up
from ..operators.cleaning import drop_unusable, require_columns
from ..operators.statistics import arg_max
from ..session import ensure_checkpoint_dir
from ..sources.tables import path_exists
from .boosting import Boosted, Setting, fit_all, forest, published_settings
from .metrics import regression_metrics
from .split import SEED, with_exact_folds, with_exact_split

MIN_FEATURES = 3
SPLIT_BINS = 256  # candidate values of a feature; a feature with fewer distinct values is split at any of them
ROWS_PER_TASK = 200_000  # of training rows; decides their partitions
LEAST_TASKS = 8


@dataclass(frozen=True)
class Learner:
    """A named way to fit a frame with columns `features` and `label`."""

    name: str
    fit: Callable[[DataFrame], Model]


def gradient_boosting(
    trees: int = 300, rate: float = 0.05, depth: int = 4, subsample: float = 0.85,
    columns: str = "all", name: str = "gbt", seed: int = SEED, bins: int = SPLIT_BINS,
) -> Learner:
    def fit(train: DataFrame) -> Model:
        ensure_checkpoint_dir(train.sparkSession)  # boosting grows lineage; the estimator cuts it there
        return GBTRegressor(
            featuresCol="features", labelCol="label", maxIter=trees, stepSize=rate, maxDepth=depth,
            subsamplingRate=subsample, featureSubsetStrategy=columns, checkpointInterval=10, seed=seed, maxBins=bins,
        ).fit(train)

    return Learner(name, fit)


def random_forest(
    trees: int = 200, depth: int = 6, seed: int = SEED, bins: int = SPLIT_BINS, bootstrap: bool = True
) -> Learner:
    def fit(train: DataFrame) -> Model:
        ensure_checkpoint_dir(train.sparkSession)
        return RandomForestRegressor(
            featuresCol="features", labelCol="label", numTrees=trees, maxDepth=depth,
            featureSubsetStrategy="all", checkpointInterval=10, seed=seed, maxBins=bins, bootstrap=bootstrap,
        ).fit(train)

    return Learner("random_forest", fit)


def ridge(alpha: float = 1.0) -> Learner:
    """Least squares with an L2 penalty of `alpha` on the sum of squares.

    The estimator averages the loss and scales the label by its deviation first, hence the conversion.
    """
    def fit(train: DataFrame) -> Model:
        n, spread = train.agg(F.count("label"), F.stddev_pop("label")).first()
        return LinearRegression(
            featuresCol="features", labelCol="label", elasticNetParam=0.0, standardization=False,
            solver="normal", regParam=alpha / n * spread,
        ).fit(train)

    return Learner("ridge", fit)


def default_learners(trees: int = 300, forest_trees: int = 200) -> list[Learner | Setting]:
    """The four compared models; boosted ones and the fits of a forest share their passes over the rows."""
    return [*published_settings(trees), forest(trees=forest_trees), ridge()]


def _cached(df: DataFrame) -> DataFrame:
    """Keep a frame with its column `_place` for many fits, spread by it.

    Row sampling is drawn by partition and position, so both must come from the data alone: the number of
    partitions from the number of rows, the place and order of a row from its content.  A model does not
    depend on the number of cores then.  The kept rows are computed again where an executor is lost.
    """
    tasks = max(LEAST_TASKS, -(-df.count() // ROWS_PER_TASK))
    kept = df.repartition(tasks, "_place").sortWithinPartitions("_place").drop("_place").persist(StorageLevel.MEMORY_AND_DISK)
    kept.count()
    return kept


def assembler(features: list[str]) -> VectorAssembler:
    if len(features) < MIN_FEATURES:
        raise ValueError(f"at least {MIN_FEATURES} features are needed")
    return VectorAssembler(inputCols=features, outputCol="features", handleInvalid="error")


def model_frame(df: DataFrame, features: list[str], target: str, keep: list[str]) -> DataFrame:
    """Usable rows as (keep..., features, label), and `_place`, a hash of their content."""
    usable = drop_unusable(require_columns(df, [*features, target]), [*features, target])
    typed = usable.select(
        *keep, *[F.col(c).cast("double").alias(f"_f{i}") for i, c in enumerate(features)],
        F.col(target).cast("double").alias("label"),
    )
    inputs = [f"_f{i}" for i in range(len(features))]
    placed = typed.withColumn("_place", F.xxhash64(*inputs, "label", *keep))
    return assembler(inputs).transform(placed).select(*keep, "features", "label", "_place")


@dataclass
class Comparison:
    scores: DataFrame  # ordinal, model, rows_train, rows_test, r2, mae, rmse, cv_r2, cv_std
    fold_scores: DataFrame  # model, fold, rows, r2
    models: dict[str, Model | Boosted]
    predictions: dict[str, DataFrame]  # on the test rows: label, prediction
    stages: DataFrame | None = None  # scores of the boosted models after every tree

    def best(self) -> str:
        return arg_max(self.scores, "cv_r2", "ordinal").first()["model"]


def compare(
    df: DataFrame,
    keys: list[str],
    learners: list[Learner | Setting] | None = None,
    features: list[str] | None = None,
    target: str = fv.TARGET,
    folds: int = 5,
    test_pct: int = 20,
    seed: int = SEED,
    parallelism: int = 1,
) -> Comparison:
    """Fit every learner on the training rows, score it on the test rows and by cross-validation.

    `parallelism` is how many fits of a learner run at a time, for data too small to fill the cluster.
    """
    spark = df.sparkSession
    names = features or fv.FEATURES
    chosen = learners or default_learners()
    ensure_checkpoint_dir(spark)
    usable = drop_unusable(require_columns(df, [*names, target]), [*names, target]).checkpoint()  # read by every count
    data = with_exact_folds(with_exact_split(usable, keys, test_pct, seed), keys, folds, seed)
    boosted, stages = _boosted(data, keys, [c for c in chosen if isinstance(c, Setting)], names, target, folds)
    split = data
    data = _cached(model_frame(data, names, target, ["is_test", "fold"]))
    train, test = data.filter(~F.col("is_test")), data.filter("is_test")
    score_rows, fold_rows, models, predictions = [], [], {}, {}
    pool = ThreadPool(parallelism)
    try:
        rows_train = train.count()
        for ordinal, learner in enumerate(chosen):
            if isinstance(learner, Setting):
                scores = boosted[learner.name]
                own = scores.pop(-1)
                score_rows.append((ordinal, learner.name, rows_train, own["rows"], *[round(own[m], 4) for m in ("r2", "mae", "rmse")]))
                fold_rows += [(learner.name, fold, r["rows"], r["r2"]) for fold, r in sorted(scores.items())]
                models[learner.name] = stages.models[learner.name, -1]
                test_rows = models[learner.name].transform(split.filter("is_test").withColumn("label", F.col(target).cast("double")))
                predictions[learner.name] = test_rows.select("label", "prediction")
                continue
            held_in = [train, *[data.filter(F.col("fold") != fold) for fold in range(folds)]]
            model, *by_fold = pool.map(inheritable_thread_target(spark)(learner.fit), held_in)
            predicted = model.transform(test).select("label", "prediction")
            held_out = regression_metrics(predicted, "label", "prediction").first()
            parts = [
                fitted.transform(data.filter(F.col("fold") == fold)).select("fold", "label", "prediction")
                for fold, fitted in enumerate(by_fold)
            ]
            scored = regression_metrics(reduce(DataFrame.unionByName, parts), "label", "prediction", ["fold"], digits=12)
            per_fold = scored.orderBy("fold").collect()  # one row per fold
            fold_rows += [(learner.name, r["fold"], r["rows"], r["r2"]) for r in per_fold]
            score_rows.append(
                (ordinal, learner.name, rows_train, held_out["rows"], held_out["r2"], held_out["mae"], held_out["rmse"])
            )
            models[learner.name] = model
            predictions[learner.name] = predicted
    finally:
        pool.close()
        data.unpersist()

    fold_scores = spark.createDataFrame(fold_rows, "model string, fold int, rows bigint, r2 double")
    cv = fold_scores.groupBy("model").agg(
        round_half_up(F.avg("r2"), 4).alias("cv_r2"), round_half_up(F.stddev_pop("r2"), 4).alias("cv_std")
    )
    scores = spark.createDataFrame(
        score_rows,
        "ordinal int, model string, rows_train bigint, rows_test bigint, r2 double, mae double, rmse double",
    )
    return Comparison(scores.join(F.broadcast(cv), "model"), fold_scores, models, predictions, stages.stages if stages else None)


def _boosted(data: DataFrame, keys: list[str], settings: list[Setting], features: list[str], target: str, folds: int):
    """Final scores by setting and fold (-1: the test rows), and all that was fitted."""
    if not settings:
        return {}, None
    fitted = fit_all(data, features, target, settings, F.col("fold"), folds, F.col("is_test"), keys)
    final = {s.name: s.trees for s in settings}
    scores: dict[str, dict] = {name: {} for name in final}
    for row in fitted.stages.collect():  # a row for each tree and fold
        if row["trees"] == final[row["setting"]]:
            scores[row["setting"]][row["fold"]] = row
    return scores, fitted


def fit_one(
    df: DataFrame, learner: Learner, features: list[str] | None = None, target: str = fv.TARGET
) -> Model:
    """Fit one learner on all usable rows."""
    data = _cached(model_frame(df, features or fv.FEATURES, target, []))
    try:
        return learner.fit(data)
    finally:
        data.unpersist()


def importance(df: DataFrame, model: Model | Boosted, features: list[str], labels: dict[str, str] | None = None) -> DataFrame:
    """(feature, label, importance, importance_pct), largest first."""
    fitted = model.stages[-1] if isinstance(model, PipelineModel) else model
    if isinstance(model, Boosted):
        shares = model.importance()
        weights = np.array([shares[f] for f in features])
    elif hasattr(fitted, "featureImportances"):
        weights = fitted.featureImportances.toArray()
    else:
        weights = abs(fitted.coefficients.toArray())
    total = float(weights.sum()) or 1.0
    titles = labels if labels is not None else fv.FEATURE_LABELS
    rows = [(f, titles.get(f, f), float(w), float(w) / total * 100) for f, w in zip(features, weights)]
    table = df.sparkSession.createDataFrame(rows, "feature string, label string, importance double, pct double")
    return table.select("feature", "label", "importance", round_half_up("pct", 1).alias("importance_pct")).orderBy(
        F.desc("importance"), "feature"
    )


def as_pipeline(model: Model | Boosted, features: list[str]) -> PipelineModel | Boosted:
    """The model with its own assembler, ready to save and to score named columns; a boosted one names its columns itself."""
    return model if isinstance(model, Boosted) else PipelineModel(stages=[assembler(features), model])


def needed_columns(model: PipelineModel | Boosted) -> list[str]:
    """The columns that a model reads."""
    if isinstance(model, Boosted):
        return model.features
    return [c for stage in model.stages if stage.hasParam("inputCols") for c in stage.getInputCols()]


def save_model(model: PipelineModel | Boosted, path: str, spark: SparkSession | None = None) -> None:
    """Replace the stored model; a boosted one is one line of JSON, of a size given by its trees."""
    if isinstance(model, Boosted):
        session = spark or SparkSession.active()
        session.createDataFrame([(model.to_json(),)], "value string").coalesce(1).write.mode("overwrite").text(path)
    else:
        model.write().overwrite().save(path)


def load_model(spark: SparkSession, path: str) -> PipelineModel | Boosted:
    if path_exists(spark, f"{path}/metadata"):
        return PipelineModel.load(path)
    return Boosted.from_json(spark.read.text(path).first()["value"])
