"""Tree learners on the feature matrix: presets, fitting, validation, scoring."""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from itertools import chain, islice
from multiprocessing.pool import ThreadPool
from typing import Any

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.util import inheritable_thread_target

from acreline.errors import DataValidationError
from acreline.functions.metrics import SUPPORTED, check_metrics
from acreline.operators.boosting import HistogramBoosting
from acreline.operators.checks import check_choice, require_columns, require_rows
from acreline.operators.evaluate import HIGHER_IS_BETTER, QUALITY_THRESHOLD, evaluate
from acreline.operators.features import FeatureSpec, TabularFeatures, TabularFeaturesModel
from acreline.operators.keys import stable_layout
from acreline.operators.split import fold_parts, kfold, random_split, stratified_split
from acreline.session import beside, ensure_checkpoint_dir

VALIDATION_MODES = ("single_split", "cross_validation")

# The tuned settings of the three learners, as far as Spark ML has the setting.
# A learning rate goes with its number of rounds; fewer rounds need a higher one (see ``shorten``).
PRESETS: dict[str, dict[str, Any]] = {
    "random_forest": {
        "numTrees": 200,
        "maxDepth": 30,
        "featureSubsetStrategy": "sqrt",
        "minInstancesPerNode": 1,
        "bootstrap": True,
    },
    "boosted_trees": {
        "maxIter": 1188,
        "maxDepth": 9,
        "stepSize": 0.019655684599424853,
        "subsamplingRate": 0.8827429375390468,
        "featureSubsetStrategy": "0.7693605922825478",
        "minInstancesPerNode": 3,
        "lossType": "squared",
    },
    "boosted_trees_leafy": {
        "maxIter": 1000,
        "maxDepth": 7,
        "stepSize": 0.013057771348997228,
        "subsamplingRate": 0.7483273008793065,
        "featureSubsetStrategy": "0.7433862914177091",
        "minInstancesPerNode": 18,
        "lossType": "squared",
    },
}

# The same settings with those that only ``boosting`` has (penalties, rows and columns drawn for a tree,
# number of leaves). The leaf-wise learner names a row share, but no rounds between draws, so none are drawn.
BOOSTING_PRESETS: dict[str, dict[str, Any]] = {
    "regularised_boosting": {
        "rounds": 1188,
        "depth": 9,
        "rate": 0.019655684599424853,
        "row_share": 0.8827429375390468,
        "column_share": 0.7693605922825478,
        "child_rows": 3,
        "gamma": 0.19744075908778486,
        "l2": 1.0,
    },
    "leafwise_boosting": {
        "rounds": 1000,
        "depth": 11,
        "leaves": 91,
        "rate": 0.013057771348997228,
        "row_share": 0.7483273008793065,
        "row_every": 0,
        "column_share": 0.7433862914177091,
        "child_rows": 18,
        "l1": 0.4494506741382034,
        "l2": 0.09541011649041131,
    },
}
ALL_PRESETS = PRESETS | BOOSTING_PRESETS

_BUILDERS: dict[str, Callable[..., Any]] = {
    "random_forest": RandomForestRegressor,
    "boosted_trees": GBTRegressor,
    "boosted_trees_leafy": GBTRegressor,
}


def shorten(name: str, rounds: int, max_depth: int | None = None) -> dict[str, Any]:
    """A preset with fewer trees or rounds; the learning rate grows so that rate x rounds is kept
    (at most 0.3)."""
    check_choice(name, ALL_PRESETS, "model")
    settings = dict(ALL_PRESETS[name])
    if name in BOOSTING_PRESETS:
        settings |= {"rounds": rounds, "rate": min(0.3, settings["rate"] * settings["rounds"] / rounds)}
        return settings | ({"depth": min(max_depth, settings["depth"])} if max_depth else {})
    if "numTrees" in settings:
        settings["numTrees"] = rounds
    else:
        total = settings["stepSize"] * settings["maxIter"]
        settings |= {"maxIter": rounds, "stepSize": min(0.3, total / rounds)}
    if max_depth:
        settings["maxDepth"] = min(max_depth, settings["maxDepth"])
    return settings


def build_regressor(name: str, settings: Mapping[str, Any] | None = None, seed: int = 42, label: str = "median_house_value"):
    """The learner behind a model name. Spark grows trees to depth 30 at most."""
    check_choice(name, ALL_PRESETS, "model")
    if name in BOOSTING_PRESETS:
        chosen = BOOSTING_PRESETS[name] if settings is None else settings
        return HistogramBoosting(labelCol=label, keyCol="row_key", settings=dict(chosen), seed=seed)
    values = dict(PRESETS[name] if settings is None else settings)
    values["maxDepth"] = min(int(values.get("maxDepth") or 30), 30)
    # Carrying node ids along pays off only where trees are deep enough to be costly to walk. Such trees have so many open
    # nodes that every task holds sums of this size.
    deep = values["maxDepth"] > 12
    learner = _BUILDERS[name](
        featuresCol="features", labelCol=label, predictionCol="prediction", seed=seed, maxMemoryInMB=256 if deep else 1024
    )
    return learner.setParams(**values, cacheNodeIds=deep, checkpointInterval=10)


@dataclass
class Training:
    """What to train and how. ``id_cols`` must name a key of the table."""

    label: str = "median_house_value"
    stratum: str | None = "stratum"
    id_cols: tuple[str, ...] = ("district_id",)
    spec: FeatureSpec = field(default_factory=FeatureSpec)
    metrics: tuple[str, ...] = SUPPORTED
    seed: int = 42
    validation: str = "single_split"
    val_size: float = 0.25
    folds: int = 5
    threshold: float = QUALITY_THRESHOLD

    def __post_init__(self) -> None:
        check_choice(self.validation, VALIDATION_MODES, "validation")
        check_metrics(self.metrics)

    def no_features(self, df: DataFrame) -> list[str]:
        helpers = [*self.id_cols, *([self.stratum] if self.stratum else []), "part", "fold", "val_part"]
        return [c for c in helpers if c in df.columns]


@dataclass
class Prepared:
    """Learned features and the kept training matrix (features, label, row_key); any number of learners can be fitted on it."""

    features: TabularFeaturesModel
    assembler: VectorAssembler
    table: DataFrame

    def release(self) -> None:
        self.table.unpersist()


def prepare(df: DataFrame, training: Training) -> Prepared:
    """Learn the features on ``df`` and keep (features, label) in a layout that depends on the rows
    alone."""
    require_rows(df, "training data")
    require_columns(df, [training.label, *training.id_cols])
    features = TabularFeatures(
        spec=training.spec, labelCol=training.label, dropCols=training.no_features(df), seed=training.seed
    ).fit(df)
    assembler = VectorAssembler(inputCols=features.feature_names(), outputCol="features")
    if training.id_cols:
        # the inputs travel, a fraction of the matrix, and the features are made where they arrive
        laid = stable_layout(df, training.id_cols)
        matrix, key = features.select_features(laid, *training.id_cols, training.label), F.xxhash64(*training.id_cols)
        table = assembler.transform(matrix).select("features", training.label, key.alias("row_key"))
    else:
        matrix = assembler.transform(features.select_features(df, training.label))
        laid = stable_layout(matrix.select("features", training.label), training.id_cols)
        table = laid.select("features", training.label, F.xxhash64("features", training.label).alias("row_key"))
    return Prepared(features, assembler, table.persist(StorageLevel.MEMORY_AND_DISK))


def fit_on(
    prepared: Prepared, name: str, training: Training, settings: Mapping[str, Any] | None = None
) -> PipelineModel:
    """Features and learner as one saveable object."""
    ensure_checkpoint_dir(prepared.table.sparkSession)
    learner = build_regressor(name, settings, training.seed, training.label).fit(prepared.table)
    return PipelineModel([prepared.features, prepared.assembler, learner])


def fit_many(
    prepared: Sequence[Prepared], name: str, training: Training, settings: Mapping[str, Any] | None = None
) -> list[PipelineModel]:
    """A model for each matrix, all at the same time: the same models as one after another.

    Boosting makes one job of the matrices that a task can hold, a task a model. The other learners run their jobs from
    threads of the driver, so that the short stages of one fit fill the gaps of another.
    """
    ensure_checkpoint_dir(prepared[0].table.sparkSession)
    if name in BOOSTING_PRESETS:
        learner = build_regressor(name, settings, training.seed, training.label)
        fitted = learner.fit_all([p.table for p in prepared])
        return [PipelineModel([p.features, p.assembler, m]) for p, m in zip(prepared, fitted)]
    return _at_once([lambda p=p: fit_on(p, name, training, settings) for p in prepared])


def _at_once(steps: Sequence[Callable[[], Any]]) -> list[Any]:
    """Results of independent steps, each of which starts Spark jobs."""
    spark = SparkSession.active()
    with ThreadPool(len(steps)) as pool:
        return pool.map(lambda step: inheritable_thread_target(spark)(step)(), steps, chunksize=1)


def fit_full(
    df: DataFrame, name: str, training: Training, settings: Mapping[str, Any] | None = None
) -> PipelineModel:
    """Features and learner fitted on ``df``."""
    prepared = prepare(df, training)
    try:
        return fit_on(prepared, name, training, settings)
    finally:
        prepared.release()


def predict(model: PipelineModel, df: DataFrame, out: str = "prediction") -> DataFrame:
    """The input columns and the prediction; map-only."""
    scored = model.transform(df)
    return scored.select(*[F.col(f"`{c}`") for c in df.columns], F.col("prediction").alias(out))


def score(model: PipelineModel, df: DataFrame, set_name: str, training: Training) -> dict[str, float]:
    return evaluate(predict(model, df), set_name, training.label, "prediction", training.metrics)


def validation_sets(train: DataFrame, training: Training) -> Iterator[tuple[str, DataFrame, DataFrame]]:
    """(name, rows to fit on, rows to score) of the holdout or of every fold.

    Learning scans these rows a dozen times, and finding a row's side takes its digest: they are kept until the last
    one is done with (or the iterator closed).
    """
    if training.validation == "single_split":
        split = stratified_split if training.stratum else random_split
        keys = {"stratum": training.stratum} if training.stratum else {}
        parted = split(
            train, id_cols=training.id_cols, test_size=training.val_size, seed=training.seed,
            salt="val", part_col="val_part", names=("fit", "val"), **keys,
        ).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            yield "validation", parted.filter("val_part = 'fit'"), parted.filter("val_part = 'val'")
        finally:
            parted.unpersist()
        return
    folded = kfold(train, training.folds, training.stratum, training.id_cols, training.seed)
    folded = folded.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for fold in range(training.folds):
            yield f"validation_fold_{fold + 1}", *fold_parts(folded, fold)
    finally:
        folded.unpersist()


def validation_scores(
    train: DataFrame, name: str, training: Training, settings: Mapping[str, Any] | None = None, at_once: bool = False
) -> list[dict[str, float]]:
    """One set of metrics per holdout or fold; features are learned again inside each of them. ``at_once`` works on all
    folds at the same time, which needs room for all their matrices; the scores are the same."""
    if at_once:
        source, prepared = validation_sets(train, training), []
        sets = list(islice(source, training.folds if training.validation == "cross_validation" else 1))
        try:
            prepared = _at_once([lambda rows=rows: prepare(rows, training) for _, rows, _ in sets])
            fitted = fit_many(prepared, name, training, settings)
            return _at_once([lambda m=m, s=s: score(m, s[2], s[0], training) for m, s in zip(fitted, sets)])
        finally:
            for p in prepared:
                p.release()
            source.close()
    return _scores(validation_sets(train, training), name, training, settings)


def _scores(
    sets: Iterable[tuple[str, DataFrame, DataFrame]], name: str, training: Training, settings: Mapping[str, Any] | None
) -> list[dict[str, float]]:
    scores = []
    for set_name, fit_rows, val_rows in sets:
        model = fit_full(fit_rows, name, training, settings)
        scores.append(score(model, val_rows, set_name, training))
    return scores


def summarize(scores: Sequence[Mapping[str, float]]) -> dict[str, float]:
    """Mean and population deviation of a handful of fold scores."""
    summary = {}
    for metric in scores[0] if scores else ():
        values = [s[metric] for s in scores]
        mean = sum(values) / len(values)
        summary[f"validation_mean_{metric}"] = mean
        summary[f"validation_std_{metric}"] = (sum((v - mean) ** 2 for v in values) / len(values)) ** 0.5
    return summary


def gate(summary: Mapping[str, float], training: Training) -> None:
    """Stop when the first metric is on the wrong side of the threshold."""
    metric = training.metrics[0]
    value = summary[f"validation_mean_{metric}"]
    bad = value < training.threshold if metric in HIGHER_IS_BETTER else value > training.threshold
    if bad or value != value:
        raise DataValidationError(f"quality gate failed: {metric} {value} against {training.threshold}")


def train(
    train_rows: DataFrame, name: str, training: Training, settings: Mapping[str, Any] | None = None
) -> tuple[PipelineModel, dict[str, float]]:
    """Validate, pass the gate, fit again on all training rows.

    The features of all training rows do not depend on the validation, whose short stages leave room: they are learned
    beside it, once the rows have been read for its split. The matrix is made after the gate.
    """
    sets = validation_sets(train_rows, training)
    try:
        first = next(sets)
        with beside(train_rows.sparkSession, lambda: prepare(train_rows, training)) as ready:
            summary = summarize(_scores(chain([first], sets), name, training, settings))
            gate(summary, training)
            prepared = ready()
    finally:
        sets.close()
    try:
        return fit_on(prepared, name, training, settings), summary
    finally:
        prepared.release()


def save_model(model: PipelineModel, path: str, example: DataFrame, id_cols: Sequence[str] = ()) -> None:
    """The fitted object, the input schema and a five-row example, side by side."""
    spark = example.sparkSession
    model.write().overwrite().save(os.path.join(path, "model"))
    order = list(id_cols) or example.columns[:1]
    rows = example.orderBy(*order).limit(5)
    rows.write.mode("overwrite").parquet(os.path.join(path, "example"))
    schema = spark.createDataFrame([(json.dumps(example.schema.jsonValue()),)], "schema string")
    schema.coalesce(1).write.mode("overwrite").text(os.path.join(path, "schema"))


def load_model(spark: Any, path: str) -> tuple[PipelineModel, T.StructType]:
    """The fitted object and the schema of its input."""
    text = spark.read.text(os.path.join(path, "schema")).first()["value"]
    return PipelineModel.load(os.path.join(path, "model")), T.StructType.fromJson(json.loads(text))
