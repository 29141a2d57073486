"""Churn model: stratified folds, gradient-boosted trees, cross-validation, outputs."""

from __future__ import annotations

from dataclasses import dataclass, replace
from math import ceil
from multiprocessing.pool import ThreadPool
from statistics import fmean, pstdev

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsemart.config import HealthConfig
from pulsemart.ml import metrics
from pulsemart.ml.features import categories, churn_features, feature_names, feature_stages
from pulsemart.operators.ranking import row_numbers
from pulsemart.session import cut_lineage, shared_folder

MODEL_NAME = "GBTClassifier"


@dataclass(frozen=True)
class TreeParams:
    """Settings of the published model and of its leaky comparison run."""

    trees: int = 300
    depth: int = 4
    learning_rate: float = 0.05
    row_sample: float = 0.8
    column_sample: str = "0.8"
    weighted: bool = True
    seed: int = 42


LEAKY_PARAMS = TreeParams(trees=100, learning_rate=0.1, row_sample=1.0, column_sample="all")

# Entries of feature vectors in a task of boosting, 40 MB in bins. Every level of every tree is a job: smaller
# tasks take longer to start and to report than to compute, and the driver receives a report from each.
TASK_ENTRIES = 10_000_000

KEEP = (
    "tenant_id",
    "company_name",
    "plan",
    "arr",
    "churned",
    "renewal_date",
    "days_to_renewal",
    "health_score",
    "health_tier",
)


@dataclass(frozen=True)
class TrainingSet:
    """Rows with ``features``, ``label`` and ``weight``, plus the name of every feature, the
    pipeline that makes ``features`` and the number of tasks that boosting spreads the rows over."""

    rows: DataFrame
    names: list[str]
    stages: PipelineModel
    tasks: int


def training_set(
    mart: DataFrame, cfg: HealthConfig = HealthConfig(), include_leaky: bool = False
) -> TrainingSet:
    """Assemble and materialise the rows: boosting reads them once per tree."""
    pairs = categories(mart)
    engineered = churn_features(mart, cfg)
    stages = feature_stages(engineered, pairs, include_leaky)
    assembled = stages.transform(engineered)
    labelled = assembled.select(*KEEP, "features", F.col("churned").cast("int").alias("label"))
    rows = cut_lineage(stratified_folds(labelled, cfg))
    balance = metrics.class_balance(rows).first()
    weight = balance.scale_pos_weight or 1.0
    weighted = rows.withColumn("weight", F.when(F.col("label") == 1, weight).otherwise(1.0))
    names = feature_names(pairs, include_leaky)
    return TrainingSet(weighted, names, stages, max(1, ceil(balance.n * len(names) / TASK_ENTRIES)))


def stratified_folds(labelled: DataFrame, cfg: HealthConfig = HealthConfig()) -> DataFrame:
    """``fold`` 0..k-1, shuffled by a seeded hash, sizes per label differing by at most one."""
    hashed = labelled.withColumn("hashed", F.xxhash64("tenant_id", F.lit(cfg.seed)))
    numbered = row_numbers(hashed, "label", "hashed")
    return numbered.withColumn("fold", ((F.col("row_number") - 1) % cfg.folds).cast("int")).drop(
        "hashed", "row_number"
    )


def _learner(params: TreeParams) -> GBTClassifier:
    learner = GBTClassifier(
        featuresCol="features",
        labelCol="label",
        maxIter=params.trees,
        maxDepth=params.depth,
        stepSize=params.learning_rate,
        subsamplingRate=params.row_sample,
        featureSubsetStrategy=params.column_sample,
        seed=params.seed,
    )
    return learner.setWeightCol("weight") if params.weighted else learner


def train_churn_model(data: TrainingSet, params: TreeParams = TreeParams()) -> GBTClassificationModel:
    shared_folder(data.rows.sparkSession)  # boosting checkpoints its residuals there
    return _learner(params).fit(learning_rows(data))


def learning_rows(data: TrainingSet) -> DataFrame:
    """The rows dealt evenly over the tasks of boosting, whatever the files they are stored in.

    Rows are drawn by their place in a task, so the order there is fixed too.
    """
    order = ("tenant_id", "arr", "renewal_date", "label", "fold")
    needed = data.rows.select(*order, "features", "weight")
    return needed.repartition(data.tasks).sortWithinPartitions(*order)


def score(model: GBTClassificationModel, rows: DataFrame) -> DataFrame:
    return model.transform(rows).withColumn("score", vector_to_array("probability")[1])


def fold_quality(data: TrainingSet, params: TreeParams, folds: int, parallel: int = 5) -> list[tuple[float, float]]:
    """(ROC-AUC, average precision) per held-out fold; folds are fitted side by side."""

    def one(fold: int) -> tuple[float, float]:
        learn = replace(data, rows=data.rows.where(F.col("fold") != fold))
        held_out = data.rows.where(F.col("fold") == fold)
        row = metrics.ranking_quality(score(train_churn_model(learn, params), held_out)).first()
        return row.roc_auc, row.average_precision

    session = data.rows.sparkSession
    with ThreadPool(min(parallel, folds)) as pool:
        return pool.map(inheritable_thread_target(session)(one), range(folds))


def _mean_std(values: list[float]) -> tuple[float, float]:
    known = [v for v in values if v is not None]
    return (fmean(known), pstdev(known)) if known else (float("nan"), float("nan"))


def cross_validate_churn(
    data: TrainingSet, cfg: HealthConfig = HealthConfig(), params: TreeParams = TreeParams()
) -> DataFrame:
    """Mean and population deviation over the folds, one row."""
    quality = fold_quality(data, params, cfg.folds)
    auc, precision = _mean_std([q[0] for q in quality]), _mean_std([q[1] for q in quality])
    return data.rows.sparkSession.createDataFrame(
        [(*auc, *precision)],
        "cv_roc_auc_mean DOUBLE, cv_roc_auc_std DOUBLE, "
        "cv_avg_precision_mean DOUBLE, cv_avg_precision_std DOUBLE",
    )


def leakage_check(
    mart: DataFrame, cfg: HealthConfig = HealthConfig(), params: TreeParams = LEAKY_PARAMS
) -> DataFrame:
    """Cross-validated ROC-AUC with the leaky feature: an inflated figure, for comparison only."""
    leaky = training_set(mart, cfg, include_leaky=True)
    auc, _ = _mean_std([q[0] for q in fold_quality(leaky, params, cfg.folds)])
    return mart.sparkSession.createDataFrame([(auc,)], "leaky_cv_roc_auc DOUBLE")


def churn_predictions(
    model: GBTClassificationModel, data: TrainingSet, cfg: HealthConfig = HealthConfig()
) -> DataFrame:
    """The flag looks at the probability before it is rounded for storage."""
    return predictions_of(score(model, data.rows), cfg.churn_threshold)


def predictions_of(scored: DataFrame, threshold: float) -> DataFrame:
    return scored.select(
        *KEEP,
        F.bround("score", 4).alias("churn_probability"),
        (F.col("score") >= threshold).cast("int").alias("churn_flag"),
    ).orderBy(F.col("churn_probability").desc(), "tenant_id")


def feature_importance(model: GBTClassificationModel, names: list[str], spark: SparkSession) -> DataFrame:
    """One row per feature of the model; the length of a vector, whatever the data size."""
    rows = list(zip(names, (float(v) for v in model.featureImportances.toArray())))
    return spark.createDataFrame(rows, "feature STRING, importance DOUBLE").orderBy(
        F.col("importance").desc(), "feature"
    )


def model_metrics(
    model: GBTClassificationModel,
    data: TrainingSet,
    validation: DataFrame,
    cfg: HealthConfig = HealthConfig(),
) -> DataFrame:
    """One row: cross-validated quality, and in-sample outcomes at the threshold."""
    quality = validation.first()
    return metrics.outcome_summary(score(model, data.rows), cfg.churn_threshold).select(
        F.lit(MODEL_NAME).alias("model"),
        *[F.lit(quality[c]).cast("double").alias(c) for c in validation.columns],
        F.lit(cfg.churn_threshold).alias("decision_threshold"),
        F.col("tp").alias("true_positives"),
        F.col("fp").alias("false_positives"),
        F.col("fn").alias("false_negatives"),
        F.col("tn").alias("true_negatives"),
        "arr_correctly_flagged",
        "arr_missed",
    )


def load_model(path: str) -> GBTClassificationModel:
    """The learner alone of a model that `model_store` saved."""
    from pulsemart.ml import model_store

    return model_store.load_model(path).learner
