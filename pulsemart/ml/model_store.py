"""The trained model with all that scoring another mart takes: categories, features in order, threshold."""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import DataFrame, SparkSession

from pulsemart.config import HealthConfig
from pulsemart.ml import training
from pulsemart.ml.features import churn_features
from pulsemart.sources.versions import Folder, Version


@dataclass(frozen=True)
class About:
    """``names`` are the entries of the feature vector, ``threshold`` the probability from which a tenant is flagged."""

    learner: str
    names: tuple[str, ...]
    threshold: float


@dataclass(frozen=True)
class ChurnModel:
    """From engineered columns to probabilities: fills, indexers, encoder, assembler, learner."""

    pipeline: PipelineModel
    about: About

    @property
    def learner(self) -> GBTClassificationModel:
        return self.pipeline.stages[-1]


def churn_model(
    learner: GBTClassificationModel, data: training.TrainingSet, cfg: HealthConfig = HealthConfig()
) -> ChurnModel:
    about = About(training.MODEL_NAME, tuple(data.names), cfg.churn_threshold)
    return ChurnModel(PipelineModel([*data.stages.stages, learner]), about)


def save_model(model: ChurnModel, path: str) -> None:
    """Replace the model at ``path``; until the new one is complete `load_model` finds the old one."""
    spark = SparkSession.active()
    folder = Folder(spark, path)
    before = folder.current() if folder.exists() else None
    name = f"model-{uuid.uuid4().hex}"
    model.pipeline.save(f"{folder.path}/{name}/pipeline")
    Folder(spark, f"{folder.path}/{name}").write("about.json", json.dumps(asdict(model.about)))
    folder.publish(Version(before.number + 1 if before else 1, folder=name))
    if before and before.folder:
        folder.delete_all([f"{folder.path}/{before.folder}"])


def load_model(path: str) -> ChurnModel:
    spark = SparkSession.active()
    version = Folder(spark, path).current()
    if version is None or version.folder is None:
        raise FileNotFoundError(f"{path}: no model was stored there")
    place = f"{path.rstrip('/')}/{version.folder}"
    about = json.loads(Folder(spark, place).read("about.json"))
    return ChurnModel(PipelineModel.load(f"{place}/pipeline"), About(**{**about, "names": tuple(about["names"])}))


def score_mart(model: ChurnModel, mart: DataFrame, cfg: HealthConfig = HealthConfig()) -> DataFrame:
    """Predictions for any tenant health mart, at the snapshot of ``cfg`` and the model's own threshold.

    Categories the model has not seen count as none of those it knows.
    """
    scored = training.score(model.pipeline, churn_features(mart, cfg))
    return training.predictions_of(scored, model.about.threshold)
