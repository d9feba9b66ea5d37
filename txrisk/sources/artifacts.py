"""What scoring needs from training: the fitted preparation, the ordered feature names and the model."""

from __future__ import annotations

import json
from typing import NamedTuple
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.ml import Model, PipelineModel
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from txrisk.operators.prepare import Preparation
from txrisk.operators.sparse import SparsePreparation


class Artifacts(NamedTuple):
    fitted: Preparation | SparsePreparation
    manifest: list[str]
    model: Model | None
    feature_set: str = "B"


def save_artifacts(spark: SparkSession, path: str, artifacts: Artifacts) -> str:
    """Write a new version below ``path`` and return its id.

    The parts of a version share a folder of their own, and the list of versions gets it only when all are there: whoever
    loads meanwhile, or after a failure, gets the version before. Old versions stay.
    """
    version = uuid4().hex
    folder = f"{path}/{version}"
    if isinstance(artifacts.fitted, SparsePreparation):
        artifacts.fitted.index.write.parquet(f"{folder}/index")
        constants = artifacts.fitted.constants(spark)
    else:
        constants = artifacts.fitted.to_frame(spark)
    constants.coalesce(1).write.parquet(f"{folder}/preparation")
    names = spark.createDataFrame(
        [(i, name, artifacts.feature_set) for i, name in enumerate(artifacts.manifest)],
        "pos int, name string, feature_set string",
    )
    names.coalesce(1).write.parquet(f"{folder}/manifest")
    PipelineModel(stages=[artifacts.model]).write().save(f"{folder}/model")
    saved = spark.range(1).select(F.current_timestamp().alias("saved_at"), F.lit(version).alias("version"))
    saved.coalesce(1).write.mode("append").parquet(f"{path}/versions")
    return version


def load_artifacts(spark: SparkSession, path: str, version: str | None = None) -> Artifacts:
    """Read the latest version, or the given one; where a part does not exist, the error names it."""
    try:
        part = "versions"
        if version is None:
            version = spark.read.parquet(f"{path}/versions").agg(F.max_by("version", F.struct("saved_at", "version"))).first()[0]
        part = "preparation"
        saved = spark.read.parquet(f"{path}/{version}/preparation")
        sparse = json.loads(saved.first()["preparation"]).get("sparse")
        if sparse:
            part = "index"
            fitted = SparsePreparation.read(sparse, spark.read.parquet(f"{path}/{version}/index"))
        else:
            fitted = Preparation.from_frame(saved)
        part = "manifest"
        names = spark.read.parquet(f"{path}/{version}/manifest").orderBy(F.col("pos")).collect()
        part = "model"
        model = PipelineModel.load(f"{path}/{version}/model").stages[0]
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        raise FileNotFoundError(f"No {part} of the artifacts below {path}") from error
    return Artifacts(fitted, [r["name"] for r in names], model, names[0]["feature_set"])
