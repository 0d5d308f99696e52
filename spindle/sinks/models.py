"""Model persistence under the shared checkpoint folder."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession

from spindle.session import checkpoint_dir


def model_path(spark: SparkSession, name: str) -> str:
    root = checkpoint_dir(spark)
    if not root:
        raise ValueError("spark.checkpoint.dir is not set; pass an explicit model path")
    return f"{root.rstrip('/')}/models/{name}"


def save_model(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
