"""Save / load fitted pipelines together with their label names."""

from __future__ import annotations

import json
import os

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession


def save_model(model: PipelineModel, path: str, labels: list[str]) -> None:
    """Write the pipeline and a small JSON of label names next to it.

    The label list travels with the model, so predictions can always be
    named (no positional zip with a table's columns).
    """
    model.write().overwrite().save(os.path.join(path, "pipeline"))
    spark = SparkSession.getActiveSession()
    meta = spark.createDataFrame([(json.dumps({"labels": labels}),)], "value STRING")
    meta.coalesce(1).write.mode("overwrite").text(os.path.join(path, "labels"))


def load_model(spark: SparkSession, path: str) -> tuple[PipelineModel, list[str]]:
    model = PipelineModel.load(os.path.join(path, "pipeline"))
    row = spark.read.text(os.path.join(path, "labels")).first()
    return model, list(json.loads(row["value"])["labels"])
