"""The training plan: split -> resample -> fit -> evaluate -> save."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from msgtriage.operators import metrics, models, sampling
from msgtriage.session import materialize


def train_and_evaluate(
    spark: SparkSession,
    data: DataFrame,
    labels: Sequence[str],
    upsample_targets: Sequence[str] = (),
    downsample_target: str | None = None,
    test_size: float = 0.2,
    seed: int = 42,
    feature_kind: str = "tfidf",
    clf_kind: str = "logistic",
    clf_params: dict | None = None,
    model_path: str | None = None,
) -> tuple[DataFrame, dict[str, float]]:
    """Hold-out report of the reference's canonical run.

    The test rows are split off first; resampling (several upsamples, then one
    negative resample, each exact-size and seeded) touches the training rows
    only; the fitted pipeline is optionally saved with its label list.
    Returns the per-label report (F9/F11) and the step timings (K14).
    """
    split = sampling.split_frame(data, (1 - test_size, test_size), ("train", "test"), "id", seed)
    split = materialize(split, "split")  # read by every step of the resampling, by the fit and by the report
    train = split.where(F.col("split") == "train").drop("split")
    test = split.where(F.col("split") == "test").drop("split")
    resampled = sampling.resample_training(
        train, upsample_targets, 0.9, downsample_target, 0.4, "id", 11
    )
    model, timings = models.fit_multilabel(
        resampled, labels, feature_kind, clf_kind, clf_params=clf_params or {"C": 0.01}
    )
    if model_path is not None:
        from msgtriage.sources.models import save_model

        save_model(model, model_path, list(labels))
    report = metrics.label_report(models.predict_long(model, test, labels, "id"))
    return report, timings
