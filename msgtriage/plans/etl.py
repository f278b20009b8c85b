"""ETL and dashboard plans over the reference-shaped fixtures."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from msgtriage.operators.filters import prepare_training
from msgtriage.operators.ingest import clean_messages
from msgtriage.operators.profile import label_totals, value_counts
from msgtriage.plans.fixtures import categories_fx, messages_fx
from msgtriage.session import input_version, materialize_once


def clean_table(
    spark: SparkSession, sf_dir: str, labels: list[str] | None = None
) -> tuple[DataFrame, list[str]]:
    """T1 + T2 -> T3 (join, unpack, keep first per id, drop NULL related)."""
    return clean_messages(messages_fx(spark, sf_dir), categories_fx(spark, sf_dir), labels)


def stored_clean_table(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[str]]:
    """The clean table as the training side sees it: written once (A4) to the
    shared folder and read back (A3), as the reference's ETL writes its table
    and training loads it. Downstream plans make several passes (label
    checks, split counts, resampling); they read the stored Parquet instead
    of re-running the join and de-duplication each time. The table is written on
    the first use in a session and read by every later query on the same input files."""
    version = input_version(spark, [f"{sf_dir}/{t}.parquet" for t in ("documents", "labels")])
    stored = materialize_once(spark, "clean-table", version, lambda: clean_table(spark, sf_dir)[0])
    return stored, [c for c in stored.columns if c not in ("id", "message", "genre")]


def training_table(
    spark: SparkSession, sf_dir: str, drop_constant: bool = True
) -> tuple[DataFrame, list[str]]:
    """T3 after the training filters (all-zero rows, ``related == 2``, constant labels)."""
    clean, labels = stored_clean_table(spark, sf_dir)
    return prepare_training(clean, labels, drop_constant=drop_constant)


def dashboard(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The two dashboard aggregates: genre counts (F3) and label totals."""
    train, labels = training_table(spark, sf_dir)
    return value_counts(train, "genre"), label_totals(train, labels)
