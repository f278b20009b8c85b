"""Profiling aggregates.

Wide statistics are computed in one pass (``df.agg`` with one aggregate per
column: partial aggregation per task, a single tiny final row) and only then
turned long with ``unpivot``; rows are never exploded per column first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from msgtriage.operators.filters import label_sum


def _one_row_to_long(row_df: DataFrame, names: Sequence[str], value: str, key: str = "label"):
    return row_df.unpivot([], list(names), key, value)


def _value_key(df: DataFrame, column: str):
    """What distinct counting needs of a value: for strings a 128-bit digest, so the rows that
    several distinct counts in one pass multiply hold no texts."""
    if df.schema[column].dataType.simpleString() == "string":
        return F.unhex(F.md5(F.col(column)))
    return F.col(column)


def distinct_counts(df: DataFrame, columns: Sequence[str] | None = None, approx: bool = False):
    """distinct non-NULL values per column -> ``(column_name, n_distinct)``.

    ``approx=True`` uses HyperLogLog++ (one pass, no per-column expansion),
    the right choice for very wide or very large inputs.
    """
    cols = list(columns or df.columns)
    if approx:
        row = df.agg(*[F.approx_count_distinct(F.col(c)).alias(c) for c in cols])
    else:
        row = df.agg(*[F.count_distinct(_value_key(df, c)).alias(c) for c in cols])
    return _one_row_to_long(row, cols, "n_distinct", "column_name")


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """NULL count per column -> ``(column_name, n_null)``."""
    cols = list(columns or df.columns)
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return _one_row_to_long(row, cols, "n_null", "column_name")


def column_info(df: DataFrame) -> DataFrame:
    """F1 + F2 + F8 in one scan: ``(position, column_name, dtype, non_null, n_null, n_distinct)``."""
    spark = df.sparkSession
    cols = df.columns
    aggs = []
    for c in cols:
        aggs += [
            F.count(F.col(c)).alias(f"nn__{c}"),
            F.count_if(F.col(c).isNull()).alias(f"nl__{c}"),
            F.count_distinct(_value_key(df, c)).alias(f"nd__{c}"),
        ]
    row = df.agg(*aggs)
    stacked = row.select(
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("column_name"),
                        F.col(f"nn__{c}").alias("non_null"),
                        F.col(f"nl__{c}").alias("n_null"),
                        F.col(f"nd__{c}").alias("n_distinct"),
                    )
                    for c in cols
                ]
            )
        ).alias("s")
    ).select("s.*")
    meta = spark.createDataFrame(
        [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)],
        "position INT, column_name STRING, dtype STRING",
    )
    return meta.join(F.broadcast(stacked), "column_name").select(
        "position", "column_name", "dtype", "non_null", "n_null", "n_distinct"
    )


def value_counts(df: DataFrame, column: str = "genre") -> DataFrame:
    """``(value, n)`` descending by count, ties by value; NULL excluded."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), F.col(column))
    )


def label_totals(df: DataFrame, labels: Sequence[str]) -> DataFrame:
    """``(label, total)`` sorted descending, ties by label name."""
    row = df.agg(*[F.sum(F.col(c)).cast("bigint").alias(c) for c in labels])
    return _one_row_to_long(row, labels, "total").orderBy(F.desc("total"), F.col("label"))


def label_prevalence(df: DataFrame, labels: Sequence[str]) -> DataFrame:
    """``(label, prevalence)`` = mean of each label, ascending."""
    row = df.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in labels])
    return _one_row_to_long(row, labels, "prevalence").orderBy("prevalence", "label")


def prevalence_change(before: DataFrame, after: DataFrame, labels: Sequence[str]) -> DataFrame:
    """prevalence before vs after a filter, joined on the label name."""
    b = label_prevalence(before, labels).withColumnRenamed("prevalence", "before")
    a = label_prevalence(after, labels).withColumnRenamed("prevalence", "after")
    return b.join(a, "label").orderBy("after", "label")


def label_count_histogram(df: DataFrame, labels: Sequence[str]) -> DataFrame:
    """``(n_labels, n_rows)`` histogram of the row-wise label sum."""
    return (
        df.select(label_sum(labels).alias("n_labels"))
        .groupBy("n_labels")
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .orderBy("n_labels")
    )


def shape_report(df: DataFrame, labels: Sequence[str], features: Sequence[str] = ("message",)):
    """``(n_rows, n_feature_cols, n_label_cols)``."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows",
        F.lit(len(features)).cast("int").alias("n_feature_cols"),
        F.lit(len(labels)).cast("int").alias("n_label_cols"),
    )


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct values of one column."""
    return df.select(column).distinct()


def head_rows(df: DataFrame, n: int = 5, order: Sequence[str] = ("id",)) -> DataFrame:
    """First ``n`` rows by a key (TakeOrderedAndProject, no full sort)."""
    return df.orderBy(*order).limit(n)
