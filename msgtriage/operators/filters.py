"""Row / column filters on the wide label table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.ml.feature import StringIndexer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def label_sum(labels: Sequence[str]) -> Column:
    """Row-wise sum of label columns, NULL counted as 0 (as pandas' sum)."""
    return reduce(add, [F.coalesce(F.col(c), F.lit(0)) for c in labels])


def select_features(df: DataFrame, labels: Sequence[str], text: str = "message") -> DataFrame:
    """B1: key, text, genre and the label block; X and Y stay in one frame."""
    return df.select("id", text, "genre", *labels)


def drop_columns(df: DataFrame, *cols: str) -> DataFrame:
    """B2."""
    return df.drop(*cols)


def drop_related_two(df: DataFrame, label: str = "related") -> DataFrame:
    """Drop rows where ``label == 2`` (NULL rows are kept)."""
    return df.where(~F.col(label).eqNullSafe(2))


def drop_all_zero(df: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Drop rows whose labels sum to less than 1."""
    return df.where(label_sum(labels) >= 1)


def constant_labels(df: DataFrame, labels: Sequence[str]) -> list[str]:
    """B6 (detect): labels with fewer than two distinct non-NULL values.

    One pass of min/max per column (no count-distinct expansion); a column is
    constant when its min equals its max or it holds no value at all.
    """
    aggs = []
    for c in labels:
        aggs += [F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}")]
    row = df.agg(*aggs).first()
    return [
        c for c in labels
        if row[f"min_{c}"] is None or row[f"min_{c}"] == row[f"max_{c}"]
    ]


def drop_constant_labels(df: DataFrame, labels: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Drop constant label columns; returns the frame and the kept labels."""
    const = set(constant_labels(df, labels))
    kept = [c for c in labels if c not in const]
    return df.drop(*const), kept


def prepare_training(
    df: DataFrame,
    labels: Sequence[str],
    drop_all_zero_rows: bool = True,
    drop_related_2: bool = True,
    drop_constant: bool = True,
    related: str = "related",
) -> tuple[DataFrame, list[str]]:
    """Q6: all-zero rows, then ``related == 2``, then constant labels."""
    out = df
    if drop_all_zero_rows:
        out = drop_all_zero(out, labels)
    if drop_related_2 and related in labels:
        out = drop_related_two(out, related)
    kept = list(labels)
    if drop_constant:
        out, kept = drop_constant_labels(out, labels)
    return out, kept


def combined_label_values(df: DataFrame, a: str, b: str, name: str = "combined") -> DataFrame:
    """Distinct values of ``a + b``."""
    return df.select((F.col(a) + F.col(b)).alias(name)).distinct()


def rows_by_key(df: DataFrame, key_value, key: str = "id") -> DataFrame:
    """Row inspection by key."""
    return df.where(F.col(key) == F.lit(key_value))


def all_zero_rows(df: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Rows whose every label equals 0."""
    return df.where(F.forall(F.array(*[F.col(c) for c in labels]), lambda x: x == 0))


def null_rows(df: DataFrame, column: str) -> DataFrame:
    """Rows where ``column`` is NULL."""
    return df.where(F.col(column).isNull())


def genre_index_frame(df: DataFrame, column: str = "genre") -> DataFrame:
    """B9 mapping ``(value, index, n)``: most frequent first, ties by value.

    The same order as ``StringIndexer(stringOrderType='frequencyDesc')``. The
    window runs over the distinct values only (one row per category).
    """
    from pyspark.sql import Window

    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(
        F.count(F.lit(1)).alias("n")
    )
    w = Window.orderBy(F.desc("n"), F.col(column))
    return counts.select(
        column, (F.row_number().over(w) - 1).alias(f"{column}_index"), "n"
    )


def index_genre(df: DataFrame, column: str = "genre", one_hot: bool = False) -> DataFrame:
    """B9 with Spark ML: ``StringIndexer`` (optionally ``OneHotEncoder``)."""
    model = StringIndexer(
        inputCol=column, outputCol=f"{column}_index", stringOrderType="frequencyDesc",
        handleInvalid="keep",
    ).fit(df)
    out = model.transform(df)
    if one_hot:
        from pyspark.ml.feature import OneHotEncoder

        out = OneHotEncoder(inputCols=[f"{column}_index"], outputCols=[f"{column}_vec"]).fit(
            out
        ).transform(out)
    return out
