"""Readers and writers.

CSV inputs are read with explicit schemas (no inference pass), multi-line
quoted fields allowed. Tables are Parquet (predicate pushdown, column pruning,
optional ``partitionBy`` for partition pruning). Writes are drop-and-replace.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from msgtriage.schema import CATEGORIES_SCHEMA, MESSAGES_SCHEMA, clean_schema
from msgtriage.sources import csv_blocks


# Texts come back as they were: blanks at either end stay, an empty string is written
# as "" and a NULL as nothing between the separators.
CSV_TEXT = {"escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
# A blank field is read as the NULL mark, a character no message holds, so "" stays a string.
CSV_READ = {**CSV_TEXT, "nullValue": "\x01", "emptyValue": ""}
CSV_WRITE = {**CSV_TEXT, "nullValue": "", "emptyValue": '""'}


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Header CSV with an explicit schema; quoted fields may span lines. One task reads a file:
    :func:`read_csv_blocks` is for large files."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("multiLine", True)
        .option("mode", "PERMISSIVE")
        .options(**CSV_READ)
        .csv(path)
    )


def read_csv_blocks(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """:func:`read_csv` with many tasks for each file, however its quoted fields span lines."""
    return csv_blocks.read(spark, path, schema, CSV_READ)


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    """A1: T1 raw messages."""
    return read_csv_blocks(spark, path, MESSAGES_SCHEMA)


def read_categories(spark: SparkSession, path: str) -> DataFrame:
    """A1: T2 packed label strings."""
    return read_csv_blocks(spark, path, CATEGORIES_SCHEMA)


def read_clean_csv(spark: SparkSession, path: str, labels: Sequence[str]) -> DataFrame:
    """A2: a T3 clean table stored as CSV."""
    return read_csv_blocks(spark, path, clean_schema(list(labels)))


def read_table(spark: SparkSession, path_or_name: str, fmt: str = "parquet") -> DataFrame:
    """A3: a whole table, by catalog name or by path."""
    if "/" not in path_or_name and spark.catalog.tableExists(path_or_name):
        return spark.table(path_or_name)
    return spark.read.format(fmt).load(path_or_name)


def write_table(
    df: DataFrame, path: str, partition_by: Sequence[str] | None = None, fmt: str = "parquet"
) -> None:
    """A4: drop-and-replace write (optionally partitioned, e.g. by ``genre``)."""
    w = df.write.mode("overwrite").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def write_csv(df: DataFrame, path: str) -> None:
    """A5: CSV copy with a header (no index column)."""
    df.write.mode("overwrite").option("header", True).options(**CSV_WRITE).csv(path)


def read_back_check(
    spark: SparkSession, path: str, expected: T.StructType, n: int = 5, seed: int = 42,
    fmt: str = "parquet", key: str = "id",
) -> tuple[int, DataFrame]:
    """Read the written table back, require rows and the expected columns,
    return the row count and a seeded ``n``-row preview."""
    from msgtriage.operators.sampling import seeded_hash

    back = read_table(spark, path, fmt)
    if [f.name for f in back.schema.fields] != [f.name for f in expected.fields]:
        raise AssertionError(f"columns differ: {back.columns} vs {expected.fieldNames()}")
    count = back.count()
    if count == 0:
        raise AssertionError(f"{path} has no rows")
    preview = back.orderBy(seeded_hash(seed, F.col(key)), F.col(key)).limit(n)
    return count, preview


# --------------------------------------------------------------------------
# A7 word vectors in word2vec text format
# --------------------------------------------------------------------------


def write_word_vectors(vectors: DataFrame, path: str) -> None:
    """``n dim`` header line, then ``word v1 ... vdim`` per word.

    Components are written as doubles (shortest round-trip form), so reading
    back gives the same numbers.
    """
    stats = vectors.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vector")).alias("dim"))
    header = stats.select(F.concat_ws(" ", F.col("n").cast("string"), F.col("dim").cast("string")).alias("value"))
    lines = vectors.select(
        F.concat_ws(
            " ", F.col("word"), F.array_join(F.transform("vector", lambda x: x.cast("double").cast("string")), " ")
        ).alias("value")
    )
    header.unionByName(lines).write.mode("overwrite").text(path)


def read_word_vectors(spark: SparkSession, path: str, dim: int | None = None) -> DataFrame:
    """``(word, vector array<double>)`` from word2vec text format.

    The header line (``n dim``, two fields) is dropped; with ``dim`` given,
    only lines with exactly ``dim`` components are kept.
    """
    parts = spark.read.text(path).select(F.split(F.trim(F.col("value")), " +").alias("p"))
    keep = F.size("p") == dim + 1 if dim is not None else F.size("p") > 2
    return parts.where(keep).select(
        F.col("p")[0].alias("word"),
        F.transform(F.slice("p", 2, F.size("p")), lambda x: x.cast("double")).alias("vector"),
    )
