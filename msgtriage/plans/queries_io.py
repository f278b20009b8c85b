"""Queries: source / sink round trips (A1-A6) through the shared scratch folder."""

from __future__ import annotations

from pyspark.sql.types import StructType

from msgtriage.operators.ingest import clean_messages
from msgtriage.plans import etl
from msgtriage.plans.fixtures import categories_fx, messages_fx, with_fixtures
from msgtriage.plans.registry import register
from msgtriage.schema import clean_schema
from msgtriage.session import scratch_path
from msgtriage.sources import files

CLEAN_SQL = with_fixtures("SELECT * FROM clean_fx", "clean_fx")


@register("csv_roundtrip", ("A1", "A5", "C1", "D1"), CLEAN_SQL)
def q_csv_roundtrip(spark, sf_dir):
    """Write T1/T2 as CSV (multi-line quoted text), read back with explicit schemas, clean."""
    mpath, cpath = scratch_path(spark, "messages-csv"), scratch_path(spark, "categories-csv")
    files.write_csv(messages_fx(spark, sf_dir), mpath)
    files.write_csv(categories_fx(spark, sf_dir), cpath)
    clean, _ = clean_messages(files.read_messages(spark, mpath), files.read_categories(spark, cpath))
    return clean


@register("clean_csv_read", ("A2", "A5"), CLEAN_SQL)
def q_clean_csv_read(spark, sf_dir):
    clean, labels = etl.clean_table(spark, sf_dir)
    path = scratch_path(spark, "clean-csv")
    files.write_csv(clean, path)
    return files.read_clean_csv(spark, path, labels)


@register("table_roundtrip", ("A3", "A4", "A6"), CLEAN_SQL)
def q_table_roundtrip(spark, sf_dir):
    """Drop-and-replace Parquet write partitioned by genre, read back, checked."""
    clean, labels = etl.clean_table(spark, sf_dir)
    path = scratch_path(spark, "clean-table")
    files.write_table(clean, path, partition_by=["genre"])
    # a partition column is read back as the last column
    fields = clean_schema(labels).fields
    expected = StructType([f for f in fields if f.name != "genre"] + [f for f in fields if f.name == "genre"])
    files.read_back_check(spark, path, expected)
    return files.read_table(spark, path).select(*clean.columns)
