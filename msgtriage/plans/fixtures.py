"""Reference-shaped inputs derived by Spark from the given tables.

``messages_fx`` (T1) and ``categories_fx`` (T2) follow the definitions in
FIXTURES.md: every document becomes a message, every labelled document a
packed label string; duplicate ids, ``related = 2`` values, all-zero rows and
a constant label are planted deterministically from the id. The whole tables
are used; the id arithmetic only *adds* planted copies / values.

Each builder has a DuckDB SQL twin (``*_SQL``) used by the oracle queries.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
]

#: Labels of the fixture, in packed-string order.
FIXTURE_LABELS = ["related", "toxic", "long", "multi_line", "child_alone"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def messages_fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id, message, original, genre``; ids divisible by 40 appear twice."""
    docs = table(spark, sf_dir, "documents")
    base = docs.select(
        F.col("doc_id").alias("id"),
        F.col("text").alias("message"),
        F.when(F.col("lang") == "en", F.lit(None).cast("string"))
        .otherwise(F.col("text"))
        .alias("original"),
        F.col("lang").alias("genre"),
    )
    return base.unionByName(base.where(F.col("id") % 40 == 0))


def categories_fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id, categories`` packed as ``name-d;...``; ids divisible by 40 twice."""
    labels = table(spark, sf_dir, "labels")
    # Derive the two text facts before the join so the text itself is never shuffled.
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.col("n_chars") >= 2000).cast("int").alias("is_long"),
        (F.instr(F.col("text"), "\n") > 0).cast("int").alias("is_multi_line"),
    )
    related = F.when(F.col("doc_id") % 50 == 0, F.lit(2)).otherwise(F.col("quality"))
    base = labels.join(docs, "doc_id").select(
        F.col("doc_id").alias("id"),
        F.concat_ws(
            ";",
            F.concat(F.lit("related-"), related.cast("string")),
            F.concat(F.lit("toxic-"), F.col("toxic").cast("string")),
            F.concat(F.lit("long-"), F.col("is_long").cast("string")),
            F.concat(F.lit("multi_line-"), F.col("is_multi_line").cast("string")),
            F.lit("child_alone-0"),
        ).alias("categories"),
    )
    return base.unionByName(base.where(F.col("id") % 40 == 0))


def predictions_fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixed predictions, long form ``(id, label, y, yhat)`` over quality and toxic."""
    labels = table(spark, sf_dir, "labels")
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", F.when(F.col("n_chars") % 3 == 0, 1).otherwise(0).alias("yhat")
    )
    joined = labels.join(docs, "doc_id").select(
        F.col("doc_id").alias("id"), "quality", "toxic", "yhat"
    )
    return joined.unpivot(["id", "yhat"], ["quality", "toxic"], "label", "y").select(
        "id", "label", F.col("y").cast("int").alias("y"), F.col("yhat").cast("int").alias("yhat")
    )


# --------------------------------------------------------------------------
# DuckDB twins (CTE bodies)
# --------------------------------------------------------------------------

MESSAGES_FX_SQL = """
SELECT doc_id AS id, text AS message,
       CASE WHEN lang = 'en' THEN NULL ELSE text END AS original, lang AS genre
FROM documents
UNION ALL
SELECT doc_id, text, CASE WHEN lang = 'en' THEN NULL ELSE text END, lang
FROM documents WHERE doc_id % 40 = 0
"""

CATEGORIES_FX_SQL = """
WITH base AS (
  SELECT l.doc_id AS id,
         concat('related-', CASE WHEN l.doc_id % 50 = 0 THEN 2 ELSE l.quality END,
                ';toxic-', l.toxic,
                ';long-', CASE WHEN d.n_chars >= 2000 THEN 1 ELSE 0 END,
                ';multi_line-', CASE WHEN d.text LIKE concat('%', chr(10), '%') THEN 1 ELSE 0 END,
                ';child_alone-0') AS categories
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id)
SELECT id, categories FROM base
UNION ALL
SELECT id, categories FROM base WHERE id % 40 = 0
"""

#: T3 clean table: keep first per id by (message, original, genre, categories).
CLEAN_FX_SQL = """
SELECT id, message, genre,
       TRY_CAST(right(split_part(categories, ';', 1), 1) AS INTEGER) AS related,
       TRY_CAST(right(split_part(categories, ';', 2), 1) AS INTEGER) AS toxic,
       TRY_CAST(right(split_part(categories, ';', 3), 1) AS INTEGER) AS long,
       TRY_CAST(right(split_part(categories, ';', 4), 1) AS INTEGER) AS multi_line,
       TRY_CAST(right(split_part(categories, ';', 5), 1) AS INTEGER) AS child_alone
FROM (
  SELECT m.id, m.message, m.original, m.genre, c.categories,
         row_number() OVER (PARTITION BY m.id
                            ORDER BY m.message NULLS FIRST, m.original NULLS FIRST,
                                     m.genre NULLS FIRST, c.categories NULLS FIRST) AS rn
  FROM messages_fx m JOIN categories_fx c ON m.id = c.id
) j
WHERE rn = 1 AND TRY_CAST(right(split_part(categories, ';', 1), 1) AS INTEGER) IS NOT NULL
"""

#: Training rows: all-zero rows dropped, then related = 2 dropped.
TRAINING_FX_SQL = """
SELECT * FROM clean_fx
WHERE related + toxic + long + multi_line + child_alone >= 1 AND related <> 2
"""

PREDICTIONS_FX_SQL = """
SELECT l.doc_id AS id, 'quality' AS label, l.quality AS y,
       CASE WHEN d.n_chars % 3 = 0 THEN 1 ELSE 0 END AS yhat
FROM labels l JOIN documents d ON l.doc_id = d.doc_id
UNION ALL
SELECT l.doc_id, 'toxic', l.toxic, CASE WHEN d.n_chars % 3 = 0 THEN 1 ELSE 0 END
FROM labels l JOIN documents d ON l.doc_id = d.doc_id
"""


def with_fixtures(body: str, *names: str, ctes: tuple[tuple[str, str], ...] = ()) -> str:
    """Prefix ``body`` with the fixture CTEs it needs, then the extra ``ctes``."""
    order = ["messages_fx", "categories_fx", "clean_fx", "training_fx", "predictions_fx"]
    sql = {
        "messages_fx": MESSAGES_FX_SQL,
        "categories_fx": CATEGORIES_FX_SQL,
        "clean_fx": CLEAN_FX_SQL,
        "training_fx": TRAINING_FX_SQL,
        "predictions_fx": PREDICTIONS_FX_SQL,
    }
    needs = set(names)
    if "training_fx" in needs:
        needs.add("clean_fx")
    if "clean_fx" in needs:
        needs |= {"messages_fx", "categories_fx"}
    parts = [f"{n} AS ({sql[n]})" for n in order if n in needs]
    parts += [f"{n} AS ({q})" for n, q in ctes]
    if not parts:
        return body
    return "WITH " + ",\n".join(parts) + "\n" + body
