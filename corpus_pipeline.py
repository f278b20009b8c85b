"""The corpus pipeline: documents through five of the training-data operators.

Every stage takes ``(spark, docs, sf_dir)`` with all its predecessor kept, and returns a
DataFrame that is written as Parquet to the shared folder and read again as the next
stage's documents. All stages but the last return the columns of ``docs``.

1. *language*: documents without a letter, whose language is uncertain, or whose words are unlikely
   in the best of the learned languages go. If no document has a language, none can be
   learned, and all with a letter stay.
2. *near duplicates*: of each group of near copies the document with the smallest id stays.
3. *decontamination*: passages of benchmark items are cut out; documents made up of them go.
4. *personal data*: spans found are replaced by their kind.
5. *mixing*: documents are repeated or left out until sources stand at their target weights.

Rows with a null ``doc_id`` are documents like all others. The models and tables
are fitted on the documents of their own stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from msgtriage.llm import decontaminate, langid, mixing, ngram_join, pii
from msgtriage.llm.queries import TOKENIZERS, reach_workers, table
from msgtriage.session import materialize

MIN_LANGUAGE_SCORE = 0.5
MIN_LANGUAGE_FIT = -3.0  # texts half in another learned language lie above -2, other languages below -4.5 (sf0.01)
MAX_COVERAGE = 0.5


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: reject ``und``, scores below ``MIN_LANGUAGE_SCORE`` and fits below
    ``MIN_LANGUAGE_FIT``; without any language to learn only texts without a letter."""
    reach_workers(spark)
    model = langid.fit(docs, langid.vocabulary_pieces(f"{TOKENIZERS}/piece_bpe_32k.model"))
    names = ("__lang", "__score", "__fit")
    found = langid.predict(docs, model, names=names)
    if not model.langs:
        return found.where(F.col("__fit") > float("-inf")).select(*docs.columns)
    known = (F.col("__lang") != langid.UNKNOWN) & (F.col("__score") >= MIN_LANGUAGE_SCORE)
    return found.where(known & (F.col("__fit") >= MIN_LANGUAGE_FIT)).select(*docs.columns)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join: of each component the smallest ``doc_id`` stays, once."""
    reach_workers(spark)
    return ngram_join.keep_one_per_group(docs, width=5, threshold=80)


def _recounted(docs: DataFrame) -> DataFrame:
    """The column ``n_chars``, if there is one, for the texts as they are now."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.coalesce(F.length("text").cast(docs.schema["n_chars"].dataType), "n_chars"))


def cut_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination of spans; documents covered by ``MAX_COVERAGE`` or more go."""
    return _recounted(decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"), max_coverage=MAX_COVERAGE))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """PII: every span becomes the name of its kind."""
    return _recounted(pii.redact(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing sources to target weights: one row per copy taken."""
    return mixing.mix(docs, copy_column="mix_copy")


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("language", keep_known_languages),
    ("near_duplicates", keep_one_of_near_copies),
    ("decontamination", cut_benchmark_passages),
    ("personal_data", redact_personal_data),
    ("mixing", mix_sources),
]

# The fitted language model and the hashed sampling have no SQL form; the tests hold the
# stages against brute force instead.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
