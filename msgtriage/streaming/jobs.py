"""Structured Streaming jobs.

Each job reads a landing folder of files with a fixed schema (never
inferred), keeps its progress in a checkpoint below the shared checkpoint
root, and writes an idempotent sink. ``trigger(availableNow=True)`` drains
what is there in bounded micro-batches and stops (a scheduled run); a
long-running deployment uses ``processingTime`` instead.
"""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from msgtriage.operators.ingest import dedupe_first
from msgtriage.operators.lexicon import measured_size


LANDING_FILE_BYTES = 128 * 1024 * 1024


def land_files(df: DataFrame, path: str, n_files: int = 4, order: str | None = None) -> int:
    """Write ``df`` into a landing folder for a stream, in one job; the number of files asked for.

    ``n_files`` is the least number of files; larger inputs get one per
    ``LANDING_FILE_BYTES`` of their measured size. With ``order`` (event time) the
    rows are range-partitioned on that column (NULL times first, no row is left out) and the
    files' modification times are set in that order, so they arrive in time order as a
    real feed would (the file source picks files up by modification time).
    """
    n_files = max(n_files, -(-measured_size(df)[1] // LANDING_FILE_BYTES))
    if order is None:
        df.repartition(n_files).write.mode("overwrite").parquet(path)
        return n_files
    df.repartitionByRange(n_files, F.col(order).asc_nulls_first()).write.mode("overwrite").parquet(path)
    spark = df.sparkSession
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    # parts are named by their range's number
    parts = sorted((f.getPath().getName(), f.getPath()) for f in system.listStatus(folder) if f.getPath().getName().startswith("part-"))
    start = int(time.time() * 1000) - 1000 * len(parts)
    for i, (_, part) in enumerate(parts):
        system.setTimes(part, start + 1000 * i, -1)
    return n_files


def per_batch(n_files: int, batches: int = 4) -> int:
    """Files of a micro-batch, so that a drain takes ``batches`` of them however much has landed: each
    batch has a fixed cost (its commits, a state store per shuffle partition), and its files are read
    by as many tasks."""
    return max(1, -(-n_files // batches))


def _reader(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def run(query: StreamingQuery) -> None:
    """Wait for an ``availableNow`` query to drain; re-raise its failure."""
    query.awaitTermination()
    if query.exception() is not None:  # pragma: no cover - awaitTermination raises
        raise RuntimeError(str(query.exception()))


# --------------------------------------------------------------------------
# S1 score a message stream
# --------------------------------------------------------------------------


def score_stream(
    spark: SparkSession, model: PipelineModel, labels: Sequence[str], source: str,
    schema: T.StructType, sink: str, checkpoint: str, key: str = "id", files_per_batch: int = 1,
) -> StreamingQuery:
    """Incoming messages -> fitted pipeline -> long predictions ``(key, label, yhat)``.

    Stateless: every micro-batch is a map-only job; the sink is a file sink
    whose commit log makes replays after a failure exactly-once.
    """
    stream = _reader(spark, source, schema, files_per_batch)
    scored = model.transform(stream)
    wide = scored.select(key, *[F.col(f"pred_{x}").cast("int").alias(x) for x in labels])
    long = wide.unpivot([key], list(labels), "label", "yhat")
    return (
        long.writeStream.format("parquet").option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True).start(sink)
    )


# --------------------------------------------------------------------------
# S2 live dashboard counts
# --------------------------------------------------------------------------


def _upsert_batches(sink: str):
    """foreachBatch writer: every batch's updated rows are appended with their
    batch id; readers keep the latest row per key (``read_latest``). Replaying
    a batch after a failure rewrites the same batch id, so it is idempotent
    for the reader."""

    def write(batch: DataFrame, batch_id: int) -> None:
        (
            batch.withColumn("_batch", F.lit(batch_id).cast("bigint"))
            .write.mode("append").parquet(sink)
        )

    return write


def read_latest(spark: SparkSession, sink: str, keys: Sequence[str]) -> DataFrame:
    """The newest version of every key written by ``_upsert_batches``."""
    df = spark.read.parquet(sink)
    values = [c for c in df.columns if c not in keys and c != "_batch"]
    latest = df.groupBy(*keys).agg(F.max(F.struct("_batch", *values)).alias("_l"))
    return latest.select(*keys, *[F.col(f"_l.{c}").alias(c) for c in values])


def count_stream(
    spark: SparkSession, source: str, schema: T.StructType, sink: str, checkpoint: str,
    column: str = "genre", files_per_batch: int = 1,
) -> StreamingQuery:
    """Running counts per value (``update`` mode: only changed groups leave
    each batch). State is one row per distinct value."""
    stream = _reader(spark, source, schema, files_per_batch)
    counts = stream.where(F.col(column).isNotNull()).groupBy(column).agg(
        F.count(F.lit(1)).alias("n")
    )
    return (
        counts.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
        .foreachBatch(_upsert_batches(sink)).trigger(availableNow=True).start()
    )


def windowed_event_stream(
    spark: SparkSession, source: str, schema: T.StructType, sink: str, checkpoint: str,
    window: str = "1 hour", watermark: str = "2 hours", files_per_batch: int = 1,
) -> StreamingQuery:
    """S2 on event time: tumbling-window counts and sums per event type.

    The watermark bounds the state: windows that end before it are evicted.
    Spark's guarantee is one-sided: events within the delay are always
    counted; events older than the watermark may or may not be.
    """
    stream = _reader(spark, source, schema, files_per_batch)
    agg = (
        stream.withWatermark("ts", watermark)
        .groupBy(F.window("ts", window).alias("w"), "event_type")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
        .select(F.col("w.start").alias("window_start"), "event_type", "n", "total")
    )
    return (
        agg.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
        .foreachBatch(_upsert_batches(sink)).trigger(availableNow=True).start()
    )


# --------------------------------------------------------------------------
# S3 streaming ingest with duplicate removal
# --------------------------------------------------------------------------


def dedupe_stream(
    spark: SparkSession, source: str, schema: T.StructType, sink: str, checkpoint: str,
    key: str = "id", order: Sequence[str] | None = None, files_per_batch: int = 1,
    mode: str = "state",
) -> StreamingQuery:
    """S3 without event time: write each key once.

    ``mode="state"`` (default): streaming ``dropDuplicates([key])``; the seen
    keys live in the state store (RocksDB, see ``session.DEFAULT_CONF``; one entry per
    key ever seen, so it suits key sets that fit the executors' disks), and a
    micro-batch costs lookups for its own rows only; the file sink's commit
    log makes replays exactly-once. Among copies of a key in one batch an
    arbitrary one is kept: use it where copies are identical, as the
    reference's are, and ``anti_join`` where the first by ``order`` matters.

    ``mode="anti_join"``: each batch keeps its first row per key by ``order``
    (D1, deterministic) and drops keys already in the sink with a
    ``left_anti`` join; a replayed batch finds its rows written and adds
    nothing. It re-reads the sink's key column every batch, so it suits
    small sinks only.
    """
    stream = _reader(spark, source, schema, files_per_batch)
    if mode == "state":
        return (
            stream.dropDuplicates([key]).writeStream.format("parquet")
            .option("checkpointLocation", checkpoint).outputMode("append")
            .trigger(availableNow=True).start(sink)
        )

    def write(batch: DataFrame, batch_id: int) -> None:
        first = dedupe_first(batch, key, order)
        try:
            seen = batch.sparkSession.read.schema(schema).parquet(sink).select(key)
            new = first.join(seen, key, "left_anti")
        except AnalysisException:  # the sink does not exist before the first batch
            new = first
        new.write.mode("append").parquet(sink)

    return (
        stream.writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(write).trigger(availableNow=True).start()
    )


def dedupe_event_stream(
    spark: SparkSession, source: str, schema: T.StructType, sink: str, checkpoint: str,
    key: str = "event_id", watermark: str = "2 hours", files_per_batch: int = 1,
) -> StreamingQuery:
    """S3 with event time: ``dropDuplicatesWithinWatermark`` (state bounded by
    the watermark), appended to a file sink."""
    stream = _reader(spark, source, schema, files_per_batch)
    unique = stream.withWatermark("ts", watermark).dropDuplicatesWithinWatermark([key])
    return (
        unique.writeStream.format("parquet").option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True).start(sink)
    )


def first_copy_stream(
    spark: SparkSession, source: str, schema: T.StructType, sink: str, checkpoint: str,
    key: Sequence[str], order: Sequence[str], time: str = "ts", ttl: str = "2 hours",
    watermark: str = "2 hours", files_per_batch: int = 1,
) -> StreamingQuery:
    """S3 with the first copy by ``order`` kept (D1) and bounded state.

    Rows of a key belong together while each comes less than ``ttl`` of event time after the one before;
    of such a run the smallest row by ``order`` (then by its other columns) is written once, with the
    run's number of rows as ``copies``, in whatever order the rows arrive. It is written when the watermark has passed the
    run's end, so the state holds the keys of the last ``ttl`` + ``watermark`` only, and the
    newest runs are written by later data. Copies are merged inside each task before the
    shuffle, so a key with a third of the rows is no single task's work. Rows later than the watermark, and
    rows without a time, are not part of any run. A restart goes on from the checkpoint; nothing is written twice.
    """
    rest = [f.name for f in schema.fields if f.name not in order]
    row = F.struct(*(F.col(f"`{c}`") for c in [*order, *rest]))
    keys = [F.col(f"`{c}`").alias(f"_key{i}") for i, c in enumerate(key)]
    runs = (
        _reader(spark, source, schema, files_per_batch).withWatermark(time, watermark)
        .groupBy(F.session_window(time, ttl), *keys)
        .agg(F.min(row).alias("_first"), F.count(F.lit(1)).alias("copies"))
    )
    first = runs.select(*(F.col(f"_first.`{f.name}`").alias(f.name) for f in schema.fields), "copies")
    merge = "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition"
    before = spark.conf.get(merge)
    spark.conf.set(merge, "true")
    try:  # a query keeps the settings of its start
        return (
            first.writeStream.format("parquet").option("checkpointLocation", checkpoint)
            .outputMode("append").trigger(availableNow=True).start(sink)
        )
    finally:
        spark.conf.set(merge, before)
