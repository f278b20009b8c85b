"""Queries: Structured Streaming jobs (S1-S3), each checked against its batch twin."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from msgtriage.operators import models
from msgtriage.plans.fixtures import messages_fx, table, with_fixtures
from msgtriage.plans.queries_ml import _split
from msgtriage.plans.registry import r6, register
from msgtriage.session import scratch_path
from msgtriage.streaming import jobs


def _paths(spark, name):
    base = scratch_path(spark, name)
    return tuple(os.path.join(base, p) for p in ("landing", "sink", "checkpoint"))


def _events(spark, sf_dir):
    """Events with ``ts`` as TIMESTAMP (watermarks need it; the table has NTZ)."""
    return table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


@register("stream_scores", ("S1", "K13", "A8"))
def q_stream_scores(spark, sf_dir):
    """Score the held-out messages as a stream with a model fitted in batch."""
    train, test, labels = _split(spark, sf_dir)
    model, _ = models.fit_multilabel(train, labels, "tfidf", "logistic", clf_params={"C": 0.01})
    landing, sink, ckpt = _paths(spark, "stream-scores")
    incoming = test.select("id", "message")
    files = jobs.per_batch(jobs.land_files(incoming, landing, 4))
    jobs.run(jobs.score_stream(spark, model, labels, landing, incoming.schema, sink, ckpt, "id", files))
    return spark.read.parquet(sink)


@register(
    "stream_genre_counts",
    ("S2", "F3"),
    with_fixtures(
        "SELECT genre, count(*) AS n FROM messages_fx WHERE genre IS NOT NULL GROUP BY genre",
        "messages_fx",
    ),
)
def q_stream_genre_counts(spark, sf_dir):
    landing, sink, ckpt = _paths(spark, "stream-genres")
    msgs = messages_fx(spark, sf_dir)
    files = jobs.per_batch(jobs.land_files(msgs, landing, 4))
    jobs.run(jobs.count_stream(spark, landing, msgs.schema, sink, ckpt, "genre", files))
    return jobs.read_latest(spark, sink, ["genre"])


@register(
    "stream_event_windows",
    ("S2",),
    """SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS window_start, event_type,
              count(*) AS n, round(sum(value), 6) AS total
       FROM events GROUP BY ALL""",
)
def q_stream_event_windows(spark, sf_dir):
    landing, sink, ckpt = _paths(spark, "stream-windows")
    events = _events(spark, sf_dir)
    jobs.land_files(events, landing, 4, order="ts")
    jobs.run(jobs.windowed_event_stream(spark, landing, events.schema, sink, ckpt, "1 hour", "2 hours"))
    out = jobs.read_latest(spark, sink, ["window_start", "event_type"])
    return out.select(
        F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"),
        "event_type", "n", r6("total").alias("total"),
    )


@register(
    "stream_dedupe",
    ("S3", "D1"),
    with_fixtures("SELECT DISTINCT id, genre FROM messages_fx", "messages_fx"),
)
def q_stream_dedupe(spark, sf_dir):
    landing, sink, ckpt = _paths(spark, "stream-dedupe")
    msgs = messages_fx(spark, sf_dir)
    files = jobs.per_batch(jobs.land_files(msgs, landing, 4))
    jobs.run(jobs.dedupe_stream(spark, landing, msgs.schema, sink, ckpt, "id", files_per_batch=files))
    return spark.read.parquet(sink).select("id", "genre")


@register(
    "stream_event_dedupe",
    ("S3",),
    "SELECT DISTINCT event_id, event_type FROM events",
)
def q_stream_event_dedupe(spark, sf_dir):
    landing, sink, ckpt = _paths(spark, "stream-event-dedupe")
    events = _events(spark, sf_dir)
    jobs.land_files(events, landing, 4, order="ts")
    jobs.run(jobs.dedupe_event_stream(spark, landing, events.schema, sink, ckpt, "event_id"))
    return spark.read.parquet(sink).select("event_id", "event_type")


@register(
    "stream_first_copies",
    ("S3", "D1"),
    """WITH e AS (SELECT *, CASE WHEN ts - lag(ts) OVER k < INTERVAL 2 HOUR THEN 0 ELSE 1 END AS opens
                  FROM events WINDOW k AS (PARTITION BY user_id, event_type ORDER BY ts, event_id)),
            r AS (SELECT *, sum(opens) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS run FROM e)
       SELECT user_id, event_type, arg_min(event_id, (ts, event_id)) AS event_id, count(*) AS copies
       FROM r GROUP BY user_id, event_type, run
       HAVING max(ts) + INTERVAL 2 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 2 HOUR""",
)
def q_stream_first_copies(spark, sf_dir):
    """The first event of each user and type in every run with less than two hours between events."""
    landing, sink, ckpt = _paths(spark, "stream-first-copies")
    events = _events(spark, sf_dir)
    jobs.land_files(events, landing, 4, order="ts")
    jobs.run(jobs.first_copy_stream(spark, landing, events.schema, sink, ckpt, ["user_id", "event_type"], ["ts", "event_id"]))
    return spark.read.parquet(sink).select("user_id", "event_type", "event_id", "copies")
