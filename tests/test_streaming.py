import datetime as dt
import os
import time

from pyspark.sql import functions as F

from msgtriage.operators import sampling
from msgtriage.session import scratch_path
from msgtriage.streaming import jobs

SCHEMA = "event_id long, ts timestamp, event_type string, value double"


def test_watermark_keeps_events_within_the_delay(spark):
    base = scratch_path(spark, "late-data")
    landing, sink, ckpt = (os.path.join(base, p) for p in ("in", "out", "ck"))
    t = lambda h, m=0: dt.datetime(2024, 1, 1, h, m)
    first = [(1, t(10, 5), "a", 1.0), (2, t(11, 10), "a", 2.0), (3, t(12, 0), "a", 4.0)]
    second = [(4, t(7, 30), "a", 8.0),   # older than the watermark (10:00): may or may not count
              (5, t(10, 30), "a", 16.0),  # late but within the delay: must join the 10:00 window
              (6, t(12, 40), "a", 32.0)]
    spark.createDataFrame(first, SCHEMA).coalesce(1).write.mode("append").parquet(landing)
    time.sleep(1.1)  # the file source orders files by modification time
    spark.createDataFrame(second, SCHEMA).coalesce(1).write.mode("append").parquet(landing)
    schema = spark.read.parquet(landing).schema
    jobs.run(jobs.windowed_event_stream(spark, landing, schema, sink, ckpt, "1 hour", "2 hours"))
    out = jobs.read_latest(spark, sink, ["window_start", "event_type"])
    got = {r.window_start.hour: (r.n, r.total) for r in out.collect()}
    assert {h: got[h] for h in (10, 11, 12)} == {10: (2, 17.0), 11: (1, 2.0), 12: (2, 36.0)}
    assert set(got) <= {7, 10, 11, 12}


def test_resampling_independent_of_partitioning(spark):
    df = spark.range(500).select("id", (F.col("id") % 7 == 0).cast("int").alias("t"))
    a = sampling.upsample(df.repartition(1), "t", 0.5, "id", 3)
    b = sampling.upsample(df.repartition(13), "t", 0.5, "id", 3)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    fa = sampling.assign_folds(df.repartition(2), 5, "id", 9)
    fb = sampling.assign_folds(df.repartition(11), 5, "id", 9)
    assert sorted(map(tuple, fa.collect())) == sorted(map(tuple, fb.collect()))


def test_first_copy_is_kept_over_restarts(spark):
    """Copies in any order, over two runs of the job: the first by ``order`` of each run of copies, written once."""
    base = scratch_path(spark, "first-copies")
    landing, sink, ckpt = (os.path.join(base, p) for p in ("in", "out", "ck"))
    t = lambda h, m=0: dt.datetime(2024, 1, 1, h, m)
    batches = [
        [(1, t(10, 5), "b", 1.0), (1, t(10, 0), "z", 2.0), (2, t(10, 10), "a", 3.0), (None, t(10), "n", 1.0), (9, None, "x", 0.0)],
        [(1, t(9, 30), "c", 4.0), (1, t(10, 40), "a", 0.0), (None, t(10), "m", 1.0)],  # an earlier copy arrives later
        [(2, t(13, 0), "b", 5.0), (3, t(13, 0), "b", 6.0), (3, t(13, 0), "a", 7.0)],
        [(4, t(20), "q", 0.0)],
    ]
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(landing)
        schema = spark.read.parquet(landing).schema
        jobs.run(jobs.first_copy_stream(spark, landing, schema, sink, ckpt, ["event_id"], ["ts"], ttl="1 hour", watermark="1 hour"))
        if i == 1:
            assert spark.read.schema(schema).parquet(sink).count() == 0  # no run has ended
    got = spark.read.parquet(sink).select("event_id", "ts", "event_type", "copies").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(
        [(1, t(9, 30), "c", 4), (2, t(10, 10), "a", 1), (None, t(10), "m", 2), (2, t(13), "b", 1), (3, t(13), "a", 2)], key=repr
    )


def test_batches_do_not_grow_with_the_files():
    assert [jobs.per_batch(n) for n in (0, 1, 4, 5, 96)] == [1, 1, 1, 2, 24]
