"""Cases that once lost rows, looped or multiplied."""

import pytest
from pyspark.sql import functions as F

from msgtriage.operators import models, sampling, vectors
from msgtriage.session import scratch_path
from msgtriage.streaming import jobs


@pytest.mark.parametrize(
    "counts,median",
    [({0.0: 3000, 1.0: 3000}, 0.5), ({0.0: 3001, 1.0: 3000}, 0.0), ({0.0: 2000, 1.0: 1, 2.0: 2001}, 1.5), ({5.0: 4000}, 5.0), ({float(i): 7 for i in range(900)}, 449.5)],
)
def test_median_of_tied_values_ends(spark, counts, median):
    rows = spark.createDataFrame(list(counts.items()), "x double, n int")
    rows = rows.select(F.explode(F.array_repeat("x", F.col("n"))).alias("x")).union(spark.sql("select double('NaN') union all select cast(null as double)"))
    assert vectors.global_median(rows, collect_limit=100) == median


def test_landing_keeps_rows_without_time(spark):
    rows = spark.range(1000).select("id", F.when(F.col("id") % 10 > 0, F.timestamp_seconds(F.col("id") * 997 % 5000)).alias("ts"))
    path = scratch_path(spark, "landing")
    jobs.land_files(rows, path, 4, order="ts")
    assert sorted(spark.read.parquet(path).collect()) == sorted(rows.collect(), key=lambda r: r.id)
    files = spark.read.parquet(path).select("ts", F.col("_metadata.file_modification_time").alias("at"))
    spans = files.groupBy("at").agg(F.min("ts").alias("lo"), F.max("ts").alias("hi")).orderBy("at").collect()
    assert len(spans) == 4
    ends = [(r.lo, r.hi) for r in spans if r.hi is not None]
    assert all(a[1] <= b[0] for a, b in zip(ends[:-1], ends[1:]))


def test_empty_class_cannot_be_drawn_from(spark):
    df = spark.createDataFrame([(i, 0) for i in range(8)], "id long, y int")
    with pytest.raises(ValueError):
        sampling.upsample(df, "y", 0.5)


def test_predictions_of_repeated_keys_do_not_multiply(spark):
    rows = [(1, 0, 1.0), (1, 1, 0.0), (2, 1, 1.0)]
    scored = spark.createDataFrame(rows, "id long, y int, pred_y double")
    got = sorted(map(tuple, models._long(scored, ["y"], "id").collect()))
    assert got == [(1, "y", 0, 1), (1, "y", 1, 0), (2, "y", 1, 1)]


def test_word_vectors_use_every_embedding(spark):
    emb = spark.createDataFrame([(i, [float(i)]) for i in range(37)], "vec_id long, embedding array<float>")
    words = spark.range(3000).select(F.concat(F.lit("w"), "id").alias("word"))
    got = vectors.hashed_word_vectors(words, emb)
    assert got.count() == 3000 and got.select("vector").distinct().count() == 37
